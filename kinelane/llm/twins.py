"""SQL twins shared by several text operators: CRC-32 and Merkle levels in plain SQL."""

from __future__ import annotations


def crc32_of(codes: str) -> str:
    """SQL for the CRC-32 of a list of byte values, taken half a byte pos a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    halves = f"flatten(list_transform({codes}, lambda b: [b & 15, b >> 4]))"
    step = f"xor(c >> 4, list_extract({table}::BIGINT[], (xor(c, h) & 15) + 1))"
    register = f"list_reduce(list_transform({halves}, lambda h: h::BIGINT), lambda c, h: {step}, 4294967295::BIGINT)"
    return f"xor({register}, 4294967295::BIGINT)"


def bytes_of(text: str) -> str:
    """SQL for the UTF-8 bytes of a text of code points below U+0800."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda ch: "
        "CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] "
        "ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)] END))"
    )


def tree_levels(name: str, nodes: str, fanout: int, levels: int) -> list[str]:
    """Common table expressions ``name0`` to ``name{levels}`` of a tree over ``nodes`` (g, pos, n, h).

    Each level has a node's siblings to both sides; a group's last node is carried up.
    """
    def beside(number: int, source: str) -> str:
        run = f"PARTITION BY g, pos // {fanout} ORDER BY pos ROWS BETWEEN"
        return (
            f"{name}{number} AS (SELECT g, pos, n, h, "
            f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
            f"FROM ({source}))"
        )

    out = [beside(0, f"SELECT g, pos, n, h FROM {nodes}")]
    for number in range(levels):
        parents = (
            f"SELECT g, pos // {fanout} AS pos, (max(n) + {fanout - 1}) // {fanout} AS n, "
            "CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h "
            f"FROM {name}{number} GROUP BY g, pos // {fanout}"
        )
        out.append(beside(number + 1, parents))
    return out


def tree_climb(start: str, name: str, fanout: int, levels: int) -> list[str]:
    """Expressions that take ``start`` (id, g, pos, folded, proof) up all levels, in ``name_up``.

    ``start`` names a table with those columns; each level folds the siblings in.
    """
    out, source = [], start
    for number in range(levels):
        step = f"{name}_up{number}"
        out.append(
            f"{step} AS (SELECT s.id, s.g, s.pos // {fanout} AS pos, "
            "CASE WHEN t.n > 1 THEN sha256(t.l || s.folded || t.r) ELSE s.folded END AS folded, "
            "CASE WHEN t.n > 1 THEN s.proof || t.l || t.r ELSE s.proof END AS proof "
            f"FROM {source} s JOIN {name}{number} t ON t.g IS NOT DISTINCT FROM s.g AND t.pos = s.pos)"
        )
        source = step
    return out
