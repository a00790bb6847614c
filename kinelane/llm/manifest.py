"""A Merkle manifest of a dataset: digests of rows, of runs of eight, of groups, of all.

Slot pivot: the children of a parent are spread into one column for each slot by a
conditional aggregate. Their concatenation is what the parent hashes; without the own
slot's column it is what a child needs beside itself to prove its place. Rows are
numbered by a range shuffle and counts for each range, so no group passes one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelane.llm import twins
from kinelane.llm.common import stored

FANOUT = 8
#: The columns of a leaf, in order, and what stands for a null.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ABSENT = "-"
#: One row in so many is tampered with when proofs are tried out.
TAMPERED = 3

#: Siblings to the left and right of a node and of its ancestors, from below.
PATH = "array<struct<left string, right string>>"
_UPPER, _LOWER = (bytes(range(first, first + 26)).decode() for first in (0x41, 0x61))


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    written = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(written, F.lit(ABSENT))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with other values for some of its fields."""
    return digest(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, group, leaf and tampered (null where the row is left alone)."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    lowered = leaf(text=F.translate("text", _UPPER, _LOWER))
    return docs.select(
        "doc_id",
        # Without nulls, and in the order of the groups: null first, then bytewise.
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("group"),
        leaf().alias("leaf"),
        F.when(chosen, lowered).alias("tampered"),
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``at``, the place of a row in its ``group`` (from 0), and the group's ``n``.

    Rows are dealt by ranges of the whole order, equal rows too, and the places within a
    range are written out, so a lost executor cannot move them. Only the counts of each
    range and group are added up.
    """
    listed = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["group", *order, "_row"]
    placed = stored(
        listed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.spark_partition_id())
    )
    counts = placed.groupBy("group", "_range").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy("group").orderBy("_range")
    starts = counts.select(
        "group", "_range",
        (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_start"),
        F.sum("_n").over(Window.partitionBy("group")).alias("n"),
    )
    joined = placed.join(starts, ["group", "_range"])
    return joined.withColumn("at", F.col("_place") + F.col("_start")).drop("_place", "_range", "_start")


def _parents(n: Column) -> Column:
    return F.ceil(n / FANOUT).cast("long")


def pivoted(nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row for each parent, with its children's structs in columns slot0 to slot7.

    ``nodes`` have group, at, n, digest; parents are numbered in ``at`` with their
    number in ``n`` and their own digest.
    """
    slot = F.col("at") % FANOUT
    child = F.struct("digest", *carried)
    columns = [F.first(F.when(slot == i, child), ignorenulls=True).alias(f"slot{i}") for i in range(FANOUT)]
    runs = nodes.groupBy(
        "group", _parent_of(F.col("at")).alias("at"), _parents(F.col("n")).alias("n")
    ).agg(*columns)
    digests = [F.col(f"slot{i}.digest") for i in range(FANOUT)]
    return runs.withColumn("digest", digest(F.concat_ws("", *digests)))


def _parent_of(at: Column) -> Column:
    return F.floor(at / FANOUT).cast("long")


def _children(paths: DataFrame, runs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The nodes of the runs, each with its path: its siblings, then its parent's path.

    ``paths`` have group, at, path of the parents and whatever all of a group share.
    """
    joined = runs.drop("n", "digest").join(paths, ["group", "at"])
    shared = [c for c in paths.columns if c not in ("group", "at", "path")]
    digests = [F.col(f"slot{i}.digest") for i in range(FANOUT)]

    def child(i: int) -> Column:
        own = F.struct(
            F.concat_ws("", *digests[:i], F.lit("")).alias("left"),
            F.concat_ws("", *digests[i + 1 :], F.lit("")).alias("right"),
        )
        node = F.struct(
            "group", (F.col("at") * FANOUT + i).alias("at"),
            F.concat(F.array(own), F.col("path")).alias("path"), *shared,
            *[F.col(f"slot{i}.{c}").alias(c) for c in ("digest", *carried)],
        )
        return F.when(F.col(f"slot{i}").isNotNull(), node)

    each = F.explode(F.array_compact(F.array(*[child(i) for i in range(FANOUT)])))
    return joined.select(each.alias("_child")).select("_child.*")


def _levels(nodes: DataFrame, carried: tuple[str, ...] = ()) -> list[DataFrame]:
    """Runs of all levels from below, each written out; the last holds single nodes."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while most > 1:
        runs = stored(pivoted(nodes.where("n > 1"), carried if not levels else ()))
        levels.append(runs)
        nodes = runs.select("group", "at", "n", "digest")
        most = -(-most // FANOUT)
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """group and digest of the node that remains of each group."""
    remaining = nodes.where("n = 1").select("group", "digest")
    for runs in levels:
        remaining = remaining.union(runs.where("n = 1").select("group", "digest"))
    return remaining


def _descended(
    nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, carried: tuple[str, ...] = ()
) -> DataFrame:
    """All nodes with their paths; ``tops`` have group, path and what a group shares."""
    first = tops.withColumn("at", F.lit(0).cast("long"))
    shared = [c for c in tops.columns if c not in ("group", "path")]
    columns = ["group", "at", "path", *shared]
    paths = None
    for height in range(len(levels) - 1, -1, -1):
        # Groups that end at this height start from their top.
        ends = levels[height].where("n = 1").select("group", "at")
        own = ends.join(first, ["group", "at"]).select(*columns)
        paths = own if paths is None else paths.select(*columns).union(own)
        paths = _children(paths, levels[height], carried if not height else ())
    alone = nodes.where("n = 1").select("group", "at", "digest", *carried)
    alone = alone.join(first, ["group", "at"])
    named = [*columns, "digest", *carried]
    return alone.select(*named) if paths is None else paths.select(*named).union(alone.select(*named))


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its path give."""
    return F.aggregate(path, node, lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, from below, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, group, digest, tampered, path, subroot and root for each row of ``docs``.

    Rows without a language are a group of their own. Rows that share an id are ordered by
    their digests, equal rows are neighbours; rows without an id come first in their
    group and are never tampered with. Extra columns are ignored, and an empty table
    gives no rows.
    """
    found = stored(leaves(docs))
    carried = ("doc_id", "tampered")
    nodes = stored(numbered(found, ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest"))
    levels = _levels(nodes, carried)
    # The subroots are leaves of a tree of their own, of one group, in order of the languages.
    tops = _tops(nodes, levels).withColumnRenamed("group", "name")
    upper = stored(numbered(tops.withColumn("group", F.lit("")), ["name"]))
    upper_levels = _levels(upper, ("name",))
    root = _tops(upper, upper_levels).select(
        "group", F.col("digest").alias("root"), F.array().cast(PATH).alias("path")
    )
    subroots = stored(
        _descended(upper, upper_levels, root, ("name",)).select(
            F.col("name").alias("group"), "path", F.col("digest").alias("subroot"), "root"
        )
    )
    return _descended(nodes, levels, subroots, carried)


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row.

    The proof is tried on the row as it is, or on its tampered form.
    """
    tried = proofs(docs).withColumn(
        "folded_root", folded(F.coalesce("tampered", "digest"), F.col("path"))
    )
    return tried.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Levels of the SQL twin: enough for 8 ** 9 rows of a language, and as many languages.
SQL_LEVELS = 9


def _sql() -> str:
    def field(name: str, value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '{ABSENT}')"

    def row(text: str) -> str:
        return f"sha256({' || '.join(field(c, text if c == 'text' else c) for c in FIELDS)})"

    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = twins.crc32_of(twins.bytes_of("doc_id::VARCHAR"))
    parts = [
        f"rows AS (SELECT doc_id, lang, {row('text')} AS h, "
        f"CASE WHEN doc_id IS NOT NULL AND {crc} % {TAMPERED} = 0 THEN {row(lowered)} END AS other FROM documents)",
        "leaves AS (SELECT *, lang AS g, row_number() OVER () AS id, "
        "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, "
        "count(*) OVER (PARTITION BY lang) AS n FROM rows)",
        *twins.tree_levels("low", "leaves", FANOUT, SQL_LEVELS),
        f"subroots AS (SELECT g AS lang, h, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, "
        f"count(*) OVER () AS n FROM low{SQL_LEVELS})",
        *twins.tree_levels("top", "subroots", FANOUT, SQL_LEVELS),
        "start AS (SELECT id, g, pos, coalesce(other, h) AS folded, '' AS proof FROM leaves)",
        *twins.tree_climb("start", "low", FANOUT, SQL_LEVELS),
        "turn AS (SELECT u.id, s.g, s.pos, u.folded, u.proof "
        f"FROM low_up{SQL_LEVELS - 1} u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.g)",
        *twins.tree_climb("turn", "top", FANOUT, SQL_LEVELS),
    ]
    return (
        f"WITH {', '.join(parts)} "
        "SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(u.proof) AS proof_sha256, "
        "u.folded AS folded_root, u.folded = t.h AS verified FROM leaves l "
        f"JOIN top_up{SQL_LEVELS - 1} u ON u.id = l.id "
        f"JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN top{SQL_LEVELS} t"
    )


ORACLE = _sql()
