"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's pattern is turned into a Boolean query over trigrams that any match must
hold: alternatives, each a set of trigrams. Postings (trigram, document) are kept for the
trigrams that some query asks for; intersecting them gives the candidates of each rule,
and only these are searched with its pattern. A rule without mandatory trigrams searches
all documents.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelane.llm.common import stored, text_or_empty


class Rule(NamedTuple):
    """A kind of secret: its pattern, and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int
    least: int


BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: What the scan finds beyond the base rules.
MORE_RULES = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("hosted", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
)
RULES = BASE_RULES + MORE_RULES

#: Marks the borders of matches; where a text holds it, the next code point stands in.
_MARK, _STAND_IN = "\ufdd0", "\ufdd1"
_REDACTED = "[SECRET]"
#: Code points of the chunks of a text from which the kept parts are taken.
_CHUNK = 1024
#: Literal alternatives followed at once while a query is derived.
_ALTERNATIVES = 64

Query = frozenset[frozenset[str]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _least(query: Query) -> Query:
    """Without alternatives that ask for all that another asks for."""
    return frozenset(q for q in query if not any(other < q for other in query))


def _strings(node: tuple) -> set[str] | None:
    """All texts a part of a pattern can match in lower case, if they are few."""
    kind, value = node
    if kind is sre.LITERAL:
        return {chr(value).lower()}
    if kind is sre.IN:
        found: set[str] = set()
        for inner, what in value:
            if inner is sre.LITERAL:
                found.add(chr(what).lower())
            elif inner is sre.RANGE and what[1] - what[0] < 8:
                found |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is sre.SUBPATTERN:
        return _sequence_strings(list(value[-1]))
    if kind is sre.BRANCH:
        found = set()
        for branch in value[1]:
            inner = _sequence_strings(list(branch))
            if inner is None:
                return None
            found |= inner
        return found if len(found) <= _ALTERNATIVES else None
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 4:
        inner = _sequence_strings(list(value[2]))
        if inner is None:
            return None
        found = set()
        for times in range(value[0], value[1] + 1):
            found |= {"".join(p) for p in product(inner, repeat=times)}
            if len(found) > _ALTERNATIVES:
                return None
        return found
    return None


def _sequence_strings(nodes: list[tuple]) -> set[str] | None:
    found = {""}
    for node in nodes:
        own = _strings(node)
        if own is None or len(found) * len(own) > _ALTERNATIVES:
            return None
        found = {a + b for a in found for b in own}
    return found


def trigram_query(pattern: str) -> Query | None:
    """Alternatives of trigrams, one of which any match holds in lower case.

    None if the pattern asks for none, so that all texts must be searched.
    """
    needs: Query = frozenset([frozenset()])

    def meet(strings: set[str]) -> None:
        nonlocal needs
        own = frozenset(_trigrams(s) for s in strings)
        if frozenset() in own:
            return
        joined = _least(frozenset(a | b for a in needs for b in _least(own)))
        if len(joined) <= _ALTERNATIVES:
            needs = joined

    def walk(nodes: list[tuple]) -> None:
        run = {""}
        for node in nodes:
            own = _strings(node)
            if own is not None and len(run) * len(own) <= _ALTERNATIVES:
                run = {a + b for a in run for b in own}
                continue
            meet(run)
            run = own if own is not None else {""}
            kind, value = node
            if own is None and kind is sre.SUBPATTERN:
                walk(list(value[-1]))
            elif own is None and kind is sre.MAX_REPEAT and value[0] > 0:
                walk(list(value[2]))
        meet(run)

    walk(list(sre_parser.parse(pattern)))
    return None if needs == frozenset([frozenset()]) else needs


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id, print) for each text that holds the trigram in any case."""
    lower = docs.select("doc_id", "print", F.lower("_text").alias("low"))
    held = F.array_compact(F.array(
        *(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)
    ))
    return lower.select(F.explode(held).alias("trigram"), "doc_id", "print")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id, print and the kinds whose trigram query the text meets.

    The posting lists of a clause are intersected by counting, which shuffles partial
    counts by document; a common trigram is spread over all documents that hold it.
    """
    spark = docs.sparkSession
    clauses = [
        (rule.kind, number, trigram, len(clause))
        for rule in rules
        if (query := trigram_query(rule.pattern)) is not None
        for number, clause in enumerate(sorted(map(sorted, query)))
        for trigram in clause
    ]
    asked = spark.createDataFrame(clauses, "kind string, clause int, trigram string, need int")
    index = postings(docs, sorted({c[2] for c in clauses}))
    # As many rows as the rules have trigrams.
    met = index.join(F.broadcast(asked), "trigram")
    whole = (
        met.groupBy("doc_id", "print", "kind", "clause")
        .agg(F.count_distinct("trigram").alias("n"), F.first("need").alias("need"))
        .where("n = need")
    )
    return whole.groupBy("doc_id", "print").agg(F.collect_set("kind").alias("kinds"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each value joined with all before it, in as many passes as their number has digits."""
    def joined(own: Column) -> Column:
        digits = F.ceil(F.log2(F.greatest(F.size(own), F.lit(1)))).cast("int")
        shifts = F.transform(F.sequence(F.lit(0), digits), lambda d: F.pow(F.lit(2), d).cast("int"))
        return F.aggregate(shifts, own, lambda so_far, shift: F.transform(
            so_far, lambda x, i: F.when(i >= shift, join(x, F.get(so_far, i - shift))).otherwise(x)
        ))

    return _bound(values, joined)


def _found(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule's matches as structs (first, kind, last), in code points."""
    cut = F.split(F.regexp_replace(text, f"({rule.pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    empty = F.expr("cast(array() as array<struct<first:int,kind:int,last:int>>)")

    def spans(parts: Column) -> Column:
        def of(ends: Column) -> Column:
            def span(part: Column, i: Column) -> Column:
                own = F.regexp_extract(part, rule.pattern, rule.group) if rule.group else part
                good = (i % 2 == 1) & (F.length(own) >= rule.least)
                return F.when(good, F.struct(
                    F.get(ends, i - 1).alias("first"), F.lit(order).alias("kind"), F.get(ends, i).alias("last")
                ))

            return F.array_compact(F.transform(parts, span))

        return _bound(_running(F.transform(parts, F.length), lambda x, y: x + y), of)

    return F.when(text.rlike(rule.pattern), _bound(cut, spans)).otherwise(empty)


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string")
            ),
        ),
        ",",
    )


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``_row`` (a struct of the columns of ``docs``) and ``_spans`` of all rules.

    Spans are structs (first, kind, last) in code points.
    """
    marked = docs.select(
        F.struct(*docs.columns).alias("_row"), "doc_id", text_or_empty().alias("_text")
    ).withColumn("print", F.xxhash64("_text"))
    # Written first, so that Spark sees its size: few candidates go to the texts, not texts to them.
    hits = stored(candidates(marked, rules))
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.print") == F.col("c.print"))
    joined = marked.alias("d").join(hits.alias("c"), same, "left").select("d.*", "c.kinds")
    clear = F.when(
        F.contains("_text", F.lit(_MARK)), F.translate("_text", _MARK, _STAND_IN)
    ).otherwise(F.col("_text"))
    ready = joined.withColumn("_text", clear)
    empty = F.expr("cast(array() as array<struct<first:int,kind:int,last:int>>)")
    found = []
    for order, rule in enumerate(rules):
        spans = _found(F.col("_text"), rule, order)
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(empty)
        found.append(spans)
    return ready.select("_row", F.concat(*found).alias("_spans"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for each row of ``docs``.

    A null text is empty and holds nothing; its digest is that of the empty string.
    Repeated rows and rows without doc_id each give a row. Matches of one kind never
    overlap; those of different kinds may. Extra columns are ignored; an empty table gives
    no rows.
    """
    n_base = len(BASE_RULES)
    spans = with_spans(docs.select("doc_id", "text"), rules)
    base = F.filter("_spans", lambda s: s["kind"] < n_base)

    def n_of(order: int) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == order)).cast("long")

    counts = [n_of(order).alias(f"n_{rule.kind}") for order, rule in enumerate(BASE_RULES)]
    return spans.select(
        "_row.doc_id", *counts, F.sha2(_listed(base, rules).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_spans"), rules).alias("spans"),
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each found span replaced by a mark, overlapping ones by one mark.

    A text without secrets stays as it is, null included; ``n_chars`` follows the text.
    """
    spans = with_spans(docs, rules)
    old = F.col("_row.text")

    def between(chunks: Column, first: Column, last: Column) -> Column:
        def part(c: Column) -> Column:
            skipped = F.greatest(first - c * _CHUNK, F.lit(0))
            return F.substr(F.get(chunks, c), skipped + 1, F.least(last - c * _CHUNK, F.lit(_CHUNK)) - skipped)

        touched = F.sequence(*(F.floor(at / _CHUNK).cast("int") for at in (first, last - 1)))
        return F.when(last > first, F.array_join(F.transform(touched, part), "")).otherwise(F.lit(""))

    def marked(both: Column) -> Column:
        # A span that begins inside an earlier one only moves its end.
        def piece(span: Column, i: Column) -> Column:
            so_far = F.when(i > 0, F.get(both["reach"], i - 1)).otherwise(F.lit(0))
            kept = F.concat(between(both["chunks"], so_far, span["first"]), F.lit(_REDACTED))
            return F.when(span["first"] >= so_far, kept).otherwise(F.lit(""))

        pieces = F.array_join(F.transform(both["spans"], piece), "")
        return F.concat(pieces, between(both["chunks"], F.array_max(both["reach"]), F.length(old)))

    def with_reach(ordered: Column) -> Column:
        return F.struct(
            ordered.alias("spans"), _running(F.transform(ordered, lambda s: s["last"]), F.greatest).alias("reach"),
            F.regexp_extract_all(old, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)).alias("chunks"),
        )

    changed = F.size("_spans") > 0
    text = F.when(changed, _bound(_bound(F.array_sort("_spans"), with_reach), marked)).otherwise(old)
    out = spans.select("_row", text.alias("_new"), changed.alias("_changed"))
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns} | {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        length = F.length("_new").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("_changed"), length).otherwise(columns["n_chars"])
    return out.select(*(c.alias(name) for name, c in columns.items()))


def _oracle() -> str:
    """The registered query in SQL: matches are marked, and lengths before them added up."""
    mark = "chr(64976)"
    kinds, spans = [], []
    for order, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        long_enough = (
            f"length(regexp_extract(p[i], '{pattern}', {rule.group})) >= {rule.least}"
            if rule.group
            else f"length(p[i]) >= {rule.least}"
        )
        kinds.append(
            f"string_split(regexp_replace(t, '({pattern})', {mark} || '\\1' || {mark}, 'g'), {mark}) AS p{order}"
        )
        spans.append(
            f"list_transform(list_filter(range(2, len(p{order}) + 1, 2), lambda i: "
            f"{long_enough.replace('p[i]', f'p{order}[i]')}), lambda i: {{"
            f"'first': coalesce(list_sum(list_transform(p{order}[1:i - 1], lambda x: length(x))), 0)::BIGINT, "
            f"'kind': {order}, "
            f"'last': list_sum(list_transform(p{order}[1:i], lambda x: length(x)))::BIGINT}})"
        )
    names = ", ".join(f"'{r.kind}'" for r in RULES)
    shown = (
        f"array_to_string(list_transform({{}}, lambda s: [{names}][s.kind + 1] || ':' || s.first || ':' || s.last), ',')"
    )
    n_base = len(BASE_RULES)
    counts = ", ".join(
        f"len(list_filter(spans, lambda s: s.kind = {order})) AS n_{rule.kind}"
        for order, rule in enumerate(BASE_RULES)
    )
    return f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), {mark}, chr(64977)) AS t FROM documents
), cut AS (
  SELECT doc_id, {", ".join(kinds)} FROM texts
), found AS (
  SELECT doc_id, list_sort({" || ".join(f"({s})" for s in spans)}) AS spans FROM cut
)
SELECT doc_id, {counts},
       sha256({shown.format(f"list_filter(spans, lambda s: s.kind < {n_base})")}) AS base_sha256,
       {shown.format("spans")} AS spans
FROM found
"""


ORACLE = _oracle()
