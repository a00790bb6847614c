"""Quality rules per document, and verdicts per host from shrunk failure rates.

All in DataFrame functions. Each document is measured once; failures are summed by host
(partial sums, so a host with a third of all rows is no burden), and each host's rate of
failing a rule is shrunk towards the rate of all hosts by a beta prior whose strength is
taken from how much the hosts differ. A host whose shrunk rate of any rule is above
``HOST_LIMIT`` is rejected with all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelane.llm.common import stored, text_or_empty

LEAST_WORDS = 50
HOST_LIMIT = 0.6
#: Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0

#: Rule failures beyond the base rules only count towards the host.
RULES = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of each text."""
    texts = docs.select("doc_id", F.col(host).alias("host"), text_or_empty().alias("text"))
    split = texts.withColumn(
        "words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    ).withColumn("lines", _lines(F.col("text")))
    n = F.size("words")
    words = F.col("words")
    numbered = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )
    joined = F.array_join("words", "")
    counted = split.select(
        "doc_id", "host", n.cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        (F.length(joined) - F.length(F.regexp_replace(joined, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.array_sort(numbered)).alias("windows"),
    )
    windows = F.col("windows")
    # Equal windows are neighbours once sorted by hash.
    twice = F.filter(
        windows,
        lambda w, k: (F.coalesce(F.get(windows, k - 1)["h"] == w["h"], F.lit(False)))
        | (F.coalesce(F.get(windows, k + 1)["h"] == w["h"], F.lit(False))),
    )
    places = F.array_sort(F.transform(twice, lambda w: w["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    covered = F.aggregate(
        places,
        start,
        lambda s, p: F.struct(
            p.alias("last"), (s["total"] + F.least(F.lit(3), p - s["last"])).alias("total")
        ),
        lambda s: s["total"],
    )
    return counted.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("windows")


def host_verdicts(rows: DataFrame) -> DataFrame:
    """host, n and whether it is rejected, from the failures of its documents.

    With rate p of all hosts' mean and variance v, the prior weighs p(1-p)/v - 1
    documents, within the bounds above; hosts that do not differ are shrunk most.
    """
    failures = [F.sum(F.expr(f"cast({rule} as long)")).alias(name) for name, rule in RULES.items()]
    hosts = stored(rows.groupBy("host").agg(F.count("*").alias("n"), *failures))
    rates = {name: F.col(name) / F.col("n") for name in RULES}
    prior = hosts.agg(
        *(F.avg(rate).alias(f"m_{name}") for name, rate in rates.items()),
        *(F.var_pop(rate).alias(f"v_{name}") for name, rate in rates.items()),
    ).first()
    bad = F.lit(False)
    for name in RULES:
        mean, spread = prior[f"m_{name}"] or 0.0, prior[f"v_{name}"] or 0.0
        weight = mean * (1 - mean) / spread - 1 if spread > 0 else MOST_WEIGHT
        weight = min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)
        bad = bad | ((F.col(name) + mean * weight) / (F.col("n") + weight) > HOST_LIMIT)
    return hosts.select("host", "n", bad.alias("host_failed"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed, host_failed and kept for each row of ``docs``.

    A null or empty text has no words and fails; documents without host are one host.
    Repeated rows count each. Extra columns are ignored; an empty table gives no rows.
    """
    rows = stored(measured(docs, host))
    verdicts = host_verdicts(rows)
    joined = rows.alias("r").join(
        verdicts.alias("v"), F.col("r.host").eqNullSafe(F.col("v.host")), "left"
    )
    failed = F.expr(f"{RULES['few_words']} or {RULES['repeats']}")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("v.host_failed").alias("host_failed"),
        (~failed & ~F.col("v.host_failed")).alias("kept"),
    )


#: The registered query in SQL.
ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT n, doc_id, host, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), places AS (
  SELECT n, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3
), windows AS (
  SELECT n, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places
), often AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS k FROM windows) WHERE k >= 2
), covered AS (
  SELECT n, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT n, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY n
), measures AS (
  SELECT s.doc_id, s.host, len(words) AS n_words,
         len(array_to_string(words, '')) AS word_chars,
         len(array_to_string(words, ''))
           - len(regexp_replace(array_to_string(words, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.n = c.n
), failures AS (
  SELECT *, n_words < 50 AS few_words, 100 * n_repeat_words > 50 * n_words AS repeats,
         10 * n_symbols > word_chars AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup_lines
  FROM measures
), hosts AS (
  SELECT host, count(*) AS n, rule, sum(failed::INT) AS k
  FROM (
    SELECT host, unnest(['few_words', 'repeats', 'symbols', 'dup_lines']) AS rule,
           unnest([few_words, repeats, symbols, dup_lines]) AS failed
    FROM failures
  ) GROUP BY host, rule
), priors AS (
  SELECT rule, avg(k / n) AS m, var_pop(k / n) AS v FROM hosts GROUP BY rule
), weights AS (
  SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000 END, 2), 1000) AS w
  FROM priors
), verdicts AS (
  SELECT host, bool_or((k + m * w) / (n + w) > 0.6) AS host_failed
  FROM hosts JOIN weights USING (rule) GROUP BY host
)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words,
       (few_words OR repeats) AS base_failed, v.host_failed,
       NOT (few_words OR repeats) AND NOT v.host_failed AS kept
FROM failures f JOIN verdicts v ON f.host IS NOT DISTINCT FROM v.host
"""
