"""URL rules in a sorted array of digests.

Rules are kept as a sorted array of 64-bit xxhash keys beside their strings, in files that
Spark sends to each executor once and Python maps into memory. For each url the possible
rules (each parent domain with each length of path that some rule has) are hashed and
looked up by one binary search for all; where digests agree the whole strings are
compared, so a collision cannot give a verdict.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules that one set of files may hold (about 60 bytes each on each executor).
MOST_RULES = 50_000_000
DEFAULT_VERDICT = "allow"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, and the paths that begin like this."""

    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host(url: str = "url") -> Column:
    """What is between ``://`` and the path, with A-Z in lower case; else empty."""
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path(url: str = "url") -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def digests(keys: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode()) for k in keys), np.uint64)


class Digests:
    """The mapped files: sorted keys, the strings in that order, verdicts."""

    PARTS = ("keys", "ends", "strings", "verdicts", "paths")

    def __init__(self, name: str, at=SparkFiles.get):
        self.keys = self._mapped(at(f"{name}.keys"), np.uint64)
        self.ends = self._mapped(at(f"{name}.ends"), np.int64)
        self.strings = self._mapped(at(f"{name}.strings"), np.uint8)
        self.blocks = self._mapped(at(f"{name}.verdicts"), np.uint8)
        self.path_lengths = self._mapped(at(f"{name}.paths"), np.int64)

    @staticmethod
    def _mapped(file: str, kind) -> np.ndarray:
        # An empty file cannot be mapped.
        return np.memmap(file, kind, "r") if os.path.getsize(file) else np.empty(0, kind)

    def string(self, place: int) -> str:
        first = self.ends[place - 1] if place else 0
        return self.strings[first : self.ends[place]].tobytes().decode()

    def find(self, keys: list[str]) -> list[int]:
        """The place of each key, or -1; digests alone decide nothing."""
        wanted = digests(keys)
        at = np.searchsorted(self.keys, wanted, "left")
        out = np.full(len(keys), -1)
        inside = np.flatnonzero(at < len(self.keys))
        for place in inside[self.keys[at[inside]] == wanted[inside]].tolist():
            here = int(at[place])
            while here < len(self.keys) and self.keys[here] == wanted[place]:
                if self.string(here) == keys[place]:
                    out[place] = here
                    break
                here += 1
        return out.tolist()


def write_digests(rules: Iterable[Rule], folder: str, name: str) -> None:
    """The files for ``rules``; of equal rules a block wins."""
    verdicts: dict[str, bool] = {}
    for rule in rules:
        key = f"{rule.host.lower()}{rule.path}"
        verdicts[key] = verdicts.get(key, False) or rule.verdict == "block"
    if len(verdicts) > MOST_RULES:
        raise ValueError(f"{len(verdicts)} rules; split them into lists of {MOST_RULES}")
    keys = list(verdicts)
    values = digests(keys)
    order = np.argsort(values, kind="stable")
    ordered = [keys[i].encode() for i in order]
    parts = {
        "keys": values[order], "ends": np.cumsum([len(k) for k in ordered], dtype=np.int64),
        "strings": np.frombuffer(b"".join(ordered), np.uint8),
        "verdicts": np.array([verdicts[keys[i]] for i in order], np.uint8),
        "paths": np.array(sorted({len(r.path) for r in rules}), np.int64),
    }
    for part, array in parts.items():
        array.tofile(f"{folder}/{name}.{part}")


def _shipped(spark: SparkSession, rules: Iterable[Rule]) -> str:
    """Write the files and let Spark send them to all executors; their common name."""
    name, folder = f"rules-{uuid.uuid4()}", tempfile.mkdtemp(prefix="rules-")
    write_digests(rules, folder, name)
    for part in Digests.PARTS:
        spark.sparkContext.addFile(f"{folder}/{name}.{part}")
    return name


def _options(host_: str, path_: str, lengths: list[int]) -> list[str]:
    """Keys of all rules that would fit, the longest first."""
    found = []
    rest = host_
    while True:
        found += [rest + path_[:n] for n in lengths if n <= len(path_)]
        _label, dot, rest = rest.partition(".")
        if not dot:
            return sorted(set(found), key=lambda k: (-len(k), k))


def judge(
    pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = DEFAULT_VERDICT
) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages``.

    A null url, or one without ``://``, has an empty host and path; no rule with a host
    fits it and it gets the default. Of the rules that fit, the longest wins. Repeated
    rows are judged alike, extra columns are ignored, an empty table gives no rows.
    """
    rules = list(rules)
    name = _shipped(pages.sparkSession, rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Digests(name)
        lengths = table.path_lengths.tolist()
        for batch in batches:
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            options = [_options(h, p, lengths) if h else [] for h, p in zip(hosts, paths)]
            flat = [key for own in options for key in own]
            distinct = list(dict.fromkeys(flat))
            place = dict(zip(distinct, table.find(distinct)))
            ruled, verdict = [], []
            for own in options:
                hit = next((k for k in own if place[k] >= 0), None)
                ruled.append(hit)
                verdict.append(
                    default if hit is None else "block" if table.blocks[place[hit]] else "allow"
                )
            yield pa.record_batch(
                [*(batch.column(c) for c in ("page_id", "host", "path")),
                 pa.array(ruled, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return pages.select("page_id", host().alias("host"), path().alias("path")).mapInArrow(
        work, "page_id long, host string, path string, rule string, verdict string"
    )


#: The registered query in SQL.
ORACLE = """
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS n
  FROM pages
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT p.n, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS place
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.n = f.n AND f.place = 1
"""
