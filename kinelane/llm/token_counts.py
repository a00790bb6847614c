"""Token counts by merging ragged arrays of symbols, lowest rank first, all at once.

The distinct pieces of a batch are held as one array of symbols with the piece of each.
In every round each piece finds its adjacent pair of lowest rank and merges all its
occurrences, for all pieces together; pieces without a mergeable pair rest. What is left
are the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinelane.llm import common, tokens

LIMIT = 1024
_NONE = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Bytes that print stand for themselves; the others take U+0100 and up, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merger:
    """The merges of a vocabulary file, as sorted pair keys with rank and result."""

    def __init__(self, path: str):
        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        ids = model["vocab"]
        self.size = np.int64(max(ids.values()) + 1)
        self.byte_ids = np.array([ids[c] for c in byte_characters()], np.int64)
        self.by_character = {c: ids[c] for c in byte_characters()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * int(self.size) + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]

    def merge(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all sequences, end to end, and how many each has."""
        counts = counts.copy()
        owner = np.repeat(np.arange(len(counts)), counts)
        done_symbols, done_owner = [], []
        while len(symbols):
            at = np.full(len(symbols), -1)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            pair = symbols[inside] * self.size + symbols[inside + 1]
            found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            hit = self.keys[found] == pair
            at[inside[hit]] = found[hit]
            rank = np.where(at >= 0, self.ranks[at], _NONE)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            least_here = np.repeat(least, sizes)
            rest = least_here == _NONE
            chosen = (rank == least_here) & ~rest
            # Of overlapping equal pairs (a a a) every second one counts, from the left.
            follows = chosen.copy()
            follows[0] = False
            follows[1:] &= chosen[:-1]
            if follows.any():
                place = np.arange(len(chosen))
                begin = np.maximum.accumulate(np.where(chosen & ~follows, place, 0))
                chosen &= (place - begin) % 2 == 0
            left = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[left] = self.made[at[left]]
            gone = np.zeros(len(symbols), bool)
            gone[left + 1] = True
            done_symbols.append(symbols[rest])
            done_owner.append(owner[rest])
            stay = ~rest & ~gone
            symbols, owner = symbols[stay], owner[stay]
        if not done_symbols:
            return symbols, np.zeros(len(counts), np.int64)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(counts)).astype(np.int64)


class Counter(tokens.Encoder):
    """Encodes by merging; the library only names its special tokens and odd pieces."""

    def __init__(self, path: str):
        self.merger = Merger(path)
        super().__init__(path, True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}

    def _pieces(self, texts: list[str]) -> list[np.ndarray]:
        data, offsets = common.utf8(pa.array(texts, pa.large_string()))
        flat, counts = self.merger.merge(self.merger.byte_ids[data], np.diff(offsets))
        return np.split(flat.astype(np.uint32), np.cumsum(counts)[:-1])

    def _whole(self, text: str) -> np.ndarray:
        """A text with characters or special tokens that the byte rules do not cover."""
        parts = [(text, None)]
        for word, number in self.special.items():
            cut = []
            for part, own in parts:
                pieces = [part] if own is not None else part.split(word)
                for place, piece in enumerate(pieces):
                    if place:
                        cut.append((word, number))
                    cut.append((piece, own))
            parts = cut
        out: list[np.ndarray] = []
        for part, number in parts:
            if number is not None:
                out.append(np.array([number], np.uint32))
            elif part:
                pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
                symbols = np.array([self.merger.by_character[c] for p in pieces for c in p], np.int64)
                sizes = np.array([len(p) for p in pieces], np.int64)
                out.append(self.merger.merge(symbols, sizes)[0].astype(np.uint32))
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [self._whole(text) for text in texts]

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.cache.encode = self._pieces
        return super().ids(data, offsets)


_counters: dict[str, Counter] = {}


def counted(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    A null or empty text has no tokens. Repeated rows are counted each, extra columns are
    ignored, an empty table gives no rows. ``path`` names a byte-level vocabulary file
    that each executor can open.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(path) or _counters.setdefault(path, Counter(path))

        def rows(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            n = counter.ids(data, offsets)[1]
            return pa.record_batch(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        yield from common.by_row_slices(batches, "text", rows)

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
