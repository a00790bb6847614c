"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

Both vocabularies cut a text into pieces (a word with its space, a run of digits, of
punctuation, of white space) and encode each piece by itself. Texts of ASCII and Latin
letters are cut with numpy on their bytes; a piece that was met before is looked up by
its 64-bit hash and compared byte by byte, and only new ones go through the library. Any other text, and one that
may hold a special token, goes through the library whole. The ids are the same.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from kinelane.llm import common

#: Pieces that one Python worker remembers, about 45 bytes each; beyond that it starts anew.
CACHE_PIECES = 1_500_000
#: Pieces of one size up to this have one hash only if they are the same.
PROVEN = 8

SPACE, LETTER, DIGIT, OTHER, UNKNOWN = 0, 1, 2, 3, 4

_KIND = np.full(256, UNKNOWN, np.uint8)
_KIND[0:128] = OTHER
_KIND[0x1C:0x20] = UNKNOWN
_KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KIND[0x30:0x3A] = DIGIT
#: Lead bytes of U+00C0 to U+017F and what may follow them: all letters but two signs.
#: U+0130 is left out too, as its lower case is two characters.
_KIND[0xC3:0xC6] = LETTER
_KIND[0x80:0xC0] = LETTER


def kinds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and which texts hold anything that is not surely known."""
    kind = _KIND[data]
    odd = kind == UNKNOWN
    high = data >= 0x80
    if high.any():
        trail = (data >= 0x80) & (data < 0xC0)
        lead = (data >= 0xC3) & (data <= 0xC5)
        before = np.zeros(len(data), bool)
        before[1:] = lead[:-1]
        odd |= trail & ~before
        sign = np.zeros(len(data), bool)
        sign[1:] = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        sign[1:] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)
        odd |= sign
    special = np.zeros(len(data), bool)
    special[:-1] = (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    total = np.concatenate([[0], np.cumsum(odd | special)])
    return kind, total[offsets[1:]] > total[offsets[:-1]]


_APOSTROPHE = ord("'")
_ONE = np.zeros(256, bool)
_ONE[[ord(c) for c in "stmd"]] = True


def _contractions(
    data: np.ndarray, kind: np.ndarray, start: np.ndarray, offsets: np.ndarray, spaced: bool
) -> None:
    """Move the starts behind 's 't 'm 'd 're 've 'll, where ' begins a piece."""
    at = np.flatnonzero((data[:-1] == _APOSTROPHE) & (kind[1:] == LETTER)) if len(data) > 1 else []
    if not len(at):
        return
    ends = offsets[np.searchsorted(offsets, at, "right")]
    for p, end in zip(at.tolist(), ends.tolist()):
        if not start[p] or not start[p + 1] or p + 1 >= end:
            continue
        if spaced and data[p] != _APOSTROPHE:
            continue
        two = bytes(data[p + 1 : min(p + 3, end)])
        size = 1 if _ONE[two[0]] else 2 if two in (b"re", b"ve", b"ll") else 0
        if size:
            start[p + 1] = False
            if p + 1 + size < end:
                start[p + 1 + size] = True


def spaced_pieces(
    data: np.ndarray, kind: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the pieces where a space belongs to what follows it."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[offsets] = True
    start[n] = True
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    # The last white space before something else: a space joins it, others stand alone.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~border[1:n]) if n > 1 else np.empty(0, int)
    start[last] = True
    start[last[data[last] == 0x20] + 1] = False
    _contractions(data, kind, start, offsets, True)
    cuts = np.flatnonzero(start)
    return cuts[:-1], cuts[1:]


def bare_pieces(
    data: np.ndarray, kind: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the pieces where white space is dropped and digits stand alone."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    start[offsets] = True
    start[n] = True
    _contractions(common.lowered(data), kind, start, offsets, False)
    cuts = np.flatnonzero(start)
    if not n:
        return cuts[:0], cuts[:0]
    inside = kind[cuts[:-1]] != SPACE
    return cuts[:-1][inside], cuts[1:][inside]


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places first, first + 1, ... of each range, end to end."""
    before = np.cumsum(counts) - counts
    return np.repeat(first - before, counts) + np.arange(int(counts.sum()))


class PieceCache:
    """What each distinct piece was encoded to, by hash."""

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.code = np.empty(0, np.int32)
        self.first = np.empty(0, np.int32)
        self.count = np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint32)
        self.bytes = np.empty(0, np.uint8)
        self.begin = np.empty(0, np.int32)
        self.size = np.empty(0, np.int32)

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Codes of pieces that are encoded now, with their bytes."""
        raw = data.tobytes()
        made = self.encode([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())])
        counts = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter(chain.from_iterable(made), np.uint32, int(counts.sum()))
        code = len(self.count) + np.arange(len(made))
        sizes = ends - starts

        def grown(old: np.ndarray, new: np.ndarray) -> np.ndarray:
            return np.concatenate([old, new.astype(old.dtype)])

        self.begin = grown(self.begin, len(self.bytes) + np.cumsum(sizes) - sizes)
        self.size = grown(self.size, sizes)
        self.bytes = grown(self.bytes, data[ragged(starts, sizes)])
        self.first = grown(self.first, len(self.flat) + np.cumsum(counts) - counts)
        self.count = grown(self.count, counts)
        self.flat = grown(self.flat, flat)
        return code

    def codes(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """A code for each piece, after encoding the new ones."""
        hashes = common.range_hashes(data, starts, ends)
        distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        if not known.all():
            if len(self.hashes) + len(distinct) > CACHE_PIECES and len(self.hashes):
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            code = self._add(data, starts[example[new]], ends[example[new]])
            place = np.searchsorted(self.hashes, distinct[new])
            self.hashes = np.insert(self.hashes, place, distinct[new])
            self.code = np.insert(self.code, place, code)
            at = np.searchsorted(self.hashes, distinct)
        codes = self.code[at][inverse]
        # Longer pieces of one hash need not be one: each is held against the bytes remembered.
        sizes = ends - starts
        same = self.size[codes] == sizes
        alike = np.flatnonzero(same & (sizes > PROVEN))
        same[alike] = common.same_ranges(
            data, starts[alike], sizes[alike], self.bytes, self.begin[codes[alike]]
        )
        others = np.flatnonzero(~same)
        if len(others):
            codes[others] = self._add(data, starts[others], ends[others])
        return codes


class Encoder:
    """Ids of whole texts; ``spaced`` as the vocabulary's way to cut pieces."""

    def __init__(self, path: str, spaced: bool):
        # Tasks run side by side already; threads within one only cost.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = spaced_pieces if spaced else bare_pieces
        self.cache = PieceCache(self._encoded)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        out = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in out]

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, end to end, and their number for each text."""
        rows = len(offsets) - 1
        kind, odd = kinds(data, offsets)
        starts, ends = self.pieces(data, kind, offsets)
        row = np.searchsorted(offsets, starts, "right") - 1
        if odd.any():
            keep = ~odd[row]
            starts, ends, row = starts[keep], ends[keep], row[keep]
        codes = self.cache.codes(data, starts, ends)
        counts = self.cache.count[codes].astype(np.int64)
        flat = self.cache.flat[ragged(self.cache.first[codes], counts)]
        per_row = np.bincount(row, counts, minlength=rows).astype(np.int64)
        if not odd.any():
            return flat, per_row
        at = np.concatenate([[0], np.cumsum(per_row)])
        which = np.flatnonzero(odd)
        whole = self._encoded([
            data[offsets[r] : offsets[r + 1]].tobytes().decode() for r in which
        ])
        by_row = {r: np.array(ids, np.uint32) for r, ids in zip(which.tolist(), whole)}
        parts = [by_row.get(r, flat[at[r] : at[r + 1]]) for r in range(rows)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]


def forget() -> None:
    """Give back the memory of the encoders, in steps that no longer need them."""
    _encoders.clear()


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
