"""Encoding and decoding with a SentencePiece vocabulary of merge type.

A text's symbols start as its characters. An agenda holds the adjacent pairs that make a
piece of the vocabulary, best score first and leftmost first among equals; the top pair
is merged and its new neighbours enter the agenda, until none is left.

No merge can span a border between two characters that no piece has side by side, so a
text is cut there, and each distinct chunk goes through its agenda once for each Python
worker. The new chunks of each Arrow batch are checked against the library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.llm import common, tokens

#: The character that stands for a space, in texts and pieces.
SPACE = "▁"
#: Chunks, and characters of chunks, that one Python worker remembers.
CACHE_CHUNKS, CACHE_CHARACTERS = 500_000, 8_000_000


class Agenda:
    """The pieces of a vocabulary with their scores, and merging by them."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = len(self.library)
        if any(self.library.is_unused(i) for i in range(size)):
            raise ValueError(f"{path} has unused pieces, which an agenda would have to undo")
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(self.library.is_byte(i) for i in self.bytes):
            raise ValueError(f"{path} has no piece for each byte")
        special = {self.library.unk_id(), *self.bytes}
        plain = [i for i in range(size) if i not in special and not self.library.is_control(i)]
        self.ids = {self.library.id_to_piece(i): i for i in plain}
        self.scores = {piece: self.library.get_score(i) for piece, i in self.ids.items()}
        self._borders()
        self.clear()

    def _borders(self) -> None:
        """Which characters any piece has side by side."""
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        characters = sorted({c for pair in pairs for c in pair})
        number = {c: i + 1 for i, c in enumerate(characters)}
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.beside = np.zeros((len(characters) + 1,) * 2, bool)
        for pair in pairs:
            self.beside[number[pair[0]], number[pair[1]]] = True
        # A character that joins with nothing keeps the library from adding to a chunk.
        self.guard = next(c for c in map(chr, range(0x0A, 0x80)) if c not in number)
        self.guard_ids = self.library.encode(self.guard)

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.first = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.unlike = np.empty(0, bool)
        self.flat = np.empty(0, np.int32)

    def merged(self, chunk: str) -> list[str]:
        """The pieces that are left of a chunk when its agenda is empty."""
        parts: list[str | None] = list(chunk)
        before = list(range(-1, len(parts) - 1))
        after = [*range(1, len(parts)), -1]
        scores = self.scores
        agenda = []

        def offered(left: int, right: int) -> tuple | None:
            pair = parts[left] + parts[right]
            score = scores.get(pair)
            return None if score is None else (-score, left, right, len(pair))

        for left in range(len(parts) - 1):
            if (entry := offered(left, left + 1)) is not None:
                agenda.append(entry)
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            one, other = parts[left], parts[right]
            # One of the two has been merged with something else meanwhile.
            if one is None or other is None or len(one) + len(other) != size:
                continue
            parts[left], parts[right] = one + other, None
            beyond = after[left] = after[right]
            if beyond >= 0:
                before[beyond] = left
                if (entry := offered(left, beyond)) is not None:
                    heapq.heappush(agenda, entry)
            if before[left] >= 0 and (entry := offered(before[left], left)) is not None:
                heapq.heappush(agenda, entry)
        return [part for part in parts if part is not None]

    def chunk_ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        for piece in self.merged(chunk):
            number = self.ids.get(piece)
            if number is None:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(number)
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks, and check them against the library."""
        size = sum(map(len, chunks))
        if self.known and (
            len(self.known) + len(chunks) > CACHE_CHUNKS or self.characters + size > CACHE_CHARACTERS
        ):
            raise _Full
        made = [self.chunk_ids(chunk) for chunk in chunks]
        guarded = [self.guard + chunk.replace(SPACE, " ") for chunk in chunks]
        skip = len(self.guard_ids)
        told = [ids[skip:] for ids in self.library.encode(guarded, num_threads=1)]
        unlike = [own != other for own, other in zip(made, told)]
        # Where they differ the library says what is right.
        made = [other if bad else own for own, other, bad in zip(made, told, unlike)]
        counts = np.fromiter(map(len, made), np.int64, len(made))
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.characters += size
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.unlike = np.concatenate([self.unlike, np.array(unlike, bool)])
        new = np.fromiter((i for ids in made for i in ids), np.int32, int(counts.sum()))
        self.flat = np.concatenate([self.flat, new])

    def chunks(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The chunks of texts, end to end, and the number for each text."""
        marked = [SPACE + text.replace(" ", SPACE) if text else "" for text in texts]
        line = "".join(marked)
        kind = self.kind[np.frombuffer(line.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
        cut = np.ones(len(line) + 1, bool)
        cut[1:-1] = ~self.beside[kind[:-1], kind[1:]]
        cut[ends] = True
        cuts = np.flatnonzero(cut)
        numbers = np.diff(np.searchsorted(cuts, ends), prepend=0)
        places = cuts.tolist()
        return [line[a:b] for a, b in zip(places, places[1:])], numbers

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts, end to end; their number, and the unlike chunks, for each text."""
        chunks, numbers = self.chunks(texts)
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if new:
            try:
                self._learn(new)
            except _Full:
                self.clear()
                self._learn(list(dict.fromkeys(chunks)))
        codes = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        counts = self.count[codes]
        flat = self.flat[tokens.ragged(self.first[codes], counts)]
        text = np.repeat(np.arange(len(texts)), numbers)
        per_text = np.bincount(text, counts, len(texts)).astype(np.int64)
        unlike = np.bincount(text, self.unlike[codes], len(texts)).astype(np.int64)
        return flat, per_text, unlike

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


class _Full(Exception):
    """The remembered chunks and the new ones are too many."""


_agendas: dict[str, Agenda] = {}


def agenda(path: str) -> Agenda:
    """One for each vocabulary and Python worker."""
    return _agendas.get(path) or _agendas.setdefault(path, Agenda(path))


def _ranges(batch: pa.RecordBatch, flat: np.ndarray, counts: np.ndarray) -> list[list[int]]:
    ends = np.cumsum(counts)
    return [flat[a:b].tolist() for a, b in zip((ends - counts).tolist(), ends.tolist())]


def _encoded(docs: DataFrame, path: str, back: bool) -> DataFrame:
    common.shipped(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = agenda(path)

        def rows(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            flat, counts, unlike = pieces.encode(texts)
            columns = {
                "doc_id": batch.column("doc_id"),
                "ids": tokens.lists(flat, counts, pa.int32()),
                "n_unlike": pa.array(unlike),
            }
            if back:
                decoded = pieces.decode(_ranges(batch, flat, counts))
                columns["decoded"] = pa.array(decoded, pa.string())
            return pa.record_batch(list(columns.values()), list(columns))

        yield from common.by_row_slices(batches, "text", rows)

    schema = "doc_id long, ids array<int>, n_unlike long" + (", decoded string" if back else "")
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and n_unlike for each row of ``docs``, without begin and end ids.

    ``n_unlike`` tells in how many chunks of the text the agenda and the library differ,
    where the ids are the library's; it is 0 for a vocabulary of merge type. A null or
    empty text has no ids. Repeated rows are encoded each, extra columns are ignored, an
    empty table gives no rows. ``path`` names a model with a piece for each byte that
    each executor can open.
    """
    return _encoded(docs, path, back=False)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The same, with the text that the ids decode to in ``decoded``."""
    return _encoded(docs, path, back=True)


def decoded(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids; null or no ids give an empty text."""
    common.shipped(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = agenda(path)
        for batch in batches:
            texts = pieces.decode([ids or [] for ids in batch.column("ids").to_pylist()])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    listed = rows.select("doc_id", F.col(ids).cast("array<int>").alias("ids"))
    return listed.mapInArrow(work, "doc_id long, text string")


def digests(trips: DataFrame) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and n_unlike."""
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return trips.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "n_unlike",
    )
