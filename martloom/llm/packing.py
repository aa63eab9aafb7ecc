"""Packing of tokenized documents into windows by Karmarkar-Karp multiway differencing.

A document's whole windows are sequences of their own. Remainders are gathered into groups that fill a fixed number of
windows. Each remainder is a partial partition: one sum per window, all but one of them zero. The two partitions that
differ most within themselves are merged, the largest sums of one with the smallest of the other, until one partition is
left; its windows are nearly equal. What still exceeds a window's capacity is cut off and fills windows with room.

A task packs its own documents as they stream by, so nothing is shuffled and only one group is held.
"""

from __future__ import annotations

import gc
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.ngram_join import slices
from martloom.llm.shared import release
from martloom.llm.token_records import ENCODED_BYTES, _encoder

#: Windows that a group of remainders fills.
GROUP = 64
#: Tokens of one Arrow batch that leaves a task.
BATCH_TOKENS = 1 << 20

_PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def differenced(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size: partial partitions merged by multiway differencing until one is left."""
    sums = [np.zeros(windows, dtype=np.int64) for _ in sizes]
    for own, size in zip(sums, sizes, strict=True):
        own[0] = size
    heap = [(-size, i, own) for i, (size, own) in enumerate(zip(sizes, sums, strict=True))]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, i, a), (_, j, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = a + b[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order] - both[order[-1]]
        merges.append((i, j, order))
        heapq.heappush(heap, (-int(both[0]), len(sizes) + len(merges) - 1, both))
    # From the last merge back: which window each place of a partial partition has become.
    window: list[np.ndarray] = [np.arange(windows)] * (len(sizes) + len(merges))
    for at in range(len(merges) - 1, -1, -1):
        i, j, order = merges[at]
        place = np.empty(windows, dtype=np.int64)
        place[order] = window[len(sizes) + at]
        window[i], window[j] = place, place[::-1]
    return np.array([window[i][0] for i in range(len(sizes))], dtype=np.int64)


def whole_windows(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of each size, nothing cut: the number of windows rises as long as one exceeds its capacity."""
    if any(s > capacity for s in sizes):
        raise ValueError("a size exceeds the capacity")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place = differenced(sizes, windows)
        if not len(sizes) or np.bincount(place, weights=sizes).max() <= capacity:
            return place
        windows += 1


@dataclass
class Piece:
    """Ids start to end of a document of `doc` = (its id, all its ids)."""

    doc: tuple[int | None, np.ndarray]
    start: int
    end: int

    @property
    def size(self) -> int:
        return self.end - self.start

    def cut(self, size: int) -> Piece:
        """The last `size` ids as a piece of their own."""
        self.end -= size
        return Piece(self.doc, self.end, self.end + size)


def filled(pieces: list[Piece], windows: int, capacity: int) -> list[list[Piece]]:
    """Pieces in windows by differencing; ids beyond a window's capacity are cut off its longest piece and go where there is room."""
    out: list[list[Piece]] = [[] for _ in range(windows)]
    for piece, w in zip(pieces, differenced([p.size for p in pieces], windows).tolist(), strict=True):
        out[w].append(piece)
    over: list[Piece] = []
    for inside in out:
        excess = sum(p.size for p in inside) - capacity
        while excess > 0:
            longest = max(inside, key=lambda p: p.size)
            if longest.size <= excess:
                inside.remove(longest)
                over.append(longest)
                excess -= longest.size
            else:
                over.append(longest.cut(excess))
                excess = 0
    for inside in out:
        room = capacity - sum(p.size for p in inside)
        while room > 0 and over:
            piece = over.pop()
            if piece.size > room:
                over.append(piece)
                piece = piece.cut(room)
            inside.append(piece)
            room -= piece.size
    return out


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Pieces of less than a window in all, in sequences whose lengths are powers of two, the longest first."""
    left, out = sum(p.size for p in pieces), []
    while left:
        room, inside = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            piece = pieces.pop()
            if piece.size > room:
                pieces.append(piece)
                piece = piece.cut(room)
            inside.append(piece)
            room -= piece.size
        out.append(inside)
    return out


class _Packer:
    """The sequences of one task."""

    def __init__(self, capacity: int, group: int) -> None:
        self.capacity, self.group = capacity, group
        self.number = TaskContext.get().partitionId() << 32
        self.open: list[Piece] = []
        self.size = self.tokens = 0
        self.rows: list[tuple] = []

    def _sequence(self, inside: list[Piece]) -> None:
        offset = 0
        for p in inside:
            name, ids = p.doc
            self.rows.append((name, p.start, p.size, len(ids), self.number, offset, ids[p.start : p.end].astype("<u4").tobytes()))
            offset += p.size
        self.number += 1
        self.tokens += offset

    def add(self, name: int | None, ids: np.ndarray) -> None:
        doc, whole = (name, ids), len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._sequence([Piece(doc, start, start + self.capacity)])
        if whole == len(ids):
            return
        self.open.append(Piece(doc, whole, len(ids)))
        self.size += len(ids) - whole
        over = self.size - self.group * self.capacity
        if over >= 0:
            rest = [self.open[-1].cut(over)] if over else []
            for inside in filled(self.open, self.group, self.capacity):
                self._sequence(inside)
            self.open, self.size = rest, over

    def close(self) -> None:
        """The last group: as many full windows as it has, the rest in powers of two."""
        windows, over = divmod(self.size, self.capacity)
        rest: list[Piece] = []
        while over:
            piece = self.open.pop()
            if piece.size > over:
                self.open.append(piece)
                piece = piece.cut(over)
            rest.append(piece)
            over -= piece.size
        if windows:
            for inside in filled(self.open, windows, self.capacity):
                self._sequence(inside)
        for inside in powers(rest):
            self._sequence(inside)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 7
        self.rows, self.tokens = [], 0
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = [f.split()[0] for f in _PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """Pieces of the documents in `docs` (doc_id, text; other columns are ignored) with their place: doc_id, start, length,
    doc_tokens, sequence_id, offset, and ids, the piece's token ids as little-endian 32-bit numbers.

    Every document is its whole text's ids and `end_id`; a null or empty text is its end id alone. Sequences hold
    `capacity` ids; only the last few of a task are shorter, and their lengths are powers of two. sequence_id is unique, its
    high half the task's number. Every row is packed, repeated ones and those without doc_id too; an empty table gives none.
    """
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("the capacity of a window is a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the encoder holds millions of strings and makes no cycles; looking for some takes a tenth of the time
        encoder, packer = _encoder(tokenizer), _Packer(capacity, group)
        end = np.array([end_id], dtype=encoder.kind)
        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                for name, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                    packer.add(name, np.concatenate((np.frombuffer(ids, dtype=encoder.kind), end)))
                    if packer.tokens >= BATCH_TOKENS:
                        yield packer.taken()
        packer.close()
        gc.enable()
        yield packer.taken()
        release()

    return rows.mapInArrow(pack, _PIECE)


def piece_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
