"""Harmonic packing of token sequences (operator 4).

Each worker packs its own partition, without a shuffle.  A document of n ids
(its tokens and an end id) with n <= capacity goes to the class of lengths in
(capacity / (i + 1), capacity / i]; a bin of class i closes at exactly i
documents.  Longer documents are cut: their ids fill the gaps of closed bins
and whole sequences of their own.  Where there are too few long documents, the
bins that wait for filling are taken apart, the latest first, to fill the
others.  At the end of a partition the rest is laid end to end and its last
part cut at powers of two, so that padding vanishes.

Defined results: null and empty texts are one end id; repeated rows and equal
or null doc_ids are packed each by itself; an empty table gives no piece; extra
columns of the input are ignored.  Memory: one slice of texts, one open bin per
class, at most ``WAITING`` closed bins, and one reserve of cut documents.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from matchstats.llm.common import ship_code
from matchstats.llm.tokens import crc32_ids, memo, text_slices

CAPACITY = 1024
END_ID = 0
#: Shorter documents than capacity / CLASSES share the last class.
CLASSES = 32
#: Closed bins that wait for ids of long documents to fill their gaps.
WAITING = 64
#: Ids of cut documents kept back for such gaps, in sequences.
RESERVE = 16
#: Sequence ids of a partition start at its number times this.
PARTITION_STRIDE = 1 << 40

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long")


class Piece:
    __slots__ = ("doc", "ids", "start", "end")

    def __init__(self, doc, ids: np.ndarray, start: int, end: int):
        self.doc, self.ids, self.start, self.end = doc, ids, start, end

    def __len__(self) -> int:
        return self.end - self.start


class HarmonicPacker:
    """Packs documents as they come; ``rows`` holds the finished pieces."""

    def __init__(self, capacity: int = CAPACITY, classes: int = CLASSES, first_sequence: int = 0):
        self.capacity, self.classes, self.sequence = capacity, classes, first_sequence
        self.bins: dict[int, list[Piece]] = {i: [] for i in range(1, classes + 1)}
        self.fill: dict[int, int] = dict.fromkeys(self.bins, 0)
        self.waiting: list[tuple[list[Piece], int]] = []
        self.filler: deque[Piece] = deque()
        self.spare = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        if n > self.capacity:
            self._spare(Piece(doc, ids, 0, n))
            while self.waiting and self.waiting[-1][1] <= self.spare:
                self._close(*self.waiting.pop())
            while self.spare >= (RESERVE + 1) * self.capacity:
                self._emit(self._take(self.capacity))
            return
        kind = min(self.classes, self.capacity // n)
        if self.fill[kind] + n > self.capacity:  # only the last class
            self._shut(kind)
        self.bins[kind].append(Piece(doc, ids, 0, n))
        self.fill[kind] += n
        if kind < self.classes and len(self.bins[kind]) == kind or self.fill[kind] == self.capacity:
            self._shut(kind)

    def finish(self) -> None:
        for kind, pieces in self.bins.items():
            for p in pieces:
                self._spare(p)
            self.bins[kind], self.fill[kind] = [], 0
        while self.waiting:
            self._settle()
        while self.spare >= self.capacity:
            self._emit(self._take(self.capacity))
        while self.spare:
            self._emit(self._take(1 << (self.spare.bit_length() - 1)))

    def _spare(self, piece: Piece) -> None:
        self.filler.append(piece)
        self.spare += len(piece)

    def _shut(self, kind: int) -> None:
        pieces, gap = self.bins[kind], self.capacity - self.fill[kind]
        self.bins[kind], self.fill[kind] = [], 0
        if gap <= self.spare:
            self._close(pieces, gap)
        else:
            self.waiting.append((pieces, gap))
            if len(self.waiting) > WAITING:
                self._settle()

    def _settle(self) -> None:
        """Fill the oldest waiting bin, taking the latest ones apart if needed."""
        pieces, gap = self.waiting.pop(0)
        while gap > self.spare and self.waiting:
            for p in self.waiting.pop()[0]:
                self._spare(p)
        if gap > self.spare:  # the very last bin of the partition
            for p in pieces:
                self._spare(p)
        else:
            self._close(pieces, gap)

    def _close(self, pieces: list[Piece], gap: int) -> None:
        self._emit(pieces + self._take(gap))

    def _take(self, n: int) -> list[Piece]:
        """The next n spare ids, cut where they end."""
        out = []
        while n:
            head = self.filler[0]
            if len(head) <= n:
                piece = self.filler.popleft()
            else:
                piece = Piece(head.doc, head.ids, head.start, head.start + n)
                head.start += n
            out.append(piece)
            n -= len(piece)
            self.spare -= len(piece)
        return out

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc, p.start, len(p), crc32_ids(p.ids[p.start: p.end]), len(p.ids), self.sequence,
                              offset))
            offset += len(p)
        self.sequence += 1

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(PIECES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, classes: int = CLASSES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of
    each piece.  Every id of every row lies in exactly one piece."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        packer = HarmonicPacker(capacity, classes, partition * PARTITION_STRIDE)
        tokens = memo(tokenizer_path)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for at, part in text_slices(batch.column("text")):
                ids, off = tokens.ids(part)
                for i in range(len(part)):
                    own = np.empty(off[i + 1] - off[i] + 1, np.uint32)
                    own[:-1], own[-1] = ids[off[i]: off[i + 1]], END_ID
                    packer.add(names[at + i], own)
                yield packer.drain()
        packer.finish()
        yield packer.drain()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES_DDL)
