"""Harmonic packing of token sequences.

Class j holds pieces of more than capacity / (j + 1) and at most capacity / j tokens, and each of its sequences takes
exactly j of them. A document gives whole sequences first. What is left goes to its class if j such pieces fill a
sequence but for ``WASTE`` tokens; otherwise a piece of the next class's full size is cut off, and the rest is placed
in the same way.

Every task packs its own rows: nothing is shuffled, and a task holds less than one sequence of each class. At its end the
open sequences are joined, cut at the capacity, and the last one is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.tokens import token_ids

CAPACITY = 1024
WASTE = 32
END_ID = 0

_FIELDS = (
    ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
)


def cut_sizes(capacity: int = CAPACITY, waste: int = WASTE) -> list[list[int]]:
    """For each remainder below the capacity, the sizes of the pieces it is cut into."""
    sizes: list[list[int]] = [[]]
    for left in range(1, capacity):
        j = capacity // left
        if capacity - j * left <= waste:
            sizes.append([left])
        else:
            first = capacity // (j + 1)
            sizes.append([first, *sizes[left - first]])
    return sizes


class Packer:
    """Packs the documents of one task. A piece is (row's id, start, tokens of its document, ids)."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, waste: int = WASTE) -> None:
        self.capacity, self.cuts, self.next = capacity, cut_sizes(capacity, waste), first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            self.rows.append((doc, start, len(ids) // 4, total, self.next, offset, ids))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._close([(doc, start, total, ids[start * 4 : (start + self.capacity) * 4])])
        start = whole
        for size in self.cuts[total - whole]:
            j = self.capacity // size
            held = self.open.setdefault(j, [])
            held.append((doc, start, total, ids[start * 4 : (start + size) * 4]))
            start += size
            if len(held) == j:
                self._close(self.open.pop(j))

    def finish(self) -> None:
        pieces = [p for j in sorted(self.open) for p in self.open[j]]
        self.open.clear()
        left = sum(len(p[3]) for p in pieces) // 4
        rooms = [self.capacity] * (left // self.capacity) + [1 << b for b in range(self.capacity.bit_length(), -1, -1) if (left % self.capacity) >> b & 1]
        at = 0
        for room in rooms:
            taken = []
            while room:
                doc, start, total, ids = pieces[at]
                part = ids[: room * 4]
                taken.append((doc, start, total, part))
                room -= len(part) // 4
                if len(part) < len(ids):
                    pieces[at] = (doc, start + len(part) // 4, total, ids[len(part) :])
                else:
                    at += 1
            self._close(taken)

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        arrays = [pa.array([r[0] for r in rows], id_type), *(pa.array([r[i + 1] for r in rows], t) for i, (_, t) in enumerate(_FIELDS))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(n for n, _ in _FIELDS)])


def _pack(path: str, capacity: int, waste: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, end = TaskContext.get(), np.array([END_ID], "<u4").tobytes()
        encoder, packer, kind = token_ids(path), Packer((task.partitionId() if task else 0) << 33, capacity, waste), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, encoder.encode(text.as_py() or "") + end)
                if len(packer.rows) > 4096:
                    yield packer.batch(kind)
        packer.finish()
        if packer.rows:
            yield packer.batch(kind)

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, waste: int = WASTE) -> DataFrame:
    """Pieces of the documents (``doc_id``, ``text``) in sequences of at most ``capacity`` tokens.

    A document is its ids by the tokenizer file, then id 0; null and empty texts are that one id. Every token is in exactly
    one piece. Rows with the same id are packed each by itself; a piece does not tell them apart. An empty table gives an
    empty result, and other columns are left out. Returns doc_id, start, length, doc_tokens, sequence_id, offset, ids
    (little-endian unsigned 32-bit).
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _pack(tokenizer, capacity, waste), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
