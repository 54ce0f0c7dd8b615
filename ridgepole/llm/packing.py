"""Harmonic packing of token ids into sequences of a fixed capacity.

Lengths fall into classes by the reciprocal of the capacity: class K takes pieces of
``capacity // K`` ids, and K of them fill a bin.  A document gives as many whole bins as
it fills, then its rest is cut into the largest class sizes that fit, one after the other
(700 of 1024: 512, 170, 18), so a bin of class K lacks fewer than K ids.  Each task fills
its own bins and waits for no other.  The bins that a task has not filled at its end
(fewer than K pieces of each class) are chained, cut at the capacity, and the last stretch
is cut at powers of two, which are not padded.

Defined results: a null or empty text is its separator alone; equal rows are packed as
often as they occur; an empty table gives no rows; a null id of a document stays null.
Ids of a piece are hashed as little-endian unsigned 32-bit words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.llm import hashes, tokens

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

#: Characters whose ids a task holds at a time.
BATCH = 1 << 21
#: The same of texts, which take many times the room of their ids while they are encoded.
TEXTS = 1 << 18


def class_sizes(rest: np.ndarray, capacity: int) -> np.ndarray:
    """The largest class size that fits into each rest (a rest is under the capacity)."""
    return capacity // (capacity // (rest + 1) + 1)


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents: (document, start, length), whole bins first, then class sizes."""
    whole = lengths // capacity
    docs = [np.repeat(np.arange(len(lengths)), whole)]
    starts = [hashes.expand(np.zeros(len(whole), np.int64), whole) * capacity]
    sizes = [np.full(int(whole.sum()), capacity, np.int64)]
    at, rest = whole * capacity, lengths - whole * capacity
    live = np.flatnonzero(rest)
    while len(live):
        size = class_sizes(rest[live], capacity)
        docs.append(live)
        starts.append(at[live])
        sizes.append(size)
        at[live] += size
        rest[live] -= size
        live = live[rest[live] > 0]
    return np.concatenate(docs), np.concatenate(starts), np.concatenate(sizes)


def _rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)


class Bins:
    """A task's bins: one open bin for each class."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.waiting: dict[int, list[tuple[int | None, int, int, np.ndarray]]] = {}

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
        """Rows of all bins that these documents fill; ids: of all documents on end."""
        capacity = self.capacity
        docs, starts, sizes = cut(lengths, capacity)
        base = np.cumsum(lengths) - lengths
        order = np.lexsort((starts, docs, sizes))
        docs, starts, sizes = docs[order], starts[order], sizes[order]
        raw = memoryview(ids.astype("<u4")).cast("B")
        begins = (base[docs] + starts) * 4
        named = doc_ids.to_pylist() if doc_ids.null_count else doc_ids.to_numpy(zero_copy_only=False)
        done: list[list] = [[] for _ in range(7)]
        kinds, firsts = np.unique(sizes, return_index=True)
        for size, a, b in zip(kinds.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(sizes)]):
            per = capacity // size
            held = self.waiting.pop(size, [])
            total = len(held) + b - a
            full = total // per * per
            for place, (doc, start, whole, piece) in enumerate(held):
                if place < full:
                    self._emit(done, doc, start, size, zlib.crc32(piece), whole, self.next_id, place * size)
            take = max(0, full - len(held))
            if take:
                d, s = docs[a : a + take], starts[a : a + take]
                place = len(held) + np.arange(take)
                crc = [zlib.crc32(raw[x : x + 4 * size]) for x in begins[a : a + take].tolist()]
                names = [named[i] for i in d.tolist()] if doc_ids.null_count else named[d]
                for column, values in zip(done, (names, s, np.full(take, size), crc, lengths[d], self.next_id + place // per, place % per * size)):
                    column.append(values)
            self.next_id += full // per
            rest = held[full:] if not take else []
            rest += [(None if named[docs[i]] is None else int(named[docs[i]]), int(starts[i]), int(lengths[docs[i]]), ids[begins[i] // 4 : begins[i] // 4 + size].astype("<u4")) for i in range(a + take, b)]
            if rest:
                self.waiting[size] = rest
        return self._batch(done)

    @staticmethod
    def _emit(done, *values) -> None:
        for column, v in zip(done, values):
            column.append([v])

    @staticmethod
    def _batch(done: list[list]) -> pa.RecordBatch:
        if not done[0]:
            return _rows([np.empty(0, np.int64)] * 7)
        flat = [pa.chunked_array([pa.array(x, pa.int64()) for x in column]).combine_chunks() for column in done]
        return _rows([x if isinstance(x, pa.Array) else x.chunk(0) for x in flat])

    def finish(self) -> pa.RecordBatch:
        """Rows of what is left: chained, cut at the capacity, the last stretch at powers of two."""
        pieces = [p for size in sorted(self.waiting, reverse=True) for p in self.waiting[size]]
        self.waiting = {}
        total = sum(len(p[3]) for p in pieces)
        ends, at = [], 0
        while total - at >= self.capacity:
            at += self.capacity
            ends.append(at)
        while at < total:
            at += 1 << (total - at).bit_length() - 1
            ends.append(at)
        done: list[list] = [[] for _ in range(7)]
        k = at = begin = 0
        for doc, start, whole, ids in pieces:
            used = 0
            while used < len(ids):
                n = min(len(ids) - used, ends[k] - at)
                self._emit(done, doc, start + used, n, zlib.crc32(ids[used : used + n]), whole, self.next_id + k, at - begin)
                used, at = used + n, at + n
                if at == ends[k]:
                    k, begin = k + 1, at
        self.next_id += k
        return self._batch(done)


def _encoded(own: tokens.Encoder, texts: pa.Array, sizes: list[int], separator: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end, each with its separator, and how many each has; few texts are open at a time."""
    parts, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for a, b in hashes.slices(sizes, TEXTS):
        ids, counts = own.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
        ends = counts + 1
        whole = np.full(int(ends.sum()), separator, np.int64)
        whole[hashes.expand(np.cumsum(ends) - ends, counts)] = ids
        parts.append(whole.astype("<u4"))
        lengths.append(ends)
    return np.concatenate(parts), np.concatenate(lengths)


def pack(docs: DataFrame, tokenizer_path: str, separator: int = 0, capacity: int = 1024, doc_id: Column | None = None, text: Column | None = None) -> DataFrame:
    """One row for each piece: where it lies in its document and in its sequence.

    ``sequence_id`` holds the task's number in its upper bits, so tasks need not agree.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    rows = docs.select((F.col("doc_id") if doc_id is None else doc_id).alias("doc_id"), (F.col("text") if text is None else text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(tokenizer_path)
        bins = Bins(capacity, TaskContext.get().partitionId() << 36)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
            for a, b in hashes.slices(sizes, BATCH):
                ids, lengths = _encoded(own, batch.column(1).slice(a, b - a), sizes[a:b], separator)
                yield bins.add(batch.column(0).slice(a, b - a).cast(pa.int64()), ids, lengths)
        yield bins.finish()

    return rows.mapInArrow(run, PIECES)
