"""Removal of byte strings that occur more than once in a corpus, by sorted suffixes of shards.

A string of ``length`` bytes has a least k-mer (by hash, the leftmost of equals).  Stretches
of a text whose strings share their least k-mer form a piece, and equal strings lie in
pieces of the same k-mer.  So pieces are brought together by k-mer:

* Equal pieces are collapsed into one; all strings of a piece that occurs twice repeat.
* Different pieces of one k-mer are the rows of shards.  Each shard is a text of its own,
  whose suffixes are sorted with their common prefixes by external induced sorting
  (``inducing``); neighbours that agree on ``length`` bytes repeat.
* Pieces whose k-mer occurs once in the corpus hold no repeat and go no further.

A task that sorts a shard keeps text, queues and results in files of its own scratch
folder, which it removes at its end; a lost task is run again from the shuffled pieces.

Strings are judged on the input and never cross texts; every copy is removed, overlaps
count.  Equal texts are worked on once.  Texts, k-mers and pieces are told apart by 64-bit
hashes, pieces by two of them.  Defined results: a null text is empty; texts shorter than
``length`` lose nothing; repeated rows count as copies of each other; an empty table gives
an empty table.  Columns with the names of added ones are replaced.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgepole.llm import hashes, inducing
from ridgepole.llm.common import FEW, narrowed, stored, whole_runs

LENGTH = 200
KMER = 64
#: Bytes of pieces that a shard is meant to hold.
SHARD = 3 << 19
#: Bytes of texts that a task works on at a time.
BYTES = 1 << 20
#: The same where each byte takes an array of words or more.
BLOCK = 1 << 18
#: Rows of a batch that a task takes out of it at a time.
ROWS = 256
_PLACE_BITS = 24

_VALUE = hashes.symbols(256, 23)
_SPAN, _SORT = 0, 1


def _bytes(column: pa.Array) -> list[bytes]:
    return [v.encode("utf-8", "replace") if isinstance(v, str) else (v or b"") for v in column.to_pylist()]


def _few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches: what is made of texts is held for a few of them."""
    for batch in batches:
        for low in range(0, max(batch.num_rows, 1), ROWS):
            yield batch.slice(low, ROWS)


def pieces(texts: list[bytes], length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """(text, start, bytes, k-mer hash, piece hash) of all pieces; texts of ``length`` and more."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    prefix = hashes.Prefix(_VALUE[raw])
    at = np.arange(len(raw) - kmer + 1)
    grams = hashes.mix(prefix.of(at, at + kmer))
    mask = (1 << _PLACE_BITS) - 1
    ranked = (grams & ~np.uint64(mask)) | at.astype(np.uint64)
    width = length - kmer + 1  # k-mers of a string
    count = len(raw) - length + 1  # strings
    padded = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranked)] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(mask)).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)[:count]
    inside = np.arange(count) + length <= (first + sizes)[text]
    starts = np.flatnonzero(inside & np.concatenate([[True], (least[1:] != least[:-1]) | ~inside[:-1] | (text[1:] != text[:-1])]))
    stops = np.flatnonzero(inside & np.concatenate([(least[1:] != least[:-1]) | ~inside[1:] | (text[1:] != text[:-1]), [True]]))
    ends = stops + length
    whole = hashes.mix(prefix.of(starts, ends) + (ends - starts).astype(np.uint64))
    return text[starts], starts - first[text[starts]], ends - starts, grams[least[starts]].view(np.int64), whole.view(np.int64)


def _cut(length: int, kmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _few_rows(batches):
            new = []
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            # a long text is worked on in stretches that overlap by a string less one byte
            names, begins, parts = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), _bytes(batch.column(1))):
                for low in range(0, len(value) - length + 1, BLOCK):
                    names.append(key)
                    begins.append(low)
                    parts.append(value[low : low + BLOCK + length - 1])
            keys, base = np.array(names, np.int64), np.array(begins, np.int64)
            for a, b in hashes.slices([len(p) for p in parts], BLOCK):
                text, start, size, gram, whole = pieces(parts[a:b], length, kmer)
                place = (base[a:b][text] + start) << 12 | size
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (gram, whole, keys[a:b][text], place)], names=["kmer", "piece", "text", "place"])

    return run


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by k-mer, piece, text, place: repeated ones as spans, one of each different kind to sort."""
    for table in whole_runs(batches, "kmer"):
        kmer, piece, text, place = (table.column(c).to_numpy() for c in ("kmer", "piece", "text", "place"))
        if not len(kmer):
            continue
        turn = lambda *columns: np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
        fresh = turn(kmer, piece, text, place)
        kmer, piece, text, place = (c[fresh] for c in (kmer, piece, text, place))
        first = np.flatnonzero(turn(kmer, piece))
        copies = np.diff(np.append(first, len(kmer)))
        kinds_first = np.flatnonzero(turn(kmer[first]))
        kinds = np.diff(np.append(kinds_first, len(first)))
        sort = first[np.repeat(kinds, kinds) >= 2]
        twice = np.repeat(copies, copies) >= 2
        span = np.flatnonzero(twice)
        rows = np.concatenate([span, sort])
        if len(rows):
            what = np.repeat([_SPAN, _SORT], [len(span), len(sort)])
            columns = (what, kmer[rows], text[rows], place[rows] >> 12, place[rows] & 4095, twice[rows].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["kind", "kmer", "text", "start", "size", "twice"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kmer", "text", "start", "twice", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in _few_rows(batches):
        out: list[list] = [[] for _ in names]
        held = 0
        for text, raw, parts in zip(batch.column("text").to_pylist(), _bytes(batch.column("value")), batch.column("parts").to_pylist()):
            for part in parts:
                start, size = part["start"], part["size"]
                for column, value in zip(out, (part["kmer"], text, start, part["twice"], raw[start : start + size])):
                    column.append(value)
                held += size
            if held > BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                out, held = [[] for _ in names], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def _sort_shard(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one shard, sorted by k-mer, text, start."""
        with tempfile.TemporaryDirectory() as folder:
            path, columns, last = os.path.join(folder, "text"), [], None
            with open(path, "wb") as out:
                for batch in batches:
                    kept = []
                    for i, name in enumerate(zip(*[batch.column(c).to_pylist() for c in ("kmer", "text", "start")])):
                        if name != last:
                            kept.append(i)
                        last = name
                    batch = batch.take(pa.array(kept, pa.int64()))
                    values = batch.column("bytes").to_pylist()
                    for value in values:
                        # symbols: 0 the end, 1 between pieces, then the bytes; text has no byte over 0xF4
                        out.write((np.frombuffer(value, np.uint8) + np.uint8(2)).tobytes() + b"\x01")
                    sizes = np.array([len(v) for v in values], np.int64)
                    columns.append((sizes, *[batch.column(c).to_numpy() for c in ("text", "start", "twice")]))
                out.write(b"\x00")
            if not columns:
                return
            sizes, text, start, twice = (np.concatenate(c) for c in zip(*columns))
            flags = inducing.repeated(np.memmap(path, np.uint8, "r"), length, folder)
            ends = np.cumsum(sizes + 1)
            for low, high in hashes.slices(sizes, BYTES):
                base = ends[low] - sizes[low] - 1
                hit = np.asarray(flags[base : ends[high - 1]])
                owner = np.repeat(np.arange(low, high), sizes[low:high] + 1)
                offset = np.arange(base, ends[high - 1]) - (ends - sizes - 1)[owner]
                hit = hit & (twice[owner] == 0) & (offset + length <= sizes[owner])
                edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                mine = owner[a]
                origin = start[mine] - (ends[mine] - sizes[mine] - 1 - base)
                yield pa.RecordBatch.from_arrays([pa.array(text[mine]), pa.array(origin + a), pa.array(origin + b - 1 + length)], names=["text", "start", "stop"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of spans sorted by text, start: each text's union of spans."""
    for table in whole_runs(batches, "text"):
        text, start, stop = (table.column(c).to_numpy() for c in ("text", "start", "stop"))
        if not len(text):
            continue
        opens = np.append(True, text[1:] != text[:-1])
        group = np.cumsum(opens) - 1
        # texts laid one after the other, so that one running maximum serves them all
        shift = group * (int(stop.max()) + 1)
        reach = np.maximum.accumulate(stop + shift)
        new = opens.copy()
        new[1:] |= (start + shift)[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(text)) - 1
        owner = group[first]
        counts = np.bincount(owner)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        starts = pa.ListArray.from_arrays(offsets, pa.array(start[first]))
        stops = pa.ListArray.from_arrays(offsets, pa.array(reach[last] - shift[last]))
        yield pa.RecordBatch.from_arrays([pa.array(text[np.flatnonzero(opens)]), starts, stops], names=["text", "starts", "stops"])


def spans(rows: DataFrame, length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """``text`` (hash), ``starts``, ``stops``: what is removed of each text that loses anything.

    ``rows`` has ``text`` (hash), ``value`` (the text) and ``holder`` (a bigint that tells copies apart).
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = rows.where(F.octet_length("value") >= length)
    emitted = long.select("text", "value").mapInArrow(_cut(length, kmer), "kmer bigint, piece bigint, text bigint, place bigint")
    dealt = emitted.repartition(tasks, "kmer").sortWithinPartitions("kmer", "piece", "text", "place")
    schema = "kind bigint, kmer bigint, text bigint, start bigint, size bigint, twice bigint"
    matched = stored(dealt.mapInArrow(_match, schema), "repeats-matched")

    held = long.groupBy("text").agg(F.count("*").alias("copies"), F.min("holder").alias("holder"), F.max(F.octet_length("value")).cast("bigint").alias("bytes"))
    held = stored(held, "repeats-texts")
    parts = matched.where(F.col("kind") == _SORT).groupBy("text").agg(F.collect_list(F.struct("kmer", "start", "size", "twice")).alias("parts"), F.sum("size").alias("total"))
    parts = stored(parts.join(held.select("text", "holder"), "text"), "repeats-parts")
    total = parts.agg(F.sum("total")).first()[0] or 0
    near = narrowed(long, parts.select("text", "holder"), ["text", "holder"])
    sliced = near.select("text", "value").join(parts.select("text", "parts"), "text").mapInArrow(_slices, "kmer bigint, text bigint, start bigint, twice bigint, bytes binary")
    shards = sliced.repartition(max(1, -(-total // SHARD)), "kmer").sortWithinPartitions("kmer", "text", "start")
    sorted_ = shards.mapInArrow(_sort_shard(length), "text bigint, start bigint, stop bigint")

    collapsed = matched.where(F.col("kind") == _SPAN).select("text", "start", (F.col("start") + F.col("size")).alias("stop"))
    copied = held.where("copies > 1").select("text", F.lit(0).cast("bigint").alias("start"), F.col("bytes").alias("stop"))
    united = collapsed.union(copied).union(sorted_).repartition(tasks, "text").sortWithinPartitions("text", "start")
    return united.mapInArrow(_merge, "text bigint, starts array<bigint>, stops array<bigint>")


def _apply(keep: list[str], characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_rows(batches):
            texts = batch.column(len(keep)).to_pylist()
            starts, stops = batch.column(len(keep) + 1).to_pylist(), batch.column(len(keep) + 2).to_pylist()
            for low, high in hashes.slices([len(t or "") for t in texts], BYTES):
                sizes, gone, runs, rest = [], [], [], []
                for i in range(low, high):
                    raw = texts[i].encode("utf-8", "replace") if texts[i] else b""
                    cuts = list(zip(starts[i] or [], stops[i] or []))
                    if characters:
                        cuts = [c for c in (_whole_characters(raw, *c) for c in cuts) if c[0] < c[1]]
                    at, parts = 0, []
                    for a, b in cuts:
                        parts.append(raw[at:a])
                        at = b
                    parts.append(raw[at:])
                    sizes.append(len(raw))
                    rest.append(b"".join(parts))
                    gone.append(len(raw) - len(rest[-1]))
                    runs.append([{"start": a, "stop": b} for a, b in cuts])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                own = batch.slice(low, high - low)
                added = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.binary())]
                yield pa.RecordBatch.from_arrays([*own.columns[: len(keep)], *added], names=[*keep, "n_bytes", "n_removed", "spans", "kept"])

    return run


def _whole_characters(raw: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a span that holds whole UTF-8 characters only."""
    while a < b and raw[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, characters: bool = False) -> DataFrame:
    """Replace the text by ``n_bytes``, ``n_removed``, ``spans`` and ``kept`` (the bytes that stay).

    With ``characters``, a character goes only if all its bytes do, so ``kept`` is text.
    """
    added = ["n_bytes", "n_removed", "spans", "kept"]
    value = F.col(f"`{text}`")
    rows = docs.select(F.xxhash64(value).alias("text"), value.alias("value"), F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-1)).alias("holder"))
    found = stored(spans(rows.where(value.isNotNull()), length), "repeats-spans")
    few = found.count() <= FEW
    lost = found.withColumnRenamed("text", "_text")
    keep = [c for c in docs.columns if c not in {*added, text}]
    whole = docs.select(*[F.col(f"`{c}`") for c in keep], value.alias("_value"))
    joined = whole.join(F.broadcast(lost) if few else lost, F.xxhash64("_value") == F.col("_text"), "left").drop("_text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema.fields[:-1]]
    schema = ", ".join([*fields, "n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"])
    return joined.mapInArrow(_apply(keep, characters), schema)
