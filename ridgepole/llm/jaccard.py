"""Jaccard join of documents on five-word shingles by grouped prefixes.

Documents of equal shingle sets are one class.  Shingles have one global order: those that
many prefixes hold come last, the rarer before the more frequent, all others by hash.  Two sets of Jaccard similarity t share
a shingle among the first ``n - ceil(t n) + 1`` of each, so classes with the same prefix
and size are collapsed into one group, and groups are brought together by the shingles of
their prefixes.

Links are verified exactly, in two rounds, so that a group of thousands of near copies
does not become all its pairs.  Round one expands each group, and each shingle's groups,
to a star around one member of each size.  Round two takes every group and every shingle of
two groups or more (those of the same two groups once) that has three classes at least, in
different components still: ``FEW_MEMBERS`` or fewer are expanded to their pairs across components; larger ones are joined to clusters, which are cut into blocks by
size, and a task compares two blocks by products of their incidence matrices and hands on
a spanning forest of the links.  A candidate pair that is left out lies inside one
component, so components are complete.

Texts travel only for candidates that bitmaps of about a bit a shingle do not rule out: sets
differ in no fewer shingles than their bitmaps in bits, so no link is lost by them.

The common shingles are the ``MOST_COMMON`` most frequent ones at most: their order only
decides how many candidates there are, never which links are found.

Defined results: null texts and texts without words have no shingles, link with nothing
and are their own component; each row is judged by its own text, also where doc_ids repeat;
a null doc_id gets its count, is never linked and has a null component; an empty table
gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgepole.llm import hashes, shingles, vectors
from ridgepole.llm.common import components, discard, narrowed, stored, whole_runs

#: A shingle in more prefixes than this is common.
COMMON = 8
MOST_COMMON = 1 << 20
#: Partners that one group of rows compares with a pivot.
PARTNERS = 512
#: Members of a shingle that are expanded to pairs; shingles and texts of a block of a larger one.
FEW_MEMBERS = 8
BLOCK_SHINGLES = 1_000_000
BLOCK_TEXTS = 1024

_MEMBER, _GROUPS, _CLASSES, _BUCKET, _TWO = 0, 1, 2, 3, 4


def _bytes(column: pa.Array) -> list[bytes]:
    return [v.encode("utf-8", "replace") if v else b"" for v in column.to_pylist()]


def _parts(column: pa.Array):
    """Slices of a batch with their shingle sets, a bounded number of bytes at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in hashes.slices(sizes, shingles.BYTES):
        yield a, b, shingles.sets(_bytes(column.slice(a, b - a)))


def _prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _sizes(percent: int):
    """Each document's class and size; of a class, once for a task, its bitmap and its prefix by hash alone, for counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for a, b, found in _parts(batch.column(1)):
                keys = [shingles.key(s) for s in found]
                heads, bits = [], []
                for k, s in zip(keys, found):
                    fresh = len(s) and k not in seen
                    heads.append(s[: _prefix_length(len(s), percent)].view(np.int64) if fresh else None)
                    bits.append(shingles.bitmap(s) if fresh else None)
                    seen.add(k)
                counts = [0 if h is None else len(h) for h in heads]
                flat = np.concatenate([h for h in heads if h is not None] or [np.empty(0, np.int64)])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in found], pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.binary()), lists],
                    names=["doc_id", "n", "key", "bits", "head"],
                )

    return run


def _prefixes(common, percent: int):
    """Rows of groups by shingle (kind 0) and of classes by group (kind 1), each once for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, frequency = common.value
        classes: set[int] = set()
        groups: set[int] = set()
        for batch in batches:
            for _, _, found in _parts(batch.column(0)):
                tokens, owners, sizes, kinds = [], [], [], []
                for s in found:
                    k = shingles.key(s)
                    if not len(s) or k in classes:
                        continue
                    classes.add(k)
                    if len(late):
                        at = np.searchsorted(late, s)
                        at[at == len(late)] = 0
                        is_late = late[at] == s
                        last = s[is_late][np.argsort(frequency[at[is_late]], kind="stable")]
                        s_ordered = np.concatenate([s[~is_late], last])
                    else:
                        s_ordered = s
                    head = s_ordered[: _prefix_length(len(s), percent)].view(np.int64)
                    group = shingles.key(np.append(head.view(np.uint64), np.uint64(len(s))))
                    tokens.append([group])
                    owners.append([k])
                    kinds.append([1])
                    sizes.append([len(s)])
                    if group not in groups:
                        groups.add(group)
                        tokens.append(head)
                        owners.append(np.full(len(head), group))
                        kinds.append(np.zeros(len(head), np.int64))
                        sizes.append(np.full(len(head), len(s)))
                if tokens:
                    columns = [np.concatenate(x).astype(np.int64) for x in (tokens, owners, sizes, kinds)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "owner", "n", "kind"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, size, owner: members, stars (``_TWO`` is that of a shingle of two groups), and the buckets of three and more."""
    for table in whole_runs(batches, "token"):
        if not table.num_rows:
            continue
        token, owner, n, kind = (table.column(c).to_numpy() for c in ("token", "owner", "n", "kind"))
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner, n, kind = token[fresh], owner[fresh], n[fresh], kind[fresh]
        opens = np.ones(len(token), bool)
        opens[1:] = token[1:] != token[:-1]
        first = np.flatnonzero(opens)
        count = np.diff(np.append(first, len(token)))
        many = np.repeat(count, count)
        out = [(np.full(int((kind == 1).sum()), _MEMBER), token[kind == 1], owner[kind == 1], n[kind == 1])]
        size_class = (np.log(n) / np.log(1.25)).astype(np.int64)
        turn = opens.copy()
        turn[1:] |= size_class[1:] != size_class[:-1]
        heads = np.flatnonzero(turn)
        head = heads[np.cumsum(turn) - 1]
        spokes = np.flatnonzero(head != np.arange(len(head)))
        joints = np.flatnonzero(~opens[heads])
        a = np.concatenate([head[spokes], heads[joints - 1]])
        b = np.concatenate([spokes, heads[joints]])
        fits = 5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])
        a, b = a[fits], b[fits]
        out.append((np.where(kind[a] == 1, _CLASSES, np.where(many[a] == 2, _TWO, _GROUPS)), owner[a], owner[b], n[b]))
        deep = np.flatnonzero((many >= 3) & (kind == 0))
        out.append((np.full(len(deep), _BUCKET), token[deep], owner[deep], n[deep]))
        what, x, y, size = (np.concatenate(c).astype(np.int64) for c in zip(*out))
        if len(what):
            pair = (what == _GROUPS) | (what == _CLASSES) | (what == _TWO)
            x, y = np.where(pair, np.minimum(x, y), x), np.where(pair, np.maximum(x, y), y)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (what, x, y, size)], names=["kind", "x", "y", "n"])


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.array([shingles.difference(x, y) for x, y in zip(batch.column("bitsa").to_pylist(), batch.column("bitsb").to_pylist())], np.int64)
            keep = pa.array(shingles.possible(apart, batch.column("total").to_numpy(), percent))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return run


def possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose bitmaps (``key``, ``n``, ``bits``) leave it open that they are similar enough."""
    of = lambda name: bitmaps.select(F.col("key").alias(name), F.col("n").alias(f"n{name}"), F.col("bits").alias(f"bits{name}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    return met.select("a", "b", (F.col("na") + F.col("nb")).alias("total"), "bitsa", "bitsb").mapInArrow(_possible(percent), "a bigint, b bigint")


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by pivot and role: the pivot's text, then its partners'."""
        pivot, own = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            role = batch.column("role").to_numpy()
            linked = []
            for first, last, found in _parts(batch.column("text")):
                for i, s in zip(range(first, last), found):
                    if role[i] == 0:
                        pivot, own = a[i], s
                    elif a[i] == pivot and shingles.similar(own, s, percent):
                        linked.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], names=["a", "b"])

    return run


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts (``key``, ``text``) are similar enough.

    A text travels once for each pivot it is compared with; a pivot of many partners gets
    several groups of rows, and its own text is sent to each.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("m"))
    of = lambda name: degree.select(F.col("k").alias(name), F.col("m").alias(f"m{name}"))
    turned = pairs.join(of("a"), "a").join(of("b"), "b")
    ends = F.when(F.col("ma") >= F.col("mb"), F.struct("a", "b", "ma")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("mb").alias("ma")))
    parts = F.ceil(F.col("ma") / F.lit(PARTNERS)).cast("int")
    dealt = turned.select(ends.alias("e")).select("e.a", "e.b", "e.ma").withColumn("part", F.pmod(F.xxhash64("b"), parts).cast("int"))
    dealt = stored(dealt.select("a", "b", "part"), "jaccard-pairs")
    text = texts.select("key", "text")
    partners = dealt.join(text.withColumnRenamed("key", "b"), "b").select("a", "part", F.lit(1).alias("role"), "b", "text")
    pivots = dealt.select("a", "part").distinct().join(text.withColumnRenamed("key", "a"), "a").select("a", "part", F.lit(0).alias("role"), F.lit(0).cast("bigint").alias("b"), "text")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = partners.unionByName(pivots).repartition(tasks, "a", "part").sortWithinPartitions("a", "part", "role")
    return rows.mapInArrow(_verify(percent), "a bigint, b bigint")


def _clusters(crowd: DataFrame) -> DataFrame:
    """``key, n, label, cluster`` of classes that share large shingles, directly or through others."""
    spokes = crowd.where("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b"))
    cluster = components(spokes)
    return crowd.select("key", "n", "label").distinct().join(cluster, F.col("key") == F.col("node")).select("key", "n", "label", F.col("component").alias("cluster"))


def _blocks(crowd: DataFrame, carried: DataFrame, percent: int) -> DataFrame:
    """The rows of each two blocks of a cluster that meet, with what ``carried`` has for their ``key``, sorted by ``pair`` and ``side``.

    Sizes fall into classes a factor 1 / t apart, so similar texts lie in one class or in
    neighbouring ones, and blocks of a class meet those of the same and the next class.
    """
    size = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))).cast("bigint")
    sized = crowd.withColumn("size", size)
    parts = sized.groupBy("cluster", "size").agg(
        F.greatest(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count("*") / F.lit(BLOCK_TEXTS))).alias("parts")
    )
    at = lambda step: parts.select("cluster", (F.col("size") - step).alias("size"), F.col("parts").alias(f"parts{step}".replace("-", "_")))
    placed = sized.join(at(0), ["cluster", "size"]).join(at(1), ["cluster", "size"], "left").join(at(-1), ["cluster", "size"], "left")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.col("parts0")))
    meets = lambda name, side, low, high: F.transform(
        F.when(F.col(name).isNull(), F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1)),
        lambda other: F.struct(F.xxhash64("cluster", *low(other), *high(other)).alias("pair"), side(other).alias("side")),
    )
    own, mine = F.col("size"), F.col("block")
    same = meets("parts0", lambda o: (o < mine).cast("int"), lambda o: (own, F.least(mine, o)), lambda o: (own, F.greatest(mine, o)))
    above = meets("parts1", lambda o: F.lit(0), lambda o: (own, mine), lambda o: (own + 1, o))
    below = meets("parts_1", lambda o: F.lit(1), lambda o: (own - 1, o), lambda o: (own, mine))
    dealt = placed.select("key", "n", "label", F.explode(F.concat(same, above, below)).alias("p")).select("p.pair", "p.side", "key", "n", "label")
    rows = dealt.join(carried, "key")
    tasks = int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "pair").sortWithinPartitions("pair", "side", "key")


def _open(crowd: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The rows that may be linked with one of their cluster and another component, as far as bitmaps tell."""
    keys = _blocks(crowd, bitmaps.select("key", "bits"), percent).mapInArrow(_hopeful(percent), "key bigint").distinct()
    return crowd.join(keys, "key", "left_semi")


def _hopeful(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two blocks at a time (or one with itself), sorted by pair and side."""
        for table in whole_runs(batches, "pair"):
            pair, side, key, label, n = (table.column(c).to_numpy() for c in ("pair", "side", "key", "label", "n"))
            turn = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else []
            for first, last in zip(turn, np.append(turn[1:], len(pair))):
                split = first + int((side[first:last] == 0).sum())
                bits = [np.frombuffer(v, np.uint8) for v in table.column("bits").slice(first, last - first).to_pylist()]
                width = np.array([len(b) for b in bits])
                mine = np.arange(first, split)
                theirs = np.arange(split, last) if split < last else mine
                hope = np.zeros(last - first, bool)
                for p in np.unique(width[mine - first]):
                    for q in np.unique(width[theirs - first]):
                        i, j = mine[width[mine - first] == p], theirs[width[theirs - first] == q]
                        apart = shingles.differences(np.stack([bits[x] for x in i - first]), np.stack([bits[x] for x in j - first]))
                        hit = shingles.possible(apart, n[i][:, None] + n[j][None, :], percent) & (label[i][:, None] != label[j][None, :])
                        hope[i[hit.any(1)] - first] = True
                        hope[j[hit.any(0)] - first] = True
                yield pa.RecordBatch.from_arrays([pa.array(key[first:last][hope])], names=["key"])

    return run


def common_counts(sets: list[np.ndarray], split: int = 0, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets before ``split`` with those from it on; without a
    split of all with all, where an earlier set meets a later one.

    Shingles of few sets are counted pair by pair, those of many by products of incidence matrices.
    """
    n = len(sets)
    rows, low_row = split or n, split
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    turn = np.append(True, values[1:] != values[:-1]) if len(values) else np.empty(0, bool)
    count = np.diff(np.append(np.flatnonzero(turn), len(values)))
    many = np.repeat(count, count)
    few = (many > 1) & (many <= FEW_MEMBERS)
    token, own = (np.cumsum(turn) - 1)[few], owner[few]
    out = np.zeros(rows * (n - low_row), np.float32)
    for step in range(1, FEW_MEMBERS):
        a, b = own[:-step], own[step:]
        met = token[:-step] == token[step:]
        met &= (a < rows) & (b >= low_row)
        out += np.bincount(a[met] * (n - low_row) + b[met] - low_row, minlength=len(out)).astype(np.float32)
    out = out.reshape(rows, n - low_row)
    dense = many > FEW_MEMBERS
    column, own = np.cumsum(turn & dense)[dense] - 1, owner[dense]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [low, low + columns])
        part = np.zeros((n, columns), np.float32)
        part[own[a:b], column[a:b] - low] = 1
        out += part[:rows] @ part[low_row:].T
    return out


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two blocks at a time (or one with itself), sorted by pair and side."""
        for table in whole_runs(batches, "pair"):
            pair, side, key, label = (table.column(c).to_numpy() for c in ("pair", "side", "key", "label"))
            turn = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else []
            for first, last in zip(turn, np.append(turn[1:], len(pair))):
                split = first + int((side[first:last] == 0).sum())
                sets = shingles.sets(_bytes(table.column("text").slice(first, last - first)))
                left = (first, split)
                right = (split, last) if split < last else left
                if left[0] == left[1]:
                    continue
                mine, theirs = sets[: split - first], sets[right[0] - first : right[1] - first]
                both = common_counts(sets, len(mine) if split < last else 0)
                n, m = np.array([len(s) for s in mine]), np.array([len(s) for s in theirs])
                hit = (100 * both >= percent * (n[:, None] + m[None, :] - both)) & (label[left[0] : left[1], None] != label[None, right[0] : right[1]])
                i, j = np.nonzero(hit)
                if len(i):
                    root = vectors.forest(last - first, i, j + right[0] - first)
                    moved = np.flatnonzero(root != np.arange(last - first))
                    yield pa.RecordBatch.from_arrays([pa.array(key[first + root[moved]]), pa.array(key[first + moved])], names=["a", "b"])

    return run


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (least doc_id reachable by links) of every row."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    headed = stored(rows.mapInArrow(_sizes(percent), "doc_id bigint, n bigint, key bigint, bits binary, head array<bigint>"), "jaccard-heads")
    sized = stored(headed.drop("bits", "head"), "jaccard-sizes")
    bitmaps = stored(headed.where("bits is not null").select("key", "n", "bits").dropDuplicates(["key"]), "jaccard-bitmaps")

    counted = headed.where("head is not null").select(F.explode("head").alias("token")).groupBy("token").count().where(F.col("count") > COMMON)
    common = counted.orderBy(F.col("count").desc(), "token").limit(MOST_COMMON).select("token", "count").toArrow()
    discard(headed)
    values = common.column("token").to_numpy().view(np.uint64)
    by_value = np.argsort(values)
    late = spark.sparkContext.broadcast((values[by_value], common.column("count").to_numpy()[by_value]))

    emitted = rows.select("text").mapInArrow(_prefixes(late, percent), "token bigint, owner bigint, n bigint, kind bigint")
    dealt = emitted.repartition(max(tasks, 1), "token").sortWithinPartitions("token", "n", "owner")
    found = stored(dealt.mapInArrow(_stars, "kind bigint, x bigint, y bigint, n bigint"), "jaccard-stars")
    kind = lambda k: found.where(F.col("kind") == k)

    members = kind(_MEMBER).select(F.col("x").alias("g"), F.col("y").alias("key"), "n")
    lead = members.groupBy("g").agg(F.min("key").alias("lead"))
    left, right = lead.select(F.col("g").alias("x"), F.col("lead").alias("a")), lead.select(F.col("g").alias("y"), F.col("lead").alias("b"))
    groups = found.where(F.col("kind").isin(_GROUPS, _TWO)).select("x", "y").distinct().join(left, "x").join(right, "y").select("a", "b")
    stars = groups.union(kind(_CLASSES).select("x", "y")).where("a <> b")
    stars = stored(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-round")

    named = sized.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        holders = stored(wanted.join(named, "key"), "jaccard-holders")
        near = narrowed(rows.where("text is not null"), holders.select("doc_id"), "doc_id")
        keyed = near.mapInArrow(_keyed, "key bigint, text string").join(wanted, "key", "left_semi")
        return stored(keyed.dropDuplicates(["key"]), "jaccard-texts")

    likely = stored(possible(stars, bitmaps, percent), "jaccard-likely")
    star_texts = texts_of(likely)
    linked = stored(verify(likely, star_texts, percent), "jaccard-links")
    discard(star_texts)
    labels = stored(components(linked), "jaccard-labels")

    # round two: shingles and groups whose members are not of one component yet
    of = members.join(labels.withColumnRenamed("node", "key"), "key", "left").select("g", "key", "n", F.coalesce("component", "key").alias("label"))
    of = stored(of, "jaccard-members")
    two = kind(_TWO).select("x", "y").distinct().select(F.xxhash64("x", "y").alias("token"), F.explode(F.array("x", "y")).alias("g"))
    held = kind(_BUCKET).select(F.col("x").alias("token"), F.col("y").alias("g")).union(two)
    ends = of.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("many"), F.min("key").alias("lead"))
    ends = stored(ends, "jaccard-ends")
    spans = held.join(ends, "g").select("token", "low", "high", "many", "lead").union(ends.select(F.col("g").alias("token"), "low", "high", "many", "lead"))
    torn = spans.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("many").alias("many"), F.min("lead").alias("lead"))
    torn = stored(torn.where("low < high and many > 2").select("token", "many", "lead"), "jaccard-torn")  # round one compared two classes
    of_groups = held.union(ends.select(F.col("g").alias("token"), "g"))
    open_rows = stored(of_groups.join(torn, "token").join(of, "g").select("token", "key", "n", "label", "many", "lead"), "jaccard-open")
    few = open_rows.where(F.col("many") <= FEW_MEMBERS)
    left = few.select("token", F.col("key").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"))
    right = few.select("token", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    near_size = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (F.col("la") < F.col("lb"))
    pairs = left.join(right, "token").where(near_size).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = stored(possible(pairs.join(stars, ["a", "b"], "left_anti"), bitmaps, percent), "jaccard-round")
    crowd = stored(_clusters(open_rows.where(F.col("many") > FEW_MEMBERS)), "jaccard-clusters")
    crowd = stored(_open(crowd, bitmaps, percent), "jaccard-clusters")
    discard(bitmaps)
    texts = texts_of(rest.union(crowd.select(F.col("key").alias("a"), F.col("key").alias("b"))))
    compared = _blocks(crowd, texts, percent).mapInArrow(_compare(percent), "a bigint, b bigint")
    more = stored(verify(rest, texts, percent).union(compared), "jaccard-links")
    discard(texts)
    if not more.isEmpty():
        labels = stored(components(linked.union(more)), "jaccard-labels")

    named_rows = sized.select("doc_id", "n", "key").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("_label", F.coalesce("component", "key"))
    least = named_rows.where("n > 0 and doc_id is not null").groupBy("_label").agg(F.min("doc_id").alias("_least"))
    return named_rows.join(least, "_label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("_least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        for a, b, found in _parts(column):
            yield pa.RecordBatch.from_arrays([pa.array([shingles.key(s) for s in found], pa.int64()), column.slice(a, b - a)], names=["key", "text"])
