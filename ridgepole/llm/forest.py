"""Approximate search by a forest of hash prefixes, for the largest inner products.

Each tree gives every vector a string of ``BITS`` hash bits, from random hyperplanes of its
own, and keeps the vectors sorted by it.  The vectors whose strings share a prefix with a
query's are one range of a tree.  A query goes down to its longest matches in all trees,
then up, one bit in all trees at a time, until the ranges together hold ``share`` times as
many entries as there are vectors, and ``least`` of them if the roots have as many; all of these are candidates, compared by their exact inner products.

For inner products, a vector x gets one more component, ``sqrt(M**2 - x.x)`` with M the
largest norm, so all have one length; a query gets 0 there, and angles order as products do.
Norms are banded by factors of ``RATIO``, and each band has its own M and its own trees, of
which a query takes the same share, so a few long vectors do not turn all others away from it.

How far up a query goes is settled on counts of prefixes.  A tree is cut into segments of
neighbours (bounds are quantiles); a query visits the segments its ranges touch, and a
task holds one segment's queries while its vectors stream by, keeping the best of each
query.  Equal vectors are one vector with their least ids.

Random vectors of 64 dimensions have no near neighbours, so ``share`` is large; the tests
measure recall against brute force without ``least``, which only makes small tables exact.  Where the roots are reached, the search is exact.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
neither search nor are found, nor do rows with a null id; ties go to the smaller id; rows
that repeat an id are each found; with fewer candidates than asked for, all found are given;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgepole.llm import hashes, vectors
from ridgepole.llm.common import stored

TREES = 24
BITS = 62
SHARE = 1.0
LEAST = 16_384
#: Norms of a band differ by this factor at most; bands are as many as the norms of doubles have.
RATIO = 1.25
MOST_BANDS = 8192
#: Vectors that a segment is meant to hold, and segments of a tree at most.
SEGMENT = 8192
MOST_SEGMENTS = 4096
#: Depths at which prefixes are counted: beyond them a range holds a few vectors.
DEEPEST = 24


@lru_cache(maxsize=2)
def _planes(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.RandomState(seed).standard_normal((dim, trees * BITS))


def strings(x: np.ndarray, last: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(vectors, trees) hash strings as numbers that sort like the strings."""
    planes = _planes(x.shape[1] + 1, trees, seed)
    side = (x @ planes[:-1] + last[:, None] * planes[-1]) > 0
    weight = (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)).astype(np.int64)
    return (side.reshape(len(x), trees, BITS) * weight).sum(axis=2)


def _hash(longest: dict[int, tuple[int, float]], trees: int, seed: int, query: bool):
    """longest: place and largest norm of each band.  A query is a string in the trees of all bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vectors.matrix(batch.column(1))
            norm2 = (x * x).sum(axis=1)
            settled = [longest[b] for b in batch.column(2).to_pylist()]
            top = np.array([m for _, m in settled])
            last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, top * top - norm2))
            scale = np.maximum(top, 1e-300)
            own = strings(x / scale[:, None], last / scale, trees, seed)
            first = np.array([p for p, _ in settled], np.int32) * trees
            for offset in sorted(p * trees for p, _ in longest.values()) if query else [first]:
                which = pa.array(np.repeat(np.arange(len(x)), trees))
                tree = np.tile(np.arange(trees, dtype=np.int32), (len(x), 1)) + (offset if query else offset[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.ravel().astype(np.int32)), pa.array(own.ravel()), *[c.take(which) for c in batch.columns[:2]]],
                    names=["tree", "string", *batch.schema.names[:2]],
                )

    return run


def _score(most: int):
    def out(query, rep, score):
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(rep, pa.int64()), pa.array(score, pa.float64())], names=["query", "rep", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by segment and role: a segment's queries, then its vectors."""
        place, best = None, None
        held: list[pa.RecordBatch] = []

        def finish():
            if best is not None and len(best["rep"]):
                score, rep, ids = best["score"], best["rep"], best["ids"]
                q, k = np.nonzero(rep >= 0)
                yield out(ids[q], rep[q, k], score[q, k])

        for batch in batches:
            if not batch.num_rows:
                continue
            tree, segment, role = (batch.column(n).to_numpy() for n in ("tree", "segment", "role"))
            turn = np.flatnonzero((tree[1:] != tree[:-1]) | (segment[1:] != segment[:-1]) | (role[1:] != role[:-1])) + 1
            for a, b in zip([0, *turn.tolist()], [*turn.tolist(), batch.num_rows]):
                here, part = (int(tree[a]), int(segment[a])), batch.slice(a, b - a)
                if here != place:
                    yield from finish()
                    place, best, held = here, None, []
                if role[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if best is None:
                    queries = pa.Table.from_batches(held)
                    n = queries.num_rows
                    best = {
                        "ids": queries.column("id").to_numpy(), "low": queries.column("low").to_numpy(), "high": queries.column("high").to_numpy(),
                        "vec": vectors.matrix(queries.column("vec")), "score": np.full((n, most), -np.inf), "rep": np.full((n, most), -1, np.int64),
                    }
                string, rep, vec = part.column("low").to_numpy(), part.column("id").to_numpy(), vectors.matrix(part.column("vec"))
                for q in range(0, len(best["ids"]), 512):
                    mine = slice(q, q + 512)
                    score = best["vec"][mine] @ vec.T
                    inside = (string >= best["low"][mine, None]) & (string <= best["high"][mine, None])
                    score[~inside] = -np.inf
                    keep = min(most + 8, score.shape[1])
                    top = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
                    # scores that do not depend on the shape of a block
                    exact = (best["vec"][mine][:, None, :] * vec[top]).sum(axis=2)
                    exact[~np.take_along_axis(inside, top, axis=1)] = -np.inf
                    all_scores = np.concatenate([best["score"][mine], exact], axis=1)
                    all_reps = np.concatenate([best["rep"][mine], np.where(np.isfinite(exact), rep[top], -1)], axis=1)
                    order = np.lexsort((all_reps, -all_scores), axis=1)[:, :most]
                    best["score"][mine] = np.take_along_axis(all_scores, order, axis=1)
                    best["rep"][mine] = np.take_along_axis(all_reps, order, axis=1)
        yield from finish()

    return run


def search(rows: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", most: int = 20, trees: int = TREES, share: float = SHARE, least: int = LEAST, seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``most`` nearest others of each row where ``is_query`` holds."""
    spark = rows.sparkSession
    distinct = stored(vectors.distinct(rows, vec_id, vector, most_ids=most + 1), "forest-distinct")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, longest = distinct.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(0.0))).first()
    log_longest = float(np.log(longest)) if longest > 0 else 0.0
    apart = F.coalesce((F.lit(log_longest) - F.log(norm)) / F.lit(float(np.log(RATIO))), F.lit(float(MOST_BANDS)))
    band = F.floor(F.least(F.greatest(apart, F.lit(0.0)), F.lit(float(MOST_BANDS)))).cast("int")
    bands = distinct.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.max(norm).alias("longest")).orderBy("band").collect()  # MOST_BANDS + 1 rows at most
    tops = {r["band"]: (place, r["longest"]) for place, r in enumerate(bands)}
    needs = [(place, float(min(trees * r["n"], max(share, least / count) * r["n"]))) for place, r in enumerate(bands)]
    needs = spark.createDataFrame(needs, "place int, need double")
    id_, vec = F.col(f"`{vec_id}`"), F.col(f"`{vector}`")
    asked = rows.where(is_query & id_.isNotNull() & vectors.usable(vec)).select(id_.cast("bigint").alias("query_id"), vec.alias("_vec"))
    asked = stored(asked.join(distinct.select("vec", "rep"), F.col("_vec") == F.col("vec")).select("query_id", "rep"), "forest-queries")
    sought = distinct.join(asked.select("rep").distinct(), "rep", "left_semi")

    kind = distinct.schema["vec"].dataType.simpleString()
    schema = f"tree int, string bigint, id bigint, vec {kind}"
    hashed = lambda df, query: df.select(F.col("rep").alias("id"), "vec", band.alias("band")).mapInArrow(_hash(tops, trees, seed, query), schema)
    points = hashed(distinct, False)
    targets = hashed(sought, True)

    # how far up each query goes in each band: the deepest level whose ranges in all trees hold enough
    deepest = int(max(1, min(DEEPEST, np.ceil(np.log2(max(2.0, trees / share))) + 6)))
    finest = stored(points.groupBy("tree", F.shiftright("string", BITS - deepest).alias("prefix")).agg(F.count("*").alias("n")), "forest-prefixes")
    levels = F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("level")
    cut = lambda c, level: F.expr(f"shiftright({c}, {deepest} - {level})")
    sizes = finest.select("tree", "prefix", "n", levels).groupBy("tree", "level", cut("prefix", "level").alias("prefix")).agg(F.sum("n").alias("n"))
    asks = targets.select("id", "tree", F.shiftright("string", BITS - deepest).alias("prefix"), levels).select("id", "tree", "level", cut("prefix", "level").alias("prefix"))
    place = F.floor(F.col("tree") / trees).cast("int").alias("place")
    reach = asks.join(sizes, ["tree", "level", "prefix"]).groupBy("id", place, "level").agg(F.sum("n").alias("n"))
    reach = reach.join(F.broadcast(needs), "place").where(F.col("n") >= F.col("need"))
    depth = reach.groupBy("id", "place").agg(F.max("level").alias("level"))

    # segments of each tree between quantiles of its strings
    parts = int(max(1, min(MOST_SEGMENTS, count // SEGMENT)))
    if parts > 1:
        cuts = [i / parts for i in range(1, parts)]
        bounds = points.groupBy("tree").agg(F.percentile_approx("string", cuts, 10_000).alias("bounds")).collect()  # MOST_SEGMENTS numbers a tree at most
        bounds = {r["tree"]: np.array(r["bounds"], np.int64) for r in bounds}
    else:
        bounds = {}

    def to_segments(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tree, string = batch.column("tree").to_numpy(), batch.column("string").to_numpy()
                if query:
                    shift = BITS - batch.column("level").to_numpy().astype(np.int64)
                    low = string >> shift << shift
                    high = low + (np.int64(1) << shift) - 1
                else:
                    low = high = string
                first, last = np.zeros(len(tree), np.int64), np.zeros(len(tree), np.int64)
                for t, own in bounds.items():
                    mine = tree == t
                    first[mine], last[mine] = np.searchsorted(own, low[mine], side="left"), np.searchsorted(own, high[mine], side="left")
                many = last - first + 1
                which = pa.array(np.repeat(np.arange(len(tree)), many))
                columns = [batch.column("tree").take(which), pa.array(hashes.expand(first, many)), pa.array(np.full(int(many.sum()), 0 if query else 1, np.int32))]
                columns += [pa.array(low).take(which), pa.array(high).take(which), batch.column("id").take(which), batch.column("vec").take(which)]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "segment", "role", "low", "high", "id", "vec"])

        return run

    dealt_schema = f"tree int, segment bigint, role int, low bigint, high bigint, id bigint, vec {kind}"
    deep = targets.withColumn("place", place).join(depth, ["id", "place"]).select("tree", "string", "id", "vec", "level")
    visits = deep.mapInArrow(to_segments(True), dealt_schema)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(trees * parts, 1 << 16))
    dealt = visits.unionByName(points.mapInArrow(to_segments(False), dealt_schema)).repartition(tasks, "tree", "segment").sortWithinPartitions("tree", "segment", "role", "low", "id")
    scored = dealt.mapInArrow(_score(most + 1), "query bigint, rep bigint, score double")

    best = scored.groupBy("query", "rep").agg(F.max("score").alias("score"))
    near = best.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "rep"))).where(F.col("_r") <= most + 1)
    near = stored(near.join(distinct.select("rep", "ids"), "rep").select(F.col("query").alias("rep"), F.explode("ids").alias("vec_id"), "score"), "forest-near")
    answers = asked.join(near, "rep").where("vec_id <> query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= most).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
