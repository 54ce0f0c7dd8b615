"""Stored intermediate tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgepole.session import remove_dir, scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: its lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, once all that was made of it is stored or collected."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        remove_dir(table.sparkSession, path)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes on ``edges`` (``a``, ``b``: bigint); the least node names it.

    Small-star and large-star steps in turn, on rows; each node of a star keeps one edge to
    its least neighbour, so a long chain or a hot node is settled in a number of rounds that
    grows with the logarithm of its size.
    """
    both = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stored(both, "components"), None
    while True:
        # large star: the greater neighbours of each node go to the least one of it and its neighbours
        ways = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = ways.join(least, F.col("a") == F.col("k")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lesser neighbours go to the least of them
        large = stored(large, "components")
        small_least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        joined = large.join(small_least, F.col("a") == F.col("k"))
        small = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(small_least.select(F.col("k").alias("a"), F.col("m").alias("b")))
        now = stored(small.distinct(), "components")
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())


#: Rows of keys that may be sent to every task.
FEW = 1 << 20


def _sized(keys: DataFrame) -> DataFrame:
    keys = keys.distinct()
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def narrowed(rows: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows whose key is among ``keys``: a broadcast where those are few, else a shuffle."""
    return rows.join(_sized(keys), on, "left_semi")


def without(rows: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows whose key is not among ``keys``; null keys stay."""
    return rows.join(_sized(keys), on, "left_anti")


def whole_runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut only where ``column`` changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        first = int(np.searchsorted(values, values[-1])) if values[0] <= values[-1] else 0
        if first or (held and held[-1].column(column)[-1].as_py() != values[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = []
        held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)
