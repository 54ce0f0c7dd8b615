"""Running totals that do not gather a whole group in one task.

Rows are cut into blocks by rank, not by value: a range partitioning deals them to a given
number of tasks by sampled bounds, so a block holds a task's share of the rows however far
apart the numbers lie and however many of them one key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.operators import columns as cols
from ridgepole.session import scratch_dir


def rank_blocks(df: DataFrame, keys: Sequence[str], order: str, blocks: int | None = None) -> DataFrame:
    """Add ``_block``: ascending in (``keys``, ``order``), with about as many rows in each.

    A key has at most ``blocks`` of them (the session's shuffle partitions unless given),
    which bounds every window over a key's blocks.  The rows are stored in the shared
    scratch folder: bounds are sampled anew whenever a plan runs, and all that is made of
    the blocks must see the same ones, also after an executor is lost.
    """
    spark = df.sparkSession
    number = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [cols.col(k).asc_nulls_first() for k in keys] + [cols.col(order).asc_nulls_first()]
    path = scratch_dir(spark, "rank-blocks")
    df.repartitionByRange(number, *by).withColumn("_block", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_block", T.IntegerType())])).parquet(path)


def with_join_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rename the keys (``_key0`` ...), so a join of a table with itself stays unambiguous."""
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    return df.select(*[cols.col(n).alias(renamed.get(n, n)) for n in df.columns])


def same_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with their renamed twins."""
    tests = [cols.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Total:
    """Sum of ``value`` within ``keys`` up to the current row, or up to the one before it."""

    keys: Sequence[str]
    value: Column
    out: str
    inclusive: bool = True


def running_totals(df: DataFrame, order: str, totals: Sequence[Total], blocks: int | None = None) -> DataFrame:
    """Add running totals by ``order``, which is unique within each key.

    Rows are cut into blocks of equal rank ranges by the keys that all totals share, so a
    window holds a task's share of the rows however large its key; the per-block sums, at
    most ``blocks`` for each key, are then accumulated and joined back.  All per-block sums
    are partial aggregates over the stored blocks, so several totals do not pile up on each
    other's plans.
    """
    shared = [k for k in totals[0].keys if all(k in t.keys for t in totals)]
    values = [t.value.cast("bigint").alias(f"_v{i}") for i, t in enumerate(totals)]
    cut = rank_blocks(df.select("*", *values), shared, order, blocks)
    result = cut
    for i, t in enumerate(totals):
        parts = [*t.keys, "_block"]
        within = Window.partitionBy(*[cols.col(k) for k in parts]).orderBy(cols.col(order))
        result = result.withColumn(f"_run{i}", F.sum(f"_v{i}").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    for i, t in enumerate(totals):
        parts = [*t.keys, "_block"]
        sums = cut.groupBy(*[cols.col(k) for k in parts]).agg(F.sum(f"_v{i}").alias("_sum"))
        # without keys there is one group, of one row per block
        across = Window.partitionBy(*([cols.col(k) for k in t.keys] or [F.lit(1)])).orderBy("_block")
        before = F.sum("_sum").over(across.rowsBetween(Window.unboundedPreceding, -1))
        offsets = with_join_keys(sums.select(*[cols.col(k) for k in parts], before.alias(f"_before{i}")), parts)
        keys = [f"_key{j}" for j in range(len(parts))]
        result = result.join(offsets, same_keys(parts), "left").drop(*keys)
    added = []
    for i, t in enumerate(totals):
        total = F.col(f"_run{i}") + F.coalesce(F.col(f"_before{i}"), F.lit(0))
        if not t.inclusive:
            total = total - F.coalesce(F.col(f"_v{i}"), F.lit(0))
        added.append(total.alias(t.out))
    return result.select(*[cols.col(n) for n in df.columns], *added)
