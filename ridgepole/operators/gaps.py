"""Missing numbers between the least and greatest of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols
from ridgepole.operators.expand import explode_range
from ridgepole.operators.running import rank_blocks


def missing_ranges(df: DataFrame, keys: Sequence[str], number: str, blocks: int | None = None) -> DataFrame:
    """Runs of missing whole numbers per key: ``gap_start``, ``gap_end`` (inclusive).

    Distinct numbers are compared with their neighbour inside blocks of equal rank ranges,
    so a window holds a task's share of them whether they are dense or far apart; a second
    pass over each block's least and greatest value, at most ``blocks`` rows for each key,
    finds the runs that span blocks.
    """
    k = [cols.col(x) for x in keys]
    distinct = df.where(cols.col(number).isNotNull()).select(*k, cols.col(number).cast("bigint").alias("_n")).distinct()
    numbers = rank_blocks(distinct, keys, "_n", blocks)
    inside = Window.partitionBy(*k, "_block").orderBy("_n")
    near = numbers.select(*k, F.lag("_n").over(inside).alias("_prev"), F.col("_n").alias("_next"))
    ends = numbers.groupBy(*k, "_block").agg(F.min("_n").alias("_next"), F.max("_n").alias("_last"))
    between = Window.partitionBy(*k).orderBy("_block") if keys else Window.partitionBy(F.lit(1)).orderBy("_block")
    far = ends.select(*k, F.lag("_last").over(between).alias("_prev"), "_next")
    return (
        near.union(far)
        .where(F.col("_next") > F.col("_prev") + 1)
        .select(*k, (F.col("_prev") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"))
    )


def missing_numbers(ranges: DataFrame, keys: Sequence[str], out: str = "missing") -> DataFrame:
    """One row per missing number.  Long runs are spread over tasks in pieces."""
    k = [cols.col(x) for x in keys]
    return explode_range(ranges, "gap_start", "gap_end", out, spread=True).select(*k, F.col(out))


def missing_preview(ranges: DataFrame, keys: Sequence[str], first: int = 20, out: str = "missing") -> DataFrame:
    """The first few missing numbers per key, with the count of all of them.

    ``row_number() <= k`` is applied before the shuffle, so a key sends at most ``first``
    ranges per task.
    """
    if not keys:
        whole = ranges.withColumn("_all", F.lit(1))
        return missing_preview(whole, ["_all"], first, out).drop("_all")
    k = [cols.col(x) for x in keys]
    by_start = Window.partitionBy(*k).orderBy("gap_start")
    head = (
        ranges.withColumn("_r", F.row_number().over(by_start))
        .where(F.col("_r") <= first)
        .withColumn("gap_end", F.least("gap_end", F.col("gap_start") + (first - 1)))
    )
    listed = F.slice(F.sort_array(F.flatten(F.collect_list(F.sequence("gap_start", "gap_end")))), 1, first)
    shown = head.groupBy(*k).agg(listed.alias(out))
    counted = ranges.groupBy(*k).agg(F.sum(F.col("gap_end") - F.col("gap_start") + 1).alias("missing_count"))
    return shown.join(counted, list(keys))
