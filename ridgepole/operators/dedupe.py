"""First or last row per key.

Written as ``min_by`` / ``max_by`` so every task first reduces its own rows to one per
key: a key that holds a third of the table still sends one row per task through the
shuffle, and no group is ever gathered whole (a ranking window would do that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick) -> DataFrame:
    rest = [n for n in df.columns if n not in set(keys)]
    rank = F.struct(*[cols.col(o) if isinstance(o, str) else o for o in order])
    if not rest:
        return df.select(*[cols.col(k) for k in keys]).distinct()
    best = (
        df.select(*[cols.col(k) for k in keys], F.struct(*[cols.col(n) for n in rest]).alias("_row"), rank.alias("_rank"))
        .groupBy(*[cols.col(k) for k in keys])
        .agg(pick("_row", "_rank").alias("_row"))
    )
    values = {k: cols.col(k) for k in keys} | {n: F.col("_row")[n].alias(n) for n in rest}
    return best.select(*[values[n] for n in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the least ``order`` per key; ``order`` must leave no ties."""
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` per key; ``order`` must leave no ties."""
    return _pick(df, keys, order, F.max_by)
