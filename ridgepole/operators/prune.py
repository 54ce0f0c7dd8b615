"""Keep the columns that still carry data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols


def live_columns(df: DataFrame, where: Column) -> list[str]:
    """Columns with at least one non-null value among the selected rows.

    One aggregate over the table; the driver receives a single row of counts.
    """
    counts = df.where(where).agg(*[F.count(cols.col(n)).alias(str(i)) for i, n in enumerate(df.columns)])
    row = counts.first()
    return [n for i, n in enumerate(df.columns) if row[i] > 0]


def recent_subset(df: DataFrame, year: str, rows_from: int, columns_from: int) -> DataFrame:
    """Rows from ``rows_from`` on, with the columns that are in use from ``columns_from`` on."""
    kept = live_columns(df, cols.col(year) >= columns_from)
    return df.where(cols.col(year) >= rows_from).select(*[cols.col(n) for n in kept])
