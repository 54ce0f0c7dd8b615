"""Derived keys and filled-in columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.functions import text
from ridgepole.operators import columns as cols


def tract_key(state: Column, county: Column, tract: Column) -> Column:
    """Eleven-digit census tract key: 2 state, 3 county, 6 tract digits."""
    number = (
        state.cast("bigint") * F.lit(10**9) + county.cast("bigint") * F.lit(10**6) + tract.cast("bigint")
    )
    return text.zero_fill(number.cast("string"), 11)


def tract_key_by_vintage(
    year: Column, older: Sequence[Column], newer: Sequence[Column], switch_year: int = 2022
) -> Column:
    """Key from the older census columns before ``switch_year``, from the newer ones after.

    A missing part gives a null key.
    """
    return F.when(year < switch_year, tract_key(*older)).when(year >= switch_year, tract_key(*newer))


def fill_from_yearly(df: DataFrame, target: str, sources: Sequence[str]) -> DataFrame:
    """Collapse year-tagged columns into ``target`` (first non-null wins) and drop them.

    Absent sources are passed over.  A target that is there already keeps its values where
    no source has one; with neither sources nor target it is all null.
    """
    found = [n for n in (cols.find_column(df, [s]) for s in sources) if n is not None and n != target]
    values = [cols.col(n) for n in [*found, *([target] if target in df.columns else [])]]
    filled = F.coalesce(*values) if values else F.lit(None).cast("double")
    rest = [cols.col(n) for n in df.columns if n not in set(found) and n != target]
    return df.select(*rest, filled.alias(target))
