"""Column types read from the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.functions import text
from ridgepole.operators import columns as cols


_KINDS = ("double", "bigint", "double", "string")


def _kind(c: Column) -> Column:
    """0 for null, then how wide a type the text needs: 1 whole, 2 number, 3 text."""
    return F.when(c.isNull(), 0).when(text.looks_whole(c), 1).when(text.looks_numeric(c), 2).otherwise(3).cast("byte")


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """``bigint``, ``double`` or ``string`` per text column, from all values.

    A single aggregate decides every column at once: the widest kind of its values.  A
    column without values is ``double`` (all missing).
    """
    names = list(columns or [n for n, t in df.dtypes if t == "string"])
    kinds = df.select(*[_kind(cols.col(n)).alias(f"k{i}") for i, n in enumerate(names)])
    row = kinds.agg(*[F.max(f"k{i}").alias(f"k{i}") for i in range(len(names))]).first()
    return {n: _KINDS[row[i] or 0] for i, n in enumerate(names)}


def infer_types_by(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> dict[str, dict[str, str]]:
    """``infer_types`` of the rows of each value of ``key``, in one pass: a row of kinds for each.

    For keys of which there are few, such as the files of one scan.
    """
    names = list(columns or [n for n, t in df.dtypes if t == "string" and n != key])
    kinds = df.select(cols.col(key).alias("_key"), *[_kind(cols.col(n)).alias(f"k{i}") for i, n in enumerate(names)])
    widest = kinds.groupBy("_key").agg(*[F.max(f"k{i}").alias(f"k{i}") for i in range(len(names))])
    return {r["_key"]: {n: _KINDS[r[f"k{i}"] or 0] for i, n in enumerate(names)} for r in widest.toLocalIterator()}


def _lenient(c: Column, kind: str) -> Column:
    return F.when(text.plain_number(c), c).try_cast(kind) if kind in ("double", "float") else c.try_cast(kind)


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts: text that does not fit becomes null."""
    return df.select(
        *[
            _lenient(cols.col(n), types[n]).alias(n) if n in types and types[n] != "string" else cols.col(n)
            for n in df.columns
        ]
    )
