"""Stacking tables whose columns and types drift between releases."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.operators import columns as cols

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """Narrowest type every input converts to without loss of rows."""
    kinds = [t for t in dict.fromkeys(types) if not isinstance(t, T.NullType)]
    if not kinds:
        return T.StringType()
    if len(kinds) == 1:
        return kinds[0]
    if any(isinstance(t, T.StringType) for t in kinds):
        return T.StringType()
    numbers = [t for t in kinds if not isinstance(t, T.BooleanType)]
    if numbers and all(isinstance(t, T.NumericType) for t in numbers):
        if all(type(t) in _WHOLE for t in numbers):
            return max(numbers, key=lambda t: _WHOLE.index(type(t)))
        if any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in numbers):
            return numbers[0] if len(numbers) == 1 else T.DoubleType()
        decimals = [t if isinstance(t, T.DecimalType) else T.DecimalType(20, 0) for t in numbers]
        scale = max(t.scale for t in decimals)
        digits = max(t.precision - t.scale for t in decimals)
        # no decimal holds more than 38 digits; text holds all of them
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.StringType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in kinds):
        stamps = [t for t in kinds if not isinstance(t, T.DateType)]
        return stamps[0] if len(stamps) == 1 else T.TimestampType()
    raise TypeError(f"no common type for {[t.simpleString() for t in kinds]}")


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; missing columns are null, types widen, duplicates stay.

    Column order is first seen.  The common types are worked out from the schemas
    before planning: letting the engine coerce bigint with string would turn the column
    into a number and fail on the first text.  Each branch stays a plain projection over
    its scan, so filters and pruning reach every branch.
    """
    if not frames:
        raise ValueError("nothing to combine")
    exact = frames[0].sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def key(name: str) -> str:
        return name if exact else name.lower()

    spelling: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            spelling.setdefault(key(field.name), field.name)
            kinds.setdefault(key(field.name), []).append(field.dataType)
    target = {k: common_type(v) for k, v in kinds.items()}

    def fitted(frame: DataFrame) -> DataFrame:
        present = {key(f.name): f for f in frame.schema.fields}
        out = []
        for k, data_type in target.items():
            field = present.get(k)
            if field is None:
                value = F.lit(None).cast(data_type)
            elif field.dataType == data_type:
                value = cols.col(field.name)
            elif isinstance(field.dataType, T.BooleanType) and isinstance(data_type, T.NumericType):
                value = cols.col(field.name).cast("int").cast(data_type)
            else:
                value = cols.col(field.name).cast(data_type)
            out.append(value.alias(spelling[k]))
        return frame.select(*out)

    return reduce(DataFrame.union, [fitted(f) for f in frames])


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables that must agree in column names, order and types."""
    if not frames:
        raise ValueError("nothing to combine")
    expected = frames[0].dtypes
    for frame in frames[1:]:
        if frame.dtypes != expected:
            raise ValueError(f"schemas differ: {expected} and {frame.dtypes}")
    return reduce(DataFrame.union, frames)
