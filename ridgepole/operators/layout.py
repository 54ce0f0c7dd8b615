"""Fixed-width layouts: from dictionary rows, or from the text itself."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.functions import text
from ridgepole.operators import columns as cols
from ridgepole.operators.running import Total, running_totals


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    width: int
    type: str = "string"


@dataclass(frozen=True)
class Layout:
    """Ordered fields of one record; positions count from zero."""

    fields: tuple[Field, ...]

    @classmethod
    def of(cls, pairs: Sequence[tuple[str | None, int]], separator_width: int = 1) -> "Layout":
        """Lay out ``(name, width)`` pairs one after the other.

        A missing name reads ``None``, a blank one ``unnamed``; repeated names are
        numbered ``_2``, ``_3`` until unique.
        """
        if separator_width < 0:
            raise ValueError("separator_width must be >= 0")
        if not pairs:
            raise ValueError("the dictionary holds no usable field width")
        taken: set[str] = set()
        given = [("None" if n is None else n.strip()) or "unnamed" for n, _ in pairs]
        fields, cursor = [], 0
        seen: dict[str, int] = {}
        for name, (_, width) in zip(given, pairs):
            seen[name] = seen.get(name, 0) + 1
            unique = name if seen[name] == 1 else f"{name}_{seen[name]}"
            while unique in taken:
                seen[name] += 1
                unique = f"{name}_{seen[name]}"
            taken.add(unique)
            fields.append(Field(unique, cursor, int(width)))
            cursor += int(width) + separator_width
        return cls(tuple(fields))

    def typed(self, types: Mapping[str, str]) -> "Layout":
        return Layout(tuple(replace(f, type=types.get(f.name, f.type)) for f in self.fields))

    def renamed(self, names: Sequence[str]) -> "Layout":
        if len(names) != len(self.fields):
            raise ValueError(f"{len(names)} names for {len(self.fields)} fields")
        return Layout(tuple(replace(f, name=n) for f, n in zip(self.fields, names)))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def line_length(self) -> int:
        return max(f.start + f.width for f in self.fields)

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{cols.quoted(f.name)} {f.type}" for f in self.fields))


def usable_fields(df: DataFrame, name: str = "Field Name", width: str = "Field Width", keep: Sequence[str] = ()) -> DataFrame:
    """Name and width of each dictionary row; rows without a readable width are dropped."""
    for needed in (name, width):
        if needed not in df.columns:
            raise ValueError(f"the dictionary has no column {needed!r}; it has {df.columns}")
    return df.select(
        *[cols.col(k) for k in keep],
        cols.col(name).cast("string").alias("column_name"),
        cols.col(width).try_cast("bigint").alias("column_width"),
    ).where(F.col("column_width").isNotNull())


def describe_fields(
    df: DataFrame, keys: Sequence[str], order: str, separator_width: int = 1, blocks: int | None = None
) -> DataFrame:
    """Final name and start position of every field, for many documents at once.

    Names are stripped, the nameless named, and repeats within a document numbered in
    field order; ``column_start`` is the sum of all earlier widths and separators.  Both
    are blocked running totals: neither a huge document nor a name shared by a third of
    all rows ends up in one task.
    """
    if separator_width < 0:
        raise ValueError("separator_width must be >= 0")
    stripped = text.strip(F.coalesce(F.col("column_name"), F.lit("None")))
    base = df.withColumn("_base", F.when(stripped == "", F.lit("unnamed")).otherwise(stripped))
    counted = running_totals(
        base,
        order,
        [
            Total([*keys, "_base"], F.lit(1), "_nth"),
            Total(keys, F.col("column_width") + F.lit(separator_width), "column_start", inclusive=False),
        ],
        blocks,
    )
    numbered = F.concat(F.col("_base"), F.lit("_"), F.col("_nth").cast("string"))
    unique = F.when(F.col("_nth") > 1, numbered).otherwise(F.col("_base")).alias("column_name")
    return counted.select(*[unique if n == "column_name" else cols.col(n) for n in df.columns], "column_start")


def collect_layout(df: DataFrame, order: str, separator_width: int = 1) -> Layout:
    """Bring the fields of one record description to the driver.

    They become the plan's own columns, so they are as many as the table is wide.
    """
    rows = df.orderBy(order).collect()
    return Layout.of([(r["column_name"], r["column_width"]) for r in rows], separator_width)


_LATIN = "ISO-8859-1"
#: Bytes of lines looked at together.
_PIECE = 1 << 22


def _used_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The positions that any line of a task uses, once each."""
    used = np.zeros(0, bool)
    for batch in batches:
        lines = batch.column(0).cast(pa.large_binary())
        if not len(lines):
            continue
        offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
        data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)
        longest = int(np.diff(offsets).max())
        if longest > len(used):
            used = np.concatenate([used, np.zeros(longest - len(used), bool)])
        step = max(1, _PIECE // max(longest, 1))
        for first in range(0, len(lines), step):
            ends = offsets[first : first + step + 1]
            part = data[ends[0] : ends[-1]]
            # blanks and tabs separate; everything else uses its position
            at = np.flatnonzero((part != 0x20) & (part != 0x09)) + ends[0]
            used[at - ends[np.searchsorted(ends, at, side="right") - 1]] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(used))], names=["_pos"])


def column_spans(lines: DataFrame, value: str = "value") -> DataFrame:
    """Find fields in undescribed text: runs of positions not blank in every line.

    Each task goes over the bytes of its lines as arrays, batch by batch, and hands on the
    positions that are used: as many rows as a line is long, however many lines there are.
    Returns ``start`` and ``width`` per field.
    """
    c = cols.col(value)
    if not isinstance(lines.schema[value].dataType, T.BinaryType):
        # one byte per character; which character it was does not matter
        c = F.encode(F.regexp_replace(c, "[^\\u0000-\\u00ff]", "x"), _LATIN)
    positions = lines.select(c.alias("_raw")).mapInArrow(_used_positions, "_pos bigint").distinct()
    # one row per used position of a line: the group is as small as a line is long
    in_line = Window.partitionBy(F.lit(1)).orderBy("_pos")
    runs = positions.select("_pos", (F.col("_pos") - F.row_number().over(in_line)).alias("_run"))
    return runs.groupBy("_run").agg(
        F.min("_pos").cast("bigint").alias("start"),
        (F.max("_pos") - F.min("_pos") + 1).cast("bigint").alias("width"),
    ).select("start", "width")


def infer_layout(lines: DataFrame, names: Sequence[str] | None = None, value: str = "value") -> Layout:
    """Layout from the text itself, with positional ``names``."""
    spans = column_spans(lines, value).orderBy("start").collect()
    found = Layout(tuple(Field(f"column_{i + 1}", s["start"], s["width"]) for i, s in enumerate(spans)))
    return found.renamed(names) if names is not None else found
