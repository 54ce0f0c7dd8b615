"""Delimited, Parquet and spreadsheet-export tables."""

from __future__ import annotations

import csv
import io
import posixpath
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.operators import columns as cols
from ridgepole.operators.layout import Layout, collect_layout, usable_fields
from ridgepole.sources import files


#: Folder of a store of many dictionaries: ``store.<format>/year=<year>/document=<name>``.
STORE = "store"
_STORED = re.compile(rf"/{STORE}\.(csv|parquet)/year=")
#: Column that holds the order of a stored dictionary's fields.
FIELD_ORDER = "field_order"


def read_dictionary(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A parsed data dictionary, in the order of its fields (``_order``).

    Cells hold line breaks, so the CSV form is read whole-record; a dictionary is one
    small file and one task reads it.  Fields come in file order; a dictionary of a store
    names their order itself.
    """
    stored = _STORED.search(path)
    kind = (fmt or (stored.group(1) if stored else posixpath.splitext(path)[1].lstrip("."))).lower()
    if kind == "csv":
        df = (
            spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        )
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"a dictionary is csv or parquet, not {kind!r}")
    if FIELD_ORDER in df.columns:
        return df.withColumn("_order", F.col(FIELD_ORDER).cast("bigint")).drop(FIELD_ORDER)
    # of several part files the names give the order, inside a file the rows; a dictionary
    # is as long as a record is wide, so one window holds it
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    in_order = Window.partitionBy(F.lit(1)).orderBy("_file", "_at")
    return placed.withColumn("_order", (F.row_number().over(in_order) - 1).cast("bigint")).drop("_file", "_at")


def store_path(root: str, fmt: str) -> str:
    return f"{root}/{STORE}.{fmt}"


def read_store(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All dictionaries of a store, with ``year`` and ``document``.

    Document names stay text, whatever they look like; filters on the two are answered by
    the folders' names.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    found = reader.format(fmt).load(store_path(root, fmt)).schema
    kinds = {"document": T.StringType(), "year": T.IntegerType(), FIELD_ORDER: T.LongType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    return reader.schema(schema).format(fmt).load(store_path(root, fmt))


def read_layout(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    name: str = "Field Name",
    width: str = "Field Width",
    separator_width: int = 1,
) -> Layout:
    """The layout a dictionary file describes; fields stay in file order."""
    fields = usable_fields(read_dictionary(spark, path, fmt), name, width, keep=("_order",))
    return collect_layout(fields, "_order", separator_width)


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], sep: str = "|", schema: T.StructType | str | None = None
) -> DataFrame:
    """Delimited text with a header, gzip by suffix.

    Without a schema every column is text; see ``infer_types`` for reading types from
    all values.  A gzip file cannot be split, so many part files are better than one.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_name_map(spark: SparkSession, path: str) -> dict[str, str]:
    """A header-less two-column file of old and new column names."""
    rows = spark.read.option("escape", '"').csv(path).collect()
    return {str(r[0]): str(r[1]) for r in rows}


ROW = "_row"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the records of each file from 0; ``_file`` comes first.

    A file of whole records is read by one task from its start, one file after the other.
    """
    name, number = None, 0
    for batch in batches:
        files_here = batch.column(0)
        for first, stop in _runs(files_here):
            if files_here[first].as_py() != name:
                name, number = files_here[first].as_py(), 0
            part = batch.slice(first, stop - first)
            rows = pa.array(range(number, number + stop - first), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, rows], names=[*part.schema.names, ROW])
            number += stop - first


def _runs(values: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal values."""
    if len(values):
        coded = values.dictionary_encode().indices.to_numpy()
        ends = [*(np.flatnonzero(np.diff(coded)) + 1).tolist(), len(values)]
        yield from zip([0, *ends[:-1]], ends)


def _numbered_records(spark: SparkSession, paths: Sequence[str], schema: T.StructType, corrupt: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("escape", '"').schema(schema)
    if corrupt is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    records = reader.csv(list(paths)).select(F.col("_metadata.file_path").alias("_file"), "*")
    return records.mapInArrow(_numbered, T.StructType([*records.schema.fields, T.StructField(ROW, T.LongType())]))


def _skipped(skip_rows: Mapping[str, int]) -> Column:
    """Title rows of a record's file; ``skip_rows`` names only files that have some."""
    titled = [(name, n) for name, n in skip_rows.items() if n]
    if not titled:
        return F.lit(0)
    known = F.create_map(*[F.lit(x) for pair in titled for x in pair])
    base = F.regexp_extract(F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B"))), r"([^/]*)$", 1)
    return F.coalesce(F.try_element_at(known, base), F.lit(0))


def read_sheets(spark: SparkSession, paths: Sequence[str], skip_rows: Mapping[str, int] | None = None) -> list[tuple[list[str], DataFrame]]:
    """Exported worksheets by header: sheets of equal headers are one scan, however many they are.

    ``skip_rows`` gives the title rows above the header by file name.  One pass over all
    sheets reads their header records (the driver gets one for each sheet); then each
    signature is one scan with the columns' names, all text, and ``_file``.  Headers may
    hold line breaks.  A worksheet is bounded (about a million rows) and its quoted cells
    may span lines, so one task reads one sheet, and many sheets are read side by side.
    Returned in the order of each signature's first path, with its paths.
    """
    skipped = _skipped(skip_rows or {})
    # with one declared column, the text of every wider record lands in the second
    heads = _numbered_records(spark, paths, T.StructType().add("_first", "string").add("_record", "string"), "_record").where(F.col(ROW) == skipped)
    found = {unquote(r["_file"]): r for r in heads.toLocalIterator()}
    signatures: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        row = next((found[k] for k in (path, *_spellings(path)) if k in found), None)
        if row is None:
            raise ValueError(f"{path} has no header row after its title rows")
        given = next(csv.reader(io.StringIO(row["_record"]))) if row["_record"] is not None else [row["_first"]]
        signatures.setdefault(tuple(name or f"Unnamed: {i}" for i, name in enumerate(given)), []).append(path)
    frames = []
    for names, own in signatures.items():
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        rows = _numbered_records(spark, own, schema).where(F.col(ROW) > skipped).drop(ROW)
        frames.append((own, rows.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], "_file")))
    return frames


def read_sheet(spark: SparkSession, path: str, skip_rows: int = 0) -> DataFrame:
    """One exported worksheet whose header follows ``skip_rows`` title rows."""
    ((_, sheet),) = read_sheets(spark, [path], {path.rsplit("/", 1)[-1]: skip_rows})
    return sheet.drop("_file")


def _spellings(path: str) -> list[str]:
    """A local path as file listings and as file metadata write it."""
    bare = re.sub(r"^file:/+", "/", path)
    return [f"file://{bare}", f"file:{bare}"] if bare.startswith("/") else []


def bank_export_name(year: int) -> str:
    return f"{year}_PUDB_EXPORT_1231{str(year)[2:]}.csv"


def read_bank_export(spark: SparkSession, folder: str, year: int, schema: T.StructType | str | None = None) -> DataFrame:
    """The acquisitions file of one year; a missing year is an error."""
    path = f"{folder}/{bank_export_name(year)}"
    if not files.exists(spark, path):
        raise FileNotFoundError(path)
    return read_delimited(spark, path, sep=",", schema=schema)


ENTERPRISES = ("fnma", "fhlmc")


def checked_enterprises(enterprises: Iterable[str]) -> list[str]:
    chosen = sorted({e.lower() for e in enterprises})
    if not set(chosen) <= set(ENTERPRISES):
        raise ValueError(f"enterprises must be among {ENTERPRISES}: {chosen}")
    return chosen


def converted_paths(
    spark: SparkSession, root: str, pattern: str, enterprises: Iterable[str], years: Iterable[int]
) -> list[tuple[int, str, str]]:
    """``(year, enterprise, path)`` of the converted tables of one kind that exist."""
    chosen = checked_enterprises(enterprises)
    found = []
    for year in sorted(set(years)):
        stem = pattern.replace("{year}", str(year))
        for enterprise in chosen:
            path = f"{root}/{year}/{enterprise}_{stem}.parquet"
            if files.exists(spark, path):
                found.append((year, enterprise, path))
    if not found:
        raise FileNotFoundError(f"nothing converted matches {pattern!r} for {sorted(set(years))} and {chosen} under {root}")
    return found


_TABLE_FOLDER = re.compile(r"(\.(?:csv|parquet|pq))/[^/]*$", re.IGNORECASE)


def read_bronze(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None
) -> list[DataFrame]:
    """Frames of the readable bronze files (CSV or Parquet); other files are passed over.

    All CSV files are one scan, with one schema (given or inferred) they must all match.
    """
    if not paths:
        raise ValueError("no bronze files to read")
    # part files of one written table share a schema: read the folder, not each part
    tables = list(dict.fromkeys(_TABLE_FOLDER.sub(r"\1", p) for p in paths))
    csvs = [p for p in tables if p.lower().endswith(".csv")]
    parquets = [p for p in tables if p.lower().endswith((".parquet", ".pq"))]
    frames: list[DataFrame] = []
    if csvs:
        # headers of every file are checked against the schema instead of trusted
        reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        frames.append(reader.csv(csvs))
    frames += [spark.read.parquet(p) for p in parquets]
    if not frames:
        raise ValueError("none of the bronze files can be read")
    return frames


def rename_and_drop(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return cols.drop_unnamed(cols.rename_by_map(df, names))
