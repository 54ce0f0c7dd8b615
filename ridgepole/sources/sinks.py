"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.functions import text
from ridgepole.operators import columns as cols
from ridgepole.operators.union import union_strict
from ridgepole.sources import files

FORMATS = ("parquet", "csv")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", overwrite: bool = True) -> str:
    """Parquet, or comma-separated text with a header."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}; use one of {FORMATS}")
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", True).option("escape", '"').csv(path)
    return path


def write_new(spark: SparkSession, df: DataFrame, path: str, overwrite: bool) -> bool:
    """Write Parquet unless a committed output is there already; tells whether it wrote.

    A folder left behind by a job that died has no commit marker and is replaced.
    """
    if not overwrite and files.is_complete(spark, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> str:
    """A folder for each value of ``by``; those that ``df`` holds are replaced, the others stay."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}; use one of {FORMATS}")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    if fmt == "csv":
        # blanks of a cell stay: a blank name is not a missing one
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = "|", overwrite: bool = True, compression: str = "gzip") -> str:
    """Delimited text, compressed unless told otherwise, one part file per task."""
    (
        df.write.mode("overwrite" if overwrite else "errorifexists")
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("compression", compression)
        .csv(path)
    )
    return path


def combined_name(spark: SparkSession, pattern: str, lowest: int | None, highest: int | None, enterprises: Sequence[str], fmt: str) -> str:
    """Name of the combined table of a pattern such as ``sf{year}c``."""
    years = [F.lit(y).cast("int") for y in (lowest, highest)]
    label = text.combined_label(F.lit(pattern.format(year="YYYY")), *years, F.lit(list(enterprises)), fmt)
    return spark.range(1).select(label).first()[0]


def write_hive(
    sources: Sequence[DataFrame] | Sequence[str],
    destination: str,
    partition_columns: Sequence[str] = ("year", "enterprise_flag"),
    overwrite: bool = False,
    spark: SparkSession | None = None,
) -> str:
    """Hive-partitioned Parquet from frames, or from Parquet files and folders.

    The rebalance hint groups rows by partition value, so folders get few files, and the
    adaptive planner splits a value that is far larger than the rest instead of leaving
    it to one task.  An old dataset goes only once the new one lies committed beside it.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    frames = [
        s if isinstance(s, DataFrame) else (spark or SparkSession.active()).read.option("recursiveFileLookup", True).parquet(s)
        for s in sources
    ]
    whole = union_strict(frames)
    session = whole.sparkSession
    if files.exists(session, destination) and not overwrite:
        raise FileExistsError(f"{destination} exists; pass overwrite=True to replace it")
    keys = [cols.col(c) for c in partition_columns]
    beside = f"{destination.rstrip('/')}.{uuid.uuid4().hex}.new"
    whole.hint("rebalance", *keys).write.partitionBy(*partition_columns).parquet(beside)
    files.publish(session, beside, destination)
    return destination
