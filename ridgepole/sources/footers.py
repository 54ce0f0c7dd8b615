"""What Parquet footers say about stored tables, so that values need not be read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols
from ridgepole.operators.prune import live_columns
from ridgepole.session import scratch_dir, spread
from ridgepole.sources import files, sinks

SCHEMA = "path string, name string, rows bigint, present bigint, low double, high double"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    from ridgepole.sources.archives import _open

    for batch in batches:
        for path in batch["path"]:
            system, where = _open(path)
            with system.open_input_file(where) as handle:
                footer = pq.ParquetFile(handle).metadata
            told = []
            for i in range(footer.num_columns):
                chunks = [footer.row_group(g).column(i) for g in range(footer.num_row_groups)]
                name = footer.schema.column(i).path
                stats = [c.statistics for c in chunks]
                known = all(s is not None and s.has_null_count for s in stats)
                present = sum(c.num_values - s.null_count for c, s in zip(chunks, stats)) if known else None
                # row groups without a value have no bounds
                bounds = [s for s, c in zip(stats, chunks) if s is not None and not (s.has_null_count and s.null_count == c.num_values)]
                numeric = bool(bounds) and all(s.has_min_max and isinstance(s.min, (int, float)) for s in bounds)
                low, high = (float(min(s.min for s in bounds)), float(max(s.max for s in bounds))) if numeric else (None, None)
                told.append((path, name, footer.num_rows, present, low, high))
            yield pd.DataFrame(told, columns=["path", "name", "rows", "present", "low", "high"]).astype({"present": "Int64"})


def footers(spark: SparkSession, table: str) -> DataFrame:
    """A row for each column of each file of a stored table: rows, values present, least and greatest number.

    Unknown where a file's statistics do not say.  Only the footers are read, side by side.
    """
    listed = files.list_files(spark, table).where(F.col("path").endswith(".parquet")).select("path")
    return spread(listed, F.col("path")).mapInPandas(_read, SCHEMA)


def live_columns_of(spark: SparkSession, table: str, year: str, since: int) -> list[str]:
    """Columns of a stored table with a value in a row of ``since`` or later.

    A file whose rows are all that late is answered by its footer, one whose rows are all
    earlier is passed over; only files on both sides of the limit, and those whose footers
    do not say enough, are scanned, and only for columns not known to be alive.
    """
    stored = sinks.write_table(footers(spark, table), f"{scratch_dir(spark, 'footers')}/told")
    told = spark.read.schema(SCHEMA).parquet(stored)
    of_year = told.where(F.col("name") == year).select("path", "low", "high", (F.col("present") == F.col("rows")).alias("whole"))
    each = told.groupBy("path").agg(F.max(F.col("present").isNull()).alias("unknown")).join(of_year, "path", "left")
    kind = (
        F.when(F.col("high") < since, "early")
        .when(~F.col("unknown") & F.col("whole") & (F.col("low") >= since), "late")
        .otherwise("mixed")
    )
    sorted_out = each.select("path", kind.alias("kind"))
    # as many rows as the table has columns
    present = told.join(sorted_out.where("kind = 'late'"), "path").where("present > 0").select("name").distinct()
    whole = spark.read.parquet(table)
    known = {r["name"] for r in present.collect()}
    # nested columns have a footer entry for each of their leaves
    alive = {n for n in whole.columns if n in known or any(k.startswith(n + ".") for k in known)}
    # as many rows as the table has files
    mixed = [r["path"] for r in sorted_out.where("kind = 'mixed'").toLocalIterator()]
    rest = [n for n in whole.columns if n not in alive]
    if mixed and rest:
        scanned = spark.read.schema(whole.schema).parquet(*mixed)
        asked = scanned.where(cols.col(year) >= since).select(*[cols.col(n) for n in rest])
        alive |= set(live_columns(asked, F.lit(True)))
    return [n for n in whole.columns if n in alive]


def recent_subset_of(spark: SparkSession, table: str, year: str, rows_from: int, columns_from: int) -> DataFrame:
    """``recent_subset`` of a stored table, with footers read in the place of most values."""
    kept = live_columns_of(spark, table, year, columns_from)
    whole = spark.read.parquet(table)
    return whole.where(cols.col(year) >= rows_from).select(*[cols.col(n) for n in kept])
