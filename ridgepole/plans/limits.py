"""County loan limits."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.functions import paths, text
from ridgepole.operators import columns as cols
from ridgepole.operators.infer import infer_types_by, with_types
from ridgepole.operators.union import union_relaxed
from ridgepole.sources import files, sinks, tables


# Fixed value: title rows above the header of every limits sheet.
TITLE_ROWS = 1


def limit_year(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^FullCountyLoanLimitList(\d{4})_HERA", 1), F.lit("")).cast("int")


def first_path_per_year(listing: DataFrame) -> DataFrame:
    """The first limits sheet of each year, in name order."""
    named = listing.select("path", limit_year(paths.base_name(F.col("path"))).alias("year"))
    return named.where(F.col("year").isNotNull()).groupBy("year").agg(F.min("path").alias("path"))


def harmonise_limits(sheet: DataFrame, year: int) -> DataFrame:
    return cols.tag(cols.respell(sheet, text.one_line), Year=year)


class LoanLimits:
    """Yearly county limit sheets combined into one table."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def combine(self, data_folder: str, save_folder: str, min_year: int = 2011, max_year: int = 2024) -> str | None:
        listing = files.list_files(self.spark, data_folder, recursive=False)
        chosen = first_path_per_year(listing).where(F.col("year").between(min_year, max_year))
        # one row for each year
        sheets = [r["path"] for r in chosen.orderBy("year").toLocalIterator()]
        titles = {unquote(p).rsplit("/", 1)[-1]: TITLE_ROWS for p in sheets}
        frames = []
        for _, same in tables.read_sheets(self.spark, sheets, titles) if sheets else []:
            year = limit_year(paths.base_name(F.col("_file"))).alias("Year")
            names = [n for n in same.columns if n != "_file"]
            # types are those of each sheet's own values; sheets of equal types stay together
            types = infer_types_by(same, "_file", names)
            by_types: dict[tuple, list[str]] = {}
            for file, own in types.items():
                by_types.setdefault(tuple(own.items()), []).append(file)
            for own, of in by_types.items():
                part = with_types(same.where(F.col("_file").isin(of)), dict(own))
                frames.append(cols.respell(part.select(*[cols.col(n) for n in names], year), text.one_line))
        if not frames:
            return None
        target = f"{save_folder}/conforming_loan_limits_{min_year}-{max_year}.csv.gz"
        return sinks.write_delimited(union_relaxed(frames), target, sep=",")
