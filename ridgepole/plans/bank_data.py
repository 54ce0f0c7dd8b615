"""Home-loan-bank acquisitions and members."""

from __future__ import annotations

import datetime
import posixpath
import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.functions import dates, paths, text, years
from ridgepole.operators import columns as cols
from ridgepole.operators.infer import infer_types, with_types
from ridgepole.operators.prune import recent_subset
from ridgepole.operators.rules import apply_rules
from ridgepole.operators.union import union_relaxed
from ridgepole.plans import rule_tables
from ridgepole.session import tune
from ridgepole.sources import files, sinks, tables
from ridgepole.sources.footers import recent_subset_of


def clean_acquisitions(df: DataFrame, file_year: int, names: Mapping[str, str], changed: int = rule_tables.UNITS_CHANGED) -> DataFrame:
    """Rename, drop fillers and run all rules of one yearly file as one projection."""
    renamed = tables.rename_and_drop(df, names)
    return apply_rules(renamed, rule_tables.acquisition_rules(file_year, changed), drop=("Year",))


def repair_member_dates(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """Dates of sheets that give them as text with two-digit years; none lies after ``as_of``."""
    readers = {"APPROVAL DATE": dates.strict_date, "MEM DATE": dates.lenient_date}
    repaired = {
        name: dates.not_after(dates.two_digit_year(read(cols.col(name), "M/d/yy")), F.lit(as_of))
        for name, read in readers.items()
        if name in df.columns
    }
    return df.withColumns(repaired)


def quarter_of(file_name: str) -> tuple[int, int]:
    """``(year, quarter)`` in a sheet's name."""
    found = re.match(r"[^Q]*Q(\d)(\d{4})", file_name)
    if not found:
        raise ValueError(f"{file_name!r} does not name a quarter")
    return int(found.group(2)), int(found.group(1))


def named_members(sheet: DataFrame) -> DataFrame:
    return cols.rename_by_map(cols.respell(sheet, text.upper_words), rule_tables.MEMBER_NAMES)


def harmonise_members(sheet: DataFrame, file_name: str, as_of: datetime.date) -> DataFrame:
    """One quarterly sheet: header spelling, provenance, date repair."""
    year, quarter = quarter_of(file_name)
    tagged = cols.tag(named_members(sheet), **{"SOURCE FILE": file_name, "YEAR": year, "QUARTER": quarter})
    return tagged if (year, quarter) < rule_tables.TEXT_DATES_FROM else repair_member_dates(tagged, as_of)


def harmonise_member_sheets(sheets: DataFrame, as_of: datetime.date, text_dates: bool) -> DataFrame:
    """Quarterly sheets of one header, told apart by ``_file``, all before or all since dates became text."""
    name = F.url_decode(F.replace(paths.base_name(F.col("_file")), F.lit("+"), F.lit("%2B")))
    own = [n for n in sheets.columns if n != "_file"]
    renamed = named_members(sheets.select(*[cols.col(n) for n in own]))
    tagged = sheets.select(
        *[cols.col(n).alias(new) for n, new in zip(own, renamed.columns)],
        name.alias("SOURCE FILE"), years.quarter_year_in_name(name).alias("YEAR"), years.quarter_in_name(name).alias("QUARTER"),
    )
    return repair_member_dates(tagged, as_of) if text_dates else tagged


class BankData:
    """Acquisitions (one CSV per year) and members (one exported sheet per quarter)."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = tune(spark)

    # --- acquisitions ---

    def load_acquisitions(
        self, data_folder: str, year: int, names: Mapping[str, str], schema: T.StructType | str | None = None
    ) -> DataFrame:
        """One cleaned year.  Without a schema the types are read from all values."""
        raw = tables.rename_and_drop(tables.read_bank_export(self.spark, data_folder, year, schema), names)
        if schema is None:
            numeric = [n for n in raw.columns if n not in rule_tables.ACQUISITION_TEXT]
            raw = with_types(raw, infer_types(raw, numeric))
        return clean_acquisitions(raw, year, {})

    def import_acquisitions(
        self,
        data_folder: str,
        save_folder: str,
        name_map: str,
        min_year: int = 2009,
        max_year: int = 2022,
        schema: T.StructType | str | None = None,
    ) -> list[str]:
        names = tables.read_name_map(self.spark, name_map)
        written = []
        for year in range(min_year, max_year + 1):
            cleaned = self.load_acquisitions(data_folder, year, names, schema)
            written.append(sinks.write_table(cleaned, f"{save_folder}/fhlb_acquisitions_{year}.parquet"))
        return written

    def combine_acquisitions(self, data_folder: str, save_folder: str, min_year: int = 2009, max_year: int = 2022) -> list[str]:
        """All years together, and the columns still in use for 2018 on."""
        frames = [
            self.spark.read.parquet(f"{data_folder}/fhlb_acquisitions_{year}.parquet")
            for year in range(min_year, max_year + 1)
        ]
        everything = f"{save_folder}/fhlb_acquisitions_{min_year}-{max_year}.parquet"
        recent = f"{save_folder}/fhlb_acquisitions_2018-{max_year}.parquet"
        whole = union_relaxed(frames)
        pruned = max_year > 2018 and "Loan Acquisition Date" in whole.columns
        written = []
        # both tables share one name when the years start in 2018; the subset is kept then
        if not (pruned and recent == everything):
            written.append(sinks.write_table(whole, everything))
        if pruned:
            limits = {"rows_from": 2018, "columns_from": 2019}
            if written:  # the stored table's footers tell most of what is in use
                subset = recent_subset_of(self.spark, everything, "Loan Acquisition Date", **limits)
            else:
                subset = recent_subset(whole, "Loan Acquisition Date", **limits)
            written.append(sinks.write_table(subset, recent))
        return written

    # --- members ---

    def member_sheets(self, folder: str, min_year: int, max_year: int) -> list[str]:
        listing = files.list_files(self.spark, folder, recursive=False)
        name = paths.base_name(F.col("path"))
        wanted = listing.where(name.rlike(r"^FHLB_Members.*\.csv$")).where(
            years.quarter_year_in_name(name).between(min_year, max_year)
        )
        return [r["path"] for r in wanted.orderBy("path").toLocalIterator()]

    def combine_members(
        self,
        data_folder: str,
        save_folder: str,
        min_year: int = 2009,
        max_year: int = 2023,
        as_of: datetime.date | None = None,
        skip_rows: Mapping[str, int] = rule_tables.MEMBER_SKIP_ROWS,
    ) -> str | None:
        """One pipe-separated table of all quarterly sheets."""
        limit = as_of or datetime.date.today()
        found = self.member_sheets(data_folder, min_year, max_year)
        if not found:
            return None
        bare = lambda p: unquote(posixpath.basename(p))
        titles = {bare(p): skip_rows.get(posixpath.splitext(bare(p))[0], 0) for p in found}
        # sheets before and since dates became text are read apart
        since = {p: quarter_of(bare(p)) >= rule_tables.TEXT_DATES_FROM for p in found}
        frames = []
        for text_dates in (False, True):
            own = [p for p in found if since[p] == text_dates]
            for first, same in tables.read_sheets(self.spark, own, titles) if own else []:
                frames.append((first[0], harmonise_member_sheets(same, limit, text_dates)))
        frames = [frame for _, frame in sorted(frames, key=lambda f: found.index(f[0]))]
        combined = cols.drop_unnamed(union_relaxed(frames))
        return sinks.write_delimited(combined, f"{save_folder}/fhlb_members_combined_{min_year}-{max_year}.csv.gz")

