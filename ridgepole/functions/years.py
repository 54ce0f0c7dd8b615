"""Years and quarters in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plausible release years.
FIRST_YEAR = 1990
LAST_YEAR = 2035


def year_in_name(name: Column) -> Column:
    """Latest plausible four-digit year in a name, else null.

    A year is a maximal run of exactly four digits, so ``20230`` holds none.
    """
    runs = F.split(name, "[^0-9]+")
    years = F.transform(F.filter(runs, lambda r: F.length(r) == 4), lambda r: r.try_cast("int"))
    return F.array_max(F.filter(years, lambda y: y.between(FIRST_YEAR, LAST_YEAR)))


def year_folder(name: Column) -> Column:
    """A folder name read as a year; null unless it is one in the plausible range."""
    year = F.when(name.rlike(r"^\s*\d{4}\s*$"), name).try_cast("int")
    return F.when(year.between(FIRST_YEAR, LAST_YEAR), year)


def quarter_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^[^Q]*Q(\d)(\d{4})", 1), F.lit("")).cast("int")


def quarter_year_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^[^Q]*Q(\d)(\d{4})", 2), F.lit("")).cast("int")
