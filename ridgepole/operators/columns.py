"""Header-level operators: rename, drop, tag."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.functions import text


def quoted(name: str) -> str:
    """Back-ticked name: source headers hold blanks, dots and brackets."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def respell(df: DataFrame, *spellings: Callable[[str], str]) -> DataFrame:
    """Apply header spellings (``text.one_line``, ``text.upper_words``) to every column."""
    names = df.columns
    for spelling in spellings:
        names = [spelling(n) for n in names]
    return df.toDF(*names)


def rename_by_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new in one step; absent names are ignored."""
    return df.toDF(*[names.get(n, n) for n in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop the filler columns spreadsheets leave behind (``Unnamed: 3``)."""
    return df.select(*[col(n) for n in df.columns if "unnamed" not in n.lower()])


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    gone = set(names)
    return df.select(*[col(n) for n in df.columns if n not in gone])


def tag(df: DataFrame, **values: Column | int | str | None) -> DataFrame:
    """Add provenance columns, replacing any of the same name."""
    columns = {
        name: value if isinstance(value, Column) else F.lit(value if value is not None else None)
        for name, value in values.items()
    }
    return df.withColumns(columns)


def find_column(df: DataFrame, aliases: Iterable[str]) -> str | None:
    """First column spelled like one of ``aliases``, ignoring case, breaks and repeated blanks."""
    present = {text.collapsed(n): n for n in reversed(df.columns)}
    for alias in aliases:
        found = present.get(text.collapsed(alias))
        if found is not None:
            return found
    return None


def find_by_label(df: DataFrame, labels: Iterable[str]) -> str | None:
    """First column whose label key (no case, blanks, underscores) is among ``labels``."""
    wanted = set(labels)
    return next((n for n in df.columns if text.label_key_of(n) in wanted), None)
