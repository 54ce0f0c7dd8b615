"""Text clean-up expressions and header spelling."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a fixed-width field may hold in place of a value.
MISSING_TOKENS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

BLANKS = " \t\r\n"
#: The same, as a class of a pattern.
BLANK_CLASS = r" \t\r\n"


def strip(c: Column) -> Column:
    """Drop blanks, tabs and line ends at both ends."""
    return F.trim(c, F.lit(BLANKS))


def strip_blanks(c: Column) -> Column:
    """Drop blanks and tabs at both ends (a field of a line holds no line end)."""
    return F.trim(c, F.lit(" \t"))


def plain_dashes(c: Column) -> Column:
    """En and em dashes become hyphens."""
    return F.translate(c, "–—", "--")


def label_key(c: Column) -> Column:
    """Lower case without blanks and underscores, for matching column labels."""
    return F.regexp_replace(F.lower(c), r"[\s_]+", "")


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def file_label(c: Column) -> Column:
    """Replace whatever is unsafe in a file name with ``_``."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_\-]", "_")


def combined_label(kind: Column, lowest: Column, highest: Column, enterprises: Column, fmt: str) -> Column:
    """File name of a combined table: kind, span of years and enterprises, joined by ``_``.

    Fixed value: the format, ``sfYYYYc_2018-2023_fhlmc-fnma.parquet``; without years the
    span reads ``all``.
    """
    span = F.coalesce(F.concat(lowest.cast("string"), F.lit("-"), highest.cast("string")), F.lit("all"))
    return F.concat(F.concat_ws("_", file_label(kind), span, F.array_join(F.array_sort(F.array_distinct(enterprises)), "-")), F.lit(f".{fmt}"))


def _number_start(c: Column) -> Column:
    """Signs, points, digits and blanks all sort before the colon, letters after it.

    A failing cast is dear (it raises inside), so this sifts out most text first.
    """
    return c < ":"


def looks_whole(c: Column) -> Column:
    """True for text that reads as a bigint."""
    return F.when(_number_start(c) & ~c.contains("."), c.try_cast("bigint").isNotNull()).otherwise(False)


def plain_number(c: Column) -> Column:
    """No type suffix: a cast would read codes like ``1D`` and ``2F`` as numbers."""
    ends = F.right(c, F.lit(1)).isin("d", "D", "f", "F")
    return ~ends | ~c.rlike("[0-9.][dDfF]$")  # inf is a number and ends in f too


def looks_numeric(c: Column) -> Column:
    """True for text that reads as a number, infinity included."""
    infinite = F.lower(c).isin("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
    return F.when(_number_start(c) & plain_number(c), c.try_cast("double").isNotNull()).otherwise(infinite)


def number_or_null(c: Column) -> Column:
    """Lenient double from text."""
    return F.when(_number_start(c) & plain_number(c), c).try_cast("double")


def whole_number(c: Column, what: str = "value") -> Column:
    """Strict text-to-bigint: bad text fails the job with or without ANSI mode."""
    parsed = c.try_cast("bigint")
    complaint = F.raise_error(F.concat(F.lit(f"{what} is not a whole number: "), c.cast("string")))
    return F.when(parsed.isNotNull() | c.isNull(), parsed).otherwise(complaint.cast("bigint"))


# --- header spelling (driver side: column names only) ---------------------------


def label_key_of(name: str) -> str:
    return re.sub(r"[\s_]+", "", str(name).lower())


def one_line(name: str) -> str:
    return str(name).replace("\n", " ")


def upper_words(name: str) -> str:
    return str(name).upper().replace("_", " ").strip()


def collapsed(name: str) -> str:
    """Spelling used to match names across years: single blanks, lower case."""
    return re.sub(r"\s+", " ", str(name)).strip().lower()
