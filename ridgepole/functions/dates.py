"""Date repair."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The span a 64-bit nanosecond timestamp can hold.  Dates outside it
# are treated as unreadable.
EARLIEST = datetime.date(1677, 9, 22)
LATEST = datetime.date(2262, 4, 11)


def lenient_date(c: Column, fmt: str) -> Column:
    """Parse by format; unreadable or out-of-span text becomes null."""
    d = F.try_to_date(c, fmt)
    return F.when(d.between(F.lit(EARLIEST), F.lit(LATEST)), d)


def strict_date(c: Column, fmt: str) -> Column:
    """Parse by format; unreadable text fails the job with or without ANSI mode."""
    d = F.try_to_date(c, fmt)
    complaint = F.raise_error(F.concat(F.lit(f"not a {fmt} date: "), c.cast("string")))
    return F.when(d.isNotNull() | c.isNull(), d).otherwise(complaint.cast("date"))


def two_digit_year(d: Column) -> Column:
    """Dates read with a two-digit year: 69-99 belong to the 1900s (the POSIX pivot).

    The engine reads every two-digit year into 2000-2099.
    """
    return F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)


def not_after(d: Column, as_of: Column) -> Column:
    """Two-digit years may land a century late: a date after ``as_of`` moves back 100 years."""
    return F.when(d > as_of, F.add_months(d, -1200)).otherwise(d)
