"""Field-number cells such as ``19, 21-23`` turned into one row per number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole import session
from ridgepole.functions import text
from ridgepole.operators import columns as cols

PIECE = 1 << 16


def explode_range(df: DataFrame, start: str, end: str, out: str, *, spread: bool = False) -> DataFrame:
    """One row per whole number in ``[start, end]``; reversed or null ranges give none.

    A range is cut into pieces of pieces, so no single array grows with the data;
    ``spread`` hands the pieces to different tasks.
    """
    s, e = cols.col(start).cast("bigint"), cols.col(end).cast("bigint")
    step = F.lit(PIECE).cast("bigint")
    large = df.where(s.isNotNull() & (e >= s)).select("*", F.explode(F.sequence(s, e, step * step)).alias("_from"))
    upto = F.least(F.col("_from") + (step * step - 1), e)
    pieces = large.select("*", F.explode(F.sequence(F.col("_from"), upto, step)).alias("_low"))
    if spread:
        pieces = session.spread(pieces, F.col("_low"))
    numbers = F.sequence(F.col("_low"), F.least(F.col("_low") + (PIECE - 1), e))
    return pieces.select(*[cols.col(n) for n in df.columns], F.explode(numbers).alias(out))


def explode_tokens(df: DataFrame, numbers: str, out: str = "token", position: str = "token_no") -> DataFrame:
    """Split a cell on commas, one trimmed token per row, with its place in the cell."""
    cell = text.plain_dashes(cols.col(numbers).cast("string"))
    return df.select("*", F.posexplode(F.split(cell, ",")).alias(position, out)).withColumn(out, text.strip(F.col(out)))


def _number(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("bigint")


def token_start(token: Column) -> Column:
    return _number(token, r"(\d+)")


def token_end(token: Column) -> Column:
    return F.coalesce(_number(token, r"\d+\s*-\s*(\d+)"), token_start(token))


_TRAILING_RANGE = r"(\d+)\s*-\s*(\d+)\s*$"


def expand_numbers(
    df: DataFrame, numbers: str, name: str | None = None, out: str = "Field #", position: str | None = None
) -> DataFrame:
    """One row per field number; ``numbers`` is replaced by ``out``.

    ``position`` names an extra column for the place of the token in its cell.

    With ``name`` given, a name that ends in a range as long as the token's range is
    numbered along with it (``Origin 1-5`` over ``19-23`` gives ``Origin 1`` .. ``Origin 5``)
    and ``NameNum`` holds that number; other names stay and ``NameNum`` is null.
    """
    rows = explode_tokens(df, numbers, "_token", "_token_no").select(
        "*", token_start(F.col("_token")).alias("_start"), token_end(F.col("_token")).alias("_end")
    )
    rows = explode_range(rows, "_start", "_end", "_number")
    others = [cols.col(n) for n in df.columns if n not in {numbers, name}]
    if position is not None:
        others.append(F.col("_token_no").alias(position))
    if name is None:
        return rows.select(F.col("_number").alias(out), *others)

    label = text.plain_dashes(cols.col(name).cast("string"))
    first, last = _number(label, _TRAILING_RANGE, 1), _number(label, _TRAILING_RANGE, 2)
    aligned = (last - first) == (F.col("_end") - F.col("_start"))
    name_num = F.when(aligned, first + F.col("_number") - F.col("_start"))
    prefix = text.strip(F.regexp_replace(label, r"\s*" + _TRAILING_RANGE, ""))
    rows = rows.select("*", name_num.alias("NameNum"), prefix.alias("_prefix"), label.alias("_label"))
    numbered = F.concat(F.col("_prefix"), F.lit(" "), F.col("NameNum").cast("string"))
    return rows.select(
        F.col("_number").alias(out),
        F.when(F.col("NameNum").isNotNull(), numbered).otherwise(F.col("_label")).alias(name),
        *others,
        F.col("NameNum"),
    )
