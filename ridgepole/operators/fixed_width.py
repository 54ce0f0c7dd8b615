"""Fixed-width lines to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.functions import text
from ridgepole.operators import columns as cols
from ridgepole.operators.infer import infer_types
from ridgepole.operators.layout import Field, Layout
from ridgepole.session import tune


def _cut(line: Column, field: Field, is_bytes: bool) -> Column:
    """The text of a field.

    Bytes of a single-byte encoding are cut by offset, whatever the position.  Text has
    to be walked from its start to find the n-th character, which makes late fields dear.
    """
    part = F.substring(line, field.start + 1, field.width)
    if not is_bytes:
        return part
    # only text needs its characters decoded; numbers and dates are ASCII
    return F.decode(part, "ISO-8859-1") if field.type == "string" else part.cast("string")


def _number(part: Column, field: Field, missing: tuple[str, ...]) -> Column:
    """Lenient cast of a cut field, null for text that is no value of the type.

    Blank fields are common and a failing cast is dear, so they never reach the cast.
    """
    given = ~part.isin("", " " * field.width)
    if field.type in ("double", "float"):
        given &= text.plain_number(F.rtrim(part))
    value = F.when(given, part).try_cast(field.type)
    if field.type in ("double", "float") and "NaN" in missing:
        return F.nanvl(value, F.lit(None).cast(field.type))
    return value


def _has_field(line: Column, layout: Layout, is_bytes: bool) -> Column:
    """True when any field of a line holds more than blanks.

    Mostly the first thing on a line stands in its first field, and only the left end is
    looked at.  Else one pattern looks for a non-blank among the fields' places: what
    stands between them or behind the last does not count.
    """
    fields = sorted((f for f in layout.fields if f.width > 0), key=lambda f: f.start)
    if not fields:
        return F.lit(False)
    left = line.cast("string") if is_bytes else line
    rest = F.ltrim(left, F.lit(text.BLANKS))
    lead = F.octet_length(left) - F.octet_length(rest)  # blanks are single bytes
    in_first = (lead >= fields[0].start) & (lead < fields[0].start + fields[0].width)
    places = "|".join(f".{{{f.start},{f.start + f.width - 1}}}[^{text.BLANK_CLASS}]" for f in fields)
    whole = F.decode(line, "ISO-8859-1") if is_bytes else line
    return (rest != "") & (in_first | whole.rlike(f"^(?s:{places})"))


def parse_lines(
    lines: DataFrame,
    layout: Layout,
    value: str = "value",
    keep: Sequence[str] = (),
    missing: tuple[str, ...] = text.MISSING_TOKENS,
) -> DataFrame:
    """Cut each line by ``layout``, strip, null blanks and missing tokens, cast leniently.

    ``value`` holds text, or the bytes of latin-1 lines (what ``read_lines`` gives, and
    the faster form).  Lines whose fields are all blank are dropped; a line too short for a
    field gives null.
    Everything is projection, so fields nobody selects are never cut out.  The session is
    tuned, as a record's fields fused into one large method would run interpreted.
    """
    tune(lines.sparkSession)
    line = cols.col(value)
    is_bytes = isinstance(lines.schema[value].dataType, T.BinaryType)
    # a cast can stand in for the token test as long as no token reads as a value
    tokens_are_known = set(missing) <= set(text.MISSING_TOKENS)
    direct = {f.name for f in layout.fields if f.type != "string" and tokens_are_known}

    def first(field: Field) -> Column:
        part = _cut(line, field, is_bytes)
        return part if field.name in direct else text.strip_blanks(part)

    def second(field: Field) -> Column:
        c = cols.col(field.name)
        if field.name in direct:
            return _number(c, field, missing)
        given = F.when(~c.isin("", *missing), c)
        if field.type in ("double", "float"):
            given = F.when(text.plain_number(given), given)
        return given if field.type == "string" else given.try_cast(field.type)

    kept = [cols.col(k) for k in keep]
    cut = lines.where(_has_field(line, layout, is_bytes)).select(*kept, *[first(f).alias(f.name) for f in layout.fields])
    # a second projection, so a stripped field is computed once though it is used twice
    return cut.select(*kept, *[second(f).alias(f.name) for f in layout.fields])


def parse_lines_inferred(lines: DataFrame, layout: Layout, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """As ``parse_lines``, with column types read from all values in one extra pass.

    Codes lose their leading zeros this way; prefer declared types.
    """
    as_text = layout.typed(dict.fromkeys(layout.names, "string"))
    types = infer_types(parse_lines(lines, as_text, value), layout.names)
    return parse_lines(lines, layout.typed(types), value, keep)


def format_lines(
    df: DataFrame, layout: Layout, value: str = "value", keep: Sequence[str] = (), as_bytes: bool = False
) -> DataFrame:
    """Write columns as fixed-width lines, the inverse of ``parse_lines``.

    ``as_bytes`` gives latin-1 bytes, the form that is cheaper to cut.  A value wider than
    its field fails the job instead of shifting the record.  Lines are made once, as rows of
    a generator: a filter on a line is not pushed below it, where it would make the line again.
    """
    tune(df.sparkSession)
    cells = df.select(
        *[cols.col(k) for k in keep],
        *[F.coalesce(cols.col(f.name).cast("string"), F.lit("")).alias(f"_cell{i}") for i, f in enumerate(layout.fields)],
    )
    parts: list[Column] = []
    cursor = 0
    for i, field in enumerate(layout.fields):
        if field.start > cursor:
            parts.append(F.lit(" " * (field.start - cursor)))
        cell = F.col(f"_cell{i}")
        too_wide = F.raise_error(F.concat(F.lit(f"{field.name} is wider than {field.width}: "), cell))
        parts.append(F.when(F.length(cell) > field.width, too_wide.cast("string")).otherwise(F.rpad(cell, field.width, " ")))
        cursor = field.start + field.width
    line = F.encode(F.concat(*parts), "ISO-8859-1") if as_bytes else F.concat(*parts)
    return cells.select(*[cols.col(k) for k in keep], F.explode(F.array(line)).alias(value))
