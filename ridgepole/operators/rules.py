"""Cleaning rules as data.

A rule names the columns it touches and says how one value changes.  ``apply_rules``
runs a list of rules in order as a few stacked projections, so a table with dozens of
rules still costs one narrow stage: no shuffle, all inside generated code.
Columns a rule names but the table lacks are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.functions import dates, text
from ridgepole.operators import columns as cols

Row = Callable[[str], Column]
Condition = Callable[[Row], Column]


def before(column: str, year: int) -> Condition:
    return lambda row: row(column) < year


def since(column: str, year: int) -> Condition:
    return lambda row: row(column) >= year


@dataclass(frozen=True)
class Rule:
    """Base: ``columns`` are tried by exact name, then by collapsed spelling."""

    columns: Sequence[str]

    def change(self, value: Column, row: Row, data_type: str) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Scale(Rule):
    factor: int
    where: Condition

    def change(self, value, row, data_type):
        return F.when(self.where(row), value * self.factor).otherwise(value)


@dataclass(frozen=True)
class Recode(Rule):
    old: int
    new: int
    where: Condition

    def change(self, value, row, data_type):
        replacement = F.lit(self.new).cast(data_type)
        return F.when(self.where(row) & (value == self.old), replacement).otherwise(value)


@dataclass(frozen=True)
class ScaleToWhole(Rule):
    """Scale, then round half to even, which removes floating point residue."""

    factor: int

    def change(self, value, row, data_type):
        return F.rint(value * self.factor)


@dataclass(frozen=True)
class NumberAfterPrefix(Rule):
    prefix: str

    def change(self, value, row, data_type):
        bare = F.replace(value.cast("string"), F.lit(self.prefix), F.lit(""))
        return text.whole_number(bare, "/".join(self.columns)).cast("int")


@dataclass(frozen=True)
class NullFrom(Rule):
    """Values at or above the bound are not real measurements."""

    bound: float

    def change(self, value, row, data_type):
        return F.when(value >= self.bound, None).otherwise(value)


@dataclass(frozen=True)
class NullIfIn(Rule):
    """Listed code values mean "not reported"."""

    codes: Sequence[float]

    def change(self, value, row, data_type):
        number = text.number_or_null(value) if data_type == "string" else value
        return F.when(number.isin(*self.codes), None).otherwise(value)


@dataclass(frozen=True)
class ReadDate(Rule):
    fmt: str
    open_ended: Sequence[str] = ()

    def change(self, value, row, data_type):
        given = F.when(~value.isin(*self.open_ended), value) if self.open_ended else value
        return dates.lenient_date(given, self.fmt)


def sentinels(table: Mapping[str, Sequence[float]]) -> list[Rule]:
    """One ``NullIfIn`` per entry of a column -> codes table."""
    return [NullIfIn((column,), codes) for column, codes in table.items()]


def apply_rules(df: DataFrame, rules: Sequence[Rule], drop: Sequence[str] = ()) -> DataFrame:
    """Run ``rules`` in order and drop columns.

    Rules on different columns share one projection.  A further rule on the same column
    starts the next one, which keeps its input from being written out (and computed)
    once per mention; the projections still run as one narrow stage.
    """
    spelled = {text.collapsed(name): name for name in reversed(df.columns)}
    state: dict[str, Column] = {}

    def row(name: str) -> Column:
        if name not in df.columns:
            raise ValueError(f"a rule needs column {name!r}, which the table lacks: {df.columns}")
        return state.get(name, cols.col(name))

    def flush() -> None:
        nonlocal df
        if state:
            df = df.select(*[row(name).alias(name) for name in df.columns])
            state.clear()

    for rule in rules:
        for wanted in rule.columns:
            name = wanted if wanted in df.columns else spelled.get(text.collapsed(wanted))
            if name is None:
                continue
            if name in state:
                flush()
            state[name] = rule.change(cols.col(name), row, dict(df.dtypes)[name])
    gone = set(drop)
    return df.select(*[row(name).alias(name) for name in df.columns if name not in gone])
