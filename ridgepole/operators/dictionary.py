"""From raw dictionary tables to one clean layout relation per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols
from ridgepole.operators.dedupe import keep_first
from ridgepole.operators.expand import expand_numbers
from ridgepole.operators.union import union_relaxed, union_strict

# Label keys of the number column and of the name column.
NUMBER_LABEL = "field#"
NAME_LABELS = ("fieldname", "variablename", "name")

ORDINALS = ("doc", "page", "table_no", "row_no")


def label_role(label_key: Column) -> Column:
    """``number``, ``name`` or null for a label key."""
    return F.when(label_key == NUMBER_LABEL, F.lit("number")).when(label_key.isin(*NAME_LABELS), F.lit("name"))


def normalise_table(table: DataFrame) -> DataFrame | None:
    """One extracted table shape: expand its numbers; ``None`` if it has no number column."""
    number = cols.find_by_label(table, {NUMBER_LABEL})
    if number is None:
        return None
    return expand_numbers(table, number, cols.find_by_label(table, NAME_LABELS), position="_token_no")


def combine_tables(
    tables: Sequence[DataFrame], ordinals: Sequence[str] = ORDINALS, within: Sequence[str] = (), relaxed: bool = False
) -> DataFrame:
    """Stack the tables of documents and keep the first row of every field number.

    ``ordinals`` name the document, then the reading order; ``within`` names what a
    document's name is unique in (its year).  Tables that do not describe fields are left
    out; the others must agree in their columns unless ``relaxed``, which fills up with nulls.
    """
    described = [t for t in (normalise_table(x) for x in tables) if t is not None]
    stacked = union_relaxed(described) if relaxed else union_strict(described)
    document, *reading_order = ordinals
    # one cell may name a number twice, so the place in the cell decides last
    return keep_first(stacked, [*within, document, "Field #"], [*reading_order, "_token_no"]).drop("_token_no")
