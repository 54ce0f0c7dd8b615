"""Full outer join of the two halves of a split release."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.operators import columns as cols


def outer_join_halves(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y"), match_nulls: bool = True
) -> DataFrame:
    """Full outer join of two halves; shared other columns get suffixes.

    Null keys match null keys, as many rows with as many rows: ``null_key_counts`` tells
    beforehand how many that are, and without ``match_nulls`` they stay unmatched.

    Built as matched rows plus the rows only one side has.  A full outer join cannot be
    split when one key is hot, while the adaptive planner splits both sides of an inner
    join and the kept side of an anti join.  The anti joins look only at distinct keys,
    which are reduced before they are shuffled.  Both uses of a half read it under the same
    alias without a projection in between, so its wide rows are shuffled once and the
    second use reads the first one's exchange.
    """
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    # aliases keep the halves apart, also if both come from one table
    l_rows, r_rows = left.alias("_l"), right.alias("_r")
    l_names, r_names = (
        {n: n + suffix if n in shared else n for n in side.columns if n not in set(keys)} for side, suffix in ((left, suffixes[0]), (right, suffixes[1]))
    )

    def of(alias: str, name: str) -> Column:
        return F.col(f"{alias}.{cols.quoted(name)}")

    def same(pairs: Sequence[tuple[Column, Column]]) -> Column:
        return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if match_nulls else a == b for a, b in pairs])

    def columns(side: DataFrame, alias: str, names: dict[str, str], present: bool) -> list[Column]:
        return [(of(alias, n) if present else F.lit(None).cast(side.schema[n].dataType)).alias(out) for n, out in names.items()]

    def row(alias: str, with_left: bool, with_right: bool) -> list[Column]:
        return [*[of(alias, k).alias(k) for k in keys], *columns(left, "_l", l_names, with_left), *columns(right, "_r", r_names, with_right)]

    def unmatched(rows: DataFrame, alias: str, other: DataFrame) -> DataFrame:
        their_keys = other.select(*[cols.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
        return rows.join(their_keys, same([(of(alias, k), F.col(f"_key{i}")) for i, k in enumerate(keys)]), "left_anti")

    matched = l_rows.join(r_rows, same([(of("_l", k), of("_r", k)) for k in keys]), "inner").select(*row("_l", True, True))
    only_left = unmatched(l_rows, "_l", right).select(*row("_l", True, False))
    only_right = unmatched(r_rows, "_r", left).select(*row("_r", False, True))
    return matched.union(only_left).union(only_right)


def null_key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each half by which of its keys are null, for keys with a null: ``<key>_null .., n_left, n_right``.

    Such rows match all rows of the other half with equal other keys and the same nulls.
    """
    flags = [f"{k}_null" for k in keys]
    both = None
    for side, counts in ((left, (1, 0)), (right, (0, 1))):
        rows = side.select(*[cols.col(k).isNull().alias(f) for k, f in zip(keys, flags)]).where(reduce(lambda a, b: a | b, [cols.col(f) for f in flags]))
        told = rows.select(*[cols.col(f) for f in flags], F.lit(counts[0]).alias("n_left"), F.lit(counts[1]).alias("n_right"))
        both = told if both is None else both.union(told)
    return both.groupBy(*[cols.col(f) for f in flags]).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
