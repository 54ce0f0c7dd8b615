"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, their racks and their shards, each shard with a weight; an inner node
weighs what its shards weigh together.  A row descends from the root: at each level every
child draws ``-ln(u) / weight`` from a hash ``u`` of the row's key and the child's name,
and the least draw wins.  A child is drawn in proportion to its weight, and a draw depends
on nothing but the key, the child's name and the child's weight.  So when weights change,
a row can only move where a node on its way has gained or lost weight; all other subtrees
keep their rows.  ``grow`` adds a shard as a region of its own, so the new shard takes
rows from everywhere and no row moves between old shards.

Defined results: a null key is a key like any other (all such rows share a shard); equal
keys share a shard; a row's text plays no part in its place.  An empty table gives an empty
table.  Columns of the input that clash with the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window of slot numbers is meant to hold.
SLOT_BLOCK = 50_000


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    number: int
    weight: float = 1.0


def tree(shards: int, racks: int = 2, per_rack: int = 2) -> tuple[Shard, ...]:
    """Equal shards numbered from 0, in regions of ``racks`` racks of ``per_rack`` shards."""
    region = racks * per_rack
    return tuple(Shard(i // region, i % region // per_rack, i) for i in range(shards))


def grow(nodes: tuple[Shard, ...], weight: float = 1.0) -> tuple[Shard, ...]:
    """The tree with one more shard, in a region of its own: no old subtree's weight changes."""
    return (*nodes, Shard(max(n.region for n in nodes) + 1, 0, max(n.number for n in nodes) + 1, weight))


def reweigh(nodes: tuple[Shard, ...], number: int, weight: float) -> tuple[Shard, ...]:
    return tuple(replace(n, weight=weight) if n.number == number else n for n in nodes)


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """-ln(u) / weight, u from the first 52 bits of an MD5 of child name and key."""
    digits = F.substring(F.md5(F.concat(name, F.lit(":"), key).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _winner(key: Column, children: Column) -> Column:
    """Number of the child with the least draw; ties go to the smaller number."""
    draws = F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"), c["number"].alias("number")))
    return F.array_min(draws)["number"]


def _children(options: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("number")) for n, w, i in options])


def _by_parent(options: dict[int, list[tuple[str, float, int]]]) -> Column:
    return F.create_map(*[c for parent, children in options.items() for c in (F.lit(parent), _children(children))])


def place(df: DataFrame, key: Column, nodes: tuple[Shard, ...], out: str = "shard") -> DataFrame:
    """Add the shard number a row's key descends to.  Weights must be positive.

    The tree is a constant of the plan, so its size is what a user writes down; each level
    looks up the children of the node that won the level above and draws among them only.
    """
    if not nodes or any(n.weight <= 0 for n in nodes):
        raise ValueError("a tree needs shards of positive weight")
    weights: dict[tuple[int, ...], float] = {}
    for n in nodes:
        for path in ((n.region,), (n.region, n.rack)):
            weights[path] = weights.get(path, 0.0) + n.weight
    regions = sorted(p[0] for p in weights if len(p) == 1)
    racks = sorted(p for p in weights if len(p) == 2)
    top = _children([(f"region {r}", weights[(r,)], r) for r in regions])
    middle = _by_parent({r: [(f"rack {p[0]}.{p[1]}", weights[p], i) for i, p in enumerate(racks) if p[0] == r] for r in regions})
    leaves = _by_parent({i: [(f"shard {n.number}", n.weight, n.number) for n in nodes if (n.region, n.rack) == p] for i, p in enumerate(racks)})

    rest = [F.col(f"`{c}`") for c in df.columns if c != out]
    name = F.col("_key")
    row = df.select(*rest, F.coalesce(key.cast("string"), F.lit("null")).alias("_key"))
    row = row.select("*", _winner(name, top).alias("_region"))
    row = row.select("*", _winner(name, F.element_at(middle, F.col("_region"))).alias("_rack"))
    row = row.select("*", _winner(name, F.element_at(leaves, F.col("_rack"))).alias(out))
    return row.drop("_key", "_region", "_rack")


def with_slots(df: DataFrame, key: Column, order: list[str], shard: str = "shard", out: str = "slot", block: int = SLOT_BLOCK) -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    Rows are dealt into as many blocks as the table needs by a hash of ``key``; a window
    numbers the rows of one (shard, block) by ``order``, a second one, over one row for
    each block, adds up the blocks before.
    """
    blocks = max(1, -(-df.count() // block))
    digits = F.substring(F.md5(F.concat(F.lit("slot:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 8)
    cut = df.withColumn("_block", F.shiftright(F.conv(digits, 16, 10).cast("bigint") * blocks, 32))
    inside = F.row_number().over(Window.partitionBy(shard, "_block").orderBy(*[F.col(f"`{c}`") for c in order]))
    sizes = cut.groupBy(shard, "_block").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col(shard).alias("_s"), F.col("_block").alias("_b"), before.alias("_before"))
    numbered = cut.withColumn("_inside", inside).join(starts, (F.col(shard) == F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
    return numbered.withColumn(out, F.col("_before") + F.col("_inside") - 1).drop("_block", "_inside", "_s", "_b", "_before")
