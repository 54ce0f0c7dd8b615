"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, seeded selection.

A document's size is its number of words.  Sources take turns at the given weights in the
order of their names' code points, null last, and share the total of all sizes; a target
stops at ``limit`` times its source's size and the excess goes to the others by weight.

The total is cut into blocks of equally many words.  Sources get blocks by the highest
quotients ``target / (2k + 1)``; a source's blocks go to its shards (cells) the same way,
by their sizes.  Both are settled on aggregated tables: one row for each source, then one
for each (source, shard).  A cell lays its documents on end in a seeded order; its quota
takes whole passes over the cell, and the rest as a run of blocks from a seeded block on.

Defined results: null or blank texts have size 0 and take 0; a null source is a source of
its own; equal rows take part as often as they occur; an empty table gives an empty table.
Reruns agree, whatever the partitions.  Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgepole.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a cell is meant to hold.
CELL_ROWS = 50_000
#: The total is cut into about 2**20 blocks of at most this many words.
MOST_BLOCK = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray | None = None) -> np.ndarray:
    """Seats by the highest quotients votes / (2k + 1); ties go to the earlier party.

    The divisor at which the quotients just fit is found by bisection; the seats that tie
    there are then dealt one by one.  A party stops at its cap.
    """
    votes = np.asarray(votes, float)
    caps = np.full(len(votes), seats, np.int64) if caps is None else np.minimum(np.asarray(caps, np.int64), seats)
    caps = np.where(votes > 0, caps, 0)
    if caps.sum() <= seats:
        return caps
    given = lambda d: np.minimum(caps, np.floor(votes / d + 0.5).astype(np.int64))
    low, high = votes.max() / (2.0 * seats + 2), 4 * votes.max() + 1
    while given(low).sum() <= seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if given(middle).sum() <= seats else (middle, high)
    out = given(high * (1 + 1e-9))  # a hair above, so that no tie is settled by rounding
    while (left := seats - int(out.sum())) > 0:
        quotient = np.where(out < caps, votes / (2 * out + 1), -1.0)
        out[np.argsort(-quotient, kind="stable")[: min(left, int((out < caps).sum()))]] += 1
    return out


def targets(sources: DataFrame, weights: Sequence[float], limit: int) -> DataFrame:
    """Add ``weight`` and ``target`` to one row for each source (``source``, ``source_size``)."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("_rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")))
    # sources reach their limits in the order of limit / weight, as the common level rises
    full = Window.orderBy(F.col("source_size") * limit / F.col("weight"), "_rank")
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * limit).over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / (
        F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    )
    leveled = ranked.withColumn("_level", level).withColumn("_stops", F.col("source_size") * limit <= F.col("_level") * F.col("weight"))
    # the level that is left when the first source stays under its limit; it only falls behind that one
    common = F.coalesce(F.max(F.when(~F.col("_stops"), F.col("_level"))).over(everything), F.lit(0.0))
    target = F.when(F.col("_stops"), (F.col("source_size") * limit).cast("double")).otherwise(common * F.col("weight"))
    return leveled.withColumn("target", target).drop("_level", "_stops")


def _by_source(limit: int, most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_rank").reset_index(drop=True)
        total = int(rows["source_size"].sum())
        block = max(1, min(most, total >> 20))
        rows["block"] = block
        rows["quota"] = sainte_lague(rows["target"].to_numpy(), total // block, -(-rows["source_size"].to_numpy() * limit // block))
        return rows[["_source", "source_size", "target", "block", "quota"]]

    return run


def _by_cell(limit: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_cell").reset_index(drop=True)
        sizes = rows["cell_size"].to_numpy(np.int64)
        quota = sainte_lague(sizes, int(rows["quota"].iloc[0]), -(-sizes * limit // rows["block"].to_numpy()))
        rows["words"] = np.minimum(quota * rows["block"].to_numpy(), sizes * limit)
        return rows

    return run


def mix(
    docs: DataFrame, doc_id: Column, source: Column, size: Column, weights: Sequence[float] = (5, 2, 1), limit: int = 3, seed: int = 0, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words taken, repeats counted)."""
    added = {"size", "source_size", "target", "taken"}
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    cells = max(1, -(-docs.count() // cell_rows))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    part = lambda at: F.conv(F.substring(F.col("_hash"), at, 8), 16, 10).cast("bigint")
    rows = docs.select(*keep, source.alias("_origin"), size.cast("bigint").alias("size"), key.alias("_hash"), doc_id.alias("_doc"))
    # a source with a name never meets the one without
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("_origin")), F.lit("-")))
    rows = rows.withColumn("_cell", F.shiftright(part(1) * cells, 32)).withColumn("_order", part(9))

    by_cell = stored(rows.groupBy("_source", "_cell").agg(F.max("_origin").alias("source"), F.sum("size").alias("cell_size")), "mix-cells")
    sources = targets(by_cell.groupBy("_source").agg(F.max("source").alias("source"), F.sum("cell_size").alias("source_size")), weights, limit)
    schema = "_source string, source_size bigint, target double, block bigint, quota bigint"
    quotas = sources.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(_by_source(limit, MOST_BLOCK), schema)
    cell_rows_ = by_cell.select("_source", "_cell", "cell_size").join(quotas, "_source")
    schema = "_source string, _cell bigint, cell_size bigint, source_size bigint, target double, block bigint, quota bigint, words bigint"
    settled = cell_rows_.groupBy("_source").applyInPandas(_by_cell(limit), schema)

    # the run of blocks: from a seeded block of the cell on, round its end
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_source"), F.lit(":"), F.col("_cell").cast("string")).cast("binary")), 1, 8)
    blocks = F.greatest(F.lit(1), F.expr("(cell_size + block - 1) div block"))
    settled = stored(
        settled.select(
            "_source", "_cell", "cell_size", "source_size", "target",
            F.expr("if(cell_size = 0, 0, words div cell_size)").alias("_passes"),
            F.expr("if(cell_size = 0, 0, words % cell_size)").alias("_more"),
            (F.shiftright(F.conv(digits, 16, 10).cast("bigint") * blocks, 32) * F.col("block")).alias("_from"),
        ),
        "mix-quotas",
    )
    line = Window.partitionBy("_source", "_cell").orderBy("_order", "_doc", "size")
    rows = rows.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    joined = rows.join(settled, ["_source", "_cell"], "left")
    begin, end, first, last = F.col("_end") - F.col("size"), F.col("_end"), F.col("_from"), F.col("_from") + F.col("_more")
    over = lambda a, b: F.greatest(F.lit(0), F.least(end, b) - F.greatest(begin, a))
    part_taken = over(first, F.least(last, F.col("cell_size"))) + over(F.lit(0), last - F.col("cell_size"))
    return joined.select(*keep, "size", "source_size", "target", (F.col("_passes") * F.col("size") + part_taken).cast("bigint").alias("taken"))
