"""Vector columns: which rows take part, distinct vectors, arrays of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct(rows: DataFrame, vec_id: str, vector: str, most_ids: int | None = None) -> DataFrame:
    """``rep`` (least id), ``copies``, ``vec`` of each distinct usable vector, and with ``most_ids`` its least ids.

    Groups are counted before they are shuffled, so a vector of a third of all rows is one
    row for each task; the list of ids stops at ``most_ids`` in every task.
    """
    kept = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vec")).where(usable(F.col("vec")) & F.col("id").isNotNull())
    counted = kept.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    if most_ids is None:
        return counted
    first = kept.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("_r") <= most_ids)
    ids = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return counted.join(ids, "vec")


def matrix(column: pa.Array) -> np.ndarray:
    """A batch's vectors, in double precision.  All must have one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, however large or small their components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node connected to each of nodes 0..n-1 by the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
