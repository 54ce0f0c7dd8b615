"""Token totals by source, language and tokenizer version, kept up by signed changes.

Totals are additive, so a batch of inserts, deletes and revised counts is reduced to one
signed row for each (source, lang, version) and stored under its batch id.  The totals are
the sum over the stored batches.  A batch is written to a folder of its own and moved into
place whole; committing the same id again does nothing, so a job may be rerun after any
failure without counting twice.  One job at a time commits to a store.

Defined results: a null or empty text has no tokens and counts as a document; null sources
and languages are groups of their own; equal rows count as often as they occur; totals that
fall back to no documents and no tokens vanish; a store without batches has no totals.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.llm import hashes, tokens

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, docs bigint, tokens bigint"
#: Characters of texts that a task encodes at a time.
CHARS = 1 << 21


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Replace the text by its number of ids under a byte-level BPE file."""
    keep = [c for c in docs.columns if c not in {text, out}]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for a, b in hashes.slices([len(t) for t in texts], CHARS):
                _, lengths = own.encode(texts[a:b])
                rest = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rest.columns[:-1], pa.array(lengths)], names=[*keep, out])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*fields, f"`{out}` bigint"]))


def inserted(counted: DataFrame, version: str, n: str = "n_tokens") -> DataFrame:
    return counted.select("source", "lang", F.lit(version).alias("version"), F.lit(1).cast("bigint").alias("docs"), F.col(n).cast("bigint").alias("tokens"))


def deleted(counted: DataFrame, version: str, n: str = "n_tokens") -> DataFrame:
    added = inserted(counted, version, n)
    return added.withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")})


def revised(counted: DataFrame, version: str, old: Column, new: Column) -> DataFrame:
    """Changes that put a new count in the place of an old one; the documents stay."""
    return counted.select("source", "lang", F.lit(version).alias("version"), F.lit(0).cast("bigint").alias("docs"), (new - old).cast("bigint").alias("tokens"))


class Totals:
    """A store of committed batches in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._name = jvm.org.apache.hadoop.fs.Path
        self._files = self._name(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _place(self, batch: str) -> str:
        return f"{self.path}/batches/{quote(batch, safe='')}"

    def committed(self, batch: str) -> bool:
        return self._files.exists(self._name(self._place(batch)))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch of changes; False if its id is committed already."""
        if self.committed(batch):
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        attempt = f"{self.path}/attempts/{uuid.uuid4().hex}"
        summed.write.parquet(attempt)
        self._files.mkdirs(self._name(f"{self.path}/batches"))
        if not self._files.rename(self._name(attempt), self._name(self._place(batch))):
            raise OSError(f"batch {batch} could not be moved into place")
        return True

    def _stored(self) -> list[str]:
        folder = self._name(f"{self.path}/batches")
        if not self._files.exists(folder):
            return []
        return sorted(s.getPath().toString() for s in self._files.listStatus(folder))

    def totals(self) -> DataFrame:
        stored = self._stored()
        if not stored:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*stored)
        summed = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 or tokens <> 0")
