"""Raw, bronze and silver layers of one dataset."""

from __future__ import annotations

import logging
import posixpath
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgepole.functions import paths as path_columns
from ridgepole.operators.union import union_strict
from ridgepole.session import scratch_dir
from ridgepole.sources import archives, files, sinks, tables

log = logging.getLogger(__name__)

Layer = Literal["raw", "bronze", "silver"]


@dataclass(frozen=True)
class LayerPaths:
    dataset: str
    raw: str
    bronze: str
    silver: str

    @classmethod
    def under(cls, base: str, dataset: str) -> "LayerPaths":
        root = f"{base.rstrip('/')}/{dataset}"
        return cls(dataset, f"{root}/raw", f"{root}/bronze", f"{root}/silver")


class Medallion:
    """Promote raw artefacts to bronze, then combine bronze into a silver table."""

    def __init__(self, spark: SparkSession, base: str, dataset: str) -> None:
        self.spark = spark
        self.paths = LayerPaths.under(base, dataset)

    def list_layer(self, layer: Layer) -> DataFrame:
        return files.list_layer(self.spark, getattr(self.paths, layer))

    def promote(
        self, raw_artifact: str, allowed: tuple[str, ...] | None = (".csv",), overwrite: bool = True
    ) -> list[str]:
        """Unpack (ZIP) or copy (anything else) into bronze; returns the bronze paths.

        Archives are flattened; of members with the same base name the last one wins.
        """
        if not files.exists(self.spark, raw_artifact):
            raise FileNotFoundError(raw_artifact)
        source = files.list_files(self.spark, raw_artifact, recursive=False)
        if raw_artifact.lower().endswith(".zip"):
            wanted = archives.bronze_members(archives.members_of(source), allowed)
        else:
            if allowed and posixpath.splitext(raw_artifact)[1].lower() not in {a.lower() for a in allowed}:
                return []
            wanted = source.select(
                F.col("path").alias("archive"),
                F.lit(None).cast("string").alias("member"),
                path_columns.base_name(F.col("path")).alias("base_name"),
            )
        targets = wanted.select(
            "archive", "member", *[c for c in wanted.columns if c == "position"], "base_name", F.concat(F.lit(self.paths.bronze + "/"), F.col("base_name")).alias("target")
        )
        present = files.list_files(self.spark, self.paths.bronze, recursive=False).select(
            path_columns.base_name(F.col("path")).alias("base_name")
        )
        todo = targets if overwrite else targets.join(present, "base_name", "left_anti")
        # all tasks copy at once; of the stored report only the paths asked for come back
        report = sinks.write_table(archives.unpack(todo), scratch_dir(self.spark, "promoted") + "/report")
        outcome = self.spark.read.parquet(report).select("target", "member", "status", "detail").collect()
        for row in outcome:
            if row["status"] != "copied":
                log.warning("%s not promoted: %s", row["member"], row["detail"])
        copied = {r["target"] for r in outcome if r["status"] == "copied"}
        if not overwrite:
            copied |= {r["target"] for r in targets.join(present, "base_name", "left_semi").toLocalIterator()}
        return sorted(copied)

    def build_silver(
        self,
        bronze_files: Sequence[str] | None = None,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        schema: T.StructType | str | None = None,
        sink: str = "parquet",
        output_name: str | None = None,
    ) -> str:
        """Strict union of the bronze files, an optional user transform, one write."""
        if sink not in sinks.FORMATS:
            raise ValueError(f"unsupported silver sink: {sink}")
        chosen = list(bronze_files) if bronze_files else [r["path"] for r in self.list_layer("bronze").toLocalIterator()]
        whole = union_strict(tables.read_bronze(self.spark, chosen, schema))
        if transform is not None:
            whole = whole.transform(transform)
        name = output_name or f"{self.paths.dataset}_silver.{sink}"
        return sinks.write_table(whole, f"{self.paths.silver}/{name}", sink)
