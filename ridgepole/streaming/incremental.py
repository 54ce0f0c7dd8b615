"""Convert only what is new in a growing raw folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgepole.functions import years
from ridgepole.operators.fixed_width import parse_lines
from ridgepole.operators.layout import Layout
from ridgepole.sources.text_lines import stream_lines


def parsed_stream(
    spark: SparkSession,
    folder: str,
    layout: Layout,
    encoding: str = "latin-1",
    glob: str = "*",
    files_per_batch: int | None = None,
    name_level: int = 0,
) -> DataFrame:
    """Records of arriving files, tagged with file name and the year in it.

    ``name_level`` counts folders up from the file: 1 takes the name of the table folder
    whose part files arrive.
    """
    lines = stream_lines(spark, folder, encoding, files_per_batch, glob)
    name = F.element_at(F.split(F.col("file_path"), "/"), -1 - name_level)
    tagged = lines.select("value", name.alias("source_file"), years.year_in_name(name).alias("year"))
    return parse_lines(tagged, layout, keep=("source_file", "year"))


def convert_new(
    records: DataFrame, output: str, checkpoint: str, partition_columns: Sequence[str] = ("year",)
) -> StreamingQuery:
    """Append the records of files not seen before, then stop.

    The checkpoint remembers the files taken, and the file sink's log makes each batch
    appear exactly once even if a job dies half-way and is run again.  Both folders must
    lie on shared storage.
    """
    return (
        records.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_columns)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
