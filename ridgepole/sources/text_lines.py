"""Text lines in single-byte or UTF-8 encodings, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Encodings in which a line break is always the same single byte.
_CHARSETS = {
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "ascii": "US-ASCII",
    "us-ascii": "US-ASCII",
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
}


def _lines(lines: DataFrame, encoding: str) -> DataFrame:
    charset = _CHARSETS.get(encoding.lower())
    if charset is None:
        raise ValueError(f"unsupported line encoding {encoding!r}; known: {sorted(_CHARSETS)}")
    # the text source hands over the bytes of a line untouched
    value = F.col("value") if charset == "UTF-8" else F.col("value").cast("binary")
    return lines.select(value.alias("value"), F.col("_metadata.file_path").alias("file_path"))


def read_lines(spark: SparkSession, files: str | Sequence[str], encoding: str = "latin-1") -> DataFrame:
    """Lines with the file they come from.  Plain files are split across tasks.

    Lines of a single-byte encoding stay bytes, to be cut by offset before decoding.
    """
    return _lines(spark.read.text(files), encoding)


def stream_lines(
    spark: SparkSession, folder: str, encoding: str = "latin-1", files_per_batch: int | None = None, glob: str = "*"
) -> DataFrame:
    """Lines of files as they arrive in a folder."""
    reader = spark.readStream.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _lines(reader.text(folder), encoding)
