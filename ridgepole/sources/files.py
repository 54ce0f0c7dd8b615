"""Listings and existence checks on any file system Spark can reach."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.functions import paths, years

LISTING = "path string, length bigint, modificationTime timestamp"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to ``path`` has committed."""
    return exists(spark, f"{path}/_SUCCESS")


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, hidden names included, by one request to the file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return [] if found is None else [status.getPath().toString() for status in found]


def publish(spark: SparkSession, folder: str, target: str) -> None:
    """Move a written folder to its place and mark it complete; what lay there goes.

    A target without the mark counts as unfinished, so a job that dies in between only
    leaves work to be done again.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, place = path(folder), path(target)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(place, True)
    system.mkdirs(place.getParent())
    if not system.rename(source, place):
        raise OSError(f"{folder} could not be moved to {target}")
    system.create(path(f"{target}/_SUCCESS"), True).close()


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """Path, length and time of the files under a folder; empty if there is no such folder.

    The content column of the source is never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    try:
        return reader.load(folder).select("path", "length", "modificationTime")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LISTING)
        raise


def list_layer(spark: SparkSession, folder: str) -> DataFrame:
    """All files of a layer in path order."""
    return list_files(spark, folder).orderBy("path")


def raw_text_catalog(listing: DataFrame) -> DataFrame:
    """Raw record files: ``.txt`` files directly inside a year folder."""
    p = F.col("path")
    return listing.where(paths.extension(p) == ".txt").select(
        p.alias("path"),
        paths.base_name(p).alias("file_name"),
        paths.stem(p).alias("stem"),
        years.year_folder(F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)).alias("year"),
        "length",
    ).where(F.col("year").isNotNull())
