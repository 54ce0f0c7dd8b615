"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession


# The virtual machine never compiles a method of more than 8,000 bytes of code.  A record
# of dozens of fields fused into one method would run interpreted, an order of magnitude
# slower; under this limit such a stage uses its split-up form, which gets compiled.
_SMALL_METHODS = ("spark.sql.codegen.hugeMethodLimit", "65535", "8000")


def tune(spark: SparkSession) -> SparkSession:
    """Settings for wide records; a value the user chose stays."""
    key, default, wanted = _SMALL_METHODS
    if spark.conf.get(key) == default:
        spark.conf.set(key, wanted)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder if scratch is None else SparkSession.builder.config("spark.checkpoint.dir", f"file://{scratch}")
    spark = (
        builder.master(f"local[{cores}]")
        .appName("ridgepole")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name for intermediate tables, in a folder that every executor shares.

    That is the folder the cluster names in ``spark.checkpoint.dir``, else the warehouse.
    A warehouse on the driver's own disk is refused when executors run elsewhere: the
    parts they write there would be lost.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if shared.startswith("file:") and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/ridgepole/{label}-{uuid.uuid4().hex}"


def many_tasks(spark: SparkSession) -> int:
    """A number of tasks that keeps all cores busy, however few bytes there are."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: Column) -> DataFrame:
    """Deal short rows that stand for much work over tasks.

    The number is given, so the adaptive planner does not fold them into one task for
    being few bytes.
    """
    return df.repartition(many_tasks(df.sparkSession), *keys)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
