"""Session settings every job and query relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a task that writes no more partitions than this at once doesn't sort its rows by them
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("emberlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash rows over the session's full number of shuffle partitions.

    For small rows that a later step unfolds into many: adaptive execution would size the partitions by
    what goes in, and merge away the parallelism the unfolding needs. A number given here is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _configured_folder(spark: SparkSession) -> str | None:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (a single-machine session) a temporary folder takes its place.
    """
    base = _configured_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="emberlake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store Spark reads it from."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result that several later steps read, and read it back.

    It is computed once, a lost executor costs no recomputation, and Spark knows its size.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
