"""Writers. The overwrite mode travels with each write, so one job cannot change another's."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.session import path_exists, stored


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together before writing it.

    Rebalancing lets adaptive execution cut a partition that outgrows the advised size into several
    tasks and merge small ones, so a month with most of the rows is not one task.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def replace_partitions(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    watch: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> None:
    """Parquet by partition; only the partitions present in the frame are replaced.

    ``watch`` sees the rows in the stage that writes them, whose tasks count once however often they run. ``dealt`` says
    that the rows are written where they are, as after a join that makes many of each: a task keeps a file open for each
    of its partitions (up to the number in ``session.SETTINGS``, beyond which it sorts), and nothing is shuffled.
    """
    rows = df if dealt else by_partition(df, columns)
    rows = watch(rows) if watch else rows
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *columns
    ).parquet(path)


def merge_partitions(df: DataFrame, path: str, columns: Sequence[str], keys: Sequence[str]) -> None:
    """Bring rows into a table kept by partition, such as half a month of detections.

    Only the partitions met in ``df`` are read and written again. Their rows stay, but for those that have the key of a
    new row, which takes their place; of new rows with one key one is taken. Keys may be null and compare as equal then.
    The merged partitions are written aside before they replace what they were read from. A table that isn't there yet is
    made.
    """
    spark = df.sparkSession
    new = df.dropDuplicates([*keys, *columns])
    if not path_exists(spark, path):
        replace_partitions(new, path, columns)
        return
    new = stored(new, "merge-new")
    # one row per partition met, as many as the write makes folders
    met = [row.asDict() for row in new.select(*columns).distinct().collect()]
    if not met:
        return
    touched = reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in one.items()]) for one in met])
    old = spark.read.schema(df.schema).parquet(path).where(touched)
    same = reduce(and_, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*keys, *columns]])
    kept = old.alias("o").join(new.select(*keys, *columns).alias("n"), same, "left_anti")
    replace_partitions(stored(kept.select(*df.columns).unionByName(new), "merge"), path, columns)


def replace_table(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = (),
    rows_per_file: int | None = None,
    order: Sequence[str] = (),
) -> None:
    """Parquet, replacing the whole table; optionally partitioned and with a cap on rows per file.

    ``order`` names columns that rows are looked up by: each file holds one range of them, so their least and largest
    values and a Bloom filter tell a reader which row groups to open.
    """
    if order:
        df = df.repartitionByRange(*columns, *order).sortWithinPartitions(*columns, *order)
    elif columns:
        df = by_partition(df, columns)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if columns:
        writer = writer.partitionBy(*columns)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    for name in order:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    writer.parquet(path)


def land_text(df: DataFrame, path: str) -> None:
    """One text column as gzip files."""
    df.write.mode("overwrite").option("compression", "gzip").text(path)


def land_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Gzip CSV files; ``append`` adds files to a folder that has some."""
    df.write.mode(mode).option("compression", "gzip").option("header", header).csv(path)
