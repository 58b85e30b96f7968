"""Readers for the landed files and the lake tables."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.functions.clean import canonical_names
from emberlake.sources.files import SCHEMES, first_line, scheme_of

# fixed values: the columns of a daily weather file, in file order
WEATHER_COLUMNS = (
    "station", "date", "element", "value", "measurement_flag", "quality_flag", "source_flag", "obs_time",
)

# fixed values: field, first column (from 1), width in the station list
STATION_LAYOUT = (
    ("id", 1, 11),
    ("latitude", 13, 8),
    ("longitude", 22, 9),
    ("elevation", 32, 6),
    ("state", 39, 2),
    ("name", 42, 30),
    ("gsn_flag", 73, 3),
    ("hcn_crn_flag", 77, 3),
    ("wmo_id", 81, 5),
)

SHAPE_SCHEMA = "osm_id string, admin_level int, name string, parents string, geom string"


def strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every column text. A file whose header differs from the first one's fails the
    read instead of being matched by position."""
    header = spark.read.option("header", True).csv(path).schema
    return spark.read.option("header", True).option("enforceSchema", False).schema(header).csv(path)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, header`` of each file at the paths (files, folders, globs): its first line, null for an empty file.

    Spark lists the files and tasks read the beginning of each. In a store that tasks can't open by themselves Spark
    reads the files' first blocks as text instead.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path")
    if scheme_of(paths[0]) in SCHEMES:

        def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(header=[first_line(path) for path in batch["path"]])

        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return files.repartition(tasks, "path").mapInPandas(first_lines, "path string, header string")
    place = F.monotonically_increasing_id()
    lines = spark.read.text(list(paths)).where("_metadata.file_block_start = 0")
    lines = lines.select(F.col("_metadata.file_path").alias("path"), "value", place.alias("place"))
    return lines.groupBy("path").agg(F.regexp_replace(F.min_by("value", "place"), "^\\ufeff", "").alias("header"))


def read_mixed_csv(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """CSV files with headers that may differ from file to file: one frame per header, every column text.

    A header is a list of column names in their order. Files without any line are passed over.
    """
    found = headers(spark, paths).where("header IS NOT NULL").groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    by_header = {row["header"]: row["paths"] for row in found.collect()}
    frames = []
    for header, files in sorted(by_header.items()):
        columns = strings(next(csv.reader([header])))
        # files of one header are read by the paths given, so that no list of files travels with the plan
        chosen = list(paths) if len(by_header) == 1 else files
        frames.append(spark.read.option("header", True).option("enforceSchema", False).schema(columns).csv(chosen))
    return frames


def read_fires(spark: SparkSession, *paths: str | Sequence[str]) -> DataFrame:
    """Fire detections of any instrument: files are read by their header, wherever they lie, and unified by name."""
    every = [p for path in paths for p in ([path] if isinstance(path, str) else path)]
    parts = [canonical_names(frame) for frame in read_mixed_csv(spark, every)]
    if not parts:
        raise ValueError(f"no file with a header in {every}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_weather(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.schema(strings(WEATHER_COLUMNS)).csv(path)


def fixed_width(line: Column, layout: Sequence[tuple[str, int, int]]) -> list[Column]:
    """One trimmed text column per field of a fixed-width line."""
    return [F.trim(F.substring(line, start, width)).alias(name) for name, start, width in layout]


def read_fixed_width(
    spark: SparkSession, path: str | Sequence[str], layout: Sequence[tuple[str, int, int]] = STATION_LAYOUT
) -> DataFrame:
    return spark.read.text(path).select(*fixed_width(F.col("value"), layout))


def read_shapes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines of administrative areas; identifiers become text whatever their JSON type."""
    return spark.read.schema(SHAPE_SCHEMA).json(path)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | str | None = None
) -> DataFrame:
    """A lake table from its root. Partition predicates prune directories, others reach the Parquet scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def at_level(table: DataFrame, level: int) -> DataFrame:
    """One partition of a table kept by administrative level, without the level column."""
    return table.where(F.col("adm") == level).drop("adm")


def register_tables(spark: SparkSession, tables: Iterable[tuple]) -> None:
    """Register ``(name, frame or path[, columns])`` entries as views for SQL text."""
    for name, source, *rest in tables:
        df = spark.read.parquet(source) if isinstance(source, str) else source
        (df.select(*rest[0]) if rest else df).createOrReplaceTempView(name)


def literal_rows(spark: SparkSession, name: str, values: Sequence) -> DataFrame:
    """A list as a one-column table."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
