"""Equi-joins that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 * 1024 * 1024
HOT_ROWS = 1_000_000  # rows of one key that a single task may take
LIST_KEYS = 1_000_000  # a longer list of hot keys is joined with a shuffle
SLICE_BYTES = 16 * 1024 * 1024  # of a dimension for each slice that rows of equal columns are dealt in
NULL_PARTS = 256  # rows whose key is null match nothing and may go anywhere


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a frame, from one aggregation over it."""
    width: Column = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 24
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) * 2 + 24
        else:
            width = width + 16
    return df.agg(F.coalesce(F.sum(width.cast("long") + 32), F.lit(0))).first()[0]


def heavy_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of more than ``hot_rows`` rows with the number of parts each should be cut into.

    Counting combines within the map tasks first, so a hot key reaches the reducer as one row per task. There
    are at most as many hot keys as the rows have times ``hot_rows``.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    return counted.dropna(subset=keys).select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"))


def _row_spread(df: DataFrame, parts: Column) -> Column:
    """Part number of a row.

    A hash of the row keeps the choice the same when a lost task runs again; the input partition in it
    separates exact copies of one row.
    """
    plain = [
        F.to_json(F.struct(field.name))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(field.name)
        for field in df.schema.fields
    ]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), parts).cast("int")


def salted_join(
    many: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffled join in which each hot key of ``many`` is cut into parts and ``few`` repeated per part.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``, seen from ``many``.
    """
    hot = heavy_keys(many.select(*keys), keys, hot_rows)
    if hot.count() <= LIST_KEYS:
        hot = F.broadcast(hot)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    unmatched = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    cut = many.join(hot, keys, "left")
    cut = cut.withColumn("_part", _row_spread(many, F.when(unmatched, NULL_PARTS).otherwise(parts))).drop("_parts")
    repeated = few.join(hot, keys, "left")
    repeated = repeated.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return cut.hint("merge").join(repeated.hint("merge"), [*keys, "_part"], how).drop("_part")


def dealt(fact: DataFrame, columns: Sequence[str], keys: list[str], slices: int) -> DataFrame:
    """Rows brought together by columns before a join multiplies them, those of equal columns in some slices by key.

    With a small dimension adaptive execution sizes the tasks; beside a larger one it would, by what goes in, make too few.
    """
    together = [F.col(name) for name in columns]
    if slices == 1:
        return fact.hint("rebalance", *together)
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fact.repartition(tasks, *together, F.pmod(F.xxhash64(*keys), F.lit(slices)))


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    deal: Sequence[str] = (),
    watch: Callable[[DataFrame, Column], DataFrame] | None = None,
) -> DataFrame:
    """Join a fact with a dimension on equal keys: broadcast if the dimension measures small, else salted.

    Where it is broadcast, rows of the fact can be brought together by columns (``deal``) first, while they are few.
    ``watch`` (inner joins only) is given rows and a column with the number of rows of the result that each stands for:
    those of the fact, once dealt, with their number of matches, or where it isn't broadcast those of the result.
    """
    size = measured_bytes(dimension) if limit > 0 else 0
    if limit > 0 and size <= limit:
        rows = dealt(fact, deal, keys, 1 + size // SLICE_BYTES) if deal else fact
        if watch and size:
            matches = dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("_matches"))
            rows = watch(rows.join(F.broadcast(matches), keys), F.col("_matches")).drop("_matches")
            watch = None
        joined = rows.join(F.broadcast(dimension), keys, how)
    else:
        joined = salted_join(fact, dimension, keys, how, hot_rows)
    return watch(joined, F.lit(1)) if watch else joined
