"""The jobs that produce the lake tables: areas, stations, fires, weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions import clean, geo
from emberlake.operators import hierarchy, nearest, spatial
from emberlake.operators.skew import dimension_join
from emberlake.sources import readers, sinks

ROWS_PER_SHAPE_FILE = 1000  # fixed value
LATITUDES = (-80, 84)  # fixed values: open range the projection is used for


# --- areas -----------------------------------------------------------------------------------------------


def shapes_table(source: DataFrame) -> DataFrame:
    return source.select(
        geo.strip_srid(F.col("geom")).alias("geometry"),
        F.col("admin_level").alias("adm"),
        F.col("osm_id").cast("string").alias("id"),
    )


def rejected_shapes(source: DataFrame) -> DataFrame:
    """``id, adm, fault`` of the areas no join can use; they stay in the table of shapes as they came."""
    shapes = shapes_table(source)
    faults = spatial.rejected_areas(shapes).withColumnRenamed("shape_id", "id")
    return shapes.select("id", "adm").join(faults, "id")


def build_shapes(
    spark: SparkSession, source: str, shapes: str, relations: str, levels: Sequence[int] | None = None
) -> None:
    areas = readers.read_shapes(spark, source)
    sinks.replace_table(hierarchy.relations(areas, levels), relations, ["adm"])
    sinks.replace_table(shapes_table(areas), shapes, ["adm"], ROWS_PER_SHAPE_FILE, ["id"])


def named_ancestors(relations: DataFrame) -> DataFrame:
    """Relations of one level as the columns the facts carry: ``shape_id, adm, adm_name, adm{n}...``."""
    return relations.select(
        F.col("id").alias("shape_id"),
        F.col("id").alias("adm"),
        F.col("name").alias("adm_name"),
        *hierarchy.ancestor_columns(relations),
    )


def area_tiles(shapes: DataFrame, relations: DataFrame, **options) -> spatial.NamedTiles:
    """Areas with their ancestors, as points meet them."""
    return spatial.named_tiles(spatial.area_edges(shapes), named=named_ancestors(relations), **options)


def located(points: DataFrame, tiles: spatial.NamedTiles) -> DataFrame:
    """Points with every area that contains them, and the area's ancestors."""
    return spatial.contains_join(points, tiles).drop("shape_id")


# --- stations --------------------------------------------------------------------------------------------


def clean_stations(raw: DataFrame) -> DataFrame:
    """Station text fields to numbers, without the stations the projection cannot take."""
    low, high = LATITUDES
    lat = F.col("latitude").try_cast("decimal(24,20)")
    return raw.where((lat > low) & (lat < high)).select(
        "id",
        "name",
        "elevation",
        geo.number(F.col("longitude")).alias("x"),
        geo.number(F.col("latitude")).alias("y"),
    )


def stations_table(stations: DataFrame, shapes: DataFrame, relations: DataFrame, **options) -> DataFrame:
    """Stations (``id, name, elevation, x, y``) with the areas they are among the nearest to."""
    named = nearest.nearest_points(stations, spatial.area_edges(shapes), named=named_ancestors(relations), **options)
    return named.select(
        "id",
        geo.point_wkt(F.col("x"), F.col("y")).alias("geometry"),
        "name",
        F.col("elevation").try_cast("float").alias("elevation"),
        F.col("distance").cast("float").alias("distance"),
        "adm",
        "adm_name",
        *hierarchy.ancestor_columns(named),
    )


def build_stations(
    spark: SparkSession, source: str, stations: str, relations: str, shapes: str, level: int = 8
) -> None:
    table = stations_table(
        clean_stations(readers.read_fixed_width(spark, source)),
        readers.at_level(readers.read_table(spark, shapes), level),
        readers.at_level(readers.read_table(spark, relations), level),
    )
    sinks.replace_table(table, stations)


# --- fires -----------------------------------------------------------------------------------------------


def clean_fires(raw: DataFrame) -> DataFrame:
    """Typed fire detections; text that cannot be read becomes null.

    Year and month come from the acquisition time, the year from the date's text where the time is
    unreadable.
    """
    when = clean.fire_time(F.col("acq_date"), F.col("acq_time"))
    return clean.canonical_names(raw).select(
        geo.number(F.col("longitude")).alias("x"),
        geo.number(F.col("latitude")).alias("y"),
        *[clean.real(F.col(c)).alias(c) for c in ("bright_ti4", "bright_ti5", "frp", "scan", "track")],
        "confidence",
        when.alias("datetime"),
        F.coalesce(F.year(when), clean.whole(F.substring("acq_date", 1, 4))).alias("year"),
        F.month(when).alias("month"),
    )


def rejected_fires(fires: DataFrame) -> DataFrame:
    """How many cleaned rows lack a position or a time."""
    return fires.agg(
        F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("without_position"),
        F.count_if(F.col("datetime").isNull()).alias("without_time"),
    )


def fires_table(fires: DataFrame, shapes: DataFrame, relations: DataFrame, **options) -> DataFrame:
    """Cleaned detections with every area that contains them."""
    return fires_in(fires, area_tiles(shapes, relations, **options))


def fires_in(fires: DataFrame, tiles: spatial.NamedTiles) -> DataFrame:
    named = located(fires, tiles)
    return named.select(
        geo.point_wkt(F.col("x"), F.col("y")).alias("geometry"),
        "bright_ti4", "bright_ti5", "frp", "scan", "track", "confidence", "datetime", "year", "month",
        "adm",
        "adm_name",
        *hierarchy.ancestor_columns(named),
    )


FIRE_PARTITIONS = ("year", "month")


def landed_area_tiles(spark: SparkSession, relations: str, shapes: str, level: int = 8) -> spatial.NamedTiles:
    """The areas that fires of any folder meet, from the tables."""
    return area_tiles(
        readers.at_level(readers.read_table(spark, shapes), level),
        readers.at_level(readers.read_table(spark, relations), level),
    )


def landed_fire_fact(spark: SparkSession, source: str | Sequence[str], tiles: spatial.NamedTiles) -> DataFrame:
    paths = [source] if isinstance(source, str) else source
    return fires_in(clean_fires(readers.read_fires(spark, *paths)), tiles)


def build_fires(
    spark: SparkSession, source: str | Sequence[str], fires: str, relations: str, shapes: str, level: int = 8
) -> None:
    rows = landed_fire_fact(spark, source, landed_area_tiles(spark, relations, shapes, level))
    sinks.replace_partitions(rows, fires, FIRE_PARTITIONS)


# --- weather ---------------------------------------------------------------------------------------------


def clean_weather(raw: DataFrame) -> DataFrame:
    when = clean.weather_time(F.col("date"), F.col("obs_time"))
    return raw.select(
        "station", "element", "measurement_flag", "quality_flag", "source_flag",
        clean.whole(F.col("value")).alias("value"),
        when.alias("datetime"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
    )


def weather_table(readings: DataFrame, stations: DataFrame, **options) -> DataFrame:
    """Readings with each area their station is linked to; readings of unlinked stations are dropped."""
    links = stations.select(
        F.col("id").alias("station"),
        F.col("distance").alias("distance_from_station"),
        "adm",
        "adm_name",
        *hierarchy.ancestor_columns(stations),
    )
    return dimension_join(readings, links, ["station"], **options)


WEATHER_PARTITIONS = ("element", "year", "month")


def landed_weather_fact(spark: SparkSession, source: str | Sequence[str], stations: str, **options) -> DataFrame:
    """Readings are dealt for the write before the join: after it there is a row for each area a station is linked to."""
    readings = clean_weather(readers.read_weather(spark, source))
    return weather_table(readings, readers.read_table(spark, stations), deal=WEATHER_PARTITIONS, **options)


def build_weather(spark: SparkSession, source: str | Sequence[str], weather: str, stations: str) -> None:
    rows = landed_weather_fact(spark, source, stations)
    sinks.replace_partitions(rows, weather, WEATHER_PARTITIONS, dealt=True)
