"""Every operator and query, bound to the driver's tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions import calendar, clean, geo
from emberlake.operators import hierarchy, nearest, spatial
from emberlake.plans import analytics, bindings, jobs, quality
from emberlake.session import shared_folder, tune
from emberlake.sources import archive, readers, sinks
from emberlake.sources.files import store_of
from emberlake.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPINE = ("1997-01-01", "1997-12-31")
LEVELS = (2, 4)
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# --- bound tables ----------------------------------------------------------------------------------------


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.view(spark, sf_dir, bindings.SOURCE_AREAS)


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.view(spark, sf_dir, bindings.FIRES)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.view(spark, sf_dir, bindings.WEATHER)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.view(spark, sf_dir, bindings.STATIONS)


def shapes_at(source: DataFrame, level: int = 8) -> DataFrame:
    return readers.at_level(jobs.shapes_table(source), level)


def relations_at(source: DataFrame, level: int = 8) -> DataFrame:
    return readers.at_level(hierarchy.relations(source, LEVELS), level)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned fires with their key."""
    raw = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES)
    return raw.select(
        "event_id", geo.number(F.col("longitude")).alias("x"), geo.number(F.col("latitude")).alias("y")
    )


def station_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.clean_stations(bindings.view(spark, sf_dir, bindings.SOURCE_STATIONS))


def plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


# --- spatial ---------------------------------------------------------------------------------------------


@query
def points_in_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fires with every city that contains them, and the city's ancestors."""
    source = areas(spark, sf_dir)
    return jobs.located(detections(spark, sf_dir), jobs.area_tiles(shapes_at(source), relations_at(source))).select(
        "event_id", "x", "y", "adm", "adm_name", "adm2", "adm2_name", "adm4", "adm4_name"
    )


@query
def points_in_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join one level up: few large areas, each over many grid cells."""
    return spatial.contains_join(
        detections(spark, sf_dir), spatial.area_edges(shapes_at(areas(spark, sf_dir), 4))
    ).select("event_id", F.col("shape_id").alias("adm"))


@query
def fires_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fire fact as the job writes it."""
    source = areas(spark, sf_dir)
    cleaned = jobs.clean_fires(bindings.view(spark, sf_dir, bindings.SOURCE_FIRES))
    return plain_time(
        jobs.fires_table(cleaned, shapes_at(source), relations_at(source))
    ).withColumns({c: F.round(F.col(c).cast("double"), 2) for c in ("bright_ti4", "bright_ti5", "frp", "scan", "track")})


@query
def areas_within_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spatial.distance_join(
        station_points(spark, sf_dir), spatial.area_edges(shapes_at(areas(spark, sf_dir)))
    )
    return pairs.select("id", F.col("shape_id").alias("adm"), F.round("distance", 3).alias("distance"))


@query
def nearest_k_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = nearest.nearest_points(
        station_points(spark, sf_dir), spatial.area_edges(shapes_at(areas(spark, sf_dir)))
    )
    return linked.select(
        "id", F.col("shape_id").alias("adm"), F.round("distance", 3).alias("distance"), "station_rank"
    )


@query
def nearest_k_of_tied_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest stations where an area has a hundred and more within reach, three at each place."""
    many = jobs.clean_stations(bindings.view(spark, sf_dir, bindings.TIED_STATIONS))
    linked = nearest.nearest_points(many, spatial.area_edges(shapes_at(areas(spark, sf_dir))))
    return linked.select(
        "id", F.col("shape_id").alias("adm"), F.round("distance", 3).alias("distance"), "station_rank"
    )


@query
def shape_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas that cannot be read in full, each with its fault."""
    return jobs.rejected_shapes(bindings.view(spark, sf_dir, bindings.BROKEN_AREAS))


@query
def points_in_readable_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containment among areas most of which are broken: these match nothing, whatever is left of them."""
    shapes = shapes_at(bindings.view(spark, sf_dir, bindings.BROKEN_AREAS))
    located = spatial.contains_join(detections(spark, sf_dir), spatial.area_edges(shapes))
    return located.select("event_id", F.col("shape_id").alias("adm"))


@query
def stations_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station table as the job writes it."""
    source = areas(spark, sf_dir)
    table = jobs.stations_table(
        station_points(spark, sf_dir), shapes_at(source), relations_at(source)
    )
    return table.withColumns(
        {
            "elevation": F.round(F.col("elevation").cast("double"), 1),
            "distance": F.round(F.col("distance").cast("double"), 1),
        }
    )


@query
def weather_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather fact as the job writes it, from the station table the job before it wrote."""
    source = areas(spark, sf_dir)
    folder = shared_folder(spark, "stations")
    sinks.replace_table(
        jobs.stations_table(station_points(spark, sf_dir), shapes_at(source), relations_at(source)), folder
    )
    # rounded once for each link, of which readings make many rows
    links = readers.read_table(spark, folder).withColumn("distance", F.round(F.col("distance").cast("double"), 1))
    readings = jobs.clean_weather(bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER))
    return jobs.weather_table(plain_time(readings), links)


@query
def distance_to_home_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planar distance of each city's first corner to its own state's outline, in projected metres."""
    source = areas(spark, sf_dir)
    cities = jobs.shapes_table(source)
    corners = readers.at_level(cities, 8).select("id", geo.wkt_rings(F.col("geometry"))[0][0].alias("corner"))
    homes = relations_at(source).select("id", F.col("adm4"))
    states = spatial.area_edges(readers.at_level(cities, 4))
    placed = corners.join(homes, "id").select(
        "id", F.col("adm4").alias("shape_id"),
        geo.mercator_x(F.col("corner.x")).alias("mx"), geo.mercator_y(F.col("corner.y")).alias("my"),
    )
    found = nearest.distance_to(placed, states, ["id"])
    return found.select("id", F.col("shape_id").alias("adm4"), F.round("distance", 3).alias("distance"))


@query
def area_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape text to rings: corners and extent of each area."""
    shapes = jobs.shapes_table(areas(spark, sf_dir))
    corners = F.flatten(geo.wkt_rings(F.col("geometry")))
    return shapes.select(
        "adm",
        "id",
        F.size(geo.wkt_rings(F.col("geometry"))).alias("rings"),
        F.size(corners).alias("corners"),
        F.array_min(F.transform(corners, lambda c: c["x"])).alias("min_x"),
        F.array_max(F.transform(corners, lambda c: c["x"])).alias("max_x"),
        F.array_min(F.transform(corners, lambda c: c["y"])).alias("min_y"),
        F.array_max(F.transform(corners, lambda c: c["y"])).alias("max_y"),
    )


@query
def point_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as text, as stored, and with swapped axes."""
    point = F.struct("x", "y")
    swapped = geo.flip(point)
    return detections(spark, sf_dir).select(
        "event_id",
        geo.point_wkt(F.col("x"), F.col("y")).alias("geometry"),
        geo.point_wkt(swapped["x"], swapped["y"]).alias("flipped"),
    )


@query
def project_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees to metres and back, through the SQL functions."""
    geo.register_sql_functions(spark)
    return detections(spark, sf_dir).selectExpr(
        "event_id",
        "round(el_mercator_x(x), 3) AS mx",
        "round(el_mercator_y(y), 3) AS my",
        "round(el_longitude(el_mercator_x(x)), 6) AS lon",
        "round(el_latitude(el_mercator_y(y)), 6) AS lat",
    )


@query
def sql_areas_at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The containment join in SQL, through its table function."""
    spatial.register_areas(spark, spatial.area_edges(shapes_at(areas(spark, sf_dir))))
    found = detections(spark, sf_dir)
    return spark.sql("SELECT d.event_id, a.shape_id AS adm FROM {d} d, LATERAL el_areas_at(d.x, d.y) a", d=found)


@query
def sql_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contains, distance and flip in SQL: first corner of each city against its state, in degrees."""
    geo.register_sql_functions(spark)
    source = areas(spark, sf_dir)
    return spark.sql(
        """
        WITH city AS (SELECT c.id, r.adm4, el_rings(c.geometry)[0][0] AS corner FROM {cities} c JOIN {relations} r ON c.id = r.id)
        SELECT city.id, city.adm4, el_flip(el_point(corner.x, corner.y)) AS flipped,
               el_contains(s.geometry, corner.x, corner.y) AS inside,
               round(el_distance(s.geometry, corner.x, corner.y), 6) AS distance
        FROM city JOIN {states} s ON s.id = city.adm4
        """,
        cities=shapes_at(source), relations=relations_at(source), states=shapes_at(source, 4),
    )


@query
def point_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.extent(detections(spark, sf_dir))


# --- hierarchy -------------------------------------------------------------------------------------------


@query
def hierarchy_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.parent_links(areas(spark, sf_dir)).select(
        "adm", "id", "name", "parent_id", "parent_level", "parent_name"
    )


@query
def hierarchy_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.relations(areas(spark, sf_dir), LEVELS)


@query
def shapes_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.shapes_table(areas(spark, sf_dir))


# --- cleaning --------------------------------------------------------------------------------------------


@query
def fire_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = plain_time(jobs.clean_fires(bindings.view(spark, sf_dir, bindings.SOURCE_FIRES)))
    return cleaned.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in ("bright_ti4", "bright_ti5", "frp", "scan", "track")})


@query
def fire_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.rejected_fires(jobs.clean_fires(bindings.view(spark, sf_dir, bindings.SOURCE_FIRES)))


@query
def weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_time(jobs.clean_weather(bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER)))


@query
def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.view(spark, sf_dir, bindings.STATION_LINES)
    parsed = jobs.clean_stations(lines.select(*readers.fixed_width(F.col("value"), readers.STATION_LAYOUT)))
    return parsed.withColumn("elevation", F.col("elevation").try_cast("double"))


@query
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base name and stem of a path."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = F.regexp_replace("url", r"[?#].*$", "")
    return pages.select(
        "page_id", clean.base_name(path).alias("base_name"), clean.file_stem(clean.base_name(path)).alias("stem")
    )


# --- calendar --------------------------------------------------------------------------------------------


@query
def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and the last fire, with its labels and number of fires."""
    daily_fires = fires(spark, sf_dir).groupBy(F.to_date("datetime").alias("date")).agg(
        F.count(F.lit(1)).alias("fire_spots")
    )
    bounds = daily_fires.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    spine = bounds.select(F.explode(calendar.days(F.col("first"), F.col("last"))).alias("date"))
    return spine.join(daily_fires, "date", "left").select(
        "date",
        calendar.week_label(F.col("date")).alias("week"),
        calendar.month_name(F.col("date")).alias("month_name"),
        F.coalesce("fire_spots", F.lit(0)).alias("fire_spots"),
    )


@query
def weekly_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.weekly_readings(weather(spark, sf_dir), "PRCP")


@query
def weekly_sum_on_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sums on one year's labels a week apart; the weeks these do not meet are left out."""
    return analytics.weekly_readings(weather(spark, sf_dir), "PRCP", *SPINE)


@query
def weekly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = analytics.weekly_readings(weather(spark, sf_dir), "TAVG", mean=True)
    return weekly.withColumn("agg_value", F.round("agg_value", 6))


@query
def weekly_avg_on_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = analytics.weekly_readings(weather(spark, sf_dir), "TAVG", *SPINE, mean=True)
    return weekly.withColumn("agg_value", F.round("agg_value", 6))


@query
def readings_without_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many readings no weekly result can hold; every other one is in ``weekly_sum`` or ``weekly_avg``."""
    return analytics.untimed(weather(spark, sf_dir))


@query
def rolling_sums_weekly_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.rolling_rain(weather(spark, sf_dir))


@query
def rolling_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling sums of fractions: revenue per supplier and day of its own calendar."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sold = items.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(F.sum("l_extendedprice").alias("revenue"))
    return analytics.rolling_daily(sold, ["l_suppkey"], "revenue").select(
        "l_suppkey", "date", *[F.round(f"sum_w{n}", 2).alias(f"sum_w{n}") for n in analytics.WINDOWS]
    )


@query
def weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.weekly_fires(fires(spark, sf_dir)).orderBy("adm", "year", "week")


@query
def weekly_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = analytics.rain_and_fires(weather(spark, sf_dir), fires(spark, sf_dir))
    return weekly.orderBy("adm", "year", "week")


@query
def rolling_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.rain_fire_correlation(
        analytics.rain_and_fires(weather(spark, sf_dir), fires(spark, sf_dir))
    )
    return found.select(
        "adm", "year", *[F.round(c, 6).alias(c) for c in found.columns if c.endswith("_correlation")]
    )


# --- fires by month and area -----------------------------------------------------------------------------


@query
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.monthly_fires(fires(spark, sf_dir)).orderBy("adm4_name", "year", "month")


@query
def region_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the order of the month's name, as a table to be pivoted later."""
    return analytics.region_month_fires(fires(spark, sf_dir)).orderBy("adm4_name", "year", "month_name")


@query
def region_month_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = analytics.region_month_pivot(analytics.region_month_fires(fires(spark, sf_dir)))
    names = [n.lower() for n in calendar.MONTH_NAMES]
    return wide.withColumns({n: F.round(n, 6) for n in names})


@query
def area_month_counts_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = areas(spark, sf_dir)
    return analytics.area_month_fires(
        fires(spark, sf_dir), shapes_at(source), relations_at(source), YEARS
    )


@query
def shapes_of_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = areas(spark, sf_dir)
    return analytics.shapes_of_parents(shapes_at(source), relations_at(source))


@query
def points_of_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.fires_of_parents(fires(spark, sf_dir))


@query
def points_of_one_parent_and_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality on state, year and month is the question asked here."""
    return analytics.fires_of_parents(fires(spark, sf_dir), "NATION_7", 1997, 8)


@query
def stations_of_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stations_of_parents(stations(spark, sf_dir))


@query
def stations_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stations_with_data(weather(spark, sf_dir), stations(spark, sf_dir), YEARS)


@query
def shape_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = areas(spark, sf_dir)
    return analytics.shapes_by_name(shapes_at(source), relations_at(source))


@query
def shapes_of_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name's shape from the table of shapes as the job writes it, kept in order of ids."""
    source, folder = areas(spark, sf_dir), shared_folder(spark, "shapes")
    sinks.replace_table(jobs.shapes_table(source), folder, ["adm"], jobs.ROWS_PER_SHAPE_FILE, ["id"])
    shapes = readers.at_level(readers.read_table(spark, folder), 8)
    return analytics.shapes_by_name(shapes, relations_at(source), "Customer#000000007")


# --- quality ---------------------------------------------------------------------------------------------


@query
def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_years(fires(spark, sf_dir), range(1990, 2011))


@query
def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run dates with the number of fires of the week before, by SQL with named parameters."""
    fires(spark, sf_dir).createOrReplaceTempView("el_fires")
    return spark.sql(
        """
        SELECT CAST(datetime AS DATE) AS day, COUNT(*) AS fire_spots FROM el_fires
        WHERE CAST(datetime AS DATE) >= date_sub(CAST(:run_date AS DATE), :days)
          AND CAST(datetime AS DATE) <= CAST(:run_date AS DATE)
        GROUP BY CAST(datetime AS DATE)
        """,
        args={"run_date": "2001-08-01", "days": 7},
    )


@query
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that run after each job, with the two that must fail on these tables."""
    fire, rain = fires(spark, sf_dir), weather(spark, sf_dir)
    shape = areas(spark, sf_dir).select("admin_level", "osm_id")
    return quality.report(
        {
            "fires within 3 days": (quality.has_recent_rows(fire, "2001-08-02", 3), 1),
            "fires within 2 days": (quality.has_recent_rows(fire, "2001-08-02", 2), 1),
            "fires within 3 days, stale": (quality.has_recent_rows(fire, "2005-01-01", 3), 1),
            "weather within 7 days": (quality.has_recent_rows(rain, "2001-11-06", 7), 1),
            "fires cover the years": (quality.missing_year_count(fire, YEARS), 0),
            "fires cover more years": (quality.missing_year_count(fire, range(1995, 2005)), 0),
            "weather covers the years": (quality.missing_year_count(rain, YEARS), 0),
            "countries present": (quality.has_rows(shape.where("admin_level = 2")), 1),
            "stations present": (quality.has_rows(stations(spark, sf_dir)), 1),
            "weather in the year": (quality.has_rows_in_year(rain, "2001-11-06"), 1),
            "fires in the year": (quality.has_rows_in_year(fire, "2001-08-02"), 1),
        }
    )


# --- files -----------------------------------------------------------------------------------------------


@query
def manifest_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each date the manifest's first file."""
    listed = bindings.view(spark, sf_dir, bindings.MANIFEST)
    entries = archive.manifest_entries(listed, F.substring("last_modified", 1, 10))
    first = F.min(F.struct(F.col("mtime").cast("long").alias("order"), "filename", "link", "mtime", "last_modified"))
    return entries.groupBy("date").agg(first.alias("first")).select(
        "date", "first.filename", "first.link", "first.mtime", "first.last_modified"
    )


@query
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections packed into zip archives, two members each and one to pass over, and unpacked again."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, batch in enumerate(batches):
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as opened:
                for name, rows in (("even", batch[batch.event_id % 2 == 0]), ("odd", batch[batch.event_id % 2 == 1])):
                    opened.writestr(f"fires/{name}.csv", rows.to_csv(index=False, header=False, lineterminator="\n"))
                opened.writestr("fires/readme.txt", "not data\n")
            yield pd.DataFrame({"path": [f"batch-{number}.zip"], "content": [held.getvalue()]})

    rows = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES).select("event_id", "longitude", "latitude")
    files = rows.mapInPandas(pack, "path string, content binary")
    lines = archive.zip_lines(files, lambda member: member.endswith(".csv"))
    fields = F.split("line", ",")
    return lines.select(
        clean.file_stem(clean.base_name(F.col("member"))).alias("member"),
        fields[0].cast("bigint").alias("event_id"),
        fields[1].alias("longitude"),
        fields[2].alias("latitude"),
    )


@query
def landed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections packed into archive files, read member by member, landed as one gzip text per member, read back."""
    folder = shared_folder(spark, "archives")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, batch in enumerate(batches):
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as opened:
                for rest, rows in batch.groupby(batch.event_id % 3):
                    text = rows.to_csv(index=False, header=False, lineterminator="\n")
                    opened.writestr(f"fires/third-{rest}.csv", text)
                opened.writestr("fires/readme.txt", "not data\n")
            name = f"{folder}/batch-{batch.event_id.min()}-{number}.zip"
            store, path, _ = store_of(name)
            store.create_dir(path.rpartition("/")[0])
            with store.open_output_stream(path) as out:
                out.write(held.getvalue())
            yield pd.DataFrame({"path": [name]})

    rows = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES).select("event_id", "longitude", "latitude")
    rows.mapInPandas(pack, "path string").write.format("noop").mode("overwrite").save()
    lines = archive.read_zip_lines(spark, f"{folder}/batch-*.zip", lambda member: member.endswith(".csv"))
    stem = lambda c: clean.file_stem(clean.base_name(F.col(c)))
    archive.land_members(lines, f"{folder}/landed", F.concat(stem("archive"), F.lit("_"), stem("member")))
    fields = F.split("value", ",")
    return spark.read.text(f"{folder}/landed").select(
        F.substring_index("file", "_", -1).alias("member"),
        fields[0].cast("bigint").alias("event_id"),
        fields[1].alias("longitude"),
        fields[2].alias("latitude"),
    )


@query
def landed_fires_in_one_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV of two instruments, one of them with its columns in another order as well, in one folder."""
    raw = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES).drop("event_id")
    folder = shared_folder(spark, "mixed")
    variant = F.col("confidence") == "error"
    renamed = raw.where(~variant).withColumnsRenamed({"brightness": "bright_ti4", "bright_t31": "bright_ti5"})
    late = F.col("acq_date") >= "1998-01-01"
    for name, part in (
        ("one", raw.where(variant)),
        ("two", renamed.where(late)),
        ("three", renamed.where(~late).select(*reversed(renamed.columns))),
    ):
        sinks.land_csv(part, f"{folder}/{name}")
    unified = readers.read_fires(spark, f"{folder}/*")
    return unified.select("longitude", "latitude", "bright_ti4", "bright_ti5", "confidence", "acq_date", "acq_time")


@query
def landed_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV of two instruments with different headers, written, read back and unified."""
    raw = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES).drop("event_id")
    folder = shared_folder(spark, "fires")
    variant = F.col("confidence") == "error"
    sinks.land_csv(raw.where(variant), f"{folder}/one")
    renamed = raw.where(~variant).withColumnsRenamed({"brightness": "bright_ti4", "bright_t31": "bright_ti5"})
    columns = renamed.columns
    sinks.land_csv(renamed.select(*reversed(columns)), f"{folder}/two")
    unified = readers.read_fires(spark, f"{folder}/one", f"{folder}/two")
    return unified.select("longitude", "latitude", "bright_ti4", "bright_ti5", "confidence", "acq_date", "acq_time")


@query
def landed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless gzip CSV, written and read back with the fixed schema."""
    folder = shared_folder(spark, "weather")
    raw = bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER)
    sinks.land_csv(raw.select(*readers.WEATHER_COLUMNS), folder, header=False)
    return readers.read_weather(spark, folder)


@query
def landed_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width gzip text, written and read back."""
    folder = shared_folder(spark, "stations")
    sinks.land_text(bindings.view(spark, sf_dir, bindings.STATION_LINES), folder)
    return readers.read_fixed_width(spark, folder).select("id", "latitude", "longitude", "state", "name", "wmo_id")


@query
def landed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines by level, read back through a path glob."""
    folder = shared_folder(spark, "areas")
    source = areas(spark, sf_dir)
    for level in (2, 4, 8):
        source.where(F.col("admin_level") == level).write.mode("overwrite").json(f"{folder}/level{level}")
    return readers.read_shapes(spark, f"{folder}/level{{2,4,8}}")


@query
def dynamic_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all fires by year and month, replace one year with marked rows, read everything back."""
    folder = shared_folder(spark, "overwrite")
    rows = fires(spark, sf_dir).select(
        "fire_id", "adm", F.lit(0).alias("load"),
        F.year("datetime").alias("year"), F.month("datetime").alias("month"),
    )
    sinks.replace_partitions(rows, folder, ["year", "month"])
    again = rows.where(F.col("year") == 1997).withColumn("load", F.lit(1))
    sinks.replace_partitions(again, folder, ["year", "month"])
    return readers.read_table(spark, folder, ["fire_id", "adm", "load", "year", "month"])


@query
def merged_half_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fires by year and month, then the second half of each month, some of it known already, merged into them."""
    folder = shared_folder(spark, "merge")
    rows = fires(spark, sf_dir).select(
        "fire_id", "adm", F.dayofmonth("datetime").alias("day"), F.lit(0).alias("load"),
        F.year("datetime").alias("year"), F.month("datetime").alias("month"),
    )
    first = rows.where((F.col("day") < 16) | (F.col("fire_id") % 3 == 0))
    sinks.replace_partitions(first, folder, ["year", "month"])
    late = rows.where((F.col("day") >= 16) & (F.col("year") > 1995)).withColumn("load", F.lit(1))
    sinks.merge_partitions(late.unionByName(late.where("fire_id % 5 = 0")), folder, ["year", "month"], ["fire_id"])
    return readers.read_table(spark, folder, ["fire_id", "adm", "day", "load", "year", "month"])


@query
def named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables registered by name, from a frame and from a path with chosen columns, for one SQL text."""
    folder = shared_folder(spark, "named")
    sinks.replace_table(stations(spark, sf_dir), folder)
    readers.register_tables(
        spark, [("el_station", folder, ["id", "adm4_name"]), ("el_reading", weather(spark, sf_dir), ["station", "element", "value"])]
    )
    return spark.sql(
        """
        SELECT adm4_name, element, COUNT(*) AS readings, SUM(value) AS total
        FROM el_reading JOIN el_station ON station = id GROUP BY adm4_name, element
        """
    )


@query
def static_overwrite_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes by level with a cap on rows per file, replaced as a whole, one level read back."""
    folder = shared_folder(spark, "shapes")
    table = jobs.shapes_table(areas(spark, sf_dir))
    sinks.replace_table(table.where("adm = 2"), folder, ["adm"], jobs.ROWS_PER_SHAPE_FILE)
    sinks.replace_table(table, folder, ["adm"], jobs.ROWS_PER_SHAPE_FILE)
    return readers.at_level(readers.read_table(spark, folder), 8)


@query
def pruned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read one element and year of weather kept by element, year and month, chosen columns only."""
    folder = shared_folder(spark, "by-element")
    rows = weather(spark, sf_dir).withColumns(
        {"year": F.year("datetime"), "month": F.month("datetime")}
    )
    sinks.replace_partitions(rows, folder, ["element", "year", "month"])
    wanted = (F.col("element") == "PRCP") & (F.col("year") == 1997) & (F.col("distance_from_station") == 0)
    return readers.read_table(spark, folder, ["station", "value", "month", "adm"], wanted)


def _landed_lake(spark: SparkSession, sf_dir: str) -> daily.Lake:
    """A lake with landed areas and stations and the tables made of them."""
    lake = daily.Lake(shared_folder(spark, "lake"))
    areas(spark, sf_dir).write.json(lake.landed("shapes"))
    sinks.land_text(bindings.view(spark, sf_dir, bindings.STATION_LINES), lake.landed("stations"))
    daily.rebuild_areas(spark, lake, LEVELS)
    daily.rebuild_stations(spark, lake)
    return lake


def _land_by_year(lake: daily.Lake, kind: str, rows: DataFrame, columns: Sequence[str], header: bool = True) -> list[int]:
    """Add rows (with ``folder``) as files to each year's folder, a few side by side; returns the years."""
    years = sorted(row["folder"] for row in rows.select("folder").distinct().collect())

    def land(year: int) -> None:
        part = rows.where(F.col("folder") == year).select(*columns)
        sinks.land_csv(part, lake.landed(f"{kind}/{year}"), header=header, mode="append")

    with ThreadPoolExecutor(daily.AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(rows.sparkSession)(land), years))
    return years


def _land_fires(lake: daily.Lake, rows: DataFrame) -> list[int]:
    return _land_by_year(lake, "fires", rows, [c for c in rows.columns if c not in ("event_id", "folder")])


def _land_weather(lake: daily.Lake, rows: DataFrame) -> list[int]:
    rows = rows.withColumn("folder", F.substring("date", 1, 4).cast("int"))
    return _land_by_year(lake, "weather", rows, readers.WEATHER_COLUMNS, header=False)


@query
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land everything by year, build all tables, and count the fire fact by month and state."""
    lake = _landed_lake(spark, sf_dir)
    raw = bindings.view(spark, sf_dir, bindings.SOURCE_FIRES)
    fire_years = _land_fires(lake, raw.withColumn("folder", F.substring("acq_date", 1, 4).cast("int")))
    weather_years = _land_weather(lake, bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER))
    daily.load_years(spark, lake, fire_years, weather_years)
    fact = readers.read_table(spark, lake.table("fires"))
    return fact.groupBy("year", "month", "adm4_name").agg(F.count(F.lit(1)).alias("fire_spots"))


@query
def daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a day's run and of a back-fill, from what was seen while the tables were written."""
    lake = _landed_lake(spark, sf_dir)
    _land_fires(lake, bindings.view(spark, sf_dir, bindings.RUN_FIRES).where("folder >= 2000"))
    _land_weather(lake, bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER).where("date >= '2000'"))
    results = daily.load_years(spark, lake, [2000, 2001], [2000, 2001])
    written = {kind: daily.rebuild(spark, lake, kind, [2001])[2001] for kind in daily.FACTS}
    results += daily.run_checks(spark, lake, "2001-11-05", written)
    results += daily.run_checks(spark, lake, "2002-03-01", written)
    rows = [(n, *result, result.passed) for n, result in enumerate(results)]
    return spark.createDataFrame(rows, "number int, check string, value int, expected int, passed boolean")


@query
def weather_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather fact rebuilt year by year, one year twice, with the readings whose time is unreadable."""
    lake = _landed_lake(spark, sf_dir)
    years = _land_weather(lake, bindings.view(spark, sf_dir, bindings.SOURCE_WEATHER))
    daily.load_years(spark, lake, [], years)
    daily.reprocess_weather(spark, lake, [1997])
    fact = spark.read.schema("element string, year int, month int, adm string, value int").parquet(lake.table("weather"))
    return fact.groupBy("element", "year", "month", "adm").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("value").alias("total")
    )


def _caught_up(spark: SparkSession, sf_dir: str) -> tuple[daily.Lake, list[dict[str, list[int]]]]:
    """Four runs: after the first four years landed, again, after the others and more files of 1996 landed, and again."""
    lake = _landed_lake(spark, sf_dir)
    fire, rain = (bindings.view(spark, sf_dir, v) for v in (bindings.RUN_FIRES, bindings.SOURCE_WEATHER))
    extra = F.col("event_id") % 5 == 0
    early = F.col("folder") <= 1998
    more = F.col("folder") == 1996
    _land_fires(lake, fire.where(early & ~(more & extra)))
    _land_weather(lake, rain.where("date < '1999'"))
    runs = [daily.sync(spark, lake), daily.sync(spark, lake)]
    _land_fires(lake, fire.where(~early | (more & extra)))
    _land_weather(lake, rain.where("date >= '1999'"))
    runs += [daily.sync(spark, lake), daily.sync(spark, lake)]
    return lake, runs


@query
def catch_up_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years that each of four runs of the ledger rebuilt."""
    _, runs = _caught_up(spark, sf_dir)
    rows = [(n, kind, year) for n, run in enumerate(runs, 1) for kind, years in run.items() for year in years]
    return spark.createDataFrame(rows, "run int, kind string, year int")


@query
def caught_up_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fire fact after runs that rebuilt only what had changed: equal to one build of everything."""
    lake, _ = _caught_up(spark, sf_dir)
    fact = spark.read.schema("datetime timestamp, adm string, year int, month int").parquet(lake.table("fires"))
    return fact.groupBy("year", "month", "adm").agg(
        F.count(F.lit(1)).alias("fire_spots"), F.count("datetime").alias("with_time")
    )


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["points_in_areas"](spark, sf_dir)
