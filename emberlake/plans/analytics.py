"""Queries over the lake tables, each for all areas, months and years at once.

``fires`` has ``adm, adm_name, adm{n}_name, datetime, geometry``; ``weather`` has ``station, element, value,
datetime, distance_from_station, adm...``; ``shapes`` has ``id, geometry``; ``relations`` has ``id, name,
adm{n}...``. A question about one city, state or month is a filter on the result or on the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions import calendar
from emberlake.functions.stats import correlation
from emberlake.operators import calendars
from emberlake.operators.skew import dimension_join
from emberlake.session import spread

WINDOWS = (15, 30, 60, 90, 120, 150)  # fixed values: days
LOOK_BACK = "11-01"  # fixed value: the rolling calendar starts on this day of the year before
MONTHS = list(range(1, 13))
LOOKED_UP = 1000  # ids that a lookup sends as a filter; more are joined


def inside_only(weather: DataFrame) -> DataFrame:
    """Readings of stations that lie within the area."""
    return weather.where(F.col("distance_from_station") == 0)


# --- weather by week -------------------------------------------------------------------------------------


def timed(rows: DataFrame) -> DataFrame:
    """Rows with a time: what has none belongs to no week, month or year. ``untimed`` counts the others."""
    return rows.where(F.col("datetime").isNotNull())


def untimed(rows: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``without_time``."""
    lost = F.count(F.when(F.col("datetime").isNull(), 1))
    return rows.agg(F.count(F.lit(1)).alias("rows"), lost.alias("without_time"))


def weekly_readings(
    weather: DataFrame,
    element: str,
    start: str | None = None,
    end: str | None = None,
    mean: bool = False,
    key: str = "adm",
) -> DataFrame:
    """Weekly sum or mean per area and year with the number of readings, on a spine of week labels.

    Without start and end the spine has all labels of each year, and every reading with a time is in the
    result. With them it steps seven days from start to end, its labels apply to each year, and readings in
    a week that it does not meet are left out. A week without readings has count 0 and a null value.
    ``days_recorded`` counts readings, also those whose value is null.
    """
    value = F.avg("value") if mean else F.sum("value")
    when = F.col("datetime")
    # numbers are grouped, and written out once per group
    weekly = (
        timed(inside_only(weather))
        .where(F.col("element") == element)
        .groupBy(key, F.year(when).alias("year"), F.month(when).alias("_month"), calendar.week_number(when).alias("_week"))
        .agg(F.count(F.lit(1)).alias("days_recorded"), value.alias("agg_value"))
    )
    label = calendar.label_of(F.col("_month"), F.col("_week")).alias("week")
    weekly = weekly.select(key, "year", label, "days_recorded", "agg_value")
    spine = calendar.week_labels(start, end) if start and end else calendar.week_labels_of(F.col("year"))
    filled = calendars.fill(weekly, [key, "year"], "week", spine, ["days_recorded", "agg_value"])
    return filled.withColumn("days_recorded", F.coalesce("days_recorded", F.lit(0)))


# --- rain before fires -----------------------------------------------------------------------------------


def rolling_rain(
    weather: DataFrame, element: str = "PRCP", windows: Sequence[int] = WINDOWS, key: str = "adm"
) -> DataFrame:
    """Per area, year and week the largest sum over the preceding days, for each window length.

    Each year runs on its own calendar from the look-back day of the year before. Readings are summed per
    day before anything is gathered, so an area's rows number no more than its calendar days.
    """
    daily = (
        inside_only(weather)
        .where(F.col("element") == element)
        .groupBy(key, F.to_date("datetime").alias("date"))
        .agg(F.sum("value").alias("value"))
    )
    own = F.year("date")
    used_in = F.when(F.date_format("date", "MM-dd") >= LOOK_BACK, F.array(own, own + 1)).otherwise(F.array(own))
    by_year = daily.select(
        key, F.explode(used_in).alias("year"), F.struct("date", "value").alias("day"), own.alias("own")
    )
    recorded = spread(by_year, key, "year").groupBy(key, "year").agg(
        F.collect_list("day").alias("days"), F.max(F.col("own") == F.col("year")).alias("has_readings")
    )
    first = F.to_date(F.concat((F.col("year") - 1).cast("string"), F.lit("-" + LOOK_BACK)))
    last = F.to_date(F.concat(F.col("year").cast("string"), F.lit("-12-31")))
    empty = F.transform(
        calendar.days(first, last),
        lambda d: F.struct(d.alias("date"), F.lit(None).cast("bigint").alias("value")),
    )
    calendar_days = (
        recorded.where("has_readings")
        .select(key, "year", F.inline(F.concat("days", empty)))
        .groupBy(key, "year", "date")
        .agg(F.sum("value").alias("value"))
    )
    rolled = calendars.rolling_sums(calendar_days, [key, "year"], "date", "value", windows)
    sums = [f"sum_w{n}" for n in windows]
    return (
        rolled.where(F.year("date") == F.col("year"))
        .groupBy(key, "year", calendar.week_label(F.col("date")).alias("week"))
        .agg(*[F.max(name).alias(name) for name in sums])
    )


def rolling_daily(daily: DataFrame, keys: Sequence[str], value: str, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Rolling sums of one value per key and ``date``, on each day between a key's first and last."""
    bounds = daily.where("date IS NOT NULL").groupBy(*keys).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    spine = spread(bounds, *keys).select(*keys, F.explode(calendar.days(F.col("first"), F.col("last"))).alias("date"))
    filled = spine.join(daily, [*keys, "date"], "left")
    return calendars.rolling_sums(filled, keys, "date", value, windows)


def weekly_fires(fires: DataFrame, key: str = "adm") -> DataFrame:
    """Number of fires per area, year and week."""
    return timed(fires).groupBy(
        key, F.year("datetime").alias("year"), calendar.week_label(F.col("datetime")).alias("week")
    ).agg(F.count(F.lit(1)).alias("fire_spots"))


def rain_and_fires(weather: DataFrame, fires: DataFrame, key: str = "adm", **options) -> DataFrame:
    """Rolling rain with the week's number of fires, zero where there were none."""
    rain = rolling_rain(weather, key=key, **options)
    return rain.join(weekly_fires(fires, key), [key, "year", "week"], "left").withColumn(
        "fire_spots", F.coalesce("fire_spots", F.lit(0))
    )


def rain_fire_correlation(weekly: DataFrame, windows: Sequence[int] = WINDOWS, key: str = "adm") -> DataFrame:
    """Correlation of each rolling sum with the number of fires, per area and year."""
    return weekly.groupBy(key, "year").agg(
        *[correlation(f"sum_w{n}", "fire_spots").alias(f"w{n}_correlation") for n in windows]
    )


# --- fires by month --------------------------------------------------------------------------------------


def monthly_fires(fires: DataFrame, parent: str = "adm4_name") -> DataFrame:
    """Fires per parent area, year and month."""
    return (
        timed(fires)
        .groupBy(parent, F.year("datetime").alias("year"), F.month("datetime").alias("month"))
        .agg(F.count(F.lit(1)).alias("fire_spots"))
        .withColumn("month_name", calendar.month_name_of(F.col("month")))
    )


def region_month_fires(fires: DataFrame, parent: str = "adm4_name") -> DataFrame:
    """Fires per region and month; a region is named by level 7, else by level 6.

    Groups follow both names, so two groups may carry one region label.
    """
    return (
        timed(fires)
        .groupBy(
            parent,
            "adm7_name",
            "adm6_name",
            F.year("datetime").alias("year"),
            F.month("datetime").alias("month"),
        )
        .agg(F.count(F.lit(1)).alias("fire_spots"))
        .select(
            parent,
            F.coalesce("adm7_name", "adm6_name").alias("region"),
            "year",
            "fire_spots",
            calendar.month_name_of(F.col("month")).alias("month_name"),
            "month",
        )
    )


def region_month_pivot(counts: DataFrame, parent: str = "adm4_name") -> DataFrame:
    """Regions by months, one column per month in calendar order, zero where there is none.

    Groups that share a region label are averaged.
    """
    wide = counts.groupBy(parent, "year", "region").pivot("month", MONTHS).agg(F.avg("fire_spots"))
    return wide.select(
        parent,
        "year",
        "region",
        *[
            F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(calendar.MONTH_NAMES[n - 1].lower())
            for n in MONTHS
        ],
    )


def area_month_fires(fires: DataFrame, shapes: DataFrame, relations: DataFrame, years: Sequence[int]) -> DataFrame:
    """Fires of every area in each month of the years, zero included, with the area's geometry."""
    counts = (
        fires.where(F.year("datetime").isin([int(y) for y in years]))
        .groupBy(
            F.col("adm").alias("id"), F.year("datetime").alias("year"), F.month("datetime").alias("month")
        )
        .agg(F.count(F.lit(1)).alias("fire_spots"))
    )
    # at most one entry per month of the calendar, so an area's counts fit in one row
    slots = F.map_from_entries(F.collect_list(F.struct(F.col("year") * 100 + F.col("month"), "fire_spots")))
    per_area = counts.groupBy("id").agg(slots.alias("slots"))
    areas = shapes_of_parents(shapes, relations)
    spine = F.explode(F.array(*[F.lit(y * 100 + m) for y in sorted(years) for m in MONTHS]))
    filled = areas.join(per_area, "id", "left").select("*", spine.alias("slot"))
    return filled.select(
        "id",
        "adm4_name",
        F.floor(F.col("slot") / 100).cast("int").alias("year"),
        (F.col("slot") % 100).alias("month"),
        F.coalesce(F.try_element_at("slots", F.col("slot")), F.lit(0)).alias("fire_spots"),
        "geometry",
    )


# --- lookups ---------------------------------------------------------------------------------------------


def _of_parent(table: DataFrame, parent: str | None, column: str) -> DataFrame:
    return table if parent is None else table.where(F.col(column) == parent)


def shapes_of_parents(shapes: DataFrame, relations: DataFrame, parent: str | None = None) -> DataFrame:
    """Shapes with the state they belong to, of one state or of all."""
    names = _of_parent(relations, parent, "adm4_name").select("id", "adm4_name")
    return shapes.select("id", "geometry").join(names, "id")


def fires_of_parents(
    fires: DataFrame, parent: str | None = None, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Fire points with state, year and month, narrowed as asked."""
    rows = _of_parent(fires, parent, "adm4_name")
    if year is not None:
        rows = rows.where(F.year("datetime") == year)
    if month is not None:
        rows = rows.where(F.month("datetime") == month)
    return rows.select(
        "adm4_name", F.year("datetime").alias("year"), F.month("datetime").alias("month"), "geometry"
    )


def stations_of_parents(stations: DataFrame, parent: str | None = None) -> DataFrame:
    return _of_parent(stations, parent, "adm4_name").select("adm4_name", "geometry", "id")


def stations_with_data(
    weather: DataFrame, stations: DataFrame, years: Sequence[int], parent: str | None = None
) -> DataFrame:
    """Stations that have readings in the years, with their position.

    Readings are reduced to distinct stations before the join.
    """
    rows = _of_parent(weather, parent, "adm4_name")
    if "year" in rows.columns:
        rows = rows.where(F.col("year").isin([int(y) for y in years]))
    else:
        rows = rows.where(F.year("datetime").isin([int(y) for y in years]))
    recorded = rows.select("station").distinct()
    places = _of_parent(stations, parent, "adm4_name") if parent is not None else stations
    places = places.groupBy(F.col("id").alias("station")).agg(F.min("geometry").alias("geometry"))
    return recorded.join(places, "station")


def shapes_by_name(shapes: DataFrame, relations: DataFrame, name: str | None = None) -> DataFrame:
    """The shape of a named area, or of every named area.

    A name's ids are found first and become a filter on the shapes, so that a table kept in order of ids opens the row
    groups that may hold them and no other geometry. A name of very many areas is joined instead.
    """
    found = _of_parent(relations, name, "name").select("id", "name")
    if name is not None:
        ids = [row["id"] for row in found.select("id").distinct().limit(LOOKED_UP + 1).collect()]
        if len(ids) <= LOOKED_UP:
            return shapes.select("id", "geometry").where(F.col("id").isin(ids)).withColumn("name", F.lit(name))
    return dimension_join(shapes.select("id", "geometry"), found, ["id"])
