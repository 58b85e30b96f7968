"""Calendar series and labels."""

from __future__ import annotations

from calendar import isleap
from datetime import date, timedelta
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: English month abbreviations in calendar order
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def week_number(day: Column) -> Column:
    """Week of the year counted from the first Monday (00 to 53)."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def label_of(month: Column, week: Column) -> Column:
    """``MM-WW`` of a month and a week of the year; null for none."""
    return F.concat(F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def week_label(day: Column) -> Column:
    """``MM-WW``: month, then the week of the year; null for no day."""
    return label_of(F.month(day), week_number(day))


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMM")


def month_name_of(number: Column) -> Column:
    """Abbreviation for a month number; null for none."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    return F.when(number.between(1, 12), F.get(names, number - 1))


def days(start: Column, end: Column, step: int = 1) -> Column:
    """Array of dates from start to end, both included, every ``step`` days."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr(f"interval {int(step)} days"))


def week_labels(start: str, end: str, step: int = 7) -> Column:
    """Array of the distinct week labels met when walking from start to end."""
    return F.array_distinct(F.transform(days(F.lit(start), F.lit(end), step), week_label))


@lru_cache(maxsize=1)
def kinds_of_year() -> tuple[tuple[str, ...], ...]:
    """Week labels of the fourteen kinds of year: by the weekday they begin with (Monday first), plain before leap."""
    labels = {}
    for year in range(2000, 2028):
        first = date(year, 1, 1)
        days_ = (first + timedelta(n) for n in range((date(year + 1, 1, 1) - first).days))
        labels[first.weekday(), isleap(year)] = tuple(sorted({day.strftime("%m-%W") for day in days_}))
    return tuple(labels[weekday, leap] for weekday in range(7) for leap in (False, True))


def week_labels_of(year: Column) -> Column:
    """Array of all week labels of a year, looked up by the weekday of its first day and whether it is leap."""
    first, last = (F.make_date(year, F.lit(month), F.lit(day)) for month, day in ((1, 1), (12, 31)))
    calendars = F.array(*[F.split(F.lit(",".join(labels)), ",") for labels in kinds_of_year()])
    return F.get(calendars, F.weekday(first) * 2 + F.dayofyear(last) - 365)


def spine(spark: SparkSession, start: str, end: str, step: int = 1) -> DataFrame:
    """Calendar table: one row per date with its week label, month name, year and month."""
    day = F.col("date")
    return spark.range(1).select(F.explode(days(F.lit(start), F.lit(end), step)).alias("date")).select(
        day,
        week_label(day).alias("week"),
        month_name(day).alias("month_name"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )
