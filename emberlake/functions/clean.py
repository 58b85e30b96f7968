"""Tolerant conversions for dirty text: anything unreadable becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: names one instrument uses for the columns of the other
VARIANT_NAMES = {"brightness": "bright_ti4", "bright_t31": "bright_ti5"}


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename instrument-specific columns; names that are absent are left alone."""
    return df.withColumnsRenamed(VARIANT_NAMES)


def clock(text: Column) -> Column:
    """``0412`` and ``04:12`` to ``04:12``; a three-digit time stays as it is."""
    return F.regexp_replace(text, "(.{2}):?(.{2})", "$1:$2")


def fire_time(date: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat(date, F.lit(" "), clock(time)), F.lit("yyyy-MM-dd HH:mm"))


def weather_time(date: Column, time: Column) -> Column:
    """Observation time; a missing hour means midnight."""
    return F.try_to_timestamp(F.concat(date, F.coalesce(time, F.lit("0000"))), F.lit("yyyyMMddHHmm"))


def real(text: Column) -> Column:
    return text.try_cast("float")


def whole(text: Column) -> Column:
    """Text to int; a fraction is cut off."""
    return F.regexp_replace(text, r"\.\d*\s*$", "").try_cast("int")


def base_name(path: Column) -> Column:
    """Last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


def file_stem(name: Column) -> Column:
    """File name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name, r"((?:^|/)\.*[^./][^/]*)\.[^./]*$", "$1")
