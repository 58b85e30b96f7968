"""Administrative hierarchy: from a comma list of parents per area to one column pair per level."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.operators.skew import BROADCAST_BYTES, HOT_ROWS, dimension_join

ANCESTOR = re.compile(r"^adm\d+(_name)?$")


def ancestor_columns(df: DataFrame) -> list[str]:
    """The columns that carry an ancestor, ``adm4``, ``adm4_name`` and so on."""
    return [name for name in df.columns if ANCESTOR.match(name)]


def parent_levels(shapes: DataFrame) -> list[int]:
    """Levels above the deepest one; a handful of values."""
    levels = sorted(row[0] for row in shapes.select("admin_level").distinct().collect())
    return levels[:-1]


def parent_links(
    shapes: DataFrame, limit: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per area and parent with the parent's level and name; a root keeps one row without parent.

    All areas of a country share its id as parent, so the lookup side is broadcast or the hot parents
    are salted.
    """
    children = shapes.select(
        F.col("admin_level").alias("adm"),
        F.col("osm_id").cast("string").alias("id"),
        "name",
        F.explode_outer(F.split("parents", ",")).alias("parent_id"),
    )
    parents = shapes.select(
        F.col("osm_id").cast("string").alias("parent_id"),
        F.col("admin_level").alias("parent_level"),
        F.col("name").alias("parent_name"),
    )
    return dimension_join(children, parents, ["parent_id"], "left", limit, hot_rows)


def relations(shapes: DataFrame, levels: Sequence[int] | None = None, **options) -> DataFrame:
    """``adm, id, name`` and ``adm{n}, adm{n}_name`` for each parent level n. Roots stay, all null."""
    levels = list(levels) if levels is not None else parent_levels(shapes)
    wide = (
        parent_links(shapes, **options)
        .groupBy("adm", "id", "name")
        .pivot("parent_level", levels)
        .agg(F.min(F.struct("parent_id", "parent_name")))
    )
    ancestors = []
    for level in levels:
        found = F.col(f"`{level}`")
        ancestors += [found["parent_id"].alias(f"adm{level}"), found["parent_name"].alias(f"adm{level}_name")]
    return wide.select("adm", "id", "name", *ancestors)
