"""Planar geometry as Column expressions: WKT, projection, point-in-polygon and distance.

A polygon is an array of edges, ``array<struct<x1,y1,x2,y2>>`` with ``y1 <= y2``. Even-odd counting over
the edges of all rings handles holes and multi-part polygons alike, so rings need no roles.
Coordinates are x = longitude, y = latitude throughout.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0  # fixed value: metres, EPSG:3857
POLE_GUARD = 89.99  # the projection is infinite at the poles

EDGE_TYPE = "struct<x1:double,y1:double,x2:double,y2:double>"


def number(text: Column) -> Column:
    """Text to double; text that is no number, NaN included, becomes null."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def point_wkt(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def strip_srid(geom: Column) -> Column:
    """Drop a leading ``SRID=...;``."""
    return F.substring_index(geom, ";", -1)


def flip(point: Column) -> Column:
    """Swap the axes of a point."""
    return F.struct(point["y"].alias("x"), point["x"].alias("y"))


def _rings_of(wkt: Column, corner) -> Column:
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(texts, lambda ring: F.transform(F.split(ring, ","), corner))


def _corner(text: Column) -> list[Column]:
    parts = F.split(F.trim(text), r"\s+")
    x, y = (F.try_element_at(parts, F.lit(n)).try_cast("double") for n in (1, 2))
    return [x.alias("x"), y.alias("y"), (F.size(parts) > 2).alias("more")]


def wkt_rings(wkt: Column) -> Column:
    """POLYGON / MULTIPOLYGON text to ``array<array<struct<x,y>>>``, one entry per ring."""
    return _rings_of(wkt, lambda text: F.struct(*_corner(text)[:2]))


def wkt_corners(wkt: Column) -> Column:
    """The same with ``more``, whether a corner has more than two numbers."""
    return _rings_of(wkt, lambda text: F.struct(*_corner(text)))


def area_fault(wkt: Column, rings: Column) -> Column:
    """Why a text is no area, given its rings; null for an area that can be read in full.

    In this order: ``no polygon`` (other or no text, brackets that do not match, no ring), ``unreadable number`` (a
    corner that is not two finite numbers), ``short ring`` (fewer than four corners), ``open ring`` (the last corner
    is not the first). One fault anywhere rejects the whole area: with a ring or an edge left out, even-odd
    counting would place points wrongly.
    """
    # rings and then polygons are replaced by one sign each, and the commas between them dropped, so that the
    # patterns repeat single signs only, whatever the number of rings
    marked = F.regexp_replace(F.regexp_replace(wkt, r"\([^()]+\)", "#"), r"(?<=#)\s*,\s*(?=#)", "")
    parts = F.regexp_replace(F.regexp_replace(marked, r"\(\s*#+\s*\)", "@"), r"(?<=@)\s*,\s*(?=@)", "")
    polygon = marked.rlike(r"(?i)^\s*POLYGON\s*\(\s*#+\s*\)\s*$")
    several = parts.rlike(r"(?i)^\s*MULTIPOLYGON\s*\(\s*@+\s*\)\s*$")
    finite = lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))
    read = lambda ring: F.forall(ring, lambda c: finite(c["x"]) & finite(c["y"]) & ~c["more"])
    return (
        F.when(~F.coalesce(polygon | several, F.lit(False)) | (F.size(rings) == 0), F.lit("no polygon"))
        .when(~F.forall(rings, read), F.lit("unreadable number"))
        .when(F.exists(rings, lambda ring: F.size(ring) < 4), F.lit("short ring"))
        .when(F.exists(rings, lambda ring: F.element_at(ring, 1) != F.element_at(ring, -1)), F.lit("open ring"))
    )


def checked_rings(wkt: Column) -> Column:
    """``struct<fault, rings>`` of an area's text; the text is taken apart once."""
    judged = lambda rings: F.struct(area_fault(wkt, rings).alias("fault"), rings.alias("rings"))
    return F.transform(F.array(wkt_corners(wkt)), judged)[0]


def ring_edges(rings: Column) -> Column:
    """All edges of all rings, each running upwards; an open ring is closed."""

    def edges(ring: Column) -> Column:
        first, last = F.element_at(ring, 1), F.element_at(ring, -1)
        closed = F.when(first == last, ring).otherwise(F.concat(ring, F.array(first)))
        after = F.slice(closed, F.lit(2), F.size(closed) - 1)
        before = F.slice(closed, F.lit(1), F.size(closed) - 1)
        return F.zip_with(before, after, upward)

    return F.flatten(F.transform(rings, edges))


def upward(a: Column, b: Column) -> Column:
    keep = a["y"] <= b["y"]
    return F.struct(
        F.when(keep, a["x"]).otherwise(b["x"]).alias("x1"),
        F.when(keep, a["y"]).otherwise(b["y"]).alias("y1"),
        F.when(keep, b["x"]).otherwise(a["x"]).alias("x2"),
        F.when(keep, b["y"]).otherwise(a["y"]).alias("y2"),
    )


def wkt_edges(wkt: Column) -> Column:
    return ring_edges(wkt_rings(wkt))


def mercator_x(lon: Column) -> Column:
    """EPSG:4326 longitude to EPSG:3857 metres."""
    return F.lit(EARTH_RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    """EPSG:4326 latitude to EPSG:3857 metres."""
    bounded = F.greatest(F.least(lat, F.lit(POLE_GUARD)), F.lit(-POLE_GUARD))
    return F.lit(EARTH_RADIUS) * F.ln(F.tan(F.pi() / 4 + F.radians(bounded) / 2))


def longitude(x: Column) -> Column:
    """EPSG:3857 metres back to EPSG:4326 longitude."""
    return F.degrees(x / F.lit(EARTH_RADIUS))


def latitude(y: Column) -> Column:
    """EPSG:3857 metres back to EPSG:4326 latitude."""
    return F.degrees(2 * F.atan(F.exp(y / F.lit(EARTH_RADIUS))) - F.pi() / 2)


def mercator_edges(edges: Column) -> Column:
    """Edges in degrees to edges in metres; the projection keeps them upward."""
    return F.transform(
        edges,
        lambda e: F.struct(
            mercator_x(e["x1"]).alias("x1"),
            mercator_y(e["y1"]).alias("y1"),
            mercator_x(e["x2"]).alias("x2"),
            mercator_y(e["y2"]).alias("y2"),
        ),
    )


def side(e: Column, x: Column, y: Column) -> Column:
    """Negative right of the upward edge, positive left of it, zero on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def on_edge(e: Column, x: Column, y: Column) -> Column:
    return (
        (e["y1"] <= y)
        & (y <= e["y2"])
        & (F.least(e["x1"], e["x2"]) <= x)
        & (x <= F.greatest(e["x1"], e["x2"]))
        & (side(e, x, y) == 0)
    )


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Whether the polygon contains the point; its boundary counts as inside."""

    def crossing_on_the_left(e: Column) -> Column:
        return (e["y1"] <= y) & (y < e["y2"]) & (side(e, x, y) < 0)

    return F.exists(edges, lambda e: on_edge(e, x, y)) | (
        F.size(F.filter(edges, crossing_on_the_left)) % 2 == 1
    )


def edge_distance(e: Column, x: Column, y: Column) -> Column:
    """Planar distance from a point to a segment."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ox, oy = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
    return F.sqrt(ox * ox + oy * oy)


def outline_distance(edges: Column, x: Column, y: Column) -> Column:
    """Planar distance from a point to the nearest edge; null without edges."""
    return F.array_min(F.transform(edges, lambda e: edge_distance(e, x, y)))


def distance(edges: Column, x: Column, y: Column) -> Column:
    """Planar distance from a point to a polygon, zero inside."""
    return F.when(covers(edges, x, y), F.lit(0.0)).otherwise(outline_distance(edges, x, y))


def batch_distances() -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """The function for Arrow batches; made here, it travels whole to workers, which need not have this package."""

    def distances(edges: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        """``distance`` of many points, each to its own polygon, whose edges are a list of four numbers each, one edge at least.

        The arithmetic is that of ``covers`` and ``edge_distance``, step by step, on whole batches.
        """
        if not len(edges):
            return pa.array([], pa.float64())
        x1, y1, x2, y2 = np.ascontiguousarray(edges.flatten().to_numpy().reshape(-1, 4).T)
        ends = edges.offsets.to_numpy() // 4
        starts, sizes = ends[:-1] - ends[0], np.diff(ends)
        px, py = (np.repeat(v.to_numpy(), sizes) for v in (x, y))
        dx, dy, fx, fy = x2 - x1, y2 - y1, px - x1, py - y1
        square = dx * dx + dy * dy
        along = np.divide(fx * dx + fy * dy, square, out=np.zeros_like(square), where=square != 0)
        t = np.maximum(0.0, np.minimum(1.0, along))
        ox, oy = px - (x1 + t * dx), py - (y1 + t * dy)
        nearest = np.sqrt(np.minimum.reduceat(ox * ox + oy * oy, starts))
        turn = dx * fy - fx * dy
        from_low = y1 <= py
        on = from_low & (py <= y2) & (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2)) & (turn == 0)
        crossed = np.add.reduceat((from_low & (py < y2) & (turn < 0)).astype(np.int64), starts)
        inside = np.logical_or.reduceat(on, starts) | (crossed % 2 == 1)
        return pa.array(np.where(inside, 0.0, nearest))

    return distances


def extent(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Bounding box and number of points, as one row."""
    return df.agg(
        F.min(x).alias("min_x"),
        F.max(x).alias("max_x"),
        F.min(y).alias("min_y"),
        F.max(y).alias("max_y"),
        F.count(x).alias("points"),
    )


def side_sql(e: str, x: str, y: str) -> str:
    """``side`` as SQL text, for an edge called ``e``."""
    return f"({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1)"


def on_edge_sql(e: str, x: str, y: str) -> str:
    return (
        f"({e}.y1 <= {y} AND {y} <= {e}.y2 AND least({e}.x1, {e}.x2) <= {x} AND {x} <= greatest({e}.x1, {e}.x2)"
        f" AND {side_sql(e, x, y)} = 0)"
    )


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the geometry functions to SQL text as temporary functions.

    SQL function bodies take scalars and arrays, so polygons pass as WKT text and points as two numbers or as text.
    ``el_contains`` and ``el_distance`` answer for one polygon in the unit of its coordinates, null where its text is
    none; joins of many points and areas go through ``spatial.register_areas``.
    """
    ring = r"regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)"
    x_of = "try_cast(split(trim(v), '\\\\s+')[0] as double)"
    y_of = "try_cast(split(trim(v), '\\\\s+')[1] as double)"
    edge = "'x1', if(a.y <= b.y, a.x, b.x), 'y1', least(a.y, b.y), 'x2', if(a.y <= b.y, b.x, a.x), 'y2', greatest(a.y, b.y)"
    between = "slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1)"
    crossing = f"e.y1 <= y AND y < e.y2 AND {side_sql('e', 'x', 'y')} < 0"
    along = "((x - e.x1) * (e.x2 - e.x1) + (y - e.y1) * (e.y2 - e.y1))"
    square = "((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))"
    t = f"greatest(0D, least(1D, coalesce(try_divide({along}, {square}), 0D)))"
    apart = f"sqrt(pow(x - e.x1 - {t} * (e.x2 - e.x1), 2) + pow(y - e.y1 - {t} * (e.y2 - e.y1), 2))"
    definitions = [
        "el_point(x DOUBLE, y DOUBLE) RETURNS STRING RETURN concat('POINT (', x, ' ', y, ')')",
        "el_flip(point STRING) RETURNS STRING RETURN"
        r" regexp_replace(point, '^\\s*POINT\\s*\\(\\s*(\\S+)\\s+(\\S+?)\\s*\\)\\s*$', 'POINT ($2 $1)')",
        "el_strip_srid(geom STRING) RETURNS STRING RETURN substring_index(geom, ';', -1)",
        f"el_mercator_x(lon DOUBLE) RETURNS DOUBLE RETURN {EARTH_RADIUS} * radians(lon)",
        f"el_mercator_y(lat DOUBLE) RETURNS DOUBLE RETURN {EARTH_RADIUS} * "
        f"ln(tan(pi() / 4 + radians(greatest(least(lat, {POLE_GUARD}D), -{POLE_GUARD}D)) / 2))",
        f"el_longitude(x DOUBLE) RETURNS DOUBLE RETURN degrees(x / {EARTH_RADIUS})",
        f"el_latitude(y DOUBLE) RETURNS DOUBLE RETURN degrees(2 * atan(exp(y / {EARTH_RADIUS})) - pi() / 2)",
        "el_rings(wkt STRING) RETURNS ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>> RETURN "
        f"transform({ring}, r -> transform(split(r, ','), v -> named_struct('x', {x_of}, 'y', {y_of})))",
        f"el_edges(wkt STRING) RETURNS ARRAY<{EDGE_TYPE.upper()}> RETURN "
        f"flatten(transform(el_rings(wkt), r -> zip_with({between}, (a, b) -> named_struct({edge}))))",
        "el_contains(wkt STRING, x DOUBLE, y DOUBLE) RETURNS BOOLEAN RETURN "
        f"exists(el_edges(wkt), e -> {on_edge_sql('e', 'x', 'y')}) OR size(filter(el_edges(wkt), e -> {crossing})) % 2 = 1",
        "el_distance(wkt STRING, x DOUBLE, y DOUBLE) RETURNS DOUBLE RETURN "
        f"if(el_contains(wkt, x, y), 0D, array_min(transform(el_edges(wkt), e -> {apart})))",
    ]
    for body in definitions:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
