"""Spatial joins as equi-joins on grid cells: containment, distance; ranks with ties."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlake.functions import geo
from emberlake.operators.skew import BROADCAST_BYTES, HOT_ROWS, measured_bytes, salted_join
from emberlake.operators.tiles import BOX, area_tiles, cell_of, in_box, plan_tiles, tile_covers
from emberlake.session import spread, stored

REACH = 50_000.0  # fixed value: projected metres
TILE_COLUMNS = ("odd", "first", "second", "rest", "near", *BOX)
EDGES = 64  # of one row of an outline
BOX_BYTES = 96  # of an area's box in one cell
NUMBER_BYTES = 8
SLACK = 1e-6  # metres: more than rounding can make of a bound


def box_of(edges: Column) -> list[Column]:
    """Bounding box of an array of edges."""
    least = lambda f: F.array_min(F.transform(edges, f))
    most = lambda f: F.array_max(F.transform(edges, f))
    return [
        least(lambda e: F.least(e["x1"], e["x2"])).alias("x0"),
        least(lambda e: e["y1"]).alias("y0"),
        most(lambda e: F.greatest(e["x1"], e["x2"])).alias("x1"),
        most(lambda e: e["y2"]).alias("y1"),
    ]


def length(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def box_distance(x: Column, y: Column) -> Column:
    """Distance of a point to the box ``BOX``, zero inside: nothing in the box is nearer."""
    x0, y0, x1, y1 = map(F.col, BOX)
    zero = F.lit(0.0)
    return length(F.greatest(x0 - x, x - x1, zero), F.greatest(y0 - y, y - y1, zero))


def area_edges(shapes: DataFrame, wkt: str = "geometry", key: str = "id") -> DataFrame:
    """Areas in the form the joins take: ``shape_id`` and ``edges``, from WKT text.

    An area that cannot be read in full is left out, so that it never matches; ``rejected_areas`` names the
    fault. Texts differ in length by orders of magnitude, so they are spread before they are taken apart.
    """
    texts = spread(shapes.select(F.col(key).alias("shape_id"), F.col(wkt).alias("_wkt")), "shape_id")
    edges = F.transform(
        F.array(geo.checked_rings(F.col("_wkt"))),
        lambda area: F.when(area["fault"].isNull(), geo.ring_edges(area["rings"])),
    )
    # a filter on a generated column stays above the parsing, which then runs once
    return texts.select("shape_id", F.explode_outer(edges).alias("edges")).where("edges IS NOT NULL")


def rejected_areas(shapes: DataFrame, wkt: str = "geometry", key: str = "id") -> DataFrame:
    """``shape_id, fault`` of the areas the joins leave out; a missing text is a fault too."""
    texts = spread(shapes.select(F.col(key).alias("shape_id"), F.col(wkt).alias("_wkt")), "shape_id")
    faults = F.explode_outer(F.array(geo.checked_rings(F.col("_wkt"))["fault"])).alias("fault")
    return texts.select("shape_id", faults).where("fault IS NOT NULL")


def _with_tiles(
    points: DataFrame, tiles: DataFrame, x: Column, y: Column, cell: float, small: bool, hot_rows: int
) -> DataFrame:
    placed = points.where(x.isNotNull() & y.isNotNull()).select("*", cell_of(x, cell).alias("_cx"), cell_of(y, cell).alias("_cy"))
    keys = ["_cx", "_cy"]
    if small:
        joined = placed.join(F.broadcast(tiles), keys)
    else:
        joined = salted_join(placed, tiles, keys, hot_rows=hot_rows)
    return joined.drop(*keys)


@dataclass(frozen=True)
class NamedTiles:
    """Areas as points meet them: tiles of a side ``cell``, ``small`` if they fit a broadcast, and names that do."""

    rows: DataFrame
    cell: float
    small: bool
    named: DataFrame | None = None

    def kept(self) -> NamedTiles:
        """Written once, for several joins."""
        return replace(self, rows=stored(self.rows, "tiles"))


def named_tiles(
    areas: DataFrame, cell: float | None = None, limit: int = BROADCAST_BYTES, named: DataFrame | None = None
) -> NamedTiles:
    """Tiles of areas for ``contains_join``; names (``named``) too large for a broadcast are joined to them."""
    plan = plan_tiles(areas, cell=cell)
    tiles = area_tiles(areas, plan.cell).withColumnsRenamed({"cx": "_cx", "cy": "_cy"})
    if named is not None and not (limit > 0 and measured_bytes(named) <= limit):
        return NamedTiles(tiles.join(named, "shape_id"), plan.cell, False)
    # plan.bytes is an upper bound of the tiles' size, counted from the areas themselves
    return NamedTiles(tiles, plan.cell, plan.bytes <= limit, named)


def contains_join(
    points: DataFrame,
    areas: DataFrame | NamedTiles,
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    named: DataFrame | None = None,
) -> DataFrame:
    """Points with the ``shape_id`` of every area that contains them, boundaries included.

    A point in several overlapping areas gives a row for each; a point in none gives no row. ``named`` has more columns
    by ``shape_id``, for which the rows found are not shuffled: they are broadcast or, where too large for that, joined to
    the tiles before points meet them. An area without a row there is left out. Areas that several joins need are given as
    their ``named_tiles``.
    """
    px, py = F.col(x), F.col(y)
    tiles = areas if isinstance(areas, NamedTiles) else named_tiles(areas, cell, limit, named)
    joined = _with_tiles(points, tiles.rows, px, py, tiles.cell, tiles.small, hot_rows)
    located = joined.where(in_box(px, py) & tile_covers(px, py)).drop(*TILE_COLUMNS)
    return located if tiles.named is None else located.join(F.broadcast(tiles.named), "shape_id")


def register_areas(spark: SparkSession, areas: DataFrame, function: str = "el_areas_at") -> None:
    """Offer the containment join to SQL text: a table function that gives the areas at a point.

    ``FROM points p, LATERAL el_areas_at(p.x, p.y) a`` has ``a.shape_id``. The function reads the tiles of the areas
    (view ``{function}_tiles``) by the point's cell, so the lateral join becomes an equi-join on the cell.
    """
    plan = plan_tiles(areas)
    tiles = area_tiles(areas, plan.cell)
    (F.broadcast(tiles) if plan.bytes <= BROADCAST_BYTES else tiles).createOrReplaceTempView(f"{function}_tiles")

    def crossings(e: str) -> str:
        passed = f"{e}.low <= y AND y < {e}.high AND {geo.side_sql(e, 'x', 'y')} < 0"
        return f"if({e}.left > y, 1, 0) + if({passed}, 1, 0)"

    on = [f"coalesce({geo.on_edge_sql(e, 'x', 'y')}, false)" for e in ("t.first", "t.second")]
    on.append(f"coalesce(exists(t.rest, e -> {geo.on_edge_sql('e', 'x', 'y')}), false)")
    more = f"coalesce(aggregate(t.rest, 0, (n, e) -> n + {crossings('e')}), 0)"
    counted = f"t.odd + {crossings('t.first')} + {crossings('t.second')} + {more}"
    cell = " AND ".join(f"t.c{axis} = floor({axis} / {plan.cell}D)" for axis in "xy")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(x DOUBLE, y DOUBLE) RETURNS TABLE(shape_id STRING) RETURN"
        f" SELECT t.shape_id FROM {function}_tiles t WHERE {cell} AND (({counted}) % 2 = 1 OR {' OR '.join(on)})"
    )


def _by_box(
    points: DataFrame, outlines: DataFrame, reach: float, cell: float | None, limit: int, hot_rows: int
) -> DataFrame:
    """``distance`` of points (``_mx``, ``_my``) to the areas whose box is within reach, each area a row with all its edges.

    Areas go to the cells of their box, points to the cells within reach, which no outline is copied to. A pair counts in
    the first of the cells it shares.
    """
    px, py = F.col("_mx"), F.col("_my")
    side, within = plan_tiles(outlines, cell=cell, least=reach / 2).cell, reach + SLACK
    ends = [cell_of(F.col(bound), side).alias(f"_{bound}") for bound in BOX]
    boxes = outlines.select("*", *box_of(F.col("edges"))).select("*", *ends)
    numbers = F.transform("edges", lambda e: F.array(*[e[name] for name in ("x1", "y1", "x2", "y2")]))
    boxes = boxes.withColumn("edges", F.flatten(numbers))
    width = BOX_BYTES + NUMBER_BYTES * F.size("edges")
    n_bytes = boxes.agg(F.sum((F.col("_x1") - F.col("_x0") + 1) * (F.col("_y1") - F.col("_y0") + 1) * width)).first()[0]
    cells = boxes.withColumn("_cx", F.explode(F.sequence("_x0", "_x1")))
    cells = cells.withColumn("_cy", F.explode(F.sequence("_y0", "_y1"))).drop("_x1", "_y1")
    placed = points.where(px.isNotNull() & py.isNotNull()).select(
        "*", cell_of(px - within, side).alias("_px"), cell_of(py - within, side).alias("_py")
    )
    placed = placed.withColumn("_cx", F.explode(F.sequence(F.col("_px"), cell_of(px + within, side))))
    placed = placed.withColumn("_cy", F.explode(F.sequence(F.col("_py"), cell_of(py + within, side))))
    keys = ["_cx", "_cy"]
    if n_bytes <= limit:
        joined = placed.join(F.broadcast(cells), keys)
    else:
        joined = salted_join(placed, cells, keys, hot_rows=hot_rows)
    first = (F.col("_cx") == F.greatest("_px", "_x0")) & (F.col("_cy") == F.greatest("_py", "_y0"))
    pairs = joined.where(first & (box_distance(px, py) <= within))
    apart = F.arrow_udf(geo.batch_distances(), "double")("edges", px, py)
    # a filter on a generated column stays above the distance, which is then taken once
    return pairs.select(*points.columns, "shape_id", F.explode_outer(F.array(apart)).alias("distance"))


def _by_tile(
    points: DataFrame, outlines: DataFrame, reach: float, cell: float | None, limit: int, hot_rows: int
) -> DataFrame:
    """The same from tiles, which hold the edges within reach of a cell only."""
    px, py = F.col("_mx"), F.col("_my")
    plan = plan_tiles(outlines, reach, cell)
    tiles = area_tiles(outlines, plan.cell, reach).withColumnsRenamed({"cx": "_cx", "cy": "_cy"})
    joined = _with_tiles(points, tiles, px, py, plan.cell, plan.bytes <= limit, hot_rows)
    apart = F.when(tile_covers(px, py), F.lit(0.0)).otherwise(geo.outline_distance(F.col("near"), px, py))
    return joined.withColumn("distance", apart).drop(*TILE_COLUMNS)


def distance_join(
    points: DataFrame,
    areas: DataFrame,
    reach: float = REACH,
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    edges: int = EDGES,
) -> DataFrame:
    """Point-area pairs at most ``reach`` apart, with ``shape_id`` and ``distance`` (zero inside).

    Distances are planar in EPSG:3857 metres; input coordinates are degrees. Areas of at most so many ``edges`` are met
    by their box and measured whole, longer ones by tiles.
    """
    metres = areas.select("shape_id", geo.mercator_edges(F.col("edges")).alias("edges")).where(F.size("edges") > 0)
    # the edges of all rows of one id make one area
    total = F.sum(F.size("edges")).over(Window.partitionBy("shape_id"))
    metres = stored(metres.select("*", (total <= edges).alias("few")), "outlines")
    projected = points.withColumns({"_mx": geo.mercator_x(F.col(x)), "_my": geo.mercator_y(F.col(y))})
    few, many = (metres.where(F.col("few") == kind).drop("few") for kind in (True, False))
    few = few.groupBy("shape_id").agg(F.flatten(F.collect_list("edges")).alias("edges"))
    kinds = {row["few"] for row in metres.select("few").distinct().collect()}
    ways = [_by_box(projected, few, reach, cell, limit, hot_rows)] if True in kinds else []
    if kinds != {True}:
        ways.append(_by_tile(projected, many, reach, cell, limit, hot_rows))
    measured = reduce(DataFrame.unionByName, ways).drop("_mx", "_my")
    return measured.where(F.col("distance") <= reach)


def nearest_with_ties(
    pairs: DataFrame,
    group: str,
    value: str,
    k: int,
    rank: str = "rank",
    hot_rows: int = HOT_ROWS,
    copies: Column | None = None,
) -> DataFrame:
    """Rows whose rank by ``value`` within ``group`` is at most k, ties sharing a rank.

    Equal values are counted (``copies`` of each row, one by default) before anything is gathered by group, and no
    more than k distinct values per group pass the window, so a group of any size is ranked without bringing its
    rows together. The k steps of a group are joined back by group alone.
    """
    steps = pairs.groupBy(group, value).agg(F.sum(F.lit(1) if copies is None else copies).alias("_ties"))
    ordered = Window.partitionBy(group).orderBy(value)
    closer = F.sum("_ties").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    ranks = (
        steps.withColumn("_step", F.row_number().over(ordered))
        .where(F.col("_step") <= k)
        .withColumn(rank, (F.coalesce(closer, F.lit(0)) + 1).cast("int"))
        .where(F.col(rank) <= k)
        .groupBy(group)
        .agg(F.collect_list(F.struct(F.col(value).alias("from"), F.col(rank).alias("rank"))).alias("_steps"))
    )
    reached = F.filter("_steps", lambda step: step["from"] <= F.col(value))
    last = F.array_max(F.transform("_steps", lambda step: step["from"]))
    joined = salted_join(pairs, ranks, [group], hot_rows=hot_rows).where(F.col(value) <= last)
    return joined.withColumn(rank, F.array_max(F.transform(reached, lambda step: step["rank"]))).drop("_steps")
