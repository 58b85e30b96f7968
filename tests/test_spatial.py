"""Spatial joins against exact arithmetic and against every point with every area."""

import math
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyspark
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from emberlake.functions import geo
from emberlake.operators import nearest, spatial
from emberlake.operators.tiles import area_tiles, plan_tiles
from emberlake.plans import jobs

HOLED = [[(0, 0), (9, 0), (9, 9), (0, 9)], [(2, 2), (6, 3), (5, 7), (2, 5)]]
CONCAVE = [[(0, 0), (4, 0), (4, 4), (2, 2), (0, 4)]]
TWO_PARTS = [[(6, 6), (9, 6), (9, 9), (6, 9)], [(1, 1), (3, 1), (2, 4)], [(7, 7), (8, 7), (8, 8), (7, 8)]]


def covered_points(rings, points):
    """Even-odd test of all points, boundary inside; exact for coordinates in quarters."""
    x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    inside, edge = np.zeros(len(points), bool), np.zeros(len(points), bool)
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            (ax, ay), (bx, by) = sorted((a, b), key=lambda c: c[1])
            cross = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
            within = (min(ax, bx) <= x) & (x <= max(ax, bx)) & (ay <= y) & (y <= by)
            edge |= (cross == 0) & within
            inside ^= (ay <= y) & (y < by) & (cross < 0)
    return np.flatnonzero(inside | edge)


def wkt(rings):
    texts = ["(" + ",".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + ")" for ring in rings]
    return "POLYGON(" + ",".join(texts) + ")"


def frames(spark, polygons, points):
    shapes = spark.createDataFrame([(str(i), wkt(p)) for i, p in enumerate(polygons)], "id string, geometry string")
    spots = spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "pid long, x double, y double"
    )
    return spots, spatial.area_edges(shapes)


def wanted(polygons, points):
    return {(int(i), k) for k, p in enumerate(polygons) for i in covered_points(p, points)}


def found(joined):
    return {(r.pid, int(r.shape_id)) for r in joined.select("pid", "shape_id").collect()}


@pytest.mark.parametrize("cell", [0.25, 2.0, 16.0])
def test_contains_on_grid_lines_and_vertices(spark, cell):
    polygons = [HOLED, CONCAVE, TWO_PARTS]
    points = [(i / 4, j / 4) for i in range(-2, 40) for j in range(-2, 40)]
    spots, areas = frames(spark, polygons, points)
    assert found(spatial.contains_join(spots, areas, cell=cell)) == wanted(polygons, points)


def test_covers_column_agrees(spark):
    polygons = [HOLED, CONCAVE, TWO_PARTS]
    points = [(i / 4, j / 4) for i in range(-2, 40) for j in range(-2, 40)]
    spots, areas = frames(spark, polygons, points)
    every = spots.crossJoin(areas).where(geo.covers(F.col("edges"), F.col("x"), F.col("y")))
    assert found(every) == wanted(polygons, points)


coordinate = st.integers(-12, 12).map(lambda v: v / 2)
ring = st.lists(st.tuples(coordinate, coordinate), min_size=3, max_size=7)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    polygons=st.lists(st.lists(ring, min_size=1, max_size=2), min_size=15, max_size=30),
    cell=st.sampled_from([0.5, 1.0, 4.0]),
)
def test_contains_equals_exact_arithmetic(spark, polygons, cell):
    """Any rings at all, self-crossing and overlapping ones included."""
    points = [(i / 4, j / 4) for i in range(-26, 27, 3) for j in range(-26, 27)]
    spots, areas = frames(spark, polygons, points)
    assert found(spatial.contains_join(spots, areas, cell=cell)) == wanted(polygons, points)


def star(random_, n, radius):
    cx, cy = random_.uniform(-20, 20), random_.uniform(-20, 20)
    turns = sorted(random_.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + radius * random_.uniform(0.3, 1) * math.cos(t), cy + radius * random_.uniform(0.3, 1) * math.sin(t)) for t in turns]


@pytest.mark.parametrize("options", [{}, {"limit": 0, "hot_rows": 50}])
def test_contains_with_chosen_cell_and_with_salted_shuffle(spark, options):
    """Areas from tiny to huge; a third of the points are copies of one."""
    random_ = random.Random(5)
    polygons = [[star(random_, random_.choice([3, 9, 200]), random_.choice([0.05, 1, 15]))] for _ in range(60)]
    points = [(random_.uniform(-30, 30), random_.uniform(-30, 30)) for _ in range(1200)]
    points += [(polygons[3][0][0][0], polygons[3][0][0][1])] * 600
    spots, areas = frames(spark, polygons, points)
    joined = spatial.contains_join(spots.repartition(6), areas, **options)
    assert found(joined) == wanted(polygons, points)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert joined.groupBy("pid", "shape_id").count().where("count > 1").count() == 0


def test_points_without_position_are_dropped(spark):
    _, areas = frames(spark, [HOLED], [])
    raw = spark.createDataFrame([("1", "1"), ("NaN", "1"), ("x", "1"), (None, "1")], "a string, b string")
    spots = raw.select(geo.number(F.col("a")).alias("x"), geo.number(F.col("b")).alias("y"))
    assert spatial.contains_join(spots, areas).count() == 1


def test_unreadable_and_empty_shapes_do_no_harm(spark):
    texts = ["POLYGON((0 0,4 0,4 4,0 4,0 0))", "POLYGON((0 0,x 0,4 y,0 4,0 0))", "POLYGON EMPTY", None]
    shapes = spark.createDataFrame(list(enumerate(texts)), "id int, geometry string")
    spots = spark.createDataFrame([(0, 1.0, 1.0), (1, 5.0, 1.0)], "pid long, x double, y double")
    assert found(spatial.contains_join(spots, spatial.area_edges(shapes))) == {(0, 0)}
    assert found(spatial.distance_join(spots, spatial.area_edges(shapes), reach=200_000.0)) == {(0, 0), (1, 0)}
    broken = spatial.area_edges(shapes.where("id > 0"))
    assert broken.count() == 0
    assert spatial.contains_join(spots, broken).count() == spatial.distance_join(spots, broken).count() == 0
    assert nearest.nearest_points(spots, broken).count() == 0


FAULTS = {
    "POLYGON((0 0,4 0,4 4,0 4,0 0))": None,
    " polygon ( (0 0, 4 0, 4 4, 0 0) , (1 1,2 1,2 2,1 1) ) ": None,
    "MULTIPOLYGON(((0 0,4 0,4 4,0 0)),((6 6,9 6,9 9,6 6),(7 6.5,8 6.5,8 7,7 6.5)))": None,
    "POLYGON((0 0,1e1 0,1 -1.5,0 0))": None,
    None: "no polygon",
    "": "no polygon",
    "POLYGON EMPTY": "no polygon",
    "POINT (1 2)": "no polygon",
    "POLYGON()": "no polygon",
    "POLYGON((0 0,4 0,4 4,0 0)": "no polygon",
    "POLYGON((0 0,4 0,4 4,0 0)))": "no polygon",
    "POLYGON(0 0,4 0,4 4,0 0)": "no polygon",
    "POLYGON((0 0,4 0,4 4,0 0) (1 1,2 1,2 2,1 1))": "no polygon",
    "MULTIPOLYGON((0 0,4 0,4 4,0 0))": "no polygon",
    "POLYGON(())": "no polygon",
    "POLYGON((0 0,4 0,4 4,0 0),())": "no polygon",
    "POLYGON((0 0,x 0,4 4,0 0))": "unreadable number",
    "POLYGON((0 0,NaN 0,4 4,0 0))": "unreadable number",
    "POLYGON((0 0,Infinity 0,4 4,0 0))": "unreadable number",
    "POLYGON((0 0,4,4 4,0 0))": "unreadable number",
    "POLYGON((0 0 1,4 0 1,4 4 1,0 0 1))": "unreadable number",
    "POLYGON((0 0,4 0,0 0))": "short ring",
    "POLYGON((0 0,4 0,4 4,0 0),(1 1,1 1))": "short ring",
    "POLYGON((0 0,4 0,4 4,0 4))": "open ring",
    "MULTIPOLYGON(((0 0,4 0,4 4,0 0)),((6 6,9 6,9 9,6 7)))": "open ring",
}


def test_faults_of_areas(spark):
    shapes = spark.createDataFrame(list(enumerate(FAULTS)), "id int, geometry string")
    got = {r.shape_id: r.fault for r in spatial.rejected_areas(shapes).collect()}
    assert got == {i: fault for i, fault in enumerate(FAULTS.values()) if fault}
    assert {r.shape_id for r in spatial.area_edges(shapes).collect()} == {i for i, f in enumerate(FAULTS.values()) if not f}


def test_an_area_of_very_many_rings_is_judged(spark):
    rings = ",".join(f"({i} 0,{i} 1,{i + 1} 1,{i} 0)" for i in range(60_000))
    texts = [f"POLYGON({rings})", f"MULTIPOLYGON(({rings.replace('),(', ')),((')}))", f"POLYGON({rings},(0 0,1 1,2 2,0 1))"]
    shapes = spark.createDataFrame(list(enumerate(texts)), "id int, geometry string")
    assert {r.shape_id: r.fault for r in spatial.rejected_areas(shapes).collect()} == {2: "open ring"}


def test_areas_are_parsed_once(spark):
    shapes = spark.range(3).selectExpr("id", "'POLYGON((0 0,4 0,4 4,0 4,0 0))' AS geometry")
    plan = spatial.area_edges(shapes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Filter") == 1 and plan.index("Filter isnotnull(edges") < plan.index("Generate explode")


def test_tiles_hold_only_nearby_edges(spark):
    """An area with very many corners: a tile keeps the few edges of its cell."""
    random_ = random.Random(1)
    turns = [2 * math.pi * i / 20000 for i in range(20000)]
    ring_ = [((10 + random_.uniform(-0.01, 0.01)) * math.cos(t), 10 * math.sin(t)) for t in turns]
    _, areas = frames(spark, [[ring_]], [])
    plan = plan_tiles(areas)
    tiles = area_tiles(areas, plan.cell)
    sizes = tiles.agg(F.count("*").alias("n"), F.max(F.size("rest")).alias("most"), F.count_if(F.col("first").isNull()).alias("whole")).first()
    assert sizes.n <= plan.tiles
    assert sizes.most < 1000
    assert sizes.whole > 0


@pytest.mark.parametrize("cell", [None, 262144.0])
def test_distance_join_equals_every_pair(spark, cell):
    random_ = random.Random(9)
    polygons = [[star(random_, random_.choice([3, 8, 40]), random_.choice([0.05, 0.5, 6]))] for _ in range(40)]
    points = [(random_.uniform(-22, 22), random_.uniform(-22, 22)) for _ in range(700)]
    spots, areas = frames(spark, polygons, points)
    x, y = geo.mercator_x(F.col("x")), geo.mercator_y(F.col("y"))
    every = (
        spots.crossJoin(areas.select("shape_id", geo.mercator_edges(F.col("edges")).alias("edges")))
        .select("pid", "shape_id", geo.distance(F.col("edges"), x, y).alias("distance"))
        .where("distance <= 50000")
    )
    want = {(r.pid, r.shape_id): r.distance for r in every.collect()}
    got = {(r.pid, r.shape_id): r.distance for r in spatial.distance_join(spots, areas, cell=cell).collect()}
    assert got.keys() == want.keys()
    assert len(want) > 100 and any(d == 0 for d in want.values()) and any(d > 0 for d in want.values())
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-6) for k in want)


def test_distance_reach_is_inclusive(spark):
    """One degree of longitude on the equator, with the reach set to just that."""
    spots, areas = frames(spark, [[[(0, -1), (1, -1), (1, 1), (0, 1)]]], [(2, 0), (2.001, 0), (0.5, 0)])
    one = geo.EARTH_RADIUS * math.radians(2) - geo.EARTH_RADIUS * math.radians(1)
    got = {r.pid: r.distance for r in spatial.distance_join(spots, areas, reach=one).collect()}
    assert got == {0: one, 2: 0.0}


def test_distances_of_batches_equal_the_columns(spark):
    """Points on corners and edges, inside holes, outside; an edge of no length."""
    polygons = [HOLED, CONCAVE, TWO_PARTS, [[(0, 0), (0, 0), (4, 0), (4, 4)]]]
    points = [(i / 2, j / 2) for i in range(-2, 21) for j in range(-2, 21)]
    spots, areas = frames(spark, polygons, points)
    numbers = F.flatten(F.transform("edges", lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))
    x, y = F.col("x"), F.col("y")
    got = F.arrow_udf(geo.batch_distances(), "double")(numbers, x, y).alias("got")
    rows = spots.repartition(3).crossJoin(areas).select(got, geo.distance(F.col("edges"), x, y).alias("want")).collect()
    assert len(rows) == len(points) * 4 and all(r.got == r.want for r in rows)
    assert 0 < sum(r.want == 0 for r in rows) < len(rows)


def test_batch_distances_need_no_package_on_the_workers(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(geo.batch_distances()))
    code = (
        "import sys, pickle, pyarrow as pa; sys.path[:] = [p for p in sys.path if p]; f = pickle.load(open('f', 'rb'));"
        "print(f(pa.array([[0.0, 0.0, 0.0, 2.0]]), pa.array([-3.0]), pa.array([1.0])).to_pylist(), 'emberlake' in sys.modules)"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(Path(pyspark.__file__).parents[1])}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert ran.stdout.strip() == "[3.0] False", ran.stderr


@pytest.mark.parametrize("options", [{}, {"limit": 0, "hot_rows": 50}, {"edges": 0}, {"edges": 9, "limit": 0}])
def test_distance_join_of_short_and_long_outlines(spark, options):
    """Outlines met by box, by tile and some by each, with rows that share an id; each pair once."""
    random_ = random.Random(3)
    polygons = [[star(random_, random_.choice([3, 9, 90]), random_.choice([0.02, 0.5, 9]))] for _ in range(40)]
    points = [(random_.uniform(-22, 22), random_.uniform(-22, 22)) for _ in range(500)]
    points += [polygons[0][0][0]] * 200
    spots, areas = frames(spark, polygons, points)
    areas = areas.withColumn("shape_id", F.expr("if(shape_id < 4, null, if(shape_id < 8, '4', shape_id))"))
    joined = spatial.distance_join(spots, areas, **options)
    merged = areas.groupBy("shape_id").agg(F.flatten(F.collect_list("edges")).alias("edges"))
    x, y = geo.mercator_x(F.col("x")), geo.mercator_y(F.col("y"))
    every = spots.crossJoin(nearest.metre_edges(merged)).select("pid", "shape_id", geo.distance(F.col("edges"), x, y).alias("d"))
    want = {(r.pid, r.shape_id): r.d for r in every.where("d <= 50000").collect()}
    rows = joined.collect()
    got = {(r.pid, r.shape_id): r.distance for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys() and len(want) > 100
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-6) for k in want)


def test_short_outlines_are_not_copied_to_the_cells_within_reach(spark):
    """Boxes far smaller than a cell go to one to four cells each, not to the twenty within reach of them."""
    polygons = [[[(i, j), (i + 0.01, j), (i + 0.01, j + 0.01)]] for i in range(10) for j in range(10)]
    spots, areas = frames(spark, polygons, [(0, 0)])
    joined = spatial.distance_join(spots, areas, limit=0)
    joined.collect()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert " AS near" not in plan and "ArrowEvalPython" in plan


def test_names_reach_the_tiles_before_the_points(spark):
    """With names too large for a broadcast the rows found are not joined again, and with small ones not shuffled."""
    polygons = [HOLED, CONCAVE, TWO_PARTS, [[(0, 0), (9, 0), (9, 9), (0, 9)]]]
    spots, areas = frames(spark, polygons, [(i / 2, j / 2) for i in range(20) for j in range(20)])
    named = spark.createDataFrame([("0", "a"), ("1", "b"), ("1", "c"), ("3", "d"), (None, "e")], "shape_id string, name string")
    located = spatial.contains_join(spots, areas)
    want = sorted((r.pid, r.shape_id, r.name) for r in located.join(named, "shape_id").collect())
    columns = ["pid", "shape_id", "name"]
    for limit in (0, spatial.BROADCAST_BYTES):
        joined = spatial.contains_join(spots, areas, limit=limit, named=named)
        assert sorted(map(tuple, joined.select(columns).collect())) == want
        assert joined.columns.count("shape_id") == 1
    top = lambda df: next(line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line)
    assert "_cx" in top(spatial.contains_join(spots, areas, limit=0, named=named))


def test_fire_table_has_its_ancestors_from_the_tiles(spark):
    """The join that makes the rows is the last one where the table of areas is large."""
    shapes = spark.createDataFrame([("1", wkt(HOLED), 8)], "id string, geometry string, adm int")
    relations = spark.createDataFrame([("1", "one", "n1", "N")], "id string, name string, adm4 string, adm4_name string")
    numbers = ("bright_ti4", "bright_ti5", "frp", "scan", "track")
    fires = spark.createDataFrame([(1.0, 1.0), (4.0, 4.0)], "x double, y double").selectExpr(
        "x", "y", *[f"1D AS {n}" for n in numbers], "'h' AS confidence", "now() AS datetime", "2020 AS year", "1 AS month"
    )
    table = jobs.fires_table(fires, shapes, relations, limit=0)
    assert [(r.geometry, r.adm, r.adm4_name) for r in table.collect()] == [("POINT (1.0 1.0)", "1", "N")]
    joins = [line for line in table._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert "_cx" in joins[0]


@pytest.mark.parametrize("hot_rows", [10, 2_000_000])
def test_nearest_keeps_ties(spark, hot_rows):
    rows = [("a", 0.0, i) for i in range(500)] + [("a", 1.0, 900)]
    rows += [("b", float(d), 1000 + i) for i, d in enumerate([5, 1, 3, 3, 3, 9])]
    rows += [("c", 2.0, 2000)]
    pairs = spark.createDataFrame(rows, "shape string, d double, pid long").repartition(5)
    got = spatial.nearest_with_ties(pairs, "shape", "d", 3, hot_rows=hot_rows)
    want = pairs.withColumn("rank", F.expr("rank() over (partition by shape order by d)")).where("rank < 4")
    columns = ["shape", "d", "pid", "rank"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert {r.pid for r in got.where("shape = 'a'").collect()} == set(range(500))


def test_nearest_limits_before_the_shuffle(spark):
    pairs = spark.range(1000).selectExpr("id % 5 AS shape", "cast(id as double) AS d", "id AS pid")
    assert "WindowGroupLimit" in spatial.nearest_with_ties(pairs, "shape", "d", 3)._jdf.queryExecution().toString()


def test_projection_round_trip(spark):
    df = spark.range(-80, 84).selectExpr("id * 2.0D AS lon", "cast(id AS double) AS lat")
    row = df.agg(
        F.max(F.abs(geo.longitude(geo.mercator_x(F.col("lon"))) - F.col("lon"))).alias("lon"),
        F.max(F.abs(geo.latitude(geo.mercator_y(F.col("lat"))) - F.col("lat"))).alias("lat"),
    ).first()
    assert row.lon < 1e-12 and row.lat < 1e-12
    poles = spark.range(1).select(geo.mercator_y(F.lit(-90.0)).alias("y")).first()
    assert math.isfinite(poles.y)


def test_wkt_reading(spark):
    texts = [
        "POLYGON((0 0,2 0,2 2,0 0))",
        "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((6 6, 9 6, 9 9, 6 6), (7 6.5, 8 6.5, 8 7, 7 6.5)))",
        "POLYGON((0 0,1e1 0,1 -1.5))",
        "POLYGON EMPTY",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "w string")
    rows = df.select(geo.wkt_rings(F.col("w")).alias("r"), geo.wkt_edges(F.col("w")).alias("e")).collect()
    assert [None if r.r is None else [len(x) for x in r.r] for r in rows] == [[4], [4, 4, 4], [3], [], None]
    assert len(rows[2].e) == 3  # the open ring is closed
    assert all(e.y1 <= e.y2 for r in rows if r.e for e in r.e)


def test_extent_flip_and_text(spark):
    df = spark.createDataFrame([(1.5, -2.0), (3.0, 4.0), (None, None)], "x double, y double")
    assert tuple(geo.extent(df).first()) == (1.5, 3.0, -2.0, 4.0, 2)
    flipped = df.select(geo.flip(F.struct("x", "y")).alias("p"), geo.point_wkt(F.col("x"), F.col("y")).alias("w")).first()
    assert (flipped.p.x, flipped.p.y, flipped.w) == (-2.0, 1.5, "POINT (1.5 -2.0)")


def test_sql_functions(spark):
    geo.register_sql_functions(spark)
    row = spark.sql(
        "SELECT el_point(1.5D, 2D) p, el_strip_srid('SRID=4326;POINT (1 2)') s, el_strip_srid('POINT (1 2)') t,"
        " size(el_rings('POLYGON((0 0,1 0,1 1,0 0),(0 0,1 0,1 1,0 0))')) n, el_latitude(el_mercator_y(12.5D)) l"
    ).first()
    assert (row.p, row.s, row.t, row.n) == ("POINT (1.5 2.0)", "POINT (1 2)", "POINT (1 2)", 2)
    assert math.isclose(row.l, 12.5)


@pytest.mark.parametrize("options", [{}, {"limit": 0, "hot_rows": 20, "cell": 262144.0}])
def test_nearest_equals_ranking_every_pair(spark, options, monkeypatch):
    monkeypatch.setattr(nearest, "EDGES", 4)
    random_ = random.Random(4)
    polygons = [[star(random_, random_.choice([3, 9, 60]), random_.choice([0.05, 0.5, 6]))] for _ in range(40)]
    points = [(random_.uniform(-22, 22), random_.uniform(-22, 22)) for _ in range(900)]
    points += points[:200] + points[:100] + [(polygons[3][0][0][0], polygons[3][0][0][1])] * 5
    spots, areas = frames(spark, polygons, points)
    spots = spots.withColumn("note", F.when(F.col("pid") % 2 == 0, "n"))
    metres = areas.select("shape_id", geo.mercator_edges(F.col("edges")).alias("edges"))
    apart = geo.distance(F.col("edges"), geo.mercator_x(F.col("x")), geo.mercator_y(F.col("y")))
    every = spots.crossJoin(metres).select("pid", "shape_id", apart.alias("distance")).where("distance <= 50000")
    ranks = every.selectExpr("*", "rank() over (partition by shape_id order by distance) AS station_rank").where("station_rank <= 3")
    want = {(r.pid, r.shape_id): (r.station_rank, r.distance) for r in ranks.collect()}
    rows = nearest.nearest_points(spots.repartition(3), areas, **options).collect()
    got = {(r.pid, r.shape_id): (r.station_rank, r.distance) for r in rows}
    assert len(rows) == len(got) and {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(math.isclose(got[k][1], want[k][1], rel_tol=1e-12, abs_tol=1e-6) for k in want)
    assert len(want) > 150 and len({v[0] for v in want.values()}) == 3


def test_few_pairs_are_measured_exactly(spark):
    """Many areas with two hundred places within reach each: the bounds decide on nearly all pairs."""
    random_ = random.Random(8)
    polygons = [[[(x, y), (x + 0.02, y), (x, y + 0.02)]] for x, y in ((random_.uniform(-1, 1), random_.uniform(-1, 1)) for _ in range(50))]
    points = [(random_.uniform(-2, 2), random_.uniform(-2, 2)) for _ in range(4000)]
    spots, areas = frames(spark, polygons, points)
    pairs, near = nearest.candidates(spots, nearest.metre_edges(areas))
    n_pairs, n_near = pairs.count(), near.count()
    assert n_pairs > 50 * 150 and n_near < 0.1 * n_pairs
    plan = near._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_counts_by_cell_bound_what_is_paired(spark):
    """Dense places: an area is paired with those around it, not with all within reach, and k points are that near."""
    random_ = random.Random(9)
    polygons = [[star(random_, 5, 0.02)] for _ in range(10)]
    centre = polygons[0][0][0]
    points = [(centre[0] + random_.uniform(-0.3, 0.3), centre[1] + random_.uniform(-0.3, 0.3)) for _ in range(3000)]
    spots, areas = frames(spark, polygons, points)
    metres = nearest.metre_edges(areas)
    places = nearest.places_of(spots)
    corners = metres.select("shape_id", F.col("edges")[0]["x1"].alias("ax"), F.col("edges")[0]["y1"].alias("ay"))
    reach = nearest.counted_reach(places, corners, 3, 50_000.0)
    apart = geo.distance(F.col("edges"), F.col("mx"), F.col("my"))
    met = reach.join(metres, "shape_id").join(places).where(apart <= F.col("within")).groupBy("shape_id", "within").count().collect()
    assert met and all(r["count"] >= 3 for r in met) and min(r.within for r in met) < 6_000
    near = nearest.near_pairs(places, metres, 3, 50_000.0)
    assert near.where("near > limit + 1e-5").count() == 0 and near.where(F.col("limit") < 6_000).count() > 0


def test_stations_have_their_names_from_the_places(spark, monkeypatch):
    """Ancestors are joined to places of areas, which are fewer than the stations at them; texts of areas are read once."""
    shapes = spark.createDataFrame([("1", wkt(HOLED)), ("2", wkt(CONCAVE))], "id string, geometry string")
    relations = spark.createDataFrame([("1", "one", "n1", "N"), ("1", "uno", "n1", "N")], "id string, name string, adm4 string, adm4_name string")
    points = spark.createDataFrame([(i, 4.0 + i % 2, 4.0) for i in range(6)], "id int, x double, y double").selectExpr("CAST(id AS STRING) AS id", "'n' AS name", "'1' AS elevation", "x", "y")
    read = []
    monkeypatch.setattr(nearest, "metre_edges", lambda areas, of=nearest.metre_edges: read.append(areas) or of(areas))
    table = jobs.stations_table(points, shapes, relations, reach=1e6)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    top = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "(x#" in top and "shape_id" not in top and len(read) == 1 and "regexp" not in plan
    want = nearest.nearest_points(points, spatial.area_edges(shapes), reach=1e6).where("shape_id = '1'")
    names = [(r.id, name, round(r.distance, 1)) for r in want.collect() for name in ("one", "uno")]
    assert names and sorted((r.id, r.adm_name, round(r.distance, 1)) for r in table.collect()) == sorted(names)


def test_what_grows_after_it_was_stored_is_not_broadcast(spark, tmp_path):
    """Counts of places by cells of all sizes, and points, whatever their files' sizes say."""
    path = str(tmp_path / "places")
    spark.range(500).selectExpr("id * 10D AS mx", "id % 7 * 10D AS my", "1L AS copies").write.parquet(path)
    corners = spark.range(20).selectExpr("CAST(id AS STRING) AS shape_id", "id * 10D AS ax", "id * 3D AS ay")
    within = nearest.counted_reach(spark.read.parquet(path), corners, 3, 50_000.0)
    assert within.count() == 20
    assert "BroadcastExchange" not in within._jdf.queryExecution().executedPlan().toString()
    spots, areas = frames(spark, [HOLED], [(i / 5, 11.0) for i in range(30)])
    linked = nearest.nearest_points(spots, areas, reach=5e5)
    top = next(line for line in linked._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line)
    assert "SortMergeJoin" in top


def test_bounds_hold(spark):
    random_ = random.Random(6)
    polygons = [[star(random_, random_.choice([3, 9]), random_.choice([0.5, 6]))] for _ in range(30)]
    points = [(random_.uniform(-30, 30), random_.uniform(-30, 30)) for _ in range(100)]
    spots, areas = frames(spark, polygons, points)
    metres = nearest.metre_edges(areas).select("*", *nearest.box_of(F.col("edges")))
    x, y = geo.mercator_x(F.col("x")), geo.mercator_y(F.col("y"))
    pairs = spots.crossJoin(metres).select(
        nearest.box_distance(x, y).alias("near"), nearest.outline_within(x, y).alias("far"),
        geo.outline_distance(F.col("edges"), x, y).alias("outline"), geo.distance(F.col("edges"), x, y).alias("distance"),
    )
    assert pairs.where("near > distance + 1e-6 or far < outline - 1e-6").count() == 0 and pairs.where("near > 0").count() > 100


def test_distance_to_own_area_of_many_edges(spark):
    """One area of 5,000 edges and many points: no row carries the whole outline."""
    turns = [2 * math.pi * i / 5000 for i in range(5000)]
    ring_ = [(10 * math.cos(t) + 1e-3 * (i % 7), 10 * math.sin(t)) for i, t in enumerate(turns)]
    _, areas = frames(spark, [[ring_]], [])
    random_ = random.Random(2)
    rows = [(i, "0", random_.uniform(-2e6, 2e6), random_.uniform(-2e6, 2e6)) for i in range(300)]
    points = spark.createDataFrame(rows, "pid long, shape_id string, mx double, my double")
    metres = nearest.metre_edges(areas)
    assert metres.select(F.max(F.size("edges"))).first()[0] == 5000
    assert nearest.outline_rows(metres).agg(F.max(F.size("edges"))).first()[0] == nearest.EDGES
    every = points.join(metres, "shape_id").select("pid", geo.distance(F.col("edges"), F.col("mx"), F.col("my")).alias("d"))
    want = {r.pid: r.d for r in every.collect()}
    got = {r.pid: r.distance for r in nearest.distance_to(points, areas, ["pid"], hot_rows=40).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-6) for i in want)
    assert 0 < sum(d == 0 for d in got.values()) < 300


def test_sql_geometry_functions(spark):
    geo.register_sql_functions(spark)
    random_ = random.Random(3)
    polygons = [HOLED, CONCAVE, TWO_PARTS, [star(random_, 30, 5)]]
    points = [(i / 2, j / 2) for i in range(-2, 22) for j in range(-2, 22)]
    shapes = spark.createDataFrame([(i, wkt(p)) for i, p in enumerate(polygons)], "id int, w string")
    spots = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "pid long, x double, y double")
    both = spots.crossJoin(shapes).selectExpr(
        "pid", "id", "w", "x", "y", "el_contains(w, x, y) AS inside", "el_distance(w, x, y) AS distance"
    )
    both = both.withColumn("apart", geo.distance(geo.wkt_edges(F.col("w")), F.col("x"), F.col("y"))).collect()
    assert {(r.pid, r.id) for r in both if r.inside} == wanted(polygons, points)
    assert all(math.isclose(r.distance, r.apart, abs_tol=1e-9) for r in both)
    texts = spark.sql("SELECT el_flip('POINT (1.5 -2.0)') a, el_flip(' point( 1  2 ) ') b, el_flip('POINT (1.5 -2)') = el_flip(el_flip(el_flip('POINT (1.5 -2)'))) c").first()
    assert (texts.a, texts.b, texts.c) == ("POINT (-2.0 1.5)", " point( 1  2 ) ", True)
    assert spark.sql("SELECT el_contains(NULL, 1D, 1D) a, el_distance('POLYGON EMPTY', 1D, 1D) b").first()[1] is None


def test_areas_at_a_point_in_sql(spark):
    random_ = random.Random(5)
    polygons = [HOLED, CONCAVE, TWO_PARTS] + [[star(random_, random_.choice([3, 9, 200]), random_.choice([0.05, 1, 15]))] for _ in range(30)]
    points = [(random_.uniform(-30, 30), random_.uniform(-30, 30)) for _ in range(600)] + [(i / 2, j / 2) for i in range(20) for j in range(20)]
    spots, areas = frames(spark, polygons, points)
    spatial.register_areas(spark, areas, "test_areas_at")
    joined = spark.sql("SELECT s.pid, a.shape_id FROM {s} s, LATERAL test_areas_at(s.x, s.y) a", s=spots)
    assert found(joined) == wanted(polygons, points)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
