"""Jobs on landed files, sinks, archives and checks."""

import datetime
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from emberlake.operators import hierarchy, skew, spatial
from emberlake.plans import analytics, jobs, quality
from emberlake.session import tune
from emberlake.sources import archive, readers, sinks
from emberlake.streaming import daily

AREAS = [
    {"osm_id": -1, "admin_level": 2, "name": "Root", "parents": None, "geom": "SRID=4326;POLYGON((0 0,9 0,9 9,0 9,0 0))"},
    {"osm_id": -2, "admin_level": 4, "name": "State", "parents": "-1", "geom": "SRID=4326;POLYGON((0 0,5 0,5 5,0 5,0 0))"},
    {"osm_id": -3, "admin_level": 8, "name": "City", "parents": "-2,-1", "geom": "SRID=4326;MULTIPOLYGON(((0 0,4 0,4 4,2 2,0 4,0 0)),((6 6,9 6,9 9,6 9,6 6),(7 7,8 7,8 8,7 8,7 7)))"},
    {"osm_id": -4, "admin_level": 8, "name": "Town", "parents": "-1", "geom": "POLYGON((3 0,5 0,5 2,3 2,3 0))"},
    {"osm_id": -5, "admin_level": 8, "name": "Lost", "parents": "-99", "geom": "POLYGON((20 20,21 20,21 21,20 20))"},
]
HEADER = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,confidence,bright_ti5,frp"
FIRES = [
    "0.5,3.5,330.1,0.4,0.4,2021-02-03,0412,nominal,290.5,2.1",  # in City and Town
    "0.5,0.5,330.1,0.4,0.4,2021-02-03,04:12,nominal,290.5,2.1",  # in City
    "0.5,1.0,n/a,0.4,0.4,2021-02-04,412,low,290.5,2.1",  # in City, unreadable time
    "7.5,7.5,1,1,1,2021-02-03,0412,low,1,1",  # in a hole
    "7.0,7.5,1,1,1,2021-03-03,0412,low,1,1",  # on the hole's edge
    "15,15,1,1,1,2021-02-03,0412,low,1,1",  # nowhere
]


def station(id_, lat, lon, elevation, name):
    return f"{id_:<11} {lat:>8} {lon:>9} {elevation:>6} XX {name:<30} GSN HCN 12345"


STATIONS = [
    station("ST000000001", "1.0000", "1.0000", "12.5", "INSIDE A"),
    station("ST000000002", "0.5000", "0.5000", "-999.9", "INSIDE B"),
    station("ST000000003", "1.5000", "0.5000", "1.0", "INSIDE C"),
    station("ST000000004", "0.2500", "0.2500", "1.0", "INSIDE D"),
    station("ST000000005", "-0.3000", "1.0000", "1.0", "CLOSE"),
    station("ST000000006", "84.0000", "1.0000", "1.0", "POLE"),
    station("ST000000007", "-80.0000", "1.0000", "1.0", "POLE"),
    station("ST000000008", "20.5000", "20.9000", "1.0", "FAR"),
]
WEATHER = [
    "ST000000001,20210203,PRCP,120,,,S,0700",
    "ST000000001,20210204,PRCP,0,,,S,",
    "ST000000002,20210204,TAVG,231,,,S,2400",
    "ST000000002,20210205,TAVG,x,,,S,0700",
    "ST999999999,20210204,PRCP,5,,,S,0700",
]


def land(lake, name, lines, compress=True):
    path = lake.landed(name).removeprefix("file://")
    import os

    os.makedirs(path, exist_ok=True)
    data = "\n".join(lines).encode() + b"\n"
    with open(f"{path}/part.txt" + (".gz" if compress else ""), "wb") as f:
        f.write(gzip.compress(data) if compress else data)


@pytest.fixture
def lake(tmp_path):
    made = daily.Lake(str(tmp_path))
    land(made, "shapes", [json.dumps(a) for a in AREAS], compress=False)
    land(made, "stations", STATIONS)
    land(made, "fires/2021", [HEADER, *FIRES])
    land(made, "weather/2021", WEATHER)
    return made


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_daily_run(spark, lake):
    daily.run_day(spark, lake, "2021-02-05")
    relations = spark.read.parquet(lake.table("relations"))
    assert rows(relations, "id", "adm", "adm2", "adm2_name", "adm4", "adm4_name") == [
        ("-1", 2, None, None, None, None),
        ("-2", 4, "-1", "Root", None, None),
        ("-3", 8, "-1", "Root", "-2", "State"),
        ("-4", 8, "-1", "Root", None, None),
        ("-5", 8, None, None, None, None),
    ]
    shapes = spark.read.parquet(lake.table("shapes"))
    assert not any("SRID" in r.geometry for r in shapes.collect()) and shapes.count() == 5

    fires = spark.read.parquet(lake.table("fires"))
    assert rows(fires, "geometry", "adm", "adm_name", "adm4_name", "year", "month") == [
        ("POINT (0.5 0.5)", "-3", "City", "State", 2021, 2),
        ("POINT (1.0 0.5)", "-3", "City", "State", 2021, None),
        ("POINT (3.5 0.5)", "-3", "City", "State", 2021, 2),
        ("POINT (3.5 0.5)", "-4", "Town", None, 2021, 2),
        ("POINT (7.5 7.0)", "-3", "City", "State", 2021, 3),
    ]
    assert dict(fires.dtypes)["frp"] == "float" and dict(fires.dtypes)["datetime"] == "timestamp"
    by_point = {r.geometry: r for r in fires.where("adm = '-3'").collect()}
    assert by_point["POINT (0.5 0.5)"].datetime == datetime.datetime(2021, 2, 3, 4, 12)
    assert by_point["POINT (1.0 0.5)"].bright_ti4 is None and by_point["POINT (1.0 0.5)"].datetime is None

    stations = spark.read.parquet(lake.table("stations"))
    got = {(r.name, r.adm_name): r.distance for r in stations.collect()}
    inside = {("INSIDE " + x, "City"): 0.0 for x in "ABCD"}
    assert {k: v for k, v in got.items() if k[1] == "City"} == inside  # four tie at rank one, none further out
    assert ("FAR", "Lost") in got and not any(name == "POLE" for name, _ in got)
    assert stations.where("name = 'INSIDE B'").first().elevation == pytest.approx(-999.9)

    weather = spark.read.parquet(lake.table("weather"))
    assert rows(weather, "station", "element", "value", "year", "month", "adm_name") == [
        ("ST000000001", "PRCP", 0, 2021, 2, "City"),
        ("ST000000001", "PRCP", 120, 2021, 2, "City"),
        ("ST000000002", "TAVG", 231, None, None, "City"),
        ("ST000000002", "TAVG", None, 2021, 2, "City"),
    ]


def test_running_a_day_again_changes_nothing_and_other_months_stay(spark, lake):
    daily.run_day(spark, lake, "2021-02-05")
    columns = ["geometry", "adm", "year", "month", "confidence"]
    before = rows(spark.read.parquet(lake.table("fires")), *columns)
    daily.run_day(spark, lake, "2021-02-05", areas=False, stations=False)
    assert rows(spark.read.parquet(lake.table("fires")), *columns) == before
    land(lake, "fires/2021", [HEADER, "0.5,0.5,1,1,1,2021-02-09,0101,high,1,1"])
    daily.catch_up(spark, lake, "2021-02-01", "2021-02-09")
    after = rows(spark.read.parquet(lake.table("fires")), *columns)
    assert [r for r in after if r[3] == 3] == [r for r in before if r[3] == 3]
    assert [r for r in after if r[3] == 2] == [("POINT (0.5 0.5)", "-3", 2021, 2, "high")]


def test_the_recency_check_opens_only_its_months(spark, lake):
    daily.run_day(spark, lake, "2021-02-05")
    table = readers.read_table(spark, lake.table("fires"), ["datetime", "year", "month"])
    plan = quality.has_recent_rows(table, "2021-02-05", 3)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "year#" in filters and "month#" in filters and "2021" in filters
    for run_date, days, value in (("2021-02-05", 3, 1), ("2021-03-07", 3, 0), ("2021-03-05", 3, 1), ("2022-01-02", 400, 1)):
        assert quality.has_recent_rows(table, run_date, days).first()["value"] == value, run_date


def test_checks_come_from_what_was_written(spark, lake):
    results = daily.run_day(spark, lake, "2021-02-05")
    assert [(r.check, r.value, r.passed) for r in results] == [("fires are recent", 1, True), ("weather is recent", 1, True)]
    seen = daily.reprocess_fires(spark, lake, [2021])[2021]
    assert (seen.rows, seen.last, seen.years, seen.strays) == (5, datetime.datetime(2021, 3, 3, 4, 12), (2021,), 0)
    assert seen.reaches("2021-03-06", 3) == 1 and seen.reaches("2021-03-07", 3) == 0
    rain = daily.reprocess_weather(spark, lake, [2021])[2021]
    assert (rain.rows, rain.years, rain.strays) == (4, (2021,), 1)


def test_strays_stay_when_other_years_are_rebuilt(spark, lake):
    daily.rebuild_areas(spark, lake)
    daily.rebuild_stations(spark, lake)
    land(lake, "weather/2020", ["ST000000001,20200203,PRCP,7,,,S,0700", "ST000000001,20200203,TAVG,8,,,S,2400", "ST000000001,20210901,PRCP,9,,,S,0700"])
    landed = ["station", "element", "value", "year", "month"]
    want = [
        ("ST000000001", "PRCP", 0, 2021, 2), ("ST000000001", "PRCP", 120, 2021, 2), ("ST000000001", "PRCP", 7, 2020, 2),
        ("ST000000001", "PRCP", 9, 2021, 9), ("ST000000001", "TAVG", 8, None, None), ("ST000000002", "TAVG", 231, None, None),
        ("ST000000002", "TAVG", None, 2021, 2),
    ]
    for years in ([2020, 2021], [2021], [2020], [2021, 2020], [2021]):
        daily.reprocess_weather(spark, lake, years)
        assert rows(spark.read.parquet(lake.table("weather")), *landed) == sorted(want, key=repr), years
    land(lake, "weather/2020", ["ST000000001,20200203,PRCP,7,,,S,0700"])
    daily.reprocess_weather(spark, lake, [2020])
    assert spark.read.parquet(lake.table("weather_strays")).where("landed = 2020").count() == 0


def test_the_ledger_rebuilds_what_changed(spark, lake):
    daily.rebuild_areas(spark, lake)
    daily.rebuild_stations(spark, lake)
    land(lake, "weather/2020", ["ST000000001,20200203,PRCP,7,,,S,0700"])
    assert daily.sync(spark, lake) == {"fires": [2021], "weather": [2020, 2021]}
    assert daily.sync(spark, lake) == {"fires": [], "weather": []}
    land(lake, "weather/2020", ["ST000000001,20200203,PRCP,7,,,S,0700", "ST000000001,20200204,PRCP,8,,,S,0700"])
    land(lake, "fires/2022", [HEADER, "0.5,0.5,1,1,1,2022-02-09,0101,high,1,1"])
    assert daily.sync(spark, lake, at_once=1) == {"fires": [2022], "weather": [2020]}
    assert daily.sync(spark, lake, ["weather"]) == {"weather": []}
    assert rows(spark.read.parquet(lake.table("weather")).where("year = 2020"), "value") == [(7,), (8,)]
    known = spark.read.parquet(lake.table("ledger"))
    assert rows(known.groupBy("kind", "year").count(), "kind", "year", "count") == [
        ("fires", 2021, 1), ("fires", 2022, 1), ("weather", 2020, 1), ("weather", 2021, 1),
    ]


def test_a_rebuild_makes_the_tiles_of_areas_once(spark, lake, monkeypatch):
    """However many years it rebuilds, and some of them again for rows that lie in another year's folder."""
    daily.rebuild_areas(spark, lake)
    land(lake, "fires/2022", [HEADER, "0.5,0.5,1,1,1,2022-02-09,0101,high,1,1", "0.5,0.5,1,1,1,2021-07-09,0101,late,1,1"])
    made = []
    monkeypatch.setattr(spatial, "area_tiles", lambda *a, make=spatial.area_tiles: made.append(a) or make(*a))
    written = daily.reprocess_fires(spark, lake, [2021, 2022])
    assert len(made) == 1
    assert (written[2021].rows, written[2022].strays) == (6, 1)
    fires = spark.read.parquet(lake.table("fires")).where("confidence IN ('high', 'late')")
    assert rows(fires, "year", "month", "adm", "confidence") == [(2021, 7, "-3", "late"), (2022, 2, "-3", "high")]


@pytest.mark.parametrize("options", [{}, {"limit": 0}])
def test_rows_are_watched_before_a_join_makes_many_of_each(spark, options):
    fact = spark.sql("SELECT * FROM VALUES ('a', 1, timestamp'2020-01-05', 2020), ('a', 2, timestamp'2021-01-05', 2021), ('b', 3, null, null), ('z', 4, timestamp'2030-01-05', 2030), (null, 5, null, 2031) AS t(k, i, datetime, year)")
    links = spark.sql("SELECT IF(id < 50, 'a', 'b') AS k, id AS v FROM range(53)")
    for dimension, want in ((links, (103, datetime.datetime(2021, 1, 5), (2020, 2021), 53)), (links.where("v < 0"), (0, None, (), 0))):
        watch = quality.Watch(~F.col("year").eqNullSafe(F.lit(2020)))
        joined = skew.dimension_join(fact, dimension, ["k"], deal=["year"], watch=watch.over, **options)
        assert rows(joined, "k", "i", "v") == rows(fact.join(dimension, "k"), "k", "i", "v")
        watch = quality.Watch(~F.col("year").eqNullSafe(F.lit(2020)))
        joined = skew.dimension_join(fact, dimension, ["k"], deal=["year"], watch=watch.over, **options)
        joined.write.format("noop").mode("overwrite").save()
        assert tuple(watch.result()) == want
    plan = skew.dimension_join(fact, links, ["k"], watch=quality.Watch().over)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("CollectMetrics")


def test_weather_of_a_lake_without_stations(spark, lake):
    daily.rebuild_areas(spark, lake)
    land(lake, "stations", [station("ST000000001", "60.0000", "60.0000", "1.0", "NOWHERE")])
    daily.rebuild_stations(spark, lake)
    seen = daily.reprocess_weather(spark, lake, [2021])[2021]
    assert (seen.rows, seen.last, seen.years, seen.strays) == (0, None, (), 0)


def test_an_extra_load_keeps_the_rest_of_its_months(spark, lake):
    daily.run_day(spark, lake, "2021-02-05")
    columns = ["geometry", "adm", "year", "month", "confidence"]
    before = rows(spark.read.parquet(lake.table("fires")), *columns)
    land(lake, "extra", [HEADER, "0.5,0.5,330.1,0.4,0.4,2021-02-03,04:12,again,290.5,2.1", "0.5,0.5,1,1,1,2021-02-20,0101,new,1,1",
                         "0.5,0.5,1,1,1,2021-02-20,0101,new,1,1", "0.5,0.5,1,1,1,2021-02-21,412,untimed,1,1", "0.5,0.5,1,1,1,2019-07-20,0101,old,1,1"])
    for _ in range(2):
        daily.load_extra(spark, lake, "fires", lake.landed("extra"))
        after = rows(spark.read.parquet(lake.table("fires")), *columns)
        replaced = ("POINT (0.5 0.5)", "-3", 2021, 2, "nominal")
        added = [("POINT (0.5 0.5)", "-3", 2021, 2, "again"), ("POINT (0.5 0.5)", "-3", 2021, 2, "new"), ("POINT (0.5 0.5)", "-3", 2019, 7, "old")]
        assert after == sorted([*(r for r in before if r != replaced), *added], key=repr)


def test_merge_reads_and_writes_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(40).selectExpr("id", "IF(id % 7 = 0, NULL, 'old') AS v", "IF(id % 10 = 9, NULL, CAST(id % 10 AS INT)) AS part")
    sinks.merge_partitions(table, path, ["part"], ["id"])
    names = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before = names()
    new = spark.createDataFrame([(3, "new", 3), (103, "new", 3), (19, "new", None), (None, "new", None), (None, "new", None)], "id long, v string, part int")
    sinks.merge_partitions(new, path, ["part"], ["id"])
    touched = {f for f in before if f not in names()}
    assert touched and all("part=3/" in f or "HIVE_DEFAULT" in f for f in touched)
    want = {(r.id, r.v, r.part) for r in table.collect()} - {(3, "old", 3), (19, "old", None)}
    got = [(r.id, r.v, r.part) for r in spark.read.schema("id long, v string, part int").parquet(path).collect()]
    assert len(got) == len(set(got)) and set(got) == want | {(3, "new", 3), (103, "new", 3), (19, "new", None), (None, "new", None)}
    sinks.merge_partitions(new.limit(0), path, ["part"], ["id"])


def test_stale_or_missing_data_fails_the_checks(spark, lake):
    with pytest.raises(quality.QualityError, match="fires are recent"):
        daily.run_day(spark, lake, "2021-12-05")
    daily.back_fill(spark, lake, [2021], [2021])
    fires = spark.read.parquet(lake.table("fires"))
    assert quality.missing_years(fires, [2020, 2021, 2022]).count() == 2
    with pytest.raises(quality.QualityError):
        quality.enforce({"years": (quality.missing_year_count(fires, [2020, 2021]), 0)})
    quality.assert_scalar(
        spark,
        "SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END FROM fires WHERE datetime >= date_sub(CAST(:d AS DATE), 3)",
        tables=[("fires", lake.table("fires"), ["datetime"])],
        args={"d": "2021-02-05"},
    )
    with pytest.raises(quality.QualityError, match="empty"):
        quality.assert_scalar(spark, "SELECT 0", message="empty")
    assert quality.has_rows(fires.where("false")).first()[0] == 0


OTHER = "longitude,latitude,brightness,bright_t31,frp,scan,track,acq_date,acq_time,confidence"


def test_instruments_are_unified_by_name(spark, tmp_path):
    lake = daily.Lake(str(tmp_path))
    land(lake, "a", [HEADER, FIRES[0]])
    land(lake, "b", [OTHER, "1,2,3,4,5,6,7,2021-01-01,0000,high"])
    both = readers.read_fires(spark, lake.landed("a"), lake.landed("b"))
    assert rows(both, "longitude", "bright_ti4", "bright_ti5") == [("1", "3", "4"), ("3.5", "330.1", "290.5")]


def mixed_folder(lake):
    """Files of both instruments, packed and plain, one with another order of columns, one with a mark, one empty."""
    land(lake, "fires/2021", [HEADER, *FIRES])
    folder = lake.landed("fires/2021")
    moved = ",".join(reversed(HEADER.split(",")))
    texts = {
        "other.csv": f"{OTHER}\n0.5,0.5,3,4,5,6,7,2021-04-01,0000,high\n",
        "marked.csv": f"\ufeff{OTHER}\r\n0.5,0.6,3,4,5,6,7,2021-04-01,0000,high\r\n",
        "moved.csv": f"{moved}\n9,280.5,low,0000,2021-05-01,1,1,320.5,0.5,0.5\n",
        "quoted.csv": '"latitude","longitude","acq_date","acq_time"\n0.5,0.7,2021-06-01,0000\n',
        "header_only.csv": f"{OTHER}\n",
        "empty.csv": "",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as out:
            out.write(text)
    return folder


@pytest.mark.parametrize("schemes", [("file",), ()])
def test_one_folder_of_both_instruments(spark, tmp_path, monkeypatch, schemes):
    monkeypatch.setattr(readers, "SCHEMES", schemes)
    folder = mixed_folder(daily.Lake(str(tmp_path)))
    assert readers.headers(spark, [folder]).where("header IS NOT NULL").count() == 6
    got = readers.read_fires(spark, folder)
    assert rows(got.where("acq_date > '2021-03-31'"), "longitude", "latitude", "bright_ti4", "bright_ti5", "frp") == sorted(
        [("0.5", "0.5", "3", "4", "5"), ("0.5", "0.6", "3", "4", "5"), ("0.5", "0.5", "320.5", "280.5", "9"), ("0.7", "0.5", None, None, None)], key=repr
    )
    assert got.count() == len(FIRES) + 4
    with pytest.raises(ValueError, match="no file with a header"):
        readers.read_fires(spark, f"{folder}/empty.csv")


def test_the_fire_job_takes_a_mixed_folder(spark, lake):
    mixed_folder(lake)
    daily.rebuild_areas(spark, lake)
    daily.reprocess_fires(spark, lake, [2021])
    table = spark.read.parquet(lake.table("fires")).where("month > 3")
    assert rows(table, "geometry", "bright_ti4", "month") == [
        ("POINT (0.5 0.5)", 3.0, 4), ("POINT (0.5 0.5)", 320.5, 5), ("POINT (0.5 0.6)", 3.0, 4), ("POINT (0.7 0.5)", None, 6),
    ]


def test_rejected_rows_are_counted(spark, lake):
    cleaned = jobs.clean_fires(readers.read_fires(spark, lake.landed("fires/2021")))
    assert tuple(jobs.rejected_fires(cleaned).first()) == (0, 1)


def test_partition_pruning_and_pushdown(spark, lake):
    daily.run_day(spark, lake, "2021-02-05")
    table = readers.read_table(spark, lake.table("weather"), ["station", "value"], "element = 'PRCP' AND year = 2021 AND distance_from_station = 0")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(element" in plan and "PushedFilters: [IsNotNull(distance_from_station)" in plan
    assert "ReadSchema: struct<station:string,value:int,distance_from_station:float>" in plan
    level = readers.at_level(spark.read.parquet(lake.table("shapes")), 8)
    assert level.columns == ["geometry", "id"] and level.count() == 3
    assert "PartitionFilters: [isnotnull(adm" in level._jdf.queryExecution().executedPlan().toString()


def test_file_cap_and_static_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(2500).selectExpr("id", "id % 1 AS adm")
    sinks.replace_table(df, path, ["adm"], 1000)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 1000
    sinks.replace_table(df.where("id < 5").withColumn("adm", F.lit(7)), path, ["adm"], 1000)
    assert spark.read.parquet(path).count() == 5


def test_a_name_reads_one_row_group_of_shapes(spark, tmp_path):
    path = str(tmp_path / "shapes")
    rows_ = spark.range(6000).selectExpr("concat('c', lpad(id * 7 % 6000, 5, '0')) AS id", "repeat('geometry ', 50) AS geometry", "8 AS adm")
    sinks.replace_table(rows_, path, ["adm"], 1000, ["id"])
    relations = spark.range(6000).selectExpr("concat('c', lpad(id, 5, '0')) AS id", "concat('name ', id) AS name")
    found = analytics.shapes_by_name(readers.at_level(spark.read.parquet(path), 8), relations, "name 4321")
    assert [r.id for r in found.collect()] == ["c04321"]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert 0 < scan.metrics().apply("numOutputRows").value() <= 1000
    twins = relations.withColumn("name", F.lit("same"))
    assert analytics.shapes_by_name(spark.read.parquet(path), twins, "same").count() == 6000


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    plan = sinks.by_partition(spark.range(10).selectExpr("id", "id % 2 AS month"), ["month"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan._jdf.queryExecution().executedPlan().toString()


def test_zip_members(spark, tmp_path):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("deep/fire_a.csv", "h\n" + "\n".join(str(i) for i in range(45_000)) + "\n")
        z.writestr("fire_b.csv", "h\né\n")
        z.writestr("readme.txt", "no")
        z.writestr("empty/", "")
    (tmp_path / "one.zip").write_bytes(held.getvalue())
    lines = archive.read_zip_lines(spark, str(tmp_path), lambda m: "fire" in m)
    assert rows(lines.groupBy("member").count(), "member", "count") == [("deep/fire_a.csv", 45_001), ("fire_b.csv", 2)]
    assert archive.read_zip_lines(spark, str(tmp_path), lambda m: "absent" in m).count() == 0
    target = str(tmp_path / "landed")
    archive.land_members(lines, target, F.concat(F.lit("2021_"), F.regexp_extract("member", r"([^/]+)\.csv$", 1)))
    back = readers.read_csv(spark, f"{target}/file=2021_fire_a")
    assert back.columns == ["h"] and back.count() == 45_000
    assert [r.h for r in readers.read_csv(spark, f"{target}/file=2021_fire_b").collect()] == ["é"]


def test_members_are_tasks(spark, tmp_path):
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for i in range(5):
                z.writestr(f"m{i}.csv", f"{name}{i}\n" * (i + 1))
    (tmp_path / "not.txt").write_text("x")
    lines = archive.read_zip_lines(spark, str(tmp_path), task_bytes=1)
    assert lines.rdd.getNumPartitions() == 10 and lines.count() == 30
    shared = archive.read_zip_lines(spark, [f"{tmp_path}/a.zip", f"file://{tmp_path}/b*.zip"])
    assert shared.rdd.getNumPartitions() == 1 and shared.select("line").distinct().count() == 10
    assert rows(shared.where("member = 'm1.csv'"), "line_no", "line") == [(0, "a1"), (0, "b1"), (1, "a1"), (1, "b1")]
    with pytest.raises(Exception, match="absent"):
        archive.read_zip_lines(spark, f"{tmp_path}/absent.zip").count()


def test_a_member_of_over_100_megabytes_is_read_as_a_stream(spark, tmp_path):
    line = "0123456789" * 100 + "\n"
    with zipfile.ZipFile(tmp_path / "large.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        with z.open("large.csv", "w", force_zip64=True) as out:
            for _ in range(120):
                out.write((line * 1000).encode())
        z.writestr("small.csv", "x\n")
    lines = archive.read_zip_lines(spark, f"{tmp_path}/large.zip")
    assert lines.rdd.getNumPartitions() == 2
    found = lines.groupBy("member").agg(F.count("*").alias("n"), F.max("line_no").alias("last"), F.min(F.length("line")).alias("least"))
    assert rows(found, "member", "n", "last", "least") == [("large.csv", 120_000, 119_999, 1000), ("small.csv", 1, 0, 1)]
    reader = archive.ZipLinesReader([f"{tmp_path}/large.zip"], archive.is_file, archive.TASK_BYTES)
    import tracemalloc

    tracemalloc.start()
    assert sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part)) == 120_001
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6  # a batch of 20,000 lines of 1,000 characters, twice


def test_manifest(spark):
    listed = spark.createDataFrame(
        [("a.b.txt", "2021-02-03 01:00", "5", "/x"), ("c.txt", "2021-02-04 01:00", "6", "/y"), ("d.txt", "2021-02-04 02:00", "7", "/z")],
        "name string, last_modified string, mtime string, downloadsLink string",
    ).coalesce(1)
    assert archive.pick_from_manifest(listed, "2021-02-03")["filename"] == "a.b"
    assert archive.pick_from_manifest(listed, "2021-02-04")["link"] == "/y"
    with pytest.raises(archive.NotInManifest):
        archive.pick_from_manifest(listed, "2021-02-05")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    """One key owns a third of the rows, and they are copies; some keys are null."""
    many = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id % 90 END AS k", "IF(id % 3 = 0, 0, id) AS v"
    ).repartition(7)
    few = spark.range(60).selectExpr("id AS k", "id * 2 AS w").unionAll(spark.range(7, 9).selectExpr("id AS k", "0L AS w"))
    got = skew.salted_join(many, few, ["k"], how, hot_rows=100)
    want = many.join(few, ["k"], how)
    assert got.columns == want.columns and rows(got, *want.columns) == rows(want, *want.columns)
    hot = skew.heavy_keys(many, ["k"], 100).collect()
    assert [(r.k, r._parts) for r in hot] == [(7, 11)]


def test_salt_spreads_copies(spark):
    copies = spark.range(4000).selectExpr("7 AS k").repartition(64)
    parts = copies.select(skew._row_spread(copies, F.lit(8)).alias("p")).groupBy("p").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 1500


def test_dimension_join_checks_size(spark):
    fact, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    small = skew.dimension_join(fact, dim, ["k"])._jdf.queryExecution().executedPlan().toString()
    large = skew.dimension_join(fact, dim, ["k"], limit=10)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in small and "SortMergeJoin" in large


def test_hierarchy_with_hot_parent_salted(spark, lake):
    source = readers.read_shapes(spark, lake.landed("shapes"))
    plain = hierarchy.relations(source, [2, 4])
    salted = hierarchy.relations(source, [2, 4], limit=0, hot_rows=1)
    assert rows(plain, *plain.columns) == rows(salted, *plain.columns)
    assert hierarchy.ancestor_columns(plain) == ["adm2", "adm2_name", "adm4", "adm4_name"]


def test_every_hot_key_and_null_keys_are_cut(spark, monkeypatch):
    from emberlake.operators import skew

    rows = [(k, i) for k in ("a", "b", "c", "d", None) for i in range(40)] + [("e", 1)]
    many = spark.createDataFrame(rows, "k string, i int")
    few = spark.createDataFrame([("a", 1), ("b", 2), ("e", 3), (None, 4)], "k string, v int")
    assert sorted(map(tuple, skew.heavy_keys(many, ["k"], 10).collect())) == [(k, 4) for k in "abcd"]
    flat = lambda df: sorted(map(repr, df.select("k", "i", "v").collect()))
    for listed in (skew.LIST_KEYS, 0):
        monkeypatch.setattr(skew, "LIST_KEYS", listed)
        for how in ("inner", "left"):
            assert flat(skew.salted_join(many, few, ["k"], how, hot_rows=10)) == flat(many.join(few, "k", how))


@pytest.mark.parametrize("options", [{}, {"limit": 0}])
def test_weather_is_written_where_it_is_joined(spark, tmp_path, options):
    """Rows made of one reading by its station's links are not shuffled or sorted for the write."""
    readings = spark.range(400).selectExpr(
        "concat('s', id % 7) AS station", "IF(id % 3 = 0, 'TAVG', 'PRCP') AS element", "int(id) AS value",
        "timestamp_ntz'2001-01-01 00:00:00' AS datetime", "2001 AS year", "int(id % 12) + 1 AS month",
    )
    links = spark.range(60).selectExpr(
        "concat('s', id % 6) AS id", "float(id) AS distance", "concat('c', id) AS adm", "'n' AS adm_name", "'r' AS adm2", "'r' AS adm2_name"
    )
    tune(spark)
    table = jobs.weather_table(readings, links, deal=jobs.WEATHER_PARTITIONS, **options)
    path = str(tmp_path / "weather")
    sinks.replace_partitions(table, path, jobs.WEATHER_PARTITIONS, dealt=True)
    want = readings.join(links.withColumnRenamed("id", "station"), "station")
    got = spark.read.parquet(path)
    names = ["station", "element", "value", "adm"]
    assert rows(got, *names) == rows(want, *names) and len(rows(got, "adm")) > 3000
    # the last exchange of the rows lies below the join
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < (plan.find("Rebalance") if not options else len(plan))


def test_rows_are_dealt_in_slices_beside_a_larger_dimension(spark):
    from emberlake.operators import skew

    fact = spark.range(1000).selectExpr("id AS k", "id % 2 AS month")
    plain = skew.dealt(fact, ["month"], ["k"], 1)
    cut = skew.dealt(fact, ["month"], ["k"], 40)
    places = cut.groupBy("month", F.spark_partition_id().alias("p")).count().groupBy("month").count().collect()
    assert rows(plain, "k", "month") == rows(cut, "k", "month") and min(r["count"] for r in places) > 4
