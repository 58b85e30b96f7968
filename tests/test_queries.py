"""Every registered query against its SQL on the smallest tables, and the pieces they are made of."""

import datetime
import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from emberlake.functions import calendar, clean, stats
from emberlake.operators import calendars
from emberlake.plans import analytics, answers, catalog, quality

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, answers.SQL
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def text(value):
    return "null" if value is None else repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    cursor = oracle.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(text(row[columns.index(c)]) for c in order) for row in cursor.fetchall())
    got = sorted(tuple(text(row[c]) for c in order) for row in df.collect())
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).columns[:2] == ["event_id", "x"]


def test_week_label_equals_python(spark):
    spine = calendar.spine(spark, "2018-01-01", "2026-12-31").collect()
    assert len(spine) == 3287
    assert all(r.week == r.date.strftime("%m-%W") and r.month_name == r.date.strftime("%b") for r in spine)


def test_weeks_that_meet_no_spine_label_are_left_out(spark):
    labels = spark.range(1).select(calendar.week_labels("2021-01-01", "2021-12-31").alias("w")).first().w
    days = [datetime.date(2021, 1, 1) + datetime.timedelta(n) for n in range(365)]
    assert sum(d.strftime("%m-%W") not in labels for d in days) == 18


def test_clock_and_times(spark):
    df = spark.createDataFrame([("0412",), ("04:12",), ("412",), ("2400",), (None,)], "t string")
    got = df.select(clean.clock(F.col("t")).alias("c"), clean.fire_time(F.lit("2021-02-03"), F.col("t")).alias("f"),
                    clean.weather_time(F.lit("20210203"), F.col("t")).alias("w")).collect()
    assert [r.c for r in got] == ["04:12", "04:12", "412", "24:00", None]
    assert [r.f is not None for r in got] == [True, True, False, False, False]
    assert [r.w is not None for r in got] == [True, False, False, False, True]
    assert got[4].w == datetime.datetime(2021, 2, 3)


def test_numbers_and_names(spark):
    df = spark.createDataFrame([("12",), ("-12.7",), (" 3 ",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(clean.whole(F.col("t"))).collect()] == [12, -12, 3, None, None, None]
    assert [r[0] for r in df.select(clean.real(F.col("t"))).collect()][0:2] == [12.0, pytest.approx(-12.7)]
    paths = ["a/b/c.tar.gz", ".bashrc", "x", "a.", "a..txt", "d.d/x"]
    names = spark.createDataFrame([(p,) for p in paths], "p string")
    got = names.select(clean.file_stem(F.col("p")).alias("s"), clean.base_name(F.col("p")).alias("b")).collect()
    assert [(r.s, r.b) for r in got] == [(os.path.splitext(p)[0], os.path.basename(p)) for p in paths]


def test_correlation_skips_nulls_and_constants(spark):
    df = spark.createDataFrame([(1, 2, 5), (2, 4, 5), (3, 7, 5), (None, 100, 5)], "a int, b int, c int")
    row = df.select(stats.correlation("a", "b").alias("ab"), stats.correlation("a", "c").alias("ac")).first()
    assert math.isclose(row.ab, df.where("a is not null").corr("a", "b")) and row.ac is None


def test_rolling_sums_equal_range_frames(spark):
    days = spark.sql("SELECT explode(sequence(date'2020-11-01', date'2021-02-28')) AS date, explode(array('p', 'q')) AS k")
    daily = days.withColumn("value", F.expr("IF(hash(k, date) % 3 = 0, abs(hash(date)) % 50, NULL)").cast("long"))
    got = calendars.rolling_sums(daily, ["k"], "date", "value", [3, 15])
    want = daily.selectExpr(
        "*",
        *[f"sum(value) over (partition by k order by date range between interval {n} days preceding and current row) AS sum_w{n}" for n in (3, 15)],
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(got.columns).collect()), key=repr)


def test_rolling_sums_of_fractions_keep_their_digits(spark):
    """A huge value long before a window leaves the window's small sum exact; running totals would not."""
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-12-31')) AS date, explode(array('p', 'q')) AS k")
    daily = days.withColumn(
        "value", F.expr("CASE WHEN date = date'2020-01-05' THEN 1e17D WHEN hash(k, date) % 4 = 0 THEN abs(hash(date)) % 50 / 8D END")
    )
    lengths = [0, 3, 11, 12, 15, 30, 150]
    got = calendars.rolling_sums(daily, ["k"], "date", "value", lengths)
    want = daily.selectExpr(
        "*",
        *[f"sum(value) over (partition by k order by date range between interval {n} days preceding and current row) AS sum_w{n}" for n in lengths],
    )
    late = "date > '2020-07-01'"
    assert sorted(map(tuple, got.where(late).collect()), key=repr) == sorted(map(tuple, want.where(late).select(got.columns).collect()), key=repr)
    assert got.columns == ["date", "k", "value", *[f"sum_w{n}" for n in lengths]]


def test_week_labels_of_every_kind_of_year(spark):
    years = spark.range(1895, 2105).select(F.col("id").cast("int").alias("year"))
    got = {r.year: r.labels for r in years.select("year", calendar.week_labels_of(F.col("year")).alias("labels")).collect()}
    for year, labels in got.items():
        days = [datetime.date(year, 1, 1) + datetime.timedelta(n) for n in range(366)]
        assert labels == sorted({d.strftime("%m-%W") for d in days if d.year == year}), year


def test_empty_weeks_have_count_zero_and_no_value(spark):
    rows = [("a", "PRCP", 5, datetime.datetime(2021, 1, 5), 0.0), ("a", "PRCP", 7, datetime.datetime(2021, 1, 6), 0.0),
            ("a", "PRCP", 9, datetime.datetime(2021, 1, 6), 10.0), ("a", "TAVG", 9, datetime.datetime(2021, 1, 6), 0.0)]
    weather = spark.createDataFrame(rows, "adm string, element string, value int, datetime timestamp, distance_from_station double")
    got = {r.week: (r.days_recorded, r.agg_value) for r in analytics.weekly_readings(weather, "PRCP", "2021-01-01", "2021-12-31").collect()}
    assert len(got) == 53 and got["01-01"] == (2, 12)
    assert {v for k, v in got.items() if k != "01-01"} == {(0, None)}


def test_every_timed_reading_is_in_its_week(spark):
    days = [datetime.datetime(2021, 1, 1) + datetime.timedelta(n) for n in range(365)] + [datetime.datetime(2020, 12, 31), None, None]
    rows = [("a", "PRCP", 1, d, 0.0) for d in days]
    weather = spark.createDataFrame(rows, "adm string, element string, value int, datetime timestamp, distance_from_station double")
    got = analytics.weekly_readings(weather, "PRCP").groupBy("year").agg(F.sum("days_recorded").alias("n")).collect()
    assert {r.year: r.n for r in got} == {2021: 365, 2020: 1}
    assert tuple(analytics.untimed(weather).first()) == (368, 2)
    fires = spark.createDataFrame([("p", None, "R", d) for d in days], "adm4_name string, adm7_name string, adm6_name string, datetime timestamp")
    assert {r.month_name for r in analytics.monthly_fires(fires).collect()} == set(calendar.MONTH_NAMES)
    wide = analytics.region_month_pivot(analytics.region_month_fires(fires)).collect()
    assert sorted(r.year for r in wide) == [2020, 2021]
    none = spark.range(1).select(calendar.week_label(F.lit(None).cast("date")).alias("w"), calendar.month_name_of(F.lit(None).cast("int")).alias("m"))
    assert tuple(none.first()) == (None, None)


def test_checks_without_a_true_result_fail(spark):
    value = lambda rows: spark.createDataFrame(rows, "value int")
    quality.enforce({"one": (value([(1,)]), 1)})
    for rows in ([], [(None,)], [(0,)], [(1,), (0,)]):
        with pytest.raises(quality.QualityError, match="bad"):
            quality.enforce({"one": (value([(1,)]), 1), "bad": (value(rows), 1)})


def test_groups_sharing_a_region_label_are_averaged(spark):
    when = datetime.datetime(2021, 3, 1)
    fires = spark.createDataFrame(
        [("S", None, "R", when)] * 1 + [("S", "R", "x", when)] * 3, "adm4_name string, adm7_name string, adm6_name string, datetime timestamp"
    )
    wide = analytics.region_month_pivot(analytics.region_month_fires(fires)).collect()
    assert len(wide) == 1 and wide[0].mar == 2.0 and wide[0].jan == 0.0


def test_equality_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fires")
    spark.range(10).selectExpr("concat('S', id) AS adm4_name", "current_timestamp() AS datetime", "'POINT (1 2)' AS geometry", "id AS other").write.parquet(path)
    plan = analytics.fires_of_parents(spark.read.parquet(path), "S3", 2021, 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(adm4_name,S3)" in plan and "ReadSchema: struct<adm4_name:string,datetime:timestamp,geometry:string>" in plan
