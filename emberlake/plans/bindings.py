"""The lake's tables, derived from the driver's tables with integer arithmetic.

Each view is one SQL text that Spark and any other ANSI engine read alike; table names in braces. Area
corners lie on half hundredths of a degree and points on hundredths, so no point is on an outline by
accident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _hundredths(key: str, factor: int, modulus: int, half: int) -> str:
    return f"CAST(({key} * {factor}) % {modulus} - {half} AS DOUBLE) / 100"


def _offset_text(axis: str, units: int) -> str:
    return _text(f"CAST({axis}0 + {units} * u AS DOUBLE) / 1000") + f" AS {axis}t{units}"


# the text of every coordinate a corner may have, once
OFFSETS = ", ".join(_offset_text(axis, units) for axis in "xy" for units in (0, 3, 4, 6, 8, 9, 12))


def ring_text(corners: list[tuple[int, int]]) -> str:
    """SQL for the text of a closed ring with corners given in units from (x0, y0)."""
    points = [f"tx.xt{x} || ' ' || tx.yt{y}" for x, y in [*corners, corners[0]]]
    return "'(' || " + " || ',' || ".join(points) + " || ')'"


BOX = [(0, 0), (12, 0), (12, 12), (0, 12)]
# rings of an area by its number modulo four: bent, with a hole, slanted, in two parts
RINGS = {
    0: [[(0, 0), (12, 0), (12, 6), (6, 6), (6, 12), (0, 12)]],
    1: [BOX, [(3, 3), (9, 3), (9, 9), (3, 9)]],
    2: [[(0, 0), (12, 0), (6, 12)]],
    3: [[(0, 0), (4, 0), (4, 4), (0, 4)], [(8, 8), (12, 8), (12, 12), (8, 12)]],
}


def _polygon(rings: list) -> str:
    return "'POLYGON(' || " + " || ',' || ".join(map(ring_text, rings)) + " || ')'"


def _multipolygon(rings: list) -> str:
    return "'MULTIPOLYGON((' || " + " || '),(' || ".join(map(ring_text, rings)) + " || '))'"


# corner (x0, y0) and a twelfth of the side, in thousandths of a degree; sides shrink with the customer's
# number, so the covered ground grows only with the logarithm of the table
AREA_BOXES = """
SELECT c_custkey AS k, c_name, c_nationkey,
       ((c_custkey * 7919) % 5000 - 2500) * 10 + 5 AS x0,
       ((c_custkey * 104729) % 5000 - 2500) * 10 + 5 AS y0,
       CAST(GREATEST(FLOOR(100 / (1 + FLOOR(SQRT(c_custkey)))), 1) AS BIGINT) * 10 AS u
FROM {customer}"""
STATE_BOXES = """
SELECT n_nationkey AS k, n_name, n_regionkey, (n_nationkey % 5) * 10000 - 25005 AS x0,
       CAST(FLOOR(n_nationkey / 5) AS INT) * 10000 - 25005 AS y0, 920 AS u FROM {nation}"""
COUNTRY_BOXES = "SELECT r_regionkey AS k, r_name, r_regionkey * 20000 - 60005 AS x0, -40005 AS y0, 6700 AS u FROM {region}"

SOURCE_AREAS = f"""
SELECT 'r' || CAST(k AS STRING) AS osm_id, 2 AS admin_level, r_name AS name,
       CAST(NULL AS STRING) AS parents, 'SRID=4326;' || {_polygon([BOX])} AS geom
FROM (SELECT *, {OFFSETS} FROM ({COUNTRY_BOXES}) c) tx
UNION ALL
SELECT 'n' || CAST(k AS STRING), 4, n_name, 'r' || CAST(n_regionkey AS STRING), 'SRID=4326;' || {_polygon([BOX])}
FROM (SELECT *, {OFFSETS} FROM ({STATE_BOXES}) s) tx
UNION ALL
SELECT 'c' || CAST(k AS STRING), 8, c_name,
       'n' || CAST(c_nationkey AS STRING) || ',r' || CAST(n_regionkey AS STRING),
       CASE k % 4 WHEN 0 THEN 'SRID=4326;' || {_polygon(RINGS[0])}
                  WHEN 1 THEN 'SRID=4326;' || {_polygon(RINGS[1])}
                  WHEN 2 THEN {_polygon(RINGS[2])}
                  ELSE 'SRID=4326;' || {_multipolygon(RINGS[3])} END
FROM (SELECT *, {OFFSETS} FROM ({AREA_BOXES}) a) tx JOIN {{nation}} ON c_nationkey = n_nationkey"""

_OPEN = ring_text(BOX).rsplit(" || ',' || ", 1)[0] + " || ')'"
_SHORT = ring_text([(0, 0), (12, 0)])
# areas of which one in eight can be read; the others have one fault each
BROKEN_AREAS = f"""
SELECT 'c' || CAST(k AS STRING) AS osm_id, 8 AS admin_level, c_name AS name, CAST(NULL AS STRING) AS parents,
       CASE k % 8 WHEN 0 THEN 'SRID=4326;' || {_polygon([BOX])}
                  WHEN 1 THEN 'POLYGON(' || {_OPEN} || ')'
                  WHEN 2 THEN {_polygon([BOX])[:-len(" || ')'")]} || ',' || {_SHORT} || ')'
                  WHEN 3 THEN 'POLYGON((n/a 0,' || tx.xt12 || ' 0,0 ' || tx.yt12 || ',n/a 0))'
                  WHEN 4 THEN 'POLYGON EMPTY'
                  WHEN 5 THEN NULL
                  WHEN 6 THEN {_polygon([BOX])[:-len(" || ')'")]}
                  ELSE 'MULTIPOLYGON((' || {ring_text(BOX)} || '),(' || {_OPEN} || '))' END AS geom
FROM (SELECT *, {OFFSETS} FROM ({AREA_BOXES}) a) tx"""
FAULTS = {1: "open ring", 2: "short ring", 3: "unreadable number", 4: "no polygon", 5: "no polygon", 6: "no polygon", 7: "open ring"}

# detections as text, with both time spellings, an unpadded one and unreadable numbers
SOURCE_FIRES = f"""
SELECT event_id,
       {_text(_hundredths('event_id', 611953, 5000, 2500))} AS longitude,
       {_text(_hundredths('event_id', 104729, 4999, 2500))} AS latitude,
       CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS brightness,
       CAST(value / 2 AS STRING) AS bright_t31, CAST(value AS STRING) AS frp,
       '0.4' AS scan, '0.5' AS track, event_type AS confidence,
       CAST(CAST(ts AS DATE) AS STRING) AS acq_date,
       CASE event_id % 3
         WHEN 0 THEN LPAD(CAST(EXTRACT(HOUR FROM ts) AS STRING), 2, '0')
                     || LPAD(CAST(EXTRACT(MINUTE FROM ts) AS STRING), 2, '0')
         WHEN 1 THEN LPAD(CAST(EXTRACT(HOUR FROM ts) AS STRING), 2, '0') || ':'
                     || LPAD(CAST(EXTRACT(MINUTE FROM ts) AS STRING), 2, '0')
         ELSE CAST(EXTRACT(HOUR FROM ts) * 100 + EXTRACT(MINUTE FROM ts) AS STRING) END AS acq_time
FROM {{events}}"""

# the same detections over seven years, by the folder they land in: some with an unreadable time or date, some a year late
RUN_FIRES = f"""
SELECT event_id, longitude, latitude, brightness, bright_t31, frp, scan, track, confidence,
       CASE WHEN event_id % 499 = 0 THEN 'unknown' ELSE CAST(day AS STRING) END AS acq_date,
       CASE WHEN event_id % 97 = 0 THEN '99:99' ELSE acq_time END AS acq_time,
       CAST(EXTRACT(YEAR FROM day) AS INT) + CASE WHEN event_id % 211 = 0 AND day < DATE '2001-01-01' THEN 1 ELSE 0 END AS folder
FROM (SELECT *, DATE '1995-01-01' + CAST((event_id * 7919) % 2500 AS INT) AS day FROM ({SOURCE_FIRES}) f) d"""

# weather readings as text, with a missing and an impossible hour
SOURCE_WEATHER = """
SELECT 's' || CAST(l_suppkey AS STRING) AS station,
       REPLACE(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '') AS date,
       CASE l_returnflag WHEN 'R' THEN 'PRCP' WHEN 'A' THEN 'TAVG' ELSE 'TMAX' END AS element,
       CAST(CAST(l_quantity AS INT) AS STRING) AS value,
       CAST(NULL AS STRING) AS measurement_flag, CAST(NULL AS STRING) AS quality_flag,
       l_linestatus AS source_flag,
       CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '0700' ELSE '2400' END AS obs_time
FROM {lineitem}"""

SOURCE_STATIONS = f"""
SELECT 's' || CAST(s_suppkey AS STRING) AS id, s_name AS name, CAST(s_acctbal AS STRING) AS elevation,
       {_text(_hundredths('s_suppkey', 7907, 5000, 2500))} AS longitude,
       {_text(_hundredths('s_suppkey', 27449, 5000, 2500))} AS latitude
FROM {{supplier}}"""

# many stations around the origin, three at each place
TIED_STATIONS = f"""
SELECT 'e' || CAST(event_id AS STRING) AS id, event_type AS name, CAST(value AS STRING) AS elevation,
       {_text("CAST((p * 7919) % 7993 * 10 + 3 - 40000 AS DOUBLE) / 10000")} AS longitude,
       {_text("CAST((p * 104729) % 7963 * 10 + 3 - 40000 AS DOUBLE) / 10000")} AS latitude
FROM (SELECT *, CAST(FLOOR(event_id / 3) AS BIGINT) AS p FROM {{events}}) e"""

# the same stations as lines of fixed width
STATION_LINES = f"""
SELECT RPAD(id, 11, ' ') || ' ' || LPAD(latitude, 8, ' ') || ' ' || LPAD(longitude, 9, ' ') || ' '
       || LPAD(SUBSTR(elevation, 1, 6), 6, ' ') || ' ' || 'XX' || ' ' || RPAD(name, 30, ' ')
       || ' ' || '   ' || ' ' || '   ' || ' ' || '00000' AS value
FROM ({SOURCE_STATIONS}) s"""

# fires and weather in the form of the finished fact tables, areas known by key
FIRES = f"""
SELECT o_orderkey AS fire_id, o_orderdate AS datetime, 'c' || CAST(o_custkey AS STRING) AS adm,
       'Customer#' || LPAD(CAST(o_custkey AS STRING), 9, '0') AS adm_name,
       'NATION_' || CAST(o_custkey % 25 AS STRING) AS adm4_name,
       'District ' || CAST(o_custkey % 40 AS STRING) AS adm6_name,
       CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'Region ' || CAST(o_custkey % 60 AS STRING) END AS adm7_name,
       'POINT (' || {_text(_hundredths('o_orderkey', 611953, 5000, 2500))} || ' '
                 || {_text(_hundredths('o_orderkey', 104729, 4999, 2500))} || ')' AS geometry
FROM {{orders}}"""

WEATHER = """
SELECT 's' || CAST(l_suppkey AS STRING) AS station,
       CASE l_returnflag WHEN 'R' THEN 'PRCP' WHEN 'A' THEN 'TAVG' ELSE 'TMAX' END AS element,
       CAST(l_quantity AS INT) AS value, l_shipdate AS datetime,
       CAST(CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_linenumber * 1000 END AS DOUBLE) AS distance_from_station,
       'c' || CAST(l_suppkey AS STRING) AS adm,
       'NATION_' || CAST(l_suppkey % 25 AS STRING) AS adm4_name
FROM {lineitem}"""

STATIONS = f"""
SELECT id, 'POINT (' || longitude || ' ' || latitude || ')' AS geometry, name,
       'NATION_' || CAST(CAST(SUBSTR(id, 2) AS BIGINT) % 25 AS STRING) AS adm4_name
FROM ({SOURCE_STATIONS}) s"""

# a list of available files, one per order
MANIFEST = """
SELECT o_orderkey, 'FIRE_' || CAST(o_orderkey AS STRING) || '.v1.txt' AS name,
       CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 06:00:00' AS last_modified,
       CAST(o_orderkey * 100 AS STRING) AS mtime, '/files/' || CAST(o_orderkey AS STRING) AS "downloadsLink"
FROM {orders}"""


def oracle_text(view: str) -> str:
    """A view's SQL with the driver's own table names."""
    return view.format(**{name: name for name in TABLES})


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view's SQL as a frame over the Parquet files."""
    used = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES if "{" + name + "}" in text
    }
    return spark.sql(text.replace('"', "`"), **used)
