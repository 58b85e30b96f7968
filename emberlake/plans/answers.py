"""For each query the plain SQL that must give the same rows on the driver's tables.

Spatial answers compare every point with every edge and share no code with the tile join.
"""

from __future__ import annotations

from emberlake.plans import bindings as b

SQL: dict[str, str] = {}


def _view(text: str) -> str:
    return "(" + b.oracle_text(text) + ")"


AREAS, FIRES, WEATHER, STATIONS = (_view(v) for v in (b.SOURCE_AREAS, b.FIRES, b.WEATHER, b.STATIONS))
SOURCE_FIRES, SOURCE_WEATHER = _view(b.SOURCE_FIRES), _view(b.SOURCE_WEATHER)
SOURCE_STATIONS = _view(b.SOURCE_STATIONS)

# --- geometry --------------------------------------------------------------------------------------------


def _ring_list(rings: list) -> str:
    closed = [[*ring, ring[0]] for ring in rings]
    return "[" + ", ".join("[" + ", ".join(f"[{x}, {y}]" for x, y in ring) + "]" for ring in closed) + "]"


_CASES = " ".join(f"WHEN {n} THEN {_ring_list(rings)}" for n, rings in b.RINGS.items())
_BOX = _ring_list([b.BOX])

# corners lie on half hundredths: a box test on the corner box loses no candidate
GEOMETRY = f"""
boxes AS ({b.oracle_text(b.AREA_BOXES)}),
city_box AS (SELECT 'c' || k AS adm, x0 / 1000 AS bx0, y0 / 1000 AS by0, (x0 + 12 * u) / 1000 AS bx1,
                    (y0 + 12 * u) / 1000 AS by1 FROM boxes),
city_ring AS (SELECT 'c' || k AS adm, x0, y0, u, UNNEST(CASE k % 4 {_CASES} END) AS ring FROM boxes),
state_box AS (SELECT 'n' || k AS adm, x0, y0, u FROM ({b.oracle_text(b.STATE_BOXES)}) s),
state_ring AS (SELECT adm, x0, y0, u, {_BOX}[1] AS ring FROM state_box),
step AS (SELECT UNNEST(range(1, 8)) AS i),
city_edge AS (
  SELECT adm, CAST(x0 + u * ring[i][1] AS DOUBLE) / 1000 AS x1, CAST(y0 + u * ring[i][2] AS DOUBLE) / 1000 AS y1,
         CAST(x0 + u * ring[i + 1][1] AS DOUBLE) / 1000 AS x2, CAST(y0 + u * ring[i + 1][2] AS DOUBLE) / 1000 AS y2
  FROM city_ring JOIN step ON i < len(ring)),
state_edge AS (
  SELECT adm, CAST(x0 + u * ring[i][1] AS DOUBLE) / 1000 AS x1, CAST(y0 + u * ring[i][2] AS DOUBLE) / 1000 AS y1,
         CAST(x0 + u * ring[i + 1][1] AS DOUBLE) / 1000 AS x2, CAST(y0 + u * ring[i + 1][2] AS DOUBLE) / 1000 AS y2
  FROM state_ring JOIN step ON i < len(ring)),
spot AS (SELECT event_id, CAST(longitude AS DOUBLE) AS x, CAST(latitude AS DOUBLE) AS y FROM {SOURCE_FIRES} s),
inside AS (
  SELECT event_id, x, y, adm
  FROM spot JOIN city_box ON x BETWEEN bx0 AND bx1 AND y BETWEEN by0 AND by1 JOIN city_edge USING (adm)
  GROUP BY ALL
  HAVING SUM(CASE WHEN (y1 > y) <> (y2 > y) AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x THEN 1 ELSE 0 END) % 2 = 1),
named AS (
  SELECT 'c' || c_custkey AS adm, c_name AS adm_name, 'n' || n_nationkey AS adm4, n_name AS adm4_name,
         'r' || r_regionkey AS adm2, r_name AS adm2_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_METRES = "6378137.0 * radians({x})", "6378137.0 * ln(tan(pi() / 4 + radians({y}) / 2))"


def _mx(x: str) -> str:
    return _METRES[0].format(x=x)


def _my(y: str) -> str:
    return _METRES[1].format(y=y)


DISTANCE = f"""{GEOMETRY},
metre_edge AS (
  SELECT adm, {_mx('x1')} AS x1, {_my('y1')} AS y1, {_mx('x2')} AS x2, {_my('y2')} AS y2 FROM city_edge),
place AS (
  SELECT id, name, CAST(elevation AS DOUBLE) AS elevation, longitude, latitude,
         {_mx('CAST(longitude AS DOUBLE)')} AS x, {_my('CAST(latitude AS DOUBLE)')} AS y
  FROM {SOURCE_STATIONS} s),
along AS (
  SELECT id, adm, x, y, x1, y1, x2, y2,
         GREATEST(0, LEAST(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1))
                              / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t
  FROM place CROSS JOIN metre_edge),
apart AS (
  SELECT id, adm,
         CASE WHEN SUM(CASE WHEN (y1 > y) <> (y2 > y) AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x
                            THEN 1 ELSE 0 END) % 2 = 1 THEN 0.0
              ELSE MIN(SQRT(POW(x - x1 - t * (x2 - x1), 2) + POW(y - y1 - t * (y2 - y1), 2))) END AS distance
  FROM along GROUP BY id, adm),
near AS (SELECT * FROM apart WHERE distance <= 50000),
nearest AS (
  SELECT * FROM (SELECT *, CAST(RANK() OVER (PARTITION BY adm ORDER BY distance) AS INT) AS station_rank FROM near) r
  WHERE station_rank < 4),
linked AS (
  SELECT id, 'POINT (' || longitude || ' ' || latitude || ')' AS geometry, name,
         ROUND(CAST(CAST(elevation AS FLOAT) AS DOUBLE), 1) AS elevation,
         ROUND(CAST(CAST(distance AS FLOAT) AS DOUBLE), 1) AS distance,
         adm, adm_name, adm2, adm2_name, adm4, adm4_name
  FROM nearest JOIN place USING (id) JOIN named USING (adm))"""

SQL["points_in_areas"] = f"""
WITH {GEOMETRY}
SELECT event_id, x, y, adm, adm_name, adm2, adm2_name, adm4, adm4_name FROM inside JOIN named USING (adm)"""

SQL["points_in_states"] = f"""
WITH {GEOMETRY}
SELECT event_id, adm FROM spot CROSS JOIN state_edge GROUP BY event_id, adm
HAVING SUM(CASE WHEN (y1 > y) <> (y2 > y) AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x THEN 1 ELSE 0 END) % 2 = 1"""

_TIME = """CASE WHEN LENGTH(REPLACE(acq_time, ':', '')) = 4
       THEN TRY_STRPTIME(acq_date || ' ' || REPLACE(acq_time, ':', ''), '%Y-%m-%d %H%M') END"""


def _short(column: str, alias: str) -> str:
    return f"ROUND(CAST(TRY_CAST({column} AS FLOAT) AS DOUBLE), 2) AS {alias}"


_FIRE_VALUES = ", ".join(
    _short(c, a)
    for c, a in (
        ("brightness", "bright_ti4"), ("bright_t31", "bright_ti5"), ("frp", "frp"), ("scan", "scan"), ("track", "track"),
    )
)
CLEAN_FIRES = f"""
SELECT event_id, CAST(longitude AS DOUBLE) AS x, CAST(latitude AS DOUBLE) AS y, {_FIRE_VALUES}, confidence,
       {_TIME} AS datetime, CAST(SUBSTR(acq_date, 1, 4) AS INT) AS year, CAST(MONTH({_TIME}) AS INT) AS month
FROM {SOURCE_FIRES} s"""

SQL["fires_table"] = f"""
WITH {GEOMETRY}, cleaned AS ({CLEAN_FIRES})
SELECT 'POINT (' || c.x || ' ' || c.y || ')' AS geometry, bright_ti4, bright_ti5, frp, scan, track, confidence,
       datetime, year, month, adm, adm_name, adm2, adm2_name, adm4, adm4_name
FROM cleaned c JOIN inside USING (event_id) JOIN named USING (adm)"""

SQL["areas_within_distance"] = f"WITH {DISTANCE} SELECT id, adm, ROUND(distance, 3) AS distance FROM near"
SQL["nearest_k_stations"] = (
    f"WITH {DISTANCE} SELECT id, adm, ROUND(distance, 3) AS distance, station_rank FROM nearest"
)
SQL["stations_table"] = f"WITH {DISTANCE} SELECT * FROM linked"

SQL["nearest_k_of_tied_stations"] = f"""
WITH {GEOMETRY},
metre_edge AS (
  SELECT adm, {_mx('x1')} AS x1, {_my('y1')} AS y1, {_mx('x2')} AS x2, {_my('y2')} AS y2 FROM city_edge),
metre_box AS (SELECT adm, MIN(LEAST(x1, x2)) AS bx0, MIN(LEAST(y1, y2)) AS by0, MAX(GREATEST(x1, x2)) AS bx1,
                     MAX(GREATEST(y1, y2)) AS by1 FROM metre_edge GROUP BY adm),
place AS (SELECT id, {_mx('CAST(longitude AS DOUBLE)')} AS x, {_my('CAST(latitude AS DOUBLE)')} AS y
          FROM {_view(b.TIED_STATIONS)} s),
along AS (
  SELECT id, adm, x, y, x1, y1, x2, y2,
         GREATEST(0, LEAST(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1))
                              / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t
  FROM place JOIN metre_box ON x BETWEEN bx0 - 50001 AND bx1 + 50001 AND y BETWEEN by0 - 50001 AND by1 + 50001
  JOIN metre_edge USING (adm)),
apart AS (
  SELECT id, adm,
         CASE WHEN SUM(CASE WHEN (y1 > y) <> (y2 > y) AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x
                            THEN 1 ELSE 0 END) % 2 = 1 THEN 0.0
              ELSE MIN(SQRT(POW(x - x1 - t * (x2 - x1), 2) + POW(y - y1 - t * (y2 - y1), 2))) END AS distance
  FROM along GROUP BY id, adm)
SELECT id, adm, ROUND(distance, 3) AS distance, station_rank
FROM (SELECT *, CAST(RANK() OVER (PARTITION BY adm ORDER BY distance) AS INT) AS station_rank
      FROM apart WHERE distance <= 50000) r
WHERE station_rank < 4"""

_FAULT = " ".join(f"WHEN {n} THEN '{fault}'" for n, fault in b.FAULTS.items())
SQL["shape_rejects"] = f"""
SELECT 'c' || c_custkey AS id, 8 AS adm, CASE c_custkey % 8 {_FAULT} END AS fault FROM customer WHERE c_custkey % 8 <> 0"""
SQL["points_in_readable_areas"] = f"""
WITH {GEOMETRY}
SELECT event_id, adm FROM spot JOIN city_box ON x BETWEEN bx0 AND bx1 AND y BETWEEN by0 AND by1
WHERE CAST(SUBSTR(adm, 2) AS BIGINT) % 8 = 0"""

CLEAN_WEATHER = f"""
SELECT station, element, measurement_flag, quality_flag, source_flag, CAST(value AS INT) AS value, datetime,
       CAST(YEAR(datetime) AS INT) AS year, CAST(MONTH(datetime) AS INT) AS month
FROM (SELECT *, CASE WHEN COALESCE(obs_time, '0000') <> '2400'
                     THEN STRPTIME(date || COALESCE(obs_time, '0000'), '%Y%m%d%H%M') END AS datetime
      FROM {SOURCE_WEATHER} s) t"""

SQL["weather_by_area"] = f"""
WITH {DISTANCE}, reading AS ({CLEAN_WEATHER})
SELECT reading.*, linked.distance AS distance_from_station, adm, adm_name, adm2, adm2_name, adm4, adm4_name
FROM reading JOIN linked ON station = id"""

SQL["distance_to_home_state"] = f"""
WITH {GEOMETRY},
metre AS (SELECT adm, {_mx('x1')} AS x1, {_my('y1')} AS y1, {_mx('x2')} AS x2, {_my('y2')} AS y2 FROM state_edge),
corner AS (SELECT 'c' || k AS id, {_mx('CAST(x0 AS DOUBLE) / 1000')} AS x, {_my('CAST(y0 AS DOUBLE) / 1000')} AS y FROM boxes),
pair AS (
  SELECT corner.id, named.adm4, x, y, x1, y1, x2, y2,
         GREATEST(0, LEAST(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1))
                              / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t
  FROM corner JOIN named ON named.adm = corner.id JOIN metre ON metre.adm = named.adm4),
box AS (SELECT adm AS adm4, {_mx('x0 / 1000')} AS bx0, {_my('y0 / 1000')} AS by0, {_mx('(x0 + 12 * u) / 1000')} AS bx1,
               {_my('(y0 + 12 * u) / 1000')} AS by1 FROM state_box)
SELECT id, adm4,
       ROUND(CASE WHEN MAX(x) BETWEEN MAX(bx0) AND MAX(bx1) AND MAX(y) BETWEEN MAX(by0) AND MAX(by1) THEN 0.0
                  ELSE MIN(SQRT(POW(x - x1 - t * (x2 - x1), 2) + POW(y - y1 - t * (y2 - y1), 2))) END, 3) AS distance
FROM pair JOIN box USING (adm4) GROUP BY id, adm4"""

SQL["area_vertices"] = f"""
WITH {GEOMETRY},
region_ring AS (SELECT 'r' || k AS adm, x0, y0, u, {_BOX}[1] AS ring FROM ({b.oracle_text(b.COUNTRY_BOXES)}) c),
ring AS (
  SELECT 8 AS level, adm, x0, y0, u, ring FROM city_ring
  UNION ALL SELECT 4, adm, x0, y0, u, ring FROM state_ring
  UNION ALL SELECT 2, adm, x0, y0, u, ring FROM region_ring),
corner AS (SELECT level, adm, x0, y0, u, UNNEST(ring) AS c FROM ring),
per_ring AS (SELECT level, adm, COUNT(*) AS rings, SUM(len(ring)) AS corners FROM ring GROUP BY level, adm)
SELECT level AS adm, adm AS id, CAST(ANY_VALUE(rings) AS INT) AS rings, CAST(ANY_VALUE(corners) AS INT) AS corners,
       MIN(CAST(x0 + u * c[1] AS DOUBLE) / 1000) AS min_x, MAX(CAST(x0 + u * c[1] AS DOUBLE) / 1000) AS max_x,
       MIN(CAST(y0 + u * c[2] AS DOUBLE) / 1000) AS min_y, MAX(CAST(y0 + u * c[2] AS DOUBLE) / 1000) AS max_y
FROM corner JOIN per_ring USING (level, adm) GROUP BY level, adm"""

SQL["point_text"] = f"""
SELECT event_id, 'POINT (' || longitude || ' ' || latitude || ')' AS geometry,
       'POINT (' || latitude || ' ' || longitude || ')' AS flipped FROM {SOURCE_FIRES} s"""

SQL["project_points"] = f"""
SELECT event_id, ROUND({_mx('CAST(longitude AS DOUBLE)')}, 3) AS mx, ROUND({_my('CAST(latitude AS DOUBLE)')}, 3) AS my,
       ROUND(CAST(longitude AS DOUBLE), 6) AS lon, ROUND(CAST(latitude AS DOUBLE), 6) AS lat FROM {SOURCE_FIRES} s"""

SQL["sql_areas_at_points"] = f"WITH {GEOMETRY} SELECT event_id, adm FROM inside"
SQL["sql_geometry"] = f"""
WITH {GEOMETRY},
corner AS (SELECT 'c' || k AS id, x0 / 1000 AS x, y0 / 1000 AS y FROM boxes),
box AS (SELECT adm AS adm4, x0 / 1000 AS bx0, y0 / 1000 AS by0, (x0 + 12 * u) / 1000 AS bx1, (y0 + 12 * u) / 1000 AS by1
        FROM state_box)
SELECT id, adm4, 'POINT (' || CAST(y AS DOUBLE) || ' ' || CAST(x AS DOUBLE) || ')' AS flipped,
       x BETWEEN bx0 AND bx1 AND y BETWEEN by0 AND by1 AS inside,
       ROUND(SQRT(POW(GREATEST(bx0 - x, x - bx1, 0), 2) + POW(GREATEST(by0 - y, y - by1, 0), 2)), 6) AS distance
FROM corner JOIN named ON named.adm = corner.id JOIN box USING (adm4)"""
SQL["point_extent"] = f"""
SELECT MIN(CAST(longitude AS DOUBLE)) AS min_x, MAX(CAST(longitude AS DOUBLE)) AS max_x,
       MIN(CAST(latitude AS DOUBLE)) AS min_y, MAX(CAST(latitude AS DOUBLE)) AS max_y, COUNT(*) AS points
FROM {SOURCE_FIRES} s"""

# --- hierarchy -------------------------------------------------------------------------------------------

_NAMED = """
SELECT 'c' || c_custkey AS id, c_name AS name, 'n' || n_nationkey AS adm4, n_name AS adm4_name,
       'r' || r_regionkey AS adm2, r_name AS adm2_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

SQL["hierarchy_links"] = f"""
WITH area AS {AREAS},
child AS (SELECT admin_level AS adm, osm_id AS id, name, UNNEST(COALESCE(string_split(parents, ','), [NULL])) AS parent_id FROM area)
SELECT adm, id, child.name, parent_id, area.admin_level AS parent_level, area.name AS parent_name
FROM child LEFT JOIN area ON parent_id = osm_id"""

RELATIONS = f"""
SELECT 8 AS adm, id, name, adm2, adm2_name, adm4, adm4_name FROM ({_NAMED}) n
UNION ALL
SELECT 4, 'n' || n_nationkey, n_name, 'r' || r_regionkey, r_name, NULL, NULL
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 2, 'r' || r_regionkey, r_name, NULL, NULL, NULL, NULL FROM region"""
SQL["hierarchy_pivot"] = RELATIONS

SHAPES = f"SELECT REPLACE(geom, 'SRID=4326;', '') AS geometry, admin_level AS adm, osm_id AS id FROM {AREAS} a"
SQL["shapes_clean"] = SHAPES
SQL["landed_shapes"] = f"SELECT osm_id, admin_level, name, parents, geom FROM {AREAS} a"
SQL["static_overwrite_by_level"] = f"SELECT geometry, id FROM ({SHAPES}) s WHERE adm = 8"

# --- cleaning --------------------------------------------------------------------------------------------

SQL["fire_clean"] = f"SELECT * EXCLUDE (event_id) FROM ({CLEAN_FIRES}) c"
SQL["fire_rejects"] = f"""
SELECT COUNT(*) FILTER (WHERE x IS NULL OR y IS NULL) AS without_position,
       COUNT(*) FILTER (WHERE datetime IS NULL) AS without_time FROM ({CLEAN_FIRES}) c"""
SQL["weather_clean"] = CLEAN_WEATHER
SQL["fixed_width_parse"] = f"""
SELECT id, name, CAST(SUBSTR(elevation, 1, 6) AS DOUBLE) AS elevation, CAST(longitude AS DOUBLE) AS x,
       CAST(latitude AS DOUBLE) AS y FROM {SOURCE_STATIONS} s"""
SQL["landed_stations"] = f"SELECT id, latitude, longitude, 'XX' AS state, name, '00000' AS wmo_id FROM {SOURCE_STATIONS} s"
SQL["file_names"] = r"""
SELECT page_id, base_name, regexp_replace(base_name, '(\.*[^./][^/]*)\.[^./]*$', '\1') AS stem
FROM (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS base_name FROM pages) p"""

# --- calendar --------------------------------------------------------------------------------------------

SQL["calendar_spine"] = f"""
WITH fire AS (SELECT CAST(datetime AS DATE) AS date, COUNT(*) AS n FROM {FIRES} f GROUP BY ALL),
spine AS (SELECT CAST(UNNEST(generate_series(MIN(date)::TIMESTAMP, MAX(date)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM fire)
SELECT date, strftime(date, '%m-%W') AS week, strftime(date, '%b') AS month_name, COALESCE(n, 0) AS fire_spots
FROM spine LEFT JOIN fire USING (date)"""


def _weekly(element: str, value: str) -> str:
    return f"""
WITH reading AS (
  SELECT adm, CAST(YEAR(datetime) AS INT) AS year, strftime(datetime, '%m-%W') AS week, value
  FROM {WEATHER} w WHERE distance_from_station = 0 AND element = '{element}'),
weeks AS (
  SELECT DISTINCT strftime(generate_series, '%m-%W') AS week
  FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-12-31', INTERVAL 7 DAYS)),
spine AS (SELECT * FROM (SELECT DISTINCT adm, year FROM reading) k CROSS JOIN weeks)
SELECT spine.adm, spine.year, spine.week, COUNT(reading.week) AS days_recorded, {value} AS agg_value
FROM spine LEFT JOIN reading ON spine.adm = reading.adm AND spine.year = reading.year AND spine.week = reading.week
GROUP BY spine.adm, spine.year, spine.week"""


SQL["weekly_sum_on_spine"] = _weekly("PRCP", "CAST(SUM(value) AS BIGINT)")
SQL["weekly_avg_on_spine"] = _weekly("TAVG", "ROUND(AVG(value), 6)")


def _every_week(element: str, value: str) -> str:
    return f"""
WITH reading AS (
  SELECT adm, CAST(YEAR(datetime) AS INT) AS year, strftime(datetime, '%m-%W') AS week, value FROM {WEATHER} w
  WHERE distance_from_station = 0 AND element = '{element}' AND datetime IS NOT NULL),
label AS (
  SELECT DISTINCT year, strftime(UNNEST(generate_series(make_date(year, 1, 1)::TIMESTAMP, make_date(year, 12, 31)::TIMESTAMP,
                                                        INTERVAL 1 DAY)), '%m-%W') AS week
  FROM (SELECT DISTINCT year FROM reading))
SELECT k.adm, k.year, label.week, COUNT(reading.week) AS days_recorded, {value} AS agg_value
FROM (SELECT DISTINCT adm, year FROM reading) k JOIN label USING (year)
LEFT JOIN reading ON reading.adm = k.adm AND reading.year = k.year AND reading.week = label.week
GROUP BY k.adm, k.year, label.week"""


SQL["weekly_sum"] = _every_week("PRCP", "CAST(SUM(value) AS BIGINT)")
SQL["weekly_avg"] = _every_week("TAVG", "ROUND(AVG(value), 6)")
SQL["readings_without_time"] = f"""
SELECT COUNT(*) AS rows, COUNT(*) FILTER (datetime IS NULL) AS without_time FROM {WEATHER} w"""

_WINDOWS = (15, 30, 60, 90, 120, 150)
ROLLING = f"""
rain AS (
  SELECT adm, CAST(datetime AS DATE) AS date, value FROM {WEATHER} w
  WHERE distance_from_station = 0 AND element = 'PRCP'),
city_year AS (SELECT DISTINCT adm, CAST(YEAR(date) AS INT) AS year FROM rain),
day AS (
  SELECT adm, year, CAST(UNNEST(generate_series(make_timestamp(year - 1, 11, 1, 0, 0, 0), make_timestamp(year, 12, 31, 0, 0, 0),
                                                INTERVAL 1 DAY)) AS DATE) AS date FROM city_year),
rolled AS (
  SELECT day.adm, day.year, day.date, {", ".join(
      f"SUM(value) OVER (PARTITION BY day.adm, day.year ORDER BY day.date RANGE INTERVAL {n} DAYS PRECEDING) AS s{n}"
      for n in _WINDOWS)}
  FROM day LEFT JOIN rain ON rain.adm = day.adm AND rain.date = day.date),
weekly_rain AS (
  SELECT adm, year, strftime(date, '%m-%W') AS week, {", ".join(f"CAST(MAX(s{n}) AS BIGINT) AS sum_w{n}" for n in _WINDOWS)}
  FROM rolled WHERE YEAR(date) = year GROUP BY ALL),
weekly_fire AS (
  SELECT adm, CAST(YEAR(datetime) AS INT) AS year, strftime(datetime, '%m-%W') AS week, COUNT(*) AS fire_spots
  FROM {FIRES} f GROUP BY ALL),
both_weekly AS (
  SELECT weekly_rain.*, COALESCE(fire_spots, 0) AS fire_spots
  FROM weekly_rain LEFT JOIN weekly_fire USING (adm, year, week))"""

SQL["rolling_sums_weekly_max"] = f"WITH {ROLLING} SELECT * FROM weekly_rain"
SQL["rolling_revenue"] = f"""
WITH sold AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price FROM lineitem),
day AS (SELECT l_suppkey, CAST(UNNEST(generate_series(MIN(date)::TIMESTAMP, MAX(date)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date
        FROM sold GROUP BY l_suppkey),
daily AS (SELECT l_suppkey, date, SUM(price) AS price FROM sold GROUP BY ALL)
SELECT l_suppkey, date, {", ".join(
    f"CAST(SUM(price) OVER (PARTITION BY l_suppkey ORDER BY date RANGE INTERVAL {n} DAYS PRECEDING) AS DOUBLE) AS sum_w{n}"
    for n in _WINDOWS)}
FROM day LEFT JOIN daily USING (l_suppkey, date)"""
SQL["weekly_counts"] = f"WITH {ROLLING} SELECT * FROM weekly_fire"
SQL["weekly_joined"] = f"WITH {ROLLING} SELECT * FROM both_weekly"
SQL["rolling_correlation"] = f"""
WITH {ROLLING}
SELECT adm, year, {", ".join(
    f"CASE WHEN isnan(CORR(sum_w{n}, fire_spots)) THEN NULL ELSE ROUND(CORR(sum_w{n}, fire_spots), 6) END AS w{n}_correlation"
    for n in _WINDOWS)}
FROM both_weekly GROUP BY adm, year"""

# --- fires by month and area ------------------------------------------------------------------------------

_DATED = f"""(SELECT *, CAST(YEAR(datetime) AS INT) AS year, CAST(MONTH(datetime) AS INT) AS month,
              strftime(datetime, '%b') AS month_name FROM {FIRES} f) d"""

SQL["monthly_counts"] = f"""
SELECT adm4_name, year, month, COUNT(*) AS fire_spots, ANY_VALUE(month_name) AS month_name
FROM {_DATED} GROUP BY adm4_name, year, month"""

REGION_MONTH = f"""
SELECT adm4_name, CASE WHEN adm7_name IS NOT NULL THEN adm7_name ELSE adm6_name END AS region, year,
       COUNT(*) AS fire_spots, ANY_VALUE(month_name) AS month_name, month
FROM {_DATED} GROUP BY adm4_name, adm7_name, adm6_name, year, month"""
SQL["region_month_counts"] = REGION_MONTH

_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
SQL["region_month_pivot"] = f"""
SELECT adm4_name, year, region, {", ".join(
    f'COALESCE(ROUND(AVG(fire_spots) FILTER (WHERE month = {n}), 6), 0) AS "{name}"' for n, name in enumerate(_NAMES, 1))}
FROM ({REGION_MONTH}) c GROUP BY adm4_name, year, region"""

_CITIES = f"(SELECT geometry, id FROM ({SHAPES}) s WHERE adm = 8)"
_HOMES = f"({_NAMED})"

SQL["area_month_counts_zero_filled"] = f"""
WITH counted AS (SELECT adm, year, month, COUNT(*) AS n FROM {_DATED} GROUP BY adm, year, month),
slot AS (SELECT y.range AS year, m.range AS month FROM range(1995, 2002) y CROSS JOIN range(1, 13) m)
SELECT h.id, h.adm4_name, CAST(slot.year AS INT) AS year, CAST(slot.month AS INT) AS month, COALESCE(n, 0) AS fire_spots, geometry
FROM {_CITIES} c JOIN {_HOMES} h ON h.id = c.id CROSS JOIN slot
LEFT JOIN counted ON counted.adm = h.id AND counted.year = slot.year AND counted.month = slot.month"""

SQL["shapes_of_parent"] = f"SELECT h.id, geometry, adm4_name FROM {_CITIES} c JOIN {_HOMES} h ON h.id = c.id"
SQL["points_of_parent"] = f"SELECT adm4_name, year, month, geometry FROM {_DATED}"
SQL["points_of_one_parent_and_month"] = f"""
SELECT adm4_name, year, month, geometry FROM {_DATED} WHERE adm4_name = 'NATION_7' AND year = 1997 AND month = 8"""
SQL["stations_of_parent"] = f"SELECT adm4_name, geometry, id FROM {STATIONS} s"
SQL["stations_with_data"] = f"""
SELECT station, MIN(s.geometry) AS geometry FROM {WEATHER} w JOIN {STATIONS} s ON w.station = s.id
WHERE YEAR(datetime) BETWEEN 1995 AND 2001 GROUP BY station"""
SQL["shapes_of_one_name"] = f"""
SELECT h.id, geometry, name FROM {_CITIES} c JOIN {_HOMES} h ON h.id = c.id WHERE name = 'Customer#000000007'"""
SQL["shape_by_name"] = f"SELECT h.id, geometry, name FROM {_CITIES} c JOIN {_HOMES} h ON h.id = c.id"

# --- quality ---------------------------------------------------------------------------------------------

SQL["missing_years"] = f"""
SELECT CAST(wanted.year AS INT) AS year FROM (SELECT DISTINCT year FROM {_DATED}) present
RIGHT JOIN (SELECT UNNEST(range(1990, 2011)) AS year) wanted ON present.year = wanted.year WHERE present.year IS NULL"""
SQL["recent_rows"] = f"""
SELECT CAST(datetime AS DATE) AS day, COUNT(*) AS fire_spots FROM {FIRES} f
WHERE CAST(datetime AS DATE) BETWEEN DATE '2001-07-25' AND DATE '2001-08-01' GROUP BY ALL"""


def _check(name: str, value: str, expected: int) -> str:
    return f"""SELECT '{name}' AS "check", CAST({value} AS INT) AS value, {expected} AS expected,
       CAST({value} AS INT) = {expected} AS passed"""


def _any(source: str, where: str) -> str:
    return f"(SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END FROM {source} t WHERE {where})"


def _absent(source: str, first: int, last: int) -> str:
    return f"""(SELECT COUNT(*) FROM range({first}, {last + 1}) y
                WHERE y.range NOT IN (SELECT YEAR(datetime) FROM {source} t))"""


SQL["quality_checks"] = " UNION ALL ".join(
    [
        _check("fires within 3 days", _any(FIRES, "CAST(datetime AS DATE) >= DATE '2001-07-30'"), 1),
        _check("fires within 2 days", _any(FIRES, "CAST(datetime AS DATE) >= DATE '2001-07-31'"), 1),
        _check("fires within 3 days, stale", _any(FIRES, "CAST(datetime AS DATE) >= DATE '2004-12-29'"), 1),
        _check("weather within 7 days", _any(WEATHER, "CAST(datetime AS DATE) >= DATE '2001-10-30'"), 1),
        _check("fires cover the years", _absent(FIRES, 1995, 2001), 0),
        _check("fires cover more years", _absent(FIRES, 1995, 2004), 0),
        _check("weather covers the years", _absent(WEATHER, 1995, 2001), 0),
        _check("countries present", _any(AREAS, "admin_level = 2"), 1),
        _check("stations present", _any(STATIONS, "TRUE"), 1),
        _check("weather in the year", _any(WEATHER, "YEAR(datetime) = 2001"), 1),
        _check("fires in the year", _any(FIRES, "YEAR(datetime) = 2001"), 1),
    ]
)

# --- files -----------------------------------------------------------------------------------------------

SQL["manifest_pick"] = f"""
WITH listed AS (
  SELECT *, SUBSTR(last_modified, 1, 10) AS date,
         ROW_NUMBER() OVER (PARTITION BY SUBSTR(last_modified, 1, 10) ORDER BY o_orderkey) AS n
  FROM {_view(b.MANIFEST)} m)
SELECT date, 'FIRE_' || o_orderkey || '.v1' AS filename, "downloadsLink" AS link, mtime, last_modified FROM listed WHERE n = 1"""
SQL["zip_members"] = f"""
SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS member, event_id, longitude, latitude
FROM {SOURCE_FIRES} s"""
SQL["landed_fires"] = f"""
SELECT longitude, latitude, brightness AS bright_ti4, bright_t31 AS bright_ti5, confidence, acq_date, acq_time
FROM {SOURCE_FIRES} s"""
SQL["landed_fires_in_one_folder"] = SQL["landed_fires"]
SQL["landed_members"] = f"""
SELECT 'third-' || (event_id % 3) AS member, event_id, longitude, latitude FROM {SOURCE_FIRES} s"""
SQL["landed_weather"] = f"SELECT * FROM {SOURCE_WEATHER} s"
SQL["dynamic_overwrite_roundtrip"] = f"""
SELECT fire_id, adm, CASE WHEN year = 1997 THEN 1 ELSE 0 END AS load, year, month FROM {_DATED}"""
SQL["merged_half_months"] = f"""
SELECT fire_id, adm, CAST(DAY(datetime) AS INT) AS day, CASE WHEN DAY(datetime) >= 16 AND year > 1995 THEN 1 ELSE 0 END AS load, year, month
FROM {_DATED} WHERE DAY(datetime) < 16 OR year > 1995 OR fire_id % 3 = 0"""
SQL["named_tables"] = f"""
SELECT s.adm4_name, element, COUNT(*) AS readings, CAST(SUM(value) AS BIGINT) AS total
FROM {WEATHER} w JOIN {STATIONS} s ON station = id GROUP BY s.adm4_name, element"""
SQL["pruned_partitions"] = f"""
SELECT station, value, CAST(MONTH(datetime) AS INT) AS month, adm FROM {WEATHER} w
WHERE element = 'PRCP' AND YEAR(datetime) = 1997 AND distance_from_station = 0"""
SQL["daily_run"] = f"""
WITH {GEOMETRY}, cleaned AS ({CLEAN_FIRES})
SELECT year, month, adm4_name, COUNT(*) AS fire_spots
FROM cleaned c JOIN inside USING (event_id) JOIN named USING (adm) GROUP BY year, month, adm4_name"""

_RUN_FIRES = f"""
SELECT event_id, folder, {_TIME} AS datetime, TRY_CAST(SUBSTR(acq_date, 1, 4) AS INT) AS year,
       CAST(MONTH({_TIME}) AS INT) AS month FROM {_view(b.RUN_FIRES)} r"""


def _seen(kind: str, source: str, since: str) -> str:
    return f"(SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END FROM {source} WHERE CAST(datetime AS DATE) >= DATE '{since}')"


def _without(source: str) -> str:
    return f"(SELECT 2 - COUNT(DISTINCT year) FROM {source} WHERE year IN (2000, 2001))"


_RUN_CHECKS = [
    ("fires cover the years", _without("fire"), 0),
    ("weather cover the years", _without("rain"), 0),
    ("fires are recent", _seen("fires", "fire", "2001-11-02"), 1),
    ("weather is recent", _seen("weather", "rain", "2001-10-29"), 1),
    ("fires are recent", _seen("fires", "fire", "2002-02-26"), 1),
    ("weather is recent", _seen("weather", "rain", "2002-02-22"), 1),
]
SQL["daily_checks"] = f"""
WITH {DISTANCE}, fire AS (SELECT * FROM ({_RUN_FIRES}) f JOIN inside USING (event_id) WHERE folder >= 2000),
rain AS (SELECT r.* FROM ({CLEAN_WEATHER}) r JOIN linked ON station = id WHERE datetime >= '2000-01-01')
""" + " UNION ALL ".join(
    f"SELECT {n} AS number, c.* FROM ({_check(*check)}) c" for n, check in enumerate(_RUN_CHECKS)
)
SQL["weather_rebuild"] = f"""
WITH {DISTANCE}
SELECT element, year, month, adm, COUNT(*) AS readings, CAST(SUM(value) AS BIGINT) AS total
FROM ({CLEAN_WEATHER}) r JOIN linked ON station = id GROUP BY ALL"""
SQL["catch_up_runs"] = f"""
WITH fire AS (SELECT folder, event_id % 5 = 0 AND folder = 1996 AS extra FROM {_view(b.RUN_FIRES)} r),
rain AS (SELECT DISTINCT CAST(SUBSTR(date, 1, 4) AS INT) AS folder FROM {SOURCE_WEATHER} s)
SELECT DISTINCT CASE WHEN folder <= 1998 AND NOT extra THEN 1 ELSE 3 END AS run, 'fires' AS kind, folder AS year FROM fire
UNION ALL SELECT CASE WHEN folder <= 1998 THEN 1 ELSE 3 END, 'weather', folder FROM rain"""
SQL["caught_up_fires"] = f"""
WITH {GEOMETRY}
SELECT year, month, adm, COUNT(*) AS fire_spots, COUNT(datetime) AS with_time
FROM ({_RUN_FIRES}) f JOIN inside USING (event_id) GROUP BY ALL"""
