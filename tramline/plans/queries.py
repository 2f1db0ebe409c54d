"""A query for every operator, over tables derived from the driver's data, and the SQL that checks it."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.functions import dates, geo, routes
from tramline.functions.storage import run_folder, stored
from tramline.operators import calendar, combine, exports, feed_graph, point_reduce, reach, spatial, stops
from tramline.operators.components import components
from tramline.operators.feed_graph import FeedGraph
from tramline.plans.views import frame, tables, view, with_views
from tramline.sources import graphs, gtfs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers the function under its name, with the checking SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_views(sql)
        return f

    return add


def text(array: Column | str) -> Column:
    """An array as text, the same in every engine."""
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


def graph(spark: SparkSession, d: str) -> FeedGraph:
    return feed_graph.build_feed_graph(tables(spark, d))


def patterns(spark: SparkSession, d: str) -> DataFrame:
    """Journeys before compaction: stops carry their number among the valid stops."""
    t = tables(spark, d)
    numbered = feed_graph.number(feed_graph.valid_stops(t["stops"]), "number").select("feed_id", "stop_id", "number")
    line = feed_graph.lines(t["routes"]).select("feed_id", "route_id", "line_id")
    days = calendar.service_weekdays(calendar.joined_calendar_dates(t["calendar"], t["calendar_dates"]))
    return feed_graph.journey_patterns(t["stop_times"], t["trips"], line, days, numbered)


def located(spark: SparkSession, d: str) -> DataFrame:
    """Valid stops by number: (feed_id, stop_id, name, lat, lon)."""
    return feed_graph.number(feed_graph.valid_stops(tables(spark, d)["stops"]), "number").select("feed_id", F.col("number").alias("stop_id"), "name", "lat", "lon")


def whole(spark: SparkSession, d: str) -> FeedGraph:
    """One graph of all feeds; journeys have an id that follows from their content."""
    g = combine.combine(FeedGraph(located(spark, d), feed_graph.lines(tables(spark, d)["routes"]), patterns(spark, d)))
    g = FeedGraph(*(stored(df) for df in g))
    return g._replace(journeys=g.journeys.withColumn("journey_id", F.concat_ws("|", F.col("line_id").cast("string"), text("stops"), text("times_within_day"))))


# --- scalar functions


@query("""SELECT k, CASE WHEN s IS NULL OR try_cast(s AS BIGINT) > 20991231 THEN DATE '2099-12-31' WHEN regexp_full_match(s, '\\d{8}') THEN CAST(try_strptime(s, '%Y%m%d') AS DATE) END AS with_default,
 CASE WHEN s IS NULL OR try_cast(s AS BIGINT) > 20991231 THEN NULL WHEN regexp_full_match(s, '\\d{8}') THEN CAST(try_strptime(s, '%Y%m%d') AS DATE) END AS without
 FROM (SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '20240230' WHEN 2 THEN '99991231' WHEN 3 THEN 'soon' ELSE strftime(o_orderdate, '%Y%m%d') END AS s FROM orders) x""")
def c01_parse_date(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 7
    s = F.when(k == 0, None).when(k == 1, "20240230").when(k == 2, "99991231").when(k == 3, "soon").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    df = frame(spark, d, "orders").select(F.col("o_orderkey").alias("k"), s.alias("s"))
    return df.select("k", dates.parse_date(F.col("s"), F.lit("2099-12-31").cast("date")).alias("with_default"), dates.parse_date(F.col("s")).alias("without"))


@query("""SELECT row_idx, CAST(CASE WHEN row_idx % 11 <> 0 THEN CAST(substr(arrival_time,1,2) AS INT)*60 + CAST(substr(arrival_time,4,2) AS INT) END AS INT) AS minute FROM g_stop_times""")
def c02_time_minutes(spark: SparkSession, d: str) -> DataFrame:
    s = F.when(F.col("row_idx") % 11 == 0, F.concat("arrival_time", F.lit(":00"))).otherwise(F.concat(F.lit(" "), "arrival_time"))
    return view(spark, d, "g_stop_times").select("row_idx", dates.time_to_minutes_from_midnight(s).alias("minute"))


@query("SELECT feed_id, trip_id, stop_id, row_idx, minute FROM v_st")
def c04_mean_minute(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.timed_stops(tables(spark, d)["stop_times"]).select("feed_id", "trip_id", "stop_id", "row_idx", "minute")


@query("SELECT o_orderkey AS k, CAST((isodow(o_orderdate) - 1) * 1440 + o_custkey % 1440 AS BIGINT) AS week_minute FROM orders")
def c05_week_minutes(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "orders").select(F.col("o_orderkey").alias("k"), dates.minutes_from_week_start(F.weekday("o_orderdate"), F.col("o_custkey") % 1440).cast("long").alias("week_minute"))


ZONES = ["Europe/Berlin", "America/New_York", "Asia/Tokyo", "no such zone"]


@query("""SELECT k, CAST(((isodow(u) - 1) * 1440 + hour(u) * 60 + minute(u)) AS INT) AS week_minute FROM (SELECT o_orderkey AS k, timezone('UTC', timezone(
 CASE o_orderkey % 4 WHEN 0 THEN 'Europe/Berlin' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo' ELSE 'UTC' END, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_minutes(CAST(480 + o_custkey % 900 + o_custkey % 2 * 1440 AS INT)))) AS u FROM orders) x""")
def c06_utc_week_minutes(spark: SparkSession, d: str) -> DataFrame:
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return frame(spark, d, "orders").select(F.col("o_orderkey").alias("k"), dates.local_minutes_to_week_minutes_utc(F.to_date("o_orderdate"), 480 + F.col("o_custkey") % 900 + F.col("o_custkey") % 2 * 1440, zone).alias("week_minute"))


HAVERSINE = "sqrt(power(sin(radians({b}.stop_lat - {a}.stop_lat) / 2), 2) + cos(radians({a}.stop_lat)) * cos(radians({b}.stop_lat)) * power(sin(radians({b}.stop_lon - {a}.stop_lon) / 2), 2))"
DISTANCE = f"2 * 6371009.0e0 * asin(least(1.0e0, {HAVERSINE.format(a='a', b='b')}))"
DISTANCE_RS = f"2 * 6371.0e0 * atan2({HAVERSINE.format(a='a', b='b')}, sqrt(1 - power({HAVERSINE.format(a='a', b='b')}, 2)))"


def _same_name(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of equally named stops; the names repeat a bounded number of times in these tables."""
    s = view(spark, d, "g_stops")
    a, b = (s.select(*[F.col(c).alias(f"{p}_{c}") for c in ("feed_id", "stop_id", "stop_name", "stop_lat", "stop_lon", "row_idx")]) for p in "ab")
    return a.join(b, (F.col("a_feed_id") == F.col("b_feed_id")) & (F.col("a_stop_name") == F.col("b_stop_name")) & (F.col("a_row_idx") < F.col("b_row_idx")))


ENDS = ("a_stop_lat", "a_stop_lon", "b_stop_lat", "b_stop_lon")


@query(f"SELECT a.feed_id, a.stop_id AS a, b.stop_id AS b, round({DISTANCE}, 4) AS m, round({DISTANCE} / 1000, 7) AS km FROM g_stops a JOIN g_stops b ON a.feed_id = b.feed_id AND a.row_idx < b.row_idx AND a.stop_name = b.stop_name")
def c08_haversine(spark: SparkSession, d: str) -> DataFrame:
    at = [F.col(c) for c in ENDS]
    return _same_name(spark, d).select(F.col("a_feed_id").alias("feed_id"), F.col("a_stop_id").alias("a"), F.col("b_stop_id").alias("b"), F.round(geo.haversine_m(*at), 4).alias("m"), F.round(geo.haversine_km(*at), 7).alias("km"))


@query(f"SELECT a.feed_id, a.stop_id AS a, b.stop_id AS b, round({DISTANCE_RS}, 7) AS km, CAST(round({DISTANCE_RS} * 20) AS INT) AS minutes FROM g_stops a JOIN g_stops b ON a.feed_id = b.feed_id AND a.row_idx < b.row_idx AND a.stop_name = b.stop_name")
def c11_walk_minutes(spark: SparkSession, d: str) -> DataFrame:
    km = geo.splitter_km(*[F.col(c) for c in ENDS])
    return _same_name(spark, d).select(F.col("a_feed_id").alias("feed_id"), F.col("a_stop_id").alias("a"), F.col("b_stop_id").alias("b"), F.round(km, 7).alias("km"), F.round(geo.walk_minutes(km)).cast("int").alias("minutes"))


@query("""SELECT feed_id, stop_id, round(111.32 * greatest(abs(cos(radians(stop_lat))), 1e-6), 7) AS lon_km, CAST(floor(stop_lat) AS INT) AS lat_floor, CAST(floor(stop_lon) AS INT) AS lon_floor,
 CAST(floor(stop_lat / (1.5 * 50 / 111320.0)) AS BIGINT) AS gi FROM g_stops""")
def c14_cell_key(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    lon_km = F.when(lat.isNotNull(), F.round(geo.lon_km_per_degree(lat), 7))
    return view(spark, d, "g_stops").select("feed_id", "stop_id", F.when(lat.isNull(), F.round(F.lit(111.32e-6), 7)).otherwise(lon_km).alias("lon_km"), geo.cell_of(lat).alias("lat_floor"), geo.cell_of(lon).alias("lon_floor"), geo.grid_of(lat, 50.0).alias("gi"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, CAST(((l_partkey % 1500 - l_suppkey % 1500) % 1440 + 1440) % 1440 AS BIGINT) AS w FROM lineitem")
def c16_duration(spark: SparkSession, d: str) -> DataFrame:
    w = dates.segment_minutes(F.col("l_suppkey") % 1500, F.col("l_partkey") % 1500)
    return frame(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), w.cast("long").alias("w"))


@query("""SELECT p_partkey AS k, coalesce(t BETWEEN 0 AND 12 OR floor(t / 100) IN (1,2,4,7,8,9,10,11,12,13,14,15,17), FALSE) AS known,
 coalesce((t BETWEEN 0 AND 12 OR floor(t / 100) IN (1,2,4,7,8,9,10,11,12,13,14,15,17)) AND (t IN (3,4) OR floor(t / 100) IN (2,7,10,11,12,13,15,17)), FALSE) AS bus_or_ferry
 FROM (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN p_size % 20 ELSE p_size * 37 END AS t FROM part) x""")
def c17_route_type(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("p_partkey") % 17 == 0, None).when(F.col("p_partkey") % 2 == 0, F.col("p_size") % 20).otherwise(F.col("p_size") * 37)
    df = frame(spark, d, "part").select(F.col("p_partkey").alias("k"), t.alias("t"))
    return df.select("k", routes.is_route_type(F.col("t")).alias("known"), F.coalesce(routes.is_bus_or_ferry_route_type(F.col("t")), F.lit(False)).alias("bus_or_ferry"))


@query("""SELECT feed_id, route_id, line_id, route_short_name AS name, trim(route_color) AS color, CAST(coalesce(route_type, 0) AS INT) AS type_id, agency AS agency_id FROM v_lines""")
def c21_lines(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.lines(tables(spark, d)["routes"]).select("feed_id", "route_id", F.col("line_id").cast("long").alias("line_id"), "name", "color", "type_id", "agency_id")


@query("SELECT p_partkey AS k, CAST(CAST(concat('0x', substr(sha256(CASE WHEN p_partkey % 9 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_name END), 1, 8)) AS BIGINT) % 256 AS INT) AS color FROM part")
def c23_color_hash(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.col("p_name"))
    return frame(spark, d, "part").select(F.col("p_partkey").alias("k"), routes.color_index(name, F.col("p_partkey")).alias("color"))


@query("""SELECT k, n, i, off, CASE WHEN i + off < n THEN i + off ELSE i + off - (n // 7) * 7 * CAST(ceil((i + off - n + 1) / CAST((n // 7) * 7 AS DOUBLE)) AS INT) END AS idx
 FROM (SELECT o_orderkey AS k, CAST(7 + o_orderkey % 50 AS INT) AS n, CAST(o_custkey % 70 AS INT) AS i, CAST(o_orderkey % 7 AS INT) AS off FROM orders) x""")
def c24_index_from_start(spark: SparkSession, d: str) -> DataFrame:
    df = frame(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (7 + F.col("o_orderkey") % 50).cast("int").alias("n"), (F.col("o_custkey") % 70).cast("int").alias("i"), (F.col("o_orderkey") % 7).cast("int").alias("off"))
    return df.withColumn("idx", dates.index_from_start(F.col("n"), F.col("i"), F.col("off")))


@query("SELECT c_custkey AS k, regexp_replace(concat(c_name, '/', c_mktsegment, ' é.x'), '[^\\w\\-.é]', '_', 'g') AS name, substr(concat(c_name, repeat('x', 100)), 1, 80) AS short FROM customer")
def a15_safe_names(spark: SparkSession, d: str) -> DataFrame:
    full = F.concat("c_name", F.lit("/"), "c_mktsegment", F.lit(" é.x"))
    return frame(spark, d, "customer").select(F.col("c_custkey").alias("k"), routes.safe_file_name(full).alias("name"), F.substring(F.concat("c_name", F.lit("x" * 100)), 1, exports.NAME_LENGTH).alias("short"))


# --- filters, joins, routes


@query("SELECT feed_id, stop_id, stop_name AS name, stop_lat AS lat, stop_lon AS lon, number FROM v_ok")
def d01_valid_stops(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.number(feed_graph.valid_stops(tables(spark, d)["stops"]), "number").select("feed_id", "stop_id", "name", "lat", "lon", F.col("number").cast("long").alias("number"))


@query("SELECT feed_id, trip_id, service_id, stops FROM (SELECT feed_id, trip_id, t.service_id, string_agg(concat(s.stop_id, '@', CAST(s.minute AS VARCHAR)), ',' ORDER BY s.minute, s.row_idx, s.stop_id) AS stops FROM v_st s JOIN g_trips t USING (feed_id, trip_id) GROUP BY feed_id, trip_id, t.service_id) x")
def f01_trip_stop_times(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    out = feed_graph.trip_stop_times(t["stop_times"], t["trips"])
    return out.select("feed_id", "trip_id", "service_id", text(F.transform("stops", lambda x: F.concat(x["stop_id"], F.lit("@"), x["minute"].cast("string")))).alias("stops"))


@query("SELECT feed_id, t.trip_id, r.line_id FROM g_trips t JOIN v_lines r USING (feed_id, route_id)")
def e01_trip_lines(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return t["trips"].join(feed_graph.lines(t["routes"]).select("feed_id", "route_id", "line_id"), ["feed_id", "route_id"]).select("feed_id", "trip_id", F.col("line_id").cast("long").alias("line_id"))


GOOD_ROUTES = "SELECT feed_id, route_id FROM g_routes WHERE route_type IS NOT NULL AND NOT ((route_type BETWEEN 0 AND 12 OR floor(route_type / 100) IN (1,2,4,7,8,9,10,11,12,13,14,15,17)) AND (route_type IN (3,4) OR floor(route_type / 100) IN (2,7,10,11,12,13,15,17)))"


@query(f"SELECT feed_id, trip_id, route_id, service_id FROM g_trips WHERE (feed_id, route_id) IN ({GOOD_ROUTES})")
def e06_valid_trips(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return feed_graph.valid_trips(t["trips"], t["routes"], routes.is_bus_or_ferry_route_type).select("feed_id", "trip_id", "route_id", "service_id")


@query(f"SELECT DISTINCT feed_id, stop_id FROM g_stop_times WHERE (feed_id, trip_id) IN (SELECT feed_id, trip_id FROM g_trips WHERE (feed_id, route_id) IN ({GOOD_ROUTES}))")
def e07_covered_stops(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return feed_graph.covered_stops(t["stop_times"], t["trips"], t["routes"], routes.is_bus_or_ferry_route_type).select("feed_id", "stop_id")


COVERED = f"cov AS (SELECT DISTINCT feed_id, stop_id FROM g_stop_times WHERE (feed_id, trip_id) IN (SELECT feed_id, trip_id FROM g_trips WHERE (feed_id, route_id) IN ({GOOD_ROUTES})))"
ROLLED = f"""{COVERED}, own AS (SELECT * FROM g_stops WHERE (feed_id, stop_id) IN (SELECT feed_id, stop_id FROM cov)), kid AS (SELECT * FROM own WHERE parent_station IS NOT NULL AND (feed_id, parent_station) IN (SELECT feed_id, stop_id FROM own)),
 rolled AS (SELECT feed_id, stop_id, stop_name, stop_lat, stop_lon, row_idx FROM own WHERE (feed_id, stop_id) NOT IN (SELECT feed_id, stop_id FROM kid) UNION ALL SELECT feed_id, stop_id, stop_name, stop_lat, stop_lon, row_idx FROM g_stops WHERE (feed_id, stop_id) IN (SELECT feed_id, parent_station FROM kid))"""


@query(f"WITH {ROLLED} SELECT feed_id, stop_id, count(*) AS n FROM rolled GROUP BY feed_id, stop_id")
def e09_parent_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    covered = feed_graph.covered_stops(t["stop_times"], t["trips"], t["routes"], routes.is_bus_or_ferry_route_type)
    return stops.rolled_up(stops.with_parents(t["stops"]), covered)[0].groupBy("feed_id", "stop_id").agg(F.count("*").alias("n"))


# --- calendars


@query("""SELECT feed_id, service_id, date FROM (SELECT *, CAST(unnest(generate_series(strptime(start_date, '%Y%m%d'), coalesce(strptime(end_date, '%Y%m%d'), TIMESTAMP '2099-12-31'), INTERVAL 1 DAY)) AS DATE) AS date FROM g_calendar
 WHERE 1 IN (monday, tuesday, wednesday, thursday, friday, saturday, sunday)) x WHERE [monday, tuesday, wednesday, thursday, friday, saturday, sunday][isodow(date)] = 1""")
def f02_calendar_expand(spark: SparkSession, d: str) -> DataFrame:
    return calendar.expand_calendar(tables(spark, d)["calendar"]).select("feed_id", "service_id", "date")


@query("SELECT feed_id, service_id, date, max_by(exception_type, row_idx) AS exception_type FROM g_calendar_dates GROUP BY feed_id, service_id, date")
def f03a_last_exception(spark: SparkSession, d: str) -> DataFrame:
    return calendar.last_exceptions(tables(spark, d)["calendar_dates"]).select("feed_id", "service_id", "date", "exception_type")


def _joined(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    return calendar.joined_calendar_dates(t["calendar"], t["calendar_dates"])


@query("SELECT feed_id, service_id, date FROM v_joined")
def f03_joined_calendar(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select("feed_id", "service_id", "date")


@query("SELECT feed_id, service_id, array_to_string(days, ',') AS days FROM v_days")
def f04_service_weekdays(spark: SparkSession, d: str) -> DataFrame:
    return calendar.service_weekdays(_joined(spark, d)).select("feed_id", "service_id", text("days").alias("days"))


@query("SELECT feed_id, min(date) AS start_date, max(date) AS end_date FROM v_joined GROUP BY feed_id")
def f06_date_range(spark: SparkSession, d: str) -> DataFrame:
    return calendar.date_range(_joined(spark, d), "feed_id")


@query("SELECT feed_id, date, string_agg(service_id, ',' ORDER BY service_id) AS services FROM v_joined GROUP BY feed_id, date")
def f07_reverse_calendar(spark: SparkSession, d: str) -> DataFrame:
    return calendar.reverse_calendar(_joined(spark, d)).select("feed_id", "date", text("service_ids").alias("services"))


@query("""SELECT feed_id, service_id, """ + ", ".join(f"round(count(*) FILTER (isodow(date) = {k + 1}) / 365.0 * 7, 6) AS {n}" for k, n in enumerate(calendar.WEEKDAYS)) + " FROM g_calendar_dates WHERE exception_type = 1 GROUP BY feed_id, service_id")
def f08_weekday_pivot(spark: SparkSession, d: str) -> DataFrame:
    out = calendar.weekday_frequencies(tables(spark, d)["calendar_dates"], 365)
    return out.select("feed_id", "service_id", *[F.round(c, 6).alias(c) for c in calendar.WEEKDAYS])


SEGMENTS = """q_bp AS (SELECT date, sum(delta) AS delta FROM (SELECT start_date AS date, 1 AS delta FROM g_feed_spans UNION ALL SELECT end_date, -1 FROM g_feed_spans) x GROUP BY date),
q_seg AS (SELECT date AS b0, lead(date) OVER (ORDER BY date) AS b1, sum(delta) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS cov FROM q_bp),
q_best AS (SELECT start, cnt FROM (SELECT d.date AS start, max(s.cov) AS cnt FROM q_bp d JOIN q_seg s ON s.b0 >= d.date AND s.b1 <= d.date + 6 GROUP BY d.date) x WHERE cnt > 0 ORDER BY cnt DESC, start LIMIT 1)"""


@query(f"WITH {SEGMENTS} SELECT b0, b1, CAST(cov AS BIGINT) AS cov FROM q_seg")
def g08_coverage(spark: SparkSession, d: str) -> DataFrame:
    return calendar.segments(view(spark, d, "g_feed_spans"))


@query(f"WITH {SEGMENTS} SELECT start, start + 6 AS \"end\", CAST(cnt AS BIGINT) AS cnt FROM q_best")
def g07_best_window(spark: SparkSession, d: str) -> DataFrame:
    return calendar.most_covered_period(view(spark, d, "g_feed_spans"), 6)


SHIFTED = """sh AS (SELECT feed_id, unnest(range(0, common)) AS i, start_date AS s, end_date AS e, c0, c1, own, common, least(own, common) AS n FROM (SELECT *, CAST(end_date - start_date + 1 AS INT) AS own, CAST(c1 - c0 + 1 AS INT) AS common FROM spans) x WHERE own >= 7),
ix AS (SELECT *, CASE WHEN s > c0 THEN i + ((c0 - s) % 7 + 7) % 7 WHEN e < c1 THEN common - 1 - i + ((e - c1) % 7 + 7) % 7 ELSE i END AS raw FROM sh),
iy AS (SELECT *, CAST(CASE WHEN raw < n THEN raw ELSE raw - (n // 7) * 7 * CAST(ceil((raw - n + 1) / CAST((n // 7) * 7 AS DOUBLE)) AS INT) END AS INT) AS pos FROM ix),
mp AS (SELECT feed_id, CAST(i AS INT) AS day_idx, CASE WHEN s > c0 THEN s + pos WHEN e < c1 THEN e - pos ELSE c0 + CAST(i AS INT) END AS date FROM iy)"""


@query(f"WITH spans AS (SELECT *, DATE '2024-01-15' AS c0, DATE '2024-02-11' AS c1 FROM g_feed_spans), {SHIFTED} SELECT feed_id, day_idx, date FROM mp")
def g17_shift_calendar(spark: SparkSession, d: str) -> DataFrame:
    day = lambda s: F.lit(s).cast("date")
    shifted = calendar.shifted_dates(F.col("start_date"), F.col("end_date"), day("2024-01-15"), day("2024-02-11"))
    return view(spark, d, "g_feed_spans").select("feed_id", F.posexplode(shifted).alias("day_idx", "date"))


@query(f"WITH {SEGMENTS}, spans AS (SELECT g.*, b.start AS c0, b.start + 6 AS c1 FROM g_feed_spans g, q_best b), {SHIFTED} SELECT mp.feed_id, day_idx, mp.date, coalesce(string_agg(DISTINCT service_id, ',' ORDER BY service_id), '') AS services FROM mp LEFT JOIN g_feed_dates f ON f.feed_id = mp.feed_id AND f.date = mp.date GROUP BY mp.feed_id, day_idx, mp.date")
def g18_standard_week(spark: SparkSession, d: str) -> DataFrame:
    return calendar.standardize_calendars(view(spark, d, "g_feed_dates")).select("feed_id", "day_idx", "date", text("service_ids").alias("services"))


# --- graphs


@query("SELECT feed_id, line_id, array_to_string(stops, ',') AS stops, array_to_string(times, ',') AS times, array_to_string(days, ',') AS days FROM v_pattern")
def f05_journey_patterns(spark: SparkSession, d: str) -> DataFrame:
    return patterns(spark, d).select("feed_id", F.col("line_id").cast("long").alias("line_id"), text("stops").alias("stops"), text("times_within_day").alias("times"), text("days").alias("days"))


@query("SELECT feed_id, a, b, w FROM v_edges")
def f09_min_edges(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.min_edges(patterns(spark, d), "feed_id").select("feed_id", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "w")


@query("SELECT DISTINCT feed_id, a, b, line_id FROM v_seg WHERE a <> b")
def f10_distinct_edges(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.distinct_edges(patterns(spark, d), "feed_id").select("feed_id", *[F.col(c).cast("long").alias(c) for c in ("a", "b", "line_id")])


COMPACT = "used AS (SELECT DISTINCT feed_id, unnest(stops) AS number FROM v_pattern), com AS (SELECT o.*, row_number() OVER (PARTITION BY feed_id ORDER BY o.number) - 1 AS new_id FROM v_ok o WHERE (feed_id, number) IN (SELECT feed_id, number FROM used))"


@query(f"WITH {COMPACT} SELECT feed_id, new_id AS stop_id, stop_id AS original_id, stop_name AS name, stop_lat AS lat, stop_lon AS lon FROM com")
def g03_compact_stops(spark: SparkSession, d: str) -> DataFrame:
    return graph(spark, d).stops.select("feed_id", F.col("stop_id").cast("long").alias("stop_id"), "original_id", "name", "lat", "lon")


@query(f"WITH {COMPACT} SELECT feed_id, line_id, string_agg(CAST(new_id AS VARCHAR), ',' ORDER BY k) AS stops, array_to_string(any_value(times), ',') AS times, array_to_string(any_value(days), ',') AS days FROM (SELECT *, unnest(stops) AS number, generate_subscripts(stops, 1) AS k FROM (SELECT *, row_number() OVER () AS j FROM v_pattern) q) u JOIN com USING (feed_id, number) GROUP BY feed_id, line_id, j")
def i01_feed_graph(spark: SparkSession, d: str) -> DataFrame:
    return graph(spark, d).journeys.select("feed_id", F.col("line_id").cast("long").alias("line_id"), text("stops").alias("stops"), text("times_within_day").alias("times"), text("days").alias("days"))


@query("SELECT o.feed_id, o.number AS stop_id, coalesce(min(r.agency), '') AS agency FROM v_ok o LEFT JOIN (SELECT DISTINCT feed_id, line_id, unnest(stops) AS s FROM v_pattern) p ON p.s = o.number AND p.feed_id = o.feed_id LEFT JOIN v_lines r ON r.line_id = p.line_id AND r.feed_id = p.feed_id GROUP BY o.feed_id, o.number")
def f11_stop_agency(spark: SparkSession, d: str) -> DataFrame:
    line = feed_graph.lines(tables(spark, d)["routes"])
    got = exports.stop_agency(patterns(spark, d), line, "feed_id")
    return located(spark, d).join(got, ["feed_id", "stop_id"], "left").select("feed_id", F.col("stop_id").cast("long").alias("stop_id"), F.coalesce("agency", F.lit("")).alias("agency"))


@query("SELECT r.feed_id, agency AS agency_id, count(*) AS n, round(sum(x.stop_lat + y.stop_lat), 3) AS lat_sum FROM (SELECT DISTINCT feed_id, a, b, line_id FROM v_seg WHERE a <> b) e JOIN v_ok x ON x.number = a AND x.feed_id = e.feed_id JOIN v_ok y ON y.number = b AND y.feed_id = e.feed_id JOIN v_lines r ON r.line_id = e.line_id AND r.feed_id = e.feed_id GROUP BY r.feed_id, agency")
def f12_agency_segments(spark: SparkSession, d: str) -> DataFrame:
    line = feed_graph.lines(tables(spark, d)["routes"])
    edges = exports.placed_edges(located(spark, d), line, patterns(spark, d), "feed_id")
    return edges.groupBy("feed_id", "agency_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("a_lat") + F.col("b_lat")), 3).alias("lat_sum"))


@query("SELECT feed_id, stop_name AS name, count(*) AS n FROM g_stops GROUP BY feed_id, stop_name HAVING count(*) > 1")
def f14_name_clusters(spark: SparkSession, d: str) -> DataFrame:
    return stops.name_clusters(stops.with_parents(tables(spark, d)["stops"])).groupBy("feed_id", F.col("stop_name").alias("name")).agg(F.count("*").alias("n"))


def feeds_graph(spark: SparkSession, d: str) -> FeedGraph:
    """A graph of five feeds: stops are suppliers, lines are parts, journeys are orders with some unknown ids in them."""
    num = lambda key: (F.row_number().over(Window.partitionBy("feed_id").orderBy(key)) - 1).cast("int")
    feed = lambda key: F.concat(F.lit("f"), (F.col(key) % 5).cast("string"))
    s = frame(spark, d, "supplier").withColumn("feed_id", feed("s_suppkey")).select("feed_id", num("s_suppkey").alias("stop_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("lat"), F.col("s_acctbal").alias("lon"))
    p = frame(spark, d, "part").withColumn("feed_id", feed("p_partkey"))
    p = p.select("feed_id", num("p_partkey").alias("line_id"), F.col("p_name").alias("name"), F.lit("").alias("color"), F.col("p_size").cast("int").alias("type_id"), F.col("p_brand").alias("agency_id"))
    item = F.struct("l_linenumber", (F.col("l_suppkey") % 25).cast("int").alias("s"), (F.col("l_linenumber") * 7).cast("int").alias("t"))
    j = frame(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("x"))
    j = j.select(feed("l_orderkey").alias("feed_id"), "l_orderkey", (F.floor(F.col("l_orderkey") / 5) % 500).cast("int").alias("line_id"), F.transform("x", lambda v: v["s"]).alias("stops"), F.transform("x", lambda v: v["t"]).alias("times_within_day"), F.array(F.lit(0)).alias("days"))
    return FeedGraph(s, p, j)


FEEDS = """fs AS (SELECT concat('f', CAST(s_suppkey % 5 AS VARCHAR)) AS feed_id, row_number() OVER (PARTITION BY s_suppkey % 5 ORDER BY s_suppkey) - 1 AS stop_id, row_number() OVER (ORDER BY s_suppkey % 5, s_suppkey) - 1 AS gid, s_name AS name FROM supplier),
fl AS (SELECT concat('f', CAST(p_partkey % 5 AS VARCHAR)) AS feed_id, row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS line_id, row_number() OVER (ORDER BY p_partkey % 5, p_partkey) - 1 AS gid FROM part),
fj AS (SELECT l_orderkey AS k, concat('f', CAST(l_orderkey % 5 AS VARCHAR)) AS feed_id, l_orderkey // 5 % 500 AS line_id, l_suppkey % 25 AS s, l_linenumber AS o FROM lineitem),
rj AS (SELECT k, j.feed_id, coalesce(fl.gid, 0) AS line_id, string_agg(CAST(fs.gid AS VARCHAR), ',' ORDER BY o, s) AS stops FROM fj j JOIN fs ON fs.feed_id = j.feed_id AND fs.stop_id = j.s LEFT JOIN fl ON fl.feed_id = j.feed_id AND fl.line_id = j.line_id GROUP BY k, j.feed_id, coalesce(fl.gid, 0) HAVING count(*) >= 2)"""


@query(f"WITH {FEEDS} SELECT feed_id, line_id, stops FROM rj")
def e14_global_remap(spark: SparkSession, d: str) -> DataFrame:
    return combine.combine(feeds_graph(spark, d)).journeys.select("feed_id", F.col("line_id").cast("long").alias("line_id"), text("stops").alias("stops"))


@query(f"WITH {FEEDS} SELECT gid AS stop_id, name FROM fs")
def g04_global_ids(spark: SparkSession, d: str) -> DataFrame:
    return combine.combine(feeds_graph(spark, d)).stops.select(F.col("stop_id").cast("long").alias("stop_id"), "name")


@query(f"WITH {FEEDS} SELECT (SELECT count(*) FROM fs) AS n_stops, (SELECT count(*) FROM fl) AS n_lines, (SELECT count(*) FROM rj) AS n_journeys")
def f16_combined_counts(spark: SparkSession, d: str) -> DataFrame:
    return combine.counts(combine.combine(feeds_graph(spark, d)))


# --- space


def _places(spark: SparkSession, d: str) -> DataFrame:
    """Valid stops of all feeds under their global numbers."""
    own = located(spark, d)
    return own.join(combine.offsets(own, "off"), "feed_id").select((F.col("off") + F.col("stop_id")).alias("stop_id"), "name", "lat", "lon")


def _points(spark: SparkSession, d: str) -> DataFrame:
    """Customers as points in a city of a few kilometres."""
    k = F.col("c_custkey")
    return frame(spark, d, "customer").select(k.alias("id"), (45 + (k * 7919 % 10007) / 10007.0 * 0.05).alias("lat"), (-122 + (k * 104729 % 10007) / 10007.0 * 0.05).alias("lon"))


POINTS = "pt AS (SELECT c_custkey AS id, 45 + (c_custkey * 7919 % 10007) / CAST(10007.0 AS DOUBLE) * 0.05e0 AS stop_lat, -122 + (c_custkey * 104729 % 10007) / CAST(10007.0 AS DOUBLE) * 0.05e0 AS stop_lon FROM customer)"


@query(f"WITH {POINTS} SELECT a.id AS i, b.id AS j FROM pt a JOIN pt b ON a.id < b.id AND abs(a.stop_lat - b.stop_lat) < 0.01 WHERE {DISTANCE} < 150")
def e10_proximity(spark: SparkSession, d: str) -> DataFrame:
    return spatial.proximity_graph(_points(spark, d), 150.0)


@query(f"WITH {POINTS} SELECT a.id AS i, b.id AS j FROM pt a JOIN pt b ON a.id < b.id WHERE power((a.stop_lat - b.stop_lat) / (0.2e0 / 111.32e0), 2) + power((a.stop_lon - b.stop_lon) / (0.2e0 / 111.32e0 / cos(radians(greatest(a.stop_lat, b.stop_lat)))), 2) < 1")
def e11_ellipse_pairs(spark: SparkSession, d: str) -> DataFrame:
    return spatial.ellipse_pairs(_points(spark, d), 0.2)


WALKS = f"wk AS (SELECT a.gid AS a, b.gid AS b, CAST(round({DISTANCE_RS} * 20) AS INT) AS w FROM v_ok a JOIN v_ok b ON a.gid <> b.gid WHERE round({DISTANCE_RS} * 20) < 120)"


@query(f"WITH {WALKS} SELECT a, b, w FROM wk")
def e12_walking_links(spark: SparkSession, d: str) -> DataFrame:
    return spatial.walking_links(_places(spark, d)).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "w")


def _cells(buffer: str) -> str:
    polar = f"CASE WHEN abs(lat - {buffer}) >= greatest(abs(i), abs(lat + {buffer})) THEN lat - {buffer} WHEN abs(i) >= abs(lat + {buffer}) THEN i ELSE lat + {buffer} END"
    return f"""ci AS (SELECT gid AS number, stop_lat AS lat, stop_lon AS lon, unnest(generate_series(CAST(floor(stop_lat - {buffer}) AS BIGINT), CAST(floor(stop_lat + {buffer}) AS BIGINT))) AS i FROM v_ok),
cl AS (SELECT *, 6.0e0 / (111.32e0 * greatest(abs(cos(radians({polar}))), 1e-6)) AS r FROM ci),
cj AS (SELECT *, unnest(generate_series(CAST(floor(lon - r) AS BIGINT), CAST(floor(lon + r) AS BIGINT))) AS j FROM cl),
seed6 AS (SELECT DISTINCT CAST(i AS INT) AS lat_floor, CAST(j AS INT) AS lon_floor, number AS stop_id FROM cj WHERE i - {buffer} <= lat AND lat < i + 1 + {buffer} AND j - r <= lon AND lon < j + 1 + r)"""


@query(f"WITH {_cells('(6.0e0 / 111.32e0)')} SELECT lat_floor, lon_floor, stop_id FROM seed6")
def e13_buffer_cells(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cell_seeds(_places(spark, d), 6.0).withColumn("stop_id", F.col("stop_id").cast("long"))


@query("SELECT CAST(floor(stop_lat) AS INT) AS lat_floor, CAST(floor(stop_lon) AS INT) AS lon_floor, string_agg(CAST(gid AS VARCHAR), ',' ORDER BY gid) AS stops FROM v_ok GROUP BY ALL")
def f13_cell_seeds(spark: SparkSession, d: str) -> DataFrame:
    seeds = spatial.cell_seeds(_places(spark, d))
    return seeds.groupBy(*reach.CELL).agg(text(F.sort_array(F.collect_set("stop_id"))).alias("stops"))


WALKED = f"""WITH RECURSIVE {WALKS}, ed AS MATERIALIZED (SELECT a, b, min(w) AS w FROM (SELECT a, b, w FROM v_gedges UNION ALL SELECT a, b, w FROM wk) z GROUP BY a, b),
rc(lat_floor, lon_floor, stop_id, used) AS (SELECT CAST(floor(stop_lat) AS INT), CAST(floor(stop_lon) AS INT), gid, 0 FROM v_ok UNION SELECT lat_floor, lon_floor, ed.b, CAST(used + ed.w AS INT) FROM rc JOIN ed ON ed.a = rc.stop_id WHERE used + ed.w < 120),
reach AS (SELECT lat_floor, lon_floor, stop_id, min(used) AS minutes_used FROM rc GROUP BY ALL)"""


def _walked(g: FeedGraph) -> DataFrame:
    return reach.reachable_by_cell(g.stops, g.journeys)


@query(f"{WALKED} SELECT * FROM reach")
def h04_reach_walk(spark: SparkSession, d: str) -> DataFrame:
    return _walked(whole(spark, d)).withColumn("stop_id", F.col("stop_id").cast("long"))


@query(f"""WITH RECURSIVE {_cells('(6.0e0 / 111.32e0)')}, rc(lat_floor, lon_floor, stop_id, used) AS (SELECT lat_floor, lon_floor, stop_id, 0 FROM seed6 UNION SELECT lat_floor, lon_floor, e.b, CAST(used + e.w AS INT) FROM rc JOIN v_gedges e ON e.a = rc.stop_id WHERE used + e.w <= 120)
 SELECT lat_floor, lon_floor, stop_id, min(used) AS minutes_used FROM rc GROUP BY ALL""")
def h05_reach_rides(spark: SparkSession, d: str) -> DataFrame:
    g = whole(spark, d)
    out = reach.reachable_by_cell(g.stops, g.journeys, buffer_km=6.0, walk_kmh=None, inclusive=True)
    return out.withColumn("stop_id", F.col("stop_id").cast("long"))


JOURNEYS = f"{WALKED}, pj AS (SELECT *, concat_ws('|', CAST(line_id AS VARCHAR), array_to_string(stops, ','), array_to_string(times, ',')) AS journey_id FROM v_gpattern), vi AS (SELECT DISTINCT journey_id, line_id, unnest(stops) AS s FROM pj), nv AS (SELECT journey_id, count(*) AS n FROM vi GROUP BY journey_id), cj AS (SELECT lat_floor, lon_floor, vi.journey_id, any_value(line_id) AS line_id FROM vi JOIN reach ON reach.stop_id = vi.s JOIN nv ON nv.journey_id = vi.journey_id GROUP BY lat_floor, lon_floor, vi.journey_id, n HAVING count(*) = n)"


@query(f"{JOURNEYS} SELECT lat_floor, lon_floor, journey_id FROM cj")
def e15_cell_journeys(spark: SparkSession, d: str) -> DataFrame:
    g = whole(spark, d)
    return reach.cell_journeys(_walked(g), g.journeys)


@query(f"{JOURNEYS} SELECT lat_floor, lon_floor, line_id, row_number() OVER (PARTITION BY lat_floor, lon_floor ORDER BY line_id) - 1 AS new_line FROM (SELECT DISTINCT lat_floor, lon_floor, line_id FROM cj) x")
def e16_cell_lines(spark: SparkSession, d: str) -> DataFrame:
    g = whole(spark, d)
    own = reach.cell_journeys(_walked(g), g.journeys).join(g.journeys.select("journey_id", "line_id"), "journey_id")
    lines = reach.renumbered(own.select(*reach.CELL, "line_id").distinct(), "line_id", "new_line")
    return lines.select(*reach.CELL, F.col("line_id").cast("long").alias("line_id"), F.col("new_line").cast("long").alias("new_line"))


@query(f"{WALKED} SELECT lat_floor, lon_floor, row_number() OVER (PARTITION BY lat_floor, lon_floor ORDER BY reach.stop_id) - 1 AS stop_id, stop_name AS name, minutes_used FROM reach JOIN v_ok ON v_ok.gid = reach.stop_id")
def g05_cell_stops(spark: SparkSession, d: str) -> DataFrame:
    g = whole(spark, d)
    return reach.cell_stops(_walked(g), g.stops).select(*reach.CELL, F.col("new_id").cast("long").alias("stop_id"), "name", "minutes_used")


# --- clusters


NEAR = f"near AS (SELECT a.id AS a, b.id AS b FROM pt a JOIN pt b ON a.id <> b.id WHERE {DISTANCE} < 150)"


@query(f"WITH RECURSIVE {POINTS}, {NEAR}, cc(id, root) AS (SELECT DISTINCT a, a FROM near UNION SELECT near.b, cc.root FROM cc JOIN near ON near.a = cc.id) SELECT id, min(root) AS root FROM cc GROUP BY id")
def h01_components(spark: SparkSession, d: str) -> DataFrame:
    return spatial.proximity_components(_points(spark, d), 150.0)


CLUSTERED = """lk AS (SELECT a.row_idx AS a, b.row_idx AS b FROM g_stops a JOIN g_stops b ON a.row_idx <> b.row_idx AND a.feed_id = b.feed_id AND a.stop_name IS NOT DISTINCT FROM b.stop_name
 WHERE power((a.stop_lat - b.stop_lat) / (0.25e0 / 111.32e0), 2) + power((a.stop_lon - b.stop_lon) / (0.25e0 / 111.32e0 / cos(radians(greatest(a.stop_lat, b.stop_lat)))), 2) < 1),
cc(id, root) AS (SELECT row_idx, row_idx FROM g_stops UNION SELECT lk.b, cc.root FROM cc JOIN lk ON lk.a = cc.id), rt AS (SELECT id, min(root) AS root FROM cc GROUP BY id)"""


@query(f"WITH RECURSIVE {CLUSTERED} SELECT e.feed_id, e.stop_id, e.stop_name, round(avg(s.stop_lat), 7) AS lat, round(avg(s.stop_lon), 7) AS lon, count(*) AS n FROM rt JOIN g_stops s ON s.row_idx = rt.id JOIN g_stops e ON e.row_idx = rt.root GROUP BY e.feed_id, e.stop_id, e.stop_name")
def h03_dedup(spark: SparkSession, d: str) -> DataFrame:
    out, _ = stops.deduplicate_stops(stops.with_parents(tables(spark, d)["stops"]))
    return out.select("feed_id", "stop_id", "stop_name", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"), "n")


@query(f"WITH RECURSIVE {CLUSTERED} SELECT s.feed_id, s.stop_id, e.stop_id AS exemplar FROM rt JOIN g_stops s ON s.row_idx = rt.id JOIN g_stops e ON e.row_idx = rt.root WHERE rt.id <> rt.root")
def h03_remap(spark: SparkSession, d: str) -> DataFrame:
    return stops.deduplicate_stops(stops.with_parents(tables(spark, d)["stops"]))[1]


PLACES = f"""{ROLLED}, ro AS (SELECT DISTINCT * FROM rolled), {CLUSTERED.replace('g_stops', 'ro')},
mn AS (SELECT e.feed_id, e.stop_id, e.stop_name, e.row_idx, avg(s.stop_lat) AS lat, avg(s.stop_lon) AS lon FROM rt JOIN ro s ON s.row_idx = rt.id JOIN ro e ON e.row_idx = rt.root GROUP BY ALL),
pl AS (SELECT row_number() OVER (ORDER BY feed_id, row_idx, stop_id) - 1 AS idx, * FROM mn WHERE lat IS NOT NULL AND lon IS NOT NULL)"""


@query(f"WITH RECURSIVE {PLACES} SELECT idx, feed_id, stop_id, stop_name AS name, round(lat, 7) AS lat, round(lon, 7) AS lon FROM pl")
def h03d_standardized_stops(spark: SparkSession, d: str) -> DataFrame:
    return stops.standardized_stops(tables(spark, d))[0].withColumns({"lat": F.round("lat", 7), "lon": F.round("lon", 7)})


@query(f"""WITH RECURSIVE {PLACES}, went AS (SELECT s.feed_id, s.stop_id, e.stop_id AS place FROM rt JOIN ro s ON s.row_idx = rt.id JOIN ro e ON e.row_idx = rt.root),
 every AS (SELECT feed_id, stop_id, place FROM went WHERE (feed_id, stop_id) NOT IN (SELECT feed_id, stop_id FROM kid)
  UNION ALL SELECT k.feed_id, k.stop_id, coalesce(w.place, k.parent_station) FROM kid k LEFT JOIN went w ON w.feed_id = k.feed_id AND w.stop_id = k.parent_station)
 SELECT DISTINCT v.feed_id, v.stop_id, pl.idx FROM every v LEFT JOIN pl ON pl.feed_id = v.feed_id AND pl.stop_id = v.place WHERE v.stop_id <> v.place OR pl.idx IS NOT NULL""")
def h03c_stop_places(spark: SparkSession, d: str) -> DataFrame:
    """Where every served stop went, through clusters and parents."""
    return stops.standardized_stops(tables(spark, d))[1]


@query()
def h07_reduce_points(spark: SparkSession, d: str) -> DataFrame:
    return point_reduce.reduce_points(_points(spark, d), 100.0)


# --- exports


@query("SELECT concat('f', CAST(s_suppkey % 5 AS VARCHAR)) AS feed_id, substr(s_name, 1, 80) AS name, count(*) AS n FROM supplier GROUP BY ALL")
def b06_export_points(spark: SparkSession, d: str) -> DataFrame:
    g = feeds_graph(spark, d)
    return exports.export_points(*g).groupBy("feed_id", "name").agg(F.count("*").alias("n"))


EDGES_F = "ef AS (SELECT DISTINCT j.feed_id, j.line_id, j.s AS a, j.b FROM (SELECT *, lead(s) OVER (PARTITION BY k ORDER BY o, s) AS b FROM fj) j JOIN fs x ON x.feed_id = j.feed_id AND x.stop_id = j.s JOIN fs y ON y.feed_id = j.feed_id AND y.stop_id = j.b WHERE j.s <> j.b)"


@query(f"WITH {FEEDS}, {EDGES_F}, fa AS (SELECT feed_id, line_id, agency FROM (SELECT concat('f', CAST(p_partkey % 5 AS VARCHAR)) AS feed_id, row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS line_id, p_brand AS agency FROM part) q) SELECT CASE WHEN ef.feed_id IN ('f0', 'f1', 'f2') THEN 0 ELSE 1 END AS component, coalesce(agency, '') AS agency_id, count(*) AS n FROM ef LEFT JOIN fa USING (feed_id, line_id) WHERE ef.feed_id <> 'f4' GROUP BY ALL")
def b07_component_lines(spark: SparkSession, d: str) -> DataFrame:
    parts = spark.createDataFrame([(0, "f0"), (0, "f1"), (0, "f2"), (1, "f3")], "component int, feed_id string")
    return exports.component_agency_segments(*feeds_graph(spark, d), parts).select("component", "agency_id", "n")


@query("""SELECT feed_id, stop_id, concat('{"type":"Feature","properties":{"stop_id":', CAST(number AS VARCHAR), ',"name":"', stop_name, '","minutes_used":0},"geometry":{"type":"Point","coordinates":[', lon, ',', lat, ']}}') AS feature
 FROM (SELECT feed_id, stop_id, number, stop_name, CAST(CAST(round(stop_lon * 100) AS INT) AS VARCHAR) AS lon, CAST(CAST(round(stop_lat * 100) AS INT) AS VARCHAR) AS lat FROM v_ok) x""")
def b08_geojson_points(spark: SparkSession, d: str) -> DataFrame:
    whole = lambda c: F.round(F.col(c) * 100).cast("int").alias(c)  # noqa: E731  as integers: engines write doubles in different ways
    s = feed_graph.number(feed_graph.valid_stops(tables(spark, d)["stops"]), "number").select("feed_id", F.col("stop_id").alias("original"), F.col("number").alias("stop_id"), "name", whole("lat"), whole("lon"), F.lit(None).cast("int").alias("minutes_used"))
    return exports.point_features(s).select("feed_id", F.col("original").alias("stop_id"), "feature")


@query(f"WITH {FEEDS}, {EDGES_F}, nm AS (SELECT concat('f', CAST(p_partkey % 5 AS VARCHAR)) AS feed_id, row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS line_id, p_name AS name FROM part) SELECT ef.feed_id, ef.line_id, CAST(CAST(concat('0x', substr(sha256(coalesce(name, CAST(ef.line_id AS VARCHAR))), 1, 8)) AS BIGINT) % 256 AS INT) AS color, count(*) AS n FROM ef LEFT JOIN nm USING (feed_id, line_id) GROUP BY ALL")
def b09_image_segments(spark: SparkSession, d: str) -> DataFrame:
    out = exports.image_segments(*feeds_graph(spark, d), "feed_id")
    return out.groupBy("feed_id", F.col("line_id").cast("long").alias("line_id"), "color").agg(F.count("*").alias("n"))


# --- smaller operators


@query("SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE CAST(p_size AS DOUBLE) / 4 END AS x FROM part")
def c07_safe_double(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    s = F.when(k == 0, "NaN").when(k == 1, "x1").when(k == 2, "").otherwise(F.concat(F.lit(" "), (F.col("p_size") / 4).cast("string")))
    return frame(spark, d, "part").select(F.col("p_partkey").alias("k"), routes.safe_double(s).alias("x"))


@query("""SELECT feed_id, t.trip_id, CASE WHEN feed_id <> 'f2' AND r.agency_id IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21') THEN 'Europe/Berlin' ELSE 'UTC' END AS timezone FROM g_trips t LEFT JOIN g_routes r USING (feed_id, route_id)""")
def e02_trip_timezones(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    agency = spark.createDataFrame([(f, f"Brand#{n}", "Europe/Berlin", n) for n in (11, 12, 13, 21) for f in ("f0", "f1")] + [("f0", "Brand#22", " ", 22), ("f2", "Brand#11", None, 1)], "feed_id string, agency_id string, agency_timezone string, row_idx long")
    return feed_graph.trip_timezones(t["trips"], t["routes"], agency)


@query(GOOD_ROUTES)
def f19_valid_routes(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.valid_routes(tables(spark, d)["routes"], routes.is_bus_or_ferry_route_type)


@query("SELECT DISTINCT feed_id, unnest(stops) AS stop_id FROM v_pattern")
def f17_used_stops(spark: SparkSession, d: str) -> DataFrame:
    return feed_graph.used_stops(patterns(spark, d), "feed_id").select("feed_id", F.col("stop_id").cast("long").alias("stop_id"))


@query("""SELECT feed_id, service_id, concat('["', string_agg(strftime(date, '%Y-%m-%d'), '","' ORDER BY date), '"]') AS dates FROM v_joined GROUP BY feed_id, service_id""")
def b04_calendar_json(spark: SparkSession, d: str) -> DataFrame:
    return calendar.calendar_json(_joined(spark, d))


@query("SELECT feed_id, p.trip_id, r.agency, len(p.stops) AS n FROM v_trip p JOIN v_days USING (feed_id, service_id) JOIN v_lines r USING (feed_id, line_id)")
def e17_journey_agency(spark: SparkSession, d: str) -> DataFrame:
    t = tables(spark, d)
    line = feed_graph.lines(t["routes"]).select("feed_id", "route_id", "agency_id")
    days = calendar.service_weekdays(calendar.joined_calendar_dates(t["calendar"], t["calendar_dates"]))
    valid = feed_graph.valid_stops(t["stops"]).select("feed_id", "stop_id")
    visits = feed_graph.timed_stops(t["stop_times"]).join(valid, ["feed_id", "stop_id"], "left_semi").groupBy("feed_id", "trip_id").agg(F.count("*").alias("n")).filter("n >= 2")
    trips = t["trips"].join(visits, ["feed_id", "trip_id"]).join(days, ["feed_id", "service_id"], "left_semi").join(line, ["feed_id", "route_id"])
    return trips.select("feed_id", "trip_id", F.col("agency_id").alias("agency"), "n")


# --- sources and sinks


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared place."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


def _archives(spark: SparkSession, d: str) -> DataFrame:
    """(path, content): an archive for each of the three feeds, in different encodings and folders, and two that can't be read."""

    def file(name: str, header: str, *cols: str) -> DataFrame:
        line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
        rows = view(spark, d, f"g_{name}").withColumn("stop_name", F.concat(F.lit("é "), "stop_name")) if name == "stops" else view(spark, d, f"g_{name}")
        lines = rows.groupBy("feed_id").agg(F.sort_array(F.collect_list(F.struct("row_idx", line.alias("line")))).alias("x"))  # an archive holds a feed whole
        return lines.select("feed_id", F.concat(F.lit(header + "\n"), F.array_join(F.transform("x", lambda v: v["line"]), "\n")).alias(name))

    both = file("stops", "stop_id, stop_name ,stop_lat,stop_lon,parent_station", "stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station").join(
        file("routes", "route_id,route_type", "route_id", "route_type"), "feed_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for feed, stops_, routes_ in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w") as z:
                    z.writestr("inner/stops.txt" if feed == "f2" else "stops.txt", stops_.encode("latin-1" if feed == "f1" else "utf-8-sig"))
                    z.writestr("routes.txt", routes_)
                yield pa.RecordBatch.from_arrays([pa.array([f"store/{feed}.zip"]), pa.array([data.getvalue()], pa.binary())], names=["path", "content"])

    twice = io.BytesIO()
    with zipfile.ZipFile(twice, "w") as z:
        z.writestr("a/stops.txt", "stop_id\n")
        z.writestr("b/stops.txt", "stop_id\n")
    odd = spark.createDataFrame([("store/bad.zip", b"no archive"), ("store/twice.zip", twice.getvalue())], "path string, content binary")
    return both.mapInArrow(run, "path string, content binary").unionByName(odd)


@query("SELECT feed_id, row_number() OVER (PARTITION BY feed_id ORDER BY row_idx) - 1 AS row_idx, stop_id, concat('é ', stop_name) AS name, stop_lat AS lat, stop_lon AS lon, parent_station AS parent FROM g_stops")
def a05_feed_stops(spark: SparkSession, d: str) -> DataFrame:
    """Archives in different encodings and folders, read back."""
    got = gtfs.table(_archives(spark, d), "stops.txt")
    return got.select("feed_id", "row_idx", "stop_id", F.col("stop_name").alias("name"), routes.safe_double(F.col("stop_lat")).alias("lat"), routes.safe_double(F.col("stop_lon")).alias("lon"), F.col("parent_station").alias("parent"))


@query("SELECT feed_id, count(*) AS n, count(route_type) AS n_types FROM g_routes GROUP BY feed_id")
def a07_feed_routes(spark: SparkSession, d: str) -> DataFrame:
    return gtfs.table(_archives(spark, d), "routes.txt").groupBy("feed_id").agg(F.count("*").alias("n"), F.count("route_type").alias("n_types"))


@query("SELECT DISTINCT feed_id, 'success' AS status, NULL AS reason FROM g_stops UNION ALL VALUES ('bad', 'failure', 'bad zip file'), ('twice', 'failure', 'more than one stops.txt')")
def a04_feed_status(spark: SparkSession, d: str) -> DataFrame:
    return gtfs.feed_status(_archives(spark, d))


@query("SELECT * FROM (VALUES ('bad', 'bad zip file'), ('twice', 'more than one stops.txt')) x(feed_id, reason)")
def a14_all_failures(spark: SparkSession, d: str) -> DataFrame:
    return gtfs.all_failures(gtfs.feed_status(_archives(spark, d)))


@query("SELECT n_name AS feed_id, CASE n_nationkey % 5 WHEN 0 THEN 'success' WHEN 4 THEN 'success' ELSE 'failure' END AS status, CASE n_nationkey % 5 WHEN 1 THEN 'timeout' WHEN 2 THEN 'connection error' WHEN 3 THEN concat('status code 404; content: b', chr(39), 'gone', chr(39)) END AS reason, CASE n_nationkey % 5 WHEN 0 THEN 'fetched' WHEN 4 THEN 'cached' END AS content FROM nation")
def a04_fetch(spark: SparkSession, d: str) -> DataFrame:
    """Feeds from a cache and from a fetcher that fails in several ways."""
    nations = frame(spark, d, "nation")
    kind = {r.n_name: r.n_nationkey % 5 for r in nations.select("n_name", "n_nationkey").collect()}  # 25 rows
    BadStatus = gtfs.BadStatus

    def get(feed: str) -> bytes:
        if kind[feed]:
            raise {1: TimeoutError(), 2: ConnectionError(), 3: BadStatus(404, b"gone")}[kind[feed]]
        return b"fetched"

    cached = nations.filter("n_nationkey % 5 = 4").select(F.concat(F.lit("store/"), "n_name", F.lit(".zip")).alias("path"), F.lit(b"cached").alias("content"))
    out = gtfs.fetch(nations.select(F.col("n_name").alias("feed_id")), get, cached)
    return out.select("feed_id", "status", "reason", F.col("content").cast("string").alias("content"))


@query("SELECT concat('feeds/', n_name, '.dmfr.json') AS path FROM nation WHERE n_nationkey % 3 <> 0")
def a01_gtfs_list(spark: SparkSession, d: str) -> DataFrame:
    """The index is listed once a version: the second call would fail if it listed again."""
    base, version = _folder(spark), gtfs.FeedVersion("atlas", "abc123", "a/b")
    name = F.concat(F.when(F.col("n_nationkey") % 3 == 0, "docs/").otherwise("feeds/"), "n_name", F.lit(".dmfr.json"))
    gtfs.gtfs_list(spark, version, lambda _: frame(spark, d, "nation").select(name.alias("path")), base)
    return gtfs.gtfs_list(spark, version, lambda _: 1 / 0, base)


@query("SELECT r_name AS spec, n_name AS id FROM nation JOIN region ON r_regionkey = n_regionkey")
def a03_all_gtfs_info(spark: SparkSession, d: str) -> DataFrame:
    """Specification files, one a region, and the feeds that they name."""
    path = _folder(spark)
    named = frame(spark, d, "nation").join(frame(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    specs = named.groupBy("r_name").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("n_name").alias("id"))).alias("feeds"))).alias("value"))
    specs.write.partitionBy("r_name").text(path)
    return gtfs.read_specs(spark, path).select(F.regexp_replace(F.url_decode(F.regexp_extract("spec", "r_name=([^/]*)/", 1)), "_", " ").alias("spec"), F.col("feed.id").alias("id"))


@query("SELECT CAST(n_regionkey AS INT) AS component, n_name AS feed_id FROM nation")
def a11_components(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    parts = frame(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("feeds"))
    whole = parts.agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("n_regionkey", "feeds"))), lambda x: x["feeds"]).alias("components"))).alias("value"))
    whole.coalesce(1).write.text(path)
    return gtfs.read_components(spark, path)


@query(f"WITH {FEEDS} SELECT feed_id, CAST(l_orderkey // 5 % 500 AS INT) AS line_id, string_agg(CAST(l_suppkey % 25 AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey % 25, l_linenumber * 7) AS stops FROM (SELECT *, concat('f', CAST(l_orderkey % 5 AS VARCHAR)) AS feed_id FROM lineitem) x GROUP BY feed_id, l_orderkey")
def a08_graph_messages(spark: SparkSession, d: str) -> DataFrame:
    """Journeys of graphs that went through messages."""
    g = feeds_graph(spark, d)
    g = graphs.parsed(graphs.graph_messages(g._replace(stops=g.stops.withColumn("minutes_used", F.lit(None).cast("int"))), "feed_id"))
    return g.journeys.select("feed_id", "line_id", text("stops").alias("stops"))


@query(f"WITH {FEEDS} SELECT line_id, stops, count(*) AS n FROM rj GROUP BY line_id, stops")
def a09_chunked_graph(spark: SparkSession, d: str) -> DataFrame:
    """The graph of all feeds, written in chunks and read again."""
    path = _folder(spark)
    combine.write_graph(combine.combine(feeds_graph(spark, d)), path, max_rows=1000)
    return combine.read_graph(spark, path).journeys.groupBy(F.col("line_id").cast("long").alias("line_id"), text("stops").alias("stops")).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES (1, TRUE)) x(files, at_most)")
def g12_chunk_sizes(spark: SparkSession, d: str) -> DataFrame:
    """No file of a chunked graph has more rows than asked for."""
    path = _folder(spark)
    combine.write_graph(combine.combine(feeds_graph(spark, d)), path, max_rows=100)
    sizes = combine.read_graph(spark, path).stops.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return sizes.agg(F.lit(1).alias("files"), (F.max("n") <= 100).alias("at_most"))


@query(f"{WALKED} SELECT * FROM reach WHERE lat_floor = 47 AND lon_floor = -122")
def h08_one_cell(spark: SparkSession, d: str) -> DataFrame:
    """A search from one cell's seeds only."""
    g = whole(spark, d)
    return reach.reachable_by_cell(g.stops, g.journeys, cell=(47, -122)).withColumn("stop_id", F.col("stop_id").cast("long"))


@query(f"{JOURNEYS} SELECT lat_floor, lon_floor, count(*) AS journeys, count(DISTINCT line_id) AS lines, CAST(sum(len(string_split(split_part(journey_id, '|', 2), ','))) AS BIGINT) AS visits FROM cj GROUP BY lat_floor, lon_floor")
def b03_cell_subgraphs(spark: SparkSession, d: str) -> DataFrame:
    """Cells written as partitions and read again."""
    g, path = whole(spark, d), _folder(spark)
    combine.write_graph(FeedGraph(*reach.cell_subgraphs(_walked(g), *g)), path, by=reach.CELL)
    back = combine.read_graph(spark, path).journeys
    return back.groupBy(*reach.CELL).agg(F.count("*").alias("journeys"), F.countDistinct("line_id").alias("lines"), F.sum(F.size("stops")).cast("long").alias("visits"))


@query(f"""WITH {SEGMENTS}, spans AS (SELECT g.*, b.start AS c0, b.start + 6 AS c1 FROM g_feed_spans g, q_best b), {SHIFTED},
 sv AS (SELECT mp.feed_id, day_idx, concat('[', coalesce(string_agg(DISTINCT concat('"', service_id, '"'), ',' ORDER BY concat('"', service_id, '"')) FILTER (WHERE service_id IS NOT NULL), ''), ']') AS ids FROM mp LEFT JOIN g_feed_dates f ON f.feed_id = mp.feed_id AND f.date = mp.date GROUP BY mp.feed_id, day_idx)
 SELECT feed_id, (SELECT start FROM q_best) AS start_common, (SELECT start + 6 FROM q_best) AS end_common, concat('[', string_agg(ids, ',' ORDER BY day_idx), ']') AS services FROM sv GROUP BY feed_id""")
def b05_standard_week_json(spark: SparkSession, d: str) -> DataFrame:
    return calendar.standardized_json(view(spark, d, "g_feed_dates"))


@query(f"WITH {FEEDS}, {EDGES_F} SELECT feed_id, count(*) AS n FROM ef GROUP BY feed_id")
def b09_drawings(spark: SparkSession, d: str) -> DataFrame:
    drawn = exports.drawings(exports.image_segments(*feeds_graph(spark, d), "feed_id"), "feed_id")
    return drawn.select("feed_id", F.regexp_count("svg", F.lit("<line ")).cast("long").alias("n"))
