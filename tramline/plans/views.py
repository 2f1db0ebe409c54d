"""Schedule tables derived from the driver's star schema. The same SQL text runs in Spark and DuckDB, so DuckDB can check every operator."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["supplier", "part", "orders", "lineitem", "events", "customer"]

#: Keys of the star schema are dealt to three feeds, so that equal local ids occur in all of them.
FEED = "concat('f', CAST({0} % 3 AS STRING)) AS feed_id"
LOCAL = "concat('{1}', CAST(CAST(floor({0} / 3) AS INT) AS STRING))"
TRIP_SERVICE = "concat(substr(o_orderpriority, 1, 1), '_', CAST(o_custkey % 4 AS STRING))"

VIEWS: dict[str, str] = {
    "g_stops": f"""SELECT {FEED.format('s_suppkey')}, {LOCAL.format('s_suppkey', 'S')} AS stop_id, concat('Stop ', CAST(s_suppkey % 51 AS STRING)) AS stop_name,
 CASE WHEN s_suppkey % 37 = 5 THEN NULL WHEN s_suppkey % 41 = 7 THEN 0.0e0 ELSE 45.0e0 + (s_suppkey % 51) * 0.11e0 + floor(s_suppkey / 51) * 0.0012e0 END AS stop_lat,
 CASE WHEN s_suppkey % 41 = 7 THEN 0.0e0 ELSE -122.0e0 + ((s_suppkey % 51) % 7) * 0.31e0 END AS stop_lon,
 CASE WHEN floor(s_suppkey / 3) % 5 = 4 THEN {LOCAL.format('(s_suppkey - 3)', 'S')} END AS parent_station, s_suppkey AS row_idx FROM supplier""",
    "g_routes": f"""SELECT {FEED.format('p_partkey')}, {LOCAL.format('p_partkey', 'R')} AS route_id, p_brand AS agency_id, p_name AS route_short_name, p_type AS route_long_name,
 CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_size <= 13 THEN p_size ELSE p_size * 30 END AS route_type, substr(p_brand, 7, 2) AS route_color, p_partkey AS row_idx FROM part""",
    "g_trips": f"""SELECT {FEED.format('o_orderkey')}, {LOCAL.format('o_orderkey', 'T')} AS trip_id, concat('R', CAST(o_custkey % 700 AS STRING)) AS route_id,
 {TRIP_SERVICE} AS service_id, o_orderkey AS row_idx FROM orders""",
    "g_stop_times": f"""SELECT {FEED.format('l_orderkey')}, {LOCAL.format('l_orderkey', 'T')} AS trip_id, {LOCAL.format('l_suppkey', 'S')} AS stop_id,
 CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE concat(lpad(CAST(CAST(floor(m / 60) AS INT) AS STRING), 2, '0'), ':', lpad(CAST(m % 60 AS STRING), 2, '0'), ':30') END AS arrival_time,
 CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE concat(lpad(CAST(CAST(floor((m + l_linenumber % 3) / 60) AS INT) AS STRING), 2, '0'), ':', lpad(CAST((m + l_linenumber % 3) % 60 AS STRING), 2, '0'), ':00') END AS departure_time,
 l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey % 100000 AS row_idx FROM (SELECT *, (l_orderkey % 24) * 60 + l_linenumber * 29 + CAST(l_quantity AS INT) % 17 AS m FROM lineitem) b""",
    "g_calendar_dates": f"""SELECT {FEED.format('o_orderkey')}, {TRIP_SERVICE} AS service_id, CAST(o_orderdate AS DATE) AS date,
 CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS exception_type, o_orderkey AS row_idx FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 4 <> 3""",
    "g_calendar": f"""SELECT feed_id, service_id, CASE WHEN (k + j) % 3 = 0 THEN 0 ELSE 1 END AS monday, k % 2 AS tuesday, 1 - k % 2 AS wednesday, CASE WHEN j = 2 THEN 1 ELSE 0 END AS thursday,
 CASE WHEN k > 2 THEN 1 ELSE 0 END AS friday, CASE WHEN j = 1 THEN 1 ELSE 0 END AS saturday, CASE WHEN k = 5 AND j = 1 OR feed_id = 'f2' THEN 1 ELSE 0 END AS sunday,
 concat('1996', lpad(CAST(k AS STRING), 2, '0'), '01') AS start_date, CASE WHEN k = 4 THEN NULL ELSE concat('1997', lpad(CAST(j + 3 AS STRING), 2, '0'), '28') END AS end_date, k * 10 + j AS row_idx
 FROM (SELECT DISTINCT {FEED.format('o_orderkey')}, {TRIP_SERVICE} AS service_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS k, CAST(o_custkey % 4 AS INT) AS j FROM orders) x""",
    "g_feed_spans": """SELECT concat('f', CAST(user_id AS STRING)) AS feed_id, min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date FROM events WHERE event_type = 'purchase' AND value > 60 GROUP BY user_id""",
    "g_feed_dates": """SELECT DISTINCT concat('f', CAST(user_id AS STRING)) AS feed_id, concat('s', CAST(event_id % 3 AS STRING)) AS service_id, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'purchase' AND value > 60""",
    # helpers of the checking SQL
    "v_st": """SELECT feed_id, trip_id, stop_id, row_idx, CAST(floor((am + dm) / 2) AS INT) AS minute FROM (SELECT *, CAST(substr(arrival_time,1,2) AS INT)*60 + CAST(substr(arrival_time,4,2) AS INT) AS am,
 CAST(substr(departure_time,1,2) AS INT)*60 + CAST(substr(departure_time,4,2) AS INT) AS dm FROM g_stop_times WHERE arrival_time IS NOT NULL) x""",
    "v_ok": "SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY row_idx) - 1 AS number, row_number() OVER (ORDER BY feed_id, row_idx) - 1 AS gid FROM g_stops WHERE stop_lat IS NOT NULL AND NOT (stop_lat = 0 AND stop_lon = 0)",
    "v_lines": "SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY row_idx) - 1 AS line_id, row_number() OVER (ORDER BY feed_id, row_idx) - 1 AS gline, concat(feed_id, ':', agency_id) AS agency FROM g_routes",
    "v_joined": """SELECT coalesce(b.feed_id, e.feed_id) AS feed_id, coalesce(b.service_id, e.service_id) AS service_id, coalesce(b.date, e.date) AS date FROM
 (SELECT feed_id, service_id, date FROM (SELECT *, CAST(unnest(generate_series(strptime(start_date, '%Y%m%d'), coalesce(strptime(end_date, '%Y%m%d'), TIMESTAMP '2099-12-31'), INTERVAL 1 DAY)) AS DATE) AS date FROM g_calendar
   WHERE 1 IN (monday, tuesday, wednesday, thursday, friday, saturday, sunday)) x
  WHERE [monday, tuesday, wednesday, thursday, friday, saturday, sunday][isodow(date)] = 1) b
 FULL JOIN (SELECT feed_id, service_id, date, max_by(exception_type, row_idx) AS k FROM g_calendar_dates GROUP BY feed_id, service_id, date) e ON b.feed_id = e.feed_id AND b.service_id = e.service_id AND b.date = e.date
 WHERE e.k = 1 OR (e.k IS NULL AND b.service_id IS NOT NULL)""",
    "v_days": "SELECT feed_id, service_id, list_sort(list(DISTINCT isodow(date) - 1)) AS days FROM v_joined GROUP BY feed_id, service_id",
    "v_visits": """SELECT feed_id, r.line_id, t.trip_id, t.service_id, s.minute, p.number AS stop, p.stop_id, row_number() OVER (PARTITION BY feed_id, t.trip_id ORDER BY s.minute, s.row_idx, p.number) AS pos
 FROM v_st s JOIN g_trips t USING (feed_id, trip_id) JOIN v_lines r USING (feed_id, route_id) JOIN v_ok p USING (feed_id, stop_id)""",
    "v_trip": "SELECT feed_id, trip_id, any_value(line_id) AS line_id, any_value(service_id) AS service_id, list(stop ORDER BY pos) AS stops, list(minute ORDER BY pos) AS times FROM v_visits GROUP BY feed_id, trip_id HAVING count(*) >= 2",
    "v_pattern": "SELECT feed_id, line_id, stops, times, list_sort(list_distinct(flatten(list(days)))) AS days FROM v_trip JOIN v_days USING (feed_id, service_id) GROUP BY feed_id, line_id, stops, times",
    "v_seg": """SELECT feed_id, line_id, stops[i] AS a, stops[i + 1] AS b, (times[i + 1] - times[i] + 1440) % 1440 AS w FROM (SELECT *, unnest(range(1, len(stops))) AS i FROM v_pattern) x""",
    "v_edges": "SELECT feed_id, a, b, min(w) AS w FROM v_seg GROUP BY feed_id, a, b",
    # the graph of all feeds
    "v_off": "SELECT feed_id, min(gid) AS off FROM v_ok GROUP BY feed_id",
    "v_gedges": "SELECT a + off AS a, b + off AS b, w FROM v_edges JOIN v_off USING (feed_id)",
    "v_gpattern": "SELECT l.gline AS line_id, list_transform(p.stops, lambda x: x + o.off) AS stops, times, days FROM v_pattern p JOIN v_off o USING (feed_id) JOIN v_lines l USING (feed_id, line_id)",
}


def with_views(sql: str) -> str:
    """The statement with the views that it uses, and those that they use, in front as CTEs."""
    used, todo = set(), re.findall(r"\w+", sql)
    while todo:
        if (name := todo.pop()) in VIEWS and name not in used:
            used.add(name)
            todo += re.findall(r"\w+", VIEWS[name])
    once = lambda name: "MATERIALIZED " if name.startswith("v_") else ""  # noqa: E731  recursive statements would make them again and again
    head = ",\n".join(f"{name} AS {once(name)}({text})" for name, text in VIEWS.items() if name in used)
    sql = sql.strip()
    if not head:
        return sql
    if sql.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{sql[14:]}"
    return f"WITH {head},\n{sql[4:]}" if sql.upper().startswith("WITH") else f"WITH {head}\n{sql}"


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; it reads only the base tables that it names."""
    text = VIEWS[name]
    for base in BASE:
        if re.search(rf"\bFROM {base}\b", text):
            frame(spark, sf_dir, base).createOrReplaceTempView(f"tramline_{base}")
            text = re.sub(rf"\bFROM {base}\b", f"FROM tramline_{base}", text)
    return spark.sql(text)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The schedule tables of three feeds."""
    return {n: view(spark, sf_dir, f"g_{n}") for n in ("stops", "routes", "trips", "stop_times", "calendar", "calendar_dates")}
