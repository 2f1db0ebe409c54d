"""From schedule tables to graphs of stops, lines and journeys; all feeds at once, keyed by feed_id."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.dates import segment_minutes, stop_minute
from tramline.functions.routes import agency_key, blank, line_name, route_type_or_zero, safe_double
from tramline.operators.calendar import joined_calendar_dates, last_rows, service_weekdays


class FeedGraph(NamedTuple):
    stops: DataFrame
    lines: DataFrame
    journeys: DataFrame


def column(df: DataFrame, name: str) -> Column:
    """An optional column of a schedule file."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def number(df: DataFrame, name: str, order: str = "row_idx") -> DataFrame:
    """Adds dense numbers from 0 within each feed, in file order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy("feed_id").orderBy(order)) - 1)


def valid_stops(stops: DataFrame) -> DataFrame:
    """Stops with coordinates other than (0, 0): (feed_id, stop_id, name, lat, lon, row_idx); of equal ids the last row."""
    df = stops.select("feed_id", "stop_id", F.coalesce(column(stops, "stop_name"), F.lit("")).alias("name"), safe_double(F.col("stop_lat")).alias("lat"), safe_double(F.col("stop_lon")).alias("lon"), "row_idx")
    return last_rows(df.filter("lat is not null and lon is not null and not (lat = 0 and lon = 0)"), "feed_id", "stop_id")


def lines(routes: DataFrame) -> DataFrame:
    """Every route is a line, numbered by its row."""
    df = number(routes, "line_id")
    return df.select(
        "feed_id", "line_id", "route_id", line_name(column(routes, "route_short_name"), column(routes, "route_long_name")).alias("name"),
        F.trim(F.coalesce(column(routes, "route_color"), F.lit(""))).alias("color"), route_type_or_zero(column(routes, "route_type")).alias("type_id"),
        agency_key(F.col("feed_id"), column(routes, "agency_id")).alias("agency_id"), "row_idx",
    )


def timed_stops(stop_times: DataFrame) -> DataFrame:
    """(feed_id, trip_id, stop_id, minute, row_idx) of the stop times that can be read.

    The minute is made by a generator, so the optimiser can't repeat the parsing in a filter.
    """
    minute = stop_minute(F.col("arrival_time"), F.col("departure_time"))
    return stop_times.select("feed_id", "trip_id", "stop_id", F.explode(F.array_compact(F.array(minute))).alias("minute"), "row_idx")


def trip_stop_times(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """(feed_id, trip_id, service_id, stops array<struct<minute, row_idx, stop_id>>)."""
    known = last_rows(trips.select("feed_id", "trip_id", "service_id", "row_idx"), "feed_id", "trip_id").drop("row_idx")
    here = stop_times.join(known.select("feed_id", "trip_id"), ["feed_id", "trip_id"], "left_semi")
    grouped = timed_stops(here).groupBy("feed_id", "trip_id").agg(F.sort_array(F.collect_list(F.struct("minute", "row_idx", "stop_id"))).alias("stops"))
    return grouped.join(known, ["feed_id", "trip_id"])


def journey_patterns(stop_times: DataFrame, trips: DataFrame, line_of_route: DataFrame, days_of_service: DataFrame, stop_numbers: DataFrame) -> DataFrame:
    """(feed_id, line_id, stops, times_within_day, days, first_row): trips with equal line, stops and times are one journey.

    Unknown stops are left out before the arrays are made, so their neighbours become neighbours; a journey has two stops or more.
    """
    known = last_rows(trips.select("feed_id", "trip_id", "route_id", "service_id", "row_idx"), "feed_id", "trip_id").drop("row_idx")
    known = known.join(line_of_route, ["feed_id", "route_id"]).join(days_of_service.filter(F.size("days") > 0), ["feed_id", "service_id"])
    # one pass over the stop times, which are exchanged twice: by stop and, as numbers only, by trip for the trips that are known and the grouping;
    # unknown stops count for the first row only, as collect_list skips nulls
    timed = timed_stops(stop_times).join(stop_numbers, ["feed_id", "stop_id"], "left").select("feed_id", "trip_id", "minute", "row_idx", "number")
    timed = timed.join(known.select("feed_id", "trip_id"), ["feed_id", "trip_id"], "left_semi")
    visits = F.sort_array(F.collect_list(F.when(F.col("number").isNotNull(), F.struct("minute", "row_idx", "number"))))
    placed = timed.groupBy("feed_id", "trip_id").agg(visits.alias("s"), F.min("row_idx").alias("first_row")).filter(F.size("s") >= 2)
    trips_with = placed.join(known, ["feed_id", "trip_id"])
    pattern = trips_with.select("feed_id", "line_id", F.transform("s", lambda x: x["number"]).alias("stops"), F.transform("s", lambda x: x["minute"]).alias("times_within_day"), "days", "first_row")
    merged = pattern.groupBy("feed_id", "line_id", "stops", "times_within_day")
    return merged.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("days")))).alias("days"), F.min("first_row").alias("first_row"))


def compact(stops: DataFrame, journeys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Only the stops on a journey, renumbered from 0 in file order, and the journeys with the new numbers."""
    used = journeys.select("feed_id", F.explode("stops").alias("number")).distinct()
    kept = number(stops.join(used, ["feed_id", "number"], "left_semi"), "stop_id", "number")
    long = journeys.select("*", F.posexplode("stops").alias("pos", "number")).join(kept.select("feed_id", "number", "stop_id"), ["feed_id", "number"])
    keys = ["feed_id", "line_id", "stops", "times_within_day", "days", "first_row"]
    back = long.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "stop_id"))), lambda x: x["stop_id"]).alias("renumbered"))
    return kept, back.drop("stops").withColumnRenamed("renumbered", "stops")


def build_feed_graph(tables: dict[str, DataFrame]) -> FeedGraph:
    """Graphs of all feeds from their schedule tables (stops, routes, trips, stop_times, calendar, calendar_dates)."""
    stops = number(valid_stops(tables["stops"]), "number").withColumnRenamed("stop_id", "original_id")
    line = lines(tables["routes"])
    of_route = last_rows(line.select("feed_id", "route_id", "line_id", "row_idx"), "feed_id", "route_id").drop("row_idx")
    days = service_weekdays(joined_calendar_dates(tables.get("calendar"), tables.get("calendar_dates")))
    journeys = journey_patterns(tables["stop_times"], tables["trips"], of_route, days, stops.select("feed_id", F.col("original_id").alias("stop_id"), "number"))
    kept, journeys = compact(stops, journeys)
    return FeedGraph(
        kept.select("feed_id", "stop_id", "name", "lat", "lon", F.lit(None).cast("int").alias("minutes_used"), "original_id"),
        line.select("feed_id", "line_id", "name", "color", "type_id", "agency_id"),
        journeys.select("feed_id", "line_id", "stops", "times_within_day", "days", "first_row"),
    )


def segments(journeys: DataFrame, *keys: str) -> DataFrame:
    """One row per pair of consecutive stops: (keys..., line_id, a, b, w). Array functions only: no exchange."""
    pair = F.transform(
        F.sequence(F.lit(1), F.size("stops") - 1),
        lambda i: F.struct(F.element_at("stops", i).alias("a"), F.element_at("stops", i + 1).alias("b"), segment_minutes(F.element_at("times_within_day", i), F.element_at("times_within_day", i + 1)).alias("w")),
    )
    whole = journeys.filter((F.size("stops") == F.size("times_within_day")) & (F.size("stops") >= 2))
    return whole.select(*keys, "line_id", F.explode(pair).alias("p")).select(*keys, "line_id", "p.a", "p.b", "p.w")


def min_edges(journeys: DataFrame, *keys: str) -> DataFrame:
    """(keys..., a, b, w): shortest ride between neighbouring stops."""
    return segments(journeys, *keys).groupBy(*keys, "a", "b").agg(F.min("w").alias("w"))


def distinct_edges(journeys: DataFrame, *keys: str, loops: bool = False) -> DataFrame:
    """(keys..., a, b, line_id) without repetition; self-loops only on demand."""
    df = segments(journeys, *keys).select(*keys, "a", "b", "line_id")
    return (df if loops else df.filter("a <> b")).distinct()


def trip_timezones(trips: DataFrame, routes: DataFrame, agency: DataFrame) -> DataFrame:
    """(feed_id, trip_id, timezone): that of the route's agency; UTC where it is blank or unknown. A route without an agency uses the nameless one."""
    zones = last_rows(agency.select("feed_id", F.coalesce(blank(column(agency, "agency_id")), F.lit("default")).alias("agency"), F.coalesce(blank(column(agency, "agency_timezone")), F.lit("UTC")).alias("timezone"), "row_idx"), "feed_id", "agency").drop("row_idx")
    of_route = last_rows(routes.select("feed_id", "route_id", F.coalesce(blank(column(routes, "agency_id")), F.lit("default")).alias("agency"), "row_idx"), "feed_id", "route_id").drop("row_idx")
    known = of_route.join(zones, ["feed_id", "agency"], "left")
    return trips.select("feed_id", "trip_id", "route_id").join(known, ["feed_id", "route_id"], "left").select("feed_id", "trip_id", F.coalesce(F.trim("timezone"), F.lit("UTC")).alias("timezone"))


def used_stops(journeys: DataFrame, *keys: str) -> DataFrame:
    """(keys..., stop_id) on any journey."""
    return journeys.select(*keys, F.explode("stops").alias("stop_id")).distinct()


Predicate = Callable[[Column], Column]


def valid_routes(routes: DataFrame, invalid: Predicate) -> DataFrame:
    """(feed_id, route_id) of routes with a type that the predicate doesn't reject."""
    kind = safe_double(F.col("route_type"))
    return routes.filter(kind.isNotNull() & ~invalid(kind)).select("feed_id", "route_id").distinct()


def valid_trips(trips: DataFrame, routes: DataFrame, invalid: Predicate) -> DataFrame:
    return trips.join(valid_routes(routes, invalid), ["feed_id", "route_id"], "left_semi")


def covered_stops(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, invalid: Predicate) -> DataFrame:
    """(feed_id, stop_id) served by a valid trip."""
    on = valid_trips(trips, routes, invalid)
    return stop_times.join(on, ["feed_id", "trip_id"], "left_semi").select("feed_id", "stop_id").distinct()
