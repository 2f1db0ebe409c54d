"""Transit network analytics on Spark.

The names that users of schedule tools know, over DataFrames keyed by feed_id; see the modules for the rest.
"""

from tramline.functions.dates import MINUTES_PER_DAY, local_minutes_to_week_minutes_utc, minutes_from_week_start, parse_date, parse_time, time_to_minutes_from_midnight
from tramline.functions.geo import haversine_km, haversine_m
from tramline.functions.routes import is_bus_or_ferry_route_type, is_route_type
from tramline.operators.calendar import joined_calendar_dates, standardize_calendars
from tramline.operators.calendar import shifted_dates as duplicate_and_shift_calendar
from tramline.operators.combine import combine as combine_graphs
from tramline.operators.combine import write_graph as write_feed_graph
from tramline.operators.feed_graph import build_feed_graph, valid_routes, valid_trips
from tramline.operators.feed_graph import trip_stop_times as compute_trip_stop_times
from tramline.operators.point_reduce import reduce_points
from tramline.operators.reach import cell_subgraphs, reachable_by_cell
from tramline.operators.spatial import proximity_graph as build_proximity_graph
from tramline.operators.stops import all_stops, collect_stops, standardized_stops
from tramline.operators.stops import pull_stops as pull_stops_for_gtfs
from tramline.sources.gtfs import FeedVersion, all_failures, national_stations
from tramline.sources.gtfs import feed_paths as gtfs_list
from tramline.sources.gtfs import read_feeds as read_gtfs
from tramline.sources.gtfs import read_specs as all_gtfs_info

__all__ = [
    "MINUTES_PER_DAY", "FeedVersion", "all_failures", "all_gtfs_info", "all_stops", "build_feed_graph", "build_proximity_graph", "cell_subgraphs", "collect_stops", "combine_graphs", "compute_trip_stop_times",
    "duplicate_and_shift_calendar", "gtfs_list", "haversine_km", "haversine_m", "is_bus_or_ferry_route_type", "is_route_type", "joined_calendar_dates", "local_minutes_to_week_minutes_utc", "minutes_from_week_start",
    "national_stations", "parse_date", "parse_time", "pull_stops_for_gtfs", "reachable_by_cell", "read_gtfs", "reduce_points", "standardize_calendars", "standardized_stops", "time_to_minutes_from_midnight", "valid_routes",
    "valid_trips", "write_feed_graph",
]
