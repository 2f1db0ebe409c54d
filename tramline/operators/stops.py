"""Stops over all feeds: parents, clusters of stops with one name, and one list of places."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.routes import blank, is_bus_or_ferry_route_type, safe_double
from tramline.functions.storage import stored
from tramline.operators.components import components
from tramline.operators.feed_graph import Predicate, column, covered_stops
from tramline.operators.spatial import ellipse_pairs

CLUSTER_M = 250.0


def collect_stops(stops: DataFrame) -> DataFrame:
    return stops.select("feed_id", "stop_id", F.col("stop_lat"), F.col("stop_lon"))


def with_parents(stops: DataFrame) -> DataFrame:
    """A blank parent is none; a blank stop id is an error."""
    bad = F.raise_error(F.lit("a stop has no stop_id")).cast("string")
    return stops.select(
        "feed_id", F.when(blank(F.col("stop_id")).isNotNull(), F.col("stop_id")).otherwise(bad).alias("stop_id"), column(stops, "stop_name").alias("stop_name"),
        safe_double(F.col("stop_lat")).alias("lat"), safe_double(F.col("stop_lon")).alias("lon"), blank(column(stops, "parent_station")).alias("parent_station"), "row_idx",
    )


def rolled_up(stops: DataFrame, covered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Covered stops, those with a covered parent replaced by it; and the remap (feed_id, stop_id, parent_station)."""
    own = stops.join(covered, ["feed_id", "stop_id"], "left_semi")
    parents = own.select("feed_id", F.col("stop_id").alias("parent_station")).distinct()
    with_parent = own.join(parents, ["feed_id", "parent_station"], "left_semi")
    without = own.join(parents, ["feed_id", "parent_station"], "left_anti")
    needed = with_parent.select("feed_id", F.col("parent_station").alias("stop_id")).distinct()
    added = stops.join(needed, ["feed_id", "stop_id"], "left_semi")
    return without.select(*stops.columns).unionByName(added), with_parent.select("feed_id", "stop_id", "parent_station")


def name_clusters(stops: DataFrame) -> DataFrame:
    """Stops whose name occurs more than once in their feed; nameless stops count as having one name."""
    n = F.count("*").over(Window.partitionBy("feed_id", "stop_name"))
    return stops.withColumn("n", n).filter("n > 1").drop("n")


def numbered(stops: DataFrame, name: str) -> DataFrame:
    """Adds dense numbers over all feeds: a feed's offset plus the place in the feed, so rows are never sorted over all feeds."""
    local = stops.withColumn("local", F.row_number().over(Window.partitionBy("feed_id").orderBy("row_idx", "stop_id")) - 1)
    sizes = local.groupBy("feed_id").agg(F.count("*").alias("n"))
    offsets = sizes.select("feed_id", (F.sum("n").over(Window.orderBy("feed_id")) - F.col("n")).alias("offset"))  # one row a feed
    return local.join(offsets, "feed_id").withColumn(name, (F.col("offset") + F.col("local")).cast("long")).drop("local", "offset")


def cluster_roots(stops: DataFrame, radius_m: float = CLUSTER_M) -> DataFrame:
    """(id, root): connected groups of equally named stops near each other. ``stops`` has a unique id in file order."""
    links = ellipse_pairs(stops.select("id", "lat", "lon", "feed_id", "stop_name"), radius_m / 1000, ["feed_id", "stop_name"])
    return components(links.select(F.col("i").alias("a"), F.col("j").alias("b")))


def deduplicate_stops(stops: DataFrame, radius_m: float = CLUSTER_M) -> tuple[DataFrame, DataFrame]:
    """(stops, remap): each cluster becomes its first stop at the mean position; remap is (feed_id, stop_id, exemplar)."""
    own = stored(numbered(stops, "id"))
    marked = own.join(cluster_roots(own, radius_m), "id", "left").withColumn("cluster", F.coalesce("root", "id"))
    mean = marked.groupBy("feed_id", "cluster").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.min_by(F.struct("stop_id", "stop_name", "parent_station", "row_idx"), "id").alias("first"), F.count("*").alias("n"))
    out = mean.select("feed_id", "first.stop_id", "first.stop_name", "lat", "lon", "first.parent_station", "first.row_idx", "n")
    exemplar = mean.select(F.col("feed_id").alias("m_feed"), F.col("cluster").alias("m"), F.col("first.stop_id").alias("exemplar"))
    remap = marked.join(exemplar, (F.col("feed_id") == F.col("m_feed")) & (F.col("cluster") == F.col("m"))).filter(F.col("stop_id") != F.col("exemplar"))
    return out, remap.select("feed_id", "stop_id", "exemplar").distinct()


def pull_stops(tables: dict[str, DataFrame], invalid: Predicate) -> tuple[DataFrame, DataFrame]:
    """Deduplicated served stops of all feeds, and where every stop went: (feed_id, stop_id, exemplar), through parents too."""
    every = with_parents(tables["stops"])
    covered = covered_stops(tables["stop_times"], tables["trips"], tables["routes"], invalid)
    rolled, parents = rolled_up(every, covered)
    rolled = rolled.dropDuplicates(["feed_id", "stop_id", "row_idx"])
    out, remap = deduplicate_stops(rolled)
    via = remap.select(F.col("feed_id").alias("v_feed"), F.col("stop_id").alias("v_stop"), "exemplar")
    far = parents.join(via, (F.col("feed_id") == F.col("v_feed")) & (F.col("parent_station") == F.col("v_stop")), "left")
    far = far.select("feed_id", "stop_id", F.coalesce("exemplar", "parent_station").alias("exemplar"))
    kept = remap.join(far, ["feed_id", "stop_id"], "left_anti").unionByName(far)
    return out, kept


def numbered_stops(stops: DataFrame, remap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One list of places over all feeds, (idx, feed_id, stop_id, name, lat, lon), and (feed_id, stop_id, idx) of every stop; null where it has no place."""
    places = numbered(stops.filter("lat is not null and lon is not null"), "idx").select("idx", "feed_id", "stop_id", F.col("stop_name").alias("name"), "lat", "lon")
    own = places.select("feed_id", "stop_id", "idx")
    moved = remap.join(own.select("feed_id", F.col("stop_id").alias("exemplar"), "idx"), ["feed_id", "exemplar"], "left").select("feed_id", "stop_id", "idx")
    return places, own.join(moved, ["feed_id", "stop_id"], "left_anti").unionByName(moved)


def all_stops(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Places of all served stops."""
    return numbered_stops(*pull_stops(tables, lambda kind: F.lit(False)))


def standardized_stops(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Places of stops served by other than buses and ferries."""
    return numbered_stops(*pull_stops(tables, is_bus_or_ferry_route_type))
