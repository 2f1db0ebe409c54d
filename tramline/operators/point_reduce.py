"""Reduction of points to representatives within a distance, by joins and aggregations only.

Points stand in the order of their number of links (other points within two radii), ties by id. In that order, each point that is still free becomes the centre
of a cluster of the free points within one radius around it. A cluster's place is the mean of its members; members farther than a radius from it
are set free again until all are within. The centre always stays: the mean of points in a disc lies in the disc.

Two points that could claim the same member are linked, so a point may go as soon as no free point that it is linked to stands before it. All
such points go at once, wherever they are, and the result is that of going through the points one by one. No group of points is ever gathered in a task.

Points of one place have the same links and distances, so they are claimed and set free together, and the smallest id among them goes first: the rounds
work on distinct places that count as many times as they have points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m
from tramline.functions.storage import stored
from tramline.operators.spatial import close_places, members, places

MAX_M = 25.0
STEPS = 3


def _settled(group: DataFrame, max_m: float) -> DataFrame:
    """(centre, id, c_lat, c_lon): places (centre, id, lat, lon, weight) that stay with their centre, and the cluster's place."""
    while True:
        for _ in range(STEPS):
            mean = lambda c: F.degrees(F.sum(F.col("weight") * F.radians(c)) / F.sum("weight"))
            place = group.groupBy(F.col("centre").alias("at")).agg(mean("lat").alias("c_lat"), mean("lon").alias("c_lon"), F.count("*").alias("n"))
            both = group.select("centre", "id", "lat", "lon", "weight").join(place, F.col("centre") == F.col("at")).drop("at")
            group = both.filter(haversine_m(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon")) <= max_m)
        group = stored(group)
        if group.groupBy("centre", "n").agg(F.count("*").alias("left")).filter("left < n").isEmpty():
            return group.select("centre", "id", "c_lat", "c_lon")


def reduce_points(points: DataFrame, max_m: float = MAX_M) -> DataFrame:
    """(id, lat, lon) -> (id, rep, rep_lat, rep_lon): every point is within ``max_m`` of its representative. Ids are unique; points without a place are left out."""
    points = points.select("id", "lat", "lon")
    at = stored(places(points))
    near = haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) <= max_m
    links = close_places(at, 2 * max_m).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.col("a_n"), F.col("b_n"), near.alias("near"))
    links = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_n").alias("a_n"), F.col("a_n").alias("b_n"), "near")))
    # a place's points are linked to each other too; that counts for its place in the order
    degree = stored(links.groupBy(F.col("a").alias("id")).agg((F.sum("b_n") + F.first("a_n")).alias("degree")))
    first, second = (degree.select(F.col("id").alias(c), F.col("degree").alias(f"{c}_degree")) for c in "ab")
    before = (F.col("b_degree") > F.col("a_degree")) | (F.col("b_degree") == F.col("a_degree")) & (F.col("b") < F.col("a"))
    links = stored(links.join(first, "a").join(second, "b").select("a", "b", "near", before.alias("waits")))
    done, free = [], degree.select("id")
    while not free.isEmpty():
        # links between free places; a place that waits for none is a centre
        links = stored(links.join(free.select(F.col("id").alias("a")), "a", "left_semi").join(free.select(F.col("id").alias("b")), "b", "left_semi"))
        centres = free.join(links.filter("waits").select(F.col("a").alias("id")).distinct(), "id", "left_anti")
        around = links.filter("near").join(centres.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("a").alias("centre"), F.col("b").alias("id"))
        weighed = at.select("id", "lat", "lon", F.col("n").alias("weight"))
        done.append(_settled(around.unionByName(centres.select(F.col("id").alias("centre"), "id")).join(weighed, "id").select("centre", "id", "lat", "lon", "weight"), max_m))
        free = stored(free.join(done[-1].select("id"), "id", "left_anti"))
    found = at.join(degree, "id", "left_anti").select(F.col("id").alias("place"), F.col("id").alias("rep"), F.col("lat").alias("rep_lat"), F.col("lon").alias("rep_lon"))
    for round_ in done:
        found = found.unionByName(round_.select(F.col("id").alias("place"), F.col("centre").alias("rep"), F.col("c_lat").alias("rep_lat"), F.col("c_lon").alias("rep_lon")))
    return members(points, at).join(found, "place").select("id", "rep", "rep_lat", "rep_lon")


def representatives(reduced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(idx, lat, lon) of the representatives, numbered from 0 by id, and the mapping (id, idx). Only the representatives are sorted."""
    reps = reduced.filter("id = rep").select("rep", "rep_lat", "rep_lon").withColumn("idx", F.row_number().over(Window.orderBy("rep")) - 1)
    mapping = reduced.join(reps.select("rep", "idx"), "rep").select("id", "idx")
    return reps.select("idx", F.col("rep_lat").alias("lat"), F.col("rep_lon").alias("lon")), mapping
