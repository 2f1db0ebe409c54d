"""Connected components of a link table by alternating large-star and small-star steps, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.storage import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (id, root): the smallest id reachable, for every id with a link to another.

    A step is one aggregation and one join on the same key; a hub's links are never gathered in a list. The number of
    steps grows with the logarithm of the component size.
    """
    down = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(down(links))
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(low.filter("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(down(small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))))
        now = _state(edges)
        if now == state:
            break
        state = now
    # every edge now goes from a member to its root; the roots themselves are added
    members = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("root")), F.struct(F.col("b").alias("id"), F.col("b").alias("root")))
    return edges.select(F.explode(members).alias("m")).groupBy("m.id").agg(F.min("m.root").alias("root"))
