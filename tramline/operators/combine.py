"""One graph of all feeds: global dense ids from per-feed counts, and its chunked storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.functions.storage import setting, tidy
from tramline.operators.feed_graph import FeedGraph

MAX_ROWS_PER_FILE = 1_000_000
#: A task writes so many partitions side by side, each with a row group of so many bytes at most; rows of more partitions are sorted first.
WRITERS, ROW_GROUP = 32, 8 << 20


def offsets(df: DataFrame, name: str) -> DataFrame:
    """(feed_id, name): how many rows the feeds before have, by feed id. Only one row a feed is sorted."""
    sizes = df.groupBy("feed_id").agg(F.count("*").alias("n"))
    return sizes.select("feed_id", (F.sum("n").over(Window.orderBy("feed_id")) - F.col("n")).cast("int").alias(name))


def combine(graph: FeedGraph) -> FeedGraph:
    """Ids become the feed's offset plus the local id. Stops that a journey names but the feed lacks are dropped from its stops; an unknown line becomes 0;
    journeys of fewer than two stops go."""
    so, lo = offsets(graph.stops, "so"), offsets(graph.lines, "lo")
    stops = graph.stops.join(so, "feed_id").withColumn("global_id", F.col("so") + F.col("stop_id"))
    lines = graph.lines.join(lo, "feed_id").withColumn("global_line", F.col("lo") + F.col("line_id"))
    counts = graph.stops.groupBy("feed_id").agg(F.count("*").alias("n_stops"))
    line_counts = graph.lines.groupBy("feed_id").agg(F.count("*").alias("n_lines"))
    j = graph.journeys.join(so.join(counts, "feed_id"), "feed_id").join(lo.join(line_counts, "feed_id"), "feed_id", "left")
    known = F.filter("stops", lambda s: (s >= 0) & (s < F.col("n_stops")))
    j = j.withColumns({"stops": F.transform(known, lambda s: s + F.col("so")), "line_id": F.when(F.col("line_id").between(0, F.col("n_lines") - 1), F.col("lo") + F.col("line_id")).otherwise(0)})
    return FeedGraph(
        stops.select(F.col("global_id").alias("stop_id"), "name", "lat", "lon", F.lit(None).cast("int").alias("minutes_used"), "feed_id"),
        lines.select(F.col("global_line").alias("line_id"), "name", "color", "type_id", "agency_id", "feed_id"),
        j.filter(F.size("stops") >= 2).select("line_id", "stops", "times_within_day", "days", "feed_id"),
    )


def counts(graph: FeedGraph) -> DataFrame:
    """One row: n_stops, n_lines, n_journeys."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(graph.stops, "n_stops").crossJoin(one(graph.lines, "n_lines")).crossJoin(one(graph.journeys, "n_journeys"))  # single rows


def write_graph(graph: FeedGraph, path: str, max_rows: int = MAX_ROWS_PER_FILE, by: list[str] | None = None) -> None:
    """Parquet tables path/stops, path/lines and path/journeys in files of at most ``max_rows``; older content is replaced."""
    for name, df in graph._asdict().items():
        writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows)
        if by:
            writer = writer.partitionBy(*by).option("parquet.block.size", ROW_GROUP)
        with tidy(df.sparkSession), setting(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(WRITERS)):
            writer.parquet(f"{path}/{name}")


def read_graph(spark: SparkSession, path: str) -> FeedGraph:
    """A stored graph; journeys of fewer than two stops are left out. A missing table is an error."""
    stops, lines, journeys = (spark.read.parquet(f"{path}/{name}") for name in FeedGraph._fields)
    return FeedGraph(stops, lines, journeys.filter(F.size("stops") >= 2))
