"""Command line: python -m tramline.cli COMMAND --data-dir DIR ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tramline.functions.storage import clean, stored
from tramline.operators import combine, exports, reach
from tramline.operators.feed_graph import FeedGraph, build_feed_graph
from tramline.sources import gtfs


def build(spark: SparkSession, base: str) -> None:
    """Archives in DIR/feeds -> DIR/graphs, a partition for each feed."""
    combine.write_graph(build_feed_graph(gtfs.read_feeds(spark, f"{base}/feeds")), f"{base}/graphs", by=["feed_id"])


def merge(spark: SparkSession, base: str) -> None:
    """DIR/graphs -> DIR/combined."""
    combine.write_graph(combine.combine(combine.read_graph(spark, f"{base}/graphs")), f"{base}/combined")


def split(spark: SparkSession, base: str, cell: list[int] | None, rides_only: bool) -> None:
    """DIR/combined -> DIR/cells, a partition for each 1-degree cell, or one cell alone."""
    g = combine.read_graph(spark, f"{base}/combined")
    preset = {"buffer_km": 6.0, "walk_kmh": None, "inclusive": True} if rides_only else {}
    found = reach.reachable_by_cell(g.stops, g.journeys, cell=tuple(cell) if cell else None, **preset)
    journeys = stored(g.journeys.withColumn("journey_id", F.monotonically_increasing_id()))
    combine.write_graph(FeedGraph(*reach.cell_subgraphs(found, g.stops, g.lines, journeys)), f"{base}/cells", by=reach.CELL)


def points(spark: SparkSession, base: str) -> None:
    """DIR/graphs -> DIR/exports/points (CSV with WKT)."""
    exports.export_points(*combine.read_graph(spark, f"{base}/graphs")).write.mode("overwrite").option("header", True).csv(f"{base}/exports/points")


def geojson(spark: SparkSession, base: str) -> None:
    """DIR/cells -> DIR/geojson/points and /lines, a folder for each cell."""
    g = combine.read_graph(spark, f"{base}/cells")
    exports.write_geojson(exports.point_features(g.stops), f"{base}/geojson/points", *reach.CELL)
    exports.write_geojson(exports.line_features(exports.placed_edges(*g, *reach.CELL)), f"{base}/geojson/lines", *reach.CELL)


def populate(spark: SparkSession, base: str) -> None:
    """All steps from DIR/feeds to DIR/cells."""
    build(spark, base)
    merge(spark, base)
    split(spark, base, None, False)


def components(spark: SparkSession, base: str) -> None:
    """DIR/graphs and DIR/components.json -> DIR/exports/component_points and /component_lines (CSV with WKT)."""
    g, parts = combine.read_graph(spark, f"{base}/graphs"), gtfs.read_components(spark, f"{base}/components.json")
    for name, df in (("points", exports.with_component(exports.export_points(*g), parts)), ("lines", exports.component_agency_segments(*g, parts))):
        df.write.mode("overwrite").option("header", True).csv(f"{base}/exports/component_{name}")


def images(spark: SparkSession, base: str) -> None:
    """DIR/graphs -> DIR/exports/images: coloured segments of each feed, drawn as SVG."""
    segments = exports.image_segments(*combine.read_graph(spark, f"{base}/graphs"), "feed_id")
    exports.drawings(segments, "feed_id").select("feed_id", F.col("svg").alias("value")).write.mode("overwrite").partitionBy("feed_id").text(f"{base}/exports/images")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tramline", description=__doc__)
    p.add_argument("command", choices=["build", "combine", "split", "points", "geojson", "populate", "components", "images"])
    p.add_argument("--data-dir", required=True)
    p.add_argument("--cell", nargs=2, type=int, metavar=("LAT", "LON"))
    p.add_argument("--rides-only", action="store_true", help="no walking, from a buffered cell, budget included")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("tramline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "split":
        split(spark, a.data_dir, a.cell, a.rides_only)
    else:
        {"build": build, "combine": merge, "points": points, "geojson": geojson, "populate": populate, "components": components, "images": images}[a.command](spark, a.data_dir)
    clean(spark)


if __name__ == "__main__":
    main()
