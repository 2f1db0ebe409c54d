"""Tables for maps: points with agencies, lines as WKT, GeoJSON features, and coloured segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.routes import color_index
from tramline.operators.feed_graph import distinct_edges

NAME_LENGTH = 80


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def stop_agency(journeys: DataFrame, lines: DataFrame, *keys: str) -> DataFrame:
    """(keys..., stop_id, agency): the smallest agency name of the journeys through a stop."""
    visits = journeys.select(*keys, "line_id", F.explode("stops").alias("stop_id")).distinct()
    named = visits.join(lines.select(*keys, "line_id", "agency_id"), [*keys, "line_id"], "left")
    return named.groupBy(*keys, "stop_id").agg(F.min(F.coalesce("agency_id", F.lit(""))).alias("agency"))


def export_points(stops: DataFrame, lines: DataFrame, journeys: DataFrame) -> DataFrame:
    """(feed_id, stop_id, name, agency, wkt) of all feeds."""
    agency = stop_agency(journeys, lines, "feed_id")
    out = stops.join(agency, ["feed_id", "stop_id"], "left")
    return out.select("feed_id", "stop_id", F.substring(F.coalesce("name", F.lit("")), 1, NAME_LENGTH).alias("name"), F.coalesce("agency", F.lit("")).alias("agency"), point_wkt(F.col("lon"), F.col("lat")).alias("wkt"))


def placed_edges(stops: DataFrame, lines: DataFrame, journeys: DataFrame, *keys: str) -> DataFrame:
    """Distinct edges with both ends' coordinates, line name and agency; edges without coordinates go."""
    end = lambda p: stops.select(*keys, F.col("stop_id").alias(p), F.col("lon").alias(f"{p}_lon"), F.col("lat").alias(f"{p}_lat"))
    edges = distinct_edges(journeys, *keys).join(end("a"), [*keys, "a"]).join(end("b"), [*keys, "b"])
    named = edges.join(lines.select(*keys, "line_id", F.col("name").alias("line_name"), "agency_id"), [*keys, "line_id"], "left")
    return named.withColumn("agency_id", F.coalesce("agency_id", F.lit("")))


def _pair(open_: str, close: str, comma: str) -> Column:
    at = lambda p: F.concat(F.lit(open_), F.col(f"{p}_lon").cast("string"), F.lit(comma), F.col(f"{p}_lat").cast("string"), F.lit(close))
    return F.concat(at("a"), F.lit(", " if open_ == "" else ","), at("b"))


def agency_lines(edges: DataFrame, *keys: str) -> DataFrame:
    """(keys..., agency_id, n, wkt): one MULTILINESTRING an agency."""
    part = F.concat(F.lit("("), _pair("", "", " "), F.lit(")"))
    grouped = edges.groupBy(*keys, "agency_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(part)).alias("parts"))
    return grouped.select(*keys, "agency_id", "n", F.concat(F.lit("MULTILINESTRING ("), F.concat_ws(", ", "parts"), F.lit(")")).alias("wkt"))


def with_component(df: DataFrame, components: DataFrame) -> DataFrame:
    """Rows of feeds that belong to a component (component, feed_id)."""
    return df.join(components.select("component", "feed_id"), "feed_id")


def component_agency_segments(stops: DataFrame, lines: DataFrame, journeys: DataFrame, components: DataFrame) -> DataFrame:
    """(component, agency_id, n, wkt) over the feeds of each component."""
    return agency_lines(with_component(placed_edges(stops, lines, journeys, "feed_id"), components), "component")


def _feature(geometry: Column, **properties: Column) -> Column:
    values = F.to_json(F.struct(*[v.alias(k) for k, v in properties.items()]), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type":"Feature","properties":'), values, F.lit(',"geometry":'), geometry, F.lit("}"))


def point_features(stops: DataFrame) -> Column | DataFrame:
    """(cell..., feature): GeoJSON points with minutes."""
    at = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]}"))
    return stops.withColumn("feature", _feature(at, stop_id=F.col("stop_id"), name=F.coalesce("name", F.lit("")), minutes_used=F.coalesce("minutes_used", F.lit(0))))


def line_features(edges: DataFrame) -> DataFrame:
    """(..., feature): one GeoJSON line a segment."""
    at = F.concat(F.lit('{"type":"LineString","coordinates":['), _pair("[", "]", ","), F.lit("]}"))
    return edges.withColumn("feature", _feature(at, agency_id=F.col("agency_id")))


def write_geojson(features: DataFrame, path: str, *by: str) -> None:
    """Newline-delimited features, a folder for each value of ``by``."""
    out = features.select(*by, F.col("feature").alias("value")).write.mode("overwrite")
    (out.partitionBy(*by) if by else out).text(path)


def image_segments(stops: DataFrame, lines: DataFrame, journeys: DataFrame, *keys: str) -> DataFrame:
    """Segments with a colour index 0 to 255 by the line's name: what a drawing needs."""
    edges = placed_edges(stops, lines, journeys, *keys)
    return edges.select(*keys, "a_lon", "a_lat", "b_lon", "b_lat", "line_id", color_index(F.col("line_name"), F.col("line_id")).alias("color"))


def drawings(segments: DataFrame, *keys: str) -> DataFrame:
    """(keys..., svg): a drawing of all segments of a feed or cell, its colours on a wheel of 256 hues; north is up. A drawing holds one feed whole."""
    line = F.concat(
        F.lit('<line x1="'), F.round("a_lon", 5).cast("string"), F.lit('" y1="'), F.round(-F.col("a_lat"), 5).cast("string"), F.lit('" x2="'), F.round("b_lon", 5).cast("string"),
        F.lit('" y2="'), F.round(-F.col("b_lat"), 5).cast("string"), F.lit('" stroke="hsl('), F.round(F.col("color") * 360 / 256).cast("int").cast("string"), F.lit(',80%,45%)"/>'),
    )
    box = [F.round(f(F.least(a, b) if f is F.min else F.greatest(a, b)), 5) for f in (F.min, F.max) for a, b in (("a_lon", "b_lon"), (-F.col("a_lat"), -F.col("b_lat")))]
    whole = segments.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(line)), "").alias("lines"), *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)])
    frame = F.concat_ws(" ", "x0", "y0", F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return whole.select(*keys, F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" stroke-width="0.1%" viewBox="'), frame, F.lit('">'), F.col("lines"), F.lit("</svg>")).alias("svg"))
