"""Schedule feeds: zip archives of CSV files as tables keyed by feed_id and row_idx (file order). All columns are text."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.storage import remembered, ship

#: The files and columns that the engine reads.
COLUMNS = {
    "stops.txt": "stop_id stop_name stop_lat stop_lon parent_station".split(),
    "routes.txt": "route_id route_short_name route_long_name route_color route_type agency_id".split(),
    "agency.txt": "agency_id agency_timezone".split(),
    "trips.txt": "trip_id route_id service_id".split(),
    "stop_times.txt": "trip_id arrival_time departure_time stop_id".split(),
    "calendar.txt": "service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date".split(),
    "calendar_dates.txt": "service_id date exception_type".split(),
}
BATCH = 20_000


class FeedVersion(NamedTuple):
    """A state of the feed index."""

    name: str
    git_hash: str
    repo: str


class Unreadable(ValueError):
    """A file that can't be read as a table; the feed has it as missing."""


def rows_of(raw: bytes) -> Iterator[dict[str, str | None]]:
    """Rows of a CSV file, UTF-8 or else Latin-1; header names are trimmed, blanks are null. A row longer than the header makes the file unreadable."""
    try:
        text = raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
    lines = csv.reader(io.StringIO(text, newline=""))
    header = [h.strip() for h in next(lines, [])]
    for line in lines:
        if not line:
            continue
        if len(line) > len(header):
            raise Unreadable("a row is longer than the header")
        yield {h: (v if v != "" else None) for h, v in zip(header, line, strict=False)}


def member(archive: zipfile.ZipFile, name: str) -> bytes | None:
    """The file of that name in any folder; two of them are an error."""
    found = [n for n in archive.namelist() if n.rsplit("/", 1)[-1] == name]
    if len(found) > 1:
        raise ValueError(f"more than one {name}")
    return archive.read(found[0]) if found else None


def feed_of(path: str) -> str:
    return re.sub(r"\.zip$", "", path.rsplit("/", 1)[-1])


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archives; one row and task unit an archive."""
    ship(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path).select("path", "content")


def feed_status(archives: DataFrame) -> DataFrame:
    """(feed_id, status, reason): success, or failure with its reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                reason = None
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        for name in COLUMNS:
                            member(z, name)
                except zipfile.BadZipFile:
                    reason = "bad zip file"
                except ValueError as e:
                    reason = str(e)
                out.append((feed_of(path), "failure" if reason else "success", reason))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(3)], names=["feed_id", "status", "reason"])

    return archives.mapInArrow(run, "feed_id string, status string, reason string")


def all_failures(status: DataFrame) -> DataFrame:
    return status.filter("status = 'failure'").select("feed_id", "reason")


def table(archives: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """One file of all feeds: (feed_id, row_idx, columns...). Feeds without it, or where it can't be read, have no rows."""
    columns = columns or COLUMNS[name]
    names = ["feed_id", "row_idx", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(feed: str, start: int, rows: list[dict]) -> pa.RecordBatch:
            made = [pa.array([feed] * len(rows), pa.string()), pa.array(range(start, start + len(rows)), pa.int64())]
            return pa.RecordBatch.from_arrays([*made, *(pa.array([r.get(c) for r in rows], pa.string()) for c in columns)], names=names)

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        raw = member(z, name)
                    if raw is None:
                        continue
                    for _ in rows_of(raw):  # an unreadable file gives no rows at all
                        pass
                    held, start = [], 0
                    for row in rows_of(raw):
                        held.append(row)
                        if len(held) == BATCH:
                            yield emit(feed_of(path), start, held)
                            held, start = [], start + BATCH
                    if held:
                        yield emit(feed_of(path), start, held)
                except (zipfile.BadZipFile, ValueError):
                    continue

    schema = ", ".join(["feed_id string", "row_idx long", *(f"{c} string" for c in columns)])
    return archives.mapInArrow(run, schema)


def read_feeds(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables of all archives under the path, by name without .txt."""
    archives = files(spark, path)
    return {name.removesuffix(".txt"): table(archives, name) for name in COLUMNS}


class BadStatus(Exception):
    """An answer other than 200, with its code and content."""

    def __init__(self, code: int, content: bytes = b"") -> None:
        super().__init__(f"status code {code}; content: {content!r}")


#: What can go wrong while fetching, and the reason that is recorded.
FETCH_REASONS = [(TimeoutError, "timeout"), (ConnectionError, "connection error"), ((zlib.error, UnicodeDecodeError), "content decoding error"), (EOFError, "chunked encoding error")]


def fetch(feeds: DataFrame, get: Callable[[str], bytes], cached: DataFrame | None = None) -> DataFrame:
    """(feed_id, path, content, status, reason) of feeds (feed_id): from the cached archives (path, content), or by ``get`` on the executors.

    ``get`` gives the archive of a feed, or raises one of the known errors, which become failures; other errors end the job.
    """
    ship(feeds.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["feed_id", "path", "content", "status", "reason"]
        for batch in batches:
            for feed in batch.column(0).to_pylist():
                content, reason = None, None
                try:
                    content = get(feed)
                except BadStatus as e:
                    reason = str(e)
                except tuple(k for kinds, _ in FETCH_REASONS for k in (kinds if isinstance(kinds, tuple) else (kinds,))) as e:
                    reason = next(text for kinds, text in FETCH_REASONS if isinstance(e, kinds))
                row = feed, f"{feed}.zip", content, "failure" if reason else "success", reason
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if n == "content" else pa.string()) for n, v in zip(names, row, strict=True)], names=names)

    schema = "feed_id string, path string, content binary, status string, reason string"
    wanted = feeds.select("feed_id")
    if cached is None:
        return wanted.mapInArrow(run, schema)
    known = cached.select(F.regexp_extract("path", r"([^/]*?)(?:\.zip)?$", 1).alias("feed_id"), "path", "content")
    kept = wanted.join(known, "feed_id").select("feed_id", "path", "content", F.lit("success").alias("status"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(wanted.join(known.select("feed_id"), "feed_id", "left_anti").mapInArrow(run, schema))


def api_key(path: str) -> str:
    """The key for a fetcher, from a text file of the user's."""
    with open(path) as f:
        return f.read().strip()


def gtfs_list(spark: SparkSession, version: FeedVersion, listing: Callable[[FeedVersion], DataFrame], base: str) -> DataFrame:
    """Paths of feed specifications of a version of the index; kept under ``base``, by name and hash, so another hash is listed anew."""
    return remembered(spark, f"{base}/{version.name}/feed_paths/{version.git_hash}", lambda: feed_paths(listing(version)).coalesce(1))


def feed_paths(listing: DataFrame) -> DataFrame:
    """Paths of feed specifications in a listing of the index (path)."""
    return listing.filter(F.col("path").startswith("feeds/")).select("path")


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """(spec, feed): the feeds that specification files name, one row each, as parsed JSON."""
    specs = spark.read.option("multiLine", "true").json(path)
    return specs.select(F.input_file_name().alias("spec"), F.explode("feeds").alias("feed"))


def read_components(spark: SparkSession, path: str) -> DataFrame:
    """(component, feed_id) from a JSON file {"components": [[feed, ...], ...]}."""
    df = spark.read.schema("components array<array<string>>").option("multiLine", "true").json(path)
    return df.select(F.posexplode("components").alias("component", "feeds")).select("component", F.explode("feeds").alias("feed_id"))


def national_stations() -> DataFrame:
    """Railway stations from an online map service: a plug-in point."""
    raise NotImplementedError("no map service is configured; register a source of (name, lat, lon)")
