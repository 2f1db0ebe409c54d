"""Graphs as protocol-buffer messages: reading files, and messages as a binary column. The schema is built at run time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.storage import ship
from tramline.operators.feed_graph import FeedGraph, distinct_edges

#: The messages of the graph format, as (field, type, repeated); numbers count from 1.
MESSAGES = {
    "Stop": [("stop_id", "int32", False), ("name", "string", False), ("lat", "double", False), ("lon", "double", False), ("minutes_used", "int32?", False)],
    "Line": [("line_id", "int32", False), ("name", "string", False), ("color", "string", False), ("type_id", "int32", False), ("agency_id", "string", False)],
    "Journey": [("line_id", "int32", False), ("stops", "int32", True), ("times_within_day", "int32", True), ("days", "int32", True)],
    "Edge": [("start_stop_id", "int32", False), ("end_stop_id", "int32", False), ("line_id", "int32", False), ("mean_duration_minutes", "float", False)],
    "FeedGraph": [("stops", "Stop", True), ("lines", "Line", True), ("journeys", "Journey", True), ("edges", "Edge", True)],
}
STOP = "struct<stop_id:int,name:string,lat:double,lon:double,minutes_used:int>"
LINE = "struct<line_id:int,name:string,color:string,type_id:int,agency_id:string>"
JOURNEY = "struct<line_id:int,stops:array<int>,times_within_day:array<int>,days:array<int>>"


@cache
def message_class():
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    file = descriptor_pb2.FileDescriptorProto(name="tramline_graph.proto", package="graph", syntax="proto3")
    kinds = {"int32": 5, "string": 9, "double": 1, "float": 2}
    for name, fields in MESSAGES.items():
        m = file.message_type.add(name=name)
        for number, (field, kind, repeated) in enumerate(fields, 1):
            f = m.field.add(name=field, number=number, label=3 if repeated else 1)
            if kind.rstrip("?") in kinds:
                f.type = kinds[kind.rstrip("?")]
            else:
                f.type, f.type_name = 11, f".graph.{kind}"
            if kind.endswith("?"):
                m.oneof_decl.add(name=f"_{field}")
                f.proto3_optional, f.oneof_index = True, len(m.oneof_decl) - 1
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("graph.FeedGraph"))


def parse(content: bytes) -> dict:
    g = message_class()()
    g.ParseFromString(content)
    return {
        "stops": [{"stop_id": s.stop_id, "name": s.name, "lat": s.lat, "lon": s.lon, "minutes_used": s.minutes_used if s.HasField("minutes_used") else None} for s in g.stops],
        "lines": [{f: getattr(x, f) for f, _, _ in MESSAGES["Line"]} for x in g.lines],
        "journeys": [{"line_id": j.line_id, "stops": list(j.stops), "times_within_day": list(j.times_within_day), "days": list(j.days)} for j in g.journeys],
    }


#: Bytes of a message that are parsed at a time, about.
PIECE = 1 << 18


def pieces(content: bytes) -> Iterator[bytes]:
    """A message cut between its records: each piece is a message too, and all its fields are repeated ones, so the pieces together say the same."""
    start = at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while at < len(content):
            byte = content[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        return value

    while at < len(content):
        kind = varint() & 7
        if kind == 0:
            varint()
        elif kind in (1, 2, 5):
            length = {1: 8, 5: 4}.get(kind) or varint()  # which moves on, too
            at += length
        else:
            at = len(content)  # no record: the parser says what is wrong
        if at - start >= PIECE:
            yield content[start:at]
            start = at
    if start < len(content):
        yield content[start:]


def serialise(name: str, batch: pa.RecordBatch, fields: list[str]) -> bytes:
    """The batch's rows as records of the message's field ``name``."""
    message = message_class()()
    add = getattr(message, name).add
    for row in zip(*(batch.column(f).to_pylist() for f in fields), strict=True):
        add(**{f: v for f, v in zip(fields, row, strict=True) if v is not None})
    return message.SerializeToString()


def read_graph_files(spark: SparkSession, path: str, skip: str = r"^graphs_all") -> FeedGraph:
    """The graphs of all .pb files under the path; feed_id is the file's stem."""
    ship(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").load(path)
    return parsed(found.withColumn("feed_id", F.regexp_extract("path", r"([^/]*)\.pb$", 1)).filter(~F.col("feed_id").rlike(skip)).select("feed_id", "content"))


def parsed(messages: DataFrame) -> FeedGraph:
    """The graphs in messages (feed_id, content). A message is parsed piece by piece."""
    spark = messages.sparkSession
    ship(spark)
    schema = f"feed_id string, stops array<{STOP}>, lines array<{LINE}>, journeys array<{JOURNEY}>"
    ints = pa.list_(pa.int32())
    types = {
        "stops": [("stop_id", pa.int32()), ("name", pa.string()), ("lat", pa.float64()), ("lon", pa.float64()), ("minutes_used", pa.int32())],
        "lines": [("line_id", pa.int32()), ("name", pa.string()), ("color", pa.string()), ("type_id", pa.int32()), ("agency_id", pa.string())],
        "journeys": [("line_id", pa.int32()), ("stops", ints), ("times_within_day", ints), ("days", ints)],
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, c in zip(batch.column("feed_id").to_pylist(), batch.column("content"), strict=True):
                for piece in pieces(c.as_py()):
                    got = parse(piece)
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.string()), *(pa.array([got[n]], pa.list_(pa.struct(t))) for n, t in types.items())], names=["feed_id", *types])

    whole = messages.select("feed_id", "content").mapInArrow(run, schema)
    part = lambda c: whole.select("feed_id", F.explode(c).alias("x")).select("feed_id", "x.*")
    return FeedGraph(part("stops"), part("lines"), part("journeys"))


def _parts(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., kind, part, content): the rows in order as messages of a batch of rows each, numbered in that order."""
    kind, fields = list(FeedGraph._fields).index(name), [f for f, _, _ in MESSAGES[name.capitalize().removesuffix("s")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            of = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            starts = [i for i in range(len(of)) if not i or of[i] != of[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(of)], strict=True):
                content = serialise(name, batch.slice(a, b - a), fields)
                cols = [*(batch.column(k).slice(a, 1) for k in keys), pa.array([kind], pa.int32()), pa.array([part], pa.int64()), pa.array([content], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "kind", "part", "content"])
                part += 1

    schema = ", ".join([*(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys), "kind int, part long, content binary"])
    return df.select(*keys, *(f for f in fields if f not in keys)).orderBy(*keys, *fields).mapInArrow(run, schema)


def graph_messages(graph: FeedGraph, *keys: str) -> DataFrame:
    """(keys..., content): a message for each feed or cell with a stop. A message holds one feed or cell whole, as the format wants it.

    Its records are made in small parts all over the cluster, in order; only the bytes of a message come together in one task.
    """
    ship(graph.stops.sparkSession)
    parts = reduce(DataFrame.unionByName, (_parts(n, df, list(keys)) for n, df in graph._asdict().items()))
    parts = parts.join(graph.stops.select(*keys).distinct(), list(keys), "left_semi")
    schema = ", ".join([*(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys), "content binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, content = None, None, bytearray()
        row = lambda: pa.RecordBatch.from_arrays([*own, pa.array([bytes(content)], pa.binary())], names=[*keys, "content"])
        for batch in batches:
            of = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            for at, key in enumerate(of):
                if key != now:
                    if now is not None:
                        yield row()
                    now, own, content = key, [pa.array([batch.column(k)[at].as_py()], batch.column(k).type) for k in keys], bytearray()
                content += batch.column("content")[at].as_buffer()
        if now is not None:
            yield row()

    return parts.repartition(*keys).sortWithinPartitions(*keys, "kind", "part").select(*keys, "content").mapInArrow(run, schema)


def read_json_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A graph in one JSON file: stops, lines, journeys, and edges (a, b, line_id), which are derived where the file has none."""
    schema = f"stops array<{STOP}>, lines array<{LINE}>, journeys array<{JOURNEY}>, edges array<struct<start_stop_id:int,end_stop_id:int,line_id:int>>"
    whole = spark.read.schema(schema).option("multiLine", "true").json(path)
    part = lambda c: whole.select(F.explode(c).alias("x")).select("x.*")
    given = part("edges").select(F.col("start_stop_id").alias("a"), F.col("end_stop_id").alias("b"), "line_id").filter("a <> b")
    derived = distinct_edges(whole.filter("edges is null or size(edges) = 0").select(F.explode("journeys").alias("x")).select("x.*"))
    return {"stops": part("stops"), "lines": part("lines"), "journeys": part("journeys"), "edges": given.unionByName(derived)}
