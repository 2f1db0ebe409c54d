"""Feeds as a stream: new archives in a folder become rows of the schedule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tramline.sources import gtfs


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of archives as they come."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip").load(path).select("path", "content")


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends the tables of new archives to Parquet folders under ``out``, each archive once. A batch writes under its own
    number, so a batch that is run again replaces what it wrote before."""

    def write(batch: DataFrame, number: int) -> None:
        for name in gtfs.COLUMNS:
            gtfs.table(batch, name).write.mode("overwrite").parquet(f"{out}/{name.removesuffix('.txt')}/batch={number}")

    writer = archives(spark, path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
