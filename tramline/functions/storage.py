"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a folder of our own only where none is set (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tramline-checkpoint-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_folder(spark)}/tramline-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that were not written elsewhere can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings of the session (``__`` for a dot) that hold inside the block."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy(spark: SparkSession):
    """Inside the block, a query's shuffle files go as soon as the query has ended, not when the driver happens to collect its garbage."""
    return setting(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table that outlives executors; cuts the lineage, and its shuffle files go."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    for folder in folders:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remembered(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; made and written there first if it isn't complete."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Rows that Arrow hands to Python at a time, at most: whole texts and pages can be long.
ARROW_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Makes this package importable by Python workers on every executor, once a session's context, and keeps Arrow batches small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_tramline_shipped", False):
        return
    top = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    path = Path(tempfile.mkdtemp(prefix="tramline-ship-")) / "tramline_package.zip"
    path.write_bytes(data.getvalue())
    sc.addPyFile(str(path))
    sc._tramline_shipped = True
