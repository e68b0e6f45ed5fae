"""Cutting lineage with tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names. Where the setting is absent, a local session
    makes and uses a temporary folder; on a cluster executors couldn't share that, so it raises."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = getattr(spark, "_tarnbeck_dir", None)
        if top is None:
            top = spark._tarnbeck_dir = "file://" + tempfile.mkdtemp(prefix="tarnbeck-")
    return top.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and the table
    survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/tarnbeck/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tarnbeck_path = path
    _written.append(path)
    return out


def sweep(spark: SparkSession) -> None:
    """Delete all tables that materialize() has written in this process, once their results are saved."""
    for path in _written:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _written.clear()


def discard(df: DataFrame) -> None:
    """Delete a table made by materialize() that no later plan reads."""
    path = getattr(df, "_tarnbeck_path", None)
    if path:
        if path in _written:
            _written.remove(path)
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Meanwhile each action deletes its shuffle files as it ends, instead of when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def install(spark: SparkSession) -> None:
    """Ship this package to the executors' Python, once a session, for clusters where it isn't
    installed and for drivers that found it by sys.path alone."""
    context = spark.sparkContext
    if getattr(context, "_tarnbeck_shipped", False):
        return
    top = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="tarnbeck-")) / "tarnbeck.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, Path(top.name) / p.relative_to(top))
    context.addPyFile(str(path))
    context._tarnbeck_shipped = True
