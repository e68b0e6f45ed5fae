"""Arrival events: reading, parsing, exact and near duplicates, joining results, failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import mark_duplicates
from ..schemas import EVENT


def read_events(spark: SparkSession, path: str, schema: str = "body string", most_files: int = 10, form: str = "json") -> DataFrame:
    """A folder as a queue: at most most_files new files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).format(form).load(path)


def parse_events(events: DataFrame, body: str = "body") -> DataFrame:
    """Adds source_key and bucket; null where the message isn't such an event."""
    got = F.from_json(F.col(body), EVENT)
    return events.withColumn("source_key", got["detail"]["object"]["key"]).withColumn("bucket", got["detail"]["bucket"]["name"])


def distinct_within(events: DataFrame, key: list[str], at: str = "ts", ttl: str = "90 days") -> DataFrame:
    """The first event of each key; a key is forgotten ttl after its event time."""
    return events.withWatermark(at, ttl).dropDuplicatesWithinWatermark(key) if events.isStreaming else events.dropDuplicates(key)


def join_results(jobs: DataFrame, results: DataFrame, name: str = "job", within: str = "1 day") -> DataFrame:
    """Jobs (job, started) with their completion events (job, ended), which come at most within later."""
    a = jobs.withWatermark("started", within).alias("j")
    b = results.withWatermark("ended", within).alias("r")
    cond = F.expr(f"j.{name} = r.{name} AND r.ended >= j.started AND r.ended <= j.started + INTERVAL {within}")
    return a.join(b, cond).select(F.col(f"j.{name}").alias(name), "started", "ended")


def arrivals_by_window(events: DataFrame, window: str = "1 day", late: str = "1 hour", at: str = "ts", by: str = "event_type") -> DataFrame:
    own = events.withColumn(at, F.col(at).cast("timestamp"))
    own = own.withWatermark(at, late) if own.isStreaming else own
    return own.groupBy(F.window(at, window).alias("w"), by).agg(F.count("*").alias("arrivals")).select(F.col("w.start").alias("start"), by, "arrivals")


def near_duplicate_batches(
    path: str, distance: int, out: Callable[[DataFrame, int], None], key: str = "source_key", hash_col: str = "phash", at: str | None = None, ttl: str = "90 days"
):
    """For foreachBatch: mark near-duplicates within the batch and against the hashes kept so far, a
    Parquet table at path with one folder a batch. A batch that is run again overwrites its folder and
    reads only earlier ones, so results don't change. With at, the column of event time, a kept hash is
    forgotten ttl before the batch's earliest event."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = "batch=-1"
        root = path.rstrip("/")
        spark.createDataFrame([], f"{hash_col} long, kept_at timestamp").write.mode("overwrite").parquet(f"{root}/{first}")
        old = spark.read.option("basePath", root).parquet(root).where(F.col("batch") < number)
        if at is not None:
            since = batch.agg(F.min(F.col(at).cast("timestamp")).alias("t")).select(F.expr(f"t - INTERVAL {ttl}")).first()[0]
            old = old.where(F.col("kept_at").isNull() | (F.col("kept_at") >= F.lit(since)))
        marked = mark_duplicates(batch, key, hash_col, distance, seen=old.select(F.col(hash_col).alias("hash")))
        when = (F.col(at).cast("timestamp") if at else F.lit(None).cast("timestamp")).alias("kept_at")
        marked.where("not is_duplicate").select(hash_col, when).write.mode("overwrite").parquet(f"{root}/batch={number}")
        out(marked, number)

    return run


def split_failures(process: Callable[[DataFrame], DataFrame], good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None]):
    """For foreachBatch: rows whose status is failed go to bad, the others to good."""

    def run(batch: DataFrame, number: int) -> None:
        done = process(batch).persist()
        try:
            good(done.where("status is null or status <> 'failed'"), number)
            bad(done.where("status = 'failed'"), number)
        finally:
            done.unpersist()

    return run


def drain(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is there and stop."""
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
