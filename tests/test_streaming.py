"""Streams: the same results as batches over the same rows."""

import json

from pyspark.sql import functions as F

from tarnbeck.operators.dedup import mark_duplicates
from tarnbeck.streaming import arrivals


def test_queue_of_events(spark, tmp_path):
    for i in range(3):
        body = json.dumps({"detail": {"object": {"key": f"raw/{i}.txt"}, "bucket": {"name": "b"}}}) if i else "junk"
        (tmp_path / f"{i}.json").write_text(json.dumps({"body": body}))
    stream = arrivals.parse_events(arrivals.read_events(spark, f"file://{tmp_path}", most_files=1))
    seen = []
    arrivals.drain(stream, lambda df, n: seen.append((n, [r["source_key"] for r in df.collect()])), f"file://{tmp_path}/../ck1")
    assert len(seen) == 3 and sorted(str(k) for _, ks in seen for k in ks) == ["None", "raw/1.txt", "raw/2.txt"]


def test_near_duplicates_over_batches(spark, tmp_path):
    rows = [("a", 0), ("b", 0b11), ("c", 1 << 40 | 1 << 50 | 0xFF), ("d", 0b1111111), ("e", 0)]
    src = tmp_path / "in"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "source_key string, phash long").coalesce(1).write.mode("append").parquet(f"file://{src}/n={i}")
    stream = spark.readStream.schema("source_key string, phash long, n int").option("maxFilesPerTrigger", 1).parquet(f"file://{src}")
    got = {}
    take = lambda df, n: got.update({r["source_key"]: r["is_duplicate"] for r in df.collect()})
    arrivals.drain(stream, arrivals.near_duplicate_batches(f"file://{tmp_path}/kept", 5, take), f"file://{tmp_path}/ck")
    batch = mark_duplicates(spark.createDataFrame(rows, "source_key string, phash long"), "source_key", "phash", 5)
    assert got == {r["source_key"]: r["is_duplicate"] for r in batch.collect()} == {"a": False, "b": True, "c": False, "d": True, "e": True}


def test_failures_are_split(spark):
    rows = spark.createDataFrame([("a", "failed"), ("b", None), ("c", "skipped")], "k string, status string")
    good, bad = [], []
    arrivals.split_failures(lambda df: df, lambda df, n: good.extend(r["k"] for r in df.collect()), lambda df, n: bad.extend(r["k"] for r in df.collect()))(rows, 0)
    assert (sorted(good), bad) == (["b", "c"], ["a"])


def test_results_join_their_jobs(spark):
    at = lambda c: F.col(c).cast("timestamp")
    jobs = spark.createDataFrame([("j1", "2024-01-01 00:00:00"), ("j2", "2024-01-01 00:00:00")], "job string, started string").withColumn("started", at("started"))
    done = spark.createDataFrame([("j1", "2024-01-01 01:00:00"), ("j2", "2024-01-05 00:00:00")], "job string, ended string").withColumn("ended", at("ended"))
    assert [r["job"] for r in arrivals.join_results(jobs, done).collect()] == ["j1"]
