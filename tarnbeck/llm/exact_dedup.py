"""Exact dedup by content sort, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: The characters that normalising deletes (space, tab, LF, VT, FF, CR).
DELETED = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalized(text):
    """The text without DELETED; null counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for ch in DELETED:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def hot_digests(rows: DataFrame, text, sample_rows: int, hot_share: float) -> DataFrame:
    """(sha, salts) of texts estimated to fill at least hot_share of all bytes or half of what one of the
    shuffle's tasks gets, so at most 2 / that share rows. The sample grows with the number of tasks, so
    that it sees such texts at any scale; it only decides how rows are dealt, never which rows count."""
    spark = rows.sparkSession
    n = rows.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_share = min(hot_share, 0.5 / parts)
    sample_rows = max(sample_rows, round(32 / hot_share))
    sample = rows.sample(fraction=min(1.0, sample_rows / n), seed=7) if n else rows
    held = sample.groupBy(F.sha2(normalized(text), 256).alias("sha")).agg(F.count("*").alias("n"), F.sum(F.octet_length(normalized(text)) + 100).alias("bytes"))
    held = materialize(held, "held")
    total = held.select(F.sum("bytes")).first()[0] or 1
    hot = held.where((F.col("n") >= 8) & (F.col("bytes") >= hot_share * total))
    return hot.select("sha", F.greatest(F.lit(2), F.ceil(F.col("bytes") / total * 4 * parts)).cast("int").alias("salts"))


def content_sort(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_rows: int = 20_000, hot_share: float = 0.002
) -> DataFrame:
    """Group rows with equal normalised text; keep the longest original, then the smallest id.

    Returns per row: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Rows are dealt by sampled range splitters over the normalised bytes (a prefix, then the digest
    as tie-break, so that splitters stay short) and sorted externally; equals become adjacent and the
    window compares whole neighbouring texts. A text that a sample finds in hot_share of the bytes or
    in half of a task's part of them is spread over salted runs, whose heads (a few rows each) are then
    merged; one text of a third of all rows meets no single task.

    Null text is the empty text; all empty texts are one group. A null id sorts after every other and
    is reported as null. Repeated rows are rows of their own: one of them is kept. An empty table
    gives an empty result. Other columns are ignored.
    """
    runs = materialize(_runs(docs, id_col, text_col, sample_rows, hot_share), "runs")
    return runs.join(F.broadcast(_stitched(runs)), "sha", "left").select(  # bounded by the share that makes a text hot
        "doc_id",
        F.when(F.col("best").isNull(), F.col("head")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", "n").cast("long").alias("group_size"),
        _stays().alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_rows: int = 20_000, hot_share: float = 0.002
) -> DataFrame:
    """The rows that content_sort keeps, with all columns of docs: whole rows travel with the one sort. Nulls
    count as empty texts, of which one row stays; of repeated rows one stays; an empty table stays empty."""
    runs = _runs(docs, id_col, text_col, sample_rows, hot_share, carry=True).where("rn = 1")
    kept = runs.join(F.broadcast(_stitched(runs)), "sha", "left").where(_stays())  # bounded by the share that makes a text hot
    return kept.select(*(F.col("whole")[c].alias(c) for c in docs.columns))


def _runs(docs: DataFrame, id_col: str, text_col: str, sample_rows: int, hot_share: float, carry: bool = False) -> DataFrame:
    """Every row with its run (sha, salt), its place rn in it, the run's head and its size n."""
    text = F.col(text_col)
    hot = materialize(hot_digests(docs.select(text_col), text, sample_rows, hot_share), "hot")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.coalesce(text.cast("string"), F.lit(""))).alias("n_chars"),
        normalized(text).alias("norm"),
        *([F.struct(*docs.columns).alias("whole")] if carry else []),
    ).withColumn("sha", F.sha2("norm", 256))
    rows = (
        rows.join(F.broadcast(hot), "sha", "left")  # bounded by the share that makes a text hot
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")) + 1, F.lit(0)).cast("int"))
        .withColumn("prefix", F.substring("norm", 1, 24))
        .drop("salts")
    )
    order = [F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last()]
    run = Window.partitionBy("prefix", "sha", "salt", "norm").orderBy(*order)
    out = rows.repartitionByRange("prefix", "sha", "salt").withColumn("rn", F.row_number().over(run))
    if not carry:
        out = out.withColumn("head", F.first("doc_id").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        out = out.withColumn("n", F.count("*").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return out.drop("norm", "prefix")


def _stitched(runs: DataFrame) -> DataFrame:
    """(sha, best, size) of each salted text, from the heads of its runs."""
    n = F.col("n") if "n" in runs.columns else F.lit(1)
    best = F.struct((-F.col("n_chars")).alias("k"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), "salt")
    return runs.where("salt > 0 and rn = 1").groupBy("sha").agg(F.min(best).alias("best"), F.sum(n).alias("size"))


def _stays():
    return (F.col("rn") == 1) & (F.col("best").isNull() | (F.col("best.salt") == F.col("salt")))
