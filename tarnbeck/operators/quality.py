"""Quality of an index: what a run's chunks look like, by modality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PII, count_mark


def report(chunks: DataFrame, fraction: float | None = None, seed: int = 0, short: int = 20) -> DataFrame:
    """By modality: chunks, empty ones, ones under short characters, characters, chunks without a
    vector, and redaction marks. With fraction, over a sample of that share of the chunks."""
    own = chunks if fraction is None else chunks.sample(fraction, seed)
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    marks = sum((count_mark(text, label) for label in PII), F.lit(0))
    return own.groupBy("modality").agg(
        F.count("*").alias("chunks"),
        F.count_if(n == 0).alias("empty"),
        F.count_if(n < short).alias("short"),
        F.sum(n).alias("chars"),
        F.count_if(F.size("vector") <= 0).alias("unindexed"),
        F.sum(marks).cast("long").alias("redactions"),
    )
