"""Privacy: personal data in texts, EXIF, and the regions to blur."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.text import redact


def redact_segments(segments: Column) -> Column:
    """Each segment's text by itself: data split over two segments stays."""
    return F.transform(segments, lambda s: s.withField("text", redact(s["text"])))


def apply_privacy(docs: DataFrame, config: EngineConfig) -> DataFrame:
    """Redact the text and the transcript of documents that have a text. A video's transcript is
    redacted too, unless strict. EXIF is dropped and the image marked so."""
    if config.enable_pii_text_redaction:
        some = F.length(F.coalesce(F.col("content_text"), F.lit(""))) > 0
        spoken = some & (F.col("modality") != "video") if config.strict else some
        docs = docs.withColumn("segments", F.when(spoken, redact_segments(F.col("segments"))).otherwise(F.col("segments")))
        docs = docs.withColumn("content_text", F.when(some, redact(F.col("content_text"))).otherwise(F.col("content_text")))
    if config.enable_exif_strip:
        bare = F.col("image").withField("exif", F.lit(None).cast("map<string,string>")).withField("exif_stripped", F.lit(True))
        docs = docs.withColumn("image", F.when(F.col("image").isNotNull(), bare))
    return docs
