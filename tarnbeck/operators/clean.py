"""Cleanup: white space, image duplicates, keyframe pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import media, text
from .dedup import mark_duplicates
from .validate import fail


def clean(docs: DataFrame, config: EngineConfig, seen: DataFrame | None = None) -> DataFrame:
    """Collapse white space of texts, prune near-equal scenes of videos, skip duplicates of images.

    Only valid images take part in dedup, and one that fails at a later stage still makes its later
    twins duplicates. The first in source_key order is kept.
    """
    live = F.col("status").isNull()
    docs = docs.withColumn("content_text", F.when(live & (F.col("modality") == "text"), text.collapse(F.col("content_text"))).otherwise(F.col("content_text")))
    docs = docs.withColumn(
        "scenes", F.when(live & (F.col("modality") == "video"), media.prune_scenes(F.col("scenes"), config.image_dedup_hash_distance)).otherwise(F.col("scenes"))
    )
    # only images are dealt by their hash; all others pass by without a shuffle
    image = F.coalesce(F.col("modality") == "image", F.lit(False))
    pictures = docs.where(image).withColumn("_hash", F.when(live, F.col("image.phash")))
    pictures = mark_duplicates(pictures, "source_key", "_hash", config.image_dedup_hash_distance, "_twin", seen)
    pictures = pictures.withColumn("image", F.when(F.col("image").isNotNull(), F.col("image").withField("is_duplicate", F.col("_twin"))))
    pictures = fail(pictures, "", F.when(F.col("_twin"), F.lit("duplicate_detected")), "skipped").drop("_hash", "_twin")
    return docs.where(~image).unionByName(pictures)
