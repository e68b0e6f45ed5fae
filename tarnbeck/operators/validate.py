"""Acceptance rules by modality; the first that fails gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.text import is_blank


def _first(*rules: tuple[Column, Column]) -> Column:
    out = F.lit(None).cast("string")
    for rule, reason in reversed(rules):
        out = F.when(rule, reason).otherwise(out)
    return out


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def text_reason(text: Column) -> Column:
    return _first((is_blank(text), F.lit("Empty text content")))


def image_reason(width: Column, height: Column, kind: Column, size: Column, config: EngineConfig) -> Column:
    """size: bytes of the file, null without one."""
    w, h = (F.coalesce(x, F.lit(0)) for x in (width, height))
    form, mb = F.upper(F.coalesce(kind, F.lit(""))), size / 1048576
    return _first(
        ((w < config.image_min_width_px) | (h < config.image_min_height_px), _text("Image too small: ", w, "x", h)),
        (~form.isin(*config.image_allowed_formats), _text("Unsupported image format: ", form)),
        (mb > config.image_max_size_mb, F.format_string("Image exceeds max size: %.1fMB", mb)),
    )


def audio_reason(duration: Column, rate: Column, config: EngineConfig) -> Column:
    d, r = F.coalesce(duration.cast("double"), F.lit(0.0)), F.coalesce(rate, F.lit(0))
    return _first(
        (d <= config.audio_min_duration_sec, _text("Audio too short: ", d, "s")),
        (d > config.audio_max_duration_sec, _text("Audio exceeds max duration: ", d, "s")),
        (r < config.audio_min_sample_rate, _text("Sample rate too low: ", r, "Hz")),
    )


def video_reason(duration: Column, codec: Column, width: Column, height: Column, config: EngineConfig) -> Column:
    d, c = F.coalesce(duration.cast("double"), F.lit(0.0)), F.coalesce(codec, F.lit(""))
    w, h = (F.coalesce(x, F.lit(0)) for x in (width, height))
    return _first(
        (d <= 0, F.lit("Zero/invalid video duration (likely corrupt container)")),
        (d > config.video_max_duration_sec, _text("Video exceeds max duration: ", d, "s")),
        (~c.isin(*config.video_allowed_codecs), _text("Unsupported video codec: ", c)),
        (F.greatest(w, h) > config.video_max_resolution_px, _text("Video resolution exceeds max: ", w, "x", h)),
    )


def reason(config: EngineConfig) -> Column:
    """Why a document of the docs schema isn't valid; null if it is."""
    m, i, a, v = F.col("modality"), F.col("image"), F.col("audio"), F.col("video")
    return (
        F.when(m == "text", text_reason(F.col("content_text")))
        .when(m == "image", image_reason(i["width"], i["height"], i["format"], F.col("media_bytes_len"), config))
        .when(m == "audio", audio_reason(a["duration_sec"], a["sample_rate"], config))
        .when(m == "video", video_reason(v["duration_sec"], v["codec"], v["width"], v["height"], config))
        .otherwise(_text("No validator registered for modality '", F.coalesce(m, F.lit("")), "'"))
    )


def fail(docs: DataFrame, prefix: str, why: Column, status: str = "failed") -> DataFrame:
    """Set status and reason of rows that have none yet and for which why isn't null."""
    open_ = F.col("status").isNull()
    docs = docs.withColumn("_why", F.when(open_, why))
    hit = F.col("_why").isNotNull()
    full = F.concat(F.lit(f"{prefix}: "), F.col("_why")) if prefix else F.col("_why")
    return docs.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status"))).withColumn("reason", F.when(hit, full).otherwise(F.col("reason"))).drop("_why")


def validate(docs: DataFrame, config: EngineConfig) -> DataFrame:
    return fail(docs, "validation_failed", reason(config))
