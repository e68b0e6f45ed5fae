"""Metadata of a chunk: base fields and one block by modality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.media import hash_text


def metadata(config: EngineConfig, at: Column) -> Column:
    """struct for a row of chunks(); blocks of other modalities are null. at: the ingestion time.

    scene_count is the number before pruning, as the parser found it.
    """
    m, i, a, v = F.col("modality"), F.col("image"), F.col("audio"), F.col("video")
    span = (F.col("start_sec").alias("chunk_start_sec"), F.col("end_sec").alias("chunk_end_sec"))
    tile = F.when(F.col("position.row").isNotNull(), F.struct("position.row", "position.col"))
    return F.struct(
        F.col("doc_id"),
        F.col("chunk_id"),
        m,
        F.col("source_key"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingestion_timestamp"),
        F.lit(config.strict or config.enable_pii_text_redaction).alias("pii_redacted"),
        F.when(m == "text", F.struct(F.length("text").alias("char_count"))).alias("text_meta"),
        F.when(
            m == "image",
            F.struct(
                i["width"].alias("width"), i["height"].alias("height"), i["format"].alias("format"),
                (F.length(F.coalesce(i["ocr_text"], F.lit(""))) > 0).alias("ocr_text_present"), F.coalesce(i["caption"], F.lit("")).alias("caption"),
                hash_text(i["phash"]).alias("perceptual_hash"), F.coalesce(i["exif_stripped"], F.lit(False)).alias("exif_stripped"),
                F.coalesce(F.col("chunk_meta.is_tile"), F.lit(False)).alias("is_tile"), tile.alias("tile_position"),
            ),
        ).alias("image_meta"),
        F.when(m == "audio", F.struct(a["duration_sec"].alias("duration_sec"), a["sample_rate"].alias("sample_rate"), a["channels"].alias("channels"), *span)).alias("audio_meta"),
        F.when(
            m == "video",
            F.struct(
                v["duration_sec"].alias("duration_sec"), v["fps"].alias("fps"), F.concat_ws("x", v["width"], v["height"]).alias("resolution"),
                v["scene_count"].alias("scene_count"), F.col("position.scene_index").alias("scene_index"), *span,
            ),
        ).alias("video_meta"),
    )
