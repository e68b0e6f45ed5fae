"""Embedding of chunks: by text, by image, by both, or by their mean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.vectors import fuse, seeded_vector
from .models import ImageEmbedder, TextEmbedder, model_column

_NONE = "array<float>"


def embed(
    chunks: DataFrame, config: EngineConfig, text_model: Callable[[], TextEmbedder] | None = None, image_model: Callable[[], ImageEmbedder] | None = None
) -> DataFrame:
    """Adds vector and aux_vector (empty for none, never an error).

    text and audio: the text's vector. image: the image's, with the text as caption. video: the text's,
    and with a keyframe the image's beside it (dual_vector) or in the mean (single_fused_vector). So a
    silent scene has no main vector under dual_vector. Without models, vectors depend on the text or
    the path alone. model_call_partitions bounds concurrent calls.
    """
    none = F.array().cast(_NONE)
    m, path = F.col("modality"), F.coalesce(F.col("chunk_media_path"), F.lit(""))
    seen = (m == "image") | ((m == "video") & F.lit(config.embedding_strategy in ("dual_vector", "single_fused_vector")))
    text = F.when(m != "image", F.coalesce(F.col("text"), F.lit(""))).otherwise(F.lit(""))
    image = F.when(seen, path).otherwise(F.lit(""))
    caption = F.when(m == "image", F.coalesce(F.col("text"), F.lit(""))).otherwise(F.lit(""))
    if config.model_call_partitions and (text_model or image_model):
        chunks = chunks.repartition(config.model_call_partitions)

    def by(model, method, offline: Column, *columns: Column) -> Column:
        if model is None:
            return offline

        def make():
            own = model()

            def call(first, *rest):
                at = [i for i, x in enumerate(first) if x]
                got = own.embed([first[i] for i in at], *([r[i] for i in at] for r in rest)) if at else []
                out = [[] for _ in first]
                for i, v in zip(at, got, strict=True):
                    out[i] = v
                return out

            return call

        return F.coalesce(model_column(make, _NONE, *columns)["value"], none)

    out = chunks.withColumn("_t", by(text_model, "embed", seeded_vector(text), text)).withColumn("_i", by(image_model, "embed", seeded_vector(image), image, caption))
    fused = fuse(F.col("_t"), F.col("_i")) if config.embedding_strategy == "single_fused_vector" else F.col("_t")
    main = F.when(m == "image", F.col("_i")).when(m == "video", fused).otherwise(F.col("_t"))
    aux = F.when((m == "video") & F.lit(config.embedding_strategy == "dual_vector"), F.col("_i")).otherwise(none)
    return out.withColumn("vector", main).withColumn("aux_vector", aux).drop("_t", "_i")
