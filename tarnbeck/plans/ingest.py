"""Ingestion end to end: routed documents to chunks, vectors and manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import chunk, clean, embed, index, metadata, privacy, validate
from ..sources import media, sinks
from ..storage import materialize


@dataclass(frozen=True)
class Ingested:
    docs: DataFrame
    chunks: DataFrame
    vectors: DataFrame
    manifest: DataFrame
    quarantine: DataFrame


def prepare(docs: DataFrame, config: EngineConfig, seen: DataFrame | None = None, tools: media.Tools | None = None) -> DataFrame:
    """Validate, clean, redact, the media themselves too where there are tools. The first stage that
    fails a document sets its status and reason, and later stages leave it alone."""
    docs = clean.clean(validate.validate(docs, config), config, seen)
    if tools is not None:
        docs = media.refined(docs, config, tools)
    return privacy.apply_privacy(docs, config)


def ingest(
    docs: DataFrame, config: EngineConfig, at: Column | None = None, seen: DataFrame | None = None, text_model=None, image_model=None, tools: media.Tools | None = None
) -> Ingested:
    """docs: the docs schema, routed (see sources.objects). Cheap native rules stand before model
    calls, so nothing that a rule rejects is ever embedded."""
    at = F.current_timestamp() if at is None else at
    # read by chunks and by the manifest: written once rather than computed twice
    ready = materialize(prepare(docs, config, seen, tools), "ready")
    cut = chunk.chunks(ready, config)
    cut = cut.withColumn("metadata", metadata.metadata(config, at))
    done = embed.embed(cut, config, text_model, image_model)
    if text_model or image_model:
        entries = index.manifest(ready, index.indexed_counts(done), at)
    else:
        counted = ready.withColumn("chunks_indexed", F.when(F.col("status").isNull(), chunk.indexed(config)))
        entries = index.manifest(counted, None, at)
    return Ingested(ready, done, index.vector_records(done, config), entries, index.quarantine(entries, config))


def reindex(records: DataFrame, config: EngineConfig, text_model=None, image_model=None) -> DataFrame:
    """Vectors again from chunk records, without parsing anything. Images are embedded from where the
    records say that their media went."""
    again = records.withColumn("chunk_media_path", F.nullif(F.col("processed_media_key"), F.lit("")))
    return index.vector_records(embed.embed(again, config, text_model, image_model), config)


def write(result: Ingested, path: str, stamp: str, config: EngineConfig = EngineConfig()) -> None:
    """Records first, then vectors, then the manifest, as an audit needs them."""
    sinks.write_chunk_records(index.chunk_records(result.chunks, config), f"{path}/records")
    sinks.write_vectors(result.vectors, f"{path}/vectors")
    sinks.write_manifest(result.manifest, f"{path}/manifests", stamp)
