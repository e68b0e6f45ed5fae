"""Index records: chunk records, vector records, counts, manifest, quarantine, deletion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from .route import extension


def record_key(config: EngineConfig) -> Column:
    return F.concat_ws("/", F.lit(config.processed_prefix), "modality", "doc_id", F.lit("chunks"), F.concat("chunk_id", F.lit(".json")))


def media_key(config: EngineConfig) -> Column:
    """Where a chunk's media goes; empty without any."""
    path = F.coalesce(F.col("chunk_media_path"), F.lit(""))
    key = F.concat_ws("/", F.lit(config.processed_prefix), "modality", "doc_id", F.lit("chunks"), F.concat(F.col("chunk_id"), extension(path)))
    return F.when(path == "", F.lit("")).otherwise(key)


def chunk_records(chunks: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """The audit record of every chunk, whether it gets a vector or not, with where its media went."""
    return chunks.select("chunk_id", "doc_id", "modality", "text", "start_sec", "end_sec", "position", "metadata", media_key(config).alias("processed_media_key"))


def media_records(chunks: DataFrame, docs: DataFrame, config: EngineConfig) -> DataFrame:
    """processed_media_key and content of the chunks whose media is their document's own file. The file's
    bytes meet the chunks only here."""
    own = chunks.select("doc_id", "chunk_id", "modality", "chunk_media_path").withColumn("processed_media_key", media_key(config))
    files = docs.where(F.col("content").isNotNull()).select("doc_id", F.col("media_path").alias("chunk_media_path"), "content")
    return own.join(files, ["doc_id", "chunk_media_path"]).select("processed_media_key", "content")


def vector_records(chunks: DataFrame, config: EngineConfig) -> DataFrame:
    """key, modality, vector, vector_role, has_aux_vector, doc_id, processed_media_key, metadata: a
    record for each main vector that isn't empty, and one more for its aux vector."""
    aux = F.size("aux_vector") > 0
    shared = (F.when(aux, F.lit(True)).alias("has_aux_vector"),)
    main = F.struct(F.col("chunk_id").alias("key"), F.col("vector"), F.lit(None).cast("string").alias("vector_role"), *shared)
    more = F.struct(F.concat("chunk_id", F.lit("_aux")).alias("key"), F.col("aux_vector").alias("vector"), F.lit("aux_image").alias("vector_role"), *shared)
    both = F.when(aux, F.array(main, more)).otherwise(F.array(main))
    out = chunks.where(F.size("vector") > 0).withColumn("media", media_key(config)).withColumn("r", F.explode(both))
    return out.select("r.key", "modality", "r.vector", "r.vector_role", "r.has_aux_vector", "doc_id", F.col("media").alias("processed_media_key"), "metadata")


def indexed_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id").agg(F.count_if(F.size("vector") > 0).cast("int").alias("chunks_indexed"))


def manifest(docs: DataFrame, counts: DataFrame | None, at: Column) -> DataFrame:
    """One row per object: s3_key, doc_id, status, reason, chunks_indexed, timestamp. Without counts, docs
    bring chunks_indexed along."""
    n = F.coalesce(F.col("chunks_indexed"), F.lit(0))
    done = F.when(n > 0, F.lit("success")).otherwise(F.lit("failed"))
    why = F.when(n > 0, F.lit("ok")).otherwise(F.lit("no_chunks_indexed"))
    return (docs if counts is None else docs.join(counts, "doc_id", "left")).select(
        F.col("source_key").alias("s3_key"),
        "doc_id",
        "modality",
        F.coalesce("status", done).alias("status"),
        F.coalesce("reason", why).alias("reason"),
        n.alias("chunks_indexed"),
        at.alias("timestamp"),
    )


def run_summary(entries: DataFrame) -> DataFrame:
    return entries.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")))


def exit_code(entries: DataFrame) -> int:
    """1 if anything failed."""
    return int(not entries.where("status = 'failed'").isEmpty())


def quarantine(entries: DataFrame, config: EngineConfig) -> DataFrame:
    """(s3_key, quarantine_key, reason) of what failed, but for unrouted extensions and documents
    without any indexed chunk; duplicates are skipped and don't count. Keys keep the whole path, so that
    equal names don't overwrite each other; strict keeps the base name alone."""
    name = F.element_at(F.split("s3_key", "/"), -1) if config.strict else F.col("s3_key")
    failed = entries.where("status = 'failed' and modality is not null and reason <> 'no_chunks_indexed'")
    return failed.select("s3_key", F.concat_ws("/", F.lit(config.quarantine_prefix), "modality", name).alias("quarantine_key"), "reason")


def delete_vectors(vectors: DataFrame, gone: DataFrame, on: str = "doc_id") -> DataFrame:
    """The vectors without those that gone names: a modality, a manifest's documents, or keys."""
    return vectors.join(gone.select(on).distinct(), on, "left_anti")
