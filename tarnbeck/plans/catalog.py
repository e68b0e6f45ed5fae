"""The registered queries of the engine's own operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import media, text, vectors
from ..operators import chunk, dedup, embed, index, metadata, privacy, quality, search, validate
from ..operators.route import extension, modality
from ..storage import materialize, shared_dir
from ..streaming import arrivals
from ..sources.media import media_documents
from . import fixtures as fx
from . import stubs
from .ingest import ingest, prepare

C = EngineConfig()
#: The hashes at hand are far apart, so near-duplicate queries take these distances.
PAIR_DISTANCE, FRAME_DISTANCE = 20, 24


def _at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def route_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(name, *parts):
        own = F.concat(*(F.lit(p[1:]) if p[0] == "=" else F.col(p).cast("string") for p in parts))
        return fx.table(spark, sf_dir, name).select(own.alias("source_key"))

    out = keys("pages", "url").union(keys("documents", "=raw/text/", "source", "=/", "doc_id", "=.TXT"))
    out = out.union(keys("conversations", "=raw/audio/", "conv_id", "=.", "turn", "=.wav")).union(keys("events", "=raw/video.d/", "user_id", "=/.", "event_id", "=.mp4"))
    return out.select("source_key", extension(F.col("source_key")).alias("extension"), modality(F.col("source_key"), C).alias("modality"))


def unsupported_extension(spark, sf_dir):
    return fx.page_docs(spark, sf_dir, C).where("status = 'failed'").select("source_key", "reason")


def clean_text(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.md5(text.collapse(F.col("text"))).alias("clean_md5"), F.length(text.collapse(F.col("text"))).cast("long").alias("n"))


def validate_text(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    blank = F.when(F.col("doc_id") % 7 == 0, F.lit("")).when(F.col("doc_id") % 7 == 1, F.lit(" \t  \n")).when(F.col("doc_id") % 7 == 2, F.lit(None)).otherwise(F.col("text"))
    return docs.select("doc_id", F.coalesce(validate.text_reason(blank), F.lit("ok")).alias("reason"))


def _redacted(docs):
    return text.redact(text.collapse(docs))


def pii_redact(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.md5(_redacted(F.col("text"))).alias("redacted_md5"))


def pii_counts(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("source", _redacted(F.col("text")).alias("t"))
    return docs.groupBy("source").agg(*(F.sum(text.count_mark(F.col("t"), k)).alias(k) for k in text.PII))


def chunk_text(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunk.text_chunks(F.col("text"))).alias("ordinal", "c"))
    return docs.select("doc_id", "ordinal", chunk.chunk_id(F.col("doc_id"), F.col("ordinal")).alias("chunk_id"), F.md5("c.text").alias("text_md5"), F.length("c.text").cast("long").alias("n"))


def chunk_stats(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    n = F.transform(text.text_windows(F.col("text"), C.text_window, C.text_overlap), lambda w: (w["end"] - w["start"]).cast("long"))
    return docs.select("source", F.explode(n).alias("n")).groupBy("source").agg(F.count("*").alias("chunks"), F.sum("n").alias("chars"), F.min("n").alias("least"), F.max("n").alias("most"))


def text_pipeline(spark, sf_dir):
    """Route, validate, clean, redact, chunk and tag; chunks and characters by source. The one shuffle
    is of the partial sums."""
    docs = validate.validate(fx.text_docs(spark, sf_dir, C), C)
    docs = docs.withColumn("content_text", text.collapse(F.col("content_text")))
    cut = chunk.chunks(privacy.apply_privacy(docs, C), C)
    cut = cut.select(F.split("source_key", "/")[2].alias("source"), metadata.metadata(C, _at()).alias("m"), F.length("text").alias("n"))
    return cut.groupBy("source").agg(F.count("*").alias("chunks"), F.sum(F.col("m.text_meta.char_count").cast("long")).alias("chars"), F.count_if("m.pii_redacted").alias("redacted"))


def html_pages_as_text(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", text.collapse(F.col("html")).alias("t"))
    cut = pages.select("page_id", F.posexplode(chunk.text_chunks(F.col("t"))).alias("ordinal", "c"))
    return cut.select("page_id", "ordinal", F.md5("c.text").alias("text_md5"))


def transcript_compose(spark, sf_dir):
    return fx.recordings(spark, sf_dir).select("conv_id", F.md5(chunk.transcript(F.col("segments"))).alias("text_md5"), "length_ms")


def audio_validate(spark, sf_dir):
    rows = fx.audio_rows(spark, sf_dir)
    return rows.select("event_id", F.coalesce(validate.audio_reason(F.col("duration"), F.col("sample_rate"), C), F.lit("ok")).alias("reason"))


def video_validate(spark, sf_dir):
    rows = fx.video_rows(spark, sf_dir)
    why = validate.video_reason(F.col("duration"), F.col("codec"), F.col("width"), F.col("height"), C)
    return rows.select("o_orderkey", F.coalesce(why, F.lit("ok")).alias("reason"))


def image_validate(spark, sf_dir):
    rows = fx.image_rows(spark, sf_dir)
    why = validate.image_reason(F.col("width"), F.col("height"), F.col("format"), F.col("bytes"), C)
    return rows.select("p_partkey", F.coalesce(why, F.lit("ok")).alias("reason"))


def _windows():
    return text.spans(F.col("length_ms"), 30_000, 5_000)


def audio_windows(spark, sf_dir):
    return fx.recordings(spark, sf_dir).select("conv_id", F.posexplode(_windows()).alias("ordinal", "w")).select("conv_id", "ordinal", F.col("w.start").alias("start_ms"), F.col("w.end").alias("end_ms"))


def _audio_chunks(rows, segments):
    own = F.transform(_windows(), lambda w: F.struct(w["start"].alias("start_ms"), w["end"].alias("end_ms"), chunk.said_within(segments, w["start"], w["end"]).alias("text")))
    return rows.select("conv_id", F.posexplode(own).alias("ordinal", "c")).select("conv_id", "ordinal", "c.start_ms", "c.end_ms", F.md5("c.text").alias("text_md5"))


def audio_chunks(spark, sf_dir):
    return _audio_chunks(fx.recordings(spark, sf_dir), F.col("segments"))


def audio_redact_chunks(spark, sf_dir):
    return _audio_chunks(fx.recordings(spark, sf_dir).withColumn("segments", privacy.redact_segments(F.col("segments"))), F.col("segments"))


def _days(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), (F.unix_timestamp(F.col("ts").cast("timestamp")) % 86400).cast("double").alias("cut"))
    return e.groupBy("user_id", "day").agg(media.scenes(F.collect_list("cut"), F.lit(86400.0), 3600.0, 1800.0).alias("scenes"))


def scene_merge(spark, sf_dir):
    own = _days(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), F.explode("scenes").alias("s"))
    return own.select("user_id", "day", "s.scene_index", "s.start_sec", "s.end_sec")


def video_chunks(spark, sf_dir):
    """Scenes of users' days with the transcript of the conversation that stands for their speech."""
    spoken = fx.recordings(spark, sf_dir).select(
        "conv_id",
        F.transform("segments", lambda s: F.struct((s["start"] / 1000).alias("start"), (s["end"] / 1000).alias("end"), s["text"].alias("text"), F.lit(None).cast("string").alias("speaker"))).alias("segments"),
    )
    days = _days(spark, sf_dir).withColumn("conv_id", F.col("user_id") % 100).join(spoken, "conv_id", "left")
    framed = F.transform("scenes", lambda s: F.struct(s["scene_index"], s["start_sec"], s["end_sec"], F.lit(None).cast("string").alias("keyframe_path"), F.lit(None).cast("long").alias("phash")))
    cut = days.select("user_id", F.col("day").cast("string").alias("day"), F.posexplode(chunk.video_chunks(F.lit(""), F.col("segments"), framed)).alias("ordinal", "c"))
    return cut.select("user_id", "day", "ordinal", "c.start_sec", "c.end_sec", F.md5("c.text").alias("text_md5"))


def keyframe_prune(spark, sf_dir):
    v = fx.table(spark, sf_dir, "embeddings").withColumn("h", vectors.sign_bits(F.col("embedding")))
    path = F.when(F.col("vec_id") % 17 != 0, F.concat(F.lit("k/"), F.col("vec_id").cast("string")))
    scene = F.struct(F.col("vec_id").cast("int").alias("scene_index"), F.lit(0.0).alias("start_sec"), F.lit(0.0).alias("end_sec"), path.alias("keyframe_path"), F.col("h").alias("phash"))
    # a video is a label's vectors of one thousand ids, so that none grows with the table
    kept = v.groupBy("label", F.floor(F.col("vec_id") / 1000)).agg(media.prune_scenes(F.array_sort(F.collect_list(scene)), FRAME_DISTANCE).alias("k"))
    return kept.select("label", F.explode("k.scene_index").alias("vec_id"))


def probe_parse(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select("event_id")
    i = F.col("event_id")
    rate = F.element_at(F.array(*(F.lit(x) for x in ("30/1", "30000/1001", "0/0", "x"))), (i % 4 + 1).cast("int"))
    stream = '{"codec_type":"video","codec_name":"h264","duration":"7.5","width":%d,"height":360,"avg_frame_rate":"%s"}'
    sound = ',{"codec_type":"audio","codec_name":"aac","sample_rate":"%d","channels":2}'
    form = F.when(i % 5 == 0, F.lit("{}")).otherwise(F.format_string('{"duration":"%d.25"}', i % 1000))
    body = F.concat(F.lit('{"format":'), form, F.lit(',"streams":['), F.format_string(stream, i % 1000, rate), F.when(i % 2 == 0, F.format_string(sound, i % 7 * 8000)).otherwise(F.lit("")), F.lit("]}"))
    body = F.when(i % 11 == 0, F.lit("not json")).otherwise(body)
    rows = e.select("event_id", media.parse_video_probe(body).alias("v"), media.parse_audio_probe(body).alias("a"))
    return rows.select(
        "event_id", F.col("v.duration_sec").alias("duration_sec"), F.col("v.width").alias("width"), F.round("v.fps", 6).alias("fps"), F.col("v.codec").alias("codec"), F.col("v.has_audio").alias("has_audio"),
        F.col("a.sample_rate").alias("sample_rate"), F.col("a.channels").alias("channels"), F.col("a.duration_sec").alias("audio_sec"),
    )


def image_tiles(spark, sf_dir):
    own = media.tiles(F.col("width"), F.col("height"), C.image_tile_threshold_px, C.image_tile_size_px)
    return fx.image_rows(spark, sf_dir).select("p_partkey", F.explode(own).alias("t")).select("p_partkey", "t.row", "t.col", "t.left", "t.top", "t.right", "t.bottom")


def phash_bits(spark, sf_dir):
    pixels = F.transform("embedding", lambda x: x.cast("double"))
    v = fx.table(spark, sf_dir, "embeddings")
    return v.select("vec_id", media.hash_text(vectors.sign_bits(F.col("embedding"))).alias("sign_hash"), F.bit_count(media.average_hash(pixels)).cast("long").alias("above_mean"))


def _hashes(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", vectors.sign_bits(F.col("embedding")).alias("hash"))


def hamming_pairs(spark, sf_dir):
    return dedup.near_pairs(_hashes(spark, sf_dir).withColumnRenamed("vec_id", "ord"), PAIR_DISTANCE)


def greedy_dedup(spark, sf_dir):
    return dedup.mark_duplicates(_hashes(spark, sf_dir), "vec_id", "hash", PAIR_DISTANCE).select("vec_id", "is_duplicate")


def fuse_vectors(spark, sf_dir):
    v = fx.table(spark, sf_dir, "embeddings")
    a = v.select("vec_id", F.col("embedding").alias("a"))
    b = v.select((F.col("vec_id") - 1).alias("vec_id"), F.when(F.col("vec_id") % 5 == 0, F.array().cast("array<float>")).when(F.col("vec_id") % 5 == 1, F.slice("embedding", 1, 8)).otherwise(F.col("embedding")).alias("b"))
    fused = F.transform(vectors.fuse(F.col("a"), F.col("b")), lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string"))
    return a.join(b, "vec_id").select("vec_id", F.array_join(fused, ",").alias("fused"))


def _chunks_of_vectors(spark, sf_dir, config):
    i = F.col("vec_id")
    kind = F.element_at(F.array(*(F.lit(m) for m in ("text", "image", "audio", "video"))), (i % 4 + 1).cast("int"))
    rows = fx.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("c"), i.cast("string")).alias("chunk_id"), i.cast("string").alias("doc_id"), kind.alias("modality"),
        F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("said "), i.cast("string"))).alias("text"),
        F.when((i % 2 == 1) & (i % 5 != 0), F.concat(F.lit("k/"), i.cast("string"), F.lit(".png"))).alias("chunk_media_path"), F.lit(None).cast("string").alias("metadata"),
    )
    out = index.vector_records(embed.embed(rows, config), config)
    return out.select("key", "modality", "vector_role", F.coalesce("has_aux_vector", F.lit(False)).alias("has_aux"), "processed_media_key", F.round(F.col("vector")[0].cast("double") * 2000).cast("long").alias("v0"))


def dual_vector_records(spark, sf_dir):
    return _chunks_of_vectors(spark, sf_dir, C)


def fused_vector_records(spark, sf_dir):
    return _chunks_of_vectors(spark, sf_dir, EngineConfig(embedding_strategy="single_fused_vector"))


def chunk_records_vs_vectors(spark, sf_dir):
    docs = fx.audio_docs(spark, sf_dir, C)
    done = ingest(docs, C, _at()).chunks
    kept = done.select("source_key", F.size("vector").alias("n"))
    return kept.groupBy("source_key").agg(F.count("*").alias("records"), F.count_if(F.col("n") > 0).alias("vectors"))


def _kinds(spark, sf_dir):
    kind = F.element_at(F.array(*(F.lit(m) for m in ("text", "image", "audio", "video"))), (F.col("label") % 4 + 1).cast("int"))
    return fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), kind.alias("modality"))


def _searchable(spark, sf_dir):
    v = _kinds(spark, sf_dir)
    query = v.where("key = 0").first()
    # without the query's row nothing is found
    return (v, query["vector"]) if query and query["vector"] else (v.where("false"), [0.0])


def topk_search(spark, sf_dir):
    v, q = _searchable(spark, sf_dir)
    return search.top_k(v, q, 10).select("key", F.round("score", 6).alias("score"))


def topk_filtered(spark, sf_dir):
    v, q = _searchable(spark, sf_dir)
    return search.top_k(v, q, 10, modality="audio").select("key", F.round("score", 6).alias("score"))


def topk_by_modality(spark, sf_dir):
    v, q = _searchable(spark, sf_dir)
    return search.top_k_by(v, q, 5).select("modality", "rank", "key", F.round("score", 6).alias("score"))


M = EngineConfig(image_enable_captioning=True)


def _media(spark, sf_dir):
    return media_documents(fx.media_objects(spark, sf_dir), M, stubs.TOOLS)


def media_parse(spark, sf_dir):
    """Objects of all modalities parsed with stub tools: facts, texts, transcripts, scenes, keyframes, errors."""
    docs = _media(spark, sf_dir)
    frames = F.array_join(F.transform("frames", lambda f: F.coalesce(F.decode(f, "UTF-8"), F.lit("none"))), ";")
    return docs.select(
        "source_key", "modality", "status", "reason", "content_text", F.col("image.width").alias("width"), F.col("image.format").alias("format"), F.col("image.exif")["Make"].alias("make"),
        F.coalesce("audio.duration_sec", "video.duration_sec").alias("duration_sec"), F.size("segments").alias("n_segments"), F.size("scenes").alias("n_scenes"), frames.alias("frames"),
    )


def media_prepare(spark, sf_dir):
    """The same documents validated, normalised, with faces blurred and texts redacted: what is left of each file."""
    docs = prepare(_media(spark, sf_dir), M, tools=stubs.TOOLS)
    frames = F.array_join(F.transform("frames", lambda f: F.coalesce(F.decode(f, "UTF-8"), F.lit("none"))), ";")
    return docs.select("source_key", "status", "reason", "content_text", "media_path", F.decode("content", "UTF-8").alias("content"), frames.alias("frames"), F.col("image.exif_stripped").alias("exif_stripped"))


def media_manifest(spark, sf_dir):
    return ingest(_media(spark, sf_dir), M, _at(), tools=stubs.TOOLS).manifest.select("s3_key", "status", "reason", "chunks_indexed")


def _entries(spark, sf_dir):
    return ingest(fx.all_docs(spark, sf_dir, C), C, _at()).manifest


def manifest(spark, sf_dir):
    return _entries(spark, sf_dir).select("s3_key", "status", "reason", "chunks_indexed")


def run_summary(spark, sf_dir):
    return index.run_summary(_entries(spark, sf_dir))


def quarantine_keys(spark, sf_dir):
    return index.quarantine(_entries(spark, sf_dir), C)


def quality_report(spark, sf_dir):
    docs = fx.text_docs(spark, sf_dir, C).unionByName(fx.page_docs(spark, sf_dir, C))
    return quality.report(ingest(docs, C, _at()).chunks)


def delete_by_modality(spark, sf_dir):
    v = _kinds(spark, sf_dir)
    gone = spark.createDataFrame([("image",), ("video",)], "modality string")
    return index.delete_vectors(v, gone, "modality").groupBy("modality").agg(F.count("*").alias("left"), F.sum("key").alias("keys"))


def arrivals_by_day(spark, sf_dir):
    own = arrivals.arrivals_by_window(fx.table(spark, sf_dir, "events"))
    return own.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "arrivals")


def ingest_stream_dedup(spark, sf_dir):
    """The events as a stream, the first of each user and type, in the order of arrival."""
    schema = fx.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    top = f"{shared_dir(spark)}/tarnbeck/stream-{uuid.uuid4().hex}"
    first = arrivals.distinct_within(stream.select("user_id", "event_type", "ts"), ["user_id", "event_type"])
    arrivals.drain(first, lambda df, n: df.write.mode("overwrite").parquet(f"{top}/out/batch={n}"), f"{top}/checkpoint")
    return materialize(spark.read.parquet(f"{top}/out"), "arrived").groupBy("event_type").agg(F.count("*").alias("users"))


QUERIES = {
    f.__name__: f
    for f in (
        route_modality, unsupported_extension, clean_text, validate_text, pii_redact, pii_counts, chunk_text, chunk_stats, text_pipeline, html_pages_as_text,
        transcript_compose, audio_validate, video_validate, image_validate, audio_windows, audio_chunks, audio_redact_chunks, scene_merge, video_chunks, keyframe_prune,
        probe_parse, image_tiles, phash_bits, hamming_pairs, greedy_dedup, fuse_vectors, dual_vector_records, fused_vector_records, chunk_records_vs_vectors,
        topk_search, topk_filtered, topk_by_modality, media_parse, media_prepare, media_manifest, manifest, run_summary, quarantine_keys, quality_report, delete_by_modality, arrivals_by_day, ingest_stream_dedup,
    )
}
