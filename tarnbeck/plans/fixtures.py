"""Stand-ins: the tables at hand as the inputs of each modality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.media import scenes
from ..operators.route import route
from ..sources.objects import as_docs, doc_id
from ..storage import install


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    install(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """A small file is one task; what follows is heavy for each of its narrow rows."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _docs(rows: DataFrame, config: EngineConfig) -> DataFrame:
    return as_docs(route(rows, config).withColumn("doc_id", doc_id(F.col("source_key"))))


def text_docs(spark, sf_dir, config):
    rows = table(spark, sf_dir, "documents")
    key = F.concat(F.lit("raw/text/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return _docs(rows.select(key.alias("source_key"), F.col("text").alias("content_text")), config)


def page_docs(spark, sf_dir, config):
    return _docs(table(spark, sf_dir, "pages").select(F.col("url").alias("source_key"), F.col("html").alias("content_text")), config)


def recordings(spark, sf_dir) -> DataFrame:
    """conv_id, length_ms and segments (start, end in ms, text), a segment a turn, in order."""
    turns = table(spark, sf_dir, "conversations").withColumn("ms", 1000 + 40 * F.length("text").cast("long"))
    end = F.sum("ms").over(Window.partitionBy("conv_id").orderBy("turn"))
    turns = turns.withColumn("end", end).withColumn("start", F.col("end") - F.col("ms"))
    own = F.array_sort(F.collect_list(F.struct("turn", "start", "end", "text")))
    return turns.groupBy("conv_id").agg(F.max("end").alias("length_ms"), own.alias("segments"))


def image_rows(spark, sf_dir):
    kinds = {"STANDARD": "JPEG", "PROMO": "PNG", "ECONOMY": "webp", "MEDIUM": "TIFF", "SMALL": "GIF", "LARGE": "bmp"}
    table_ = F.create_map(*(F.lit(x) for p in kinds.items() for x in p))
    size = F.col("p_size") * F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", (size * 3).alias("width"), (size * 2).alias("height"),
        F.element_at(table_, F.split("p_type", " ")[0]).alias("format"), (F.col("p_partkey") % 30 * 1048576).alias("bytes"),
    )


def image_hash(key):
    """Keys equal modulo 500 are twins, as the SQL has it: exact ones, or near ones with one or two bits
    set otherwise. The n-th twin has the sqrt(n)-th of those bit patterns, so that both the distinct
    hashes and the near pairs grow with the table, the pairs in proportion to it."""
    bits = F.conv(F.substring(F.md5((key % 500).cast("string")), 1, 15), 16, 10).cast("long")
    k = F.floor(F.sqrt(F.floor(key / 500))).cast("long")
    ones = F.array(*(F.lit(1 << i).cast("long") for i in range(60)))
    return bits.bitwiseXOR(F.get(ones, k % 60).bitwiseOR(F.get(ones, (k + F.floor(k / 60)) % 60)))


def image_docs(spark, sf_dir, config):
    rows = image_rows(spark, sf_dir)
    key = F.concat(F.lit("raw/image/"), F.col("p_partkey").cast("string"), F.lit(".png"))
    image = F.struct("width", "height", "format", F.lit(None).alias("exif"), F.lit("").alias("ocr_text"), F.lit("").alias("caption"), image_hash(F.col("p_partkey")).alias("phash"), F.lit(None).alias("is_duplicate"), F.lit(False).alias("exif_stripped"))
    return _docs(rows.select(key.alias("source_key"), F.lit("").alias("content_text"), key.alias("media_path"), F.col("bytes").alias("media_bytes_len"), image.alias("image")), config)


def media_objects(spark, sf_dir) -> DataFrame:
    """Objects of all modalities whose bytes say what the tools of plans.stubs find in them."""
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*(F.lit(x) for x in ("I", "A", "V", "T"))), (k % 4 + 1).cast("int"))
    form = F.element_at(F.array(*(F.lit(x) for x in (".jpg", ".mp3", ".mp4", ".md"))), (k % 4 + 1).cast("int"))
    body = F.concat_ws("|", kind, k.cast("string"), "p_size")
    rows = _spread(table(spark, sf_dir, "part").select(F.concat(F.lit("raw/"), k.cast("string"), form).alias("source_key"), F.encode(body, "UTF-8").alias("content")))
    return rows.withColumn("media_bytes_len", F.length("content").cast("long"))


def audio_rows(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", "event_type", (e % 200 * 20 + 0.5 - 0.5 * (e % 2)).cast("double").alias("duration"), (4000 * (1 + e % 5)).cast("int").alias("sample_rate"))


def audio_docs(spark, sf_dir, config):
    rows = _spread(audio_rows(spark, sf_dir))
    key = F.concat(F.lit("raw/audio/"), F.col("event_id").cast("string"), F.lit(".wav"))
    said = F.concat(F.lit("talk "), "event_type")
    spoken = F.col("event_id") % 3 == 0
    segments = F.when(spoken, F.array(F.struct(F.lit(0.0).alias("start"), F.col("duration").alias("end"), said.alias("text"), F.lit(None).cast("string").alias("speaker"))))
    audio = F.struct(F.col("duration").alias("duration_sec"), "sample_rate", F.lit(1).alias("channels"), F.lit("pcm").alias("codec"))
    return _docs(
        rows.select(key.alias("source_key"), F.when(spoken, said).otherwise(F.lit("")).alias("content_text"), key.alias("media_path"), segments.alias("segments"), audio.alias("audio")), config
    )


def video_rows(spark, sf_dir):
    codecs = {"1": "h264", "2": "hevc", "3": "vp9", "4": "H264", "5": "av1"}
    table_ = F.create_map(*(F.lit(x) for p in codecs.items() for x in p))
    k = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", (k % 100 * 80 - 80).cast("double").alias("duration"), F.element_at(table_, F.substring("o_orderpriority", 1, 1)).alias("codec"), (640 + 640 * (k % 7)).cast("int").alias("width"))
        .withColumn("height", (F.col("width") * 9 / 16).cast("int"))
    )


def video_docs(spark, sf_dir, config):
    rows = _spread(video_rows(spark, sf_dir))
    key = F.concat(F.lit("raw/video/"), F.col("o_orderkey").cast("string"), F.lit(".mp4"))
    spoken = F.col("o_orderkey") % 3 == 0
    segments = F.when(spoken, F.array(F.struct(F.lit(0.0).alias("start"), F.col("duration").alias("end"), F.lit("speech").alias("text"), F.lit(None).cast("string").alias("speaker"))))
    rows = rows.withColumn("found", scenes(F.array().cast("array<double>"), F.col("duration"), config.video_min_scene_len_sec, 30.0))
    framed = F.transform(
        "found", lambda s: F.struct(s["scene_index"], s["start_sec"], s["end_sec"], F.concat_ws("_", key, F.lit("kf"), s["scene_index"]).alias("keyframe_path"), F.lit(None).cast("long").alias("phash"))
    )
    video = F.struct(F.col("duration").alias("duration_sec"), "width", "height", F.lit(25.0).alias("fps"), "codec", F.size("found").alias("scene_count"))
    return _docs(
        rows.select(key.alias("source_key"), F.when(spoken, F.lit("speech")).otherwise(F.lit("")).alias("content_text"), key.alias("media_path"), segments.alias("segments"), framed.alias("scenes"), video.alias("video")), config
    )


def all_docs(spark, sf_dir, config):
    out = text_docs(spark, sf_dir, config)
    for more in (page_docs, image_docs, audio_docs, video_docs):
        out = out.unionByName(more(spark, sf_dir, config))
    return out
