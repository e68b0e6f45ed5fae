"""Chunking: text windows, image tiles, audio windows, video scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import media, text
from ..functions.media import let

CHUNK = "array<struct<text:string,media_path:string,start_sec:double,end_sec:double,row:int,col:int,scene_index:int,is_tile:boolean,width:int,height:int>>"
#: Windows of a text that are cut from one block of it.
BLOCK = 64
_FIELDS = ("text", "media_path", "start_sec", "end_sec", "row", "col", "scene_index", "is_tile", "width", "height")


def chunk_id(doc_id: Column, ordinal: Column) -> Column:
    """The same on every run: MD5 of document and ordinal."""
    return F.md5(F.concat_ws(":", doc_id.cast("string"), ordinal.cast("string")))


def said_within(segments: Column, start: Column, end: Column) -> Column:
    """Texts of the segments that overlap [start, end), in order, joined by spaces."""
    own = F.filter(segments, lambda s: (s["start"] < end) & (s["end"] > start))
    return F.array_join(F.transform(own, lambda s: s["text"]), " ")


def transcript(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), " ")


def compose(*parts: Column) -> Column:
    """The parts that aren't empty, joined by line ends."""
    return F.concat_ws("\n", *(F.nullif(p, F.lit("")) for p in parts))


def _chunk(**own: Column) -> Column:
    return F.struct(*(own.get(k, F.lit(None)).alias(k) for k in _FIELDS))


def text_pieces(content: Column, window: int = 1000, overlap: int = 100) -> Column:
    """array<string>: the text of each of functions.text.text_windows().

    A substring is found by walking from a text's start, so windows are cut from blocks of BLOCK windows
    each: a very long text is walked once a block and not once a window.
    """
    overlap = overlap if overlap < window else 0
    step = window - overlap

    def cut(whole: Column, n: Column) -> Column:
        count = F.greatest(F.ceil((n - max(overlap, 0)) / step).cast("int"), F.lit(1))

        def block(b: Column) -> Column:
            own = F.sequence(F.lit(0), F.least(F.lit(BLOCK), count - b * BLOCK) - 1)
            piece = F.substring(whole, b * (BLOCK * step) + 1, F.lit((BLOCK - 1) * step + window))
            return let(piece, lambda t: F.transform(own, lambda i: F.substring(t, i * step + 1, F.lit(window))))

        windows = F.flatten(F.transform(F.sequence(F.lit(0), F.ceil(count / BLOCK).cast("int") - 1), block))
        if overlap <= 0:
            return windows
        tail = F.array(F.substring(whole, n - overlap + 1, F.lit(overlap)))
        return F.when(n <= overlap, F.array(whole)).otherwise(F.concat(windows, tail))

    return let(F.coalesce(content, F.lit("")), lambda whole: let(F.length(whole), lambda n: cut(whole, n)))


def text_chunks(content: Column, window: int = 1000, overlap: int = 100) -> Column:
    return F.transform(text_pieces(content, window, overlap), lambda t: _chunk(text=t))


def image_chunks(content: Column, path: Column, width: Column, height: Column, config: EngineConfig) -> Column:
    def one(t):
        tiled = t["row"].isNotNull()
        place = F.when(tiled, F.concat(path, F.lit("_tile_"), t["top"], F.lit("_"), t["left"], F.lit(".png"))).otherwise(path)
        return _chunk(text=content, media_path=place, row=t["row"], col=t["col"], is_tile=tiled, width=width, height=height)

    return F.transform(media.tiles(width, height, config.image_tile_threshold_px, config.image_tile_size_px), one)


def audio_chunks(content: Column, path: Column, segments: Column, duration: Column, config: EngineConfig) -> Column:
    windows = text.spans(duration, float(config.audio_chunk_window_sec), float(config.audio_chunk_overlap_sec))
    cut = F.transform(windows, lambda w: _chunk(text=said_within(segments, w["start"], w["end"]), media_path=path, start_sec=w["start"], end_sec=w["end"]))
    whole = F.array(_chunk(text=content, media_path=path))
    return F.when((duration > 0) & (F.size(segments) > 0), cut.cast(CHUNK)).otherwise(whole.cast(CHUNK))


def video_chunks(content: Column, segments: Column, scenes: Column) -> Column:
    """One a scene. A video without scenes is one chunk without media: its file is no image."""
    spoken = F.coalesce(segments, F.array().cast("array<struct<start:double,end:double,text:string,speaker:string>>"))
    cut = F.transform(
        scenes,
        lambda s: _chunk(
            text=said_within(spoken, s["start_sec"], s["end_sec"]), media_path=s["keyframe_path"], start_sec=s["start_sec"], end_sec=s["end_sec"], scene_index=s["scene_index"]
        ),
    )
    return F.when(F.size(scenes) > 0, cut.cast(CHUNK)).otherwise(F.array(_chunk(text=content)).cast(CHUNK))


def chunk_array(config: EngineConfig) -> Column:
    """The chunks of a document of the docs schema, in order."""
    m, t, p = F.col("modality"), F.col("content_text"), F.col("media_path")
    return (
        F.when(m == "text", text_chunks(t, config.text_window, config.text_overlap).cast(CHUNK))
        .when(m == "image", image_chunks(t, p, F.col("image.width"), F.col("image.height"), config).cast(CHUNK))
        .when(m == "audio", audio_chunks(t, p, F.col("segments"), F.col("audio.duration_sec"), config))
        .when(m == "video", video_chunks(t, F.col("segments"), F.col("scenes")))
    )


def indexed(config: EngineConfig) -> Column:
    """How many of a document's chunks get a vector where no model is given: counted in the document's
    row, without a row for each chunk."""
    m = F.col("modality")

    def has(c: Column) -> Column:
        said, shown = (F.length(F.coalesce(c[k], F.lit(""))) > 0 for k in ("text", "media_path"))
        seen = shown if config.embedding_strategy == "single_fused_vector" else F.lit(False)
        return F.when(m == "image", shown).when(m == "video", said | seen).otherwise(said)

    return F.coalesce(F.size(F.filter(chunk_array(config), has)), F.lit(0))


def chunks(docs: DataFrame, config: EngineConfig) -> DataFrame:
    """One row per chunk of the documents that no stage has stopped, with the document's key and facts.
    Narrow: windows, tiles and scenes are generated and transcripts sliced inside the document's row."""
    live = docs.where("status is null")
    # only what later stages read goes along, so that a document isn't copied for each of its chunks
    own = live.select("doc_id", "source_key", "modality", "image", "audio", "video", F.posexplode_outer(chunk_array(config)).alias("ordinal", "_c"))
    return own.select(
        "doc_id", "source_key", "modality", "image", "audio", "video", "ordinal",
        chunk_id(F.col("doc_id"), F.col("ordinal")).alias("chunk_id"),
        F.col("_c.text").alias("text"),
        F.col("_c.media_path").alias("chunk_media_path"),
        F.col("_c.start_sec").alias("start_sec"),
        F.col("_c.end_sec").alias("end_sec"),
        F.struct("_c.row", "_c.col", "_c.scene_index").alias("position"),
        F.struct("_c.is_tile", "_c.width", "_c.height").alias("chunk_meta"),
    )
