"""Media objects to documents: each modality's parser, with the tools it needs as calls of columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..config import EngineConfig
from ..functions import files, media
from ..functions.media import let
from ..operators import chunk
from ..operators.models import Asr, Captioner, Codec, FaceDetector, Ocr, Probe, lines
from ..operators.route import route
from ..operators.validate import fail
from ..schemas import SEGMENTS
from .objects import as_docs, decode_text, doc_id

#: The option of a file that stays as it is.
KEEP = "keep"
#: Rows that tools get at once.
ROWS = 512
_FACTS = "struct<width:int,height:int,format:string,exif:map<string,string>,phash:bigint>"


class ImageReader(Protocol):
    """Width, height, format, EXIF and perceptual hash (None without pixels) of each image."""

    def read(self, images: list[bytes]) -> list[tuple[int, int, str, dict[str, str], int | None]]: ...


class HeaderReader:
    """Reads image headers itself; no pixels, so no hash."""

    def read(self, images):
        return [(*files.image_size(x), files.exif(x), None) for x in map(bytes, images)]


@dataclass(frozen=True)
class Tools:
    """What makes each tool, once a task; None for a tool that isn't there. Whatever a tool raises for one
    file is that file's error alone."""

    reader: Callable[[], ImageReader] = HeaderReader
    probe: Callable[[], Probe] | None = None
    codec: Callable[[], Codec] | None = None
    ocr: Callable[[], Ocr] | None = None
    captioner: Callable[[], Captioner] | None = None
    asr: Callable[[], Asr] | None = None
    faces: Callable[[], FaceDetector] | None = None


def _tried(tool: Callable[..., list], args: list[list]) -> list[dict | None]:
    """Value and error of each row; None where the first argument is. A batch that raises is tried again row
    by row, so that a bad file is an error of its own row alone."""
    at = [i for i, x in enumerate(args[0]) if x is not None]
    found: list = [None] * len(args[0])
    try:
        for i, v in zip(at, tool(*([a[i] for i in at] for a in args)) if at else [], strict=True):
            found[i] = {"value": v, "error": None}
    except Exception:
        for i in at:
            try:
                found[i] = {"value": tool(*([a[i]] for a in args))[0], "error": None}
            except Exception as e:
                found[i] = {"value": None, "error": str(e) or type(e).__name__}
    return found


@dataclass(frozen=True)
class Call:
    """A tool over columns: out, struct<value, error>, is added. make is called once a task and gives a function
    from lists, one a column, to a list of results; rows whose first column is null aren't handed over.
    first, if given, makes the first list from that column's and from what earlier calls of the same
    step have found, by name."""

    out: str
    make: Callable[[], Callable[..., list]] | None
    returns: str
    columns: tuple[Column, ...]
    first: Callable[[list, dict[str, list]], list] | None = None


def called(rows: DataFrame, *calls: Call) -> DataFrame:
    """Adds the results of calls, in order, in one step: each step of a plan has a Python process for
    each core, however many calls it makes. ROWS at a time are handed over."""
    none = [c for c in calls if c.make is None]
    for c in none:
        rows = rows.withColumn(c.out, F.struct(F.lit(None).cast(c.returns).alias("value"), F.lit(None).cast("string").alias("error")))
    calls = tuple(c for c in calls if c.make is not None)
    if not calls:
        return rows
    names = [[f"_in{i}_{k}" for k in range(len(c.columns))] for i, c in enumerate(calls)]
    full = rows.select("*", *(x.alias(n) for c, own in zip(calls, names, strict=True) for x, n in zip(c.columns, own, strict=True)))
    kinds = [T._parse_datatype_string(f"struct<value:{c.returns},error:string>") for c in calls]
    arrows = [to_arrow_type(k) for k in kinds]
    # what goes along to executors has no columns, which can't be pickled
    steps = [(c.out, c.make, c.first, own) for c, own in zip(calls, names, strict=True)]
    keep = list(rows.columns)

    def run(batches):
        tools = [make() for _, make, _, _ in steps]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                got: dict[str, list] = {}
                for tool, (out, _, first, own) in zip(tools, steps, strict=True):
                    args = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in own]
                    if first is not None:
                        args[0] = first(args[0], got)
                    got[out] = _tried(tool, args)
                made = [pa.array(got[out], arrow) for (out, *_), arrow in zip(steps, arrows, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *made], [*keep, *got])

    return full.mapInArrow(run, T.StructType([*rows.schema.fields, *(T.StructField(c.out, k) for c, k in zip(calls, kinds, strict=True))]))


def _values(found: list) -> list:
    return [None if x is None else x["value"] for x in found]


def _instead_of(name: str) -> Callable[[list, dict[str, list]], list]:
    """What an earlier call made of a file, the file itself where it made nothing; null where that is null."""
    return lambda files_, got: [x if x is None or v is None else v for x, v in zip(files_, _values(got[name]) if name in got else [None] * len(files_), strict=True)]


def _method(make: Callable | None, name: str) -> Callable | None:
    return None if make is None else lambda: getattr(make(), name)


def _each(make: Callable | None) -> Callable | None:
    """Conversions of one file, or of an array of files, one for each of an array of options; null where one
    fails or the option is KEEP."""
    if make is None:
        return None

    def start():
        codec = make()

        def one(x, option):
            if x is None or option == KEEP:
                return None
            try:
                return codec.convert([x], [option])[0]
            except Exception:
                return None

        def run(files_, options):
            pairs = ((x if isinstance(x, list) else [x] * len(own or []), own) for x, own in zip(files_, options, strict=True))
            return [None if own is None else [one(x, o) for x, o in zip(many, own, strict=True)] for many, own in pairs]

        return run

    return start


def _facts(make: Callable) -> Callable:
    def start():
        reader = make()
        names = ("width", "height", "format", "exif", "phash")
        return lambda images: [dict(zip(names, (w, h, f, list(x.items()), p), strict=True)) for w, h, f, x, p in reader.read(images)]

    return start


def media_documents(objects: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    """Route objects (source_key, media_bytes_len, content) and parse them by modality.

    Images: size, format and EXIF (0 x 0 and UNKNOWN where they can't be read), the lines of OCR and a
    caption as text, each if enabled. Audio: probed facts and transcript. Video: probed facts, the
    transcript of its audio track if it has one, scenes from the codec's cut log, and a keyframe from the
    middle of each. A file that can't be probed, or whose track can't be taken out, has the status failed
    and the reason parse_error; failures of OCR, captions and transcripts leave the text empty.
    """
    routed = route(objects, config).withColumn("doc_id", doc_id(F.col("source_key")))
    parsers = {"text": _text, "image": _image, "audio": _audio, "video": _video}
    out = as_docs(routed.where("modality is null").withColumn("content", F.lit(None).cast("binary")))
    for name, parser in parsers.items():
        out = out.unionByName(as_docs(parser(routed.where(F.col("modality") == name), config, tools)))
    return out


def _text(rows: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    return rows.withColumn("content_text", decode_text(F.col("content"))).withColumn("content", F.lit(None).cast("binary"))


def _image(rows: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    own = (F.col("content"),)
    rows = called(
        rows,
        Call("_f", _facts(tools.reader), _FACTS, own),
        Call("_o", _method(tools.ocr, "read") if config.image_enable_ocr else None, "array<struct<kind:string,text:string>>", own),
        Call("_c", _method(tools.captioner, "caption") if config.image_enable_captioning else None, "string", own),
    )
    rows = rows.withColumns({k: F.col(f"{k}.value") for k in ("_f", "_o", "_c")})
    seen, caption = lines(F.col("_o")), F.coalesce("_c", F.lit(""))
    image = F.struct(
        F.coalesce("_f.width", F.lit(0)).alias("width"), F.coalesce("_f.height", F.lit(0)).alias("height"), F.coalesce("_f.format", F.lit("UNKNOWN")).alias("format"),
        F.coalesce("_f.exif", F.create_map().cast("map<string,string>")).alias("exif"), seen.alias("ocr_text"), caption.alias("caption"), F.col("_f.phash").alias("phash"),
        F.lit(None).cast("boolean").alias("is_duplicate"), F.lit(False).alias("exif_stripped"),
    )
    return rows.withColumn("content_text", chunk.compose(caption, seen)).withColumn("image", image).withColumn("media_path", F.col("source_key"))


def _segments() -> Column:
    return F.coalesce("_a.value", F.array().cast(SEGMENTS))


def _audio(rows: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    rows = called(rows, Call("_p", _method(tools.probe, "probe"), "string", (F.col("content"),))).withColumn("audio", media.parse_audio_probe(F.col("_p.value")))
    why = F.coalesce(F.col("_p.error"), F.when(F.col("audio").isNull(), F.concat(F.lit("No audio stream found in "), "source_key")))
    heard = F.when(F.col("audio").isNotNull(), F.col("content"))
    rows = called(fail(rows, "parse_error", why), Call("_a", _method(tools.asr, "transcribe"), SEGMENTS, (heard,))).withColumn("segments", _segments())
    return rows.withColumn("content_text", chunk.transcript(F.col("segments"))).withColumn("media_path", F.col("source_key"))


def _video(rows: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    rows = called(rows, Call("_p", _method(tools.probe, "probe"), "string", (F.col("content"),))).withColumn("_v", media.parse_video_probe(F.col("_p.value")))
    convert, whole = _method(tools.codec, "convert"), F.when(F.col("_v").isNotNull(), F.col("content"))
    track = F.when(F.col("_v.has_audio"), F.col("content"))
    rows = called(
        rows,
        Call("_t", convert, "binary", (track, F.lit("audio_track:wav,16000,1"))),
        # without a codec there is no track
        Call("_a", _method(tools.asr, "transcribe") if convert else None, SEGMENTS, (F.lit(None).cast("binary"),), lambda _, got: _values(got["_t"])),
        Call("_l", convert, "binary", (whole, F.lit(f"scene_log:{config.video_scene_threshold / 100}"))),
    )
    why = F.coalesce(F.col("_p.error"), F.when(F.col("_v").isNull(), F.concat(F.lit("No video stream found in "), "source_key")), F.col("_t.error"))
    rows = fail(rows, "parse_error", why).withColumn("segments", _segments()).withColumn("_l", F.split(F.decode("_l.value", "ISO-8859-1"), "\n"))
    cuts = F.coalesce(media.parse_cuts(F.col("_l")), F.array().cast("array<double>"))
    rows = rows.withColumn("_s", F.when(F.col("_v").isNotNull(), media.scenes(cuts, F.col("_v.duration_sec"), float(config.video_min_scene_len_sec), 30.0)))
    times = F.transform("_s", lambda s: F.concat(F.lit("frame:"), media.keyframe_time(s).cast("string")))
    rows = called(rows, Call("frames", _each(tools.codec), "array<binary>", (whole, times))).withColumn("frames", F.col("frames.value"))
    path = F.concat(F.col("source_key"), F.lit("_scene_"))
    framed = F.zip_with(
        "_s",
        F.coalesce("frames", F.transform("_s", lambda s: F.lit(None).cast("binary"))),
        lambda s, f: F.struct(
            s["scene_index"], s["start_sec"], s["end_sec"],
            F.when(f.isNotNull(), F.concat(path, F.lpad(s["scene_index"].cast("string"), 4, "0"), F.lit(".jpg"))).alias("keyframe_path"), F.lit(None).cast("bigint").alias("phash"),
        ),
    )
    v = F.col("_v")
    video = F.struct(*(v[k].alias(k) for k in ("duration_sec", "width", "height", "fps", "codec")), F.size("_s").alias("scene_count"))
    rows = rows.withColumn("scenes", framed).withColumn("video", F.when(v.isNotNull(), video))
    return rows.withColumn("content_text", chunk.transcript(F.col("segments"))).withColumn("media_path", F.col("source_key"))


def _instead(docs: DataFrame, made: str, suffix: Column) -> DataFrame:
    """content and media_path of what a tool made; as they were where it made nothing."""
    did = F.col(made).isNotNull()
    docs = docs.withColumn("content", F.when(did, F.col(made)).otherwise(F.col("content")))
    return docs.withColumn("media_path", F.when(did, F.concat(F.regexp_replace("media_path", r"\.[^./]*$", ""), suffix)).otherwise(F.col("media_path"))).drop(made)


def _of(modality: str, column: str = "content") -> Column:
    return F.when(F.col("status").isNull() & (F.col("modality") == modality), F.col(column))


def _boxes(found: Column, kernel: int) -> Column:
    """The blur option for the boxes found, in parts of the picture; null without any."""
    own = F.filter(found, lambda b: (b["width"] > 0) & (b["height"] > 0))
    text = F.array_join(F.transform(own, lambda b: F.concat_ws(",", *(b[k].cast("string") for k in ("left", "top", "width", "height")))), ";")
    return F.when(F.size(own) > 0, F.concat(F.lit(f"blur:{kernel}:"), text))


class _Strip:
    def strip(self, images):
        return [files.without_exif(bytes(x)) for x in images]


def _refined(docs: DataFrame, config: EngineConfig, tools: Tools, normal: bool, faces: bool, strip: Callable | None) -> DataFrame:
    """The steps of refined() that are asked for, in two calls of tools: what a later one needs of an earlier
    one's file it is handed in the same Python process."""
    normal, faces = normal and tools.codec is not None, faces and tools.faces is not None and tools.codec is not None
    convert, box = _method(tools.codec, "convert"), "struct<left:double,top:double,width:double,height:double>"
    image, kernel = F.col("modality") == "image", media.odd_kernel(config.face_blur_kernel)

    def start():
        found = tools.faces()
        return lambda frames: [[[] if f is None else found.detect([f])[0] for f in own] for own in frames]

    first, then = [], []
    if normal:
        option = F.when(image, F.lit("image:PNG")).otherwise(F.lit("audio:wav,16000,1,silence=-40dB,loudnorm"))
        first.append(Call("_n", convert, "binary", (F.coalesce(_of("image"), _of("audio")), option)))
    if faces:
        first.append(Call("_b", _method(tools.faces, "detect"), f"array<{box}>", (_of("image"),), _instead_of("_n")))
        first.append(Call("_bf", start, f"array<array<{box}>>", (_of("video", "frames"),)))
    docs = called(docs, *first)
    if normal:
        docs = _instead(docs.withColumn("_n", F.col("_n.value")), "_n", F.when(image, F.lit("_normalized.png")).otherwise(F.lit("_cleaned.wav")))
    if faces:
        docs = docs.withColumn("_b", _boxes(F.col("_b.value"), kernel))
        docs = docs.withColumn("_bf", F.transform("_bf.value", lambda b: F.coalesce(_boxes(b, kernel), F.lit(KEEP))))
        then.append(Call("_r", convert, "binary", (F.when(F.col("_b").isNotNull(), F.col("content")), F.col("_b"))))
        some = F.exists("_bf", lambda o: o != KEEP)
        then.append(Call("_rf", _each(tools.codec), "array<binary>", (F.when(some, F.col("frames")), F.col("_bf"))))
    if strip is not None:
        then.append(Call("_x", _method(strip, "strip"), "binary", (_of("image"),), _instead_of("_r")))
    docs = called(docs, *then)
    suffix = F.element_at(F.split("media_path", r"\."), -1)
    if faces:
        docs = _instead(docs.withColumn("_r", F.col("_r.value")), "_r", F.concat(F.lit("_redacted."), suffix)).withColumn("_rf", F.col("_rf.value"))
        mixed = F.zip_with(F.col("frames"), F.arrays_zip("_bf", "_rf"), lambda f, z: F.when((z["_bf"] == KEEP) | z["_rf"].isNull(), f).otherwise(z["_rf"]))
        docs = docs.withColumn("frames", F.when(F.col("_rf").isNotNull(), mixed).otherwise(F.col("frames"))).drop("_b", "_bf", "_rf")
    if strip is not None:
        docs = _instead(docs.withColumn("_x", F.col("_x.value")), "_x", F.concat(F.lit("_noexif."), suffix))
    return docs


def refined(docs: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    """normalize(), redact_faces() and strip_exif(), one after another."""
    return _refined(docs, config, tools, True, config.enable_face_redaction, _Strip if config.enable_exif_strip else None)


def normalize(docs: DataFrame, tools: Tools) -> DataFrame:
    """Images to PNG, audio to loudness-normalised 16 kHz mono without leading silence; the original where
    that fails."""
    return _refined(docs, EngineConfig(), tools, True, False, None)


def redact_faces(docs: DataFrame, config: EngineConfig, tools: Tools) -> DataFrame:
    """Blur the faces of images and of keyframes; as they were where no face is found or the codec fails."""
    return _refined(docs, config, tools, False, config.enable_face_redaction, None)


def strip_exif(docs: DataFrame, config: EngineConfig, make: Callable = _Strip) -> DataFrame:
    """Images without EXIF; those in formats that can't be stripped stay as they are."""
    return _refined(docs, config, Tools(), False, False, make if config.enable_exif_strip else None)
