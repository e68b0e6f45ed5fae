"""Media facts that arrive as columns: hashes, tiles, scenes, probes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PROBE


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def average_hash(pixels: Column) -> Column:
    """Bits of a perceptual hash: bit i is set if pixel i is above the mean. Null without pixels."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda a, x: a + x) / F.size(pixels)
    bits = F.transform(pixels, lambda x, i: F.when(x > mean, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(pixels) > 0, F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits; -1 if either hash is missing."""
    return F.coalesce(F.bit_count(a.bitwiseXOR(b)), F.lit(-1))


def hash_text(bits: Column) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def hash_bits(text: Column) -> Column:
    """The hash of hash_text(); null for anything else."""
    high, low = (F.conv(F.substring(text, k, 8), 16, 10).cast("long") for k in (1, 9))
    return F.when(text.rlike("^[0-9a-fA-F]{16}$"), F.call_function("shiftleft", high, F.lit(32)).bitwiseOR(low))


def tiles(width: Column, height: Column, threshold: int, size: int) -> Column:
    """array<struct<row,col,left,top,right,bottom>> in row order; one null-placed entry for an image no
    side of which is above threshold, or of no extent."""
    rows = F.sequence(F.lit(0), F.ceil(height / size).cast("int") - 1)
    cols = F.sequence(F.lit(0), F.ceil(width / size).cast("int") - 1)

    def tile(r, c):
        return F.struct(
            r.cast("int").alias("row"), c.cast("int").alias("col"), (c * size).cast("int").alias("left"), (r * size).cast("int").alias("top"),
            F.least((c + 1) * size, width).cast("int").alias("right"), F.least((r + 1) * size, height).cast("int").alias("bottom"),
        )

    none = F.lit(None).cast("int")
    whole = F.array(F.struct(*(none.alias(k) for k in ("row", "col", "left", "top", "right", "bottom"))))
    cut = (F.greatest(width, height) > threshold) & (F.least(width, height) > 0)
    return F.when(cut, F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: tile(r, c))))).otherwise(whole)


def parse_cuts(log: Column) -> Column:
    """Cut times from scene-detection log lines: the number behind pts_time: in each; bad ones go."""
    own = F.transform(log, lambda line: F.regexp_extract(line, r"pts_time:([^ ]*)", 1).try_cast("double"))
    return F.filter(own, lambda t: t.isNotNull())


def scenes(cuts: Column, duration: Column, shortest: float, window: float) -> Column:
    """array<struct<scene_index,start_sec,end_sec>>: boundaries at 0, each cut and the end; a scene
    shorter than shortest grows to the next boundary, the last may be short. Fewer than two scenes
    give way to fixed windows without overlap."""
    zero = F.lit(0).cast("double")
    all_bounds = F.array_sort(F.array_distinct(F.concat(F.array(zero), F.transform(cuts, lambda c: c.cast("double")), F.array(duration.cast("double")))))

    def merged(bounds):
        last = F.element_at(bounds, -1)
        start = F.struct(F.element_at(bounds, 1).alias("at"), F.array().cast("array<struct<start_sec:double,end_sec:double>>").alias("out"))

        def step(acc, end):
            grown = F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start_sec"), end.alias("end_sec")))).alias("out"))
            return F.when((end - acc["at"] >= shortest) | (end == last), grown).otherwise(acc)

        return F.aggregate(F.slice(bounds, 2, F.greatest(F.size(bounds) - 1, F.lit(0))), start, step, lambda acc: acc["out"])

    chosen = let(let(all_bounds, merged), lambda m: F.when(F.size(m) < 2, fixed_scenes(duration, window)).otherwise(m))
    return F.transform(chosen, lambda s, i: F.struct(i.cast("int").alias("scene_index"), s["start_sec"], s["end_sec"]))


def fixed_scenes(duration: Column, window: float) -> Column:
    d = duration.cast("double")
    own = F.transform(
        F.sequence(F.lit(0), F.ceil(d / window).cast("int") - 1),
        lambda i: F.struct((i * F.lit(float(window))).alias("start_sec"), F.least((i + 1) * F.lit(float(window)), d).alias("end_sec")),
    )
    return F.when(d > 0, own).otherwise(F.array().cast("array<struct<start_sec:double,end_sec:double>>"))


def keyframe_time(scene: Column) -> Column:
    return (scene["start_sec"] + scene["end_sec"]) / 2


def frame_times(duration: Column, fps: float) -> Column:
    """Times of frames sampled at fps."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(duration * fps).cast("int"), F.lit(1)) - 1), lambda i: i / F.lit(float(fps)))


def prune_scenes(scene_list: Column, distance: int) -> Column:
    """Drop each scene whose keyframe is within distance of the last kept one with a keyframe. Scenes
    without keyframe stay and don't move the comparison. A missing hash counts as near."""
    kept = F.filter(scene_list, lambda s: F.lit(False))
    start = F.struct(F.lit(None).cast("long").alias("last"), kept.alias("out"))

    def step(acc, s):
        framed = F.length(F.coalesce(s["keyframe_path"], F.lit(""))) > 0
        near = framed & acc["last"].isNotNull() & (hamming(s["phash"], acc["last"]) <= distance)
        last = F.when(framed, s["phash"]).otherwise(acc["last"])
        return F.when(near, acc).otherwise(F.struct(last.alias("last"), F.concat(acc["out"], F.array(s)).alias("out")))

    folded = F.aggregate(scene_list, start, step, lambda acc: acc["out"])
    # without any hash every scene stays
    return F.when(F.exists(scene_list, lambda s: s["phash"].isNotNull()), folded).otherwise(scene_list)


def _stream(probe: Column, kind: str) -> Column:
    return F.get(F.filter(probe["streams"], lambda s: s["codec_type"] == kind), F.lit(0))


def _duration(probe: Column, stream: Column) -> Column:
    return F.coalesce(F.coalesce(probe["format"]["duration"], stream["duration"]).try_cast("double"), F.lit(0.0))


def parse_video_probe(text: Column) -> Column:
    """struct of video facts from probe JSON; null if it doesn't parse or has no video stream."""
    probe = F.from_json(text, PROBE)
    video = _stream(probe, "video")
    rate = F.split(F.coalesce(video["avg_frame_rate"], F.lit("0/1")), "/")
    fps = F.when(F.size(rate) == 2, F.try_divide(F.get(rate, F.lit(0)).try_cast("double"), F.get(rate, F.lit(1)).try_cast("double")))
    return F.when(
        video.isNotNull(),
        F.struct(
            _duration(probe, video).alias("duration_sec"),
            F.coalesce(video["width"], F.lit(0)).alias("width"),
            F.coalesce(video["height"], F.lit(0)).alias("height"),
            F.coalesce(fps, F.lit(0.0)).alias("fps"),
            F.coalesce(video["codec_name"], F.lit("unknown")).alias("codec"),
            _stream(probe, "audio").isNotNull().alias("has_audio"),
        ),
    )


def parse_audio_probe(text: Column) -> Column:
    """struct of audio facts from probe JSON; null if it doesn't parse or has no audio stream."""
    probe = F.from_json(text, PROBE)
    audio = _stream(probe, "audio")
    return F.when(
        audio.isNotNull(),
        F.struct(
            _duration(probe, audio).alias("duration_sec"),
            F.coalesce(audio["sample_rate"].try_cast("int"), F.lit(0)).alias("sample_rate"),
            F.coalesce(audio["channels"], F.lit(0)).alias("channels"),
            F.coalesce(audio["codec_name"], F.lit("unknown")).alias("codec"),
        ),
    )


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    """A normalised face box in whole pixels, cut off at 0; null where nothing is left of it."""
    x, y = (F.greatest((box[k] * n).cast("int"), F.lit(0)) for k, n in (("left", width), ("top", height)))
    w, h = ((box[k] * n).cast("int") for k, n in (("width", width), ("height", height)))
    right, bottom = F.least(x + w, width), F.least(y + h, height)
    return F.when((right > x) & (bottom > y), F.struct(x.alias("x"), y.alias("y"), right.alias("right"), bottom.alias("bottom")))


def odd_kernel(size: int) -> int:
    return size if size % 2 else size + 1
