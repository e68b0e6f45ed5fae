"""Text expressions against plain models, on random and on chosen strings."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnbeck.functions import text
from tarnbeck.operators import chunk, route, validate
from tarnbeck.config import EXTENSIONS, EngineConfig
import os.path

SPACES = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and chr(c).isspace()]
EDGE = ["", " ", "\u001c", "\u0085", " ", " x　", "a\u001fb", " a  b ", "\n\t", "x", "﻿x​"]
PII = [
    "mail a.b+c@d-e.co.uk now", "123-45-6789", "4111 1111 1111 1111", "4111-1111-1111-1111", "1234567890123", "1234567890123456", "1234567890123456789",
    "+1 (555) 123-4567", "call +1-555-123-4567.", "５５５-１２３-４５６７", "a@b.co555-123-4567", "x555-123-4567", "555 123 4567y", "_555-123-4567", "tel:5551234567", "é555-123-4567", "12 5551234567",
]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = [*"abcXYZ0123456789@.-+()_ é", "５", *SPACES, "𝒳"]
    return ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(n)]


def redact(s):
    pats = {k.upper(): p.replace("{b}", r"\b").replace("{s}", r"\s") for k, p in text.PII.items()}
    for k, p in pats.items():
        s = re.sub(p, f"[REDACTED_{k}]", s)
    return s


def windows(n, w=1000, o=100):
    """All (start, end) that the rule allows: starts are multiples of the step before the last o characters,
    and those characters themselves."""
    o = o if o < w else 0
    starts = {k * (w - o) for k in range(int(n // (w - o)) + 2) if k == 0 or k * (w - o) < n - o} | ({n - o} if 0 < o < n else set())
    return sorted((s, min(s + w, n)) for s in starts)


def test_windows_of_any_overlap(spark):
    for w, o in ((10, 3), (10, 0), (10, 10), (10, 12), (4, 3)):
        df = spark.range(0, 45).selectExpr("cast(id as int) as n").withColumn("t", F.repeat(F.lit("abcdefghi"), 5)).withColumn("t", F.substring("t", 1, F.col("n")))
        got = df.select("n", "t", text.spans(F.col("n"), w, o).alias("s"), chunk.text_pieces(F.col("t"), w, o).alias("p")).collect()
        for r in got:
            want = windows(r["n"], w, o)
            assert [tuple(x) for x in r["s"]] == want and list(r["p"]) == [r["t"][a:b] for a, b in want], (w, o, r["n"])


def test_white_space_is_the_29_code_points(spark):
    assert len(SPACES) == 29
    assert column(spark, SPACES, text.is_blank) == [True] * 29


def test_collapse(spark):
    values = EDGE + random_texts(400, 1)
    assert column(spark, values, text.collapse) == [" ".join(v.split()) for v in values]


def test_blank(spark):
    values = EDGE + [None]
    assert column(spark, values, text.is_blank) == [not v or not v.strip() for v in values]


def test_redact(spark):
    values = PII + random_texts(600, 2)
    assert column(spark, values, text.redact) == [redact(v) for v in values]


def test_windows(spark):
    sizes = [0, 1, 99, 100, 101, 500, 999, 1000, 1001, 1900, 1901, 12345]
    got = column(spark, ["x" * n for n in sizes], lambda c: text.text_windows(c, 1000, 100))
    assert [[tuple(w) for w in g] for g in got] == [windows(n) for n in sizes]


def test_chunks_count_code_points(spark):
    value = "𝒳é" * 800
    got = column(spark, [value, None, ""], lambda c: F.transform(chunk.text_chunks(c), lambda x: x["text"]))
    assert got[0] == [value[a:b] for a, b in windows(len(value))]
    assert got[1] == got[2] == [""]


def test_long_texts_are_cut_from_blocks(spark):
    rng = random.Random(4)
    values = ["".join(rng.choices("abé𝒳 ", k=n)) for n in (57_599, 57_600, 57_700, 57_701, 58_600, 115_300, 200_001)]
    got = column(spark, values, lambda c: chunk.text_pieces(c))
    assert got == [[v[a:b] for a, b in windows(len(v))] for v in values]
    got = column(spark, values[:1], lambda c: chunk.text_pieces(c, 50, 10))
    assert got[0] == [values[0][a:b] for a, b in windows(len(values[0]), 50, 10)]


def test_audio_spans(spark):
    sizes = [0.1, 5.0, 5.1, 30.0, 30.1, 55.0, 3600.0]
    df = spark.createDataFrame([(d,) for d in sizes], "d double").select("d", text.spans(F.col("d"), 30.0, 5.0).alias("w"))
    for d, got in ((r[0], r[1]) for r in df.collect()):
        want = windows(d, 30, 5)
        assert [(round(a, 9), round(b, 9)) for a, b in got] == [(round(a, 9), round(b, 9)) for a, b in want]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 20000))
def test_window_count_closed_form(n):
    w, o = 1000, 100
    assert len(windows(n)) == (1 if n <= o else -(-(n - o) // (w - o)) + 1)


def test_routing(spark):
    rng = random.Random(3)
    keys = ["a.PDF", ".mp4", "x.", "a.tar.gz", "dir.mp4/file", "..mp4", "raw/", "", "a/.b.TXT", "...x.md", "a.b/..c.wav"]
    keys += ["".join(rng.choices("a./MPdfmp4tx", k=rng.randrange(14))) for _ in range(500)]
    assert column(spark, keys, route.extension) == [os.path.splitext(k)[1].lower() for k in keys]
    assert column(spark, keys, lambda c: route.modality(c, EngineConfig())) == [EXTENSIONS.get(os.path.splitext(k)[1].lower()) for k in keys]


def test_config_from_env():
    got = EngineConfig.from_env({"ENABLE_EXIF_STRIP": "no", "TEXT_WINDOW": "500", "VIDEO_MIN_SCENE_LEN_SEC": "1.5", "VIDEO_ALLOWED_CODECS": "h264, av1", "EMBEDDING_STRATEGY": "x"})
    assert (got.enable_exif_strip, got.text_window, got.video_min_scene_len_sec, got.video_allowed_codecs, got.embedding_strategy) == (False, 500, 1.5, ("h264", "av1"), "x")


def test_validation_bounds(spark):
    c = EngineConfig()
    rows = [(31, 32, "PNG", 1), (32, 32, "png", 25 << 20), (32, 32, "gif", 1), (40, 40, "BMP", (25 << 20) + 104858), (40, 40, None, None), (None, 5, "PNG", 1)]
    df = spark.createDataFrame(rows, "w int, h int, f string, b long").coalesce(1)
    got = [r[0] for r in df.select(validate.image_reason(F.col("w"), F.col("h"), F.col("f"), F.col("b"), c)).collect()]
    assert got == ["Image too small: 31x32", None, "Unsupported image format: GIF", "Image exceeds max size: 25.1MB", "Unsupported image format: ", "Image too small: 0x5"]
    rows = [(0.5, 8000), (0.51, 7999), (3600.0, 8000), (3600.5, 8000)]
    df = spark.createDataFrame(rows, "d double, r int").coalesce(1)
    assert [r[0] for r in df.select(validate.audio_reason(F.col("d"), F.col("r"), c)).collect()] == [
        "Audio too short: 0.5s", "Sample rate too low: 7999Hz", None, "Audio exceeds max duration: 3600.5s"]
    rows = [(0.0, "h264", 1, 1), (7200.5, "h264", 1, 1), (7200.0, "H264", 1, 1), (1.0, "vp8", 3840, 1), (1.0, "vp9", 1, 3841)]
    df = spark.createDataFrame(rows, "d double, c string, w int, h int").coalesce(1)
    assert [r[0] for r in df.select(validate.video_reason(*(F.col(x) for x in "dcwh"), c)).collect()] == [
        "Zero/invalid video duration (likely corrupt container)", "Video exceeds max duration: 7200.5s", "Unsupported video codec: H264", None, "Video resolution exceeds max: 1x3841"]
