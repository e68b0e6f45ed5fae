"""Media files parsed, normalised and redacted; image headers by hand-made bytes."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tarnbeck.__main__ import main
from tarnbeck.config import EngineConfig
from tarnbeck.functions import files
from tarnbeck.operators import index
from tarnbeck.plans import ingest as plan
from tarnbeck.plans import stubs
from tarnbeck.sources import media


def png(width, height, more=b""):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + (chunk(b"eXIf", more) if more else b"") + chunk(b"IEND", b"")


def tiff(order="<"):
    make = b"Maker\0"
    entries = [(0x010F, 2, len(make), struct.pack(order + "I", 8 + 2 + 3 * 12 + 4)), (0x0112, 3, 1, struct.pack(order + "HH", 6, 0)), (0x0100, 4, 1, struct.pack(order + "I", 70))]
    body = struct.pack(order + "H", len(entries)) + b"".join(struct.pack(order + "HHI", t, k, n) + v for t, k, n, v in entries) + bytes(4)
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8) + body + make


def jpeg(width, height, exif=b""):
    def segment(marker, body):
        return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body

    app = segment(0xE1, b"Exif\0\0" + exif) if exif else b""
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0") + app + segment(0xC0, struct.pack(">BHHB", 8, height, width, 3)) + segment(0xDA, b"\0") + b"scan\xff\xd9"


def test_headers():
    assert files.image_size(png(640, 480)) == (640, 480, "PNG")
    assert files.image_size(jpeg(320, 200, tiff())) == (320, 200, "JPEG")
    assert files.image_size(b"GIF89a" + struct.pack("<HH", 7, 9)) == (7, 9, "GIF")
    assert files.image_size(b"BM" + bytes(16) + struct.pack("<ii", 5, -6)) == (5, 6, "BMP")
    assert files.image_size(b"RIFF\0\0\0\0WEBPVP8X" + bytes(8) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")) == (100, 50, "WEBP")
    for bad in (b"", b"x", b"\xff\xd8\xff", b"II*\0", b"\x89PNG\r\n\x1a\n"):
        with pytest.raises(Exception):
            files.image_size(bad)


@pytest.mark.parametrize("order", ["<", ">"])
def test_exif_is_read_and_dropped(order):
    for image in (jpeg(10, 20, tiff(order)), png(10, 20, tiff(order))):
        assert files.exif(image) == {"Make": "Maker", "Orientation": "6"}
        bare = files.without_exif(image)
        assert files.exif(bare) == {} and files.image_size(bare)[:2] == (10, 20) and b"Maker" not in bare
    assert files.exif(b"junk") == {} and files.exif(b"\xff\xd8\xff\xe1\0\x10Exif\0\0II") == {}


def objects_of(spark, rows):
    return spark.createDataFrame([(k, len(v), bytearray(v)) for k, v in rows], "source_key string, media_bytes_len long, content binary")


def test_real_images_without_tools(spark):
    rows = [("a.jpg", jpeg(300, 200, tiff())), ("b.png", png(100, 50)), ("c.png", b"broken"), ("d.wav", b"RIFF"), ("e.md", b"hello"), ("f.xyz", b"")]
    tools = media.Tools()
    got = plan.prepare(media.media_documents(objects_of(spark, rows), EngineConfig(), tools), EngineConfig(), tools=tools)
    got = {r["source_key"]: r for r in got.collect()}
    a = got["a.jpg"]
    assert (a["image"]["width"], a["image"]["format"], a["image"]["exif_stripped"], a["media_path"]) == (300, "JPEG", True, "a_noexif.jpg") and b"Maker" not in a["content"]
    assert got["c.png"]["reason"] == "validation_failed: Image too small: 0x0" and got["d.wav"]["reason"] == "parse_error: No audio stream found in d.wav"
    assert got["e.md"]["content_text"] == "hello" and got["e.md"]["status"] is None and got["f.xyz"]["status"] == "failed"


def test_media_reach_the_sink(spark):
    config = EngineConfig()
    docs = media.media_documents(objects_of(spark, [("raw/4.jpg", b"I|4|10"), ("raw/5.mp3", b"A|5|40")]), config, stubs.TOOLS)
    got = plan.ingest(docs, config, F.lit("2024-01-01 00:00:00").cast("timestamp"), tools=stubs.TOOLS)
    out = {r["processed_media_key"]: bytes(r["content"]) for r in index.media_records(got.chunks, got.docs, config).collect()}
    assert len(out) == 1 + 3 and set(out.values()) == {b"I|4|10|image:PNG", b"A|5|40|audio:wav,16000,1,silence=-40dB,loudnorm"}
    again = plan.reindex(index.chunk_records(got.chunks, config), config)
    assert again.where("modality = 'image'").count() == got.vectors.where("modality = 'image'").count() == 1


def test_a_tool_that_fails_for_one_file_fails_that_alone(spark):
    class Bad:
        def probe(self, many):
            if any(b"bad" in bytes(x) for x in many):
                raise OSError("cannot read")
            return ['{"format":{"duration":"3"},"streams":[{"codec_type":"audio","sample_rate":"8000"}]}' for _ in many]

    docs = media.media_documents(objects_of(spark, [("a.wav", b"bad"), ("b.wav", b"good")]).coalesce(1), EngineConfig(), media.Tools(probe=Bad))
    assert {r["source_key"]: r["reason"] for r in docs.collect()} == {"a.wav": "parse_error: cannot read", "b.wav": None}


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("some text")
    (tmp_path / "in" / "b.png").write_bytes(png(100, 50))
    args = ["--prefix", f"file://{tmp_path}/in", "--out", f"file://{tmp_path}/out"]
    assert main(args, spark) == 0
    assert spark.read.option("recursiveFileLookup", "true").json(f"file://{tmp_path}/out/manifests").where("status = 'success'").count() == 2
    (tmp_path / "in" / "c.txt").write_text(" ")
    assert main(args[:2] + ["--out", f"file://{tmp_path}/out2"], spark) == 1
    with pytest.raises(SystemExit):
        main(["--out", "x"], spark)


def test_few_python_processes_stand_in_a_task(spark, sf_dir):
    """Each step of tools in a plan is a Python process for each core of an executor."""
    from tarnbeck.plans import catalog

    def steps(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")

    docs = catalog._media(spark, sf_dir)
    assert steps(docs) <= 6  # image 1, audio 2, video 3; 10 before
    assert steps(media.refined(docs, catalog.M, stubs.TOOLS)) <= 8  # two more; six before
