"""The traps of the whole flow, each by its hand-made documents."""

import pytest
from pyspark.sql import functions as F

from tarnbeck.config import EngineConfig
from tarnbeck.operators import index, models
from tarnbeck.operators.route import route
from tarnbeck.plans import ingest as plan
from tarnbeck.sources import objects, sinks

AT = "2024-01-01 00:00:00"
IMG = dict(width=100, height=100, format="PNG", exif={"a": "b"}, ocr_text="", caption="", phash=None, is_duplicate=None, exif_stripped=False)
SEG = "array<struct<start:double,end:double,text:string,speaker:string>>"


def docs_of(spark, rows, config=EngineConfig()):
    full = ["source_key", "content_text", "media_path", "media_bytes_len", "segments", "scenes", "image", "audio", "video"]
    types = {k: v for k, v in __import__("tarnbeck.schemas", fromlist=["DOCS"]).DOCS.items()}
    schema = ", ".join(f"{k} {types[k]}" for k in full)
    df = spark.createDataFrame([tuple(r.get(k) for k in full) for r in rows], schema)
    return objects.as_docs(route(df, config).withColumn("doc_id", objects.doc_id(F.col("source_key"))))


def run(spark, rows, config=EngineConfig(), **more):
    got = plan.ingest(docs_of(spark, rows, config), config, F.lit(AT).cast("timestamp"), **more)
    return got, {r["s3_key"]: (r["status"], r["reason"], r["chunks_indexed"]) for r in got.manifest.collect()}


def audio(key, segments, d=40.0, text=None):
    said = " ".join(s[2] for s in segments) if text is None else text
    return dict(source_key=key, content_text=said, media_path=key, segments=segments, audio=(d, 16000, 1, "pcm"))


def video(key, segments, scenes, d=40.0):
    return dict(source_key=key, content_text=" ".join(s[2] for s in segments), media_path=key, segments=segments, scenes=scenes, video=(d, 640, 360, 25.0, "h264", len(scenes)))


def test_statuses(spark):
    rows = [
        dict(source_key="a.txt", content_text="x" * 500),
        dict(source_key="b.txt", content_text="x" * 500),  # equal texts are both indexed
        dict(source_key="c.xyz", content_text="x"),
        dict(source_key="d.txt", content_text=" \n"),
        dict(source_key="img/1.png", content_text="", media_path="img/1.png", media_bytes_len=10, image=IMG | {"phash": 7}),
        dict(source_key="img/2.png", content_text="", media_path="img/2.png", media_bytes_len=10, image=IMG | {"phash": 6}),
        dict(source_key="img/0.png", content_text="", media_path="img/0.png", media_bytes_len=10, image=IMG | {"phash": 7, "width": 3}),  # invalid: never registers
        audio("s.wav", [], text=""),  # no transcript: nothing to index
        audio("t.wav", [(0.0, 10.0, "hello", None), (10.0, 35.0, "world", None)]),
    ]
    got, m = run(spark, rows)
    assert m["a.txt"] == m["b.txt"] == ("success", "ok", 2)
    assert m["c.xyz"] == ("failed", "Unsupported file extension '.xyz' for key: c.xyz", 0)
    assert m["d.txt"] == ("failed", "validation_failed: Empty text content", 0)
    assert m["img/1.png"] == ("success", "ok", 1) and m["img/2.png"] == ("skipped", "duplicate_detected", 0)
    assert m["img/0.png"] == ("failed", "validation_failed: Image too small: 3x100", 0)
    assert m["s.wav"] == ("failed", "no_chunks_indexed", 0)
    assert m["t.wav"] == ("success", "ok", 2)  # nothing is said in its last window
    held = {r["s3_key"]: r["quarantine_key"] for r in got.quarantine.collect()}
    assert held == {"d.txt": "quarantine/text/d.txt", "img/0.png": "quarantine/image/img/0.png"}
    assert index.run_summary(got.manifest).first().asDict() == {"success": 4, "failed": 4, "skipped": 1}
    assert index.exit_code(got.manifest) == 1
    # audit records are more than vectors: the silent recording has one
    assert index.chunk_records(got.chunks).where("doc_id = md5('s.wav')").count() == 1
    assert got.vectors.where("doc_id = md5('s.wav')").isEmpty()


def test_strict_quarantine_keeps_base_name(spark):
    rows = [dict(source_key="x/d.txt", content_text=""), dict(source_key="y/d.txt", content_text="")]
    got, _ = run(spark, rows, EngineConfig(strict=True))
    assert {r["quarantine_key"] for r in got.quarantine.collect()} == {"quarantine/text/d.txt"}


def test_audio_slices_and_split_data(spark):
    segments = [(0.0, 25.0, "call 555-123", None), (25.0, 30.0, "4567 end", None), (30.0, 40.0, "ssn 123-45-6789", None)]
    got, _ = run(spark, [audio("t.wav", segments)])
    c = got.chunks.orderBy("ordinal").collect()
    assert [(r["start_sec"], r["end_sec"]) for r in c] == [(0.0, 30.0), (25.0, 40.0), (35.0, 40.0)]
    # data split over segments stays in chunks; bounds that only touch don't overlap
    assert [r["text"] for r in c] == ["call 555-123 4567 end", "4567 end ssn [REDACTED_SSN]", "ssn [REDACTED_SSN]"]


def test_video_transcript_redaction(spark):
    rows = [video("v.mp4", [(0.0, 10.0, "a@b.com", None)], [(0, 0.0, 20.0, "k0", 1), (1, 20.0, 40.0, "k1", -1)])]
    got, m = run(spark, rows)
    assert [r["text"] for r in got.chunks.orderBy("ordinal").collect()] == ["[REDACTED_EMAIL]", ""]
    assert m["v.mp4"] == ("success", "ok", 1)
    v = {r["key"].endswith("_aux"): r for r in got.vectors.collect()}
    assert v[False]["has_aux_vector"] and v[True]["vector_role"] == "aux_image" and len(v) == 2  # the silent scene's image is lost
    got, _ = run(spark, rows, EngineConfig(strict=True))
    assert got.chunks.orderBy("ordinal").first()["text"] == "a@b.com"
    _, m = run(spark, rows, EngineConfig(embedding_strategy="single_fused_vector"))
    assert m["v.mp4"] == ("success", "ok", 2)


def test_video_without_scenes_sends_no_file(spark):
    got, m = run(spark, [video("v.mp4", [(0.0, 1.0, "hi", None)], [])])
    r = got.chunks.first()
    assert (r["text"], r["chunk_media_path"]) == ("hi", None) and m["v.mp4"] == ("success", "ok", 1)


def test_scene_count_is_before_pruning(spark):
    got, _ = run(spark, [video("v.mp4", [(0.0, 40.0, "hi", None)], [(0, 0.0, 20.0, "k0", 1), (1, 20.0, 40.0, "k1", 1)])])
    r = got.chunks.select("metadata.video_meta.*").collect()
    assert len(r) == 1 and (r[0]["scene_count"], r[0]["scene_index"], r[0]["resolution"]) == (2, 0, "640x360")


def test_redacted_flag_is_true_to_the_run(spark):
    rows = [dict(source_key="a.txt", content_text="a@b.com")]
    for config, text, flag in ((EngineConfig(), "[REDACTED_EMAIL]", True), (EngineConfig(enable_pii_text_redaction=False), "a@b.com", False), (EngineConfig(enable_pii_text_redaction=False, strict=True), "a@b.com", True)):
        r = run(spark, rows, config)[0].chunks.first()
        assert (r["text"], r["metadata"]["pii_redacted"]) == (text, flag)


def test_metadata_blocks(spark):
    rows = [dict(source_key="a.txt", content_text="hello"), dict(source_key="i.png", content_text="t", media_path="i.png", image=IMG | {"width": 5000, "height": 10000, "phash": 255, "ocr_text": "t"})]
    got, m = run(spark, rows)
    assert m["i.png"][2] == 15
    r = {x["source_key"]: x["metadata"] for x in got.chunks.where("ordinal = 0").collect()}
    assert r["a.txt"]["text_meta"]["char_count"] == 5 and r["a.txt"]["image_meta"] is None
    i = r["i.png"]["image_meta"]
    assert (i["is_tile"], tuple(i["tile_position"]), i["perceptual_hash"], i["ocr_text_present"], i["exif_stripped"]) == (True, (0, 0), "00000000000000ff", True, True)
    assert r["a.txt"]["ingestion_timestamp"] == "2024-01-01T00:00:00.000000Z"


def test_chunk_ids_repeat(spark):
    rows = [dict(source_key="a.txt", content_text="x" * 2500)]
    ids = [sorted(r["chunk_id"] for r in run(spark, rows)[0].chunks.collect()) for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 4


class Failing:
    """Embeds texts, but raises on one."""

    def embed(self, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return [[float(len(t))] for t in texts]


def test_failing_model_loses_only_its_chunk(spark):
    rows = [dict(source_key="a.txt", content_text="good"), dict(source_key="b.txt", content_text="bad")]
    _, m = run(spark, rows, text_model=Failing)
    assert m == {"a.txt": ("success", "ok", 1), "b.txt": ("failed", "no_chunks_indexed", 0)}


def test_decode_drops_invalid_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"ab\xff\xfec\r\nd\re")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.png").write_bytes(b"png")
    found = objects.choose(spark, prefix=f"file://{tmp_path}")
    docs = {r["source_key"].split("/")[-1]: r for r in objects.text_documents(found, EngineConfig()).collect()}
    assert docs["a.txt"]["content_text"] == "abc\nd\ne" and docs["b.png"]["modality"] == "image"
    assert objects.choose(spark, "nowhere", f"file://{tmp_path}/a.txt").count() == 1


def test_sinks(spark, tmp_path):
    got, _ = run(spark, [dict(source_key="a.txt", content_text="hello"), dict(source_key="b.txt", content_text=" ")])
    plan.write(got, f"file://{tmp_path}", "20240101T000000Z")
    records = spark.read.json(f"file://{tmp_path}/records")
    assert records.where("modality = 'text'").count() == 1
    assert spark.read.parquet(f"file://{tmp_path}/vectors").count() == 1
    assert spark.read.json(f"file://{tmp_path}/manifests/ingestion_20240101T000000Z").count() == 2
    copied = sinks.copy_quarantined(got.quarantine, lambda a, b: (_ for _ in ()).throw(OSError("gone"))).collect()
    assert [r["error"] for r in copied] == ["gone"]
    again = plan.reindex(index.chunk_records(got.chunks), EngineConfig())
    assert again.select("key", "vector").collect() == got.vectors.select("key", "vector").collect()
    assert index.delete_vectors(got.vectors, spark.createDataFrame([("text",)], "modality string"), "modality").isEmpty()


def test_sweep_deletes_what_was_written(spark, tmp_path):
    from tarnbeck import storage

    a, b = (storage.materialize(spark.range(3), "t") for _ in range(2))
    storage.discard(a)
    assert b._tarnbeck_path in storage._written and a._tarnbeck_path not in storage._written and b.count() == 3
    storage._written[:] = [b._tarnbeck_path]  # other tests' tables stay
    storage.sweep(spark)
    import os

    assert not os.path.exists(b._tarnbeck_path.removeprefix("file://")) and not storage._written


def test_vector_store_needs_a_client(spark):
    spark.dataSource.register(sinks.VectorStoreSource)
    df = spark.createDataFrame([("k", [1.0])], "key string, vector array<float>")
    with pytest.raises(Exception, match="client"):
        df.write.format("vector_store").mode("append").save()
    with pytest.raises(Exception):
        df.write.format("vector_store").mode("append").option("client", "no_such_module:make").save()


def test_model_stubs_and_lines(spark):
    assert models.NoCaptions().caption([b""]) == [""] and models.NoSpeech().transcribe([b""]) == [[]]
    df = spark.createDataFrame([([("LINE", "a"), ("WORD", "b"), ("LINE", "c")],)], "b array<struct<kind:string,text:string>>")
    assert df.select(models.lines(F.col("b"))).first()[0] == "a\nc"
