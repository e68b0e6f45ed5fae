"""The stand-ins for images: their hashes."""

from pyspark.sql import functions as F

from tarnbeck.config import EngineConfig
from tarnbeck.operators import dedup
from tarnbeck.plans import fixtures as fx


def test_image_hashes_grow(spark):
    keys = spark.range(1, 200_001).select(F.col("id").alias("key"), fx.image_hash(F.col("id")).alias("hash"))
    found = [keys.where(F.col("key") <= n).select("hash").distinct().count() for n in (2_000, 20_000, 200_000)]
    assert 500 < found[0] < found[1] < found[2]
    assert keys.where("hash is null").isEmpty()
    assert fx.image_docs(spark, "/root/testdata/sf0.01", EngineConfig()).select("image.phash").distinct().count() == found[0]


def test_image_twins(spark):
    config = EngineConfig()
    keys = spark.range(1, 20_001).select(F.concat(F.lit("raw/image/"), F.col("id").cast("string"), F.lit(".png")).alias("key"), (F.col("id") % 500).alias("twins"), fx.image_hash(F.col("id")).alias("hash"))
    marked = dedup.mark_duplicates(keys, "key", "hash", config.image_dedup_hash_distance).collect()
    first = {}
    for r in sorted(marked, key=lambda r: r["key"]):
        assert r["is_duplicate"] == (r["twins"] in first), r
        first.setdefault(r["twins"], r["key"])
    # groups stay apart whatever bits are set otherwise
    base = [r["hash"] for r in spark.range(500).select(fx.image_hash(F.col("id")).alias("hash")).collect()]
    assert min((a ^ b).bit_count() for i, a in enumerate(base) for b in base[:i]) > config.image_dedup_hash_distance + 4
