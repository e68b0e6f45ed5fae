"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..storage import install
from .byte_bpe import encode_decode
from .embedding_dedup import near_vectors
from .exact_dedup import content_sort
from .html_text import extract_text
from .license_scan import license_scan
from .ngram_join import jaccard_join
from .oracle import SQL
from .packing import best_fit_packing
from .token_counts import token_counts
from .toxicity import score, train
from .warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    install(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A table that is read in fewer tasks than there are cores, as a small file is, is dealt to all of
    them; a large one isn't shuffled."""
    context = rows.sparkSession.sparkContext
    cores = context.defaultParallelism
    return rows.repartition(cores) if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows


def vocabulary(name: str) -> str:
    import public_tokenizers  # only here, so that the other queries do without it

    return public_tokenizers.path(name)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spread(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spread(table(spark, sf_dir, "documents")), vocabulary("byte_bpe_50k.json"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spread(table(spark, sf_dir, "pages")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spread(table(spark, sf_dir, "pages")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spread(table(spark, sf_dir, "documents")), vocabulary("byte_bpe_50k.json"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(spread(table(spark, sf_dir, "documents")), vocabulary("byte_bpe_50k.tiktoken"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_token_counts": op5_token_counts,
    "op7_html_text": op7_html_text,
    "op8_warc": op8_warc,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_byte_bpe": op10_byte_bpe,
    "op6_exact_dedup": op6_exact_dedup,
}

ORACLE_SQL = SQL
