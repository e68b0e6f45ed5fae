"""A training-corpus pipeline: toxic texts go, exact and near copies go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnbeck.llm import exact_dedup, ngram_join, packing, toxicity
from tarnbeck.llm.common import materialize
from tarnbeck.storage import install


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels, doesn't call toxic.

    Null and empty texts have its base score and stay; each of repeated rows and of rows with null ids is
    judged by its text; other columns come along; without documents or labels nothing goes.
    """
    install(spark)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, machine)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal but for white space: the longest, then of the smallest id.

    Null counts as empty, so of all such rows one stays; of repeated rows one stays; a null id comes last;
    other columns come along; an empty table stays empty.
    """
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies (word 5-grams, Jaccard 0.8), that of the smallest id.

    Null, empty and wordless texts link with nothing and stay, as do rows that repeat the kept id and
    text; a null id is kept only in a class without another; other columns come along; an empty table
    stays empty.
    """
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 tokens.

    A null or empty text is the single id 0; repeated rows and rows with null ids are packed each on its
    own; other columns are ignored; an empty table gives no piece.
    """
    import public_tokenizers  # only here, so that the other stages do without it

    return packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("best_fit_packing", pack),
]

#: SQL can't express training the classifier; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
