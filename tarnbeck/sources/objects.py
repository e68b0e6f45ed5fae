"""Objects of a store: listing, content, text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.route import route
from ..schemas import DOCS


def list_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """source_key, length and content of every object below path. Columns that no later stage uses
    aren't read: a listing alone reads no content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("source_key"), F.col("length").alias("media_bytes_len"), "content")


def one_object(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_key"), F.col("length").alias("media_bytes_len"), "content")


def choose(spark: SparkSession, prefix: str | None = None, key: str | None = None) -> DataFrame:
    """A single key wins over a prefix."""
    if key:
        return one_object(spark, key)
    if prefix:
        return list_objects(spark, prefix)
    raise ValueError("a key or a prefix is needed")


def _utf8(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n"))


def decode_text(content: Column) -> Column:
    """UTF-8 without its invalid bytes, every line end a line feed. The built-in decoders raise on
    such bytes or put other characters in their place, so this one step is a pandas UDF."""
    return F.pandas_udf(_utf8, "string")(content)


def doc_id(key: Column) -> Column:
    """The same on every run: MD5 of the key."""
    return F.md5(key)


def as_docs(rows: DataFrame) -> DataFrame:
    """Rows with some columns of the docs schema, cast to it; the others are null."""
    have = set(rows.columns)
    return rows.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in DOCS.items()))


def text_documents(objects: DataFrame, config: EngineConfig) -> DataFrame:
    """Route objects and read those routed to text. All text extensions, documents and markup too,
    are read as they stand."""
    routed = route(objects, config).withColumn("doc_id", doc_id(F.col("source_key")))
    text = routed.where("modality = 'text'").withColumn("content_text", decode_text(F.col("content")))
    rest = routed.where("modality is null or modality <> 'text'").withColumn("content_text", F.lit(None).cast("string"))
    return as_docs(text.unionByName(rest))
