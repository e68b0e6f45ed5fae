"""Vector search: exact inner products, filtered before they are ranked."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot


def top_k(vectors: DataFrame, query: list[float], k: int, modality: str | None = None, vector: str = "vector", key: str = "key") -> DataFrame:
    """The k records with the greatest inner product with the query; ties by key. The filter comes
    first, so a table partitioned by modality reads one partition; each task ranks its own k."""
    own = vectors if modality is None else vectors.where(F.col("modality") == modality)
    scored = own.withColumn("score", dot(F.col(vector), F.array(*(F.lit(float(x)) for x in query))))
    return scored.orderBy(F.desc("score"), key).limit(k)


def top_k_by(vectors: DataFrame, query: list[float], k: int, by: str = "modality", vector: str = "vector", key: str = "key", salts: int = 32) -> DataFrame:
    """The same for each value of by. Rows are ranked in salted parts first, so a value of a third of
    all rows meets no single task; at most salts * k rows of it are ranked again."""
    scored = vectors.withColumn("score", dot(F.col(vector), F.array(*(F.lit(float(x)) for x in query))))
    scored = scored.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    part = Window.partitionBy(by, "_salt").orderBy(F.desc("score"), key)
    whole = Window.partitionBy(by).orderBy(F.desc("score"), key)
    some = scored.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= k)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).drop("_n", "_salt")
