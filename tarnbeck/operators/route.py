"""Routing of objects to a modality by their key's extension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig


def extension(key: Column) -> Column:
    """The lower-case extension with its dot; empty for none, for dot-files and for folders."""
    return F.lower(F.regexp_extract(key, r"(?:^|/)\.*[^/.][^/]*(\.[^./]*)$", 1))


def modality(key: Column, config: EngineConfig) -> Column:
    """Null for an extension that isn't routed."""
    table = F.create_map(*(F.lit(x) for pair in config.extensions.items() for x in pair))
    return F.element_at(table, extension(key))


def route(objects: DataFrame, config: EngineConfig, key: str = "source_key") -> DataFrame:
    """Adds modality, and status and reason where there is none."""
    wrong = F.concat(F.lit("Unsupported file extension '"), extension(F.col(key)), F.lit("' for key: "), F.col(key))
    out = objects.withColumn("modality", modality(F.col(key), config))
    lost = F.col("modality").isNull()
    return out.withColumn("status", F.when(lost, F.lit("failed"))).withColumn("reason", F.when(lost, wrong))
