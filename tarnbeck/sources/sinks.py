"""Sinks: chunk records, vectors, media, manifest, quarantine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def write_chunk_records(records: DataFrame, path: str, form: str = "json", mode: str = "append") -> None:
    """By modality. JSON leaves null fields out, so only a chunk's own block appears."""
    writer = records.write.mode(mode).partitionBy("modality").format(form)
    writer.option("ignoreNullFields", "true").save(path)


def write_vectors(vectors: DataFrame, path: str, mode: str = "append") -> None:
    """By modality, so a filtered search reads one partition."""
    vectors.write.mode(mode).partitionBy("modality").parquet(path)


def write_manifest(entries: DataFrame, path: str, stamp: str) -> str:
    """A JSON folder named by the run's stamp (%Y%m%dT%H%M%SZ)."""
    target = f"{path.rstrip('/')}/ingestion_{stamp}"
    entries.write.mode("errorifexists").json(target)
    return target


def write_media(chunks: DataFrame, put: Callable[[str, bytes], None], key: str = "processed_media_key", content: str = "content") -> None:
    """Hand each chunk's media to put, which must be safe to call again with the same key."""

    def each(rows: Iterator[Row]) -> None:
        for r in rows:
            put(r[key], bytes(r[content]))

    chunks.where((F.col(key) != "") & F.col(content).isNotNull()).select(key, content).foreachPartition(each)


def copy_quarantined(entries: DataFrame, copy: Callable[[str, str], None]) -> DataFrame:
    """Call copy(source, target) for each row of quarantine(); an error is reported, never raised."""

    def run(batches):
        for pdf in batches:
            errors = []
            for source, target in zip(pdf["s3_key"], pdf["quarantine_key"], strict=True):
                try:
                    copy(source, target)
                    errors.append(None)
                except Exception as e:
                    errors.append(str(e) or type(e).__name__)
            yield pdf.assign(error=errors)

    return entries.mapInPandas(run, "s3_key string, quarantine_key string, reason string, error string")


class VectorStoreSource(DataSource):
    """df.write.format("vector_store").option("client", "module:factory").save(): batches of keyed
    vectors go to a client's put(list of dict). Puts are upserts by key, so task retries are safe; a
    client that is missing or fails raises and is never counted as written."""

    @classmethod
    def name(cls) -> str:
        return "vector_store"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return VectorStoreWriter(dict(self.options))


class VectorStoreWriter(DataSourceWriter):
    def __init__(self, options: dict):
        if "client" not in options:
            raise ValueError("option client, as module:factory, is needed")
        self.options = options

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        import importlib

        module, _, factory = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), factory)()
        held, most = [], int(self.options.get("batch", "500"))
        for r in rows:
            held.append(r.asDict(recursive=True))
            if len(held) >= most:
                client.put(held)
                held = []
        if held:
            client.put(held)
        return WriterCommitMessage()
