"""Models and codecs outside the engine: interfaces, and how their calls become columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class TextEmbedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class ImageEmbedder(Protocol):
    def embed(self, paths: list[str], captions: list[str]) -> list[list[float]]: ...


class Ocr(Protocol):
    """Blocks (kind, text) of each image; lines() keeps the lines."""

    def read(self, images: list[bytes]) -> list[list[tuple[str, str]]]: ...


class Captioner(Protocol):
    def caption(self, images: list[bytes]) -> list[str]: ...


class Asr(Protocol):
    """Segments (start, end, text, speaker) of each recording."""

    def transcribe(self, recordings: list[bytes]) -> list[list[tuple[float, float, str, str | None]]]: ...


class FaceDetector(Protocol):
    """Boxes (left, top, width, height) from 0 to 1."""

    def detect(self, images: list[bytes]) -> list[list[tuple[float, float, float, float]]]: ...


class Probe(Protocol):
    """Probe JSON of each file."""

    def probe(self, files: list[bytes]) -> list[str]: ...


class Codec(Protocol):
    """Whatever rewrites media: format, loudness, blur, EXIF, tiles, keyframes, demuxing."""

    def convert(self, files: list[bytes], options: list[str]) -> list[bytes]: ...


class NoCaptions:
    def caption(self, images):
        return ["" for _ in images]


class NoSpeech:
    """Finds no segment: audio and video then have no text and aren't indexed."""

    def transcribe(self, recordings):
        return [[] for _ in recordings]


def model_column(make: Callable[[], Callable[..., list]], returns: str, *columns: Column) -> Column:
    """struct<value, error> of a model over columns. make is called once in each task and gives a
    function from lists, one a column, to a list of results. A batch that raises is retried by row,
    so one bad row never fails its task or its neighbours; its error says why."""

    def call(batches: Iterator) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            args = [s.tolist() for s in (batch if isinstance(batch, tuple) else (batch,))]
            try:
                out = [(v, None) for v in model(*args)]
            except Exception:
                out = []
                for row in zip(*args, strict=True):
                    try:
                        out.append((model(*([x] for x in row))[0], None))
                    except Exception as e:
                        out.append((None, str(e) or type(e).__name__))
            yield pd.DataFrame({"value": [v for v, _ in out], "error": [e for _, e in out]}, dtype=object)

    if len(columns) == 1:

        def one(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            yield from call(batches)

        udf = F.pandas_udf(one, f"value {returns}, error string")
    else:

        def many(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            yield from call(batches)

        udf = F.pandas_udf(many, f"value {returns}, error string")
    # a costly call must not be repeated where a filter and a projection both use it
    return udf.asNondeterministic()(*columns)


def lines(blocks: Column) -> Column:
    """Text of an image from its OCR blocks: the lines."""
    own = F.transform(F.filter(blocks, lambda b: b["kind"] == "LINE"), lambda b: b["text"])
    return F.coalesce(F.array_join(own, "\n"), F.lit(""))
