"""Best-fit packing of token pieces into fixed-length sequences."""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import PRE_TOKEN
from .common import materialize, slices
from .token_counts import byte_letters

#: Tokens of a sequence, bins open at once, pieces that are looked at before they are placed, and tokens
#: that one packing task takes.
LENGTH, OPEN_BINS, LOOKAHEAD, TASK_TOKENS = 2048, 512, 2_000, 24_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Tokenizer:
    """Ids as the vocabulary file's library gives them without begin, end or padding; a special
    token's string inside a text is that token."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[ch] for ch in k): i for k, i in vocab.items() if k not in self.special}
        merged = [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])]
        if merged != sorted(merged):
            raise ValueError("merges must rank as their ids do")
        self.encode = tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None

    def ids(self, text: str) -> np.ndarray:
        if self.cut is None or not any(s in text for s in self.special):
            return self.encode(text, disallowed_special=())
        parts = self.cut(text)
        own = [np.array([self.special[p]], np.uint32) if i % 2 else self.encode(p, disallowed_special=()) for i, p in enumerate(parts)]
        return np.concatenate(own)


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer_for(key: str, spec: str) -> Tokenizer:
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer(spec)
    return _TOKENIZERS[key]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole lengths, but for a shorter first piece."""
    first = n % length
    return [(0, first)] * bool(first) + [(s, length) for s in range(first, n, length)]


class BestFit:
    """Bounded-space online best-fit. Bit f of open is set where some open bin has f tokens free;
    a piece goes to the fullest bin that holds it. When open_bins are open and none fits, the
    fullest closes first."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.limit = length, open_bins
        self.open, self.count, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        own = self.bins[free]
        number = own.pop()
        if not own:
            self.open ^= 1 << free
        self.count -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to length tokens."""
        fits = self.open >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.count >= self.limit:
                self._take((self.open & -self.open).bit_length() - 1)
            free, number = self.length, self.made
            self.made += 1
        left = free - size
        if left:
            if not self.bins[left]:
                self.open |= 1 << left
            self.bins[left].append(number)
            self.count += 1
        return number, self.length - free


def pieces(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Tokens of every whole text and id 0 behind them, cut to pieces of at most length tokens. A null or
    empty text is the one piece of id 0; repeated rows and null ids are cut each on its own; other columns
    are ignored; an empty table gives no piece."""
    with open(vocab_path, encoding="utf-8") as f:
        spec = f.read()
    key = hashlib.sha256(spec.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches):
        ids_of = tokenizer_for(key, shared.value).ids
        for part in slices(batches, "text"):
            rows = [[] for _ in names]
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                raw = ids_of(text or "").astype("<u4").tobytes() + b"\0\0\0\0"
                for i, (start, n) in enumerate(cut(len(raw) // 4, length)):
                    own = raw[4 * start : 4 * (start + n)]
                    row = [doc, i, start, n, zlib.crc32(own)] + [np.frombuffer(own, "<u4")] * keep_ids
                    for col, v in zip(rows, row, strict=True):
                        col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=False)], names)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, PIECES + ", ids array<int>" * keep_ids)


def pack(cuts: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, lookahead: int = LOOKAHEAD, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Give every piece a sequence_id and an offset in it.

    Pieces are dealt by hash to tasks of about task_tokens each, so that tasks grow in number with
    the input and not in size. They come in the order of a hash (a total order, so a rerun after a lost
    executor repeats its result), lookahead at a time, the longest of those first, and are placed
    online: open_bins sequences stay open from one such run to the next, and the fullest closes when
    another is needed. A task holds no more than that. A piece as long as a sequence fills one by itself.
    """
    total = cuts.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, round(total / task_tokens))

    def run(batches):
        bins, base = BestFit(length, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, lookahead):
                part = batch.slice(start, lookahead)
                sizes = part.column(part.schema.get_field_index("length")).to_numpy()
                number, offset = np.zeros((2, len(sizes)), np.int64)
                for i in np.argsort(-sizes, kind="stable").tolist():
                    number[i], offset[i] = bins.place(int(sizes[i]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base + number), pa.array(offset)], [*part.schema.names, "sequence_id", "offset"])

    order = [F.xxhash64("doc_id", "piece"), "doc_id", "piece", "ids_crc32"]
    schema = cuts.schema.simpleString()[len("struct<") : -1] + ",sequence_id:bigint,offset:bigint"
    return cuts.repartition(tasks, "doc_id", "piece", "ids_crc32").sortWithinPartitions(*order).mapInArrow(run, schema)


def best_fit_packing(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all texts into sequences of LENGTH tokens: one row per piece, with doc_id, piece, start,
    length, ids_crc32, sequence_id and offset.

    A null or empty text is the single id 0. Repeated rows and rows with null ids are packed each on
    its own; other columns are ignored; an empty table gives an empty result. Only the pieces' numbers
    are shuffled, never texts or ids.
    """
    return pack(materialize(pieces(docs, vocab_path, id_col, text_col), "pieces"))
