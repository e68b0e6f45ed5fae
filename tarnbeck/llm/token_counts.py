"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import _SHIFT, PRE_TOKEN, _Memo, heap_merge
from .common import slices


def byte_letters() -> dict[str, int]:
    """The printable stand-in for each byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others follow from U+0100 in byte order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ShortcutCounter:
    """Counts tokens as the vocabulary file's library gives them."""

    def __init__(self, spec: dict):
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space")
        vocab: dict[str, int] = model["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must match as they stand")
        self.single = [0] * 256
        for ch, b in letters.items():
            self.single[b] = vocab[ch]
        self.pairs, self.made = {}, []
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs[vocab[a] << _SHIFT | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.split = regex.compile(PRE_TOKEN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.whole = self._proven(vocab, letters)
        self.memo = _Memo(lambda piece: len(self.merge(piece.encode())))

    def merge(self, raw: bytes) -> list[int]:
        single = self.single
        return heap_merge([single[b] for b in raw], self.pairs, self.made)

    def _proven(self, vocab: dict[str, int], letters: dict[str, int]) -> frozenset[str]:
        """Vocabulary strings that are one pre-token by the pattern and merge to their own id."""
        found = []
        for token, i in vocab.items():
            if any(ch not in letters for ch in token):
                continue
            raw = bytes(letters[ch] for ch in token)
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                continue
            if self.split(text) == [text] and self.merge(raw) == [i]:
                found.append(text)
        return frozenset(found)

    def count(self, text: str) -> int:
        parts = [text] if self.at_special is None or not any(s in text for s in self.special) else self.at_special.split(text)
        n, whole, memo = len(parts) - 1, self.whole, self.memo
        for part in parts:
            pieces = self.split(part)
            rest = [p for p in pieces if p not in whole]
            n += len(pieces) - len(rest) + sum(map(memo.__getitem__, rest))
        return n


_COUNTERS: dict[str, ShortcutCounter] = {}


def counter_for(key: str, spec: str) -> ShortcutCounter:
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = ShortcutCounter(json.loads(spec))
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Pre-tokens proven to encode alone as one token are counted directly; only the rest are merged.
    A special token's string inside a text is that one token, as the library has it by default.
    Null and empty texts have no bytes and no tokens. Rows are independent: repeated rows, null ids
    and other columns (ignored) need no rule. The vocabulary file is read on the driver and broadcast
    (under 2 MB). No shuffle.
    """
    with open(vocab_path, encoding="utf-8") as f:
        spec = f.read()
    key = hashlib.sha256(spec.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        count = counter_for(key, shared.value).count
        for part in slices(batches, "text"):
            n = pa.array([count(t or "") for t in part.column(1).to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
