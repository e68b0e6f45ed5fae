"""Token counts, encoding and decoding, packing: against the libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tarnbeck.llm import byte_bpe, packing, queries, token_counts

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    letters = [*"aabcdeeZ'st09 .,\n\t-_<|>", " ", "é", "ß", "漢", "字", "𝒳", "́", "\u0085", "\x1c", " ", "　", "²", "Ⅷ", "<|endoftext|>", "'ll", "http://"]
    return ["".join(rng.choices(letters, k=rng.randrange(200))) for _ in range(400)] + ["a" * 3000, " " * 500 + "x", "ab" * 1500]


def test_perfect_hash():
    keys = [f"k{i}".encode() for i in range(5000)]
    h = byte_bpe.PerfectHash(keys)
    assert sorted(h.slots) == list(range(5000)) and all(keys[h.index(k)] == k for k in keys)
    again = byte_bpe.PerfectHash(keys, (h.pilots, h.slots))
    assert all(again.index(k) == h.index(k) for k in keys[:100])
    assert byte_bpe.PerfectHash([b"one"]).index(b"other") == 0


def test_encoder_is_the_librarys(encoding):
    own = byte_bpe.TwoTierBpe(byte_bpe.read_ranks(RANKS))
    for t in texts():
        ids = own.encode(t)
        assert ids == encoding.encode_ordinary(t) and own.decode(ids) == t.encode()


def test_counter_is_the_librarys(library):
    import json

    own = token_counts.ShortcutCounter(json.load(open(JSON, encoding="utf-8")))
    for t in texts():
        assert own.count(t) == len(library.encode(t, add_special_tokens=False).ids)
    assert "the" in own.whole and len(own.whole) > 40_000


def test_packing_ids_are_the_librarys(library):
    own = packing.Tokenizer(open(JSON, encoding="utf-8").read())
    for t in texts():
        assert own.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO", 10)
    own = byte_bpe.TwoTierBpe(byte_bpe.read_ranks(RANKS))
    own.encode(" ".join(f"w{i}" for i in range(200)))
    assert len(own.memo) <= 10


def rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def check_counts(df, library):
    got = token_counts.token_counts(df, JSON).collect()
    want = []
    for i, t in rows(df):
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((i, len(t.encode()), n, n > 512))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def check_encoded(df, encoding):
    got = byte_bpe.encode_decode(df, RANKS).collect()
    want = []
    for i, t in rows(df):
        ids = encoding.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def check_packed(df, library):
    got = packing.best_fit_packing(df, JSON).collect()
    want = defaultdict(int)
    for i, t in rows(df):
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        first = len(ids) % 2048
        cuts = ([(0, first)] if first else []) + [(s, 2048) for s in range(first, len(ids), 2048)]
        for k, (s, n) in enumerate(cuts):
            want[(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))] += 1
    have = defaultdict(int)
    by = defaultdict(list)
    for r in got:
        have[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(k[3] * n for k, n in want.items())
    return len(by), -(-total // 2048)


def test_edges(edge_docs, library, encoding):
    check_counts(edge_docs, library)
    check_encoded(edge_docs, encoding)
    check_packed(edge_docs, library)
    kept = byte_bpe.encode_decode(edge_docs, RANKS, keep_ids=True).where("doc_id = 10").first()
    assert kept["ids"] == encoding.encode_ordinary("idiot <|endoftext|> MIT License é𝒳")


def test_empty_table(no_docs):
    assert token_counts.token_counts(no_docs, JSON).count() == 0
    assert byte_bpe.encode_decode(no_docs, RANKS).count() == 0
    assert packing.best_fit_packing(no_docs, JSON).count() == 0


def test_queries(spark, sf_dir, library, encoding):
    docs = queries.table(spark, sf_dir, "documents")
    check_counts(docs, library)
    check_encoded(docs, encoding)
    made, least = check_packed(docs, library)
    assert made <= least + 1


def test_best_fit_is_bounded_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # the fullest that holds it, now full and closed
    assert bins.place(8) == (2, 0) and bins.count == 2
    assert bins.place(9) == (3, 0) and bins.count == 2  # bin 2 had the least room and closed
    assert bins.place(4) == (0, 6) and bins.place(10) == (4, 0) and bins.count == 1
