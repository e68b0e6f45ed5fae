import gzip
from collections import defaultdict

import pyarrow as pa
import pytest

from tarnbeck.llm import queries
from tarnbeck.llm import warc as W
from tarnbeck.llm.common import shared_dir


def brute(rows):
    by = defaultdict(list)
    for p, h in rows:
        by[h or ""].append(p)
    out = []
    for p, h in rows:
        b, first = (h or "").encode(), min((x for x in by[h or ""] if x is not None), default=None)
        again = first is not None and p != first
        out.append((p, len(b), W.digest(b), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def got(df):
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in cols) for r in W.round_trip(df).collect()), key=str)


def test_round_trip(spark):
    big = "é<p>x\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(1, "u1", big), (2, "u2", "abc"), (3, None, "abc"), (4, "u", ""), (5, "v", None), (6, "z", big), (2, "u2", "abc"), (None, "q", "zz"), (7, "b", big + "1"), (7, "b", big + "1"), (8, "same id", "p"), (8, "same id", "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as capture", "2 as payload", "3 as sha", "4 as first").repartition(3)
    assert got(df) == brute([(p, h) for p, _, h in rows])
    assert got(df.where("false")) == []


def test_repeated_revisits(spark, monkeypatch):
    big = "x" * 200_000
    rows = [(1, "a"), (2, "a"), (2, "a"), (2, "a"), (None, "a"), (None, "a"), (3, big), (4, big), (4, big), (3, big), (5, None), (6, ""), (6, "")]
    df = spark.createDataFrame([(p, "u", h) for p, h in rows], "page_id long, url string, html string").repartition(3)
    for least in (W.BROADCAST_ROWS, 0):
        monkeypatch.setattr(W, "BROADCAST_ROWS", least)
        assert got(df) == brute(rows)


def test_query(spark, sf_dir):
    rows = [(r["page_id"], r["html"]) for r in queries.table(spark, sf_dir, "pages").collect()]
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in queries.op8_warc(spark, sf_dir).collect()), key=str) == brute(rows)


def test_payloads_come_back_whole(spark):
    rows = [(f"c{i}", i, "u", bytes([i]) * (i * 50_000)) for i in range(5)]
    path = f"{shared_dir(spark)}/warc-test"
    W.write_archives(spark.createDataFrame(rows, "capture string, order long, url string, payload binary"), path, segment=10_000)
    assert {r["capture"]: bytes(r["payload"]) for r in W.read_archives(spark, path).collect()} == {c: p for c, _, _, p in rows}


def test_files_are_warc(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, "http://x", b"ab" * 100_000)], "capture string, order long, url string, payload binary")
    W.write_archives(df, f"file://{tmp_path}/a")
    data = b"".join(gzip.open(p).read() for p in (tmp_path / "a").glob("part-*.gz"))
    found = list(W.parse(data))
    assert data.endswith(b"\r\n\r\n") and [f["warc-type"] for f, _ in found] == ["response"] + ["continuation"] * (len(found) - 1)
    assert [int(f["warc-segment-number"]) for f, _ in found] == list(range(1, len(found) + 1))
    assert int(found[-1][0]["warc-segment-total-length"]) == sum(len(b) for _, b in found)
    assert W.payload_of(b"".join(b for _, b in found)) == b"ab" * 100_000


def test_chunk_framing():
    for n in (0, 1, 8192, 8193, 100_000):
        assert W.unchunked(W.chunked(b"x" * n)) == b"x" * n
    assert W.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(bad)


def part(n, total, block):
    return dict(origin="o", segment=n, total=total, capture="c", url="u", record_type="response", payload_digest=None, refers_to=None, payload_bytes=None, payload=block)


def test_missing_or_short_segments_raise():
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    table = lambda rows: pa.Table.from_batches([W._batch(rows)])
    whole = W.reassemble(table([part(2, len(block), block[10:]), part(1, None, block[:10])]))
    assert whole.column("payload")[0].as_py() == b"hello"
    for rows in ([part(2, len(block), block[10:])], [part(1, None, block[:10]), part(2, 99, block[10:])], [part(1, None, block[:10]), part(3, len(block), block[10:])]):
        with pytest.raises(ValueError):
            W.reassemble(table(rows))
    with pytest.raises(ValueError):
        list(W.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
