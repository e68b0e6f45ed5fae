"""WARC: writing archives with segmented, chunked responses, and reading them back whole."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, shared_dir, slices

#: Bytes of a record's block above which it is cut into segments, and of an HTTP chunk.
SEGMENT, CHUNK = 1 << 16, 1 << 13
#: Records of an archive file at most: some 16 MB of usual pages, SEGMENT times as many bytes at most.
FILE_RECORDS = 4_000
#: Revisits are looked up by broadcast up to so many rows, beyond that by a shuffle.
BROADCAST_ROWS = 200_000
#: Fixed values of the format: line end, end of record, version line.
CRLF, END, VERSION = b"\r\n", b"\r\n\r\n", b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        own = payload[at : at + size]
        parts += [b"%x\r\n" % len(own), own, CRLF]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped, broken framing raises."""
    parts, at = [], 0
    while True:
        end = body.index(CRLF, at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(parts)
        if len(body) < at + n + 2 or body[at + n : at + n + 2] != CRLF:
            raise ValueError("broken chunk")
        parts.append(body[at : at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends behind it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s" % (VERSION, head.encode(), len(block), block)


def records(url: str, name: str, payload: bytes, own_digest: str, refers_to: str | None, segment: int = SEGMENT) -> list[bytes]:
    """The records of one capture: a response in one or more segments, or a revisit without payload."""
    rid = record_id(name)
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Capture", name)]
    http = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{own_digest}")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *shared, profile, ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Capture", refers_to), *http], head)]
    block = head + chunked(payload)
    if len(block) <= segment:
        return [record([("WARC-Type", "response"), ("WARC-Record-ID", rid), *shared, *http], block)]
    out = []
    for i, at in enumerate(range(0, len(block), segment)):
        own = block[at : at + segment]
        if i == 0:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", rid), *shared, *http, ("WARC-Segment-Number", 1)]
        else:
            total = len(block) if at + segment >= len(block) else None
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(f"{name}#{i + 1}")), *shared, ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", i + 1), ("WARC-Segment-Total-Length", total)]
        out.append(record(fields, own))
    return out


def parse(data: bytes):
    """(fields in lower case, block) of each record of an archive file, by Content-Length."""
    at = 0
    while at < len(data):
        if data.startswith(CRLF, at):
            at += 2
            continue
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, n = end + 4, int(fields["content-length"])
        if start + n > len(data):
            raise ValueError("record cut off")
        yield fields, data[start : start + n]
        at = start + n


def payload_of(block: bytes) -> bytes:
    """The decoded payload of an HTTP response block."""
    head, _, body = block.partition(END)
    if b"transfer-encoding: chunked" in head.lower():
        return unchunked(body)
    return body


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, segment: int = SEGMENT) -> None:
    """pages (capture string, order long, url string, payload binary) to gzipped archives under path.

    Of records with equal payloads of at least least_bytes, the one of the smallest order (then
    capture) is the response and the others are revisits of it. Digests are found first and only
    they are shuffled and pre-aggregated; then each record is written by the task that reads it.
    Rows that repeat a capture are looked up once and written as often as they are there.
    Files are Spark text output whose line separator is the format's end of record, so the commit
    protocol makes a rerun after a lost executor safe and any file system Spark knows will do.
    """
    spark = pages.sparkSession
    facts = pages.select("capture", "order", F.sha1("payload").alias("sha"), F.length("payload").alias("size"))
    firsts = facts.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.min(F.struct(F.col("order").isNull().alias("z"), "order", "capture")).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("sha", F.col("first.capture").alias("first"))
    role = materialize(facts.where(F.col("size") >= least_bytes).join(firsts, "sha").where("capture <> first").select("capture", "first").distinct(), "revisits")
    small = role.count() <= BROADCAST_ROWS
    joined = pages.join(F.broadcast(role) if small else role, "capture", "left")

    def run(batches):
        for part in slices(batches, "payload"):
            out = []
            for capture, url, payload, first in zip(*(part.column(c).to_pylist() for c in ("capture", "url", "payload", "first")), strict=True):
                out += records(url or "urn:none", capture, payload, digest(payload), first, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    lines = joined.select("capture", "url", "payload", "first").mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    discard(role)


_PART = "origin string, segment int, total long, capture string, url string, record_type string, payload_digest string, refers_to string, payload_bytes long, payload binary"
_NAMES = [f.split(" ")[0] for f in _PART.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]


def _checked(header: str | None, payload: bytes, keep: bool) -> dict:
    """The columns of a whole payload; a digest that differs from the record's raises."""
    own = digest(payload)
    if header and header != own:
        raise ValueError(f"payload digest {own}, but the record has {header}")
    return {"payload_digest": own, "payload_bytes": len(payload), "payload": payload if keep else None}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Captures of the archives under path: capture, url, record_type, payload_digest, refers_to,
    payload_bytes and payload (null for revisits, and everywhere without payloads).

    Continuation records are grouped with their first segment by the origin's id, ordered by segment
    number and checked against the total length; then the chunked framing is decoded and the digest
    compared. A missing segment, a wrong length or a wrong digest raises. Files may split captures in
    any way; only segmented captures are shuffled. A file is read whole by one task, so archives
    should be cut to files that fit a task, as write_archives does.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                data = raw.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for f, block in parse(data):
                    kind, number, total = f["warc-type"], f.get("warc-segment-number"), f.get("warc-segment-total-length")
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    row = {
                        "origin": f.get("warc-segment-origin-id", f["warc-record-id"]),
                        "segment": int(number) if number else None,
                        "total": int(total) if total else None,
                        "capture": f.get("x-capture", f["warc-record-id"]),
                        "url": f.get("warc-target-uri"),
                        "record_type": kind,
                        "payload_digest": f.get("warc-payload-digest", "").rpartition(":")[2] or None,
                        "refers_to": f.get("x-refers-to-capture", f.get("warc-refers-to")),
                    }
                    if number:
                        row["payload"] = block
                    elif kind == "response":
                        row |= _checked(row["payload_digest"], payload_of(block), payloads)
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 200
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    def whole(parts: pa.Table) -> pa.Table:
        return reassemble(parts, payloads)

    parsed = materialize(files.mapInArrow(run, _PART), "records")
    # a capture written often, as repeated rows are, is one set of segments and a count
    once = parsed.where("segment is not null").groupBy("origin", "segment").agg(*(F.first(c).alias(c) for c in _NAMES if c not in ("origin", "segment")), F.count("*").alias("copies"))
    joined = once.select(*_NAMES, "copies").groupBy("origin").applyInArrow(whole, _PART + ", copies long")
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
    return parsed.where("segment is null").unionByName(joined).drop("origin", "segment", "total")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in zip(_NAMES, _KINDS, strict=True)], _NAMES)


def reassemble(parts: pa.Table, payloads: bool = True) -> pa.Table:
    """One capture's segments, each once and in any order, to its row. Where there is a column copies,
    every segment must have been there as often."""
    rows = sorted(parts.to_pylist(), key=lambda r: r["segment"])
    if [r["segment"] for r in rows] != list(range(1, len(rows) + 1)) or len({r.get("copies") for r in rows}) != 1:
        raise ValueError(f"segments of {rows[0]['origin']} are missing")
    block = b"".join(r["payload"] for r in rows)
    if rows[-1]["total"] != len(block):
        raise ValueError(f"{rows[0]['origin']} has {len(block)} of {rows[-1]['total']} bytes")
    out = pa.Table.from_batches([_batch([rows[0] | _checked(rows[0]["payload_digest"], payload_of(block), payloads)])])
    return out.append_column("copies", pa.array([rows[0]["copies"]], pa.int64())) if "copies" in parts.column_names else out


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write every page as a WARC capture, read the archives back, and report each page's record:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is the empty payload, and empty payloads are equal as others are. A null url is written
    as urn:none. Rows that repeat id and html are one capture written several times: all of them are
    responses, or all revisits. A null page_id sorts after every other and comes back null. Other
    columns are ignored; an empty table gives an empty result. A payload shared by a third of all
    rows is one pre-aggregated digest; its revisits carry no payload.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    own = pages.select(
        F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.sha1(payload)).alias("capture"),
        F.col(id_col).cast("long").alias("order"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    )
    path = f"{shared_dir(spark)}/tarnbeck/warc-{uuid.uuid4().hex}"
    write_archives(own, path, least_bytes)
    got = materialize(read_archives(spark, path, payloads=False).drop("payload"), "captures")

    def page(capture):
        return F.substring_index(capture, "|", 1).try_cast("long")

    sizes = got.where("record_type = 'response'").groupBy(F.col("capture").alias("refers_to")).agg(F.first("payload_bytes").alias("of"))
    return got.join(sizes, "refers_to", "left").select(
        page(F.col("capture")).alias("page_id"),
        F.coalesce("payload_bytes", "of").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )
