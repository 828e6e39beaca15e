"""WARC archives: records with segments, revisits and chunked payloads, written and read back by Spark.

Writing: equal payloads are stored once, as the response of the largest page id; the others are revisit
records. A payload longer than ``segment_bytes`` is cut into a first segment and continuation records.
Reading: continuation records are grouped by origin identifier, ordered by segment number, checked
against the total length, and the chunked transfer framing of the joined block is decoded.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, parts, pick, scratch_dir

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that does not hold what its headers promise."""


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """Chunked transfer framing of a payload."""
    out = bytearray()
    for at in range(0, len(payload), chunk_bytes):
        piece = payload[at : at + chunk_bytes]
        out += b"%x\r\n%b\r\n" % (len(piece), piece)
    return bytes(out) + b"0\r\n\r\n"


def dechunked(block: bytes) -> bytes:
    """The payload inside chunked framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = block.find(b"\r\n", at)
        if end < 0:
            raise WarcError("chunk size line is cut off")
        size = int(block[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if block[at + size : at + size + 2] != b"\r\n":
            raise WarcError("chunk is shorter than its size")
        out.append(block[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response block, with chunked framing taken off where its head names it."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError("HTTP head is cut off")
    fields = [x.partition(b":") for x in head.split(b"\r\n")[1:]]
    coding = b"".join(v for k, _, v in fields if k.strip().lower() == b"transfer-encoding")
    return dechunked(body) if b"chunked" in coding.lower() else body


def record(kind: bytes, identifier: bytes, block: bytes, *fields: tuple[bytes, bytes]) -> bytes:
    """One record without the blank lines that end it (the archive writer adds them)."""
    head = [
        (b"WARC-Type", kind),
        (b"WARC-Record-ID", b"<" + identifier + b">"),
        (b"WARC-Date", b"2024-01-01T00:00:00Z"),
        *fields,
        (b"Content-Length", b"%d" % len(block)),
    ]
    return VERSION + b"\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in head) + b"\r\n" + block


def records_of(content: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers (lower-case names) and block of each record of an archive, told apart by Content-Length only."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].split(b"\r\n")
        if end < 0 or not lines[0].startswith(b"WARC/"):
            raise WarcError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = int(fields[b"content-length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) != size or content[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise WarcError(f"record at byte {at} is cut off")
        yield fields, block
        at = end + 8 + size


def plan_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """What is written for each page: one row (rec, page_id, payload_bytes, payload_digest, n, record_type,
    refers_rec) for each distinct page id and payload, with n, how often such rows stand in ``pages``.

    Of equal payloads of at least ``least_bytes`` the largest page id is the response. Null page ids are
    the smallest. Only ids and digests are shuffled; equal payloads meet as partial maxima, and the join back
    has one row per payload on its right side.
    """
    found = digested(pages).groupBy("rec", "page_id", "payload_bytes", "payload_digest").agg(F.count("*").alias("n"))
    found = materialize(found)
    first = (
        found.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_bytes", "payload_digest")
        .agg(F.max(F.struct("page_id", "rec")).alias("first"))
    )
    joined = found.join(first, ["payload_bytes", "payload_digest"], "left")
    revisit = F.col("first.rec") != F.col("rec")
    return joined.select(
        "rec",
        "page_id",
        "payload_bytes",
        "payload_digest",
        "n",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first.rec")).alias("refers_rec"),
    )


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its length and SHA-1, and a record identifier made of page id and digest."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", F.sha1("payload"))
        .withColumn("rec", F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), "payload_digest"))
    )


def write_archives(
    pages: DataFrame,
    plan: DataFrame,
    path: str,
    archive_bytes: int = 32 << 20,
    segment_bytes: int = 16 << 10,
    chunk_bytes: int = 4 << 10,
) -> None:
    """Write archives of about ``archive_bytes`` to a folder, in any place that Spark can write to.

    Archives are compressed files. A payload of which the framed block is longer than ``segment_bytes`` becomes a
    first segment and continuation records, which may lie in other archives than the first.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "payload", 4 << 20):
                out = [(x, f"{r['rec']}/{k}") for r in part.to_pylist() for k, x in enumerate(_records(r, segment_bytes, chunk_bytes))]
                columns = [pa.array([x for x, _ in out], pa.binary()), pa.array([n for _, n in out], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["record", "part"])

    long = F.col("payload_bytes") > segment_bytes
    sizes = plan.groupBy(long.alias("long")).agg(F.sum("payload_bytes").alias("total")).collect()
    if not sizes:
        plan.select(F.col("rec").alias("value")).write.text(path)
    for size in sizes:
        archives = int(size.total // archive_bytes) + 1
        wanted = plan.where(long if size.long else ~long).select("rec", "record_type", "refers_rec")
        rows = digested(pages).where(long if size.long else ~long).drop("page_id").repartition(archives, "rec")
        built = rows.dropDuplicates(["rec"]).join(wanted, "rec").mapInArrow(build, "record binary, part string")
        if size.long:
            # Segments are dealt out by their own names, so that one long payload does not fill one archive.
            built = built.repartition(archives, "part")
        lines = built.select(F.col("record").cast("string").alias("value"))
        lines.write.mode("append").option("lineSep", END).option("compression", "gzip").text(path)


def _records(row: dict, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    name = b"urn:page:" + row["rec"].encode()
    url = "".join(x for x in row["url"] or "urn:none" if x.isprintable()).encode()
    common = (
        (b"WARC-Target-URI", url),
        (b"WARC-Payload-Digest", b"sha1:" + row["payload_digest"].encode()),
    )
    if row["record_type"] == "revisit":
        refers = (b"WARC-Refers-To", b"<urn:page:" + row["refers_rec"].encode() + b">")
        yield record(b"revisit", name, b"", *common, (b"WARC-Profile", REVISIT_PROFILE), refers)
        return
    block = HTTP_HEAD + chunked(row["payload"], chunk_bytes)
    kind = (b"Content-Type", b"application/http; msgtype=response")
    if len(block) <= segment_bytes:
        yield record(b"response", name, block, *common, kind)
        return
    starts = range(0, len(block), segment_bytes)
    for k, at in enumerate(starts, 1):
        piece = block[at : at + segment_bytes]
        number = (b"WARC-Segment-Number", b"%d" % k)
        if k == 1:
            yield record(b"response", name, piece, *common, kind, number)
            continue
        origin = (b"WARC-Segment-Origin-ID", b"<" + name + b">")
        total = [(b"WARC-Segment-Total-Length", b"%d" % len(block))] if k == len(starts) else []
        yield record(b"continuation", name + b":segment:%d" % k, piece, (b"WARC-Target-URI", url), origin, number, *total)


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


RAW = "rec string, record_type string, refers_rec string, segment int, total long, digest string, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder: one row per record, with its own or its origin's identifier."""

    def name(value: bytes | None) -> str | None:
        return value.decode().strip("<>").removeprefix("urn:page:") if value else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("rec", pa.string()), ("record_type", pa.string()), ("refers_rec", pa.string()), ("segment", pa.int32()),
             ("total", pa.int64()), ("digest", pa.string()), ("block", pa.binary())]
        )
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in records_of(_unpacked(content.as_py())):
                    number, total = fields.get(b"warc-segment-number"), fields.get(b"warc-segment-total-length")
                    rows.append(
                        {
                            "rec": name(fields.get(b"warc-segment-origin-id") or fields[b"warc-record-id"]),
                            "record_type": fields[b"warc-type"].decode(),
                            "refers_rec": name(fields.get(b"warc-refers-to")),
                            "segment": int(number) if number else None,
                            "total": int(total) if total else None,
                            "digest": fields.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:") or None,
                            "block": block,
                        }
                    )
                    if len(rows) == 200:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, RAW)


READ = "rec string, record_type string, refers_rec string, payload_bytes long, payload_digest string, payload binary"


def reassemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per whole record: rec, record_type, refers_rec, payload_bytes, payload_digest, payload.

    Segments of one origin meet by their identifier and are joined in the order of their numbers; a missing
    segment, a wrong total length or a digest that does not fit the payload is an error. A revisit record has no
    payload; its length is unknown here (null) and its digest is the one in its head. Without ``payloads`` the
    payload column is null: lengths and digests are taken of each payload where it is decoded.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("rec", pa.string()), ("record_type", pa.string()), ("refers_rec", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = [_whole(x) for x in batch.slice(at, 200).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows if payloads else [x | {"payload": None} for x in rows], schema)

    single = records.where("segment is null").select(
        "rec", "record_type", "refers_rec", "digest", F.lit(None).cast("long").alias("total"),
        F.array(F.struct(F.lit(1).alias("segment"), "block")).alias("parts"),
    )
    grouped = (
        records.where("segment is not null")
        .groupBy("rec")
        .agg(
            F.lit("response").alias("record_type"),
            F.max("refers_rec").alias("refers_rec"),
            F.max("digest").alias("digest"),
            F.max("total").alias("total"),
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        )
    )
    return single.unionByName(grouped).mapInArrow(decode, READ)


def _whole(row: dict) -> dict:
    out = {"rec": row["rec"], "record_type": row["record_type"], "refers_rec": row["refers_rec"]}
    if row["record_type"] == "revisit":
        return out | {"payload_bytes": None, "payload_digest": row["digest"], "payload": None}
    parts = row["parts"]
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise WarcError(f"segments of {row['rec']} are missing or stand twice")
    block = b"".join(p["block"] for p in parts)
    if len(parts) > 1 and row["total"] != len(block):
        raise WarcError(f"segments of {row['rec']} have {len(block)} bytes, not {row['total']}")
    payload = http_payload(block)
    digest = hashlib.sha1(payload).hexdigest()
    if row["digest"] not in (None, digest):
        raise WarcError(f"payload of {row['rec']} does not fit its digest")
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}


def archive_round_trip(pages: DataFrame, least_bytes: int = 1000, **sizes: int) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back, and report each page.

    Result: page_id, payload_bytes, payload_digest (SHA-1), record_type, refers_to, a row for each row of
    ``pages``. Length and digest are those of the payload that was read back; a revisit's length
    is that of the record it refers to.

    Defined cases: null html is an empty payload; rows that repeat page id and payload are recorded once and
    come back as often as they went in; equal page ids with different payloads are different records; a null
    page id counts as the smallest; an empty table gives an empty result; other columns play no part.
    """
    spark = pages.sparkSession
    pages = pick(pages, "page_id", "url", "html")
    plan = materialize(plan_records(pages, least_bytes))
    path = f"{scratch_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, plan, path, **sizes)
    read = materialize(reassemble(read_records(spark, path), payloads=False).drop("payload"))
    lengths = read.where("record_type = 'response'").select(F.col("rec").alias("refers_rec"), F.col("payload_bytes").alias("full_bytes"))
    pages_of = plan.select("rec", "page_id", "n")
    found = read.join(pages_of, "rec").join(lengths, "refers_rec", "left")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return found.select(
        "page_id",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.element_at(F.split("refers_rec", ":"), 1).try_cast("long")).alias("refers_to"),
        copies.alias("copy"),
    ).drop("copy")
