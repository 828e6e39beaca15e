import hashlib

import pytest

from gleanery.llm import warc

from .helpers import clashing

DDL = "page_id long, url string, html string"
SIZES = {"archive_bytes": 20_000, "segment_bytes": 1000, "chunk_bytes": 7}


def plain(rows, least=1000):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    out = []
    for i, data in payloads:
        top = max((-1 if j is None else j for j, other in payloads if other == data))
        revisit = len(data) >= least and (-1 if i is None else i) != top
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def cases():
    rows = [(1, "u", "x" * 1500), (2, "u", "x" * 1500), (3, None, "x" * 999), (4, "u", "x" * 999), (5, "u", None), (6, "u", "")]
    rows += [(None, "u", "x" * 1500), (7, "u\r\nWARC-Type: x", "é" * 30_000), (8, "u", "é" * 30_000), (8, "u", "é" * 30_000)]
    rows += [(9, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 300), (10, "u", "\0\r\n"), (11, "u", "x" * 1000), (12, "u", "x" * 1000), (11, "u", "other")]
    return rows + [(100 + i, "v", "a page that many sites copy " * 50) for i in range(60)]


@pytest.mark.parametrize("sizes", [{}, SIZES])
def test_round_trip(spark, sizes):
    rows = cases()
    found = warc.archive_round_trip(clashing(spark.createDataFrame(rows, DDL)), **sizes)
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain(rows)


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame(cases(), DDL)
    plan = warc.plan_records(pages)
    warc.write_archives(pages, plan, f"{tmp_path}/w", **SIZES)
    records = warc.read_records(spark, f"{tmp_path}/w")
    assert records.where("record_type = 'continuation'").count() > 50
    whole = {r.rec: r for r in warc.reassemble(records).collect()}
    planned = {r.rec: r for r in plan.collect()}
    assert set(whole) == set(planned)
    for rec, row in whole.items():
        assert (row.payload is None) == (planned[rec].record_type == "revisit")
        if row.payload is not None:
            assert hashlib.sha1(row.payload).hexdigest() == planned[rec].payload_digest
    # A lost segment or a wrong total is an error, not a shorter page.
    for broken in (records.where("segment is null or segment <> 2"), records.selectExpr("* except (total)", "total + 1 as total")):
        with pytest.raises(Exception, match="segments of"):
            warc.reassemble(broken).collect()


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], DDL)).collect() == []


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_chunks(size):
    for payload in (b"", b"x", b"0\r\n\r\n" * 50):
        assert warc.dechunked(warc.chunked(payload, size)) == payload
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nContent-Type: x\r\n\r\nplain") == b"plain"


@pytest.mark.parametrize("broken", [b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b""])
def test_broken_chunks(broken):
    with pytest.raises(warc.WarcError):
        warc.dechunked(broken)


def test_broken_archives():
    good = warc.record(b"response", b"urn:x", b"block") + b"\r\n\r\n"
    assert [b for _, b in warc.records_of(good + good)] == [b"block"] * 2
    for broken in (good[:-3], b"junk" + good, good[:20]):
        with pytest.raises(warc.WarcError):
            list(warc.records_of(broken))
