import hashlib

import pytest
from pyspark.sql import functions as F

from pactframe.llm import warc as w
from pactframe.scratch import scratch_path

PAGE = "<html>" + "é🙂 text\r\n\r\nWARC/1.1\r\n" * 40


def archived(session, rows, **settings):
    frame = session.createDataFrame(
        [(i, u, h, "clash", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, digest int"
    )
    path = scratch_path(session, "warc-test")
    w.write_warc(frame, path, **settings)
    return w.read_warc(session, path)


def expected(rows):
    firsts = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            firsts[html] = min(i, firsts.get(html, i))
    out = []
    for i, _, html in rows:
        data, first = (html or "").encode(), firsts.get(html)
        revisit = first is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/1", PAGE), (3, "http://a/2\r\nX-Evil: 1", PAGE), (9, None, PAGE), (3, "http://a/3", PAGE),
    (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (None, "u", PAGE), (None, "u", "other"),
    (10, "u", "x" * 300_000), (11, "u", "x" * 300_000), (12, "u", "0\r\n\r\n" * 50),
]


@pytest.mark.parametrize("segment", [90, 1000, 65_536])
def test_round_trip(session, segment):
    rows = ROWS if segment > 90 else [r for r in ROWS if r[2] is None or len(r[2]) < 3000]
    records = archived(session, rows, segment_bytes=segment, chunk_bytes=37 if segment < 1000 else 8192, records_per_file=5)
    whole = w.reassemble(records)
    found = w.page_payloads(whole).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    assert whole.where("NOT complete").count() == 0
    payloads = {r["page_id"]: bytes(r["payload"]) for r in whole.where("record_type = 'response'").collect()}
    assert payloads[7] == b"short" and payloads[4] == b""
    if segment == 1000:
        assert records.where("record_type = 'continuation'").count() > 300
        assert "%0D%0A" in whole.where("page_id = 3 AND url LIKE '%a/2%'").first()["url"]


def test_segments_with_a_gap_or_a_wrong_length_are_incomplete(session):
    records = archived(session, [(1, "u", "y" * 5000), (2, "u", "z" * 5000), (3, "u", "v" * 100)], segment_bytes=1000)
    first = records.where("page_id = 1").first()["record_id"]
    damaged = records.where(~(F.col("origin_id").eqNullSafe(first) & F.col("segment").eqNullSafe(3)))
    rows = {r["page_id"]: r for r in w.reassemble(damaged).collect()}
    assert len(rows) == 3
    assert not rows[1]["complete"] and rows[1]["payload"] is None
    assert bytes(rows[2]["payload"]) == b"z" * 5000 and bytes(rows[3]["payload"]) == b"v" * 100
    wrong = records.withColumn("total_length", F.col("total_length") + 1)
    assert {r["page_id"]: r["complete"] for r in w.reassemble(wrong).collect()} == {1: False, 2: False, 3: True}


def test_chunk_framing():
    for data in (b"", b"a", b"ab" * 5000):
        for size in (1, 7, 8192):
            assert w.unframed(w.framed(data, size)) == data
    assert w.unframed(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"3\r\nab", b"5\r\nabc\r\n0\r\n\r\n", b""):
        with pytest.raises(ValueError):
            w.unframed(broken)
    assert w.payload_of(b"HTTP/1.1 200 OK\r\nContent-Type: a\r\n\r\n3\r\n") == b"3\r\n"


def test_damaged_archive_raises():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r["block"] for r in w.parsed(record * 2)] == [b"abc", b"abc"]
    for broken in (record[:-1], b"HTTP" + record, record + b"WARC/1.1\r\n"):
        with pytest.raises(ValueError):
            list(w.parsed(broken))


def test_empty_table(session):
    assert w.page_payloads(w.reassemble(archived(session, []))).collect() == []


def test_many_repeated_digests_are_joined_by_a_shuffle(session, monkeypatch):
    monkeypatch.setattr(w, "BROADCAST_ROWS", -1)
    found = w.page_payloads(w.reassemble(archived(session, ROWS)))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=str) == expected(ROWS)
