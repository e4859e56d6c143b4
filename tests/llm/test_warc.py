import hashlib
import os
import random
import tempfile

import pytest

from tests.llm.helpers import SF
from tripcast.llm import warc
from tripcast.llm.queries import QUERIES


def _records(n):
    return [warc.record(i, f"u{i}", p, None, hashlib.sha256(p).hexdigest())
            for i in range(n) for p in [(f"payload {i} " * (i + 1)).encode()]]


def _ids(found):
    return [r["record_id"][10:-1] for r in found.records]


def test_whole_archives_read_back():
    recs = _records(20)
    for data in (b"".join(recs), b"".join(map(warc.member, recs))):
        found = warc.salvage(data)
        assert _ids(found) == [str(i) for i in range(20)] and not found.gaps


@pytest.mark.parametrize("compressed", [True, False])
def test_damage_costs_one_record(compressed):
    random.seed(1)
    parts = [warc.member(r) if compressed else r for r in _records(20)]
    starts = [sum(map(len, parts[:k])) for k in range(20)]
    hurt = 0
    for _ in range(80):
        k = random.randrange(20)
        data = bytearray(b"".join(parts))
        at = starts[k] + random.randrange(len(parts[k]))
        data[at] ^= 1 + random.randrange(255)
        found = warc.salvage(bytes(data))
        missing = {str(i) for i in range(20)} - set(_ids(found))
        assert missing <= {str(k)}
        if len(found.records) < 20:  # a changed header value alone is valid
            hurt += 1
            (gap,) = found.gaps[:1]
            assert starts[k] <= gap[0] <= at and gap[0] + gap[1] == starts[k] + len(parts[k])
    assert hurt > 20


def test_garbage_between_and_truncation():
    parts = [warc.member(r) for r in _records(6)]
    found = warc.salvage(b"garbage" + parts[0] + b"\x1f\x8b\x08junk" + parts[1] + parts[2][:-4])
    assert _ids(found) == ["0", "1"]
    assert [g[:2] for g in found.gaps] == [(0, 7), (7 + len(parts[0]), 7), (14 + len(parts[0]) + len(parts[1]), len(parts[2]) - 4)]
    assert not warc.salvage(b"").gaps and warc.salvage(b"junk").gaps[0][:2] == (0, 4)


def test_gzip_payload_in_a_damaged_plain_archive():
    packed = warc.member(b"a payload, compressed")
    first = warc.record(0, "u0", packed, None, hashlib.sha256(packed).hexdigest())
    found = warc.salvage(b"X" + first[1:] + b"".join(_records(4)[1:]))
    assert _ids(found) == ["1", "2", "3"] and [g[:2] for g in found.gaps] == [(0, len(first))]


def test_plain_records_among_gzip_members():
    parts = [warc.member(r) if k in (0, 3) else r for k, r in enumerate(_records(6))]
    found = warc.salvage(b"".join(parts))
    assert _ids(found) == [str(i) for i in range(6)] and not found.gaps
    parts[1] = b"X" + parts[1][1:]
    found = warc.salvage(b"".join(parts))
    assert _ids(found) == ["0", "2", "3", "4", "5"] and [g[:2] for g in found.gaps] == [(len(parts[0]), len(parts[1]))]


def test_stores_by_their_names(spark):
    assert warc.arrow_uri("s3a://bucket/a") == "s3://bucket/a" and warc.arrow_uri("hdfs://n:1/a") == "hdfs://n:1/a"
    assert warc.arrow_uri("file:/tmp/x") == "file:///tmp/x" and warc.arrow_uri("file:///tmp/x") == "file:///tmp/x"
    d = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="only to"):
        warc.write(d, "ftp://host/a")


def test_records_are_passed_on_as_they_are_found():
    parts = [warc.member(r) for r in _records(50)]
    parts[7] = b"junk" + parts[7]
    seen = 0
    for k, found in enumerate(warc.salvaged(b"".join(parts))):
        assert len(found.records) == 1 and len(found.gaps) == (k == 7)
        seen += 1
    assert seen == 50


def test_write_and_read_edge_cases(spark):
    long = "x" * 3_000_000
    rows = [(5, "u", long), (3, None, long), (3, None, long), (9, "u", "short"), (10, "u", "short"), (11, "u\r\nv", None),
            (12, "u", ""), (None, "u", long), (13, "u", "é" * 50), (14, "u", "é" * 50)]
    d = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, digest int, uri string")
    for compress in (True, False):
        folder = "file://" + tempfile.mkdtemp(prefix="tripcast-warc-")
        assert warc.write(d, folder, compress=compress, file_bytes=1000) == len(rows)
        out = warc.read(spark, folder)
        assert out.filter("kind = 'gap'").count() == 0
        got = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"])
                     for r in out.collect())
        sha = {p: hashlib.sha256(p.encode()).hexdigest() for p in (long, "short", "", "é" * 50)}

        def row(i, kind, to, p):
            return (f"<urn:page:{i}>", kind, to and f"<urn:page:{to}>", len(p.encode()), sha[p])

        assert got == sorted([row(5, "revisit", 3, long), row(3, "response", None, long), row(3, "response", None, long),
                              row(9, "response", None, "short"), row(10, "response", None, "short"), row(11, "response", None, ""),
                              row(12, "response", None, ""), row("", "response", None, long),
                              row(13, "response", None, "é" * 50), row(14, "revisit", 13, "é" * 50)])
    empty = "file://" + tempfile.mkdtemp(prefix="tripcast-warc-")
    assert warc.write(d.limit(0), empty) == 0


def test_gaps_of_a_damaged_file_are_logged(spark):
    folder = tempfile.mkdtemp(prefix="tripcast-warc-")
    parts = [warc.member(r) for r in _records(5)]
    with open(os.path.join(folder, "a.warc.gz"), "wb") as f:
        f.write(parts[0] + b"?" * 11 + parts[1])
    rows = warc.read(spark, "file://" + folder).collect()
    (gap,) = [r for r in rows if r["kind"] == "gap"]
    assert (gap["offset"], gap["length"]) == (len(parts[0]), 11) and gap["path"].endswith("a.warc.gz") and gap["reason"]
    assert len(rows) == 3


def test_query(spark):
    first, pages = {}, spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in pages:
        h = r["html"] or ""
        first[h] = min(first.get(h, r["page_id"]), r["page_id"])
    got = {r["page_id"]: r for r in QUERIES["op6_warc"](spark, SF).collect()}
    assert len(got) == len(pages)
    for r in pages:
        b = (r["html"] or "").encode()
        again = len(b) >= 100 and first[r["html"]] != r["page_id"]
        assert tuple(got[r["page_id"]])[1:] == (len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                                                first[r["html"]] if again else None)
