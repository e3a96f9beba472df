from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from phrasetide.llm import warc
from phrasetide.session import new_work_dir

BIG = "é<p>" * 50_000
HTML = {3: "x" * 999, 4: "x" * 999, 5: "y" * 1000, 6: "y" * 1000, 7: "y" * 1000, 8: None, 9: "",
        10: BIG, 12: BIG, 11: "<html>\r\n\r\nWARC/1.1\r\n" * 60}


@pytest.fixture
def pages(spark):
    def make(html, parts=3):
        rows = [(i, None if i == 9 else f"http://ex.org/{i} ü\r\n", h) for i, h in html.items()]
        return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    return make


def stored(spark, frame, chunk=warc.CHUNK):
    folder = new_work_dir(spark, "archives")
    warc.write_archives(warc.chunked(warc.with_references(frame), chunk), folder)
    return folder


@pytest.mark.parametrize("chunk", [1000, warc.CHUNK])
def test_records_equal_brute_force(spark, pages, chunk):
    folder = stored(spark, pages(HTML), chunk)
    got = {r.record_id: r for r in warc.read_records(spark, folder).collect()}
    assert set(got) == set(HTML)
    for page, html in HTML.items():
        raw = (html or "").encode()
        same = [p for p, h in HTML.items() if (h or "") == (html or "")]
        to = max(same) if len(raw) >= 1000 and max(same) != page else None
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r.record_type, r.refers_to) == ("revisit" if to else "response", to)


def test_chunks_are_bounded_and_carry_digests(spark, pages):
    folder = stored(spark, pages({1: BIG}))
    rows = warc.read_chunks(spark, folder).orderBy("chunk_no").collect()
    raw, at = BIG.encode(), 0
    assert [r.last for r in rows] == [False] * (len(rows) - 1) + [True] and len(rows) > 3
    for r in rows:
        assert len(r.chunk) <= warc.CHUNK
        at += len(r.chunk)
        assert (r.upto_bytes, r.upto_sha1) == (at, hashlib.sha1(raw[:at]).hexdigest())
    assert b"".join(bytes(r.chunk) for r in rows) == raw


def test_archives_are_gzip_members_with_headers(spark, pages):
    folder = stored(spark, pages({1: "<p>", 2: "z" * 2000, 3: "z" * 2000}))
    text = b"".join(gzip.decompress(f.read_bytes()) for f in Path(folder).glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"WARC-Type: revisit") == 1
    assert b"WARC-Refers-To: <urn:page:3>" in text and text.endswith(b"\r\n\r\n")


def test_a_changed_payload_is_noticed(spark, pages):
    folder = stored(spark, pages({1: "<p>unchanged"}))
    file = next(Path(folder).glob("*.warc.gz"))
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"unchanged", b"Unchanged")))
    with pytest.raises(Exception, match="isn't what it states"):
        warc.read_records(spark, folder).collect()


def test_a_cut_archive_is_noticed(spark, pages):
    folder = stored(spark, pages({1: BIG}))
    file = next(Path(folder).glob("*.warc.gz"))
    file.write_bytes(file.read_bytes()[:-40])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, folder).collect()


def test_odd_tables(spark, pages):
    folder = stored(spark, pages({1: "a"}).filter("page_id < 0"))
    assert warc.read_records(spark, folder).count() == 0
    extra = pages({1: "a", 2: "a"}).withColumn("chunk", F.lit(1)).withColumn("payload", F.lit(2))
    assert warc.read_records(spark, stored(spark, extra)).count() == 2


def test_repeated_and_missing_ids(spark):
    x, y, z = "x" * 1500, "y" * 1200, "z" * 1000
    rows = [(1, x), (1, y), (2, x), (2, z), (3, y), (3, y), (3, y), (4, y), (5, BIG), (5, BIG),
            (None, "n"), (None, x), (None, BIG), (None, None)]
    frame = spark.createDataFrame([(i, "u", h) for i, h in rows],
                                  "page_id long, url string, html string").repartition(3)
    folder = stored(spark, frame)
    want = []
    for page, html in rows:
        raw = (html or "").encode()
        same = [p for p, h in rows if h == html and p is not None]
        to = max(same) if page is not None and len(raw) >= 1000 and max(same) != page else None
        want.append((page, "revisit" if to else "response", len(raw),
                     hashlib.sha1(raw).hexdigest(), to))
    got = [tuple(r) for r in warc.read_records(spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    text = b"".join(gzip.decompress(f.read_bytes()) for f in Path(folder).glob("*.warc.gz"))
    assert all(h.encode() in text for h in (x, y, z, BIG))
