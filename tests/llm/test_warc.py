import gzip
import hashlib
import json

import pytest

from tidemark.llm.warc import _store, archive_pages, normalise, read_archives, read_records, write_archives

BIG = "<p>same</p>" * 20
PAGES = [
    (7, "http://a/", BIG), (3, "http://b/\r\nWARC-Type: x", BIG), (9, None, BIG), (4, "http://c/ü", "short"), (5, "u", "short"), (6, "u", None),
    (8, "u", ""), (10, "u", "é" * 50), (2, "u", "é" * 50), (11, "u", "WARC/1.1\r\n\r\n" * 40), (12, "u", "x" * 300_000), (13, "u", "x" * 99), (14, "u", "x" * 99),
]


def _want(pages):
    firsts = {}
    for i, _, html in pages:
        data = (html or "").encode()
        firsts[data] = min(i, firsts.get(data, i))
    out = {}
    for i, _, html in pages:
        data = (html or "").encode()
        copy = len(data) >= 100 and firsts[data] < i
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), "revisit" if copy else "response", firsts[data] if copy else None)
    return out


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, record_type string").repartition(3)
    found = archive_pages(df, str(tmp_path / "w"))
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == _want(PAGES)


def test_members_stand_at_their_offsets(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    records = write_archives(df, str(tmp_path / "whole"), "page_id", "url", "html", archive_bytes=2000)
    whole = sorted((tmp_path / "whole").iterdir())
    assert len(whole) > 1 and records.count() == len(PAGES)
    assert sum(len(list(read_records(gzip.open(f)))) for f in whole) == len(PAGES)
    done = normalise(records.select("archive").distinct(), f"file://{tmp_path}/members")
    for row in done.collect():
        data = _store(row["archive"])[0].open_input_file(_store(row["archive"])[1]).read()
        entries = [json.loads(x) for x in open(_store(row["index"])[1])]
        assert [e["offset"] for e in entries] == [sum(e["length"] for e in entries[:i]) for i in range(len(entries))]
        assert sum(e["length"] for e in entries) == len(data)
        for e in entries:  # each member can be inflated by itself
            record = gzip.decompress(data[e["offset"]:e["offset"] + e["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and e["id"].encode() in record
    urls = {r["record_id"]: r["url"] for r in read_archives(done).collect()}
    assert urls["3"] == "http://b/%0D%0AWARC-Type:%20x" and urls["4"] == "http://c/ü" and urls["9"] is None


def test_a_cut_off_stream_fails_with_its_name(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    name = write_archives(df, str(tmp_path / "whole"), "page_id", "url", "html").first()["archive"]
    data = open(name, "rb").read()
    open(name, "wb").write(data[:len(data) // 2])
    with pytest.raises(Exception, match=name):
        normalise(spark.createDataFrame([(name,)], "archive string"), str(tmp_path / "m")).collect()
    assert not [f for f in (tmp_path / "m").iterdir()]


def test_empty_and_nameless(spark, tmp_path):
    schema = "page_id long, url string, html string"
    assert archive_pages(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(None, None, BIG), (None, None, BIG), (5, None, BIG), (5, None, BIG), (None, None, None)], schema)
    found = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in archive_pages(df).collect())
    assert found == [("5", "response", None)] * 2 + [("None", "response", None)] + [("None", "revisit", 5)] * 2
