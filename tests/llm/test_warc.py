"""Archives and index: exact round trips and lookups."""

import base64
import gzip
import hashlib

import pytest

from meteoframe.llm import warc

PAGES = [(1, "http://a.example.com/x", "same"), (5, "http://a.example.com/x", "same"), (3, "https://www.b.example.org/y?q=1", "same"),
         (4, "http://c.example.net/", None), (6, "http://c.example.net/", ""), (7, None, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
         (8, "http://a.example.com/x", "é" * 60000), (None, "http://a.example.com/x", "same"), (9, "http://d.example.com/", "one\x1f\x8b\x08"),
         (10, "http://d.example.com/", "twice"), (10, "http://d.example.com/", "twice")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warc"))
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, digest string")
    warc.write_archives(pages.repartition(3), f"{root}/archives")
    records = warc.read_archives(spark, f"{root}/archives")
    warc.write_index(records, f"{root}/index", block_entries=3)
    return root, records


def test_round_trip(archive):
    got = {}
    for r in archive[1].collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(PAGES)
    for page_id, url, html in PAGES:
        raw = (html or "").encode()
        for r in got[page_id]:
            assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert r.payload is None if r.record_type == "revisit" else r.payload == raw
    kinds = {k: {(r.record_type, r.refers_to) for r in v} for k, v in got.items()}
    assert kinds[1] == kinds[3] == kinds[None] == {("revisit", 5)} and kinds[5] == {("response", None)}
    assert kinds[4] == {("revisit", 6)} and kinds[6] == {("response", None)}
    assert kinds[10] == {("response", None)}          # ties are all responses


def test_short_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/a", least_bytes=5)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, f"{tmp_path}/a").collect()}
    assert kinds[1] == kinds[3] == kinds[4] == "response"


def test_files_are_plain_gzip(archive, spark):
    for file in {r.file for r in archive[1].collect()}:
        assert gzip.decompress(open(file.removeprefix("file:").replace("///", "/"), "rb").read()).startswith(b"WARC/1.1\r\n")


def test_every_capture_is_indexed_and_found(archive, spark):
    root, records = archive
    rows = [r.asDict() for r in records.drop("payload").collect()]
    captures = warc.read_captures(spark, f"{root}/index").collect()
    assert sorted((c.file, c.offset, c.length) for c in captures) == sorted((r["file"], r["offset"], r["length"]) for r in rows)
    index = warc.CaptureIndex(spark, f"{root}/index")
    for url in {p[1] for p in PAGES if p[1]}:
        found = index.captures(url)
        assert sorted((c["file"], c["offset"]) for c in found) == sorted((r["file"], r["offset"]) for r in rows if r["url"] == url)
        for c in found:
            record = index.record(c)
            assert record["page_id"] == c["page_id"] and record["payload_digest"] == c["payload_digest"]
    assert index.captures("http://nowhere.example/") == []


def test_url_keys_and_empty_table(spark, tmp_path):
    assert warc.url_key("https://WWW.Example.com:80/a b?c") == "com,example,www)/a%20b?c"
    assert warc.url_key(None) == warc.url_key("nonsense") == "-"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/e")
    records = warc.read_archives(spark, f"{tmp_path}/e")
    assert records.count() == 0
    warc.write_index(records, f"{tmp_path}/i")
    assert warc.CaptureIndex(spark, f"{tmp_path}/i").captures("http://a.example.com/x") == []


def test_damage_is_noticed():
    member = warc.record_member(1, "http://a.example/", b"payload", warc.base32_sha1(b"other"), None, False, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.parse_member(member)
