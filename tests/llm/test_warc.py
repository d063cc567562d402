"""Archives written and read back."""

import glob
import hashlib

import pytest
import zstandard

from tests.oracle import connect, difference
from tidemark.llm import queries, warc

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
LONG = "<p>équal</p>" * 20


def written(spark, df, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(df, path)
    return path, warc.read_archives(spark, path)


def test_agrees_with_sql(spark):
    name = "op11_warc"
    with connect(SF_DIR) as connection:
        assert difference(spark, connection, queries.QUERIES[name], queries.ORACLE[name], SF_DIR) is None


def test_odd_pages(spark, tmp_path):
    pages = [
        (3, "http://a/x", LONG), (1, None, LONG), (2, "http://b/\r\nWARC-Type: metadata", LONG), (4, "", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", LONG + "\r\n\r\nWARC/1.1\r\n\r\n\x00P*M\x18"), (8, "u", LONG + "!"),
        (8, "u", LONG + "!"), (None, "n", "y" * 100), (9, "u", "y" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99),
        (12, "u", "<i>long</i>" * 400_000),
    ]
    df = spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS row", "2 AS size", "3 AS digest", "4 AS head")
    _, read = written(spark, df, tmp_path)
    found = {}
    for r in read.collect():
        found.setdefault(r.page_id, []).append(r)
        assert r.intact is (True if r.record_type == "response" else None)
    kinds = {p: sorted((r.record_type, r.refers_to) for r in rows) for p, rows in found.items()}
    alone = [("response", None)]
    assert kinds[1] == alone and kinds[2] == kinds[3] == [("revisit", 1)]
    assert kinds[8] == [("response", None)] * 2 + [("revisit", 8)]
    assert kinds[None] == alone and kinds[9] == [("revisit", None)]
    assert all(kinds[p] == alone for p in (4, 5, 6, 7, 10, 11, 12))
    for page_id, url, html in pages:
        payload = (html or "").encode()
        same = [r for r in found[page_id] if r.payload_digest == hashlib.sha256(payload).hexdigest()]
        assert same and all(r.payload_bytes == len(payload) for r in same)
        assert any(r.payload == payload for r in same) or all(r.record_type == "revisit" for r in same)
        assert found[page_id][0].url == (None if url is None else url.replace("\r\n", "%0D%0A"))


def test_archives_are_plain_zstandard(spark, tmp_path):
    df = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    path, read = written(spark, df, tmp_path)
    assert read.select("payload").count() == df.count()
    size = 0
    for name in glob.glob(f"{path}/part-*"):
        with open(name, "rb") as f:
            data = f.read()
        size += len(data)
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
        end = 8 + int.from_bytes(data[4:8], "little")
        whole = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:end])).stream_reader(
            data[end:], read_across_frames=True
        ).read()
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
        assert whole.count(b"WARC-Record-ID: ") == len(list(warc.records_of(memoryview(data))))
    assert size < sum(len(r.html) for r in df.select("html").collect())


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_pages(spark, tmp_path, n):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(n)], PAGES)
    _, read = written(spark, df, tmp_path)
    assert sorted((r.page_id, bytes(r.payload)) for r in read.collect()) == [(i, b"page %d" % i) for i in range(n)]
