import gzip
import hashlib
import io

import duckdb
import pytest

from stockweave.llm import warc
from stockweave.llm.catalog import ORACLES, QUERIES

LONG = "<p>é😀" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello"
ROWS = [
    (1, "http://a/1", LONG, "x"),
    (9, "http://a/9\r\nWARC-Type: evil", LONG, "x"),
    (9, "http://a/9", LONG, "x"),
    (None, None, LONG, "x"),
    (2, None, None, "x"),
    (3, "http://a/3", "short", "x"),
    (4, "http://a/4", "short", "x"),
    (None, "u", "y" * 2000, "x"),
    (5, "http://a/5", "z" * 1000, "x"),
    (6, "http://a/6", "z" * 1000, "x"),
    (7, "http://a/7", "w" * 999, "x"),
    (8, "http://a/8", "w" * 999, "x"),
]


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, record string")
    path = str(tmp_path_factory.mktemp("warc") / "a")
    warc.write(pages, path, records_per_file=4)
    return path


def test_round_trip(spark, archived):
    got = sorted((tuple(r) for r in warc.page_digests(warc.read(spark, archived)).collect()), key=str)
    want = []
    last = {LONG: 9, "z" * 1000: 6}
    for page, _, html, _ in ROWS:
        data = (html or "").encode()
        revisit = html in last and page != last[html]
        kind, to = ("revisit", last[html]) if revisit else ("response", None)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, to))
    assert got == sorted(want, key=str)


def test_record_layout(spark, archived):
    rows = warc.read(spark, archived).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        assert r.date and r.record_id.startswith("<urn:uuid:") and r.headers["content-length"]
        if r.record_type == "revisit":
            assert r.payload == b"" and r.headers["warc-profile"] and by_id[r.refers_to].record_type == "response"
    assert any(r.target_uri == "http://a/9%0D%0AWARC-Type: evil" for r in rows)


def test_filters_are_pushed_and_blocks_skipped(spark, archived):
    df = warc.read(spark, archived, payload=False).where(
        "record_type = 'response' and target_uri like 'http://a/%' and target_uri in ('http://a/3', 'http://a/6')"
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert sorted(r.target_uri for r in df.collect()) == ["http://a/3", "http://a/6"]
    assert all(r.payload is None for r in df.collect())

    class Counting(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            Counting.got += len(data)
            return data

    record = b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: 9\r\n\r\n012345678\r\n\r\n"
    data = record % b"request" + record % b"response"
    rows = list(warc.parse(Counting(data), [("warc-type", "equals", "response")], True))
    assert [r[0] for r in rows] == ["response"] and rows[0][-1] == b"012345678" and Counting.got == 9


def test_stored_pages_push_their_record_type(spark, archived, tmp_path):
    """The reader is handed the predicates, and what the query returns is what a full read gives."""
    got = warc.stored_pages(spark, archived)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 2 and "Filter (" not in plan
    assert sorted(map(str, got.collect())) == sorted(map(str, warc.page_digests(warc.read(spark, archived)).collect()))
    # a record of another writer and type
    foreign = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    foreign += b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "f.warc").write_bytes(foreign)
    (row,) = warc.stored_pages(spark, str(tmp_path)).collect()
    assert (row.page_id, row.payload_bytes, row.record_type) == (None, 3, "response")


def test_gzip_folded_lines_and_broken_files(spark, tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: resource\r\nX-Long: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(head) + gzip.compress(head))
    rows = warc.read(spark, str(tmp_path)).collect()
    assert [(r.record_type, r.headers["x-long"], bytes(r.payload)) for r in rows] == [("resource", "a b", b"abc")] * 2
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(b"HTTP/1.1 200\r\n"), [], True))
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(head[:-6]), [], True))


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).collect() == []


def test_query(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    df = QUERIES["op2_warc"](spark, sf_dir)
    columns = ", ".join(df.columns)
    want = con.execute(f"select {columns} from ({ORACLES['op2_warc']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))
