import gzip
import hashlib
import io
import tracemalloc

import duckdb
import pytest

from stockloom.llm import op13_warc as w

SCHEMA = "page_id long, url string, html string, digest string, chunk_no int"


def facts(spark, rows, tmp_path, chunk=w.CHUNK, **settings):
    pages = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    archives = w.written(w.record_types(pages), f"file://{tmp_path}/warc", **settings)
    table = w.read_archives(archives, chunk)
    return archives, table, sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.payload_facts(table).collect())


def wanted(rows):
    out, first = [], {}
    data = [(i, (h or "").encode()) for i, _, h in rows]
    for i, x in data:
        if len(x) >= 100 and i is not None:
            first[x] = min(i, first.get(x, i))
    for i, x in data:
        again = x in first and (i is None or i > first[x])
        out.append((i is None, i or 0, len(x), hashlib.sha256(x).hexdigest(), "revisit" if again else "response", first[x] if again else None))
    return sorted(out)


ROWS = [
    (5, "http://a/1", "ä" * 50), (3, "http://a/2", "ä" * 50), (3, "http://a/2", "ä" * 50), (9, None, "x" * 99), (10, "u", "x" * 99), (11, "u\r\nWARC-Type: revisit", "y" * 100),
    (None, "u", "y" * 100), (None, "u", "z" * 100), (None, "u", "z" * 100), (12, "u", None), (13, "u", ""), (14, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (15, "u", "q" * 5_000_000),
]


def test_round_trip(spark, tmp_path):
    archives, table, found = facts(spark, ROWS, tmp_path)
    assert found == wanted(ROWS) and archives.agg({"records": "sum"}).first()[0] == len(ROWS)
    long = [r for r in table.where("page_id = 15").orderBy("chunk_no").collect()]
    assert [len(r.data) for r in long] == [w.CHUNK] * 4 + [5_000_000 - 4 * w.CHUNK] and [r.last for r in long] == [False] * 4 + [True]
    assert [r.digest_so_far for r in long] == [hashlib.sha256(b"q" * r.bytes_so_far).hexdigest() for r in long]
    assert {r.url for r in table.where("page_id = 11").collect()} == {"u%0D%0AWARC-Type: revisit"}


@pytest.mark.parametrize("chunk", [1, 7, 100])
def test_chunks_of_any_size_give_the_same_payloads(spark, tmp_path, chunk):
    rows = [r for r in ROWS if len(r[2] or "") < 1000]
    _, table, found = facts(spark, rows, tmp_path, chunk, archive_bytes=1500)
    assert found == wanted(rows)
    back = {bytes(r.payload) for r in w.payloads(table, 10_000).collect()}
    assert back == {(h or "").encode() for _, _, h in rows}


def test_empty_table(spark, tmp_path):
    archives, table, found = facts(spark, [], tmp_path)
    assert found == [] and archives.count() == 0


def stream(data: bytes, chunk=50):
    return w.Inflated(io.BytesIO(data).read, chunk)


def test_foreign_archives_and_broken_ones():
    one = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nX: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bare = b"WARC/1.1\nwarc-type: response\nContent-Type: application/http\nContent-Length: 24\n\nHTTP/1.1 200 OK\nA: b\n\nhi\n\n"
    for data in (one + bare, gzip.compress(one + bare), gzip.compress(one) + gzip.compress(bare)):
        rows = list(w.chunk_rows(stream(data), 3))
        assert [(r[0], r[6], r[9]) for r in rows] == [("<urn:x>", b"hel", False), ("<urn:x>", b"lo", True), (None, b"hi", True)]
    with pytest.raises(EOFError):
        list(w.chunk_rows(stream(gzip.compress(one)[:-20]), 3))
    with pytest.raises(EOFError):
        list(w.chunk_rows(stream(one[:-8]), 3))
    with pytest.raises(ValueError, match="differs"):
        list(w.chunk_rows(stream(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"), 3))


def test_a_long_record_is_not_held_in_memory():
    class Zeros:
        left = 300 << 20

        def read(self, n):
            n = min(n, self.left)
            self.left -= n
            return b"0" * n

    source = Zeros()
    head = io.BytesIO(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % source.left)
    tracemalloc.start()
    rows = sum(1 for _ in w.chunk_rows(w.Inflated(lambda n: head.read(n) or source.read(n), w.CHUNK), w.CHUNK))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300 and peak < 10 << 20


def test_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    found = sorted(tuple(r) for r in w.op13_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    with duckdb.connect() as c:
        c.execute(f"create view pages as select * from '{folder}/pages.parquet'")
        assert found == sorted(c.sql(w.SQL).fetchall())
