import gzip
import hashlib

from tablemover.llm.queries import OP10_SQL, op10_warc
from tablemover.llm.warc import read_warc, records_of, write_warc

from .conftest import SF

SCHEMA = "page_id long, url string, html string, row string, digest string, kind string"


def test_round_trip_in_chunks(spark, tmp_path):
    big = "<p>é\r\n\r\nWARC/1.0\r\n" * 20_000
    pages = [(1, "u\r\nx", "small"), (2, None, None), (3, "u", ""), (4, "u", big), (5, "u", big), (5, "u", big),
             (None, "u", big), (6, "u", "y" * 999), (7, "u", "y" * 999), (8, None, "z" * 1000)]
    df = spark.createDataFrame([(*p, "a", "b", None) for p in pages], SCHEMA)
    manifest = write_warc(df, f"file://{tmp_path}/w", "page_id", "url", "html", chunk_bytes=4096)
    chunks = read_warc(manifest, chunk_bytes=4096)
    rows = chunks.collect()
    assert max(len(r.chunk) for r in rows) == 4096
    whole = {}
    for r in sorted(rows, key=lambda r: (r.record_id or "", r.record_type, r.chunk_no)):
        if r.record_type == "response" and r.record_id in ("4", "1", "3", "8"):
            whole[r.record_id] = whole.get(r.record_id, b"") + r.chunk
            assert r.digest_so_far == hashlib.sha1(whole[r.record_id]).hexdigest()
    assert "4" not in whole and whole["1"] == b"small" and whole["3"] == b"" and whole["8"] == b"z" * 1000
    got = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
                  for r in records_of(chunks).collect()), key=repr)
    n, d = len(big.encode()), hashlib.sha1(big.encode()).hexdigest()
    sha = lambda s: hashlib.sha1(s).hexdigest()
    assert got == sorted([
        ("1", "response", None, 5, sha(b"small")), ("2", "response", None, 0, sha(b"")), ("3", "response", None, 0, sha(b"")),
        ("4", "revisit", "5", n, d), ("5", "response", None, n, d), ("5", "response", None, n, d),
        (None, "response", None, n, d), ("6", "response", None, 999, sha(b"y" * 999)),
        ("7", "response", None, 999, sha(b"y" * 999)), ("8", "response", None, 1000, sha(b"z" * 1000))], key=repr)


def test_archives_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "<b>x</b>", "", "", "")], SCHEMA)
    manifest = write_warc(df, f"{tmp_path}/w", "page_id", "url", "html").collect()
    data = gzip.open(manifest[0].archive).read()
    assert manifest[0].records == 1 and data.startswith(b"WARC/1.0\r\n") and data.endswith(b"<b>x</b>\r\n\r\n")
    head, _, block = data.partition(b"\r\n\r\n")
    length = int(head.rpartition(b"Content-Length: ")[2])
    assert len(block) == length + 4


def test_empty(spark, tmp_path):
    manifest = write_warc(spark.createDataFrame([], SCHEMA), f"{tmp_path}/w", "page_id", "url", "html")
    assert manifest.count() == 0 and records_of(read_warc(manifest)).count() == 0


def test_query_is_its_sql(spark, duck):
    want = duck.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({OP10_SQL})").fetchall()
    assert sorted(map(tuple, op10_warc(spark, SF).collect()), key=repr) == sorted(want, key=repr)
