import hashlib

from tablemover.llm.line_dedup import dedup_lines
from tablemover.llm.queries import OP4_SQL, op4_line_dedup

from .conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=2):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        stay = [x for x in (t or "").split("\n")
                if i is None or len(key(x)) < 10 or len(held[key(x)]) < least or min(held[key(x)]) == i]
        out.append((i, t if t is None and stay == [""] else "\n".join(stay)))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def test_awkward(awkward):
    got = dedup_lines(awkward)
    assert got.columns == awkward.columns
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert ordered((r.doc_id, r.text) for r in got.collect()) == ordered(brute(rows))


def test_three_documents(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = dedup_lines(awkward, min_docs=3)
    assert ordered((r.doc_id, r.text) for r in got.collect()) == ordered(brute(rows, 3))


def test_empty(nothing):
    assert dedup_lines(nothing).count() == 0


def test_query_is_its_sql(spark, duck):
    want = {r[0]: tuple(r) for r in duck.execute(
        f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({OP4_SQL})").fetchall()}
    assert {r.doc_id: tuple(r) for r in op4_line_dedup(spark, SF).collect()} == want


def test_digest_is_of_the_kept_text(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in brute(rows)}
    assert {r.doc_id: r.kept_sha256 for r in op4_line_dedup(spark, SF).collect()} == want
