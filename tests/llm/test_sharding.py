import random
import zlib
from collections import Counter, defaultdict

from tablemover.llm.queries import op3_sharding
from tablemover.llm.sharding import communication_matrix, hypergeometric, shard_rows

from .conftest import SF


def check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_awkward(awkward):
    rows = shard_rows(awkward, 3, ["doc_id", "text"]).collect()
    assert sorted(map(repr, (r.row for r in rows))) == sorted(map(repr, awkward.collect()))
    check(rows, 3)
    assert len(shard_rows(awkward, 40, ["doc_id", "text"]).collect()) == 14


def test_empty(nothing):
    assert shard_rows(nothing, 4, ["doc_id"]).count() == 0


def test_matrix_sums():
    blocks, shards = [5, 0, 17, 100, 1], [41, 41, 41]
    m = communication_matrix(blocks, shards, 3)
    assert [sum(r) for r in m] == blocks
    assert [sum(c) for c in zip(*m)] == shards


def test_draws_follow_the_law():
    rng, n = random.Random(1), 20_000
    got = Counter(hypergeometric(rng, 4, 6, 5) for _ in range(n))
    exact = {0: 6, 1: 60, 2: 120, 3: 60, 4: 6}  # of 252
    assert all(abs(got[k] / n - exact[k] / 252) < 0.015 for k in exact)
    big = hypergeometric(rng, 3 * 10**10, 7 * 10**10, 10**9)
    assert abs(big - 3 * 10**8) < 10**6


def test_every_row_reaches_every_place(spark):
    df = spark.range(60).withColumnRenamed("id", "k")
    seen = Counter()
    for seed in range(12):
        seen.update((r.row.k % 3, r.shard) for r in shard_rows(df, 3, ["k"], seed=seed).collect())
    assert all(seen[a, s] > 40 for a in range(3) for s in range(3))


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_sharding(spark, SF).collect()
    check(rows, 24)
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert rows and sorted(rows) == sorted(op3_sharding(spark, SF).collect())
