import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemover.llm import common, minmax
from tablemover.llm.components import components
from tablemover.llm.minmax import drop_near_duplicates, near_duplicates, shingle_set, signature
from tablemover.llm.queries import op5_minmax_dedup

from .conftest import SF


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*[words[k:] for k in range(width)])) if len(words) >= width else frozenset([tuple(words)] if words else [])


def least_reachable(nodes, links):
    up = {n: n for n in nodes}
    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs, width, bound=80):
    sets = {i: shingles(t, width) for i, t in docs.items()}
    links = [(a, b) for a, b in combinations(sorted(docs), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= bound * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, least_reachable(list(docs), links)


def check(df, docs, width):
    sizes, roots = brute(docs, width)
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(df, width=width).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in docs}


def test_awkward(awkward, nothing):
    rows = awkward.collect()
    docs = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    sizes, roots = brute(docs, 4)
    got = near_duplicates(awkward, width=4).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.id is None else roots[r.id])
    assert drop_near_duplicates(awkward).columns == awkward.columns
    assert near_duplicates(nothing).count() == 0 and drop_near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("rounds", [12, 1, 0])
def test_group_of_near_copies(spark, monkeypatch, rounds):
    """Copies edited to differing degrees, many pairs of them below the threshold, in chains; with few or no
    star rounds the exact rest has to find the links."""
    monkeypatch.setattr(minmax, "MOST_ROUNDS", rounds)
    monkeypatch.setattr(minmax, "SMALL", 8 if rounds < 12 else 64)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    docs = {}
    for k in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(200)] = f"z{rng.randrange(10**6)}"
        docs[1000 - k] = " ".join(words)
    for k in range(60):
        docs[2000 + k] = " ".join(f"q{k}v{j}" for j in range(50))
    check(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), docs, 4)


def test_edge_of_the_threshold(spark):
    docs = {1: "a b c d e f g h i", 2: "a b c d e f g h i j", 3: "x", 4: "X ", 5: "x y", 6: "b c d e f g h i j k l m"}
    check(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), docs, 4)


def test_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**64, 600, dtype=np.uint64)
        a, b = np.unique(pool[:500]), np.unique(pool[100:])
        errors.append((signature(a) == signature(b)).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.015


def test_shingle_sets_of_few_words():
    assert len(shingle_set(None, 4)) == len(shingle_set(" \n", 4)) == 0
    assert len(shingle_set("a b", 4)) == 1 and (shingle_set("a b", 4) != shingle_set("a  c", 4)).all()
    assert (shingle_set("A b", 4) == shingle_set("a\x0bB", 4)).all()


def test_components(spark, tmp_path):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5)]
    got = components(spark.createDataFrame(links, "a long, b long"), str(tmp_path / "c"))
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert {r.node: r.root for r in got.collect()} == least_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "d")).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, roots = brute(docs, 4)
    rows = op5_minmax_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (sizes[i], roots[i], roots[i] == i) for i in docs}


def test_one_of_each_group_stays(awkward):
    groups = defaultdict(list)
    for r in near_duplicates(awkward).collect():
        groups[r.component_id].append(r.id)
    kept = {r.doc_id for r in drop_near_duplicates(awkward).collect()}
    assert all(g in kept for g in groups) and all(i == g or i not in kept for g, v in groups.items() for i in v if g is not None)


def test_long_signatures_estimate_closely():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**64, 600, dtype=np.uint64)
        a, b = np.unique(pool[:540]), np.unique(pool[60:])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(minmax.estimates(minmax.long_signature(a), minmax.long_signature(b)[None])[0] - j)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.025


@pytest.mark.parametrize("bitmaps", [1, 4096])
def test_rows_without_an_id_among_the_few_are_told_apart(spark, monkeypatch, bitmaps):
    monkeypatch.setattr(common, "MOST_BITMAPS", bitmaps)
    rows = spark.range(-20_000, 20_000).unionByName(spark.createDataFrame([(None,)], "id long"))
    ids = spark.range(0, 20_000, 10).withColumnRenamed("id", "wanted")
    got = {r.id: r.maybe for r in common.maybe_among(rows, F.col("id"), ids).collect()}
    assert len(got) == 40_001 and all(got[i] for i in range(0, 20_000, 10))
    assert sum(got.values()) < 2_000 + 40_000 / (20 if bitmaps > 1 else 10)
    none = common.maybe_among(rows, F.col("id"), ids.where("wanted < 0"))
    assert none.count() == 40_001 and none.where("maybe").isEmpty()


def test_texts_that_stay_are_not_shuffled(spark):
    """Only the rows that are likely to go meet the join that would shuffle whole texts."""
    text = " ".join(f"w2x{j}" for j in range(30))
    docs = spark.createDataFrame([(k, text.replace("w2x", f"w{k}x"), "s") for k in range(2, 400)]
                                 + [(1000, text, "s"), (None, text, "s")], "doc_id long, text string, source string")
    kept = drop_near_duplicates(docs)
    assert {r.doc_id for r in kept.collect()} == {*range(2, 400), None}
    node = kept._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Union":
        assert node.nodeName() in ("Project", "Filter")  # no join over all rows
        node = node.children().head()
    assert sorted("LeftAnti" in node.children().apply(k).toString() for k in range(2)) == [False, True]
