import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablemover.llm import decontaminate
from tablemover.llm.decontaminate import (Q, QGramIndex, _codes, contamination, drop_contaminated, edit_budget, find_matches,
                                          normalised)
from tablemover.llm.queries import op9_decontaminate

from .conftest import SF

ITEM = "What is the tallest mountain that a climber has reached, without oxygen, before nineteen hundred and eighty?"


def least_edits(pattern, text):
    """Edits between the pattern and any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.34:
            out[k] = "q"
        elif kind < 0.67:
            out.insert(k, "j")
        else:
            del out[k]
    return "".join(out)


@settings(max_examples=150, deadline=None)
@given(seed=st.integers(0, 10**6), edits=st.integers(0, 14), before=st.integers(0, 40))
def test_all_within_the_budget_are_found_and_no_others(seed, edits, before):
    rng = random.Random(seed)
    pattern = normalised(ITEM)
    doc = "lorem ipsum dolor "[:before] + edited(rng, pattern, edits) + " sit amet"[:rng.randrange(9)]
    want, found = least_edits(pattern, doc), QGramIndex([(1, pattern)]).search(_codes(doc))
    assert bool(found) == (want <= edit_budget(len(pattern)))
    if found:
        assert found[0][3] == want


def test_lemma_holds_for_every_length():
    for m in range(Q, 400):
        assert m - Q + 1 - Q * edit_budget(m) >= 1


def test_awkward(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "One two, three FOUR five six seven eight nine ten eleven twelve"), (2, None), (3, ""), (4, "tiny"),
                                   (5, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    for r in contamination(awkward, items).collect():
        want = [1, 5] if "one two three four five six" in (r.row.text or "") else []
        assert r["items"] == want and r.edits == (0 if want else None)
    clean = drop_contaminated(awkward, items)
    assert clean.columns == awkward.columns and clean.count() == 14 - 4
    assert contamination(nothing, items).count() == 0
    assert {r.edits for r in contamination(awkward, items.where("false")).collect()} == {None}


def test_blocks_and_segments_change_nothing(spark, monkeypatch):
    from tablemover.llm import decontaminate

    rng = random.Random(5)
    items = [(k, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(20))) for k in range(12)]
    filler = [" ".join("".join(rng.choices("rstuvw", k=5)) for _ in range(60)) for _ in range(20)]
    docs = [(k, f"{filler[k]} {edited(rng, items[k % 12][1], k % 6).upper()} {filler[-1 - k]}" if k % 3 else filler[k]) for k in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "id long, text string")
    whole = sorted(map(tuple, find_matches(df, bench).collect()))
    assert [(r[0], r[2]) for r in whole] == [(k, k % 12) for k in range(20) if k % 3]
    assert sorted(map(tuple, find_matches(df, bench, block_chars=200).collect())) == whole
    monkeypatch.setattr(decontaminate, "SEGMENT", 50)
    assert [(r[0], r[2], r[5]) for r in sorted(map(tuple, find_matches(df, bench).collect()))] == [(r[0], r[2], r[5]) for r in whole]


def test_query(spark):
    items = {r.item_id: normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {r.doc_id: normalised(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_decontaminate(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        exact = {i for i, t in items.items() if t in docs[r.doc_id]}
        assert exact <= set(r["items"]) and r.contaminated == bool(r["items"])
        for i in set(r["items"]) - exact:
            assert least_edits(items[i], docs[r.doc_id]) <= edit_budget(len(items[i]))


def test_normalised():
    assert normalised(" A--b\tC_d,É ") == "a b c d é" and normalised(None) == ""
    assert not re.search(r"\s\s", normalised(ITEM))


@pytest.mark.parametrize("text, item", [("a" * 20_000, "a" * 1000), ("ab" * 10_000, "ab" * 300), ("a" * 1_000_000, "a" * 1000),
                                        ("abc" * 100_000, "abc" * 100_000), ("- " * 9 + "a" * 400_000, "b" + "a" * 5000)])
def test_repetitive_text_and_item(text, item):
    """Work near the length: no product of the places of one q-gram."""
    import resource
    import time

    index, before = QGramIndex([(7, item)]), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.process_time()
    found = index.search(_codes(text))
    assert time.process_time() - began < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000
    assert [f[0] for f in found] == [0] and found[0][3] <= index.budget[0]


@pytest.mark.parametrize("often", [1, 3, 64])
def test_repeated_grams_do_not_hide_a_match(monkeypatch, often):
    """Against the full table, with most q-grams left out of the counting."""
    import random

    monkeypatch.setattr(decontaminate, "OFTEN", often)
    rng = random.Random(often)
    for _ in range(40):
        item = "".join(rng.choice(["ab", "aaa", "xyz ", "b"]) for _ in range(rng.randint(15, 60)))
        broken = list(item)
        for _ in range(rng.randint(0, 1 + len(item) // 15)):
            broken[rng.randrange(len(broken))] = rng.choice(["", "q", "ab"])
        text = "".join(rng.choice(["a", "b", "xyz ", "ab"]) for _ in range(80)) + "".join(broken) + "a" * rng.randint(0, 60)
        index = QGramIndex([(1, item)])
        found = index.search(_codes(text))
        assert bool(found) == (least_edits(item, text) <= index.budget[0]), (item, text)


def test_ids_of_other_types_are_refused(spark):
    docs, items = spark.createDataFrame([("a", "t")], "doc_id string, text string"), spark.createDataFrame([(1, "t")], "item_id int, text string")
    with pytest.raises(ValueError, match="doc_id is string"):
        contamination(docs, items)
    with pytest.raises(ValueError, match="item_id is string"):
        contamination(items.withColumnRenamed("item_id", "doc_id"), docs.withColumnRenamed("doc_id", "item_id"))
