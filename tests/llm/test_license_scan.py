import random
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablemover.llm import license_scan
from tablemover.llm.license_scan import BASE_PHRASES, TEMPLATES, Template, labelled, license_spans, long_text
from tablemover.llm.queries import op12_license_scan

from .conftest import SF

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
MIT = next(t.text for t in TEMPLATES if t.label == "mit" and t.gap)
BSD = next(t.text for t in TEMPLATES if t.label == "bsd")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    """(number of words, number of places, first, last, labels) by looking at every place."""
    own = words(text)
    at = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(own))
                if own[i:i + len(phrase.split())] == phrase.split())
    return (len(own), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({label for _, label in at})))


def brute_spans(text, templates, k=3):
    """(template, start, stop, score) by dictionaries: the same law, one text at a time."""
    own, out = words(text), []
    for n, t in enumerate(templates):
        theirs, by_diagonal = words(t.text), defaultdict(set)
        places = defaultdict(list)
        for j in range(len(theirs) - k + 1):
            places[tuple(theirs[j:j + k])].append(j)
        for i in range(len(own) - k + 1):
            for j in places.get(tuple(own[i:i + k]), ()):
                by_diagonal[i - j].add(j)
        least = min(license_scan.LEAST_VOTES, len(theirs) - k + 1) if t.gap else len(theirs) - k + 1
        regions, before = [], None
        for d in sorted(x for x in by_diagonal if len(by_diagonal[x]) >= least):
            if before is None or d - before > t.gap:
                regions.append([])
            regions[-1].append(d)
            before = d
        for region in regions:
            of_template = {j + x for d in region for j in by_diagonal[d] for x in range(k)}
            of_span = {d + j + x for d in region for j in by_diagonal[d] for x in range(k)}
            start, stop = min(of_span), max(of_span) + 1
            score = min(len(of_template) / len(theirs), len(of_span) / (stop - start))
            if score >= t.least:
                out.append((n, start, stop, score))
    return sorted(out)


def answer(df):
    return {r.row.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in df.collect()}


def changed(text, seed, every):
    """The text with every so manieth word replaced, left out or doubled."""
    rng, out = random.Random(seed), []
    for k, w in enumerate(text.split()):
        if k % every == every - 1:
            out += rng.choice([["other"], [], [w, "thing"]])
        else:
            out.append(w)
    return " ".join(out)


TEXTS = ["Released UNDER the MIT-License. cc by nc", "under the mit\nlicense under the mit license", "cc by nc cc by nc by nc", "cc by\x00nc",
         "Apache License, Version 2.0", "apache license version 20", "under thé mit license", "ÀCC BY NC", "cc by nc sa", None, "", "...", "one two",
         MIT, "x y " * 50 + MIT + " and so on " + BSD, changed(MIT, 1, 20), changed(MIT, 2, 3), " ".join(MIT.split()[:40]), MIT + " " + MIT,
         "All rights reserved. GNU General Public License, version 3", "cc by nc " * 3000, "the software without " * 3000 + MIT]


def test_spans_against_dictionaries(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    by_digest = defaultdict(list)
    for r in license_spans(df).collect():
        by_digest[r.digest].append((r.template, r.start, r.stop, r.score))
    import hashlib

    for text in TEXTS:
        got = sorted(by_digest[hashlib.sha256((text or "").encode()).hexdigest()])
        assert [g[:3] for g in got] == [b[:3] for b in brute_spans(text, TEMPLATES)], text
        assert [g[3] for g in got] == pytest.approx([b[3] for b in brute_spans(text, TEMPLATES)])


def test_labels_of_texts(spark):
    got = answer(labelled(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")))
    assert {i: got[i][:5] for i in got} == {i: base(t) for i, t in enumerate(TEXTS)}
    assert got[13][5] == "mit" and got[13][6] == 1.0
    assert got[14][5] == "bsd,mit" and "mit" in got[15][5] and 0.8 <= got[15][6] < 1
    assert got[16][5] == got[17][5] == "" and got[16][6] == 0
    assert got[8][5] == "cc-by-nc,cc-by-nc-sa" and got[19][5] == "all-rights-reserved,gpl-3"
    assert "mit" in got[21][5]


def test_awkward_documents(spark, awkward):
    rows = awkward.collect()
    got = labelled(awkward).collect()
    assert sorted(map(str, (r.row for r in got))) == sorted(map(str, rows))
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(r.row.text)


def test_empty_table(spark, nothing):
    assert labelled(nothing).collect() == [] and license_spans(nothing).collect() == []


def test_a_template_shorter_than_a_gram_is_refused(spark, nothing):
    with pytest.raises(ValueError, match="no gram"):
        labelled(nothing, templates=[Template("x", "two words")])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("a b c d e f".split()), max_size=60), min_size=1, max_size=6), st.integers(3, 4))
def test_few_words_that_repeat(spark, texts, k):
    """A small alphabet makes every diagonal likely; both a phrase and a long template."""
    templates = [Template("p", "a b a b c"), long_text("l", "a b c d e f a c e b d f a a b b c c d d e e f f")]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.digest, r.template, r.start, r.stop) for r in license_spans(df, templates=templates, k=k).collect())
    import hashlib

    want = {(hashlib.sha256(t.encode()).hexdigest(), *s[:3]) for t in (" ".join(t) for t in texts) for s in brute_spans(t, templates, k)}
    assert got == sorted(want)


def test_templates_joined_by_a_shuffle(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = answer(labelled(df))
    monkeypatch.setattr(license_scan, "MOST_WORDS", 0)
    monkeypatch.setattr(license_scan, "TEMPLATES", TEMPLATES)
    assert answer(labelled(df)) == want


def test_no_python_in_the_plan(spark, awkward):
    plan = labelled(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_against_every_place(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_license_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, spans = got[d.doc_id], brute_spans(d.text, TEMPLATES)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(d.text)
        assert r.labels == ",".join(sorted({TEMPLATES[s[0]].label for s in spans}))
        assert r.score == pytest.approx(max((s[3] for s in spans), default=0))
    assert any(r.n_base for r in got.values()) and any(set(r.labels.split(",")) - set(r.base_labels.split(",")) - {""} for r in got.values())
    assert [t.label for t in BASE_PHRASES] == list(PHRASES.values())
