import zlib

import numpy as np
from tablemover.llm.queries import op2_toxicity
from tablemover.llm.toxicity import features_of, fit_nnpu, scored, telling, train

from .conftest import SF


def sample(n=400, share=0.1, seed=1):
    """Texts of plain words; toxic ones hold one of three marks."""
    rng, plain = np.random.default_rng(seed), [f"plain{k}" for k in range(300)]
    out = []
    for k in range(n):
        words = list(rng.choice(plain, 30))
        toxic = rng.random() < share
        if toxic:
            words[3] = f"nasty{rng.integers(3)}"
        out.append((k, " ".join(words), int(toxic)))
    return out


def test_learns_from_positives_and_unlabelled(spark):
    """Half of the toxic texts are not marked as such."""
    rows = sample(3000)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y * (k % 2)) for k, _, y in rows], "doc_id long, toxic int")
    models = train(docs, labels)
    held = sample(800, seed=2)
    got = scored(spark.createDataFrame(held, "doc_id long, text string, y int"), models).collect()
    cut = 0.5 * (min(r.score for r in got) + max(r.score for r in got))
    assert np.mean([(r.score >= cut) == bool(r.y) for r in got]) > 0.99


def test_unlabelled_texts_come_from_all_documents(spark):
    """A harmless word is in all toxic texts and in no clean text with a label, so only documents without a label
    show that it is harmless."""
    rows = [(k, f"filler{k % 7}" + (" nasty harmless" if k % 10 == 0 else " harmless" * (k % 2))) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(0, 1000, 2)] + [(k, 0) for k in range(1002, 2000, 2) if k % 10]
                                   , "doc_id long, toxic int")
    models = train(docs, labels)
    probe = spark.createDataFrame([(0, "filler1 harmless"), (1, "filler1 nasty harmless")], "doc_id long, text string")
    plain, nasty = (r.score for r in scored(probe, models).orderBy("doc_id").collect())
    assert plain < 0.1 and nasty > 0.7


def test_risk_stays_bounded_when_overfit():
    rng = np.random.default_rng(3)
    w = fit_nnpu(rng.integers(0, 2, (5, 40)).astype(np.float32), rng.integers(0, 2, (50, 40)).astype(np.float32), 0.2)
    assert np.isfinite(w).all() and abs(w).max() < 100


def test_no_chance_features(spark):
    rng = np.random.default_rng(0)
    rows = [(k < 200, sorted({f"c{x}" for x in rng.integers(0, 50, 10)} | ({"mark"} if k < 60 else set()))) for k in range(400)]
    got = telling(spark.createDataFrame(rows, "positive boolean, found array<string>"), 200, 200).collect()
    assert [r.feature for r in got] == ["mark"]


def test_beginnings():
    assert features_of("Worthless, no!") == {"worthless", "no", "wor-", "wort-", "worth-"} and features_of(None) == set()


def test_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (99, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    models = train(awkward, labels)
    rows = scored(awkward, models).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert scored(nothing, models).count() == 0
    assert train(nothing, labels) == [] and train(awkward, labels.where("false")) == []
    assert {r.score for r in scored(awkward, []).collect()} == {0.0}


def test_query_never_learns_from_held_out(spark):
    rows = op2_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op2_toxicity(spark, sf).where("held_out").collect() if r.doc_id in labels]
    caught = [r.predicted for r in rows if labels[r.doc_id] == 1]
    clean = [r.predicted for r in rows if labels[r.doc_id] == 0]
    assert np.mean(caught) > 0.7 and np.mean(clean) < 0.01
    good, bad = (np.mean([r.score for r in rows if labels[r.doc_id] == y]) for y in (0, 1))
    assert bad > good + 0.4


def test_fit_against_a_plain_minimiser():
    """The risk of the fitted weights is near the least over a grid, by plain arithmetic on one feature."""
    import math

    import numpy as np

    from tablemover.llm.toxicity import fit_nnpu

    prior, pos, unl = 0.3, [1] * 45 + [0] * 5, [1] * 70 + [0] * 130

    def risk(w, b):
        s = {x: 1 / (1 + math.exp(-(w * x + b))) for x in (0, 1)}
        mean = lambda rows, f: sum(f(s[x]) for x in rows) / len(rows)
        negative = mean(unl, lambda v: v * v) - prior * mean(pos, lambda v: v * v)
        return prior * mean(pos, lambda v: (1 - v) ** 2) + max(negative, 0)

    least = min(risk(w / 4, b / 4) for w in range(-40, 41) for b in range(-40, 41))
    w, b = (float(v) for v in fit_nnpu(np.array([[x] for x in pos], np.float32), np.array([[x] for x in unl], np.float32), prior))
    assert risk(w, b) <= least + 0.005
