import corpus_pipeline

from tablemover.llm.decontaminate import normalised

from .conftest import SF
from .test_line_dedup import brute as lines_left
from .test_minmax import brute as near_groups
from .test_quality import brute as counts_of


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    frames = [docs]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        frames.append(step(spark, frames[-1], SF).cache())
        if k < 4:
            assert frames[-1].columns == docs.columns
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames]
    for i, t in texts[0].items():
        n = counts_of(t)
        if n[0] < 50 or 2 * n[4] > n[0]:
            assert i not in texts[1]
        elif i in labels:
            assert (i in texts[1]) == bool(labels[i])
    assert texts[2] == dict(lines_left(list(texts[1].items())))
    roots = near_groups(texts[2], 5)[1]
    assert texts[3] == {i: t for i, t in texts[2].items() if roots[i] == i}
    leaked = {i for i, t in texts[3].items() if any(x in normalised(t) for x in items)}
    assert texts[4] == {i: t for i, t in texts[3].items() if i not in leaked}
    assert texts[5] == texts[4] and all(r.round_trip for r in frames[5].collect())
    assert all(r.n_chars == len(r.text) for r in frames[2].collect())
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, frames[5].collect()))


def test_nulls_and_empty_tables(spark, awkward):
    docs = awkward.selectExpr("doc_id", "text", "lang", "source", "CAST(NULL AS long) AS n_chars")
    for some in (docs, docs.where("false")):
        for _, step in corpus_pipeline.STAGES:
            some = step(spark, some, SF)
        assert some.count() <= 14
