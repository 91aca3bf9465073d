import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tablemover.llm import quality
from tablemover.llm.quality import COUNTS, judge, keep_good, text_counts
from tablemover.llm.queries import op7_quality_rules

from .conftest import SF


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = (text or "").split("\n")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    n = Counter(windows)
    repeated = {k + d for k, w in enumerate(windows) if n[w] > 1 for d in range(3)}
    again = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:k])
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(repeated), len(lines))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \t\n\x0b\x1c\x85 #é")))
def test_counts(text):
    assert text_counts(text) == brute(text)


def test_awkward(awkward, nothing):
    rows = judge(awkward).collect()
    assert len(rows) == 14
    for r in rows:
        assert tuple(r.counts[c] for c in COUNTS) == brute(r.row.text)
        assert r.base_failed == (r.counts.n_words < 50 or 2 * r.counts.n_repeat_words > r.counts.n_words)
        assert not (r.base_failed and r.kept)
    assert keep_good(awkward).columns == awkward.columns
    assert judge(nothing).count() == 0


def test_thresholds_follow_the_group(spark):
    """Sources differ in what is usual: the same share of symbols passes in one and fails in another."""
    def text(k, symbols):
        return " ".join(f"w{k}x{j}" + ("#" if j < symbols else "") for j in range(100))
    rows = [(k, text(k, 0), "en", "plain") for k in range(400)]
    rows += [(1000 + k, text(k, 30 + k % 30), "en", "code") for k in range(400)]
    rows += [(2000, text(7, 45), "en", "plain"), (2001, text(8, 45), "en", "code"), (2002, text(9, 45), "en", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.row.doc_id: r.kept for r in judge(docs).collect()}
    assert not kept[2000] and kept[2001]
    assert all(kept[k] for k in range(400)) and sum(kept[1000 + k] for k in range(400)) > 390


def test_no_limit_is_fixed(spark):
    """A share of symbols below 0.04 is junk among long texts without any, and a small source of mostly junk is
    judged against its language."""
    def text(k, symbols, n=400):
        return " ".join(f"w{k + 1000}x{j}" + ("#" if j < symbols else "") for j in range(n))
    rows = [(k, text(k, 0), "en", "plain") for k in range(1000)] + [(1000, text(1000, 60), "en", "plain")]
    rows += [(2000 + k, text(k, 40 + k if k < 40 else 0, 100), "en", "junk") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = judge(docs).collect()
    kept = {r.row.doc_id: r.kept for r in got}
    assert max(r.counts.n_symbols / r.counts.word_chars for r in got if r.row.doc_id == 1000) < 0.04
    assert not kept[1000] and all(kept[k] for k in range(1000))
    assert [kept[2000 + k] for k in range(60)] == [False] * 40 + [True] * 20


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op7_quality_rules(spark, SF).collect()
    for r in rows:
        want = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[:5]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        if not r.base_failed and r.doc_id in labels:
            assert r.kept == bool(labels[r.doc_id])
    assert len(rows) == len(docs)


def exact_verdicts(docs, min_group=quality.MIN_GROUP):
    """doc id -> kept, with quantiles of sorted lists in place of sketches."""
    import math
    from collections import defaultdict

    def signals(c):
        n_words, word_chars, n_symbols, n_dup, n_repeat, n_lines = c
        return {"symbol_share": n_symbols / word_chars, "line_share": n_dup / n_lines, "repeat_share": n_repeat / n_words,
                "word_length": word_chars / n_words}

    counts = {d.doc_id: quality.text_counts(d.text or "") for d in docs}
    good = {d.doc_id: d for d in docs if counts[d.doc_id][0] >= 50 and counts[d.doc_id][4] <= 0.5 * counts[d.doc_id][0]}
    seen = {i: signals(counts[i]) for i in good}

    def grid(values):
        values = sorted(values)
        return [values[max(math.ceil((k + 0.5) / quality.GRID * len(values)) - 1, 0)] for k in range(quality.GRID)]

    groups = defaultdict(list)
    for i, d in good.items():
        for key in ((d.lang, d.source), d.lang, None):
            groups[key].append(i)
    sizes = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"), range(6)))
    out = {d.doc_id: False for d in docs}
    for i, d in good.items():
        own, wide = groups[d.lang, d.source], groups[d.lang]
        share, fits = len(wide) / (len(wide) + min_group), True
        for s, size in quality.SIGNALS.items():
            weighed = sorted((v, w / quality.GRID) for ids, w in ((own, len(own)), (wide, min_group * share), (groups[None], min_group * (1 - share)))
                             for v in grid([seen[j][s] for j in ids]))
            total, at = sum(w for _, w in weighed), {}
            for name, q in quality.QUARTILES.items():
                below = 0.0
                for v, w in weighed:
                    below += w
                    if below >= q * total - 1e-9:
                        at[name] = v
                        break
            n = counts[i][sizes[size]]
            chance = math.sqrt((at["mid"] + 1 / n) / n)
            fits &= (at["low"] - quality.SPREADS * max(at["mid"] - at["low"], chance) <= seen[i][s]
                     <= at["high"] + quality.SPREADS * max(at["high"] - at["mid"], chance))
        out[i] = fits
    return out


def test_kept_against_exact_quantiles(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = exact_verdicts(docs.collect())
    got = {r.row.doc_id: r.kept for r in quality.judge(docs).select("row", "kept").collect()}
    assert got == want and 0 < sum(want.values()) < len(want)
