import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablemover.llm import tokenizer_alignment
from tablemover.llm.queries import BYTE_BPE_MODEL, SENTENCEPIECE_MODEL, TOKENIZERS, op11_tokenizer_alignment
from tablemover.llm.tokenizer_alignment import Aligner, ByteBPE, Pieces, align, lanes, linked_counts, lockstep, read_models

from .conftest import SF

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def aligner():
    a, b = read_models(BYTE_BPE_MODEL, SENTENCEPIECE_MODEL)
    return Aligner(ByteBPE(a), Pieces(b))


def unicode_bytes():
    """The usual table of byte-level vocabularies, from the tokenizer's own pre-tokenizer."""
    own = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out, n = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            out[chr(256 + n)] = b
            n += 1
    return out


def brute_tokens(text, libraries):
    a, b = libraries
    if not text:
        return [], []
    table = unicode_bytes()
    ours = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    theirs = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
              for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    same = b"".join(w for _, w in ours) == b"".join(w for _, w in theirs) == whole
    return (ours, theirs) if same else ([], [])


def ranges(tokens):
    at, out = 0, []
    for _, w in tokens:
        out.append((at, at + len(w)))
        at += len(w)
    return out


def brute(text, libraries):
    """(ids of A, ids of B, links by comparing all ranges nearby, cuts)."""
    ours, theirs = brute_tokens(text, libraries)
    ra, rb = ranges(ours), ranges(theirs)
    links, low = [], 0
    for x, (s, e) in enumerate(ra):
        while low < len(rb) and rb[low][1] <= s:
            low += 1
        y = low
        while y < len(rb) and rb[y][0] < e:
            links.append((x, y))
            y += 1
    ends_b = {e: y + 1 for y, (_, e) in enumerate(rb)}
    cuts = [(x + 1, ends_b[e]) for x, (_, e) in enumerate(ra) if e in ends_b]
    return [i for i, _ in ours], [i for i, _ in theirs], links, cuts


def digest(a, b, cuts):
    if not a:
        return ""
    before, parts = (0, 0), []
    for x, y in cuts:
        parts.append(",".join(map(str, a[before[0]:x])) + "|" + ",".join(map(str, b[before[1]:y])))
        before = (x, y)
    return hashlib.sha256(";".join(parts).encode()).hexdigest()


def brute_corpus(texts, libraries):
    """FIGURES of every text, by plain counting over all links."""
    done = [brute(t, libraries) for t in texts]
    count = Counter((a[x], b[y]) for a, b, links, _ in done for x, y in links)
    highest = defaultdict(int)
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    out = []
    for a, b, links, cuts in done:
        pairs = [(a[x], b[y]) for x, y in links]
        out.append((len(a), len(b), len(cuts), len(links), sum(count[p] == highest[p[1]] for p in pairs), sum(count[p] for p in pairs),
                    digest(a, b, cuts)))
    return out


TEXTS = ["hello world", " leading", "two  blanks", "tab\tand\nline\r\n", "naïve ÀÉ 世界 😀 ﬁ①", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "", None, " ", "   ",
         "x" * 3000, "ab" * 2000, "don't we'll I'M", "é ​﻿ \x00 \x01", "  　", "The the THE the the", "é" * 500, "12345 6789",
         "\u0085x y", "🇩🇪👩‍👩‍👧"]


def test_a_runs_the_same_merges_on_both_libraries(libraries, aligner):
    """Every code point in several contexts: the classes by which the texts are cut are the same."""
    a = libraries[0]
    assert aligner.a.fast is not None
    for low in range(0, 0x110000, 0x4000):
        chars = [chr(c) for c in range(low, low + 0x4000) if not 0xD800 <= c <= 0xDFFF]
        for context in ("a{}b", "!{}?", " {} {}"):
            texts = [" " + context.format(*[c] * context.count("{}")) for c in chars]
            for t, e in zip(texts, a.encode_batch_fast(texts, add_special_tokens=False)):
                assert e.ids == aligner.a.encode(t).tolist(), ascii(t)


def test_a_model_of_another_kind_uses_its_own_library():
    with open(BYTE_BPE_MODEL, encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = {"type": "Lowercase"}
    a = ByteBPE(json.dumps(spec))
    assert a.fast is None and a.encode(" Hello").tolist() == a.encode(" hello").tolist()


@pytest.mark.parametrize("text", TEXTS)
def test_one_text(libraries, aligner, text):
    a, b, links, cuts = brute(text, libraries)
    m = aligner.merge([text])
    assert m.a.tolist() == a and m.b.tolist() == b
    assert list(zip(m.link_a.tolist(), m.link_b.tolist())) == links
    assert [(x + 1, y + 1) for x, y in zip(m.link_a[m.cut].tolist(), m.link_b[m.cut].tolist())] == cuts
    out, ends, groups = aligner.written_groups(m)
    assert groups.tolist() == [len(cuts)] and (hashlib.sha256(out[:-1]).hexdigest() if a else "") == digest(a, b, cuts)


def test_vocabulary_order_agrees_with_the_rank_file(aligner):
    import base64

    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(w): int(r) for w, r in map(bytes.split, f)}
    assert all(aligner.a.written[r] == w for w, r in ranks.items())
    assert isinstance(aligner.a.fast, tiktoken.Encoding)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), max_size=30), st.integers(0, 10 ** 6)), max_size=6), st.integers(1, 8))
def test_lockstep_and_lanes(docs, every):
    """Any two ways to cut the same bytes, whatever the lanes; tokens of no bytes do not occur."""
    a_end, b_end, a_from, b_from, want, base = [], [], [0], [0], [], 0
    for sizes, seed in docs:
        total, rng, theirs = sum(sizes), random.Random(seed), []
        while sum(theirs) < total:
            theirs.append(min(rng.randint(1, 5), total - sum(theirs)))
        x0, y0 = len(a_end), len(b_end)
        ra, rb = ([(sum(s[:k]), sum(s[:k + 1])) for k in range(len(s))] for s in (sizes, theirs))
        want += [(x0 + x, y0 + y, e == g) for x, (s, e) in enumerate(ra) for y, (f, g) in enumerate(rb) if s < g and f < e]
        a_end += [base + e for _, e in ra]
        b_end += [base + e for _, e in rb]
        base += total
        a_from.append(len(a_end))
        b_from.append(len(b_end))
    arrays = [np.array(v, np.int64) for v in (a_end, b_end, a_from, b_from)]
    default = lanes.__defaults__
    lanes.__defaults__ = (every,)
    try:
        m = lockstep(arrays[0].astype(np.int32), arrays[1].astype(np.int32), *arrays)
    finally:
        lanes.__defaults__ = default
    assert list(zip(m.link_a.tolist(), m.link_b.tolist(), m.cut.tolist())) == want


def figures(df):
    return sorted(((r.row.doc_id, *[r[f] for f in FIGURES]) for r in df.collect()), key=str)


def test_awkward_documents(spark, awkward, libraries):
    rows = awkward.collect()
    want = brute_corpus([r.text for r in rows], libraries)
    got = linked_counts(awkward, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL)
    assert figures(got) == sorted(((r.doc_id, *w) for r, w in zip(rows, want)), key=str)
    assert sorted(map(str, (r.row for r in got.collect()))) == sorted(map(str, rows))


def test_tokens_links_and_cuts(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "links long, text string")  # a clashing name
    for r in align(df, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL).collect():
        a, b, links, cuts = brute(r.row.text, libraries)
        assert (r.a_ids, r.b_ids, [tuple(x) for x in r.links], [tuple(x) for x in r.cuts]) == (a, b, links, cuts)


def test_empty_table(spark, nothing):
    assert linked_counts(nothing, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL).collect() == []
    assert align(nothing, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL).collect() == []


def test_result_does_not_depend_on_blocks(spark, monkeypatch, libraries):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "of", "naïve", "re-entry", "tokens,", "world"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(((i, *w) for i, w in enumerate(brute_corpus(texts, libraries))), key=str)
    for size in (1, 700, 10 ** 6):
        monkeypatch.setattr(tokenizer_alignment, "BLOCK_BYTES", size)
        assert figures(linked_counts(df.repartition(3), BYTE_BPE_MODEL, SENTENCEPIECE_MODEL, carry=["doc_id"])) == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40).filter(lambda t: not any(0xD800 <= ord(c) <= 0xDFFF for c in t)), min_size=1, max_size=8))
def test_any_texts(spark, libraries, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(((i, *w) for i, w in enumerate(brute_corpus(texts, libraries))), key=str)
    assert figures(linked_counts(df, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL)) == want


def test_query_against_all_links(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: w for d, w in zip(docs, brute_corpus([d.text for d in docs], libraries))}
    got = {r.doc_id: tuple(r[f] for f in FIGURES) for r in op11_tokenizer_alignment(spark, SF).collect()}
    assert got == want and sum(w[0] > 0 for w in want.values()) > 100
