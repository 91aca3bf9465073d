import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablemover.llm.queries import SENTENCEPIECE_MODEL, op1_sentencepiece
from tablemover.llm.sentencepiece_fst import BPE, UNIGRAM, Transducer, encode_decode, read_model

from .conftest import SF


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def fst():
    return Transducer(read_model(SENTENCEPIECE_MODEL))


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from("  \t\n▁aeionrsthdlÀé.,世界😀<>0x")) | st.text())
def test_same_pieces_as_the_library(fst, library, text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = fst.encode(text).tolist()
    assert ids == library.encode(text)
    if "▁" not in text:
        assert fst.decode(ids) == text


def test_awkward(awkward, library):
    done = encode_decode(awkward, SENTENCEPIECE_MODEL)
    assert done.columns == [*awkward.columns, "n_pieces", "pieces", "round_trip", "decoded"]
    for r in done.collect():
        if r.text is None:
            assert (r.n_pieces, r.pieces, r.round_trip, r.decoded) == (0, None, None, None)
        else:
            assert r.pieces == library.encode(r.text) and r.n_pieces == len(r.pieces)
            assert r.round_trip and r.decoded == r.text


def test_columns_of_the_same_name_are_replaced(spark):
    df = spark.createDataFrame([("a b", "old")], "text string, pieces string")
    assert encode_decode(df, SENTENCEPIECE_MODEL, decoded=False).columns == ["text", "n_pieces", "pieces", "round_trip"]


def test_empty(nothing):
    assert encode_decode(nothing, SENTENCEPIECE_MODEL).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op1_sentencepiece(spark, SF).collect():
        assert r.pieces == library.encode(docs[r.doc_id]) and r.round_trip
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def model(pieces, kind):
    return {"pieces": [("<unk>", 0.0, 2), *pieces], "kind": kind, "dummy_prefix": False, "squeeze": False, "byte_fallback": False}


def cheapest(text, weights):
    """All segmentations, by brute force."""
    if not text:
        return 0.0, []
    found = []
    for k in range(1, len(text) + 1):
        if text[:k] in weights:
            cost, rest = cheapest(text[k:], weights)
            found.append((cost + weights[text[:k]], [text[:k], *rest]))
    return min(found)


@settings(max_examples=100, deadline=None)
@given(text=st.text("abc", min_size=1, max_size=9))
def test_unigram_path_is_the_cheapest(text):
    weights = {"a": 3.0, "b": 3.25, "c": 2.5, "ab": 4.125, "bc": 5.0, "abc": 6.5, "aa": 4.75, "cab": 5.0625}
    fst = Transducer(model([(p, -w, 1) for p, w in weights.items()], UNIGRAM))
    ids = fst.encode(text).tolist()
    assert fst.decode(ids) == text
    assert sum(weights[fst.decode([i])] for i in ids) == pytest.approx(cheapest(text, weights)[0])


@settings(max_examples=200, deadline=None)
@given(text=st.text("ab", min_size=1, max_size=14))
def test_bpe_path_is_the_merged_one(text):
    pieces = ["aa", "ab", "aaa", "ba", "bab", "abab", "aab", "a", "b"]
    rank = {p: k for k, p in enumerate(pieces)}
    symbols = list(text)
    while True:
        merges = [(rank[x + y], k) for k, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in rank]
        if not merges:
            break
        k = min(merges)[1]
        symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
    fst = Transducer(model([(p, -float(k), 1) for p, k in rank.items()], BPE))
    assert [fst.decode([i]) for i in fst.encode(text).tolist()] == symbols
