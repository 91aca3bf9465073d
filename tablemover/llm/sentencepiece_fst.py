"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Text is normalised by plain string replacement (dummy prefix, blanks to the piece blank, optionally runs of
blanks to one); models with a precompiled character map are refused.  Two transducers, the pieces (an arc per
piece string, weighted by the model) and byte fallback (an arc per character without a piece, which writes its
UTF-8 bytes), are composed with each input, lazily, and the path of least weight in the tropical semiring (sum
along a path, least over paths) is the encoding.

* Unigram models: an arc weighs minus the piece's log probability.
* BPE models: scores are merge ranks, which do not add up along a path.  There the state after an arc is its
  piece, and an arc to the next piece has infinite weight when byte-pair merging would have joined across the
  border.  Merging leaves exactly one path of finite weight, the library's encoding.  Whether a border holds
  follows from the two pieces alone: each piece was merged up in rank order, so its symbol at the border, and
  the ranks between which it stood there, form a short list (its spine); the border breaks if two symbols
  that stood there together can merge at a lower rank than either is merged inwards.

Defined cases.  A null text has null pieces and decodes to null; an empty text has none and decodes to the
empty text.  A very long text is one row's work, word by word; a word without blanks is one path, however long.  An
empty table gives an empty table.  A text that contains the piece blank U+2581 itself decodes to a space there, as in any
SentencePiece model.  Equal texts have equal pieces.  New columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, packed, remembered, ship_by_value, slices

BLANK = "▁"
NEVER = float("inf")
# A state is position << LABEL_BITS | label; a label is a piece id, or CHARACTER + code point for byte fallback.
CHARACTER, LABEL_BITS = 1 << 20, 22
LABELS = (1 << LABEL_BITS) - 1
START = LABELS
# Piece kinds in a model file (fixed by its format).
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Encodings of words, and borders of pieces, that a worker remembers.  A full memory of words becomes the old one,
# whose words move up when they come again, and the old one before it goes; a full memory of borders is emptied.
REMEMBERED = 220_000
BORDERS = 400_000


def read_model(path: str) -> dict:
    """What the transducers need of a model file, as plain values."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, trainer = model.normalizer_spec, model.trainer_spec
    if spec.precompiled_charsmap:
        raise ValueError("only models with the identity normaliser are supported")
    if trainer.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return {"pieces": [(p.piece, p.score, p.type) for p in model.pieces], "kind": trainer.model_type,
            "dummy_prefix": spec.add_dummy_prefix, "squeeze": spec.remove_extra_whitespaces,
            "byte_fallback": trainer.byte_fallback}


class Transducer:
    def __init__(self, model: dict):
        pieces = model["pieces"]
        self.bpe, self.dummy_prefix, self.squeeze = model["kind"] == BPE, model["dummy_prefix"], model["squeeze"]
        self.rank = {p: -s for p, s, kind in pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == 2)
        self.byte_ids = [i for i, (_, _, kind) in enumerate(pieces) if kind == BYTE] if model["byte_fallback"] else []
        self.written = [bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind == 3 else
                        p.replace(BLANK, " ").encode() for p, _, kind in pieces]
        usable = [(i, p) for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)]
        self.longest = max(len(p) for _, p in usable)
        # Without a piece that has a blank after other characters, words can be composed one by one.
        self.by_word = not any(re.search(f"[^{BLANK}]{BLANK}", p) for _, p in usable)
        # So can lines, if no piece goes beyond a line break.
        self.by_line = (self.by_word and all(p == "\n" or "\n" not in p for _, p in usable)
                        and (bool(self.byte_ids) or any(p == "\n" for _, p in usable)))
        self.arcs, self.left, self.right = {}, {}, {}
        for i, p in usable:
            if self.bpe:
                spines = self._spines(p)
                if spines is None:  # merging never arrives at this piece
                    continue
                self.left[i], self.right[i] = spines
            self.arcs[p] = (i, 0.0 if self.bpe else self.rank[p])
        # Every prefix of a piece: its label, or -1 where it only leads on.
        self.trie = {p[:k]: -1 for p in self.arcs for k in range(1, len(p))}
        self.trie.update({p: i for p, (i, _) in self.arcs.items()})
        self.worst = max(w for _, w in self.arcs.values()) + 10.0
        self.borders: dict = {}
        self.n_borders = 0
        self.words: dict = {}
        self.old_words: dict = {}
        # The words met that do not decode to themselves.
        self.changed: set = set()
        self.most_changed = REMEMBERED

    def _spines(self, piece: str):
        """How the first and the last symbol of ``piece`` grow as it is merged up: (symbol, rank at which it
        was formed, rank at which it is merged inwards) each; None if merging ends in several symbols."""
        symbols = list(piece)
        first, last = [(symbols[0], -1.0)], [(symbols[-1], -1.0)]
        while len(symbols) > 1:
            merges = [(self.rank[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.rank]
            if not merges:
                return None
            rank, k = min(merges)
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
            if k == 0:
                first.append((symbols[0], rank))
            if k == len(symbols) - 1:
                last.append((symbols[-1], rank))
        def timed(grown):
            return [(s, r, grown[n + 1][1] if n + 1 < len(grown) else NEVER) for n, (s, r) in enumerate(grown)]
        return timed(first), timed(last)

    def _border_holds(self, p, q) -> bool:
        right = self.right.get(p) or [(chr(p - CHARACTER), -1.0, NEVER)]
        left = self.left.get(q) or [(chr(q - CHARACTER), -1.0, NEVER)]
        for a, formed_a, inwards_a in right:
            for b, formed_b, inwards_b in left:
                rank = self.rank.get(a + b)
                # Equal ranks merge from the left.
                if rank is not None and formed_a <= rank < inwards_a and formed_b < rank <= inwards_b:
                    return False
        return True

    def shortest_path(self, text: str) -> list:
        """Labels of the path of least weight through the composition with a normalised ``text``: piece ids,
        and CHARACTER + code point where byte fallback applies."""
        return self._first_path(text) if self.bpe else self._least_path(text)

    def _first_path(self, text: str) -> list:
        """All finite weights are zero, so the first path that arrives is a shortest one: depth-first, the
        longest arc first, each state (position, label) once, as one number."""
        n, longest, trie, borders = len(text), self.longest, self.trie, self.borders
        if self.n_borders > BORDERS:
            borders.clear()
            self.n_borders = 0
        came, stack, end = {}, [START], n << LABEL_BITS
        while stack:
            here = stack.pop()
            if here >= end:
                break
            i, before = here >> LABEL_BITS, here & LABELS
            known = borders.get(before)
            if known is None:
                known = borders[before] = {}
            for j in range(i + 1, min(n, i + longest) + 1):
                label = trie.get(text[i:j])
                if label is None or label < 0:
                    if j == i + 1:
                        label = CHARACTER + ord(text[i])
                    elif label is None:
                        break
                    else:
                        continue
                holds = known.get(label)
                if holds is None:
                    holds = known[label] = here == START or self._border_holds(before, label)
                    self.n_borders += 1
                state = j << LABEL_BITS | label
                if holds and state not in came:
                    came[state] = here
                    stack.append(state)
        path = []
        while here != START:
            path.append(here & LABELS)
            here = came[here]
        return path[::-1]

    def _least_path(self, text: str) -> list:
        n = len(text)
        ends = [None] * (n + 1)  # per position: (least weight, label of the arc that ends there, its start)
        ends[0] = (0.0, None, 0)
        for i in range(n):
            cost = ends[i][0]
            for j in range(i + 1, min(n, i + self.longest) + 1):
                arc = self.arcs.get(text[i:j]) or ((CHARACTER + ord(text[i]), self.worst) if j == i + 1 else None)
                if arc and (ends[j] is None or cost + arc[1] < ends[j][0]):
                    ends[j] = (cost + arc[1], arc[0], i)
        path, at = [], n
        while at:
            path.append(ends[at][1])
            at = ends[at][2]
        return path[::-1]

    def _word(self, word: str) -> bytes:
        """The ids of a normalised word as int32 bytes."""
        path = self.shortest_path(word) if word else []
        if path and max(path) >= CHARACTER:
            ids, before = [], 0
            for label in path:
                if label < CHARACTER:
                    ids.append(label)
                elif self.byte_ids:
                    ids += [self.byte_ids[b] for b in chr(label - CHARACTER).encode()]
                elif before < CHARACTER:  # characters without a piece in a row are one unknown
                    ids.append(self.unknown)
                before = label
            path = ids
        return array("i", path).tobytes()

    def _remembered(self, key: str, word: str) -> bytes:
        got = self.words.get(key)
        if got is None:
            if len(self.words) >= REMEMBERED:
                self.old_words, self.words = self.words, {}
            got = self.old_words.get(key)
            if got is None:
                got = self._word(word)
                back = b"".join(map(self.written.__getitem__, memoryview(got).cast("i")))
                if back != word.replace(BLANK, " ").encode():
                    self.changed.add(key)
            if len(key) <= 64:
                self.words[key] = got
        return got

    def _words(self, text: str) -> tuple[list[str], list[bytes]]:
        """(keys in the memory of words, their ids) of a text."""
        if self.by_word and self.dummy_prefix and "  " not in text and text[0] != " " and BLANK not in text:
            first, *lines = text.split("\n") if self.by_line else [text]
            keys = first.split(" ")  # the key is the word without its blank
            for line in lines:  # a line's first word has none: its key starts with the line break before it
                head, *rest = line.split(" ")
                keys.append("\n" + head)
                keys += rest
            parts = list(map(self.words.get, keys))
            if None in parts:
                parts = [got if got is not None else self._remembered(w, w if self.by_line and w[:1] == "\n" else BLANK + w)
                         for w, got in zip(keys, parts)]
            return keys, parts
        text = (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)
        cut = re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text) if self.by_word else [text]
        # Keys apart from those above.
        return (keys := [BLANK + w for w in cut]), [self._remembered(k, w) for k, w in zip(keys, cut)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_decode(text)[0]

    def encode_decode(self, text: str) -> tuple[np.ndarray, str]:
        """The ids of a text, and the text that they decode to: its words' decodings, known with their ids."""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return np.empty(0, np.int32), ""
        if len(self.changed) > self.most_changed:  # forgotten words are judged anew when they come again
            self.changed = {k for k in self.changed if k in self.words or k in self.old_words}
            self.most_changed = REMEMBERED + 2 * len(self.changed)
        keys, parts = self._words(text)
        ids = np.frombuffer(b"".join(parts), np.int32)
        if BLANK in text or not self.changed.isdisjoint(keys):
            return ids, self.decode(ids.tolist())
        return ids, text

    def decode(self, ids) -> str:
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.dummy_prefix else text


def _mapper(model, key: str, at: int, with_text: bool):
    def encode(batches):
        fst = remembered(key, lambda: Transducer(model.value))  # kept between tasks
        for batch in slices(batches, keep=key):
            texts = batch.column(0).field(at)
            ids, whole, same = [], [], []
            for t in texts.to_pylist():
                got, back = (None, None) if t is None else fst.encode_decode(t)
                ids.append(got)
                whole.append(back)
                same.append(None if t is None else back == t)
            n = pa.array([0 if x is None else len(x) for x in ids], pa.int64())
            flat = [x for x in ids if x is not None]
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32), pa.int32())
            ends = np.concatenate(([0], np.cumsum(n.to_numpy()))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([x is None for x in ids]))
            columns = [batch.column(0), n, lists, pa.array(same, pa.bool_())]
            names = ["row", "n_pieces", "pieces", "round_trip"]
            if with_text:
                columns.append(pa.array(whole, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)
    return encode


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", decoded: bool = True) -> DataFrame:
    """``docs`` with n_pieces (long), pieces (array<int>), round_trip (the decoded pieces equal the text) and,
    if asked for, the decoded text.  The compiled model goes to the workers once; its size is the model's."""
    import zlib

    spark = docs.sparkSession
    arrow_batches(spark)
    model = read_model(model_path)
    key = f"m{zlib.crc32(repr(model).encode())}"
    rows = packed(docs)
    new = ["n_pieces", "pieces", "round_trip"] + ["decoded"] * decoded
    schema = f"{rows.schema['row'].dataType.simpleString()}"
    schema = f"row {schema}, n_pieces bigint, pieces array<int>, round_trip boolean" + ", decoded string" * decoded
    out = rows.mapInArrow(_mapper(spark.sparkContext.broadcast(model), key, docs.columns.index(text), decoded), schema)
    keep = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    return out.select(*keep, *new)


ship_by_value(__name__)
