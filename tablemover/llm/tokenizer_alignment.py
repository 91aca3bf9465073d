"""Alignment of two tokenizers' tokens by lockstep merging.

A document's tokens under tokenizer A (byte-level BPE) and B (SentencePiece pieces) are two ways to cut the same
bytes.  A token of A and one of B are linked if their byte ranges overlap, and a place where tokens of both end
is a cut; the cuts part the tokens into groups.

A worker gathers documents into blocks of about ``BLOCK_BYTES`` of text.  One NumPy state vector holds the
pointers into A and B of all documents of a block: every step emits a link for each lane, and a cut where both
tokens end, moves the pointer whose token ends first (both at a cut), and drops the lanes that have finished.
A long document takes several lanes, parted at ends that both tokenizers share, so that a block's steps do not
follow its longest text.

``align`` returns the tokens, links and cuts.  ``linked_counts`` weighs links by how often their pair of ids is
linked in the whole corpus.  For that a block leaves its distinct pairs with their numbers, and its documents
entries (number of the pair within the block, times).  The pairs are summed up by Spark, joined back to the
blocks that have them, and meet their documents by block, so what moves is a block's distinct pairs and not the
corpus's links, and no task holds more than one block and its pairs.

Defined cases.  A null or empty text, or one whose tokens of A or B do not spell a blank and the text, has no
tokens: no links, no groups, a null-free row of zeros and an empty digest.  Special tokens' strings are plain
text.  Repeated rows count each.  Pairs that tie for a B id's highest count are all best.  A very long text is a
block of its own.  An empty table gives an empty result.  Other columns come back packed in ``row``, whatever
their names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workspace import new_run_dir, stage
from .common import arrow_batches, field, packed, release, remembered, ship_by_value

# Text of a block, and tokens of A between the places where a long document may be parted into lanes.
BLOCK_BYTES = 4_000_000
LANE = 512
ROWS = 256
# Fixed value: the published pattern by which byte-level BPE cuts a text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the
    others in order for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """Tokenizer A of a ``tokenizers`` JSON file.  Where ids follow the order of the merges and the file asks for
    nothing but byte-level BPE, ``tiktoken`` runs the same merges several times faster."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, alphabet = spec["model"], byte_alphabet()
        names = dict(model["vocab"]) | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        self.written = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.written[i] = name.encode() if name in added else bytes(alphabet[c] for c in name)
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        before = spec.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before.get("add_prefix_space") and not any(model.get(k) for k in (
                     "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
                 and merged == sorted(set(merged)))
        self.fast = self.slow = None
        if plain and not {i for n, i in model["vocab"].items() if len(n) > 1 and n not in added} - set(merged):
            import tiktoken

            ranks = {self.written[i]: i for n, i in model["vocab"].items() if n not in added}
            self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(source)
            self.slow.encode_special_tokens = True

    def encode(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int32)


class Pieces:
    """Tokenizer B of a SentencePiece model file, which puts a blank before the text by itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.written = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int32)


@dataclass
class Block:
    """The tokens of several documents one after the other, their byte ends, and what the merging found.
    ``a_from[d]`` and ``b_from[d]`` are document d's first tokens; links and cuts are in order."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut: np.ndarray  # by link: both tokens end here


def lanes(a_end, b_end, a_from, b_from, every: int = LANE):
    """(first a, first b, end of a) of each lane: the documents, parted after every so manieth token of A if a
    token of B ends there too."""
    tries = np.arange(every - 1, len(a_end), every)
    at = np.minimum(np.searchsorted(b_end, a_end[tries]), max(len(b_end) - 1, 0))
    shared = tries[b_end[at] == a_end[tries]] + 1 if len(b_end) else tries[:0]
    stops = np.union1d(a_from[1:], shared)
    stops = stops[stops > 0]
    b_stops = np.searchsorted(b_end, a_end[stops - 1]) + 1
    return np.concatenate(([0], stops[:-1])), np.concatenate(([0], b_stops[:-1])), stops


def lockstep(a, b, a_end, b_end, a_from, b_from) -> Block:
    """Merge all documents at once.  Link (x, y) goes to place x + y: every step raises x + y, so no two meet."""
    n = len(a) + len(b)
    to_a, to_b = np.empty(n, np.int32), np.empty(n, np.int32)
    linked, cut = np.zeros(n, bool), np.zeros(n, bool)
    x, y, stop = lanes(a_end, b_end, a_from, b_from) if len(a) else (np.empty(0, np.int64),) * 3
    while len(x):
        place, p, q = x + y, a_end[x], b_end[y]
        a_ends, b_ends = p <= q, q <= p
        to_a[place], to_b[place], linked[place], cut[place] = x, y, True, a_ends & b_ends
        x, y = x + a_ends, y + b_ends
        live = x < stop
        if not live.all():
            x, y, stop = x[live], y[live], stop[live]
    return Block(a, b, a_end, b_end, a_from, b_from, to_a[linked], to_b[linked], cut[linked])


class Aligner:
    def __init__(self, a: ByteBPE, b: Pieces):
        self.a, self.b = a, b
        self.a_bytes, self.b_bytes = (np.array([len(w) for w in t.written], np.int64) for t in (a, b))
        digits = [str(i).encode() for i in range(max(len(a.written), len(b.written)))]
        self.n_digits = np.array([len(d) for d in digits], np.int64)
        self.digits = np.array([list(d.ljust(len(digits[-1]))) for d in digits], np.uint8)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if text:
            a, b, whole = self.a.encode(" " + text), self.b.encode(text), (" " + text).encode()
            if all(b"".join(map(t.written.__getitem__, ids.tolist())) == whole for t, ids in ((self.a, a), (self.b, b))):
                return a, b
        return np.empty(0, np.int32), np.empty(0, np.int32)

    def merge(self, texts) -> Block:
        pairs = [self.tokens(t) for t in texts]
        a, b = (np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int32) for k in (0, 1))
        a_from, b_from = (np.concatenate(([0], np.cumsum([len(p[k]) for p in pairs]))).astype(np.int64) for k in (0, 1))
        # Byte ends run on through the block, so a document's are beyond those of the one before.
        return lockstep(a, b, np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b]), a_from, b_from)

    def written_groups(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, ends, groups per document): ``a1,a2|b1;a3|b2`` of every document, each closed by one more ';'."""
        # Groups end with the last link's tokens; a group's tokens of A come before those of B.
        a_stop, b_stop = block.link_a[block.cut].astype(np.int64) + 1, block.link_b[block.cut].astype(np.int64) + 1
        a_group = np.searchsorted(a_stop, np.arange(len(block.a)), "right")
        b_group = np.searchsorted(b_stop, np.arange(len(block.b)), "right")
        b_start = np.concatenate(([0], b_stop[:-1])) if len(b_stop) else b_stop
        place_a, place_b = np.arange(len(block.a)) + b_start[a_group], np.arange(len(block.b)) + a_stop[b_group]
        ids = np.empty(len(block.a) + len(block.b), np.int32)
        ids[place_a], ids[place_b] = block.a, block.b
        after = np.full(len(ids), ord(","), np.uint8)
        after[place_a[a_stop - 1]], after[place_b[b_stop - 1]] = ord("|"), ord(";")
        n = self.n_digits[ids]
        ends = np.cumsum(n + 1)
        starts, out = ends - n - 1, np.empty(ends[-1] if len(ends) else 0, np.uint8)
        for k in range(self.digits.shape[1]):
            there = np.flatnonzero(n > k)
            out[starts[there] + k] = self.digits[ids[there], k]
        out[ends - 1] = after
        last = block.a_from[1:] + block.b_from[1:]  # tokens up to each document's end
        groups = np.diff(np.searchsorted(a_stop, block.a_from, "right"))
        return out, np.concatenate(([0], ends))[last], groups


def read_models(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        return f.read(), g.read()


def _aligner(models, key: str) -> Aligner:
    """The worker's aligner for these models, kept between tasks."""
    return remembered(key, lambda: Aligner(ByteBPE(models.value[0]), Pieces(models.value[1])))


def _blocks(batches, at: int):
    """(rows, texts) of about BLOCK_BYTES of text."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.column(0).slice(start, ROWS)
            own = part.field(at).to_pylist()
            first = 0
            for k, t in enumerate(own):
                size += len(t) if t else 0
                if size >= BLOCK_BYTES:
                    yield [*rows, part.slice(first, k + 1 - first)], texts + own[first:k + 1]
                    rows, texts, size, first = [], [], 0, k + 1
            if first < len(own):
                rows.append(part.slice(first))
                texts += own[first:]
    if texts:
        yield rows, texts


def _lists(values, ends, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values, kind))


def _pairs_of(x, y, ends) -> pa.ListArray:
    struct = pa.StructArray.from_arrays([pa.array(x, pa.int32()), pa.array(y, pa.int32())], ["a", "b"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), struct)


def _kept_rows(rows, names, keep) -> pa.StructArray:
    whole = pa.concat_arrays(rows)
    return pa.StructArray.from_arrays([whole.field(names.index(c)) for c in keep], list(keep)) if keep else pa.array(
        [{}] * len(whole), pa.struct([]))


def _broadcast_models(spark: SparkSession, a_path: str, b_path: str):
    a, b = read_models(a_path, b_path)
    return spark.sparkContext.broadcast((a, b)), f"m{zlib.crc32(a.encode())}_{zlib.crc32(b)}"


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(row, a_ids, b_ids, links, cuts): a link is a pair of token positions (a, b) in the document, a cut the
    numbers of tokens (a, b) before it."""
    rows = packed(docs)
    names, at = docs.columns, docs.columns.index(text)
    models, key = _broadcast_models(docs.sparkSession, a_path, b_path)

    def run(batches):
        aligner = _aligner(models, key)
        for own, texts in _blocks(batches, at):
            m = aligner.merge(texts)
            doc = np.searchsorted(m.a_from, m.link_a, "right") - 1
            x, y = m.link_a - m.a_from[doc], m.link_b - m.b_from[doc]
            ends = np.searchsorted(m.link_a, m.a_from[1:])
            cuts = np.concatenate(([0], np.cumsum(m.cut)))
            yield pa.RecordBatch.from_arrays(
                [_kept_rows(own, names, names), _lists(m.a, m.a_from[1:], pa.int32()), _lists(m.b, m.b_from[1:], pa.int32()),
                 _pairs_of(x, y, ends), _pairs_of(x[m.cut] + 1, y[m.cut] + 1, cuts[ends])],
                ["row", "a_ids", "b_ids", "links", "cuts"])
            release()

    pair = "array<struct<a:int,b:int>>"
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, a_ids array<int>, b_ids array<int>, links {pair}, cuts {pair}")


def _merged(docs: DataFrame, models, key: str, text: str, keep) -> DataFrame:
    """A row for each document, with its entries, and one for each block, with its pairs (``pair``, ``n``)."""
    rows = packed(docs)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        aligner = _aligner(models, key)
        for own, texts in _blocks(batches, at):
            m = aligner.merge(texts)
            n_docs, block = len(texts), uuid.uuid4().hex
            out, ends, groups = aligner.written_groups(m)
            starts = np.concatenate(([0], ends[:-1]))
            digests = [hashlib.sha256(out[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(starts, ends)]
            code = m.a[m.link_a].astype(np.int64) * len(aligner.b.written) + m.b[m.link_b]
            pairs, which, n = np.unique(code, return_inverse=True, return_counts=True)
            doc = np.searchsorted(m.a_from, m.link_a, "right") - 1
            entries, times = np.unique(doc * max(len(pairs), 1) + which, return_counts=True)
            entry_doc, entry = np.divmod(entries, max(len(pairs), 1))
            stops = np.searchsorted(entry_doc, np.arange(n_docs), "right")
            links = np.bincount(doc, minlength=n_docs)
            kept = _kept_rows(own, names, keep)
            none = [pa.nulls(n_docs, pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array([block] * n_docs), pa.array(np.diff(m.a_from)), pa.array(np.diff(m.b_from)), pa.array(groups, pa.int64()),
                 pa.array(links, pa.int64()), pa.array(digests, pa.string()), _lists(entry, stops, pa.int32()), _lists(times, stops, pa.int32()), *none],
                NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kept.type), pa.array([block]), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.nulls(1, pa.list_(pa.int32()))] * 2,
                 pa.array([pairs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64()))], NAMES)
            release()

    kept = rows.select(F.struct(*[field("row", c).alias(c) for c in keep]).alias("row")).schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kept}, block string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "entry array<int>, times array<int>, pair array<long>, n array<long>")


NAMES = ["row", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "entry", "times", "pair", "n"]
FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _weighed(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with the counts of their pairs."""
    place = pairs.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
    entry, times = (documents.column(c).combine_chunks() for c in ("entry", "times"))
    at, n = entry.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(entry.value_lengths().to_numpy())

    def summed(values):
        total = np.concatenate(([0], np.cumsum(values)))
        return pa.array(np.diff(np.concatenate(([0], total[ends]))), pa.int64())

    out = documents.select(["row", *FIGURES])
    return out.append_column("n_best", summed(n * best[at])).append_column("count_sum", summed(n * count[at]))


def linked_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text", carry=None) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row.  ``carry`` names the
    columns of ``row`` where not all are wanted (at least one)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    folder = new_run_dir(spark, "alignment")
    models, key = _broadcast_models(spark, a_path, b_path)
    keep = docs.columns if carry is None else list(carry)
    merged = stage(_merged(docs, models, key, text, keep), f"{folder}/merged")
    pairs = merged.where(F.col("pair").isNotNull()).select(F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("pair", "n")).alias("place", "p")).select(
        "of_block", "place", F.col("p.pair").alias("pair"), F.col("p.n").alias("n"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    # A B id has at most as many pairs as A has ids.
    size_b = len(Pieces(models.value[1]).written)
    of_b = Window.partitionBy(F.pmod("pair", F.lit(size_b)))
    counts = counts.select("pair", "count", (F.col("count") == F.max("count").over(of_b)).cast("int").alias("best"))
    counts = stage(counts.withColumnRenamed("pair", "of"), f"{folder}/counts")
    known = pairs.join(counts, F.col("pair") == F.col("of")).select("of_block", "place", "count", "best")
    documents = merged.where(F.col("pair").isNull()).select("block", "row", *FIGURES, "entry", "times")
    kept = documents.schema["row"].dataType.simpleString()
    return documents.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(
        _weighed, f"row {kept}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


ship_by_value(__name__)
