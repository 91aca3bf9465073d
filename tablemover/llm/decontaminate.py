"""Benchmark decontamination by the q-gram lemma.

Two texts within e edits of each other share at least m - q + 1 - q*e of the m - q + 1 q-grams of the one, and
the shared q-grams lie on diagonals at most e apart.  Per benchmark item the positions of its character
q-grams in a document are counted by diagonal, in bands twice as wide as needed that overlap by half, so that
every range of e + 1 diagonals lies in one.  A band that reaches the bound is a region; it is verified by an
alignment within the band, item against any part of the region, and counts if it needs at most e edits.

A q-gram that an item repeats very often would meet a repetitive text in their product of places.  Its places are
left out of the counting, and the bound is lower by as many; where nothing is left of it, every band that such a
q-gram reaches is a candidate.  Candidates are counted anew over all places before the alignment, by a search for
each place's q-gram on the band's diagonals, so the work on repetitive texts stays near their length.

Texts are compared in lower case with every run of other characters than letters and digits as one space.
The edit budget is ``EDIT_RATE`` of the item's length, less where the bound would reach zero.

The benchmark is the stated query set: its q-grams go to the tasks in blocks of at most ``BLOCK_CHARS``
characters, one pass over the documents per block; documents are never shuffled for the search.

Defined cases.  Items with fewer than q letters and spaces, empty and null ones match nothing; equal items
match alike.  Of several places of an item (ties) the first of least edits counts.  A null or empty document is
clean.  Very long documents are searched in overlapping segments.  Rows that repeat an id are judged by their own
text.  Ids of documents and items are integers; others are refused by name.  Empty tables give no matches.  The
other columns are carried packed, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import new_run_dir, stage
from .common import arrow_batches, field, integer_id, packed, ship_by_value, slices

Q = 10
EDIT_RATE = 0.08
BLOCK_CHARS = 2_000_000
SEGMENT = 1_000_000
# A q-gram that an item holds more often than this is no posting; hits are counted so many at a time.
OFTEN, HITS = 64, 2_000_000
MATCHES = "id long, text_hash long, item_id long, start long, stop long, edits int"
_OTHER = re.compile(r"[\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", text.lower()).strip() if text else ""


def edit_budget(length: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    return min(int(length * rate), (length - q) // q)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram, put together from those of half the length."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    have, length, base = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1, _BASE
    done, total = None, 0
    while q:
        if q & 1:  # append this power of two
            done = have if done is None else done[:len(done) - length] * base + have[total:][:len(done) - length]
            total += length
        q >>= 1
        if q:
            have = have[:len(have) - length] * base + have[length:]
            base, length = np.uint64(int(base) ** 2 % 2 ** 64), 2 * length
    return done


class QGramIndex:
    """The q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.items = [(i, _codes(t)) for i, t in items]
        self.budget = np.array([edit_budget(len(c), q, rate) for _, c in self.items], np.int64)
        size = np.array([len(c) for _, c in self.items], np.int64)
        self.need = size - q + 1 - q * self.budget
        self.width = self.budget + 1
        grams = [_grams(c, q) for _, c in self.items]
        g = np.concatenate(grams)
        owner = np.repeat(np.arange(len(grams)), [len(x) for x in grams])
        place = np.concatenate([np.arange(len(x)) for x in grams])
        self.keys, key = np.unique(g, return_inverse=True)
        self.gram_of = np.split(key, np.cumsum([len(x) for x in grams])[:-1])  # per item: the key at each place
        # Places whose q-gram an item repeats too often are no postings: the lemma holds for the others with as many less.
        pairs, of_pair, times = np.unique(owner.astype(np.int64) << 32 | key, return_inverse=True, return_counts=True)
        often = times[of_pair] > OFTEN
        self.rare_need = self.need - np.bincount(owner[often], minlength=len(grams))
        order = np.argsort(key[~often], kind="stable")
        self.owner, self.place = owner[~often][order], place[~often][order]
        self.first = np.searchsorted(key[~often][order], np.arange(len(self.keys)))
        self.count = np.bincount(key[~often], minlength=len(self.keys))
        # Of these, by key: the item and the first and last place, for items that so much may be missing of.
        open_item = often & (self.rare_need <= 0)[owner]
        some, at = np.unique(of_pair[open_item], return_inverse=True)
        low, high = np.full(len(some), len(g)), np.zeros(len(some), np.int64)
        np.minimum.at(low, at, place[open_item])
        np.maximum.at(high, at, place[open_item])
        by_key = np.argsort(pairs[some] & 0xFFFFFFFF, kind="stable")
        self.often_key = (pairs[some] & 0xFFFFFFFF)[by_key]
        self.often = np.column_stack((pairs[some] >> 32, low, high))[by_key]
        # A bit per hash class tells most foreign q-grams apart before the search among the keys.
        self.bits = max(16, int(np.ceil(np.log2(16 * len(self.keys) + 1))))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._class(self.keys)] = True
        self.reach = int((size + 6 * self.width).max())

    def _class(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - self.bits)

    def search(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item number, start, stop, edits) of the items found in ``codes``, the best place of each."""
        grams = _grams(codes, self.q)
        at = np.flatnonzero(self.seen[self._class(grams)])
        if not len(at):
            return []
        g = grams[at]
        k = np.searchsorted(self.keys, g)
        k[k == len(self.keys)] = 0
        hit = self.keys[k] == g
        at, k = at[hit], k[hit]
        if not len(at):
            return []
        places = np.sort(k.astype(np.int64) << 32 | at)  # the text's places of each key
        bands = []
        for item, cell in self._candidates(at, k):
            low = cell * self.width[item] - (1 << 31)
            shared = self._shared(places, item, low, 2 * self.width[item])
            if shared >= self.need[item]:
                bands.append((-shared, item, low))
        best = {}
        for _, item, low in sorted(bands):  # those that share most first: an exact copy ends the search for its item
            if item in best and not best[item][3]:
                continue
            # Edits before the first and after the last shared q-gram may leave the band by as many diagonals.
            low, width = int(low - self.budget[item]), int(2 * self.width[item] + 2 * self.budget[item])
            # Only fewer edits than the best place so far are of use.
            got = align(self.items[item][1], codes, low, width, best[item][3] - 1 if item in best else int(self.budget[item]))
            if got and (item not in best or got[2] < best[item][3]):
                best[item] = (item, *got)
        return list(best.values())

    def _candidates(self, at: np.ndarray, k: np.ndarray):
        """(item, cell) of the bands, a cell and the next, that may share enough q-grams, in order."""
        cells, found = self._counted(at, k)
        nxt = np.append(cells[1:] == cells[:-1] + 1, False)
        band = found + np.where(nxt, np.append(found[1:], 0), 0)
        # Where an item has places that are no postings, its band may begin a cell before the first hit.
        before = cells[self.rare_need[cells >> 34] < self.need[cells >> 34]] - 1
        before = np.setdiff1d(before, cells)
        counts = np.concatenate((band, found[np.searchsorted(cells, before + 1)]))
        cells = np.concatenate((cells, before))
        out = [cells[counts >= np.maximum(1, self.rare_need[cells >> 34])]]
        if len(self.often_key):
            for j in np.flatnonzero(np.isin(self.often_key, k)):
                item, first, last = self.often[j].tolist()
                mine, w = at[k == self.often_key[j]], int(self.width[item])
                a, b = (mine - last + (1 << 31)) // w - 1, (mine - first + (1 << 31)) // w
                # Intervals of cells, one per place in the text, as their union.
                starts = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1] + 1)))
                out += [(item << 34) + np.arange(a[s], b[e - 1] + 1) for s, e in zip(starts, [*starts[1:], len(a)])]
        for c in np.unique(np.concatenate(out)).tolist():
            yield c >> 34, c & ((1 << 34) - 1)

    def _counted(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item and cell, hits) in order, worked through in slices of a bounded number of hits."""
        n = self.count[k]
        at, k, n = at[n > 0], k[n > 0], n[n > 0]
        total = np.cumsum(n)
        cuts = np.unique(np.searchsorted(total, np.arange(HITS, total[-1] if len(n) else 0, HITS)))
        parts = []
        for s, e in zip([0, *cuts], [*cuts, len(n)]):
            if e == s:
                continue
            m = n[s:e]
            posting = np.repeat(self.first[k[s:e]], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            owner = self.owner[posting].astype(np.int64)
            cell = (np.repeat(at[s:e], m) - self.place[posting] + (1 << 31)) // self.width[owner]
            parts.append(np.unique(owner << 34 | cell, return_counts=True))
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cells, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return cells, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def _shared(self, places: np.ndarray, item: int, low: int, width: int) -> int:
        """How many of the item's places have their q-gram in the text on one of the diagonals from ``low`` on."""
        gram = self.gram_of[item].astype(np.int64) << 32
        begin = low + np.arange(len(gram))
        j = np.searchsorted(places, gram | np.maximum(begin, 0))
        there = places[np.minimum(j, len(places) - 1)]
        return int(((j < len(places)) & (there < gram + np.maximum(begin + width, 0))).sum())


def align(pattern: np.ndarray, text: np.ndarray, low: int, width: int, budget: int):
    """Least edits between the pattern and a part of ``text`` whose alignment stays on the diagonals low to
    low + width: (start, stop, edits), or None above the budget.  Start is that of the stop's diagonal."""
    m, n = len(pattern), len(text)
    begin = max(low, 0)
    region = text[begin:max(0, min(n, low + m + width))]
    exact = _text(region).find(_text(pattern))  # an exact copy needs no table
    if exact >= 0:
        return begin + exact, begin + exact + m, 0
    if budget < 1:
        return None
    pad = np.full(max(0, -low), 1 << 40, np.uint64)
    line = np.concatenate((pad, region, np.full(m + 2 * width + 2, 1 << 40, np.uint64)))
    steps = np.arange(width + 1)
    cost = np.zeros(width + 1, np.int64)
    for i in range(m):
        change = cost + (line[i:i + width + 1] != pattern[i])
        change[:-1] = np.minimum(change[:-1], cost[1:] + 1)  # the pattern's character is missing in the text
        cost = np.minimum.accumulate(change - steps) + steps  # the text has characters more
        if cost.min() > budget:
            return None
    k = int(cost.argmin())
    start = max(0, low + k)
    return start, min(n, start + m), int(cost[k])


def _searcher(index_value):
    def search(batches):
        index = QGramIndex(*index_value.value)
        for batch in slices(batches):
            ids, hashes, texts = (batch.column(c).to_pylist() for c in range(3))
            rows = []
            for i, h, text in zip(ids, hashes, texts, strict=True):
                codes, best = _codes(normalised(text)), {}
                for begin in range(0, max(1, len(codes)), SEGMENT):
                    for item, start, stop, edits in index.search(codes[begin:begin + SEGMENT + index.reach]):
                        if item not in best or edits < best[item][2]:
                            best[item] = (begin + start, begin + stop, edits)
                rows += [(i, h, index.items[item][0], *found) for item, found in best.items()]
            if rows:
                names = [c.split()[0] for c in MATCHES.split(", ")]
                kinds = [pa.int64()] * 5 + [pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return search


def _blocks(benchmark: DataFrame, item_id: str, text: str, q: int, block_chars: int):
    """The usable items in blocks.  All of the benchmark passes through the driver and is broadcast block by block:
    it is the small, fixed side, and each of its blocks is a pass over the documents."""
    block, chars = [], 0
    for row in benchmark.select(item_id, text).where(F.col(text).isNotNull()).toLocalIterator():
        item = normalised(row[1])
        if len(item) < q:
            continue
        if block and chars + len(item) > block_chars:
            yield block
            block, chars = [], 0
        block.append((row[0], item))
        chars += len(item)
    if block:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
                 q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, text_hash, item_id, start, stop, edits): the benchmark items found in the rows (id, text).  Start
    and stop count characters of the normalised text."""
    spark = docs.sparkSession
    integer_id(benchmark, item_id)
    arrow_batches(spark)
    rows = docs.select(F.col("id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    found = [rows.mapInArrow(_searcher(spark.sparkContext.broadcast((block, q, rate))), MATCHES)
             for block in _blocks(benchmark, item_id, item_text, q, block_chars)]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], MATCHES)


def _marked(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, carry=None, **options) -> tuple[DataFrame, DataFrame]:
    """The documents as (row, id, text_hash), the row with the columns in ``carry`` (all by default), and the
    matches by document as (f_id, f_hash, items, edits), written once: they are few, and their size is then
    known to the join."""
    integer_id(docs, doc_id)
    whole, carry = packed(docs), docs.columns if carry is None else list(carry)
    rows = whole.select(F.struct(*[field("row", c).alias(c) for c in carry]).alias("row"),
                        field("row", doc_id).cast("long").alias("id"), F.xxhash64(field("row", text)).alias("text_hash"))
    texts = whole.select(field("row", doc_id).alias("id"), field("row", text).alias("text"))
    found = (find_matches(texts, benchmark, **options)
             .groupBy(F.col("id").alias("f_id"), F.col("text_hash").alias("f_hash"))
             .agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.min("edits").alias("edits")))
    return rows, stage(found, new_run_dir(docs.sparkSession, "matches"))


def _same_document():
    return F.col("id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  **options) -> DataFrame:
    """(row, items, edits): every document, packed, with the sorted ids of the items in it (empty if clean) and
    the least edits of any.  ``carry`` names the columns of the row where not all are wanted."""
    rows, found = _marked(docs, benchmark, doc_id, text, **options)
    none = F.array().cast("array<bigint>")
    return rows.join(found, _same_document(), "left").select("row", F.coalesce("items", none).alias("items"), "edits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """The documents without any benchmark item."""
    rows, found = _marked(docs, benchmark, doc_id, text, **options)
    return rows.join(found, _same_document(), "left_anti").select(*[field("row", c).alias(c) for c in docs.columns])


ship_by_value(__name__)
