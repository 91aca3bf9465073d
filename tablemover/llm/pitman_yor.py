"""LM scoring with a hierarchical Pitman-Yor model.

Restaurants: one root over words, ``MIDDLES`` restaurants below it, ``LEAVES`` below those.  The word before a
token selects its leaf by a hash, the leaf its middle restaurant; so contexts share parents, and every token of
the training texts is a customer of its leaf.  A table of a restaurant is a customer of its parent for the same
word; tables of the root draw words from a uniform base over the training vocabulary and one unknown word.

Seating is sampled by Gibbs sweeps.  A sweep goes from the leaves to the root and draws the number of tables of
every (restaurant, word) from its conditional law given the words seen and all the rest: the parent's
predictive probability of the word and the restaurant's number of tables after the sweep before.  With these,
t tables of n customers have the weight S(n, t) pull^t, S being the generalized Stirling numbers, which sum up
all seatings of n customers at t tables; so all customers of a word are drawn at once, as many single removals
and re-seatings would leave them.  Predictive probabilities are averaged over the sweeps after the burn-in, and
a text's score is the sum of their logarithms.

Work is dealt by word: all that a word needs, in any restaurant, lies in its bucket, and only the totals of
LEAVES + MIDDLES + 1 restaurants are exchanged between sweeps.

1. Words with at least 1 / ``FREQUENT`` of all tokens are found, at most FREQUENT by their share.  They are
   hot keys: their tokens stay dealt by block of documents, and only their counts (at most FREQUENT x LEAVES
   numbers) are brought together, on the driver.
2. Blocks of documents are cut into postings per bucket of words (word, leaf, document number), exchanged,
   and written once.  Words and leaves travel as steps, and all columns compressed, as do the sums that come back;
   a posting takes about four bytes.  The leaf's highest bit marks training texts.
3. Each sweep is a pass over the buckets.  Draws depend on seed, bucket and sweep alone, so a sweep can be
   repeated from the totals before it, and nothing else has to be kept.
4. The last pass scores every posting and adds up by document within its block.

Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; each text ends in an end token.

Defined cases.  A null or empty text has the end token alone.  Null ids and repeated rows are scored each.
Without training texts the model is the base.  Equal texts (ties) have equal scores.  A very long text is cut into
postings like any other; its sums come together by its number in its block.  Only id, text and train are read,
whatever other columns there are.  Ids are integers.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ..workspace import new_run_dir, stage
from .common import arrow_batches, release, ship_by_value

LEAVES, MIDDLES = 1024, 32
# (discount, strength) of the root, the middle restaurants and the leaves.
LEVELS = ((0.8, 10.0), (0.8, 10.0), (0.9, 10.0))
SWEEPS, BURN_IN = 3, 1
# Up to so many customers of a word in a restaurant, the law of its tables is summed up number by number.
EXACT = 512
FREQUENT = 1000
BUCKET_BYTES = 12_000_000
# A bucket is worked off in so many parts by word, so that few numbers are in memory, while the sums that
# leave it are still one per document.
SUBS = 4
# Partial sums of logarithms travel in steps of 6e-11.
UNITS = float(1 << 34)
BLOCK_TOKENS = 1_000_000
END = b"\n"
COLD, HOT, DOCS = 0, 1, 2
PARTS = "bucket int, kind int, block long, words binary, runs binary, leaves binary, docs binary"
RESULT = ("id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def tokens_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, leaf) of every token of the text and of its end."""
    words = text.encode().lower().split() if text else []
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    end = np.uint64(xxhash.xxh3_64_intdigest(END))
    # At the start of a text the word before is an end.
    return np.append(h, end), (np.append(end, h) % np.uint64(LEAVES)).astype(np.uint16)


def _values(column):
    """The values of a column, a few hundred of them in Python at a time."""
    for at in range(0, len(column), 256):
        yield from column.slice(at, 256).to_pylist()


def _packed(x: np.ndarray, steps: bool = False) -> bytes:
    """Numbers, or their steps, compressed: all their first bytes, then all second ones and so on, or number by
    number where that is shorter, as with values that repeat.  In front are how many there are, the way, and the
    type."""
    head = len(x).to_bytes(4, "little")
    if steps:
        x = np.diff(x, prepend=x.dtype.type(0))  # wraps around
    data = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize)
    ways = [b"p" + x.dtype.str.encode() + pa.compress(data.T.tobytes(), "zstd", asbytes=True)]
    if x.dtype == np.int64:
        ways.append(b"n" + x.dtype.str.encode() + pa.compress(data.tobytes(), "zstd", asbytes=True))
    return head + min(ways, key=len)


def _unpacked(data: bytes, steps: bool = False) -> np.ndarray:
    """Undo ``_packed``."""
    n, kind = int.from_bytes(data[:4], "little"), np.dtype(data[5:8].decode())
    raw = np.frombuffer(pa.decompress(memoryview(data)[8:], n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    x = (raw.reshape(kind.itemsize, n).T.ravel() if data[4:5] == b"p" else raw).view(kind)
    return np.cumsum(x, dtype=kind) if steps else x


def _fixed(x: np.ndarray) -> np.ndarray:
    """Sums in units of 1 / ``UNITS``, which drops bits far below the error of a sum of logarithms; as they are if
    some are too large for that."""
    return np.rint(x * UNITS).astype(np.int64) if not len(x) or np.abs(x).max() < 1 << 28 else x


def _floating(x: np.ndarray) -> np.ndarray:
    """Undo ``_fixed``."""
    return x / UNITS if x.dtype == np.int64 else x


def _frequent_parts(batches):
    """Words with at least 1 / FREQUENT of a batch's tokens, with their counts, and the batch's tokens under a
    null word.  A word with that share overall has it in some batch."""
    for batch in batches:
        held, n = [], 0
        for k, text in enumerate(_values(batch.column("text"))):
            held.append(tokens_of(text)[0])
            n += len(held[-1])
            if n >= BLOCK_TOKENS or k == batch.num_rows - 1:
                words, counts = np.unique(np.concatenate(held), return_counts=True)
                many = counts * FREQUENT >= n
                yield pa.RecordBatch.from_arrays([pa.array([None, *words[many].view(np.int64).tolist()], pa.int64()),
                                                  pa.array([n, *counts[many].tolist()], pa.int64())], ["word", "n"])
                held, n = [], 0
                release()


def _postings(buckets: int, frequent: np.ndarray):
    def block_rows(block, ids, train, words, leaves):
        sizes = np.array([len(w) for w in words])
        doc = np.repeat(np.arange(len(words), dtype=np.uint32), sizes)
        w = np.concatenate(words)
        leaf = np.concatenate(leaves) | np.repeat(np.array(train, np.uint16) << np.uint16(15), sizes)
        hot = np.isin(w, frequent)
        bucket = (w >> np.uint64(20)) % np.uint64(buckets)
        bucket[hot] = np.uint64(buckets)  # sorts behind the others
        order = np.lexsort((leaf, w, bucket))
        w, leaf, doc, bucket = w[order], leaf[order], doc[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(w))
        home = block % buckets
        yield (-1 - home, DOCS, block, np.array([i or 0 for i in ids], np.int64).tobytes(), sizes.astype(np.uint32).tobytes(),
               np.array(train, np.uint8).tobytes(), np.array([i is None for i in ids], np.uint8).tobytes())
        for a, b in zip(cuts[:-1], cuts[1:]):
            first = np.flatnonzero(np.append(True, w[a + 1:b] != w[a:b - 1]))
            runs = np.diff(np.append(first, b - a)).astype(np.uint32)
            is_hot = bucket[a] == buckets
            yield (home if is_hot else int(bucket[a]), HOT if is_hot else COLD, block, _packed(w[a:b][first], steps=True),
                   _packed(runs), _packed(leaf[a:b], steps=True), _packed(_small(doc[a:b])))

    def postings(batches):
        block = TaskContext.get().partitionId() << 24
        for batch in batches:
            all_ids, all_train = batch.column("id").to_pylist(), batch.column("train").to_pylist()
            ids, train, words, leaves, n = [], [], [], [], 0
            for k, text in enumerate(_values(batch.column("text"))):
                w, leaf = tokens_of(text)
                ids.append(all_ids[k]), train.append(bool(all_train[k])), words.append(w), leaves.append(leaf)
                n += len(w)
                if n >= BLOCK_TOKENS or k == batch.num_rows - 1:
                    rows = list(zip(*block_rows(block, ids, train, words, leaves), strict=True))
                    kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds, strict=True)],
                                                     [c.split()[0] for c in PARTS.split(", ")])
                    ids, train, words, leaves, n = [], [], [], [], 0
                    del rows
                    block += 1
                    release()
    return postings


class _Stirling(dict):
    """Per discount the logarithms of S(n, t) for n and t up to EXACT, where
    S(n + 1, t) = S(n, t - 1) + (n - discount t) S(n, t).  Kept by a process; a task takes none along."""

    def __missing__(self, discount: float) -> np.ndarray:
        out, t = np.full((EXACT + 1, EXACT + 1), -np.inf), np.arange(1, EXACT + 1)
        out[1, 1] = 0
        for n in range(1, EXACT):
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], out[n, 1:] + np.log(np.maximum(n - discount * t, 1e-300)))
        self[discount] = out
        return out

    def __reduce__(self):
        return _Stirling, ()


LOG_STIRLING = _Stirling()


def _tables_of_many(rng, n: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """The same law where customers are many.  Tables are a Poisson number of independent sizes given their sum;
    the first holds what is left over, the others have the mean and the variance of the local limit, at the
    saddle point x with pull x (1 - x)^(discount - 1) = n, written by -log(1 - x)."""
    aim = np.log(n) - np.log(pull)
    low, high = np.zeros(len(n)), np.maximum(aim, 0) / (1 - discount) + 60
    for _ in range(80):
        at = (low + high) / 2
        less = np.log(-np.expm1(-np.maximum(at, 1e-300))) + (1 - discount) * at < aim
        low, high = np.where(less, at, low), np.where(less, high, at)
    mean = pull * -np.expm1(-discount * high) / discount
    spread = np.maximum(mean - n / (1 + (1 - discount) * np.expm1(np.minimum(high, 300))), 0)
    free = spread > 0.9 * mean
    drawn = np.where(free, rng.poisson(np.where(free, mean, 0)), np.rint(rng.normal(mean, np.sqrt(spread))))
    return np.clip(1 + drawn, 1, n)


def reseat(rng, customers: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """Tables of each entry drawn from the conditional law of a Gibbs step, weights S(customers, t) pull^t."""
    n = customers.astype(np.int64)
    tables, law = (n > 0).astype(np.float64), LOG_STIRLING[discount]
    several = np.flatnonzero((n > 1) & (n <= EXACT))
    several = several[np.argsort(n[several], kind="stable")]
    log_pull, at = np.log(pull), 0
    while at < len(several):
        # Entries with about as many customers, some megabytes at a time.
        here = several[at:at + max(1, (1 << 18) // int(n[several[at]]))]
        here = here[n[here] <= 2 * n[here[0]]]
        t = np.arange(1, n[here[-1]] + 1)
        weights = law[n[here], 1:n[here[-1]] + 1] + log_pull[here, None] * t
        weights = np.cumsum(np.exp(weights - weights.max(1, keepdims=True)), 1)
        tables[here] = 1 + (weights < rng.random((len(here), 1)) * weights[:, -1:]).sum(1)
        at += len(here)
    many = np.flatnonzero(n > EXACT)
    if len(many):
        tables[many] = _tables_of_many(rng, n[many].astype(np.float64), pull[many], discount)
    return tables


class Words:
    """The seating of a set of words: entries (word number, leaf) with their training counts."""

    def __init__(self, n_words: int, word: np.ndarray, leaf: np.ndarray, counts: np.ndarray):
        self.n, self.word, self.leaf, self.counts = n_words, word, leaf, counts.astype(np.float64)
        middle = word.astype(np.int64) * MIDDLES + leaf % MIDDLES
        self.pairs, self.up = np.unique(middle, return_inverse=True)
        self.pair_word, self.pair_middle = self.pairs // MIDDLES, self.pairs % MIDDLES
        self.total = np.bincount(word, self.counts, n_words)
        self.tables = [(self.total > 0).astype(float), None, (self.counts > 0).astype(float)]
        self.tables[1] = (np.bincount(self.up, self.tables[2], len(self.pairs)) > 0).astype(float)

    def customers(self):
        middle = np.bincount(self.up, self.tables[2], len(self.pairs))
        return [np.bincount(self.pair_word, self.tables[1], self.n), middle, self.counts]

    def totals(self) -> np.ndarray:
        """Per restaurant (root, middles, leaves): tables, customers."""
        root, middle, leaf = self.customers()
        out = np.zeros((2, 1 + MIDDLES + LEAVES))
        for row, (r, m, x) in enumerate(((self.tables[0], self.tables[1], self.tables[2]), (root, middle, leaf))):
            out[row, 0] = r.sum()
            out[row, 1:1 + MIDDLES] = np.bincount(self.pair_middle, m, MIDDLES)
            out[row, 1 + MIDDLES:] = np.bincount(self.leaf, x, LEAVES)
        return out

    def probabilities(self, totals: np.ndarray, base: float):
        """Predictive probability of each word at the root, each pair in its middle, each entry in its leaf."""
        def level(k, customers, tables, at, parent):
            d, s = LEVELS[k]
            all_tables, all_customers = totals[0, at], totals[1, at]
            return (np.maximum(customers - d * tables, 0) + (s + d * all_tables) * parent) / (s + all_customers)
        root, middle, leaf = self.customers()
        p0 = level(0, root, self.tables[0], 0, base)
        p1 = level(1, middle, self.tables[1], 1 + self.pair_middle, p0[self.pair_word])
        return p0, p1, level(2, leaf, self.tables[2], 1 + MIDDLES + self.leaf, p1[self.up])

    def sweep(self, rng, totals: np.ndarray, base: float) -> None:
        p0, p1, _ = self.probabilities(totals, base)
        (d0, s0), (d1, s1), (d2, s2) = LEVELS
        pull = (s2 + d2 * totals[0, 1 + MIDDLES + self.leaf]) * p1[self.up]
        self.tables[2] = reseat(rng, self.counts, pull, d2)
        customers = np.bincount(self.up, self.tables[2], len(self.pairs))
        self.tables[1] = reseat(rng, customers, (s1 + d1 * totals[0, 1 + self.pair_middle]) * p0[self.pair_word], d1)
        customers = np.bincount(self.pair_word, self.tables[1], self.n)
        self.tables[0] = reseat(rng, customers, np.full(self.n, (s0 + d0 * totals[0, 0]) * base), d0)

    def after(self, seed: list[int], history: list[np.ndarray], base: float):
        """Sweep once per totals in ``history``; the mean leaf probabilities after the burn-in, under the
        totals that follow each sweep where these are known."""
        mean, n = 0.0, 0
        for k, totals in enumerate(history):
            if k:
                self.sweep(np.random.default_rng([*seed, k]), history[k - 1], base)
                if k > BURN_IN:
                    mean, n = mean + self.probabilities(totals, base)[2], n + 1
        return mean / max(1, n)


def _buckets(batch, *kinds):
    """The rows of a batch one by one, postings of ``kinds`` unpacked: a worker holds the postings of one bucket at a
    time."""
    for row in range(batch.num_rows):
        parts = batch.column("parts")[row].as_py()
        for p in parts:
            if p["kind"] in kinds:
                p |= {c: _unpacked(p[c], steps=c in ("words", "leaves")) for c in ("words", "runs", "leaves", "docs")}
        yield batch.column("bucket")[row].as_py(), parts
        release()


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint16 if not len(x) or x.max() < 65536 else np.uint32)


def _read(parts, kind, sub=0, subs=1):
    """The postings of one kind in a bucket, of the words of one part: the seating of these words, the word and
    the entry of each posting, and the documents per block."""
    words, runs, leaf, docs = [], [], [], []
    for p in sorted((p for p in parts if p["kind"] == kind), key=lambda p: p["block"]):
        w, r, x, d = (p[c] for c in ("words", "runs", "leaves", "docs"))
        if subs > 1:
            here = (w >> np.uint64(44)) % np.uint64(subs) == sub
            take = np.repeat(here, r)
            w, r, x, d = w[here], r[here], x[take], d[take]
        if len(w):
            words.append(w), runs.append(r), leaf.append(x), docs.append((p["block"], d))
    if not words:
        return None
    words, number = np.unique(np.concatenate(words), return_inverse=True)
    number, leaf = np.repeat(number.astype(np.int32), np.concatenate(runs)), np.concatenate(leaf)
    entries, entry = np.unique(number.astype(np.int64) * LEAVES + (leaf & 0x7FFF), return_inverse=True)
    entry = entry.astype(np.int32)
    counts = np.bincount(entry[leaf >= 0x8000], minlength=len(entries))
    return words, Words(len(words), entries // LEAVES, entries % LEAVES, counts), number, entry, docs


def _totals(history, base):
    """Rows (restaurant, tables, customers) of each bucket after len(history) sweeps; restaurant -1 holds the
    number of training words and tokens."""
    def totals(batches):
        for batch in batches:
            for bucket, parts in _buckets(batch, COLD):
                out, words, tokens = np.zeros((2, 1 + MIDDLES + LEAVES)), 0, 0
                for sub in range(SUBS):
                    got = _read(parts, COLD, sub, SUBS)
                    if got is None:
                        continue
                    seating = got[1]
                    for k, known in enumerate(history):
                        seating.sweep(np.random.default_rng([bucket, sub, k + 1]), known, base)
                    out += seating.totals()
                    words, tokens = words + (seating.total > 0).sum(), tokens + seating.total.sum()
                    del got, seating
                    release()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(-1, out.shape[1]), pa.int32()),
                     pa.array(np.append(words, out[0]).astype(float)),
                     pa.array(np.append(tokens, out[1]).astype(float))], ["at", "tables", "customers"])
    return totals


def _hot_counts(batches):
    """(word, leaf, training count) of the frequent words' postings."""
    for batch in batches:
        for _, parts in _buckets(batch, HOT):
            got = _read(parts, HOT)
            if got is not None:
                words, seating = got[:2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)[seating.word]), pa.array(seating.leaf.astype(np.int32)),
                     pa.array(seating.counts.astype(np.int64))], ["word", "leaf", "n"])


def _scores(model):
    """Per block and bucket: sums over the bucket's tokens of each document, packed; and the documents."""
    def add(sums, block, doc, *terms):
        size = int(doc.max()) + 1
        old = sums.get(block)
        new = np.zeros((4, max(size, 0 if old is None else old.shape[1])))
        if old is not None:
            new[:, :old.shape[1]] = old
        for k, x in enumerate((np.ones(len(doc)), *terms)):
            new[k, :size] += np.bincount(doc, x, size)
        sums[block] = new

    def pack(block, sums):
        here = np.flatnonzero(sums[0])
        return (block, COLD, _packed(_small(here), steps=True), _packed(_small(sums[1, here].round())),
                _packed(_fixed(sums[2, here])), _packed(_fixed(sums[3, here])))

    def scores(batches):
        history, base, vocabulary, tokens, hot_words, hot_log, hot_total = model.value
        floor = tokens + 0.1 * (vocabulary + 1)
        for batch in batches:
            for bucket, parts in _buckets(batch, COLD, HOT):
                rows = [(p["block"], DOCS, p["words"], p["runs"], p["leaves"], p["docs"]) for p in parts if p["kind"] == DOCS]
                sums: dict = {}
                for kind, sub, subs in [(COLD, k, SUBS) for k in range(SUBS)] + [(HOT, 0, 1)]:
                    got = _read(parts, kind, sub, subs)
                    if got is None:
                        continue
                    words, seating, number, entry, docs = got
                    if kind == COLD:
                        log = np.log10(seating.after([bucket, sub], history, base))[entry]
                        total = seating.total[number]
                    else:
                        at = np.searchsorted(hot_words, words)[number]
                        log = hot_log[at, seating.leaf[entry]]
                        total = hot_total[at]
                    plain, known, a = np.log10((total + 0.1) / floor), (total > 0).astype(float), 0
                    for block, doc in docs:
                        cut = slice(a, a + len(doc))
                        add(sums, block, doc, known[cut], plain[cut], log[cut])
                        a += len(doc)
                    del got, seating, number, entry, log, total, plain, known
                    release()
                rows += [pack(block, x) for block, x in sums.items()]
                if rows:
                    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                        ["block", "kind", "a", "b", "c", "d"])
    return scores


def _by_document(table: pa.Table) -> pa.Table:
    """The sums of a block's documents over all buckets."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["a"], r["d"]))
    docs = next(r for r in rows if r["kind"] == DOCS)
    ids, sizes = np.frombuffer(docs["a"], np.int64), np.frombuffer(docs["b"], np.uint32)
    sums = np.zeros((3, len(ids)))
    for r in rows:
        if r["kind"] != DOCS:
            at = _unpacked(r["a"], steps=True)
            for k, x in enumerate((_unpacked(r["b"]), _floating(_unpacked(r["c"])), _floating(_unpacked(r["d"])))):
                sums[k, at] += x
    return pa.table({"id": pa.array(ids, mask=np.frombuffer(docs["d"], np.uint8).astype(bool)),
                     "train": pa.array(np.frombuffer(docs["c"], np.uint8).astype(bool)),
                     "n_tokens": pa.array(sizes.astype(np.int64)), "n_known": pa.array(sums[0].round().astype(np.int64)),
                     "base_score": pa.array(sums[1]), "score": pa.array(sums[2])})


def score_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Scores of the rows (id, text, train), learnt from those with ``train``: the rows of RESULT, scores as
    log10 probabilities, and the number of training tokens."""
    spark = docs.sparkSession
    arrow_batches(spark, "8m")  # a batch's texts make up a block of postings; a bucket of them is about as large
    folder = new_run_dir(spark, "pitman-yor")
    rows = docs.select(F.col("id").cast("long").alias("id"), "text", "train")
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))

    counted = rows.select("text").mapInArrow(_frequent_parts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stage(counted, f"{folder}/frequent")
    n_all = counted.where("word IS NULL").agg(F.max("n")).first()[0] or 0
    hot = np.array([r["word"] for r in counted.where(f"word IS NOT NULL AND n * {FREQUENT} >= {n_all}").collect()],
                   np.int64).view(np.uint64)
    hot.sort()

    parts = rows.mapInArrow(_postings(buckets, hot), PARTS)
    kept = stage(parts.groupBy("bucket").agg(F.collect_list(F.struct("kind", "block", "words", "runs", "leaves", "docs")).alias("parts")),
                 f"{folder}/postings")
    counts = (kept.where("bucket >= 0").mapInArrow(_hot_counts, "word long, leaf int, n long")
              .groupBy("word", "leaf").agg(F.sum("n").alias("n")).toArrow())
    dense = np.zeros((len(hot), LEAVES))
    at = np.searchsorted(hot, counts.column("word").to_numpy().view(np.uint64))
    dense[at, counts.column("leaf").to_numpy()] = counts.column("n").to_numpy()
    where = np.arange(dense.size)
    frequent = Words(len(hot), where // LEAVES, where % LEAVES, dense.ravel())

    history, base, vocabulary, tokens = [], 1.0, 0, 0
    for k in range(SWEEPS + 1):
        if k:
            frequent.sweep(np.random.default_rng([FREQUENT, buckets, k]), history[-1], base)
        found = (kept.where("bucket >= 0").mapInArrow(_totals(list(history), base), "at int, tables double, customers double")
                 .groupBy("at").agg(F.sum("tables").alias("tables"), F.sum("customers").alias("customers")).collect())
        totals = frequent.totals()
        for r in found:
            if r["at"] >= 0:
                totals[:, r["at"]] += (r["tables"], r["customers"])
            elif not k:
                vocabulary, tokens = int(r["tables"]), int(r["customers"])
        if not k:
            vocabulary, tokens = vocabulary + int((frequent.total > 0).sum()), tokens + int(frequent.total.sum())
            base = 1 / (vocabulary + 1)
            frequent_start = Words(len(hot), where // LEAVES, where % LEAVES, dense.ravel())
        history.append(totals)
    mean, n = 0.0, 0
    for k in range(1, SWEEPS + 1):
        frequent_start.sweep(np.random.default_rng([FREQUENT, buckets, k]), history[k - 1], base)
        if k > BURN_IN:
            mean, n = mean + frequent_start.probabilities(history[k], base)[2], n + 1
    hot_log = np.log10(mean / n).reshape(dense.shape) if len(hot) else dense
    model = spark.sparkContext.broadcast((history, base, vocabulary, tokens, hot, hot_log, frequent.total))
    scored = kept.mapInArrow(_scores(model), "block long, kind int, a binary, b binary, c binary, d binary")
    return scored.groupBy("block").applyInArrow(_by_document, RESULT), tokens


ship_by_value(__name__)
