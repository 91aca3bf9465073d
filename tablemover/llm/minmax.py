"""MinHash near-dedup by min-max hashing.

Every permutation of the shingle hashes gives two signature values, the least and the greatest image, so 128
values cost 64 evaluations per shingle.  Both match between two sets with a probability equal to their
similarity.  The values are banded (32 bands of 4): two sets of similarity 0.8 share a band but for 5 in
10^8 pairs.

1. Equal sets are one class, carried by its smallest id; only classes go on.
2. Classes that share a band with another are candidates; their full sets are written once.  Texts of other rows
   are not shuffled but for one in 32, nor are, at the end, the rows that stay.
3. Star rounds: in every band group that still holds several components, all members are compared with one
   centre (later rounds: one of each of the two largest components), on full sets.  A group of n near copies
   costs n comparisons a round, not n * n.  Links are contracted to components after each round.  In large groups rounds go on while
   they halve the rows that lie off their group's largest component.
4. The rest, exactly, first by long signatures (2,048 min-max values, two bits of each; a pair of similarity 0.8
   shows an estimate below 0.758 in 4 of 10^5 cases), then on full sets: all pairs of a small group; of a large
   one the members off the largest component with all others, in blocks of bounded size.  A pair of blocks leaves
   only links that join its members (a spanning forest), so a group leaves no square of pairs.

Two sets are linked when 100 * |intersection| >= 100 * threshold * |union|.  A document's component is that
of its class; the component's id is the least document id in it.

Defined cases.  A text without words, null included, has an empty set and is linked with nothing.  A text
with fewer words than a shingle is one shingle, its whole sequence.  A null id is in no component and is
kept.  Rows that repeat an id each belong to the component of their own text.  Ties, sets at just the threshold,
are links.  A very long text is one set, its row's work; its id and links are as any other's.  Ids are integers;
others are refused by name.  An empty table gives an empty table.  Other columns come back as they were, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workspace import new_run_dir, stage
from .common import arrow_batches, field, integer_id, maybe_among, packed, ship_by_value, slices
from .components import components

PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
THRESHOLD = 0.8
# Star rounds at most, all but the first in groups of more than SMALL rows; what they leave is compared exactly.
MOST_ROUNDS, SMALL = 12, 64
# Members, and bytes of their sets, of a block in the exact rest.
BLOCK, BLOCK_BYTES = 256, 4_000_000
LONG_PERMUTATIONS, LEAST_ESTIMATE = 1024, 0.758
_MASK = (1 << 64) - 1
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_RNG = np.random.default_rng(2024)
_FLIP = _RNG.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64) | np.uint64(1)
# Half as wide: long signatures only sort out pairs, and 32-bit products are much faster.
_LONG_FLIP = _RNG.integers(0, 1 << 32, (LONG_PERMUTATIONS, 1), dtype=np.uint32)
_LONG_ODD = _RNG.integers(0, 1 << 32, (LONG_PERMUTATIONS, 1), dtype=np.uint32) | np.uint32(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; words as [^\\x20\\x09-\\x0D]+, A-Z lower-cased
    (which is what split() and lower() of bytes do)."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)] if n else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    s = h[:n - width + 1].copy()
    for k in range(1, width):
        s = s * _MIX[k % 4] + h[k:n - width + 1 + k]
    return np.unique(s)


def signature(s: np.ndarray, flip: np.ndarray = _FLIP, odd: np.ndarray = _ODD) -> np.ndarray:
    """The min-max values, two for each permutation, of a set that is not empty."""
    least = greatest = None
    for at in range(0, len(s), 512):
        image = (s[None, at:at + 512] ^ flip) * odd
        low, high = image.min(axis=1), image.max(axis=1)
        least = low if least is None else np.minimum(least, low)
        greatest = high if greatest is None else np.maximum(greatest, high)
    return np.column_stack((least, greatest)).ravel()


def long_signature(s: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of each of 2 * LONG_PERMUTATIONS further min-max values, packed four to a byte."""
    half, step = (s >> np.uint64(32)).astype(np.uint32), 64  # few enough permutations at a time for the cache
    v = np.concatenate([signature(half, _LONG_FLIP[k:k + step], _LONG_ODD[k:k + step]) for k in range(0, LONG_PERMUTATIONS, step)])
    v = (v.astype(np.uint64) * _MIX[1] >> np.uint64(62)).astype(np.uint8).reshape(-1, 4)
    return v[:, 0] | v[:, 1] << 2 | v[:, 2] << 4 | v[:, 3] << 6


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of a packed long signature with each of several: equal pairs of bits, less those by chance."""
    differ = one ^ others
    differ = (differ | differ >> 1) & 0x55
    equal = 1 - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) / (2 * LONG_PERMUTATIONS)
    return (equal - 0.25) / 0.75


def _band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0]
    for column in sig.reshape(BANDS, ROWS).T:
        key = (key ^ column) * _MIX[3]
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _sign(width: int):
    def sign(batches):
        for batch in slices(batches):
            n, keys, bands = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), width)
                n.append(len(s))
                if not len(s):
                    keys.append(None), bands.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(_band_keys(signature(s)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["id", "n_shingles", "set_key", "bands"])
    return sign


def _sets(width: int):
    def sets(batches):
        for batch in slices(batches):
            out = [shingle_set(t.as_py(), width).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(out, pa.binary())], ["rep", "members"])
    return sets


def _set_of(cell) -> np.ndarray:
    """The sorted hashes of a binary cell, without a copy."""
    return np.frombuffer(cell.as_buffer(), np.uint64)


def similar(x: np.ndarray, y: np.ndarray, bound: int) -> bool:
    """100 * |intersection| >= bound * |union| of two sorted sets."""
    if 100 * min(len(x), len(y)) < bound * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= bound * (len(x) + len(y) - both)


def _linked(threshold: float):
    bound = round(100 * threshold)

    def linked(batches):
        for batch in slices(batches):
            keep = [similar(_set_of(x), _set_of(y), bound) for x, y in zip(batch.column("sa"), batch.column("sb"))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return linked


def _long_signatures(batches):
    for batch in slices(batches):
        out = [long_signature(_set_of(m)).tobytes() for m in batch.column("members")]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(out, pa.binary()), batch.column("members")], ["rep", "sig", "members"])


def spanning_links(left, right, bound: int) -> list[tuple[int, int]]:
    """Links across two blocks of members (rep, root, signature, set), enough to join all that are linked there:
    at most one less than there are members.  Members of one root are joined already.  Pairs whose signatures look
    similar enough are tested on full sets, unless a link before has joined them."""
    up: dict[int, int] = {}

    def top(n: int) -> int:
        while up.setdefault(n, n) != n:
            up[n] = n = up[up[n]]
        return n

    out = []
    others = np.array([m[2] for m in right])
    roots = np.array([m[1] for m in right])
    for rep, root, sig, members in left:
        for k in np.flatnonzero((estimates(sig, others) >= LEAST_ESTIMATE) & (roots != root)):
            a, b = top(root), top(int(roots[k]))
            if a != b and similar(members, right[k][3], bound):
                up[a] = b
                out.append((min(rep, right[k][0]), max(rep, right[k][0])))
    return out


def _alike(batches):
    """The pairs of a small group, across components, whose signatures look similar enough."""
    for batch in slices(batches):
        a_out, b_out = [], []
        for group in batch.column("members"):
            rep, root = (np.array(group.values.field(c)) for c in ("rep", "root"))
            sig = np.array([np.frombuffer(m["sig"].as_buffer(), np.uint8) for m in group.values])
            for k in range(len(rep) - 1):
                ok = np.flatnonzero((estimates(sig[k], sig[k + 1:]) >= LEAST_ESTIMATE) & (root[k + 1:] != root[k])) + k + 1
                a_out += np.minimum(rep[k], rep[ok]).tolist()
                b_out += np.maximum(rep[k], rep[ok]).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])


def _spanning(threshold: float):
    bound = round(100 * threshold)

    def read(side):
        return [(m["rep"].as_py(), m["root"].as_py(), np.frombuffer(m["sig"].as_buffer(), np.uint8), _set_of(m["members"])) for m in side.values]

    def spanning(batches):
        for batch in slices(batches, 1):
            links = spanning_links(read(batch.column("one")[0]), read(batch.column("other")[0]), bound)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
    return spanning


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    left = sets.select(F.col("rep").alias("a"), F.col("members").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("members").alias("sb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_linked(threshold), "a long, b long")


def _open(groups: DataFrame, folder: str) -> DataFrame:
    """The rows of the groups that hold several components.  The keys are staged: a join with a table read anew
    is one whose large groups can be split."""
    several = stage(groups.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                    .where("lo < hi").select(F.col("key").alias("k")), folder)
    return groups.join(several, F.col("key") == F.col("k"), "left_semi")


def _largest(groups: DataFrame, folder: str) -> DataFrame:
    """(k, rows, first, second) per group: how many rows it has, and its two largest components (rows, root)."""
    sized = groups.groupBy(F.col("key").alias("k"), "root").agg(F.count("*").alias("n"))
    by_size = Window.partitionBy("k").orderBy(F.desc("n"), "root")
    # Only the two first of a group go on; their ranks stop a window's task early.
    ranked = sized.withColumn("place", F.row_number().over(by_size)).where("place <= 2")
    total = sized.groupBy(F.col("k").alias("tk")).agg(F.sum("n").alias("rows"))
    two = ranked.groupBy("k").agg(*[F.max(F.when(F.col("place") == p, F.struct("n", "root"))).alias(c) for p, c in ((1, "first"), (2, "second"))])
    return stage(two.join(total, F.col("k") == F.col("tk")).select("k", "rows", "first", "second"), folder)


def _star_pairs(groups: DataFrame, largest: DataFrame | None, round_no: int, threshold: float, folder: str) -> DataFrame:
    """Every member with the group's centres.  In the first round that is the member least by a hash order, one
    order for all groups, so that copies meet the same centre in every band; later one member each, by an order of
    the round, of the largest component and of the largest other one.  Sets whose sizes alone rule a link out are no
    pair, so that their members need not travel."""
    own = groups
    if round_no:
        own = groups.join(largest.where(F.col("rows") > SMALL), F.col("key") == F.col("k")).where("root IN (first.root, second.root)")
    order = F.min(F.struct(F.xxhash64(F.lit(100 * round_no), "rep").alias("h"), F.col("rep").alias("c_rep"), F.col("root").alias("c_root"), F.col("items").alias("c_items")))
    middle = own.groupBy(F.col("key").alias("ck"), *(["root"] if round_no else [])).agg(order.alias("c"))
    middle = stage(middle.select("ck", "c.c_rep", "c.c_root", "c.c_items"), folder)
    near = 100 * F.least("items", "c_items") >= round(100 * threshold) * F.greatest("items", "c_items")
    return (groups.join(middle, F.col("key") == F.col("ck")).where("root <> c_root").where(near)
            .select(F.least("rep", "c_rep").alias("a"), F.greatest("rep", "c_rep").alias("b")).distinct())


def _rest_links(groups: DataFrame, largest: DataFrame, sets: DataFrame, threshold: float, folder: str) -> DataFrame:
    """Links that join all that the groups still hold apart.  A small group's pairs are sorted out by signatures,
    and verified once however many groups share them.  Of a large group the members off the largest component meet
    all others in blocks of a bounded number of members and bytes, which carry their sets."""
    left = groups.select(F.col("rep").alias("r")).distinct()
    signed = sets.join(left, F.col("rep") == F.col("r"), "left_semi").mapInArrow(_long_signatures, "rep long, sig binary, members binary")
    signed = stage(signed.withColumnRenamed("rep", "s_rep"), f"{folder}/signed")
    told = groups.join(largest.select("k", "rows", F.col("first.root").alias("main")), F.col("key") == F.col("k"))
    small = told.where(F.col("rows") <= SMALL).join(signed.drop("members"), F.col("rep") == F.col("s_rep"))
    pairs = small.groupBy("key").agg(F.collect_list(F.struct("rep", "root", "sig")).alias("members")).select("members").mapInArrow(
        _alike, "a long, b long").distinct()
    large = told.where(F.col("rows") > SMALL)
    sizes = large.join(signed.select("s_rep", F.octet_length("members").alias("size")), F.col("rep") == F.col("s_rep"))
    blocks = stage(sizes.groupBy(F.col("key").alias("bk")).agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES)).alias("blocks")),
                   f"{folder}/blocks")
    rows = (large.join(signed, F.col("rep") == F.col("s_rep")).join(blocks, F.col("key") == F.col("bk"))
            .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "rep"), F.col("blocks"))))
    member = F.struct("rep", "root", "sig", "members")
    every = rows.groupBy("key", "block").agg(F.collect_list(member).alias("other"))
    off = rows.where("root <> main").groupBy(F.col("key").alias("k"), "block").agg(F.collect_list(member).alias("one"))
    met = off.drop("block").join(every, F.col("k") == F.col("key")).select("one", "other").mapInArrow(_spanning(threshold), "a long, b long")
    return _verify(pairs, sets, threshold).unionByName(met.distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, set_key, n_shingles, component_id): one row per input row."""
    spark = docs.sparkSession
    integer_id(docs, doc_id)
    arrow_batches(spark)
    folder = new_run_dir(spark, "minmax")
    rows = docs.select(F.col("`" + doc_id + "`").cast("long").alias("id"), F.col("`" + text + "`").alias("text"))
    signed = stage(rows.mapInArrow(_sign(width), "id long, n_shingles long, set_key binary, bands array<long>"),
                   f"{folder}/signed")
    with_id = signed.where("id IS NOT NULL AND set_key IS NOT NULL")
    classes = with_id.groupBy("set_key").agg(F.min("id").alias("rep"))
    # One row of each class, that of its smallest id, carries the bands.
    carriers = with_id.join(classes.withColumnRenamed("set_key", "ck"),
                            (F.col("set_key") == F.col("ck")) & (F.col("id") == F.col("rep")))
    carriers = stage(carriers.groupBy("rep", "set_key").agg(F.first("bands").alias("bands"), F.first("n_shingles").alias("items")),
                     f"{folder}/classes")
    member = carriers.select(F.explode("bands").alias("key"), "rep", "items")
    # Classes share a rep where rows repeat an id with different texts; the id then has several sets.
    groups = stage(_open(member.withColumn("root", F.col("rep")), f"{folder}/open"), f"{folder}/groups")
    wanted = stage(groups.select("rep").distinct(), f"{folder}/wanted")
    texts = maybe_among(rows, F.col("id"), wanted).where("maybe").drop("maybe")
    texts = texts.join(wanted, F.col("id") == F.col("rep"), "left_semi")
    keyed = texts.withColumnRenamed("id", "rep").mapInArrow(_sets(width), "rep long, members binary")
    sets = stage(keyed, f"{folder}/sets")
    roots = None
    largest, apart, k, last = None, None, 0, False
    while not groups.isEmpty() and not last:
        if k or not MOST_ROUNDS:
            largest = _largest(groups, f"{folder}/{k}/largest")
            off = F.when(F.col("rows") > SMALL, F.col("rows") - F.col("first.n"))
            before, apart = apart, largest.agg(F.sum(off)).first()[0] or 0
            # Stars go on while each halves the rows that lie off their large group's largest component.
            last = k >= MOST_ROUNDS or not apart or before is not None and apart > before / 2
        links = (_rest_links(groups, largest, sets, threshold, f"{folder}/rest") if last else
                 _verify(_star_pairs(groups, largest, k, threshold, f"{folder}/{k}/centres"), sets, threshold))
        root_of = groups.select("rep", "root").distinct()
        ra, rb = (root_of.select(F.col("rep").alias(f"r{c}"), F.col("root").alias(f"root_{c}")) for c in "ab")
        links = links.join(ra, F.col("a") == F.col("ra")).join(rb, F.col("b") == F.col("rb"))
        links = links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        step = components(links, f"{folder}/{k}/components").select(F.col("node").alias("n"), F.col("root").alias("r"))
        move = lambda df: df.join(step, F.col("root") == F.col("n"), "left").withColumn(
            "root", F.coalesce("r", "root")).drop("n", "r")
        roots = step.select(F.col("n").alias("rep"), F.col("r").alias("root")) if roots is None else \
            move(roots).unionByName(step.select(F.col("n").alias("rep"), F.col("r").alias("root"))).groupBy("rep").agg(F.min("root").alias("root"))
        roots = stage(roots, f"{folder}/{k}/roots")
        groups = stage(_open(move(groups), f"{folder}/{k}/open"), f"{folder}/{k}/groups")
        k += 1
    found = classes.withColumnRenamed("set_key", "ck")
    if roots is not None:
        found = found.join(roots.withColumnRenamed("rep", "n"), F.col("rep") == F.col("n"), "left").select(
            "ck", F.coalesce("root", "rep").alias("rep"))
    out = signed.select("id", "set_key", "n_shingles").join(found, F.col("set_key") == F.col("ck"), "left")
    return out.select("id", "set_key", "n_shingles",
                      F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each component stays, that with the smallest id."""
    verdict = near_duplicates(docs, doc_id=doc_id, **options)
    gone = verdict.where("id <> component_id").select(F.col("id").alias("gone_id")).distinct()
    gone = stage(gone, f"{new_run_dir(docs.sparkSession, 'minmax')}/gone")
    own_id = field("row", doc_id).cast("long")
    rows = maybe_among(packed(docs), own_id, gone)
    # Rows that surely stay are not shuffled.
    tested = rows.where("maybe").join(gone, own_id == F.col("gone_id"), "left_anti")
    kept = rows.where("NOT maybe").unionByName(tested)
    return kept.select(*[field("row", c).alias(c) for c in docs.columns])


ship_by_value(__name__)
