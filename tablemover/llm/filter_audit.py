"""Interaction audit of document filters by forward-backward path counting over the lattice of filter sets.

A state of the lattice is the set of filters already applied; an edge applies one more.  What a state still
holds depends on the set and not on the order, so an edge's removals are the documents that stay in its lower
state and not in its upper one.  The number of orders that reach a state (forward) and that lead on from one
to the full set (backward) are counted by dynamic programming over the lattice.  An edge weighted by both
gives the Shapley sums, and the orders that run over an edge read their steps from it.  The work is 2^n states
and n 2^(n-1) edges per part, not n! runs.

Documents are judged once, each into a bit mask of the filters that it fails; only counts per (part, mask) meet
the lattice.  The filter of repeated texts compares SHA-256 digests, with the least id per digest found by a
partial aggregate.

Defined cases.  A null text is the empty text.  A null id is no smaller id and has none, so such a document
repeats nothing and is repeated by nothing.  Rows with the same id and text are one another's equals: none is
a repeat of the other.  A null part is the empty string.  Of several label rows of an id the highest mark
holds; a document without labels is neither good nor toxic.  Very long texts are one row's work.  An empty
table has no part, so no rows.  Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workspace import new_run_dir, stage

# All orders are reported for up to this many filters; their number is the factorial.
MOST_FILTERS = 7


@dataclass(frozen=True)
class Lattice:
    """``forward[s]``: orders of the filters in ``s``; ``backward[s]``: orders of those not in ``s``.  States are
    bit masks over the filters."""

    filters: int
    forward: list[int]
    backward: list[int]

    @classmethod
    def of(cls, n: int) -> Lattice:
        full = 2 ** n - 1
        forward, backward = [1] + [0] * full, [0] * full + [1]
        for s in range(1, full + 1):
            forward[s] = sum(forward[s & ~(1 << f)] for f in range(n) if s >> f & 1)
        for s in range(full - 1, -1, -1):
            backward[s] = sum(backward[s | 1 << f] for f in range(n) if not s >> f & 1)
        return cls(n, forward, backward)

    def edges(self) -> list[tuple[int, int, int]]:
        """(state, filter, orders that run over the edge)."""
        return [(s, f, self.forward[s] * self.backward[s | 1 << f])
                for s in range(2 ** self.filters) for f in range(self.filters) if not s >> f & 1]


def words_of(text: Column) -> Column:
    """The maximal runs outside of [\\x20\\x09-\\x0D]."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def document_filters() -> dict[str, Column]:
    """Failure conditions on ``text`` and ``words``, by letter: short, repetitive, upper case, symbols."""
    text, n = F.col("text"), F.size("words")
    upper = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct("words")) < 50 * n,
            "C": 100 * upper.cast("long") > 2 * F.char_length(text), "D": F.rlike(text, F.lit("[#$%&*|]"))}


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def failures(docs: DataFrame, id_column: str, text: str, part: str, filters: dict[str, Column] | None = None) -> DataFrame:
    """(id, part, mask, digest) of every row: bit k of the mask says that it fails the k-th of ``filters``
    (conditions on ``text`` and ``words``)."""
    filters = filters or document_filters()
    light = docs.select(_named(id_column).alias("id"), F.coalesce(_named(part).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(_named(text), F.lit("")).alias("text"))
    judged = light.withColumn("words", words_of(F.col("text")))
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(filters.values())), F.lit(0))
    return judged.select("id", "part", mask.alias("mask"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


def with_repeats(judged: DataFrame, bit: int, folder: str) -> DataFrame:
    """``judged`` with the mask's ``bit`` set where a row with a smaller id has the same digest."""
    first = judged.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Only digests with several ids matter; written and read anew, the join is free to split a hot one.
    first = stage(first.where("first < last").select(F.col("digest").alias("of"), "first"), f"{folder}/first")
    again = judged.join(first, F.col("digest") == F.col("of"), "left")
    repeats = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return again.select("id", "part", (F.col("mask") + F.when(repeats, 1 << bit).otherwise(0)).alias("mask"))


def with_marks(judged: DataFrame, labels: DataFrame, id_column: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``judged`` with ``good`` and ``toxic`` (0 or 1)."""
    marks = labels.groupBy(_named(id_column).alias("l_id")).agg(
        F.max((_named(good) == 1).cast("int")).alias("good"), F.max((_named(toxic) == 1).cast("int")).alias("toxic"))
    joined = judged.join(marks, F.col("id") == F.col("l_id"), "left")
    return joined.select("part", "mask", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def edge_counts(marked: DataFrame, names: list[str]) -> DataFrame:
    """One row per part and edge: ``state``, ``filter`` (bits and number), ``paths`` over the edge, and the counts
    at it.  ``marked`` has (part, mask, good, toxic)."""
    n = len(names)
    full, lattice = 2 ** n - 1, Lattice.of(n)
    groups = marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # A document is held by the states that share no filter with those it fails.
    states = F.filter(F.sequence(F.lit(0), F.lit(full)), lambda s: s.bitwiseAND(F.col("mask")) == 0)
    held = (groups.select("part", F.explode(states).alias("state"), "n", "good", "toxic")
            .groupBy("part", "state").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))
    # At most 2^n entries per part; the empty state holds every document, so no part is missing.
    lattices = held.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("state", F.struct("n", "good", "toxic")))).alias("at"))
    edges = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("state", "filter", "paths"), e)]) for e in lattice.edges()])
    rows = lattices.select("part", "at", F.inline(edges))

    def stay(state, what="n"):
        return F.coalesce(F.try_element_at("at", state).getField(what), F.lit(0))

    bit = F.expr("shiftleft(1, filter)")
    after = F.col("state").bitwiseOR(bit)
    every, alone = F.lit(0), F.lit(full).bitwiseXOR(bit)
    removed = stay(F.col("state")) - stay(after)
    return rows.select(
        "part", "state", "filter", "paths", stay(after).alias("kept"), removed.alias("removed"),
        (stay(every) - stay(bit) - removed).alias("redundant"), (stay(alone) - stay(F.lit(full))).alias("unique_fails"),
        (stay(F.col("state"), "good") - stay(after, "good")).alias("good_lost"),
        (stay(F.col("state"), "toxic") - stay(after, "toxic")).alias("toxic_lost"))


def with_shapley(edges: DataFrame) -> DataFrame:
    """``edges`` with the filter's removals summed over all orders: each edge counts for every path over it."""
    own = Window.partitionBy("part", "filter")
    return edges.withColumn("shapley", F.sum(F.col("removed") * F.col("paths")).over(own).cast("long"))


def order_steps(edges: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order and step, read from the edge that the order runs over at that step."""
    if len(names) > MOST_FILTERS:
        raise ValueError(f"All orders of {len(names)} filters are too many to list; the edges hold every count.")
    over: dict[tuple[int, int], list] = {}
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            over.setdefault((state, f), []).append(("".join(names[k] for k in order), step))
            state |= 1 << f
    paths = edges.sparkSession.createDataFrame([(s, f, o, k) for (s, f), steps in sorted(over.items()) for o, k in steps],
                                               "p_state int, p_filter int, filter_order string, step int")
    # At most MOST_FILTERS! * MOST_FILTERS rows: the bound of the broadcast.
    return edges.join(F.broadcast(paths), (F.col("state") == F.col("p_state")) & (F.col("filter") == F.col("p_filter"))).drop(
        "p_state", "p_filter")


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source",
          filters: dict[str, Column] | None = None, repeats: str | None = "E") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every
    order of the filters; ``repeats`` names the filter of texts that a smaller id has, None leaves it out."""
    filters = filters or document_filters()
    folder = new_run_dir(docs.sparkSession, "audit")
    names = [*filters, repeats] if repeats else list(filters)
    judged = stage(failures(docs, id_column, text, part, filters), f"{folder}/judged")
    if repeats:
        judged = with_repeats(judged, len(filters), folder)
    edges = with_shapley(edge_counts(with_marks(judged, labels), names))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return order_steps(edges, names).select("part", "filter_order", "step", *[F.col(c).cast("long") for c in counts])
