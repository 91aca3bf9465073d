"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic texts are positives; the unlabelled texts are a sample of all documents, with or without a label,
drawn without regard to it, so that positives are among them as often as in the population.
With the class prior p, the risk of a score f is estimated as

    p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)])

where the maximum keeps the estimate of the negative part from going below zero as the classifier overfits;
there, a step is taken against that part alone.  The classifiers are logistic, over presence of words and word
beginnings, under the squared loss of their probability: it is proper, and bounded, so that an error in the prior
cannot outweigh the risk of the negatives.  They are fitted with numpy on documents drawn with replacement from
the sample, and their scores are averaged; a positive that is unlabelled too is drawn as often in both.

Fitting uses bounded samples (``MAX_POSITIVES`` confirmed positives, ``MAX_UNLABELLED`` documents, each the
smallest by a hash of the id); scoring covers every whole text.

Defined cases.  A null or empty text has no words and gets the scores' intercept.  Repeated ids score each
row.  Labels of unknown documents count for nothing; of several labels for an id, toxic wins.  Without any
positive, every score is 0.  Equal texts (ties) have equal scores.  A very long text is one row's work; its
features are shares of its words.  A null id is in no label.  An empty table gives an empty table.  Other columns
come back untouched, whatever their names, but for a column ``score``, which is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_by_value

MAX_POSITIVES = 4_000
MAX_UNLABELLED = 12_000
# A word or a beginning is a feature if it is found in so many positives and its rate there lies so many
# standard errors off its rate in unlabelled texts.
MIN_Z, MIN_FOUND = 4.0, 3
MAX_FEATURES = 400
BEGINNINGS = (3, 4, 5)
CLASSIFIERS, STEPS, RATE, DECAY = 3, 300, 0.1, 1e-4
WORD = re.compile(r"\w+")


def features_of(text: str | None) -> set[str]:
    """The words of a text, and the beginnings of longer words (written with a hyphen)."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(*[{w[:k] + "-" for w in words if len(w) > k} for k in BEGINNINGS])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted(features_of(t)) for t in texts])


def telling(sample: DataFrame, n: int, m: int, most: int = MAX_FEATURES) -> DataFrame:
    """Features of the rows (positive, found) whose rate in the n positives differs from that in the m
    unlabelled texts beyond chance; the ``most`` telling ones, in order."""
    counts = sample.select("positive", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.sum(F.col("positive").cast("int")).alias("p"), F.sum((~F.col("positive")).cast("int")).alias("u"))
    both = (F.col("p") + F.col("u") + 1) / (n + m + 2)
    error = F.sqrt(both * (1 - both) * (1 / n + 1 / max(1, m)))
    z = F.abs(F.col("p") / n - F.col("u") / max(1, m)) / error
    return (counts.where(F.col("p") >= MIN_FOUND).select("feature", z.alias("z")).where(F.col("z") >= MIN_Z)
            .orderBy(F.desc("z"), "feature").limit(most))


def fit_nnpu(x_pos: np.ndarray, x_unl: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights (the intercept last) of a logistic classifier under the non-negative risk, averaged over the
    later half of the steps."""
    add = lambda x: np.hstack([x, np.ones((len(x), 1), x.dtype)])
    x_pos, x_unl = add(x_pos), add(x_unl)
    w = np.zeros(x_pos.shape[1], np.float32)
    w[-1] = np.log(prior / (1 - prior))
    m, v, mean = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    for t in range(1, steps + 1):
        s_pos, s_unl = sigmoid(x_pos @ w), sigmoid(x_unl @ w)
        g_negative = 2 * (x_unl.T @ (s_unl ** 2 * (1 - s_unl)) / len(s_unl)
                          - prior * (x_pos.T @ (s_pos ** 2 * (1 - s_pos))) / len(s_pos))
        if (s_unl ** 2).mean() >= prior * (s_pos ** 2).mean():
            g = g_negative - 2 * prior * (x_pos.T @ (s_pos * (1 - s_pos) ** 2)) / len(s_pos)
        else:
            g = -g_negative
        g = g + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        mean += w * (2 * t > steps)
    return mean / (steps - steps // 2)


def fit(positives: list, unlabelled: list, features: list[str], prior: float, seed: int = 5) -> list[tuple[dict, float]]:
    """Classifiers as (feature -> weight, intercept), each fitted on documents drawn with replacement.  A sample
    is a list of (id, feature numbers)."""
    if not positives or not unlabelled:
        return []
    def matrix(rows):
        x = np.zeros((len(rows), len(features)), np.float32)
        for r, (_, found) in enumerate(rows):
            x[r, found] = 1
        return x
    x_pos, x_unl, rng, out = matrix(positives), matrix(unlabelled), np.random.default_rng(seed), []
    place = {i: k for k, i in enumerate(dict.fromkeys(i for i, _ in positives + unlabelled))}
    at_pos, at_unl = (np.array([place[i] for i, _ in rows]) for rows in (positives, unlabelled))
    for _ in range(CLASSIFIERS):
        drawn = np.bincount(rng.integers(0, len(place), len(place)), minlength=len(place))
        p, u = (np.repeat(np.arange(len(at)), drawn[at]) for at in (at_pos, at_unl))
        if len(p) and len(u):
            w = fit_nnpu(x_pos[p], x_unl[u], prior)
        else:
            w = fit_nnpu(x_pos, x_unl, prior)
        out.append((dict(zip(features, w[:-1].tolist())), float(w[-1])))
    return out


def smallest(ids: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` distinct ids that are smallest by a hash.  A cut of the hash first leaves about twice as many,
    so that the ordering sees no more of them as the table grows."""
    ids = ids.select(F.col(column).alias("chosen_id")).distinct()
    key, span = F.pmod(F.xxhash64("chosen_id"), F.lit(1 << 40)), 2 * most / max(1, ids.count())
    return ids.where(key < F.lit(int(min(1, span) * (1 << 40)))).orderBy(key, "chosen_id").limit(most)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic", max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES):
    """Fit on the positives of ``labels`` and on a sample of all ``docs``.  The class prior is the share of
    positives among the labelled.  Returns the classifiers.  Feature counts are taken in Spark; the driver gets
    at most ``max_features`` features, the size of the model, and, per sampled text, the numbers of those it has."""
    marked = (labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("label_id"))
              .agg(F.max(toxic).alias("mark")))
    share = marked.agg(F.sum(F.when(F.col("mark") == 1, 1).otherwise(0)).alias("p"), F.count("*").alias("n")).first()
    if not share["p"]:
        return []
    chosen = (smallest(marked.where("mark = 1"), "label_id", max_positives).withColumn("positive", F.lit(True))
              .unionByName(smallest(docs, doc_id, max_unlabelled).withColumn("positive", F.lit(False))))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    texts = (texts.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen_id")))
             .dropDuplicates(["id", "positive"]).select("id", "positive", "text"))
    sample = texts.select("positive", _features("text").alias("found"))
    sizes = {r["positive"]: r["count"] for r in texts.groupBy("positive").count().collect()}
    n, m = sizes.get(True, 0), sizes.get(False, 0)
    if not n or not m:
        return []
    features = [r["feature"] for r in telling(sample, n, m, max_features).collect()]
    at = {f: k for k, f in enumerate(features)}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(at[f] for f in features_of(t) & at.keys()) for t in texts])

    rows = sorted(texts.select("id", "positive", numbers("text").alias("found")).collect(), key=lambda r: (r["id"] is None, r["id"]))
    positives = [(r["id"], r["found"]) for r in rows if r["positive"]]
    unlabelled = [(r["id"], r["found"]) for r in rows if not r["positive"]]
    prior = min(max(share["p"] / share["n"], 1e-3), 0.9)
    return fit(positives, unlabelled, features, prior)


def scored(docs: DataFrame, models: list[tuple[dict, float]], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the mean score of the classifiers (0 to 1).  The weights, at most MAX_FEATURES words a
    classifier, travel with the task."""
    known = set().union(*[set(w) for w, _ in models]) if models else set()

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        def one(text):
            found = known & features_of(text)
            return sum(1 / (1 + np.exp(-(b + sum(w[x] for x in found)))) for w, b in models) / len(models)
        return pd.Series([one(t) if models else 0.0 for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.col("`" + text + "`")))


ship_by_value(__name__)
