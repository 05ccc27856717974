"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents without a confirmed label the unlabelled
text. With the class prior p (share of toxic among labelled rows), the risk of a classifier is
p * E_P[l(+)] + max(0, E_U[l(-)] - p * E_P[l(-)]); where the second part turns negative its gradient
is reversed, so a flexible model cannot explain away the positives hidden among the unlabelled.

Features are the presence of words and of word beginnings. A first pass over the bounded sample
keeps those that are clearly more frequent among positives; an L1 penalty leaves few of them. Several
classifiers are trained on disjoint parts of the unlabelled sample, and their mean scores.

Scale: one map over the texts scores them; the model (a few thousand strings) is broadcast. Sample
sizes are documented parameters, so training costs the same at every size.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import map_batches, prepare, residue, stored, table

#: Bounds of the training sample and of the features considered.
POSITIVES, UNLABELLED, FEATURES = 4000, 12000, 20000
CLASSIFIERS = 3
#: Rows with this crc32 remainder are held out.
FOLDS, HELD_OUT = 5, 0
#: Distinct words a worker remembers to hold no feature.
REMEMBERED = 100_000
WORD = re.compile(r"\w+")


def grams(word: str) -> list[str]:
    """The word and its beginnings of 4, 5 and 6 characters; beginnings end in a hyphen."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) > n)]


def document_grams(text: str | None) -> set[str]:
    return {g for w in set(WORD.findall((text or "").lower())) for g in grams(w)}


class Model:
    """Weights of the features in use and a bias, as one linear score per classifier."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray):
        self.index = {g: i for i, g in enumerate(names)}
        self.weights, self.bias = weights, bias

    def scorer(self):
        """A function from text to score that remembers neutral words."""
        index, neutral, known = self.index, set(), {}

        def score(text: str | None) -> float:
            nonlocal neutral
            used: set[int] = set()
            for word in set(WORD.findall((text or "").lower())).difference(neutral):
                hits = known.get(word)
                if hits is None:
                    hits = [index[g] for g in grams(word) if g in index]
                    if hits:
                        if len(known) < REMEMBERED:
                            known[word] = hits
                    else:
                        if len(neutral) >= REMEMBERED:
                            neutral = set()
                        neutral.add(word)
                        continue
                used.update(hits)
            z = self.bias + self.weights[sorted(used)].sum(axis=0)
            return float((1 / (1 + np.exp(-np.clip(z, -40, 40)))).mean())
        return score


def _bounded(rows: DataFrame, at_most: int, seed: str) -> DataFrame:
    """About ``at_most`` rows, chosen by a hash of the id; all of them if there are fewer."""
    n = rows.count()
    if n <= at_most:
        return rows
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(1 << 30))
    return rows.filter(place < int(at_most / n * (1 << 30)))


def training_rows(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
                  unlabelled: int = UNLABELLED) -> tuple[DataFrame, float]:
    """(doc_id, text, positive) of the bounded sample, and the class prior.

    Rows of the held-out fold are left out. An id with several labels is toxic if any of them is.
    """
    learned = residue("doc_id", FOLDS) != HELD_OUT
    marks = (labels.filter(learned & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    counts = marks.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    prior = min(max(counts["t"] / counts["n"], 1e-4), 0.9) if counts["n"] else 0.1
    positive = _bounded(marks.filter("toxic = 1").select("doc_id"), positives, "positive")
    confirmed = marks.select("doc_id", F.lit(True).alias("marked"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(learned & F.col("doc_id").isNotNull())
    free = ids.join(confirmed, "doc_id", "left").filter("marked is null").select("doc_id").distinct()
    if free.isEmpty():  # every document is labelled: all of them serve as the unlabelled text
        free = ids.distinct()
    chosen = stored(positive.withColumn("positive", F.lit(True)).unionByName(
        _bounded(free, unlabelled, "unlabelled").withColumn("positive", F.lit(False))), "toxic-sample")
    # bounded by the two sample sizes, so it may be sent to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(texts.join(F.broadcast(chosen), "doc_id"), "toxic-texts"), prior


def candidate_features(sample: DataFrame, at_most: int = FEATURES) -> list[str]:
    """Features three times as frequent among positives as among the unlabelled, and by four standard
    errors; best first."""
    def make():
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            seen = {True: Counter(), False: Counter()}
            for text, positive in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                seen[positive].update(document_grams(text))
            names = list(seen[True] | seen[False])
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[True][g] for g in names], pa.int64()),
                 pa.array([seen[False][g] for g in names], pa.int64())], names=["gram", "p", "u"])
        return batch
    totals = sample.agg(F.count_if(F.col("positive")).alias("p"), F.count_if(~F.col("positive")).alias("u")).first()
    counted = (map_batches(sample.select("text", "positive"), make, "gram string, p long, u long")
               .groupBy("gram").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter("p >= 3"))
    share = (F.col("u") + 1) / (max(totals["u"], 1) + 1)
    expected = share * totals["p"]
    lift, excess = F.col("p") / expected, (F.col("p") - expected) / F.sqrt(expected + 0.25)
    best = counted.filter((lift >= 3) & (excess >= 4)).orderBy(excess.desc(), "gram")
    return [r["gram"] for r in best.limit(at_most).collect()]


class Rows:
    """Sparse 0/1 rows: feature numbers of all rows behind one another, with each row's start."""

    def __init__(self, rows: list[list[int]], width: int):
        self.n, self.width = len(rows), width
        self.column = np.array([i for r in rows for i in r], dtype=np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n)

    def transposed(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row], minlength=self.width)


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, steps: int = 500, rate: float = 0.05,
             penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk of the sigmoid loss, by proximal Adam.

    The second part of the risk is a difference of two estimates, so it counts as negative only
    beyond three standard errors of the class prior in the unlabelled sample.
    """
    width = positive.width
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    slack = 3 * (prior * (1 - prior) / max(unlabelled.n, 1)) ** 0.5
    up, uu = prior / max(positive.n, 1), 1 / max(unlabelled.n, 1)
    for step in range(1, steps + 1):
        # sigmoid loss: l(+) = s(-z), l(-) = s(z); both have the slope s(z) s(-z)
        sp = 1 / (1 + np.exp(-np.clip(positive.times(w) + b, -30, 30)))
        su = 1 / (1 + np.exp(-np.clip(unlabelled.times(w) + b, -30, 30)))
        negative_risk = su.sum() * uu - sp.sum() * up
        slope_p, slope_u = sp * (1 - sp) * up, su * (1 - su) * uu
        grad_p, grad_u = (slope_p, -slope_u) if negative_risk < -slack else (-2 * slope_p, slope_u)
        g = np.append(positive.transposed(grad_p) + unlabelled.transposed(grad_u), grad_p.sum() + grad_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
    return w, b


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          classifiers: int = CLASSIFIERS) -> Model:
    """Fit the classifiers; without any confirmed toxic document every score is the prior."""
    sample, prior = training_rows(docs, labels, positives, unlabelled)
    names = candidate_features(sample)
    shared = docs.sparkSession.sparkContext.broadcast({g: i for i, g in enumerate(names)})

    def make():
        index = shared.value

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            used = [sorted(index[g] for g in document_grams(t) if g in index) for t in rows.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(used, pa.list_(pa.int32()))],
                                              names=["doc_id", "positive", "used"])
        return batch
    found = (map_batches(sample.select("doc_id", "text", "positive"), make,
                         "doc_id long, positive boolean, used array<int>").orderBy("doc_id", "positive").collect())
    rows_p = [r["used"] for r in found if r["positive"]]
    rows_u = [r["used"] for r in found if not r["positive"]]
    fits = [fit_nnpu(Rows(rows_p, len(names)), Rows(rows_u[k::classifiers], len(names)), prior)
            for k in range(classifiers)] if rows_p and rows_u and names else []
    if not fits:
        return Model([], np.zeros((0, 1)), np.array([np.log(prior / (1 - prior))]))
    weights = np.stack([w for w, _ in fits], axis=1)
    active = np.flatnonzero(np.abs(weights).max(axis=1) > 1e-3)
    return Model([names[i] for i in active], weights[active], np.array([b for _, b in fits]))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with toxicity, a score from 0 to 1; a null text scores as an empty one.

    Rows and columns stay as they are; a column of the new name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "toxicity"]

    def make():
        score, at = shared.value.scorer(), kept.index("text")

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            out = [score(t) for t in rows.column(at).to_pylist()]
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.float64())],
                                              names=[*rows.schema.names, "toxicity"])
        return batch
    return map_batches(docs.select(*kept), make, docs.select(*kept).schema.add("toxicity", "double"))


def op1_toxicity(spark, folder: str) -> DataFrame:
    """Score every whole text for toxicity."""
    prepare(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", (residue("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                         F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


SQL = None
