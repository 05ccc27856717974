"""Quality by a sparse ensemble of rules.

Statistics of a text are Spark column expressions. On a bounded sample of labelled rows small
regression trees are boosted; every path from a root is a rule, a conjunction of thresholds on the
statistics. A logistic regression with L1 penalty weighs the rules, which leaves few of them, and
these are compiled back into Spark column expressions: scoring runs without Python.

Scale: one scan scores all texts. Of the sample only the statistics reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions.plan import once
from hexloom.llm.common import prepare, residue, table

#: Bound of the labelled sample; trees, their depth and candidate thresholds per statistic.
SAMPLE, TREES, DEPTH, CUTS = 20000, 40, 3, 48
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3


def statistics_table(docs: DataFrame) -> DataFrame:
    """The rows with a struct ``stats``: statistics of the text, each computed once.

    Ratios are 0 for a text without words, and a null text is empty. Words are parted by single
    blanks here; counts of one character come from the length that its removal takes away.
    """
    staged = (docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
              .withColumn("_words", once(F.split("_text", " "))))
    count = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("double")
    n_words, n_chars = F.size("_words").cast("double"), F.length("_text").cast("double")
    single = lambda c: n_chars - F.length(F.replace("_text", F.lit(c), F.lit("")))
    per_word = lambda c: c / n_words
    per_char = lambda c: F.when(n_chars > 0, c / n_chars).otherwise(0.0)
    values = {
        "n_words": n_words,
        "distinct": per_word(F.size(F.array_distinct("_words")).cast("double")),
        "word_length": per_word(n_chars),
        "upper": per_char(count("[A-ZÀ-Þ]")),
        "digits": per_char(count("[0-9]")),
        "symbols": per_word(count(r"[*%&$#@<>{}\\^~=]+")),
        "bars": per_word(single("|")),
        "exclaimed": per_word(count("!!")),
        "stops": per_word(single(".")),
        "commas": per_word(single(",")),
        "lines": per_word(single("\n")),
    }
    return staged.withColumn("stats", once(F.struct(*[v.alias(k) for k, v in values.items()]))).drop("_text", "_words")


class Tree:
    """A regression tree on binned statistics; grows greedily to a small depth."""

    def __init__(self, bins: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], depth: int):
        self.bins, self.target, self.cuts = bins, target, cuts
        self.rules: list[tuple[tuple[int, bool, float], ...]] = []
        self.fitted = np.zeros(len(target))
        self._grow(np.arange(len(target)), (), depth)

    def _grow(self, rows: np.ndarray, path: tuple, depth: int) -> None:
        self.fitted[rows] = self.target[rows].mean() if len(rows) else 0.0
        if path:
            self.rules.append(path)
        if not depth or len(rows) < 20:
            return
        y = self.target[rows]
        best = (1e-9, -1, -1)
        for k, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            b = self.bins[rows, k]
            n = np.cumsum(np.bincount(b, minlength=len(cuts) + 1))[:-1]
            s = np.cumsum(np.bincount(b, weights=y, minlength=len(cuts) + 1))[:-1]
            ok = (n >= 5) & (len(y) - n >= 5)
            if not ok.any():
                continue
            gain = np.where(ok, s ** 2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(len(y) - n, 1), -1)
            at = int(gain.argmax())
            best = max(best, (gain[at] - y.sum() ** 2 / len(y), k, at))
        _, k, at = best
        if k < 0:
            return
        low = self.bins[rows, k] <= at
        cut = float(self.cuts[k][at])
        self._grow(rows[low], (*path, (k, True, cut)), depth - 1)
        self._grow(rows[~low], (*path, (k, False, cut)), depth - 1)


def covered(x: np.ndarray, rule: tuple) -> np.ndarray:
    """Rows that meet every condition: statistic <= cut, or > cut."""
    out = np.ones(len(x), dtype=bool)
    for k, low, cut in rule:
        out &= (x[:, k] <= cut) if low else (x[:, k] > cut)
    return out


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[tuple]:
    """Distinct paths of boosted trees on random halves of the rows."""
    rng = np.random.default_rng(0)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    z, rules = np.zeros(len(y)), {}
    for _ in range(trees):
        some = rng.permutation(len(y))[:max(len(y) // 2, min(len(y), 200))]
        residual = y - 1 / (1 + np.exp(-z))
        tree = Tree(bins[some], residual[some], cuts, depth)
        for rule in tree.rules:
            rules.setdefault(tuple(sorted(rule)), None)
        leaves = [r for r in tree.rules if not any(len(o) > len(r) and o[:len(r)] == r for o in tree.rules)]
        for rule in leaves:
            rows = covered(x, rule)
            if rows.any():
                p = 1 / (1 + np.exp(-z[rows]))
                z[rows] += 0.5 * np.clip((y[rows] - p).sum() / max((p * (1 - p)).sum(), 1e-3), -4, 4)
    return list(rules)


def fit_lasso(x: np.ndarray, y: np.ndarray, penalty: float = 3e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with L1 penalty, by accelerated proximal steps."""
    n, width = x.shape
    x = x.astype(np.float32)
    w, b = np.zeros(width), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t = w.copy(), b, 1.0
    # the largest curvature: a quarter of the largest eigenvalue, by power iteration
    probe = np.ones(width + 1)
    for _ in range(20):
        forward = x @ probe[:-1].astype(np.float32) + probe[-1]
        probe = np.append(x.T @ forward, forward.sum()).astype(float)
        top = np.linalg.norm(probe)
        probe /= max(top, 1e-12)
    rate = 4 * n / max(top, 1e-12)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v.astype(np.float32) + c, -30, 30)))
        g = (p - y) / n
        new = v - rate * (x.T @ g.astype(np.float32))
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        level = c - rate * g.sum()
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / after * (new - w), level + (t - 1) / after * (level - b)
        w, b, t = new, level, after
    return w, b


class RuleModel:
    """Rules with weights and an intercept, over named statistics."""

    def __init__(self, names: list[str], rules: list[tuple], weights: np.ndarray, intercept: float):
        self.names, self.rules, self.weights, self.intercept = names, rules, weights, intercept

    def column(self, stats: str = "stats") -> Column:
        """The score as a Spark expression over the struct of statistics.

        The rules are elements of an array, which generated code evaluates in methods of bounded size; one
        sum over all of them would be a single very large method.
        """
        given = []
        for rule, weight in zip(self.rules, self.weights):
            met = F.lit(True)
            for k, low, cut in rule:
                value = F.col(f"{stats}.{self.names[k]}")
                met = met & ((value <= cut) if low else (value > cut))
            given.append(F.when(met, float(weight)).otherwise(0.0))
        start = F.lit(float(self.intercept))
        z = F.aggregate(F.array(*given), start, lambda total, x: total + x) if given else start
        return 1 / (1 + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.intercept + sum((w * covered(x, r) for r, w in zip(self.rules, self.weights)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Fit on at most about ``sample`` labelled rows outside the held-out fold.

    An id with several labels counts as good if any of them is. Without labels, with labels of
    one kind only or with too few for a rule, the model is the smoothed share of good rows.
    """
    marks = (labels.filter((residue("doc_id", FOLDS) != HELD_OUT) & F.col("doc_id").isNotNull()
                           & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality")))
    n = marks.count()
    if n > sample:
        place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30))
        marks = marks.filter(place < int(sample / n * (1 << 30)))
    # bounded by ``sample``, so it may be sent to every task
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")
    rows = statistics_table(marked).select("doc_id", "quality", "stats.*").orderBy("doc_id").toPandas()
    names = [c for c in rows.columns if c not in ("doc_id", "quality")]
    x, y = rows[names].to_numpy(float), rows["quality"].to_numpy(float)
    rules = extract_rules(x, y) if len(y) and y.min() < y.max() else []
    if not rules:
        good = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(names, [], np.zeros(0), float(np.log(good / (1 - good))))
    w, b = fit_lasso(np.stack([covered(x, r) for r in rules], axis=1), y)
    used = np.flatnonzero(np.abs(w) > 1e-4)
    return RuleModel(names, [rules[i] for i in used], w[used], b)


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The rows with quality, a score from 0 to 1; a null text scores as an empty one.

    Rows and columns stay as they are; a column of the new name is replaced.
    """
    kept = [c for c in docs.columns if c != "quality"]
    renamed = docs.select(*[F.col(c).alias(f"c_{c}") if c != "text" else F.col(c) for c in kept])
    scored = statistics_table(renamed).withColumn("c_quality", once(model.column()))
    return scored.select(*["text" if c == "text" else F.col(f"c_{c}").alias(c) for c in kept],
                         F.col("c_quality").alias("quality")).select(*kept, "quality")


def op4_quality(spark, folder: str) -> DataFrame:
    """Score every whole text for quality."""
    prepare(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_quality(docs, train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", (residue("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                         F.col("quality").alias("score"), (F.col("quality") >= THRESHOLD).cast("int").alias("predicted"))


SQL = None
