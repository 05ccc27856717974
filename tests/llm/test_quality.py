"""Rule ensemble: compiled rules, lasso and held-out accuracy."""


import numpy as np
import pytest

from hexloom.llm.quality import RuleModel, covered, extract_rules, fit_lasso, op4_quality, score_quality, statistics_table, train
from tests.oracle_check import connect


def test_compiled_rules_equal_numpy(spark):
    texts = ["Good text, as it is.\nMore of it.", "BAD!! BAD!! BAD!!", None, "", "a | b | c", "x " * 60_000, "*** %% 12"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, stats string")
    stats = statistics_table(df.drop("stats")).select("doc_id", "stats.*").orderBy("doc_id").toPandas()
    names = [c for c in stats.columns if c != "doc_id"]
    x = stats[names].to_numpy(float)
    rng = np.random.default_rng(0)
    rules = [tuple((int(k), bool(rng.random() < 0.5), float(rng.choice(x[:, k]))) for k in rng.choice(len(names), 2, False))
             for _ in range(30)]
    model = RuleModel(names, rules, rng.normal(size=30), 0.3)
    got = score_quality(df, model)
    assert got.columns == ["doc_id", "text", "stats", "quality"]
    assert [r.quality for r in got.orderBy("doc_id").collect()] == pytest.approx(model.predict(x).tolist())


def test_rules_and_lasso_learn_a_conjunction():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 6))
    y = ((x[:, 1] > 0.4) & (x[:, 4] <= 0.7)).astype(float)
    rules = extract_rules(x, y, trees=15)
    w, b = fit_lasso(np.stack([covered(x, r) for r in rules], axis=1), y)
    fresh = rng.random((2000, 6))
    z = b + sum(wi * covered(fresh, r) for r, wi in zip(rules, w))
    assert ((z > 0) == ((fresh[:, 1] > 0.4) & (fresh[:, 4] <= 0.7))).mean() > 0.97
    assert (np.abs(w) > 1e-4).mean() < 0.8


def test_labels_of_one_kind_and_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, quality int")
    for labels in (none, one):
        assert all(0 < r.quality < 1 for r in score_quality(docs, train(docs, labels)).collect())
    assert score_quality(docs.limit(0), train(docs, one)).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op4_quality(spark, folder).collect()
    truth = dict(connect(folder).sql("select doc_id, quality from labels").fetchall())
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 1000 and len(held) > 30
    assert sum(a == b for a, b in held) / len(held) > 0.95
