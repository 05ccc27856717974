"""Positive-unlabelled learning: held-out accuracy and edge rows."""

import random

import numpy as np

from hexloom.llm.toxicity import Model, Rows, document_grams, fit_nnpu, op1_toxicity, score_toxicity, train
from tests.oracle_check import connect


def test_risk_finds_the_hidden_positives():
    rng = np.random.default_rng(1)
    toxic = lambda: [0] + ([1] if rng.random() < 0.5 else []) + [int(rng.integers(2, 12))]
    clean = lambda: [int(rng.integers(2, 12)), int(rng.integers(2, 12))]
    positives = [toxic() for _ in range(300)]
    unlabelled = [toxic() if i % 10 == 0 else sorted(set(clean())) for i in range(2000)]
    w, b = fit_nnpu(Rows(positives, 12), Rows(unlabelled, 12), 0.1)
    z = np.array([w[r].sum() + b for r in unlabelled])
    assert ((z > 0) == (np.arange(2000) % 10 == 0)).mean() > 0.99


def test_beginnings_are_features():
    assert document_grams("Abcdefg abc") == {"abcdefg", "abcd-", "abcde-", "abcdef-", "abc"}
    assert document_grams(None) == document_grams("") == set()


def corpus(n=900):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 8 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["vilewort", "vilething", "grrk"]))
        rows.append((i, " ".join(text), "c"))
        if i % 2 == 0 or i % 16 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus()
    labels += [(0, None), (None, 1), (10 ** 9, 1)]
    rows += [(None, "vilewort here", "c"), (5000, None, "c"), (5001, "", "c"), (5002, "x " * 100_000, "c"), (0, rows[0][1], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity string")
    model = train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(rows)
    wrong = [r for r in got if r.doc_id is not None and r.doc_id < 900 and (r.toxicity >= 0.5) != (r.doc_id % 8 == 0)]
    assert len(wrong) <= 5
    assert all(0 <= r.toxicity <= 1 for r in got)
    assert all(r.toxicity < 0.5 for r in got if r.doc_id in (5000, 5001, 5002))


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert score_toxicity(docs, train(docs, none)).first().toxicity < 0.5
    assert score_toxicity(docs.limit(0), train(docs.limit(0), none)).count() == 0
    assert Model([], np.zeros((0, 1)), np.zeros(1)).scorer()("x") == 0.5


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = op1_toxicity(spark, folder).collect()
    held = {r[0]: r[1] for r in connect(folder).sql(
        "select l.doc_id, toxic from labels l join documents using (doc_id)").fetchall()}
    assert len(got) == 1000 and {r.held_out for r in got} == {True, False}
    marked = [(held[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in held]
    assert sum(t == p for t, p in marked) / len(marked) > 0.9
