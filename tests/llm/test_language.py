"""Nearest-centroid language identification: vectors, accuracy and edge rows."""

import random

import numpy as np

from hexloom.llm.language import gram_counts, identify, op5_language, spherical_kmeans, train
from tests.oracle_check import connect


def test_counts_ignore_case_and_join_other_characters():
    assert (gram_counts("Ab, 12 c") == gram_counts("aB  !! C")).all()
    assert gram_counts("ab").sum() == 4 + 3 + 2 and gram_counts("12 !") is None and gram_counts(None) is None
    assert gram_counts("\U00010400 a") is not None and gram_counts("x" * 500_000).sum() > 0


def test_kmeans_separates():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(size=(50, 8)) * 0.05 + np.eye(8)[i] for i in range(3)]).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres = spherical_kmeans(rows, 3)
    assert sorted(centres.argmax(axis=1).tolist()) == [0, 1, 2]


def corpus():
    rng = random.Random(8)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["str", "ung", "sch"], "cc": ["ção", "ñe", "í"]}
    rows = []
    for i in range(240):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(20)), lang))
    return rows


def test_held_out_and_edges(spark):
    rows = corpus()
    extra = [(None, "kalomi", "aa"), (900, None, "bb"), (901, "", None), (902, "123 !?", "cc"), (903, "lomika " * 20_000, None),
             (3, rows[3][1], "aa")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").selectExpr("*", "1 as lang_score")
    got = identify(docs, train(docs)).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth)
    edge = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 900}
    assert [edge[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert edge[903].lang_pred == "aa" and edge[None].lang_pred == "aa"
    assert all(0 <= r.lang_score <= 1 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert identify(docs, train(docs)).first().lang_pred == "und"
    assert identify(docs.limit(0), train(docs.limit(0))).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(connect(folder).sql("select doc_id, lang from documents").fetchall())
    got = op5_language(spark, folder).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
