"""Ranked search by K2-treap against a plain scorer."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from hexloom.llm import ranking
from hexloom.llm.ranking import SQL, Treap, op13_ranked_search, ranked, terms_of
from tests.oracle_check import compare, connect

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    big_n, big_l = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        asked = Counter(plain_terms(text))
        for (i, c), n in zip(counted, lengths):
            score = 0
            for t, times in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * n * big_n) // big_l
                    score += times * w * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("text", ["", None, "Ab9-c_d É\x85x y 日本", "a\x7fb@C[`{Z|0/9:", " É é ß "])
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("n_rows,n_columns,density", [(1, 1, 1.0), (5, 300, 0.2), (90, 40, 0.05), (64, 64, 0.9), (3, 8, 0.0)])
def test_treap_finds_the_best_columns(n_rows, n_columns, density):
    rng = np.random.default_rng(n_rows)
    grid = np.where(rng.random((n_rows, n_columns)) < density, rng.integers(1, 30, (n_rows, n_columns)), 0)
    rows, columns = np.nonzero(grid)
    tree = Treap(rows, columns, grid[rows, columns].astype(np.int64), max(1, (max(grid.shape) - 1).bit_length()))
    for k in (1, 4, 20):
        for _ in range(10):
            asked = rng.choice(n_rows, min(n_rows, 6), replace=False)
            times = rng.integers(1, 3, len(asked))
            score = times @ grid[asked]
            want = sorted((-s, c) for c, s in enumerate(score) if s > 0)[:k]
            at, found = tree.search(asked, times, k, 1)
            assert sorted(zip((-found).tolist(), at.tolist()))[:k] == want
            bound = -want[-1][0] if want else 5
            at, found = tree.search(asked, times, k, bound)
            assert sorted(zip((-found).tolist(), at.tolist()))[:k] == [w for w in want if -w[0] >= bound]


class Counted(np.ndarray):
    looked = 0

    def __getitem__(self, i):
        Counted.looked += np.size(i)
        return np.asarray(self)[i]


def test_far_cells_are_not_visited(monkeypatch):
    """A range whose bound is too low is left whole: fewer cells than the documents are looked at."""
    monkeypatch.setattr(ranking, "TOGETHER", 8)
    values = np.concatenate([np.full(4000, 2), np.full(96, 50)]).astype(np.int64)
    tree = Treap(np.zeros(4096, np.int64), np.arange(4096), values, 12)
    tree.best = tree.best.view(Counted)
    at, _ = tree.search(np.array([0]), np.array([1]), 20, 1)
    assert set(at) <= set(range(4000, 4096)) and Counted.looked < 1000


DOCS = [
    (1, "the cat sat on the mat"), (2, "The CAT the Cat the cat"), (3, None), (4, ""), (5, "... -- !"),
    (6, "dog dog dog"), (7, "the cat sat on the mat"), (7, "the cat sat on the mat"), (None, "the cat sat on the mat"),
    (None, None), (8, "é É 日本 cat42 cat"), (9, "cat " * 30000 + "w" * 100000), (10, "unrelated words only"),
    (11, "mat " + "the " * 50), *[(100 + i, "the same words stand here") for i in range(40)],
]
ITEMS = [(1, "cat mat cat"), (2, "words here"), (3, None), (4, ""), (5, "nothing"), (6, "É 日本 CAT42"), (None, "cat"),
         (7, "b cat"), (7, "a dog"), (8, "the")]


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, n int, score int, terms string"),
            spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int"))


def test_rows_equal_brute_force(spark, monkeypatch):
    asked = [x for x in ITEMS if x[0] is not None and x != (7, "b cat")]
    key = lambda r: (r[0], r[1])
    want = sorted(brute(DOCS, asked), key=key)
    docs, items = frames(spark, DOCS, ITEMS)
    assert sorted(map(tuple, ranked(docs, items).collect()), key=key) == want
    # several blocks of items, small shards, a first sample
    monkeypatch.setattr(ranking, "SAMPLE", 4)
    assert sorted(map(tuple, ranked(docs, items, item_chars=30).collect()), key=key) == want


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert ranked(frames(spark, [], [])[0], items).collect() == []
    assert ranked(docs, frames(spark, [], [])[1]).collect() == []


def test_query_matches_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op13_ranked_search, SQL, folder) == []
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert sorted(map(tuple, op13_ranked_search(spark, folder).collect())) == want
