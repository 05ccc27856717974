"""MaxScore search against brute force."""

import numpy as np
import pytest

from hexloom.llm.topk import SQL, best_in_shard, op10_topk, top_k
from tests.oracle_check import compare, connect


def brute(vectors, queries, k):
    out = []
    for qid, q in queries:
        scores = sorted((-int(np.dot(q, v)), i) for i, v in vectors if i != qid)
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("spread", [1, 300, 2 ** 28])
def test_shard_search_equals_brute_force(spread):
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread + 1, (700, 12))
    vectors[50:90] = vectors[50]
    ids = np.arange(700) * 3
    found = best_in_shard(ids[::50], vectors[::50], ids, vectors, 5)
    want = brute(list(zip(ids, vectors)), list(zip(ids[::50], vectors[::50])), 5)
    assert found == [(int(q), int(i), s) for q, _, i, s in want]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (50, [0.5, -0.25], 2), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, None, 1),
            (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1), (8, [-3.0, 4.0, 9.0], 1),
            (None, [1.0, 1.0], 1), (100, [nan, 1.0], 1), (1, [1.0, 2.0], 1), (9, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, part int")
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 50 = 0"), 3, shard_rows=3).collect()))
    pad = {i: np.array([int(np.floor(256 * x)) for x in v] + [0] * (3 - len(v))) for i, v, _ in rows
           if i is not None and v is not None and not any(x is None or not np.isfinite(x) for x in v)}
    vectors = [(i, pad[i]) for i, v, _ in rows if i in pad]
    want = brute(vectors, [(0, pad[0]), (50, pad[50])], 3)
    assert got == sorted(want)


def test_few_and_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    some = spark.createDataFrame([(0, [1.0]), (1, []), (2, [-1.0])], schema)
    assert sorted(map(tuple, top_k(some, some.filter("vec_id < 2"), 1).collect())) == [(0, 1, 1, 0), (1, 1, 0, 0)]
    assert top_k(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in top_k(df, df.filter("vec_id = 0"), 5).collect()] == [(0, 1, 1, 256 * 512)]


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op10_topk, SQL, folder) == []
