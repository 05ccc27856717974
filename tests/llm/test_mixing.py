"""Weighted fair queueing against plain computations."""

import pytest

from hexloom.llm import mixing
from hexloom.llm.mixing import SQL, mix_documents, mix_sizes, op7_mixing, source_table
from tests.oracle_check import compare, connect


def filled(sizes, weights, budget, cap=3):
    """Targets by raising the level until the budget is spent."""
    open_, targets, left = dict(zip(sizes, weights)), {}, budget
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level > cap * sizes[s]]
        if not full:
            return targets | {s: w * level for s, w in open_.items()}
        for s in full:
            targets[s] = cap * sizes[s]
            left -= targets[s]
            del open_[s]
    return targets


@pytest.mark.parametrize("sizes", [[100, 3, 5, 70], [1, 1, 1], [10, 0, 5], [9000, 900, 900, 900, 900, 900], [7]])
def test_targets(spark, sizes):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(named.items())],
                               "doc_id long, source string, size long")
    got = {r.source: r.target for r in source_table(df).collect()}
    want = filled(named, [(5, 2, 1)[i % 3] for i in range(len(sizes))], sum(sizes))
    assert got == pytest.approx(want)


def test_taken_near_target_and_equal_on_reruns(spark):
    rows = [(i, None if i % 7 == 0 else f"s{i % 40 % 5}", 1 + i * 37 % 90) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    first = mix_sizes(df).collect()
    assert sorted(map(str, first)) == sorted(map(str, mix_sizes(df.repartition(7)).collect()))
    taken, target = {}, {}
    for r in first:
        assert r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert taken == pytest.approx(target, abs=3 * 91)
    assert sum(taken.values()) <= sum(r["size"] for r in first)


def test_documents_are_repeated_as_taken(spark):
    rows = [(1, "a b", "x", "k"), (1, "a b", "x", "k"), (1, "a b c", "x", "k"), (None, "q", None, "k"),
            (3, None, "y", None), (4, "", "y", "k"), (5, "w " * 5000, "z", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mix_documents(df)
    assert out.columns == df.columns
    allowed = {r[:2] for r in rows if r[1]}
    assert {tuple(r)[:2] for r in out.collect()} <= allowed
    empty = spark.createDataFrame([], df.schema)
    assert mix_documents(empty).count() == 0
    assert mix_sizes(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0


def test_repeated_rows_at_the_cut(spark, tmp_path):
    """Of equal rows as many are taken as the budget allows; SQL says the same."""
    import duckdb
    text = " ".join(["w"] * 10)
    rows = [(1, text, "a")] * 50 + [(i, text, "b") for i in range(2, 12)] + [(None, "x y", "a")] * 3 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, op7_mixing, SQL, str(tmp_path)) == []
    got = op7_mixing(spark, str(tmp_path)).collect()
    budget = sum(r["size"] for r in got)
    assert budget - 20 < sum(r.taken for r in got) <= budget
    mixed = mix_documents(df).collect()
    assert sum(len((r.text or "").split()) for r in mixed) == sum(r.taken for r in got)


def test_rows_that_tie_with_the_cut(spark):
    """Ids repeat and are null at the cut: the mixed rows are those that the sizes' decision takes."""
    rows = [(None if i % 9 == 0 else i % 40, "w " * (1 + i % 3) + "v" * (i % 2), f"s{i % 4}") for i in range(900)]
    rows += [(5, "a b", "one")] * 30 + [(None, "", "s1"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {}
    for r in mix_sizes(mixing.measured(df)).collect():
        key = (r.doc_id, r.source, r["size"])
        want[key] = want.get(key, 0) + r.copies
    got = {}
    for r in mix_documents(df).collect():
        key = (r.doc_id, r.source, len((r.text or "").split()))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_texts_are_not_exchanged(spark):
    """However many documents there are, an exchange of the mix holds no text but that of an id at a cut."""
    rows = [(i, "w " * 5, f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mix_documents(df)._jdf.queryExecution().sparkPlan().toString()
        most = plan.split("Union")[-1].split("Window")[0]  # all documents but those with the id of a cut
        assert "BroadcastHashJoin" in most and "SortMergeJoin" not in most
        assert mix_documents(df).count() == 300
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_long_texts_and_clashing_names(spark):
    names = ["_size", "_doc_id", "_source", "_s", "_copies", "_low", "_more", "size", "copies", "mix_key", "a.b"]
    rows = [(i, "w " * (200_000 if i == 3 else 5), f"s{i % 2}", *["keep"] * len(names)) for i in range(6)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    out = mix_documents(df)
    assert out.columns == df.columns
    assert out.count() and all(r[3:] == ("keep",) * len(names) for r in map(tuple, out.collect()))


def test_many_sources_are_merged(spark, monkeypatch):
    rows = [(i, f"s{i % 60}", 1 + i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    sent = sorted(map(str, mix_sizes(df).collect()))
    monkeypatch.setattr(mixing, "SENT_CHARS", 0)
    assert sorted(map(str, mix_sizes(df).collect())) == sent


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op7_mixing, SQL, folder) == []
