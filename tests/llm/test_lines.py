"""Line dedup by sorted runs against a plain dictionary and DuckDB."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from hexloom.llm.lines import SQL, LineRuns, drop_repeated_lines, line_keys, op11_line_dedup
from tests.oracle_check import compare, connect

LONG = "a line that is long enough to be looked at by all"
SCHEMA = "doc_id long, text string, source string, kept int, row_h string, drop string, h int, batch int"


def key(line):
    return re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line).encode().lower().decode()


def brute(rows, min_docs=5):
    """rows: (doc_id, text)"""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(i)
    rank = lambda i: (i is not None, i or 0)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(held.get(key(x), ())) >= min_docs and i != max(held[key(x)], key=rank) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


ROWS = [
    *[(i, f"{LONG}\nown {i}\n\t{LONG.upper()} ") for i in range(8)],
    *[(i, "É" * 40) for i in range(20, 26)], *[(i, "é" * 40) for i in range(30, 34)],
    *[(i, "x" * 39 + "\n" + "y" * 40 + "\x85") for i in range(40, 46)],
    (50, None), (51, ""), (52, "\n"), (53, LONG + "\n"), (54, "\n" + LONG),
    (None, LONG + "\nwithout id"), (None, None), (3, LONG), (3, LONG), (3, f"{LONG}\nown 3\n\t{LONG.upper()} "),
    *[(60 + i, "\n".join([LONG + " again", "w"] * 3000 + ["z" * 50000])) for i in range(6)],
    (70, "b" * 40), (71, "b" * 40), (72, "b" * 40), (73, "b" * 40),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "x", "y", 2, 3) for i, t in rows], SCHEMA)


def test_rows_equal_brute_force(spark):
    for batches, fanout in ((1, 2), (5, 2)):
        out = drop_repeated_lines(frame(spark, ROWS), batches=batches, fanout=fanout)
        assert out.columns == ["doc_id", "text", "source", "row_h", "drop", "h", "batch", "kept", "n_lines", "n_dropped"]
        got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()), key=str)
        assert got == brute(ROWS)


def test_empty_table(spark):
    assert drop_repeated_lines(frame(spark, []), batches=2).collect() == []


def test_runs_hold_each_key_once_and_merge_by_level(spark):
    runs = LineRuns(spark, fanout=2)
    texts = [[(b * 10 + i, "\n".join(f"{'line number':>40} {(b * 7 + i * 3 + k) % 25}" for k in range(5)))
              for i in range(4)] for b in range(5)]
    seen = set()
    for batch in texts:
        keys = line_keys(frame(spark, batch).select("doc_id", "text"), 1)
        mine = {tuple(r) for r in keys.select("h", "g").collect()}
        assert {(r.h, r.g) for r in runs.add(keys).collect()} == mine - seen
        seen |= mine
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    every = [(r.h, r.g) for run in runs.runs() for r in run.collect()]
    assert len(every) == len(set(every)) and set(every) == seen
    counted = {(r.h, r.g): (r.docs, r.last) for r in runs.counts().collect()}
    every = frame(spark, [r for batch in texts for r in batch]).select("doc_id", "text")
    want = line_keys(every, 1).groupBy("h", "g").agg(F.countDistinct("doc_id"), F.max("doc_id")).collect()
    assert counted == {(h, g): (n, last) for h, g, n, last in want}
    # the batch meets the runs by merge joins without an exchange of the runs
    run = runs.runs()[0]
    plan = run.join(runs.runs()[-1].hint("merge"), ["h", "g"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()


def test_query_matches_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op11_line_dedup, SQL, folder) == []
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs))
    assert sorted(map(tuple, op11_line_dedup(spark, folder).collect())) == want
