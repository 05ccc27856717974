"""Spelling variants against a plain search over all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hexloom.llm.spelling import (
    GROUPS,
    SQL,
    _groups,
    cell_of,
    matrix,
    near_pairs,
    near_words,
    one_edit,
    op12_spelling,
    reached,
    roots,
    spelling_variants,
)
from tests.oracle_check import compare, connect


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_letter_groups_hold_every_letter_once():
    every = "".join(_groups())
    assert sorted(every) == sorted("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))))
    assert len(GROUPS) == 8


@pytest.mark.parametrize("alphabet", ["ab", "abcéß", "abcdefghijklmnopqrstuvwxyzàéÿÀ×"])
def test_block_product_equals_all_pairs(alphabet):
    rng = np.random.default_rng(len(alphabet))
    words = sorted({"".join(rng.choice(list(alphabet), rng.integers(7, 10))) for _ in range(300)} | {"a" * 70, "a" * 71, "a" * 69 + "b"})
    for longest in (64, 100):
        some = [w for w in words if len(w) <= longest]
        block = matrix("".join(w + "\n" for w in some).encode("latin-1"))
        want = {(a, b) for a in range(len(some)) for b in range(a + 1, len(some)) if is_near(some[a], some[b])}
        assert set(zip(*map(np.ndarray.tolist, near_pairs(block, block, True)))) == want
        got = set(zip(*map(np.ndarray.tolist, near_pairs(block, block, False))))
        assert got == want | {(b, a) for a, b in want}
    for a in words[:60]:
        assert all(one_edit(a.encode("latin-1"), b.encode("latin-1")) == is_near(a, b)
                   for b in words if abs(len(a) - len(b)) <= 1)


def test_every_near_pair_lies_in_cells_that_reach_each_other(spark):
    rng = np.random.default_rng(3)
    word = list("spellings" + "z" * 40)
    pairs = []
    for _ in range(400):
        at, letter = rng.integers(len(word)), chr(rng.choice([97, 110, 122, 0xE9, 0xFF, 0xC0]))
        kind = rng.integers(3)
        other = word[:at] + ([letter] if kind else []) + word[at + (kind != 2):]
        pairs.append(("".join(word), "".join(other)))
        word = other
    cells = spark.createDataFrame(pairs, "a string, b string").select(cell_of("a"), cell_of("b")).collect()
    assert all((y - x) in reached() or (x - y) in reached() for x, y in cells)


def test_blocks_of_a_large_cell_meet_once(spark):
    words = sorted({f"{a}{b}{c}tenwords" for a in "aeio" for b in "stnr" for c in "stnr"})
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in near_words(df, block=60).collect()]
    want = {(a, b) for a in words for b in words if a < b and is_near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


ROWS = [
    *[(i, "Separate separate SEPARATE seperate " * 9 + "separat Éclaircie éclaircie eclaircie") for i in range(40)],
    (50, "seperatte seperatte"), (51, "sepperatte sepperatte"), (52, None), (53, ""), (54, "short words only here"),
    (None, "seperate separates separates"), (None, "seperate"), (None, None), (50, "seperatte"), (50, "seperatte"),
    (60, ("z" * 3000 + " ") * 3 + ("z" * 2999 + " ") * 40 + "longword" * 20000), (61, "ab" * 5000 + " " + "ab" * 5000),
    (62, "under_score12separate3separate '"), (63, "日本語separate日本語 naïveté naïveté naïvetés naïvetés"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, word string, n long, cell long")


def test_rows_equal_brute_force(spark):
    assert sorted(map(tuple, spelling_variants(frame(spark, ROWS)).collect()), key=lambda r: r[0]) == brute(ROWS)
    assert spelling_variants(frame(spark, [])).collect() == []


def test_roots_follow_long_chains(spark):
    links = [(f"w{i:02}", f"w{i + 1:02}") for i in range(19)] + [("other", "w03")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {**{w: "w19" for w, _ in links}}


def test_query_matches_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op12_spelling, SQL, folder) == []
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op12_spelling(spark, folder).collect()), key=lambda r: r[0]) == brute(docs)
