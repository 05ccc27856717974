"""Near-duplicate groups against all pairs of plain shingle sets."""

import random
import re

import pytest

from hexloom.llm.dedup import SQL, components, near_groups, one_per_group, op3_near_dedup
from tests.oracle_check import compare, connect


def plain_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))


def brute(rows, words, percent=80):
    sets = [plain_set(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min(rows[j][0] for j in range(len(rows)) if root(j) == root(i))
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out)


def corpus(seed=7):
    """Families of drifting copies around the threshold, exact copies and a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß", "Ü"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        text = list(base)
        for _ in range(14):
            rows.append(" ".join(text))
            if rng.random() < 0.5:
                text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    for _ in range(40):
        rows.append(" ".join([rng.choice(vocabulary) for _ in range(30)] + passage))
    rows += [None, "", " \t\n", "one", "ONE", "one two three", "one  two\nthree", "x " * 50_000, rows[3], rows[3].upper()]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("words", [4, 5])
def test_groups_equal_brute_force(spark, words):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, node string")
    assert sorted(map(tuple, near_groups(df, words).collect())) == brute(rows, words)


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d e f g", "x"), (2, "A b c d e f g", "y"), (9, None, "z"), (None, "other text here", "z"),
            (7, "", None), (5, "a b c d e f g", "x"), (2, "A b c d e f g", "y"), (None, "a b c d e f g", "y"),
            (None, "other text here", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "7", "9", "None"]
    assert one_per_group(df.limit(0)).count() == 0
    assert near_groups(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(900, 950)] + [(-5, -7)]
    random.Random(2).shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(900, 950)} == {900}
    assert got[-5] == got[-7] == -7


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op3_near_dedup, SQL, folder) == []
