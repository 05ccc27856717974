"""License scan against plain counting."""

import math
import random
import re

from hexloom.llm.licenses import (BLOCK, PHRASES, SHARE, SQL, TEMPLATES, Index, op8_licenses, scan_licenses,
                                  words_of)
from tests.oracle_check import compare, connect


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, step, block=BLOCK):
    w = plain_words(text)
    places = sorted((i, label) for label, p in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    matches, start = set(), 0
    while True:
        inside = set(w[start:start + block])
        for label, t in TEMPLATES:
            own = set(t.split())
            if len(own & inside) >= math.ceil(SHARE * len(own) - 1e-9):
                matches.add((label, start, len(own & inside) / len(own)))
        if start + block >= len(w):
            return w, places, matches
        start += step


def random_texts(n=150):
    rng = random.Random(5)
    rows = [text for _, text in (*PHRASES, *TEMPLATES)]
    vocabulary = sorted({w for r in rows for w in r.split()})
    out = [None, "", "...", "The MIT-License; (c) CC\nBY", "é " * 40_000 + "apache license", "mit license " * 500]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 12)):
            pick = rng.random()
            line = rng.choice(rows).split()
            if pick < 0.3:
                parts += line
            elif pick < 0.6:
                line.pop(rng.randrange(len(line)))
                parts += line
            elif pick < 0.8:
                parts += rng.choices(vocabulary, k=rng.randint(1, 60))
            else:
                parts += ["word"] * rng.randint(1, 70)
        out.append(rng.choice([" ", ", ", "\n"]).join(parts).title())
    return out


def test_scan_equals_brute_force(spark):
    texts = random_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    step = Index(PHRASES, TEMPLATES, {w: 1 for _, t in (*PHRASES, *TEMPLATES) for w in words_of(t)}).step
    for r in scan_licenses(df).collect():
        w, places, matches = brute(texts[r.doc_id], step)
        assert r.n_words == len(w)
        assert [(p.start, p.label) for p in r.places] == places
        assert {(m.label, m.start, m.containment) for m in r.matches} == matches
    assert scan_licenses(df.limit(0)).count() == 0


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), op8_licenses, SQL, folder) == []
