"""Lempel-Ziv fingerprints against a plain parser."""

import hashlib
import random

import numpy as np

from hexloom.llm.fingerprint import Parser, fingerprints, likeness, written


def plain_phrases(text):
    seen, phrase = [], ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.append(phrase)
            phrase = ""
    return set(seen + ([phrase] if phrase else []))


def signature(parser, text):
    """Signature from the plain phrases, each hashed alone."""
    parts = [parser.hashed(p, [len(p)]) for p in plain_phrases(text)]
    return np.unique(np.concatenate(parts))[:parser.hashes] if parts else np.empty(0, np.uint32)


def texts(n=60):
    rng = random.Random(4)
    alphabets = ["ab", "abc de", "éüß\U0001f600 x\n", "the of and "]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def test_parser_equals_plain_parse_and_continues_from_the_shared_part():
    parser = Parser()
    every = texts()
    for text, following in zip(every, every[1:]):
        own, edited, changed = parser.both(text, following)
        half = len(text) // 2
        assert edited == text[:len(text) - half] + following[:half]
        assert own.tolist() == signature(parser, text).tolist() == parser.signature(text).tolist()
        assert changed.tolist() == signature(parser, edited).tolist()


def test_likeness_bounds():
    a, none = np.arange(5, dtype=np.uint32), np.empty(0, np.uint32)
    assert likeness(a, a) == 1.0 and likeness(none, none) == 1.0 and likeness(a, none) == 0.0


def test_every_row_meets_its_successor(spark):
    every = texts() + [None, "", "x" * 200_000]
    ids = [i * 7 - 50 for i in range(len(every))]
    ids[5] = ids[4]                                   # a repeated id: ordered by text
    rows = list(zip(ids, every, ["extra"] * len(every)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, part string")
    got = fingerprints(df, parts=7).collect()
    order = sorted(((i, t or "") for i, t, _ in rows))
    parser, want = Parser(), []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        own, edited, changed = parser.both(t, following)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed),
                     likeness(own, changed), likeness(own, parser.signature(following))))
    assert sorted(map(tuple, got)) == sorted(want)


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert fingerprints(spark.createDataFrame([], schema)).count() == 0
    (row,) = fingerprints(spark.createDataFrame([(None, "abcabc")], schema)).collect()
    assert row.doc_id is None and row.near_next == 1.0
    same = fingerprints(spark.createDataFrame([(1, "ab ab"), (1, "ab ab")], schema)).collect()
    assert len(same) == 2 and len({r.fingerprint for r in same}) == 1
