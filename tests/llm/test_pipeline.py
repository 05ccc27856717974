"""The corpus pipeline: whole runs on a fixture, and each stage against a plain version."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from hexloom.llm import pieces, quality, toxicity
from hexloom.llm.common import stored, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(40):
        text = " ".join(word() for _ in range(rng.randint(30, 60)))
        rows.append((i, text, "en", f"s{i % 3}", len(text), "x"))
    rows += [(100 + i, rows[i][1].upper(), "en", "s0", None, None) for i in range(5)]     # copies of 0 to 4
    rows += [(200, rows[7][1] + " one more", "de", "s1", 1, "y"), (300, None, None, None, None, None),
             (301, "", None, "s2", 0, "z"), (None, "no id here at all today", "en", "s1", 3, "q")]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_copies_against_all_pairs(spark, docs):
    rows = docs.collect()
    kept = cp.drop_near_copies(spark, docs, SF).collect()
    assert all(list(r.asDict()) == docs.columns for r in kept)
    ids = {r.doc_id for r in kept}
    expected = set()
    for r in rows:
        s = shingles(r.text)
        near = [o.doc_id for o in rows if s and o.doc_id is not None
                and 100 * len(s & shingles(o.text)) >= 80 * len(s | shingles(o.text))]
        if not near or r.doc_id == min(near):
            expected.add(r.doc_id)
    assert ids == expected and len(kept) == len(ids)


def test_mixing_repeats_whole_rows(spark, docs):
    before = Counter(docs.collect())
    after = Counter(cp.mix_sources(spark, docs, SF).collect())
    assert all(r in before and n <= 3 for r, n in after.items())
    words = lambda rows: sum(n * len((r.text or "").split()) for r, n in rows.items())
    assert words(after) == pytest.approx(words(before), rel=0.1)


def test_filters_follow_their_scores(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    clean = {r.doc_id for r in toxicity.score_toxicity(docs, toxicity.train(docs, labels)).collect()
             if r.toxicity < 0.5}
    good = {r.doc_id for r in quality.score_quality(docs, quality.train(docs, labels)).collect()
            if r.quality >= 0.3}
    for stage, expected in [(cp.drop_toxic, clean), (cp.keep_good, good)]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.select("doc_id").collect()} == expected
        assert 0.5 * docs.count() < len(expected) <= docs.count()


def test_encoding_is_the_encoder(spark, docs):
    encode = pieces.load().encoder()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in cp.encode(spark, docs, SF).collect():
        assert r.round_trip and r.n_ids == len(r.ids)
        assert r.ids == list(memoryview(encode(texts[r.doc_id])).cast("i"))


def test_run_equals_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
    expected = Counter((r.doc_id, r.ids_sha256) for r in docs.collect())
    assert Counter((r.doc_id, r.ids_sha256) for r in cp.run(spark, SF).collect()) == expected and expected


def test_stages_keep_columns_of_any_name(spark, docs):
    names = ["toxicity", "quality", "_size", "_hash", "_doc_id", "_source", "_text_hash", "_copies", "stats", "row", "a.b"]
    clashing = docs.drop("ids").withColumns({n: F.lit(n) for n in names})
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, clashing, SF)
        assert out.columns == clashing.columns, name
        assert all(tuple(r)[-len(names):] == tuple(names) for r in out.collect()), name


def test_blank_texts_are_those_without_words(spark):
    rows = [(1, "\u2028"), (2, "\u2028"), (3, " \t\n"), (4, " \t\n"), (5, None), (6, "\x85"), (7, "\x85")]
    kept = cp.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6]


def test_stages_take_an_empty_table(spark, docs):
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
