"""Token counts against the library."""

import random

from hexloom.llm.tokencount import (KEY_CHARS, Counts, count_tokens, frequent_pretokens, load, model_path, special_strings,
                                    split_text, token_counts)


def library(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_random_texts():
    tokenizer = load(model_path())
    counts, special = Counts(tokenizer, {}, bound=500), special_strings(tokenizer)
    rng = random.Random(9)
    letters = [chr(i) for i in [*range(0x20, 0x7f), *range(0xa0, 0x180)]] + list(
        "\t\n\r\x0b\x0c\x1c\x1f\x85 　Σσςİ́漢字😀\x00²½")
    for _ in range(3000):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))),
                 "".join(rng.choice("'sTtrevemlLdD 19_-Ééß\n") for _ in range(12)),
                 "a <|endoftext|> b<|startoftext|>"]
        assert count_tokens(texts, counts, special) == [library(tokenizer, t) for t in texts]


def test_table(spark):
    texts = [None, "", "Hello wörld's 12 <|endoftext|>", "x" * 300_000, "the cat " * 3000, "the cat", "the cat"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    tokenizer = load(model_path())
    for r in token_counts(df).collect():
        n = library(tokenizer, texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((texts[r.doc_id] or "").encode()), n > 2048)
    assert token_counts(df.limit(0)).count() == 0


WEB = ["“Quoted” — it’s 20 % of naïve café…", "日本語のテキストです。", "Привет, мир! Ёлка", "ΟΔΥΣΣΕΥΣ και Σίσυφος",
       "👩‍👩‍👧 family 🇩🇪🙂🙂", "ȩ́ é ﬁ İSTANBUL ǅ", "हिन्दी में १२३", "עברית العربية ٣", "a bc​d", "½ ² Ⅷ ㍿"]


def test_every_script_takes_the_two_tiers():
    """No text without a special string is encoded whole, and the counts are the library's."""
    tokenizer = load(model_path())
    counts, rng = Counts(tokenizer, {}), random.Random(4)
    texts = WEB + [" ".join(rng.choices(WEB, k=5)) + "".join(rng.choices("".join(WEB), k=40)) for _ in range(500)]
    whole = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert count_tokens(texts, counts, None) == whole
    assert all(w in counts for t in texts for w in split_text(t, tokenizer))
    assert split_text("don’t STOP", tokenizer)[::len(split_text("don’t STOP", tokenizer)) - 1] == ["don", "stop"]


def test_cache_is_bounded_in_bytes_and_long_pretokens_pass():
    tokenizer = load(model_path())
    counts = Counts(tokenizer, {"the": 1}, bound=10_000)
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choices("abcdef", k=9)) + " " + "z" * 5000 + " 漢" * 3 for _ in range(20)]
        assert count_tokens(texts, counts, None) == [library(tokenizer, t) for t in texts]
        assert len(counts) < 200 and sum(len(w) > KEY_CHARS for w in counts) <= 1
    counts.learn({"end"})
    assert all(len(w) <= KEY_CHARS for w in counts) and counts["the"] == 1


def test_frequent_pretokens_of_every_script(spark):
    df = spark.createDataFrame([(i, WEB[i % len(WEB)]) for i in range(60)] + [(99, None)], "doc_id long, text string")
    found, tokenizer = frequent_pretokens(df.coalesce(1), model_path()), load(model_path())
    every = {w for t in WEB for w in split_text(t, tokenizer)}
    assert set(found) == every and found["family"] == library(tokenizer, "family")
