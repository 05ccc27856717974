"""Token counts by a two-tier lookup on the map side, without a shuffle of pre-tokens.

The tokenizer splits a text into pre-tokens that it encodes one by one, so a text's count is the sum
of its pre-tokens' counts. Tier one is a broadcast table of frequent pre-tokens and their lengths,
made from a sample of whole texts. Tier two is a cache of each Python worker: a pre-token that is
in neither is encoded by the library once and remembered. Both tiers are bounded and change the
speed only; every count is exact. Texts in ASCII and Latin-1 letters (see ``PLAIN``) are split by
two expressions here; every other text, whatever its script, is normalised and split by the
tokenizer's own parts, and its pre-tokens are looked up in the same tiers. Only texts with a special
token's string are encoded whole by the library.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import map_batches, prepare, table

MODEL = "word_bpe_49k.json"
#: Texts of the sample (about so many), entries of the broadcast table, and bytes of a worker's cache.
SAMPLE_TEXTS, TABLE_SIZE, CACHE_BYTES = 2048, 65536, 64 << 20
#: Longer pre-tokens are counted anew in each batch; what an entry takes beside its characters.
KEY_CHARS, ENTRY_BYTES = 64, 96
LIMIT = 2048
#: Stands before a pre-token in the tokenizer's own writing, which holds a character for each byte.
WRITTEN = "\0"
#: Characters for which the rules below equal the library's: ASCII and the Latin-1 letters.
PLAIN = re.compile(r"[\t\n\v\f\r\x20-\x7e\xaa\xb5\xba\xc0-\xff]*")
#: The tokenizer's split pattern for plain texts in lower case; "\d" and "[^\W\d_]" are its classes
#: of numbers and letters there.
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@functools.lru_cache(2)
def load(path: str):
    """The tokenizer of a file; a worker reads it once."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counts(dict):
    """Pre-token to number of tokens: the broadcast table and, up to a bound in bytes, what the worker has met."""

    def __init__(self, tokenizer, frequent: dict[str, int], bound: int = CACHE_BYTES):
        super().__init__(frequent)
        self.tokenizer, self.model, self.frequent, self.bound = tokenizer, tokenizer.model, frequent, bound
        self.held, self.passing = 0, []

    def learn(self, pretokens: set[str]) -> None:
        """Have every pre-token of the set in the table; the library encodes what is missing."""
        for word in self.passing:
            del self[word]
        if self.held > self.bound:
            self.clear()
            self.update(self.frequent)
            self.held = 0
        missing = list(pretokens.difference(self))
        plain = [w for w in missing if w[0] != WRITTEN]
        found = self.tokenizer.encode_batch_fast(plain, add_special_tokens=False)
        self.update(zip(plain, map(len, found)))
        self.update((w, len(self.model.tokenize(w[1:]))) for w in missing if w[0] == WRITTEN)
        self.passing = [w for w in missing if len(w) > KEY_CHARS]
        self.held += sum(len(w) + ENTRY_BYTES for w in missing if len(w) <= KEY_CHARS)


def split_text(text: str, tokenizer) -> list[str]:
    """The pre-tokens of a text without special strings.

    The tokenizer writes ASCII as it stands, so such pre-tokens are the same keys in every text.
    """
    if PLAIN.fullmatch(text):
        return PRETOKEN.findall(text.lower())
    normal = tokenizer.normalizer.normalize_str(text)
    return [w if w.isascii() else WRITTEN + w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


def special_strings(tokenizer) -> re.Pattern | None:
    names = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, names))) if names else None


def count_tokens(texts: list[str | None], counts: Counts, special: re.Pattern | None) -> list[int]:
    """Numbers of tokens of whole texts."""
    split = []
    for text in texts:
        text = text or ""
        split.append(None if special and special.search(text) else split_text(text, counts.tokenizer))
    counts.learn(set().union(*filter(None, split)))
    return [len(counts.tokenizer.encode(text, add_special_tokens=False).ids) if words is None
            else sum(map(counts.__getitem__, words)) for text, words in zip(texts, split)]


def frequent_pretokens(docs: DataFrame, path: str, sample_texts: int = SAMPLE_TEXTS,
                       size: int = TABLE_SIZE) -> dict[str, int]:
    """The most frequent pre-tokens of a sample with their lengths.

    The sample has about ``sample_texts`` whole texts, drawn alike from all partitions.
    """
    def make():
        tokenizer = load(path)

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            seen = Counter()
            for text in rows.column(0).to_pylist():
                seen.update(split_text(text, tokenizer))
            kept = [w for w, n in seen.most_common(size) if n > 1 and len(w) <= KEY_CHARS]
            return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()),
                                               pa.array([seen[w] for w in kept], pa.int64())], names=["w", "n"])
        return batch
    sample = docs.select("text").sample(min(1.0, sample_texts / max(docs.count(), 1)), seed=6).filter("text is not null")
    rows = (map_batches(sample, make, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "w").limit(size).collect())
    counts = Counts(load(path), {})
    counts.learn({r["w"] for r in rows})
    return dict(counts)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """The rows with n_bytes (UTF-8), n_tokens and over_limit (n_tokens above ``limit``).

    Null and empty texts have 0 bytes and 0 tokens. Rows and columns are kept as they are; columns
    of the given table that carry the new names are replaced.
    """
    path = path or model_path()
    shared = docs.sparkSession.sparkContext.broadcast(frequent_pretokens(docs, path))
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]

    def make():
        tokenizer = load(path)
        counts, special = Counts(tokenizer, shared.value), special_strings(tokenizer)
        at = kept.index("text")

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            n = count_tokens(rows.column(at).to_pylist(), counts, special)
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(n, pa.int64())],
                                              names=[*rows.schema.names, "n_tokens"])
        return batch
    schema = docs.select(*kept).schema.add("n_tokens", "long")
    counted = map_batches(docs.select(*kept), make, schema)
    return (counted.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op6_token_counts(spark, folder: str) -> DataFrame:
    """Tokens of every whole text."""
    prepare(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


SQL = None
