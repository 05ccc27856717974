"""Lempel-Ziv phrase fingerprints and their likeness.

A text is parsed into dictionary phrases: each phrase is the longest one seen before plus one code
point. The phrases are hashed, and the smallest hashes are the signature; the share of common
hashes among the smallest of two signatures together estimates the Jaccard likeness of the phrase
sets, as compression would see it. Dictionaries are prefix-closed, so the parser moves a guessed
length up or down instead of growing each phrase from one code point, and a text's edited form
continues from the parse of the part they share.

Scale: the next document comes from one exchange of the texts. Ids are dealt to ranges by split
points from a bounded quantile summary; the first row of each range is sent to the range before it
as well, so every range sees its successor and a task streams its rows in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import prepare, table

#: Hashes of a signature.
HASHES = 64
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i below n."""
    def run(b: int) -> np.ndarray:
        steps = np.full(n, b, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    return run(BASE), run(pow(BASE, -1, 1 << 64))


class Parser:
    """Parses texts; keeps the tables of powers between texts."""

    def __init__(self, hashes: int = HASHES):
        self.hashes, self.up, self.down = hashes, *_powers(1 << 16)

    def parse(self, text: str, seen: set[str], start: int) -> list[int]:
        """Ends of the phrases of text[start:]; ``seen`` is the dictionary so far, with the empty
        phrase, and grows."""
        ends: list[int] = []
        n, guess, add, append = len(text), 1, seen.add, ends.append
        while start < n:
            phrase = text[start:start + guess]
            if phrase in seen:
                stop = start + guess
                while stop < n:
                    stop += 1
                    phrase = text[start:stop]
                    if phrase not in seen:
                        break
            else:
                shorter = phrase[:-1]
                while shorter not in seen:
                    phrase, shorter = shorter, shorter[:-1]
            guess = len(phrase)
            start += guess
            add(phrase)
            append(start)
        return ends

    def hashed(self, text: str, ends: list[int], start: int = 0) -> np.ndarray:
        """A 32-bit hash of each phrase, a function of its code points alone."""
        if not ends:
            return np.empty(0, dtype=np.uint32)
        codes = np.frombuffer(text[start:].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        if len(codes) >= len(self.up):
            self.up, self.down = _powers(2 * len(codes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * self.down[:len(codes)],
                                                                 dtype=np.uint64)])
        stops = np.asarray(ends) - start
        begins = np.concatenate([[0], stops[:-1]])
        h = (sums[stops] - sums[begins]) * self.up[begins] + (stops - begins).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(32)).astype(np.uint32)

    def smallest(self, *parts: np.ndarray) -> np.ndarray:
        """The smallest distinct hashes of all parts, ascending."""
        every = np.concatenate(parts)
        some = 2 * self.hashes
        if len(every) > some:
            found = np.unique(np.partition(every, some)[:some])
            if len(found) >= self.hashes:
                return found[:self.hashes]
        return np.unique(every)[:self.hashes]

    def both(self, text: str, following: str) -> tuple[np.ndarray, str, np.ndarray]:
        """Signature of the text, its edited form, and that form's signature."""
        half = len(text) // 2
        cut = len(text) - half
        edited = text[:cut] + following[:half]
        seen = {""}
        ends = self.parse(text[:cut], seen, 0)
        # the last phrase of the shared part may go on differently beyond it
        shared = ends[-2] if len(ends) > 1 else 0
        if len(seen) > len(ends):  # it was new, so it is no part of the dictionary yet
            seen.discard(text[shared:cut])
        common = self.hashed(text[:shared], ends[:-1])
        own, other = self.parse(text, set(seen), shared), self.parse(edited, seen, shared)
        return (self.smallest(common, self.hashed(text, own, shared)), edited,
                self.smallest(common, self.hashed(edited, other, shared)))

    def signature(self, text: str) -> np.ndarray:
        return self.smallest(self.hashed(text, self.parse(text, {""}, 0)))


def likeness(a: np.ndarray, b: np.ndarray, hashes: int = HASHES) -> float:
    """Share of common hashes among the smallest of both; 1 for two empty texts."""
    together = np.union1d(a, b)[:hashes]
    if not len(together):
        return 1.0
    return float(np.isin(together, np.intersect1d(a, b)).mean())


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def split_points(docs: DataFrame, parts: int) -> list[int]:
    """At most ``parts`` - 1 ids that divide the table into ranges of about equal rows."""
    at = [i / parts for i in range(1, parts)]
    found = docs.filter("doc_id is not null").approxQuantile("doc_id", at, 1 / (4 * parts)) if at else []
    return sorted({int(x) for x in found})


def with_successor(docs: DataFrame, parts: int) -> DataFrame:
    """(part, doc_id, text, ghost) in order of doc_id within each part; the last row of a part is a
    ghost, a copy of the first row after the part, or of the very first row."""
    points = np.array(split_points(docs, parts), dtype=np.int64)

    def dealt(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(points, ids, side="right"), pa.int64()),
                                              batch.column(0)], names=["part", "doc_id"])
    # the first row of each part: its smallest id and, of rows with that id, the smallest text hash
    firsts = (docs.select("doc_id").mapInArrow(dealt, "part long, doc_id long")
              .groupBy("part").agg(F.min("doc_id").alias("doc_id")).orderBy("part").collect())
    heads = [r["doc_id"] for r in firsts]
    before = {h: (i - 1) % len(heads) for i, h in enumerate(heads)}
    edges = np.array(heads, dtype=np.int64)

    @F.pandas_udf("array<long>")
    def places(ids):
        own = np.searchsorted(edges, ids.to_numpy(), side="right") - 1
        return pd.Series([[o, before[i]] if i in before else [o] for i, o in zip(ids, own)])
    return (docs.withColumn("_places", places("doc_id"))
            .select(F.posexplode("_places").alias("_n", "part"), "doc_id", "text")
            .withColumn("ghost", F.col("_n") > 0).drop("_n"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser = Parser()
    held: tuple | None = None

    def row(doc_id, text, following):
        own, edited, changed = parser.both(text, following)
        return [doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                own, changed]

    def finished(r, signature_next):
        return [*r[:3], written(r[3]), written(r[4]), likeness(r[3], r[4]), likeness(r[3], signature_next)]

    def packed(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                               pa.string(), pa.float64(), pa.float64()])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                   "near_next"])
    waiting: list | None = None  # a row that lacks its next document's signature
    for batch in batches:
        out = []
        for part, doc_id, text, ghost in zip(*(batch.column(c).to_pylist() for c in range(4))):
            text = text or ""
            if held is not None:
                done = row(held[0], held[1], text)
                if waiting is not None:
                    out.append(finished(waiting, done[3]))
                waiting, held = done, None
            if ghost:
                if waiting is not None:
                    out.append(finished(waiting, parser.signature(text)))
                waiting = None
            else:
                held = (doc_id, text)
        if out:
            yield packed(out)


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, with their likeness.

    The edited form replaces the last floor(n_chars / 2) code points by the first as many of the
    next document's text in the order of doc_id (after the last: the first). A null text counts as
    empty. Rows that repeat a doc_id follow one another in the order of their texts. A null doc_id
    stands before all others. One row is its own next document; an empty table gives no rows. Extra
    columns are ignored.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("doc_id"), "text")
    placed = (with_successor(rows, parts).repartition("part")
              .sortWithinPartitions("part", "ghost", "doc_id", F.coalesce("text", F.lit(""))))
    out = placed.select("part", "doc_id", "text", "ghost").mapInArrow(_in_order, SCHEMA)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != least, F.col("doc_id")))


def op2_fingerprint(spark, folder: str) -> DataFrame:
    """Fingerprints of every whole text."""
    prepare(spark)
    return fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


SQL = None
