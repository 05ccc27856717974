"""Ranked lexical search with a K2-treap over the grid of terms and documents.

A shard of documents is a square grid: a row for each term, a column for each document, and the impact
of the term on the document's score where it occurs. The grid is halved in both directions again and
again; only cells that are not empty are stored, level by level, each with the greatest impact inside,
a mask of its children that exist and the place of the first of them. A query term is one row, that is
one path of cells down to each column. For an item, the paths of all its terms descend together over a
range of documents: the greatest impacts of the cells they stand in, summed, bound every score in the
range. Ranges are taken best first, and left when their bound lies below the k-th best score known; at
single columns the bound is the score itself.

Scale: items are taken in blocks of bounded text, so their terms can be broadcast. One map reads every
text and keeps the occurrences of these terms, as a written table that later steps read; sums over it
give the weights. A task builds shards of bounded size from its documents, one after the other, keeps
k results for each item and hands them to one ranked merge. A small sample of documents is searched
before, as its k-th best score is a bound that holds everywhere.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm.common import prepare, stored, table

K = 20
#: Characters of the items that are searched together.
ITEM_CHARS = 8 << 20
#: Documents and occurrences of a shard, ranges that descend together, documents of the sample.
SHARD_DOCS, SHARD_CELLS, TOGETHER, SAMPLE = 8192, 2_000_000, 256, 8192

#: UTF-8 bytes with A-Z lower-cased and a blank for each byte that ends a term.
SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
#: For a mask of children and a child: how many children stand before it, or -1.
BEFORE = np.array([[bin(m & ((1 << c) - 1)).count("1") if m >> c & 1 else -1 for c in range(4)] for m in range(16)],
                  dtype=np.int32)
NO_ID = np.iinfo(np.int64).max


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(SPLIT).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, lengths: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """What each occurrence adds to a score, in whole numbers."""
    m = 100 - 25 + (25 * lengths * n_docs) // all_terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Treap:
    """The grid's cells; cell 0 stands for every empty one, cell 1 is the whole grid."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, side_bits: int):
        self.depth = side_bits
        path = np.zeros(len(rows), dtype=np.int64)
        for bit in range(side_bits - 1, -1, -1):
            path = path << 2 | (rows >> bit & 1) << 1 | columns >> bit & 1
        order = np.argsort(path, kind="stable")
        path, values = path[order], values[order]
        best, mask, first = [np.zeros(1, np.int64)], [np.zeros(1, np.uint8)], [np.zeros(1, np.int32)]
        made = 1
        for level in range(side_bits + 1):
            cell = path >> 2 * (side_bits - level)
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
            best.append(np.maximum.reduceat(values, start) if len(start) else np.zeros(0, np.int64))
            made += len(start)
            if level == side_bits:
                mask.append(np.zeros(len(start), np.uint8))
                first.append(np.zeros(len(start), np.int32))
                break
            child = path >> 2 * (side_bits - level - 1)
            child_start = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]])) if len(child) else start
            parent_of = np.searchsorted(start, child_start, side="right") - 1
            head = np.flatnonzero(np.diff(parent_of, prepend=-1))
            bits = np.left_shift(1, child[child_start] & 3)
            mask.append(np.bitwise_or.reduceat(bits, head).astype(np.uint8) if len(head) else np.zeros(0, np.uint8))
            first.append((made + head).astype(np.int32))
        self.best, self.mask, self.first = map(np.concatenate, (best, mask, first))

    def search(self, rows: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) that hold the k best columns of at least ``least``; ties at the k-th stay."""
        if len(self.best) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(least, 1)
        found_at, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = np.ones((1, len(rows)), dtype=np.int32)
        bound = self.best[whole] @ times
        heap, made = [(-int(bound[0]), 0, 0, np.zeros(1, np.int64), whole, bound)], 0
        while heap and -heap[0][0] >= least:
            _, _, level, at, cells, bound = heapq.heappop(heap)
            good = bound >= least
            at, cells = at[good], cells[good]
            if level == self.depth:
                found_at, found = np.concatenate([found_at, at]), np.concatenate([found, bound[good]])
                if len(found) > k:
                    least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
                    best = found >= least
                    found_at, found = found_at[best], found[best]
                continue
            # down one level: the row's bit and either half of the range
            bit = (rows >> self.depth - level - 1 & 1) << 1
            mask, first = self.mask[cells], self.first[cells]
            halves = []
            for half in (0, 1):
                place = BEFORE[mask, bit | half]
                halves.append(np.where(place >= 0, first + place, 0))
            at = np.concatenate([at << 1, at << 1 | 1])
            cells = np.concatenate(halves)
            bound = self.best[cells] @ times
            order = np.argsort(-bound, kind="stable")
            order = order[:np.searchsorted(-bound[order], -least, side="right")]
            for low in range(0, len(order), TOGETHER):
                some = order[low:low + TOGETHER]
                made += 1
                heapq.heappush(heap, (-int(bound[some[0]]), made, level + 1, at[some], cells[some], bound[some]))
        return found_at, found


@dataclass
class Question:
    """What a search of shards needs: per term its row and weight, per item its rows and their repeats."""

    items: list[int]
    rows: list[np.ndarray]
    times: list[np.ndarray]
    row_of: np.ndarray
    weights: np.ndarray
    n_docs: int
    all_terms: int
    least: list[int]


def _occurrences(vocabulary):
    """doc_id, n (terms of the text with repeats), and the vocabulary's terms in it with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            lengths, ends, terms, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                lengths.append(len(words))
                for word, n in Counter(words).items():
                    if word in known:
                        terms.append(known[word])
                        counts.append(n)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "counts"])
    return run


def _search(question, k: int):
    """Shard after shard, with the k best documents of each item so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = question.value
        nothing = np.zeros(0, np.int64)
        best = [(nothing, nothing) for _ in q.items]
        least = list(q.least)

        def shard(parts: list[tuple[np.ndarray, ...]]) -> None:
            ids, lengths, sizes, terms, tf = (np.concatenate(x) for x in zip(*parts))
            doc = np.repeat(np.arange(len(ids)), sizes)
            rows = q.row_of[terms]
            # documents side by side whose most repeated term is the same, so a range has one language
            order = np.lexsort((rows, -tf, doc))
            lead = np.zeros(len(ids), np.int64)
            head = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
            lead[doc[head]] = rows[head] + 1
            columns = np.lexsort((lengths, lead))
            column_of = np.empty(len(ids), np.int64)
            column_of[columns] = np.arange(len(ids))
            values = impacts(q.weights[terms], tf, lengths[doc], q.n_docs, q.all_terms)
            some = values > 0
            bits = max(1, int(max(len(ids), len(q.row_of)) - 1).bit_length())
            tree = Treap(rows[some], column_of[doc[some]], values[some], bits)
            for i in range(len(q.items)):
                at, score = tree.search(q.rows[i], q.times[i], k, least[i])
                if len(at):
                    all_ids = np.concatenate([best[i][0], ids[columns[at]]])
                    scores = np.concatenate([best[i][1], score])
                    top = np.lexsort((all_ids, -scores))[:k]
                    best[i] = (all_ids[top], scores[top])
                    if len(top) == k:
                        least[i] = max(least[i], int(scores[top[-1]]))
        parts, docs, cells = [], 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                some = batch.slice(low, 64)
                terms, tf = some.column(2), some.column(3)
                parts.append((some.column(0).fill_null(NO_ID).to_numpy(), some.column(1).to_numpy(),
                              terms.value_lengths().to_numpy(), terms.flatten().to_numpy(),
                              tf.flatten().to_numpy().astype(np.int64)))
                docs, cells = docs + some.num_rows, cells + len(parts[-1][3])
                if docs >= SHARD_DOCS or cells >= SHARD_CELLS:
                    shard(parts)
                    parts, docs, cells = [], 0, 0
        if parts:
            shard(parts)
        item = np.repeat(np.array(q.items, dtype=np.int64), [len(b[0]) for b in best])
        ids = np.concatenate([nothing, *(b[0] for b in best)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([nothing, *(b[1] for b in best)]))],
            names=["item_id", "doc_id", "score"])
    return run


def _block(docs: DataFrame, items: list[tuple[int, str | None]], k: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(terms_of(text)) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    found = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _occurrences(spark.sparkContext.broadcast(vocabulary)),
        "doc_id long, n long, terms array<int>, counts array<int>"), "ranking-occurrences")
    n_docs, all_terms = found.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # one row for each term of the items, whose number the block bounds
    for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    row_of = np.empty(len(df), np.int64)
    row_of[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weights = np.array([weight(n_docs, int(n)) for n in df], dtype=np.int64)
    own = [np.array([vocabulary[t] for t in c], dtype=np.int64) for c in counted]
    question = Question([i for i, _ in items], [row_of[x] for x in own],
                        [np.array(list(c.values()), dtype=np.int64) for c in counted],
                        row_of, weights, n_docs, max(all_terms, 1), [1] * len(items))
    found = found.filter(F.size("terms") > 0)
    schema = "item_id long, doc_id long, score long"
    if n_docs > 4 * SAMPLE:
        part = found.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(math.ceil(n_docs / SAMPLE))) == 0)
        seen = part.mapInArrow(_search(spark.sparkContext.broadcast(question), k), schema)
        place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc()))
        known = dict(map(tuple, seen.withColumn("place", place).filter(F.col("place") == k).select("item_id", "score").collect()))
        question.least = [known.get(i, 1) for i in question.items]
    return found.mapInArrow(_search(spark.sparkContext.broadcast(question), k), schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0.

    ``docs``: doc_id, text; ``items``: item_id, text. Null and empty texts have no terms: such a document
    is never found, such an item finds nothing. Rows that repeat a doc_id are documents of their own; a
    null doc_id counts like any other and stands last among equal scores. Items without an id take no
    part; of rows that repeat an item_id the smallest text is asked. Equal scores rank by ascending
    doc_id. Whole texts of any length are read. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = stored(items.filter("item_id is not null").groupBy(F.col("item_id").cast("long").alias("item_id"))
                   .agg(F.min("text").alias("text")), "ranking-items")
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / item_chars))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    # each block's texts are of bounded length; there are more blocks for more items
    found = [_block(docs, [tuple(r) for r in asked.filter(block == b).collect()], k) for b in range(blocks)]
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def op13_ranked_search(spark, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item, over all documents."""
    prepare(spark)
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
totals as (select count(*)::bigint as big_n, sum(len(terms))::bigint as big_l from docs where len(terms) > 0),
tfs as (
  select rid, doc_id, n, term, count(*)::bigint as tf
  from (select rid, doc_id, len(terms)::bigint as n, unnest(terms) as term from docs) group by all),
weights as (
  select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*)::bigint as df from tfs group by term), totals),
items as (
  select item_id, unnest(regexp_extract_all(translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where item_id is not null group by item_id),
asked as (select item_id, term, count(*)::bigint as times from items group by all),
scores as (
  select item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))::bigint as score
  from asked join tfs using (term) join weights using (term), totals group by item_id, rid, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
from scores where score > 0
qualify rank <= 20
"""
