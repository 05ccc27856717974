"""Exact top-k search by integer inner product with MaxScore over shards.

Terms are the dimensions. In a shard each dimension's contribution to a query is bounded from below
and above by the shard's extreme values; measured from the lower bound, contributions are never
negative, as MaxScore needs. For each query the dimensions are ordered by their bound. Those whose
bounds together cannot lift a vector over the k-th best score known so far are non-essential: the
essential ones are traversed for all vectors of the shard, the others are probed in groups, and only
for vectors whose score so far plus the bounds left can still reach the k-th best. Shard results are
merged by one ranked window.

Scale: candidates are packed into shards and queries into blocks, both of bounded size. A block
meets every shard once, by an equi-join on the shard number, so nothing is broadcast or collected,
and a task holds one block and one shard. Work is queries x vectors by nature of an exact search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexloom.llm.common import prepare, stored, table

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
SCALE = 256
#: Dimensions probed between two comparisons with the bound.
STEP = 8


def quantised(column: str, scale: int = SCALE):
    """floor(scale * x) of every component as long; null for vectors that take no part."""
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    good = F.col(column).isNotNull() & F.forall(
        column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(good, whole)


def _pack(df: DataFrame, group: str) -> DataFrame:
    """One row per group: ids and vectors as little-endian long arrays, padded to the longest vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_group, ids, vectors = None, [], []

        def packed():
            width = max(map(len, vectors))
            data = np.zeros((len(ids), width), dtype="<i8")
            for i, v in enumerate(vectors):
                data[i, :len(v)] = v
            return pa.RecordBatch.from_pylist([{
                "part": open_group, "ids": np.array(ids, dtype="<i8").tobytes(), "width": width,
                "data": data.tobytes()}], schema=pa.schema(
                [("part", pa.int64()), ("ids", pa.binary()), ("width", pa.int32()), ("data", pa.binary())]))
        for batch in batches:
            for part, vec_id, v in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if part != open_group and ids:
                    yield packed()
                    ids, vectors = [], []
                open_group = part
                ids.append(vec_id)
                vectors.append(v)
        if ids:
            yield packed()
    ordered = df.select(group, "vec_id", "q").repartition(group).sortWithinPartitions(group, "vec_id")
    return ordered.mapInArrow(run, "part long, ids binary, width int, data binary")


def best_in_shard(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                  k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of every query's k best vectors of the shard, its own id left out.

    ``vectors`` ascends by id, so among equal scores the smaller id stands first.
    """
    width = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    columns = np.ascontiguousarray(vectors.T)
    # sums of products stay exact in double precision below 2 ** 53; larger ones use whole numbers
    reach = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(width, 1)
    kind = np.float64 if reach < 2 ** 53 else np.int64
    columns, queries = columns.astype(kind), queries.astype(kind)
    low, high = low.astype(kind), high.astype(kind)
    out = []
    for qid, q in zip(query_ids, queries):
        least, most = np.minimum(q * low, q * high), np.maximum(q * low, q * high)
        spread = most - least
        order = np.argsort(-spread, kind="stable")
        # the k-th best among a first handful of vectors starts the bound
        first = min(len(ids), 64 + k)
        seeds = q @ columns[:, :first]
        seeds = np.where(ids[:first] == qid, least.sum() - 1, seeds)
        bound = np.partition(seeds, len(seeds) - k)[len(seeds) - k] if len(seeds) > k else least.sum() - 1
        # best score still possible from the dimensions after the first n
        left = most.sum() - np.concatenate([[0], np.cumsum(most[order])])
        # essential dimensions: without them no vector can reach the bound
        gain = np.concatenate([np.cumsum(spread[order][::-1])[::-1], [0]]) + least.sum()
        essential = int(np.searchsorted(-gain, -bound, side="right"))
        essential = min(max(essential, 1), width)
        score = q[order[:essential]] @ columns[order[:essential]]
        alive = np.flatnonzero((score + left[essential] >= bound) & (ids != qid))
        score = score[alive]
        at = essential
        while at < width and len(alive):
            some = order[at:at + STEP]
            score = score + q[some] @ columns[some][:, alive]
            at += len(some)
            if len(alive) > k and at < width:
                rest = least[order[at:]].sum()
                bound = max(bound, np.partition(score, len(score) - k)[len(score) - k] + rest)
                keep = score + left[at] >= bound
                alive, score = alive[keep], score[keep]
        top = np.lexsort((ids[alive], -score))[:k]
        out += [(int(qid), int(ids[alive[i]]), int(score[i])) for i in top]
    return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype="<i8")
                q_ids = np.frombuffer(row["q_ids"], dtype="<i8")
                found = best_in_shard(
                    q_ids, np.frombuffer(row["q_data"], dtype="<i8").reshape(len(q_ids), row["q_width"]),
                    ids, np.frombuffer(row["data"], dtype="<i8").reshape(len(ids), row["width"]), k)
                columns = list(zip(*found)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of each query, ties to the smaller id.

    Both tables hold vec_id and embedding. Vectors that are null or hold null, NaN or infinite
    components take no part, nor do rows without an id; shorter vectors count as padded with zeros, empty
    ones too.
    Every query row is answered on its own id: candidates with the query's id are left out, and of
    rows that repeat an id as queries, one is asked. Rows that repeat an id as candidates all count.
    Fewer than k candidates give fewer rows; empty tables give none. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.select("vec_id", quantised("embedding").alias("q"))
                  .filter("vec_id is not null and q is not null"), "vectors")
    asked = stored(queries.select("vec_id", quantised("embedding").alias("q"))
                   .filter("vec_id is not null and q is not null")
                   .groupBy("vec_id").agg(F.min("q").alias("q")), "queries")
    shards = max(1, math.ceil(rows.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / block_rows))
    packed = _pack(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "q"), F.lit(shards))), "shard")
    asked = _pack(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "block")
    asked = asked.select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("part"),
                         F.col("ids").alias("q_ids"), F.col("width").alias("q_width"),
                         F.col("data").alias("q_data"), F.col("part").alias("block"))
    found = (packed.join(asked.hint("shuffle_merge"), "part").repartition("part", "block")
             .select("ids", "width", "data", "q_ids", "q_width", "q_data")
             .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op10_topk(spark, folder: str) -> DataFrame:
    """The 5 best vectors of every query, over the whole table of embeddings."""
    prepare(spark)
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


SQL = """
with q as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from q a join q b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
       vec_id, score
from scored
qualify rank <= 5
"""
