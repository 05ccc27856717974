"""Near-duplicate groups by circulant MinHash, with exact confirmation on full shingle sets.

Two permutations give all signature coordinates: the first scatters shingle hashes over a universe,
the second, circularly shifted by k, gives coordinate k as the least value over a set. The values
that a shingle meets under all shifts stand side by side in memory, so a signature is one gather and
one minimum. ``BANDS`` bands of ``ROWS`` coordinates find candidates; a pair of sets at similarity
0.8 is missed with probability (1 - 0.8 ** ROWS) ** BANDS, below 1e-8. A link holds only if the full
sets of 64-bit shingle hashes meet the threshold.

Scale: equal sets are one node, so exact copies cost nothing. No pairs of a bucket are written out:

1. Every node is compared with two centres, the best connected member of all its buckets, which
   names its family, and the member with which it shares most bands. Near copies of one text fall
   together in this step, however many they are.
2. A family that did not fall together wholly is compared in blocks bounded by the bytes of their
   sets. A task holds two blocks, looks at pairs of different labels only, and returns no more links
   than it has members.
3. Pairs across families are left where a bucket's members still carry different labels. Sizes too far
   apart or signatures that rule the threshold out (six standard errors) pass them over. First the best
   pair of any two labels in a bucket is confirmed, then, after relabelling, each pair left: nothing is
   capped.

Texts cross one exchange, and only sets of nodes that share a bucket are kept.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import map_batches, prepare, set_aside, stored, table, without_broadcasts

ROWS, BANDS = 4, 36
COORDINATES = ROWS * BANDS
UNIVERSE = 1 << 20
#: Members of a block in the comparison of mixed buckets, and bytes of sets of one in a family.
BLOCK = 1024
BLOCK_BYTES = 8 << 20
WORDS = 4
PERCENT = 80
U = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of white space among bytes, the second permutation with its wrapped end, as windows."""
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    second = np.random.default_rng(20).permutation(UNIVERSE).astype(np.uint32)
    wrapped = np.concatenate([second, second[:COORDINATES]])
    return space, wrapped, np.lib.stride_tricks.sliding_window_view(wrapped, COORDINATES)


class Powers:
    """Powers of an odd base and of its inverse, modulo 2 ** 64, as far as needed so far."""
    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def run(b: int) -> np.ndarray:
                steps = np.full(max(2 * n, 1 << 16), b, dtype=np.uint64)
                steps[0] = 1
                return np.multiply.accumulate(steps)
            self.up, self.down = run(self.BASE), run(pow(self.BASE, -1, 1 << 64))
        return self.up, self.down


def word_hashes(text: str, powers: Powers) -> np.ndarray:
    """A hash of each word, ASCII letters in lower case, words parted by ASCII white space."""
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    if not len(codes):
        return np.empty(0, dtype=np.uint64)
    up, down = powers.upto(len(codes) + 1)
    gap = np.concatenate([[True], _tables()[0][codes], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    begins, stops = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum((codes.astype(np.uint64) + U(1)) * down[:len(codes)], dtype=np.uint64)])
    return mixed((sums[stops] - sums[begins]) * up[begins] + (stops - begins).astype(np.uint64))


def shingle_set(text: str | None, words: int, powers: Powers) -> np.ndarray:
    """Ascending distinct hashes of the text's word shingles; fewer words make one shingle."""
    h = word_hashes(text or "", powers)
    n = min(words, len(h))
    if not n:
        return h
    total = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = mixed(total * U(0x9FB21C651E98DF25) + h[i:len(h) - n + 1 + i])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The circulant MinHash coordinates of a non-empty set."""
    windows = _tables()[2]
    # first permutation: the hash itself is scattered over the universe, then moved by an odd factor
    places = (shingles * U(0xD6E8FEB86659FD93) >> U(44)).astype(np.int64)
    least = windows[places[:256]].min(axis=0)
    for at in range(256, len(places), 256):
        np.minimum(least, windows[places[at:at + 256]].min(axis=0), out=least)
    return least


def band_hashes(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        h = mixed(h * U(0x9FB21C651E98DF25) + rows[:, i])
    return h.view(np.int64)


def set_hash(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands, coordinates); node is the set's hash, null for empty sets."""
    def make():
        powers = Powers()

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            n, nodes, bands, coordinates = [], [], [], []
            for text in rows.column(1).to_pylist():
                shingles = shingle_set(text, words, powers)
                n.append(len(shingles))
                if len(shingles):
                    least = signature(shingles)
                    nodes.append(set_hash(shingles))
                    bands.append(band_hashes(least))
                    coordinates.append(least.astype(np.uint8).tobytes())
                else:
                    nodes.append(None)
                    bands.append(None)
                    coordinates.append(None)
            return pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(coordinates, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "node", "bands", "coordinates"])
        return batch
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                   F.xxhash64("text").alias("text_hash")), make,
                       "doc_id long, text_hash long, n_shingles long, node long, bands array<long>, coordinates binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component of links (a, b).

    Each round takes the least label among neighbours and then the label of that label, so paths
    shrink by doubling; it ends when nothing changes.
    """
    edges = stored(links.unionByName(links.selectExpr("b as a", "a as b")).distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        moved = stored(labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                        F.least("label", "near").alias("label")), "labels")
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stored(moved.join(jump, "label").select("node", "old", F.col("further").alias("label")), "labels")
        if after.filter("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have intersection * 100 >= percent * union."""
    def make():
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            a, b = [], []
            for x, y, left, right in zip(*(rows.column(c).to_pylist() for c in range(4))):
                s, t = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
                both = len(s) + len(t)
                common = both - len(np.unique(np.concatenate([s, t])))
                if 100 * common >= percent * (both - common):
                    a.append(x)
                    b.append(y)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        return batch
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    # the first join deals the pairs by their own members, the second meets centres that many share
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return map_batches(joined, make, "a long, b long")


def centres(buckets: DataFrame) -> DataFrame:
    """(node, family, nearest): the best connected member of all its buckets, and the centre with
    which it shares most bands, null if it is the centre of each of its buckets."""
    size = buckets.groupBy("band").agg(F.count("*").alias("size"))
    degree = buckets.join(size, "band").groupBy("node").agg(F.sum("size").alias("degree"))
    known = buckets.join(degree, "node")
    centre = known.groupBy("band").agg(F.max(F.struct("degree", "node")).alias("centre"))
    near = (known.join(centre, "band").groupBy("node", "centre").agg(F.count("*").alias("shared")))
    other = F.when(F.col("node") != F.col("centre.node"), F.struct("shared", "centre"))
    best = near.groupBy("node").agg(F.max("centre").alias("top"), F.max(other).alias("best"))
    return best.select("node", F.col("top.node").alias("family"), F.col("best.centre.node").alias("nearest"))


def star_pairs(centred: DataFrame) -> DataFrame:
    """(a, b): every node with its family's centre and with its nearest centre."""
    return (centred.select(F.col("node").alias("a"), F.explode(F.array_distinct(F.array("family", "nearest"))).alias("b"))
            .filter("b is not null and a <> b"))


def _within(percent: int):
    """Links between different labels of one block pair of a family; groups arrive one after the other."""
    def group(rows: list[tuple]) -> list[tuple[int, int]]:
        own = rows[0][4] == rows[0][5]
        first = np.array([r[3] == rows[0][4] for r in rows])
        parts = [np.frombuffer(r[2], dtype=np.uint64) for r in rows]
        sizes = np.array([len(p) for p in parts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        names, ids = np.unique(np.concatenate(parts), return_inverse=True)
        labels, roots = np.unique([r[1] for r in rows], return_inverse=True)
        main = np.bincount(roots).argmax()
        root, held, found = roots.copy(), np.zeros(len(names), dtype=bool), []
        for i in np.flatnonzero(roots != main):
            facing = np.ones(len(rows), dtype=bool) if own else first != first[i]
            if not (facing & (root != root[i])).any():
                continue
            mine = ids[starts[i]:starts[i] + sizes[i]]
            held[mine] = True
            common = np.add.reduceat(held[ids].astype(np.int64), starts)
            held[mine] = False
            linked = facing & (100 * common >= percent * (sizes + sizes[i] - common))
            for j in np.flatnonzero(linked):
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    found.append((rows[i][0], rows[j][0]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None

        def packed():
            found = group(rows)
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                               pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in range(7))):
                mark = (key, row[4], row[5])
                if mark != at and rows:
                    yield packed()
                    rows = []
                at = mark
                rows.append(row)
        if rows:
            yield packed()
    return run


def family_links(centred: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside families whose members carry different labels, enough to join what is linked."""
    marked = (centred.join(labels, "node", "left")
              .select("family", "node", F.coalesce("label", "node").alias("label")).join(sets, "node"))
    total = (marked.groupBy("family").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                          F.sum(F.length("shingles")).alias("bytes")).filter("low <> high"))
    rows = (marked.join(total.select("family", F.ceil(F.col("bytes") / BLOCK_BYTES).alias("blocks")), "family")
            .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("family", "node", "label", "shingles", "block",
                    F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
            .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node"))
    return rows.mapInArrow(_within(percent), "a long, b long")


def _compare(percent: int, best_only: bool):
    """Compare the members of each block pair; groups arrive one after the other."""
    least_share = percent / 100 - 6 * (percent / 100 * (1 - percent / 100) / COORDINATES) ** 0.5

    def group(rows: list[tuple]) -> list[tuple[int, int]]:
        nodes = np.array([r[0] for r in rows])
        labels = np.array([r[1] for r in rows])
        sizes = np.array([r[2] for r in rows])
        families = np.array([r[7] for r in rows])
        marks = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8).reshape(len(rows), COORDINATES)
        own, left, right = rows[0][5] == rows[0][6], [], []
        block = np.array([r[4] for r in rows])
        first = np.flatnonzero(block == rows[0][5])
        second = first if own else np.flatnonzero(block == rows[0][6])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, i in enumerate(first):
            others = second[n + 1:] if own else second
            fits = others[(labels[others] != labels[i]) & (families[others] != families[i])
                          & (100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))]
            if not len(fits):
                continue
            shared = (marks[fits] == marks[i]).sum(axis=1)
            for j, s in zip(fits[shared >= least_share * COORDINATES], shared[shared >= least_share * COORDINATES]):
                pair = (int(nodes[i]), int(nodes[j]))
                if best_only:
                    key = tuple(sorted((int(labels[i]), int(labels[j]))))
                    best[key] = max(best.get(key, (-1, 0, 0)), (int(s), *pair))
                else:
                    left.append(pair[0])
                    right.append(pair[1])
        return [p[1:] for p in best.values()] if best_only else list(zip(left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, at = [], None

        def packed():
            found = group(rows)
            return pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()),
                                               pa.array([max(p) for p in found], pa.int64())], names=["a", "b"])
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in range(9))):
                mark = (key, row[5], row[6])
                if mark != at and rows:
                    yield packed()
                    rows = []
                at = mark
                rows.append(row)
        if rows:
            yield packed()
    return run


def mixed_pairs(buckets: DataFrame, labels: DataFrame, details: DataFrame, percent: int,
                best_only: bool) -> DataFrame:
    """Pairs of different labels and families that share a bucket and that the signatures do not rule out."""
    marked = (buckets.join(labels, "node", "left")
              .select("band", "node", F.coalesce("label", "node").alias("label")))
    mixed_bands = (marked.join(details.select("node", "family"), "node").groupBy("band")
                   .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"),
                        F.min("family").alias("one"), F.max("family").alias("another"))
                   .filter("low <> high and one <> another"))
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = (marked.join(mixed_bands.select("band", blocks.alias("blocks")), "band")
            .join(details, "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("band", "node", "label", "n_shingles", "coordinates", "block",
                    F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "family")
            .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node"))
    return rows.mapInArrow(_compare(percent, best_only), "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Words are parted by ASCII white space and compare with A-Z in lower case; a document's set holds
    its distinct shingles of ``words`` words, or the whole sequence if it has fewer. Documents link
    when 100 * intersection >= percent * union. component_id is the smallest doc_id reachable; kept
    tells doc_id = component_id. Documents that are null, empty or without words have n_shingles 0
    and link with nothing. Rows without doc_id are answered, give no group its id unless no row has one,
    and are kept in that case. Rows that repeat an id are nodes of their own. Extra columns are
    ignored; an empty table gives no rows.
    """
    return _groups(docs, words, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, label, component_id); the label of a group is one of its nodes."""
    with without_broadcasts(docs.sparkSession):
        every, grouped = _labelled(docs, words, percent)
    smallest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_node = grouped.select("node", "label").join(smallest, "label").select("node", "label", "component_id")
    return (every.select("doc_id", "text_hash", "n_shingles", "node").join(by_node, "node", "left")
           .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))))


def _labelled(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The features of all documents, and (node, first_id, label)."""
    every = stored(features(docs, words), "features")
    nodes = (every.filter("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("first_id"), F.min_by("bands", F.coalesce("doc_id", F.lit(0))).alias("bands")))
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    buckets = stored(exploded.join(shared, "band"), "buckets")
    members = stored(buckets.select("node").distinct(), "members")
    details = stored(every.join(members, "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"),
        F.max("coordinates").alias("coordinates")), "details")
    sets = stored(_full_sets(docs, details, words), "sets")

    centred = stored(centres(buckets), "centres")
    details = details.join(centred.select("node", "family"), "node")
    links = stored(confirmed(star_pairs(centred), sets, percent), "links")
    links = links.unionByName(stored(family_links(centred, components(links), sets, percent), "links"))
    labels = components(links)
    more = stored(confirmed(mixed_pairs(buckets, labels, details, percent, True), sets, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)
    last = stored(confirmed(mixed_pairs(buckets, labels, details, percent, False), sets, percent), "links")
    if not last.isEmpty():
        labels = components(links.unionByName(last))
    grouped = nodes.select("node", "first_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return every, grouped


def _full_sets(docs: DataFrame, details: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the nodes in ``details``, from the texts of their documents."""
    def make():
        powers = Powers()

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            nodes, packed = [], []
            for node, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                shingles = shingle_set(text, words, powers)
                if len(shingles) and set_hash(shingles) == node:  # rows that repeat an id may differ
                    nodes.append(node)
                    packed.append(shingles.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())],
                                              names=["node", "shingles"])
        return batch
    wanted = details.select("node", F.col("doc_id").alias("_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc_id"), "text").join(
        wanted, F.col("_doc_id").eqNullSafe(F.col("_id"))).select("node", "text")
    return map_batches(texts, make, "node long, shingles binary").dropDuplicates(["node"])


def one_per_group(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: exactly one row of each group stays, with all its columns.

    The row with the group's smallest doc_id stays (a row without an id only if no other has one); of
    rows that repeat that id, one. Rows without words belong to no group and all stay.
    """
    groups = _groups(docs, words, percent).filter("n_shingles > 0")
    docs, restored = set_aside(docs, "doc_id", "text")
    chosen = groups.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("_doc_id"),
        F.col("text_hash").alias("_text_hash"))).alias("row")).select("row._doc_id", "row._text_hash")
    blank = F.coalesce(F.col("text").rlike(r"\A[\x20\x09-\x0D]*\z"), F.lit(True))
    hashed = docs.filter(~blank).withColumn("_hash", F.xxhash64("text"))
    # the chosen rows grow with the documents: merged at every size, as they have to be at a large one
    kept = (hashed.join(chosen.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id"))
                        & (F.col("_hash") == F.col("_text_hash")))
            .dropDuplicates(["_doc_id", "_text_hash"]).select(*docs.columns))
    return restored(docs.filter(blank).unionByName(kept))


def op3_near_dedup(spark, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents by sets of 4-word shingles."""
    prepare(spark)
    return near_groups(table(spark, folder, "documents").select("doc_id", "text"))


SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
           when len(w) < 4 then [array_to_string(w, ' ')]
           else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 80 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, b.y from reach r join both_ways b on b.x = r.y),
least as (select x, min(y) as component_id from reach group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from documents join least on x = doc_id left join sizes using (doc_id)
"""
