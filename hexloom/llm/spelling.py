"""Spelling variants by blocked Gram matrices of letter counts, with exact confirmation.

A word is a vector of letter counts. One inserted or deleted letter moves it by a squared distance of
1, one replaced letter by 2, so near words are found among the pairs at most 2 apart and of lengths at
most 1 apart; NumPy products of two blocks of vectors give all their squared distances at once, and
the pairs left are verified letter by letter.

Blocks: words are laid out by length and by how many of their letters fall into each of eight groups of
letters. One edit moves a word to one of few neighbouring cells of that layout, so a block meets its
own cell, the cells of equal length that one replacement reaches and those of the next length that one
insertion reaches. No near pair is lost by that, for any word. The cell's number is a weighted sum of
the letters, so a neighbour's number is a constant away.

Scale: a cell is dealt to blocks of bounded bytes, packed to one row each. A task holds one block and
streams its neighbours' blocks past it, so no group is held whole; words are counted in the map over
texts before they are shuffled. Forms are followed by pointer doubling, log2 of the longest chain.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import prepare, stored, table

MIN_LETTERS, MIN_COUNT = 7, 2
#: A form is so many times as frequent as the word.
TIMES = 10
#: One occurrence in so many (by its hash) is read with a letter missing.
SLIP = 31
RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{MIN_LETTERS},}}")
#: Words a worker counts before it hands the counts on.
HELD = 200_000
#: Groups of letters that share the load; letters from U+00C0 on follow by code.
GROUPS = ("ejx", "tbgq", "avwz", "okyp", "ifm", "nuc", "sdl", "rh")
#: Cells weigh the counts of the groups by powers of this.
BASE = 32
#: Characters of a block, with one for each word; rows of a product.
BLOCK, ROWS = 16_384, 4096


def slipped(doc_id: int | None, run: str, start: int) -> str:
    """The run of a document, lower-cased already; without one letter if its hash says so."""
    h = zlib.crc32(run.encode(), start)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words; at most HELD of them, or one text's, are held."""
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])
        held.clear()
        return rows
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            # lower-casing bytes changes A-Z only
            for run, n in Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
                word = slipped(doc_id, run, start)
                if len(word) >= MIN_LETTERS:
                    held[word] += n
            if len(held) >= HELD:
                yield out()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words with at least MIN_COUNT occurrences.

    A run shorter than MIN_LETTERS can't give a word, so such runs aren't looked at.
    """
    parts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _groups() -> list[str]:
    return [g + "".join(map(chr, range(0xC0 + i, 0x100, len(GROUPS)))) for i, g in enumerate(GROUPS)]


def cell_of(word: str) -> Column:
    """The cell's number: letters of group i count BASE ** i each."""
    size = F.char_length(F.col(word))
    return sum((size - F.char_length(F.translate(F.col(word), g, ""))).cast("long") * F.lit(BASE ** i)
               for i, g in enumerate(_groups()))


def reached() -> list[int]:
    """From a cell, the cells that hold the second word of a near pair; each pair is met from one side.

    The same cell; one letter of group i for one of group j; one letter of group i more.
    """
    unit = [BASE ** i for i in range(len(GROUPS))]
    return [0, *(unit[i] - unit[j] for i in range(len(unit)) for j in range(i)), *unit]


def matrix(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of Latin-1 words, one a line: letters, where each word starts, its length, its letter counts."""
    letters = np.frombuffer(words, dtype=np.uint8)
    ends = np.flatnonzero(letters == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - starts
    row = np.repeat(np.arange(len(ends)), sizes + 1)
    kind = np.where(letters >= 0xC0, letters.astype(np.int64) - 0xC0 + 26, letters.astype(np.int64) - 97)
    letter = letters != 10
    counts = np.bincount(row[letter] * 90 + kind[letter], minlength=len(ends) * 90).reshape(-1, 90)
    # sums of squares stay exact in single precision below 2 ** 24
    return letters, starts, sizes, counts.astype(np.float32 if sizes.max(initial=0) < 2000 else np.float64)


def one_edit(left: bytes, right: bytes) -> bool:
    """Whether the words, of lengths equal or one apart, differ by exactly one letter."""
    if len(left) > len(right):
        left, right = right, left
    first = next((i for i, (a, b) in enumerate(zip(left, right)) if a != b), len(left))
    if len(left) == len(right):
        return first < len(left) and left[first + 1:] == right[first + 1:]
    return left[first:] == right[first + 1:]


def near_pairs(a, b, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and of ``b`` (as matrix() gives them) that are one edit apart; of one block, each pair once."""
    (al, a_at, a_len, a_counts), (bl, b_at, b_len, b_counts) = a, b
    # distances from a Gram product: |x|^2 + |y|^2 - 2 x.y
    apart = (np.einsum("ij,ij->i", a_counts, a_counts)[:, None] + np.einsum("ij,ij->i", b_counts, b_counts)[None, :]
             - 2 * (a_counts @ b_counts.T))
    i, j = np.nonzero(apart <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    gap = b_len[j] - a_len[i]
    keep = (gap == 0) & (apart[i, j] == 2) | (np.abs(gap) == 1) & (apart[i, j] == 1)
    i, j, gap = i[keep], j[keep], gap[keep]
    if not len(i):
        return i, j
    swap = gap < 0
    size = np.minimum(a_len[i], b_len[j])
    width = int(size.max())
    if width > 64:
        good = np.array([one_edit(al[a_at[x]:a_at[x] + a_len[x]].tobytes(), bl[b_at[y]:b_at[y] + b_len[y]].tobytes())
                         for x, y in zip(i, j)], dtype=bool)
        return i[good], j[good]
    # letters agree up to some place, and behind it too, one further on in the longer word
    place = np.arange(width)
    inside = place < size[:, None]
    last_a, last_b = len(al) - 1, len(bl) - 1
    head = (al[np.minimum(a_at[i][:, None] + place, last_a)] == bl[np.minimum(b_at[j][:, None] + place, last_b)]) | ~inside
    a_shift, b_shift = swap.astype(int)[:, None], (gap > 0).astype(int)[:, None]
    tail = (al[np.minimum(a_at[i][:, None] + place + a_shift, last_a)]
            == bl[np.minimum(b_at[j][:, None] + place + b_shift, last_b)]) | ~inside
    first = np.where(head.all(axis=1), size, head.argmin(axis=1))
    behind = tail[:, ::-1]
    matched = np.where(behind.all(axis=1), width, behind.argmin(axis=1)) - (width - size)
    good = np.where(gap == 0, first + 1 + matched >= size, first + matched >= size)
    return i[good], j[good]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Home blocks stand before the guests of their part; guests gather up to ROWS words a product."""
    home, counts, key, waiting, words_waiting = None, None, None, [], 0

    def found(parts: list[tuple[list[str], list[int]]], same: bool) -> pa.RecordBatch | None:
        words = [w for p, _ in parts for w in p]
        n = [x for _, p in parts for x in p]
        own = matrix("".join(w + "\n" for w in words).encode("latin-1"))
        i, j = near_pairs(own, counts, same)
        if not len(i):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([words[x] for x in i], pa.string()), pa.array([n[x] for x in i], pa.int64()),
             pa.array([home[0][y] for y in j], pa.string()), pa.array([home[1][y] for y in j], pa.int64())],
            names=["a", "a_n", "b", "b_n"])
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "block", "side", "words", "counts")]
        for cell, block, side, words, n in zip(*columns):
            if (cell, block) != key:
                if waiting and (out := found(waiting, False)):
                    yield out
                key, home, counts, waiting, words_waiting = (cell, block), None, None, [], 0
            if side == 0:
                home = (words, n)
                counts = matrix("".join(w + "\n" for w in words).encode("latin-1"))
                if out := found([home], True):
                    yield out
                continue
            waiting.append((words, n))
            words_waiting += len(words)
            if words_waiting >= ROWS:
                if out := found(waiting, False):
                    yield out
                waiting, words_waiting = [], 0
    if waiting and (out := found(waiting, False)):
        yield out


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words once, from (word, n)."""
    spark = words.sparkSession
    placed = words.withColumn("cell", cell_of("word"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.sum(F.char_length("word") + 1) / F.lit(block)).alias("blocks"))
    sizes = stored(sizes, "spelling-cells")
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")))
    packed = stored(dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("word", "n")).alias("held")).select(
        "cell", "block", F.col("held.word").alias("words"), F.col("held.n").alias("counts")), "spelling-blocks")
    # a block is the guest of every block of the cells it reaches; in its own cell, of those after it
    guests = packed.select("cell", "block", "words", "counts").withColumn("step", F.explode(F.array(*map(F.lit, reached()))))
    guests = guests.select((F.col("cell") + F.col("step")).alias("cell"), F.when(F.col("step") == 0, F.col("block")).otherwise(-1).alias("from"),
                           "words", "counts").join(sizes, "cell")
    guests = guests.filter("from + 1 < blocks").select(
        "cell", F.explode(F.sequence(F.col("from") + 1, F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "words", "counts")
    both = packed.select("cell", "block", F.lit(0).alias("side"), "words", "counts").unionByName(guests)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = both.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "side")
    return met.mapInArrow(_meet, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), all of whose words have a form: the last of the chain of forms.

    Forms are more frequent than their words, so there is no circle; each round doubles the step.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are lower-cased runs of letters, some of them with a letter missing (see SLIP), of at least
    MIN_LETTERS code points and MIN_COUNT occurrences. Null and empty texts have none; a null doc_id
    counts as an empty one in the hash. Rows that repeat count again. Of near words with equal n the
    smallest in code-point order is the form. An empty table gives no rows; columns other than doc_id
    and text are ignored. Words have no length limit.
    """
    words = stored(word_counts(docs), "spelling-words")
    pairs = near_words(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best"))
    known = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= F.col("n") * times, F.struct(F.col("best.form"), (-F.col("best.less")).alias("n"))).alias("f")), "spelling-forms")
    last = roots(known.filter("f is not null").select("word", F.col("f.form").alias("form")))
    return known.join(last, "word", "left").select(
        "word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("f.n").alias("form_n"))


def op12_spelling(spark, folder: str) -> DataFrame:
    """Group the spelling variants of all whole texts: word, form, root, n, n_near, form_n."""
    prepare(spark)
    return spelling_variants(table(spark, folder, "documents"))


SQL = r"""
with recursive crc as (
  select list(c order by b) as t from (
    select b, list_reduce(list_prepend(b, range(8)),
                          lambda c, i: case when c % 2 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c
    from range(256) r(b))),
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
grouped as (select doc_id, run, count(*) as n from runs where length(run) >= 7 group by all),
hashed as (
  select run, n, xor(4294967295::bigint, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(1, len(hex(encode(s))), 2), lambda i:
        (instr('0123456789ABCDEF', hex(encode(s))[i]) - 1) * 16 + instr('0123456789ABCDEF', hex(encode(s))[i + 1]) - 1)),
      lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8))) as h
  from (select *, coalesce(doc_id::varchar, '') || ':' || run as s from grouped), crc),
slipped as (
  select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from hashed),
words as (
  select word, sum(n)::bigint as n from slipped where length(word) >= 7 group by word having sum(n) >= 2),
cut as (
  select word, n, i, word[1:i - 1] || word[i + 1:] as rest
  from (select *, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word, b.word as other, b.n as m from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, arg_min(other, (-m, other)) as form, max(m) as m from pairs group by word),
known as (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when m >= 10 * n then form end as form,
         case when m >= 10 * n then m end as form_n
  from words w left join best using (word)),
chain as (
  select word, word as root, 0 as depth from known
  union all select c.word, k.form, depth + 1 from chain c join known k on k.word = c.root where k.form is not null)
select word, form, arg_max(root, depth) as root, n, n_near, form_n
from known join chain using (word) group by all
"""
