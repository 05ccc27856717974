"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every document of a source, in a shuffled order that depends on its id alone, gets a virtual finish
time: the words of its source up to and including it, divided by the source's weight. A source
repeats in epochs, at most ``epochs`` of them. All (document, epoch) entries are range-sorted by
finish time and taken until the budget of words is reached. A source that ends after its last epoch
leaves the rest to the others in proportion to their weights.

Scale: no window spans a source or the whole table. Running sums come in two levels: totals per
(source, slice of the shuffle) or per slice of virtual time, running sums over these totals, and
windows inside one slice. There are as many slices as the square root of the rows, so both levels
stay small together. The table of sources is broadcast up to a checked size and merged beyond it. The
cut is a per-source table (last epoch and key), so texts are never shuffled while that table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.plan import once
from hexloom.llm.common import prepare, set_aside, stored, table

WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Up to so many characters, with 100 for each row, the table of sources is broadcast.
SENT_CHARS = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: str) -> Column:
    """The place of a document in its source's shuffled order; equal on every run."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":mix")))


def _slice(key: Column, slices: int) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * slices / F.lit(2.0 ** 32))


def _join(left: DataFrame, right: DataFrame, *keys: str, sent=lambda df: df) -> DataFrame:
    """Left join on keys that may be null; columns of the right side follow without its keys."""
    renamed = right.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(sent(renamed), same, "left").drop(*[f"_{k}" for k in keys])


def source_table(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                 epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source_size, weight, source_rank, target and the budget.

    Sources are ranked by code point, null last; targets rise in proportion to the weights until
    they reach ``epochs`` times the source's size. A source without words has target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("source_rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int")))
    full = (F.col("source_size") * epochs).cast("double")
    ranked = ranked.withColumn("ends_at", full / F.col("weight"))
    everyone = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_end = Window.partitionBy(F.lit(0)).orderBy("ends_at", "source_rank")
    ranked = (ranked
              .withColumn("budget", F.sum("source_size").over(everyone) * F.lit(share))
              .withColumn("ended", F.coalesce(F.sum(F.col("source_size") * epochs).over(
                  by_end.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("open_weight", F.sum("weight").over(
                  by_end.rowsBetween(0, Window.unboundedFollowing))))
    # the level if this source and all that end later were the open ones; the first source that
    # does not end before its level fixes the common level
    ranked = ranked.withColumn("level", (F.col("budget") - F.col("ended")) / F.col("open_weight"))
    level = F.min(F.when(F.col("level") <= F.col("ends_at"),
                         F.struct("ends_at", "source_rank", "level"))).over(everyone)["level"]
    return (ranked.withColumn("level", level)
            .select("source", "source_size", "source_rank", "weight", "budget",
                    F.when(F.col("level").isNull() | (F.col("ends_at") < F.col("level")), full)
                    .otherwise(F.col("weight") * F.col("level")).alias("target")))


def mix_sizes(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
              epochs: int = EPOCHS) -> DataFrame:
    """Decide how often each document is taken.

    ``sizes``: doc_id, source, size (words). Returns those columns with source_size, weight, target
    and taken (size times the number of epochs taken). Documents without words take 0. Rows that
    repeat an id share its place in the shuffle; among them smaller sizes come first. Equal rows are
    numbered: as many of them are taken as the budget allows, which ones makes no difference. An
    empty table gives an empty result.
    """
    rows, by_source, sent = _cuts(sizes, weights, share, epochs)
    times = _times(F.struct("mix_key", "doc_id", "size", "rid"), "mix_key", "doc_id", "size", "rid")
    return _join(rows, by_source, "source", sent=sent).select(
        "doc_id", "source", "size", "source_size", "weight", "target",
        (F.col("size") * times).cast("long").alias("taken"), times.cast("int").alias("copies"))


def _times(own: Column, *order: str) -> Column:
    """How often a row is taken, by its place before or after its source's cut."""
    limit = F.struct(*[F.col(f"cut.{c}").alias(c) for c in order])
    return F.when(F.col("cut").isNull() | (F.col("size") == 0), 0).otherwise(
        F.col("cut.epoch") + F.when(own <= limit, 1).otherwise(0))


def _cuts(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: int):
    """Rows with their place in the shuffle, the table of sources with the last entry taken of each, and how it is sent."""
    rows = stored(sizes.withColumn("mix_key", shuffle_key("doc_id")).withColumn("rid", F.monotonically_increasing_id()),
                  "mix-sizes")
    count = rows.count()
    slices = max(1, int(count ** 0.5))
    sources = stored(source_table(rows, weights, share, epochs), "mix-sources")
    chars = sources.agg(F.sum(F.coalesce(F.length("source"), F.lit(0)) + 100)).first()[0] or 0
    # a third of all rows may share a source: a small table meets them where they are
    sent = F.broadcast if chars <= SENT_CHARS else (lambda df: df)

    # 1. finish times: running words inside (source, slice), plus the slices before
    sliced = rows.filter("size > 0").withColumn("slice", _slice(F.col("mix_key"), slices))
    totals = sliced.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = totals.withColumn("before", F.coalesce(F.sum("slice_size").over(
        Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("slice_size")
    inside = (Window.partitionBy("source", "slice").orderBy("mix_key", "doc_id", "size", "rid")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = _join(_join(sliced.withColumn("inside", F.sum("size").over(inside)), before, "source", "slice"),
                   sources.drop("target"), "source", sent=sent)
    placed = placed.withColumn("upto", F.col("before") + F.col("inside"))
    entries = (placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
               .withColumn("finish", ((F.col("epoch") * F.col("source_size") + F.col("upto")).cast("double")
                                      / F.col("weight"))))
    entries = stored(entries.select("source", "source_rank", "doc_id", "size", "mix_key", "rid", "epoch", "finish",
                                    "budget"), "mix-entries")

    # 2. truncation at the budget: whole slices of virtual time first, then the slice of the cut
    top = entries.agg(F.max("finish").alias("last")).first()["last"] or 1.0
    when = F.least(F.floor(F.col("finish") / F.lit(top) * slices * epochs), F.lit(slices * epochs - 1))
    timed = entries.withColumn("time_slice", when)
    moments = timed.groupBy("time_slice").agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
    run = F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy("time_slice")
                              .rowsBetween(Window.unboundedPreceding, 0))
    cut = (moments.withColumn("upto", run).filter(F.col("upto") >= F.col("budget"))
           .orderBy("time_slice").limit(1)
           .select(F.col("time_slice").alias("cut_slice"), (F.col("upto") - F.col("words")).alias("used")).first())
    if cut is None:
        taken = timed
    else:
        order = Window.partitionBy("time_slice").orderBy(
            "finish", "source_rank", "epoch", "mix_key", "doc_id", "size", "rid")
        last = (timed.filter(F.col("time_slice") == F.lit(cut["cut_slice"]))
                .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
                            + F.lit(cut["used"]))
                .filter(F.col("upto") <= F.col("budget")).drop("upto"))
        taken = timed.filter(F.col("time_slice") < F.lit(cut["cut_slice"])).unionByName(last)

    # 3. the cut of each source: its last entry in (epoch, key) order; applied without a shuffle of texts
    cuts = taken.groupBy("source").agg(F.max(F.struct("epoch", "mix_key", "doc_id", "size", "rid")).alias("cut"))
    return rows, _join(sources, cuts, "source"), sent


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of documents."""
    return docs.select("doc_id", "source", word_count("text").alias("size"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                  epochs: int = EPOCHS) -> DataFrame:
    """The mixed corpus: the given rows, each repeated as often as it is taken, all columns kept.

    A row's place against its source's cut follows from its id and size, so no text is exchanged. Copies
    of a row are equal rows; rows that share an id but differ count as separate documents. Of rows with
    equal id, source and size, the group at a source's cut may be taken once more in part; only such
    groups, one for each source at most, are numbered.
    """
    rows, by_source, sent = _cuts(measured(docs), weights, share, epochs)
    cuts = stored(by_source.filter("cut is not null").select("source", "cut"), "mix-cuts")
    order = ("mix_key", "doc_id", "size")
    tie = F.struct(*order) == F.struct(*[F.col(f"cut.{c}").alias(c) for c in order])
    # of the rows that tie with the cut, as many are taken once more as stand before it
    more = (_join(rows.filter("size > 0"), cuts, "source", sent=sent).filter(F.col("cut").isNotNull() & tie & (F.col("rid") <= F.col("cut.rid")))
            .groupBy("source").agg(F.count(F.lit(1)).alias("more")))

    docs, restored = set_aside(docs, "doc_id", "text", "source")
    met = _join(docs, cuts, "source", sent=sent).filter("cut is not null")
    same_id = F.col("doc_id").eqNullSafe(F.col("cut.doc_id"))
    sized = lambda df: df.select("*", once(word_count("text")).alias("size"), shuffle_key("doc_id").alias("mix_key"))
    times = _times(F.struct(*order), *order)
    apart = sized(met.filter(~same_id)).withColumn("copies", times)
    close = _join(sized(met.filter(same_id)), more, "source").withColumn("tie", tie & (F.col("size") > 0))
    number = F.row_number().over(Window.partitionBy("source", "tie").orderBy("text"))
    close = close.withColumn("copies", F.when(F.col("tie"), F.col("cut.epoch") + F.when(number <= F.col("more"), 1).otherwise(0))
                             .otherwise(times)).drop("more", "tie")
    out = apart.unionByName(close).filter("copies > 0")
    return restored(out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def op7_mixing(spark, folder: str) -> DataFrame:
    """Mix all documents to weights 5, 2, 1 at 100 % of all words."""
    prepare(spark)
    out = mix_sizes(measured(table(spark, folder, "documents")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "weight")


SQL = """
with sizes as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
  from documents),
per as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source nulls last) - 1 as source_rank
  from sizes group by source),
weighed as (select *, [5, 2, 1][(source_rank % 3 + 1)::int] as weight from per),
ends as (select *, (3 * source_size)::double / weight as ends_at from weighed),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (
               order by ends_at, source_rank rows between unbounded preceding and 1 preceding), 0))::double
            / sum(weight) over (order by ends_at, source_rank rows between current row and unbounded following) as level,
         (sum(source_size) over ())::double as budget
  from ends),
targets as (
  select source, source_size, source_rank, weight, budget,
         case when lv is null or ends_at < lv then (3 * source_size)::double else weight * lv end as target
  from (select *, first_value(case when level <= ends_at then level end ignore nulls) over (
                    order by ends_at, source_rank rows between unbounded preceding and unbounded following) as lv
        from levels)),
keyed as (
  select row_number() over () as rid, s.doc_id, s.source, s.size, md5(coalesce(s.doc_id::varchar, '') || ':mix') as k,
         source_size, source_rank, weight, budget, target
  from sizes s join targets t on s.source is not distinct from t.source),
placed as (
  select *, sum(size) over (partition by source order by k, doc_id, size, rid) as upto from keyed where size > 0),
entries as (
  select p.*, e, (e * source_size + upto)::double / weight as finish from placed p, range(3) r(e)),
ordered as (
  select *, sum(size) over (order by finish, source_rank, e, k, doc_id, size, rid
                            rows between unbounded preceding and current row) as total from entries),
counts as (select rid, count(*) as n from ordered where total <= budget group by rid)
select doc_id, size, source_size, target, coalesce(n, 0)::bigint * size as taken, source, weight
from keyed left join counts using (rid)
"""
