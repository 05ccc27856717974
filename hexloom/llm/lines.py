"""Line dedup by levelled sorted runs of line hashes, with DataFrame functions only.

The state is a set of runs: tables of (h, g, docs, last), bucketed and sorted by the 128-bit hash (h, g)
of a line's key, with the number of documents that held it and the largest doc_id among them. No key
stands in two runs. A new batch of documents becomes a sorted run of its own keys, is merge-anti-joined
with each run, and what is left, the keys not seen before, is added as a run of level 0. The keys seen
before go to a log of repeats. When a level holds ``fanout`` runs they are merged into one run of the
next level, so a key is written once per level and a state of b batches has about
``fanout`` x log(b) runs.

Scale: runs and batches share one bucketing, so the anti-joins are merge joins without an exchange of
the runs; only hashes are shuffled. Texts cross one exchange, where the lines to drop meet them. A line
that very many documents hold is summed before the shuffle; nothing is grouped by line.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.llm.common import prepare, scratch_path, stored, table

#: Lines below this many code points are never dropped; a key is crowded from so many documents on.
MIN_CHARS, MIN_DOCS = 40, 5
#: Runs of a level before they are merged, and batches that the query deals the documents to.
FANOUT, BATCHES = 3, 6
BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h", "g"]


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def two_hashes(*columns: Column) -> list[Column]:
    """128 bits over the columns, as two long columns h and g."""
    return [F.xxhash64(F.lit(i), *columns) for i in (1, 2)]


def lines_of(text: str) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def row_key() -> list[Column]:
    """Two hashes of (doc_id, text): equal rows share them, and need no row number."""
    a, b = two_hashes(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                      F.coalesce(F.col("text"), F.lit("")))
    return [a.alias("row_h"), b.alias("row_g")]


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(row_h, row_g, doc_id, pos, h, g) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select(*row_key(), "doc_id", F.posexplode(lines_of("text")).alias("pos", "line"))
    keyed = lines.select("row_h", "row_g", "doc_id", "pos", F.btrim("line", F.lit(BLANK)).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= min_chars)
    keyed = keyed.withColumn("key", ascii_lower(F.col("key")))
    h, g = two_hashes(F.col("key"))
    return keyed.select("row_h", "row_g", "doc_id", "pos", h.alias("h"), g.alias("g"))


class LineRuns:
    """Line keys of the batches so far, in levels of sorted runs."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    def _written(self, rows: DataFrame) -> str:
        """Write (h, g, docs, last) as a sorted, bucketed run and return its table's name."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.select("h", "g", "docs", "last").write.format("parquet")
         .bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", scratch_path(self.spark, "line-run")).saveAsTable(name))
        return name

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *KEY)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of line_keys() and return its new keys. A document belongs to one batch.

        Rows that repeat a doc_id are one document; a null doc_id counts as one document below all.
        """
        held = lines.groupBy("h", "g", "doc_id").agg(F.count(F.lit(1)).alias("times"))
        # a partial sum before the exchange, so a line of very many documents is one row of each task
        own = held.groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        own_name = self._written(self._dealt(own))
        own = self.spark.table(own_name)
        new = reduce(lambda left, run: left.join(run.hint("merge"), KEY, "left_anti"), self.runs(), own)
        name = self._written(new)
        fresh = self.spark.table(name)
        if self.levels and any(self.levels):
            self.repeats.append(stored(own.join(fresh.hint("merge"), KEY, "left_anti"), "line-repeats"))
        self._forget(own_name)
        self._push(name, 0)
        return fresh

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.unionByName, map(self.spark.table, old))
            self._push(self._written(self._dealt(merged)), level + 1)
            for run in old:
                self._forget(run)

    def _forget(self, name: str) -> None:
        """Drop a run that others replace; its files go with the scratch tables."""
        self.spark.sql(f"drop table {name}")

    def counts(self) -> DataFrame:
        """(h, g, docs, last) of every key over all batches."""
        runs = self.runs()
        if not self.repeats:
            return reduce(DataFrame.unionByName, runs)
        more = reduce(DataFrame.unionByName, self.repeats).groupBy(*KEY).agg(
            F.sum("docs").alias("more"), F.max("last").alias("later"))
        more = self.spark.table(self._written(self._dealt(more).select(
            "h", "g", F.col("more").alias("docs"), F.col("later").alias("last"))))
        more = more.select("h", "g", F.col("docs").alias("more"), F.col("last").alias("later"))
        return reduce(DataFrame.unionByName, [
            run.join(more.hint("merge"), KEY, "left").select(
                "h", "g", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
                F.greatest("last", "later").alias("last")) for run in runs])

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._forget(name)
        self.levels = []


def keep_lines(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """The given rows with kept (text without the dropped lines), n_lines and n_dropped.

    ``drops``: (row_h, row_g, drop) with the ascending positions to drop. Columns of the three names
    are replaced, all others stay.
    """
    names = ("kept", "n_lines", "n_dropped")
    plain = [c for c in docs.columns if c not in names]
    rows = docs.select(F.struct(*plain).alias("row"), *row_key())
    met = rows.join(drops, ["row_h", "row_g"], "left").select("row.*", F.col("drop").alias("kept"))
    # between two dropped positions the lines stay; a slice for each gap keeps this linear, and the one
    # struct in an array is a name for the lines, which a lambda would split anew for each gap
    n, d = F.size(lines_of("text")), F.col("kept")
    named = F.array(F.struct(lines_of("text").alias("lines"), d.alias("drop")))

    def pieces(x: Column) -> Column:
        def gap(i: Column) -> Column:
            start = F.when(i == 0, 0).otherwise(F.get(x["drop"], i - 1) + 1)
            end = F.when(i == F.size(x["drop"]), F.size(x["lines"])).otherwise(F.get(x["drop"], i))
            return F.slice(x["lines"], start + 1, end - start)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["drop"])), gap))
    left = F.get(F.transform(named, pieces), 0)
    whole = F.coalesce(F.col("text"), F.lit(""))
    return met.select(
        *plain, F.when(d.isNull(), whole).otherwise(F.array_join(left, "\n")).alias("kept"),
        n.cast("long").alias("n_lines"), F.coalesce(F.size(d), F.lit(0)).cast("long").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The given rows with kept, n_lines and n_dropped.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of ``min_chars``
    code points or more that ``min_docs`` documents hold lose their lines everywhere but in the largest
    doc_id that holds them. Null and empty texts have one empty line. Rows that repeat a doc_id count
    as one document and keep or lose a line together; a null doc_id is one document below all others.
    A text that loses every line becomes empty. An empty table gives an empty result; columns named
    kept, n_lines or n_dropped are replaced, all others are carried along.
    """
    spark = docs.sparkSession
    spark_docs = docs.select("doc_id", "text")
    keys = line_keys(spark_docs, min_chars).withColumn(
        "batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    path = scratch_path(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    runs = LineRuns(spark, fanout)
    for number in range(batches):
        runs.add(keys.filter(F.col("batch") == number))
    crowded = stored(runs.counts().filter(F.col("docs") >= min_docs).select("h", "g", "last"), "line-crowded")
    runs.close()
    lost = keys.join(crowded, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    drops = lost.groupBy("row_h", "row_g").agg(F.array_sort(F.collect_set("pos")).alias("drop"))
    return keep_lines(docs, stored(drops, "line-drops"))


def op11_line_dedup(spark, folder: str) -> DataFrame:
    """Drop crowded lines from every whole text: doc_id, n_lines, n_dropped, kept_sha256."""
    prepare(spark)
    out = drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with rows as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (
  select rid, doc_id, unnest(range(1, len(parts) + 1)) as pos, unnest(parts) as line from rows),
keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
crowded as (
  select key, max(doc_id) as last from keyed where length(key) >= 40
  group by key having count(distinct coalesce(doc_id::varchar, 'none')) >= 5),
judged as (
  select k.*, c.key is not null and k.doc_id is distinct from c.last as gone
  from keyed k left join crowded c using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by rid, doc_id
"""
