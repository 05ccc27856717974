"""Statistics over dataset records: listings, KPIs, growth, pairs, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexloom.functions import display as D

# Dataset categories with their labels, in display order.
CATEGORIES = {
    "traffic": "Traffic", "eta": "ETA", "gps-trajectory": "GPS & Trajectory",
    "satellite": "Satellite", "energy": "Energy", "weather": "Weather",
    "demographics": "Demographics",
}
DEFAULT_CATEGORY = "demographics"
DEFAULT_REGION = "Unknown"
#: Records whose (date, id) give the points at which the growth curve is cut.
SPLIT_SAMPLE = 2000


def categories(spark: SparkSession) -> DataFrame:
    """Seven-row dimension (category, label, ordinal)."""
    rows = [(c, label, i) for i, (c, label) in enumerate(CATEGORIES.items())]
    return spark.createDataFrame(rows, "category string, label string, ordinal int")


# -- listing to datasets -------------------------------------------------------------------------

def prefix_of(key: Column) -> Column:
    """First two path parts; a file right under the top part is its own dataset."""
    folder = F.regexp_extract(key, "^([^/]+/[^/]+/)", 1)
    return F.when(folder != "", folder).otherwise(key)


def prefix_stats(files: DataFrame) -> DataFrame:
    """Per prefix: bytes, files, newest date and dominant format.

    Grouping by (prefix, extension) first leaves a handful of rows per prefix, however many files
    it has. Equal counts go to the first extension by name.
    """
    by_ext = (files.where(F.col("size") > 0)
              .groupBy(prefix_of(F.col("key")).alias("prefix"), D.extension(F.col("key")).alias("ext"))
              .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"),
                   F.max("last_modified").alias("last_modified")))
    rank = F.when(F.col("ext").isNotNull(), F.struct(-F.col("n"), F.col("ext")))
    return by_ext.groupBy("prefix").agg(
        F.sum("size").alias("size_bytes"), F.sum("n").alias("file_count"),
        F.max("last_modified").alias("last_modified"),
        D.format_label(F.min_by("ext", rank)).alias("format"))


def build_datasets(stats: DataFrame, entries: DataFrame) -> DataFrame:
    """Prefix statistics with hand-kept entries and defaults for what is not stated."""
    known = entries.withColumnsRenamed({c: f"e_{c}" for c in entries.columns if c != "prefix"})
    joined = stats.join(known, "prefix", "left")
    p = F.col("prefix")
    passed = ("pair_id", "timespan", "temporal_range", "license", "source_url", "maintainer",
              "bbox", "description", "tags")
    return joined.select(
        D.slug(p).alias("id"), F.coalesce("e_name", D.title_of_prefix(p)).alias("name"),
        F.coalesce("e_category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.coalesce("e_region", F.lit(DEFAULT_REGION)).alias("region"),
        D.stage_of(p, F.col("e_stage")).alias("stage"),
        *[F.col(f"e_{c}").alias(c) for c in passed],
        "size_bytes", "file_count", "format", "last_modified")


# -- statistics ----------------------------------------------------------------------------------

def kpis(datasets: DataFrame) -> DataFrame:
    """Totals, distinct counts, newest date and pair coverage in one row."""
    totals = datasets.agg(
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"),
        F.coalesce(F.sum("file_count"), F.lit(0)).alias("file_count_total"),
        F.count(F.lit(1)).alias("dataset_count"),
        F.count_distinct("category").alias("category_count"),
        F.count_distinct("region").alias("region_count"),
        F.count_distinct(F.nullif("maintainer", F.lit(""))).alias("maintainer_count"),
        F.max("last_modified").alias("last_updated"))
    paired = datasets.where(F.col("pair_id") != "").groupBy("pair_id").agg(
        F.count_if(F.col("stage") == "raw").alias("raw"),
        F.bool_or(F.col("stage") == "processed").alias("processed"))
    coverage = paired.agg(
        F.coalesce(F.sum(F.when(F.col("processed"), F.col("raw"))), F.lit(0)).alias("raw_with_processed"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_total"))
    one = F.lit(1).alias("_k")
    return totals.select("*", one).join(coverage.select("*", one), "_k").drop("_k")


def category_stats(datasets: DataFrame) -> DataFrame:
    """Count and bytes per known category; empty categories are listed."""
    found = datasets.groupBy("category").agg(F.count(F.lit(1)).alias("count"),
                                             F.sum("size_bytes").alias("size_bytes"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (categories(datasets.sparkSession).join(found, "category", "left")
            .select("category", "label", "ordinal", zero("count"), zero("size_bytes"))
            .orderBy("ordinal"))


def region_stats(datasets: DataFrame) -> DataFrame:
    return (datasets.groupBy("region").agg(F.count(F.lit(1)).alias("count"),
                                           F.sum("size_bytes").alias("size_bytes"))
            .orderBy(F.desc("size_bytes"), "region"))


def growth_curve(datasets: DataFrame, ranges: int | None = None) -> DataFrame:
    """Running total of bytes by date, with an anchor row one month before the first date.

    A global running sum in one window would put all rows into one task. Here the rows are cut into
    ranges of (date, id) at points from a bounded sample; each range is summed on its own and shifted
    by the total of the ranges before it. The points are values, so a recomputed task sees the same.
    """
    spark = datasets.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["id", "name", "category", "size_bytes", "last_modified"]
    own = F.struct("last_modified", "id")
    sample = (datasets.where(F.col("last_modified").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(SPLIT_SAMPLE)
              .agg(F.array_sort(F.collect_list(own)).alias("s"))
              .select(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(
                  "s", F.floor(i * F.size("s") / n).cast("int")))).alias("p")) if n > 1 else None)
    points = [p for p in sample.first()["p"] if p is not None] if sample is not None else []
    limits = F.array(*[F.struct(F.lit(p["last_modified"]).alias("last_modified"), F.lit(p["id"]).alias("id"))
                       for p in points])
    cut = datasets.select(*columns).withColumn(
        "_range", F.size(F.filter(limits, lambda p: p < own)) if points else F.lit(0))
    per_range = cut.groupBy("_range").agg(F.sum("size_bytes").alias("_bytes"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # n rows
    offsets = per_range.select("_range", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy("last_modified", "id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    points = (cut.join(offsets, "_range")
              .select(F.col("last_modified").alias("date"),
                      (F.sum("size_bytes").over(within) + F.col("_offset")).alias("total_bytes"),
                      F.col("name").alias("dataset_name"), "category", "size_bytes"))
    anchor = (cut.agg(F.min("last_modified").alias("first")).where(F.col("first").isNotNull())
              .select((F.col("first") - F.expr("INTERVAL 1 MONTH")).alias("date"),
                      F.lit(0).cast("bigint").alias("total_bytes"), F.lit("").alias("dataset_name"),
                      F.lit("traffic").alias("category"), F.lit(0).cast("bigint").alias("size_bytes")))
    return anchor.unionByName(points)


def pair_impact(datasets: DataFrame) -> DataFrame:
    """Raw against processed bytes and files of every pair that has both stages."""
    stage = lambda s, v: F.coalesce(F.sum(F.when(F.col("stage") == s, v)), F.lit(0))
    formats = lambda s: F.array_join(F.sort_array(F.collect_set(
        F.when(F.col("stage") == s, F.coalesce("format", F.lit("Unknown"))))), ", ")
    out = datasets.where(F.col("pair_id") != "").groupBy("pair_id").agg(
        F.count_if(F.col("stage") == "raw").alias("raw_count"),
        F.count_if(F.col("stage") == "processed").alias("processed_count"),
        *[stage(s, F.col(c)).alias(f"{s}_{name}") for s in ("raw", "processed")
          for c, name in (("size_bytes", "bytes"), ("file_count", "files"))],
        formats("raw").alias("raw_formats"), formats("processed").alias("processed_formats"))
    percent = lambda a, b: F.try_divide((F.col(a) - F.col(b)) * 100.0, F.col(a).cast("double"))
    return (out.where((F.col("raw_count") > 0) & (F.col("processed_count") > 0))
            .select("*", D.title(F.col("pair_id")).alias("label"),
                    percent("raw_bytes", "processed_bytes").alias("size_reduction_pct"),
                    percent("raw_files", "processed_files").alias("file_reduction_pct")))


def format_histogram(datasets: DataFrame) -> DataFrame:
    return (datasets.groupBy("stage", F.coalesce("format", F.lit("Unknown")).alias("format"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("stage", F.desc("n"), "format"))


def bbox_union(datasets: DataFrame) -> DataFrame:
    at = lambda i: F.get("bbox", F.lit(i))
    return datasets.where(F.col("bbox").isNotNull()).agg(
        F.min(at(0)).alias("west"), F.min(at(1)).alias("south"),
        F.max(at(2)).alias("east"), F.max(at(3)).alias("north"))


LIST_SIZE = 1000


def grouped_lists(datasets: DataFrame, key: str, list_size: int = LIST_SIZE) -> DataFrame:
    """Members of each group as id lists of about ``list_size`` entries: (key, chunk, ids).

    A group's members are divided by a hash of the id into as many lists as its size asks for, so
    no list grows with the data.
    """
    keyed = datasets.where(F.col(key).isNotNull()).select(key, "id")
    lists = keyed.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / float(list_size)).alias("_lists"))
    digest = F.conv(F.substring(F.md5("id"), 1, 8), 16, 10).cast("bigint")
    return (keyed.join(lists, key).withColumn("chunk", digest % F.col("_lists"))
            .groupBy(key, "chunk").agg(F.sort_array(F.collect_list("id")).alias("ids")))


# -- lookups -------------------------------------------------------------------------------------

def raw_with_processed(datasets: DataFrame) -> DataFrame:
    """Raw datasets whose pair has a processed member."""
    done = datasets.where((F.col("stage") == "processed") & (F.col("pair_id") != "")).select("pair_id")
    return datasets.where(F.col("stage") == "raw").join(done.distinct(), "pair_id", "left_semi")


def siblings_of(datasets: DataFrame, dataset_id: str) -> DataFrame:
    """Other members of one dataset's pair."""
    pair = datasets.where(F.col("id") == dataset_id).select("pair_id").distinct()
    return datasets.join(pair, "pair_id", "left_semi").where(F.col("id") != dataset_id)


def _first_per_group(datasets: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """Ids of the first n members of each group, as one short list per group."""
    window = Window.partitionBy(key).orderBy(*order)
    ranked = (datasets.where(F.col(key).isNotNull()).select(key, "id", "size_bytes", F.row_number()
              .over(window).alias("_rank")).where(F.col("_rank") <= n))
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_rank", "id"))).alias("_first"))


def _others(datasets: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """Each dataset with the first n other members of its group.

    The first n + 1 members contain the first n others of anybody, so the join carries one short
    list per group instead of all pairs.
    """
    first = _first_per_group(datasets, key, n + 1, *order)
    others = F.filter(F.transform("_first", lambda s: s["id"]), lambda i: i != F.col("id"))
    return datasets.join(first, key, "left").withColumn(
        "others", F.slice(F.coalesce(others, F.array().cast("array<string>")), 1, n)).drop("_first")


def related_datasets(datasets: DataFrame, n: int = 3) -> DataFrame:
    """First n datasets of the same category, largest first: id, rank, related_id."""
    joined = _others(datasets, "category", n, F.desc("size_bytes"), F.asc("id"))
    return joined.select("id", F.posexplode("others").alias("rank", "related_id"))


def pair_siblings(datasets: DataFrame) -> DataFrame:
    """Number of other members of each dataset's pair, and the first of them."""
    sizes = datasets.where(F.col("pair_id").isNotNull()).groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("_size"))
    joined = _others(datasets, "pair_id", 1, F.asc("id")).join(sizes, "pair_id", "left")
    count = F.coalesce(F.col("_size") - 1, F.lit(0).cast("bigint"))
    return joined.select("id", "pair_id", count.alias("sibling_count"),
                         F.get("others", F.lit(0)).alias("first_sibling"), (count > 0).alias("has_pair"))


def with_label(datasets: DataFrame) -> DataFrame:
    """Category label and position; unknown categories show their own name, last."""
    dim = F.broadcast(categories(datasets.sparkSession))  # seven rows
    return (datasets.join(dim, "category", "left")
            .withColumn("label", F.coalesce("label", "category"))
            .withColumn("ordinal", F.coalesce("ordinal", F.lit(-1))))


def of_stage(datasets: DataFrame, stage: str = "all") -> DataFrame:
    return datasets if stage == "all" else datasets.where(F.col("stage") == stage)


def search(datasets: DataFrame, text: str = "", chosen: Sequence[str] = ()) -> DataFrame:
    """Case-insensitive containment in any of the text fields or tags; no text means all."""
    out = datasets
    if text:
        word = text.lower()
        hit = F.lit(False)
        for c in ("name", "description", "region", "maintainer"):
            hit = hit | F.coalesce(F.lower(F.col(c)).contains(word), F.lit(False))
        hit = hit | F.coalesce(F.exists("tags", lambda t: F.lower(t).contains(word)), F.lit(False))
        out = out.where(hit)
    return out.where(F.col("category").isin(*chosen)) if chosen else out


def palette_search(datasets: DataFrame, text: str) -> DataFrame:
    """Containment in one text of name, tags, region and category label."""
    joined = F.concat_ws(" ", "name", F.array_join("tags", " "), "region", "label")
    return with_label(datasets).where(F.lower(joined).contains(text.lower()))


SORT_COLUMNS = {"name": "name", "size": "size_bytes", "date": "last_modified", "region": "region"}


def sort_datasets(datasets: DataFrame, by: str = "date", descending: bool = True) -> DataFrame:
    """Sorted by a range exchange; texts compare by code point."""
    c = F.col(SORT_COLUMNS[by])
    return datasets.orderBy(c.desc() if descending else c.asc(), "id")


def preview(datasets: DataFrame, n: int = 100) -> DataFrame:
    return datasets.limit(n)


def without_range(datasets: DataFrame) -> DataFrame:
    """Datasets that a timeline cannot show: no range, or one without a start."""
    return datasets.where(F.col("temporal_range.start").isNull())


def timeline(datasets: DataFrame, now: Column) -> DataFrame:
    """Datasets with a range in category order, then by start; open ends reach to now."""
    start, end = F.col("temporal_range.start"), F.col("temporal_range.end")
    last = F.coalesce(end, now.cast("date"))
    return (with_label(datasets).where(start.isNotNull())
            .select("id", "category", "ordinal", start.alias("start"), last.alias("end"),
                    D.fractional_year(start).alias("start_year"), D.fractional_year(last).alias("end_year"),
                    F.unix_millis(start.cast("timestamp")).alias("start_ms"),
                    F.unix_millis(last.cast("timestamp")).alias("end_ms"))
            .orderBy("ordinal", "start", "id"))


def visible_tags(datasets: DataFrame, n: int = 3) -> DataFrame:
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    return datasets.select("id", F.slice(tags, 1, n).alias("visible"),
                           F.greatest(F.size(tags) - n, F.lit(0)).alias("hidden"))


def layer_gaps(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Entries of ``wanted`` that are absent from ``existing``."""
    return wanted.join(existing.select(key).distinct(), key, "left_anti")
