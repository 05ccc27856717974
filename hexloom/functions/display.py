"""Text forms of sizes, ages, spans and paths. ``now`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of known file extensions.
FORMAT_LABELS = {
    "parquet": "Parquet", "csv": "CSV", "json": "JSON", "nc": "NetCDF", "netcdf": "NetCDF",
    "tif": "GeoTIFF", "tiff": "GeoTIFF", "geojson": "GeoJSON", "zip": "ZIP", "gz": "GZ",
    "tar": "TAR", "png": "PNG", "avro": "Avro",
}

# Age units in seconds, longest first.
AGE_UNITS = (("year", 31536000), ("month", 2592000), ("week", 604800), ("day", 86400),
             ("hour", 3600), ("minute", 60))


def _one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", value)


def format_bytes(size: Column) -> Column:
    """Steps of 1024 up to TB, one decimal above bytes."""
    out = F.when(size == 0, F.lit("0 B"))
    out = out.when(size < 1024, F.concat(size.cast("bigint").cast("string"), F.lit(" B")))
    units = ("KB", "MB", "GB", "TB")
    for power, unit in enumerate(units, start=1):
        text = F.concat(_one_decimal(size / float(1024 ** power)), F.lit(f" {unit}"))
        if unit == units[-1]:
            return out.otherwise(text)
        out = out.when(size < 1024 ** (power + 1), text)


def format_number(n: Column) -> Column:
    return (F.when(n >= 1_000_000_000, F.concat(_one_decimal(n / 1e9), F.lit("B")))
             .when(n >= 1_000_000, F.concat(_one_decimal(n / 1e6), F.lit("M")))
             .when(n >= 1_000, F.concat(_one_decimal(n / 1e3), F.lit("K")))
             .otherwise(n.cast("string")))


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / 1e6).cast("bigint")


def time_ago(ts: Column, now: Column) -> Column:
    age = seconds_between(ts, now)
    out = None
    for unit, seconds in AGE_UNITS:
        n = F.floor(age / float(seconds)).cast("bigint")
        text = F.concat(n.cast("string"), F.lit(f" {unit}"),
                        F.when(n > 1, F.lit("s")).otherwise(F.lit("")), F.lit(" ago"))
        out = F.when(n >= 1, text) if out is None else out.when(n >= 1, text)
    return out.otherwise(F.lit("just now"))


def days_since(ts: Column, now: Column) -> Column:
    return F.floor((F.unix_micros(now) - F.unix_micros(ts)) / 86_400_000_000.0).cast("bigint")


def recency(ts: Column, now: Column) -> Column:
    days = days_since(ts, now)
    return F.when(days <= 30, F.lit("fresh")).when(days > 180, F.lit("stale"))


def age_percent(ts: Column, now: Column) -> Column:
    """Age on a scale of one year, capped at 100."""
    return F.least(days_since(ts, now), F.lit(365)) / 365.0 * 100.0


def timespan_label(explicit: Column, start: Column, end: Column) -> Column:
    """Stated label, else a year or a span of years, else a dash."""
    first = F.year(start).cast("string")
    last = F.coalesce(F.year(end).cast("string"), F.lit("now"))
    span = F.when(first == last, first).otherwise(F.concat(first, F.lit("–"), last))
    return F.coalesce(F.nullif(explicit, F.lit("")), F.when(start.isNotNull(), span), F.lit("—"))


def fractional_year(day: Column) -> Column:
    """Year plus zero-based month twelfths plus day 365ths."""
    return F.year(day) + (F.month(day) - 1) / 12.0 + F.dayofmonth(day) / 365.0


def slug(prefix: Column) -> Column:
    bare = F.regexp_replace(prefix, "/+$", "")
    return F.lower(F.regexp_replace(bare, "[^A-Za-z0-9-]", "-"))


def title(text: Column) -> Column:
    """Hyphens and underscores to blanks, upper case for each ASCII letter behind a non-word character."""
    runs = F.regexp_extract_all(F.regexp_replace(text, "[_-]", " "), F.lit(r"\w+|\W+"), 0)
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\w"), F.concat(
        F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2)))).otherwise(r)), "")


def title_of_prefix(prefix: Column) -> Column:
    """Title of the last path part."""
    bare = F.regexp_replace(prefix, "/+$", "")
    return title(F.element_at(F.split(bare, "/"), -1))


def extension(key: Column) -> Column:
    """Text after the last dot, in lower case; null without a dot."""
    parts = F.split(key, r"\.")
    return F.when(F.size(parts) > 1, F.nullif(F.lower(F.element_at(parts, -1)), F.lit("")))


def format_label(ext: Column) -> Column:
    chain = None
    for key, label in FORMAT_LABELS.items():
        chain = F.when(ext == key, label) if chain is None else chain.when(ext == key, label)
    return F.coalesce(chain.otherwise(F.upper(ext)), F.lit("Unknown"))


def stage_of(prefix: Column, stated: Column) -> Column:
    """Stated stage, else the one the prefix implies."""
    implied = F.when(prefix.startswith("processed/"), F.lit("processed")).otherwise(F.lit("raw"))
    return F.coalesce(stated, implied)
