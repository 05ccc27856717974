"""Scalar rules for incident feeds: times, texts, numbers, category maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(value: Column) -> Column:
    """Epoch milliseconds to a UTC timestamp; 0 and -1 mean none."""
    ms = value.try_cast("bigint")
    return F.when(~ms.isin(0, -1), F.timestamp_millis(ms))


def iso_time(value: Column, zone: str = "UTC") -> Column:
    """ISO text to a UTC timestamp; a text without an offset is read in ``zone``.

    Date and time are parted by T or a blank, and both may be written without separators.
    The session time zone must be UTC.
    """
    value = F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3")
    value = F.regexp_replace(value, r"^(.{10}[T ]\d{2})(\d{2})(\d{2})(?!\d)", "$1:$2:$3")
    value = F.regexp_replace(value, r"^(.{10}[T ]\d{2})(\d{2})(?!\d)", "$1:$2")
    value = F.regexp_replace(value, r"^(.{10}[T ]\d{2}:\d{2})(?![\d:])", "$1:00")
    has_offset = value.rlike(r"[T ]\d.*(Z|[+-]\d{2}(:?\d{2})?)$")
    spaced = F.regexp_replace(value, r"([+-]\d{2})(\d{2})$", "$1:$2")
    is_iso = value.rlike(r"^\d{4}(-\d{2}(-\d{2}([T ].*)?)?)?$")
    parsed = F.when(has_offset, spaced).otherwise(value).try_cast("timestamp")
    local = F.to_utc_timestamp(parsed, zone)
    return F.when(is_iso, F.when(has_offset, parsed).otherwise(local))


def safe_int(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit("")).try_cast("int")


def safe_text(value: Column) -> Column:
    """Text without white space at its ends; empty and any spelling of ``null`` become null."""
    trimmed = F.regexp_replace(value.cast("string"), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
    return F.when((trimmed != "") & (F.lower(trimmed) != "null"), trimmed)


def first_truthy(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values])


def lookup(value: Column, table: dict[str, str], default: str | None = None) -> Column:
    chain = None
    for key, result in table.items():
        chain = (F.when(value == key, F.lit(result)) if chain is None
                 else chain.when(value == key, F.lit(result)))
    return chain.otherwise(F.lit(default))


def classify(subtype: Column, kind: Column) -> Column:
    """Event type from free text; the first rule that matches wins."""
    sub, typ = F.lower(F.coalesce(subtype, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    has = lambda text, *words: _any(text.contains(w) for w in words)
    return (F.when(has(sub, "crash", "collision") | has(typ, "crash"), "crash")
             .when(has(sub, "breakdown", "stalled", "broken"), "breakdown")
             .when(has(sub, "flood") | has(typ, "flood"), "flood")
             .when(has(sub, "fire") | has(typ, "fire"), "fire")
             .when(has(sub, "hazard", "debris", "spill", "animal"), "hazard")
             .when(typ.isin("roadwork", "roadworks") | has(sub, "roadwork"), "roadwork")
             .otherwise("other"))


def _any(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out | c
    return out


def partition_keys(ts: Column) -> dict[str, Column]:
    """Date, hour and compact stamp of a UTC timestamp."""
    return {"dt": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "HH"),
            "stamp": F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")}


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, towards zero."""
    return ((F.unix_micros(end) - F.unix_micros(start)) / 60_000_000.0).cast("bigint")
