"""Nested map attributes to flat columns. Every function maps Columns to a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom import vocab

MPH_IN_KMH = 1.60934

# Nested input types, one place for readers and tests. The parsers also take texts for numbers.
SPEED = "struct<value:int,unit:string>"
SPEED_LIMITS = f"array<struct<max_speed:{SPEED},min_speed:{SPEED},when:struct<during:string>>>"
SURFACES = "array<struct<value:string>>"
WIDTHS = "array<struct<value:double>>"
LEVELS = "array<struct<value:int>>"
SUBCLASSES = "array<struct<value:string>>"
FLAGS = "array<struct<values:array<string>>>"
ACCESS = "array<struct<access_type:string,when:struct<mode:array<string>>>>"
ROUTES = "array<struct<network:string,ref:string>>"
NAMES = "struct<primary:string>"


def number(value: Column) -> Column:
    """Anything readable as a number, else null."""
    return value.try_cast("double")


def whole(value: Column) -> Column:
    return value.try_cast("int")


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def lines_of(texts: Column) -> Column:
    """All non-null texts in lower case, one per line, with a line break at both ends."""
    return F.concat(F.lit("\n"), F.lower(F.array_join(texts, "\n")), F.lit("\n"))


def first_present(values: Column) -> Column:
    return F.get(F.array_compact(values), F.lit(0))


def speed_kmh(speed: Column) -> Column:
    value = number(speed["value"])
    is_mph = F.coalesce(F.lower(speed["unit"]).contains("mph"), F.lit(False))
    return F.when(is_mph, value * MPH_IN_KMH).otherwise(value)


def _first_speed(speeds: Column) -> Column:
    readable = F.filter(speeds, lambda s: number(s["value"]).isNotNull())
    return speed_kmh(F.get(readable, F.lit(0)))


def max_speed_kmh(limits: Column) -> Column:
    """First readable maximum, in km/h."""
    return _first_speed(limits["max_speed"])


def min_speed_kmh(limits: Column) -> Column:
    return _first_speed(limits["min_speed"])


def is_variable_speed(limits: Column) -> Column:
    """Some entry is limited to a period."""
    return F.coalesce(F.array_join(limits["when"]["during"], "") != "", F.lit(False))


def level(rules: Column) -> Column:
    """First rule that is a whole number; its extent along the line is ignored."""
    return first_present(rules["value"].try_cast("array<int>"))


def is_bridge(rules: Column) -> Column:
    return F.coalesce(level(rules) > 0, F.lit(False))


def is_tunnel(rules: Column) -> Column:
    return F.coalesce(level(rules) < 0, F.lit(False))


def first_text(entries: Column) -> Column:
    """First stated value of surface or subclass rules; an empty text counts as none."""
    return blank_to_null(first_present(entries["value"]))


def first_number(entries: Column) -> Column:
    return first_present(entries["value"].try_cast("array<double>"))


def has_flag(flags: Column, word: str) -> Column:
    """Any flag text that contains the word, whatever its case."""
    texts = F.flatten(F.array_compact(flags["values"]))
    return F.coalesce(lines_of(texts).contains(word), F.lit(False))


def is_restricted(access: Column) -> Column:
    return F.coalesce(lines_of(access["access_type"]).contains("\ndenied\n"), F.lit(False))


def is_denied(access: Column, mode: str) -> Column:
    """Some denial names the mode; a denial without modes names none."""
    denials = F.filter(access, lambda e: F.lower(e["access_type"]) == "denied")
    modes = F.flatten(F.array_compact(denials["when"]["mode"]))
    return F.coalesce(lines_of(modes).contains(f"\n{mode}\n"), F.lit(False))


def route_count(routes: Column) -> Column:
    """Distinct pairs of network and reference."""
    pairs = F.arrays_zip(routes["network"].alias("network"), routes["ref"].alias("ref"))
    return F.when(routes.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(pairs)))


def has_national_route(routes: Column) -> Column:
    """A network that starts with one of the national ones."""
    pattern = "(?m)^(" + "|".join(vocab.NATIONAL_NETWORKS) + ")"
    return F.coalesce(F.array_join(routes["network"], "\n").rlike(pattern), F.lit(False))


def primary_name(names: Column) -> Column:
    return blank_to_null(names["primary"])


def joined_alternates(values: Column) -> Column:
    """Alternates joined by a bar, nulls left out; none at all gives null."""
    kept = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, "|"))


def road_attributes() -> dict[str, Column]:
    """Flat road columns by name, for one projection over the nested source columns."""
    c = F.col
    return dict(
        road_class=F.coalesce(c("class"), F.lit("unknown")),
        speed_limit_kmh=max_speed_kmh(c("speed_limits")),
        lanes=F.lit(None).cast("double"),
        is_bridge=is_bridge(c("level_rules")),
        is_tunnel=is_tunnel(c("level_rules")),
        road_surface=first_text(c("road_surface")),
        width_m=first_number(c("width_rules")),
        is_link=has_flag(c("road_flags"), "link"),
        is_under_construction=has_flag(c("road_flags"), "construction"),
        access_denied_foot=is_denied(c("access_restrictions"), "foot"),
        access_denied_bicycle=is_denied(c("access_restrictions"), "bicycle"),
        access_denied_hgv=is_denied(c("access_restrictions"), "hgv"),
        has_access_restriction=is_restricted(c("access_restrictions")),
        subclass=first_text(c("subclass_rules")),
        route_count=route_count(c("routes")),
        has_national_route=has_national_route(c("routes")),
        road_name=primary_name(c("names")),
        min_speed_kmh=min_speed_kmh(c("speed_limits")),
        is_variable_speed=is_variable_speed(c("speed_limits")),
    )
