"""Nested parsers and scalar rules on hand-computed cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hexloom.functions import attributes as A
from hexloom.functions import display as D
from hexloom.functions import values as V

TEXT_LIMITS = ("array<struct<max_speed:struct<value:string,unit:string>,"
               "min_speed:struct<value:string,unit:string>,when:struct<during:string>>>")


def one(spark, value, kind, *exprs):
    """Evaluate expressions over a single value of the given type."""
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return tuple(df.select(*[e(F.col("v")).alias(f"c{i}") for i, e in enumerate(exprs)]).first())


def limit(top=None, low=None, during=None):
    pair = lambda s: None if s is None else {"value": s[0], "unit": s[1]}
    return {"max_speed": pair(top), "min_speed": pair(low), "when": {"during": during}}


@pytest.mark.parametrize("limits, expected", [
    ([limit((None, None)), limit(("50", "mph"))], (80.467, None, False)),
    ([limit(low=("20", None)), limit(("60", "km/h"), during="Mo")], (60.0, 20.0, True)),
    ([limit(("fast", None)), limit(("70", None))], (70.0, None, False)),
    ([], (None, None, False)), (None, (None, None, False))])
def test_speed(spark, limits, expected):
    got = one(spark, limits, TEXT_LIMITS, A.max_speed_kmh, A.min_speed_kmh, A.is_variable_speed)
    assert got[0] == pytest.approx(expected[0]) and got[1:] == expected[1:]


@pytest.mark.parametrize("rules, expected", [
    (["x", "-1", "2"], (-1, False, True)), (["2"], (2, True, False)), ([None], (None, False, False)),
    (None, (None, False, False))])
def test_level(spark, rules, expected):
    rows = None if rules is None else [{"value": r} for r in rules]
    assert one(spark, rows, "array<struct<value:string>>", A.level, A.is_bridge, A.is_tunnel) == expected


def test_first_text_and_number(spark):
    kind = "array<struct<value:string>>"
    rows = [{"value": None}, {"value": "gravel"}, {"value": "paved"}]
    assert one(spark, rows, kind, A.first_text) == ("gravel",)
    assert one(spark, [{"value": ""}], kind, A.first_text) == (None,)
    assert one(spark, [{"value": "wide"}, {"value": "3.5"}], kind, A.first_number) == (3.5,)


@pytest.mark.parametrize("flags, expected", [
    ([["is_link"], ["Under_Construction"]], (True, True)), ([None, ["LINK_road"]], (True, False)),
    ([["li", "nk"]], (False, False)), (None, (False, False))])
def test_flags(spark, flags, expected):
    rows = None if flags is None else [{"values": f} for f in flags]
    got = one(spark, rows, A.FLAGS, lambda c: A.has_flag(c, "link"), lambda c: A.has_flag(c, "construction"))
    assert got == expected


@pytest.mark.parametrize("entries, expected", [
    ([("denied", None), ("allowed", ["foot"])], (True, False, False)),
    ([("Denied", ["FOOT", "hgv"])], (True, True, True)),
    ([("allowed", ["foot"])], (False, False, False)), (None, (False, False, False))])
def test_access(spark, entries, expected):
    rows = None if entries is None else [
        {"access_type": t, "when": None if m is None else {"mode": m}} for t, m in entries]
    got = one(spark, rows, A.ACCESS, A.is_restricted, lambda c: A.is_denied(c, "foot"),
              lambda c: A.is_denied(c, "hgv"))
    assert got == expected


def test_routes(spark):
    rows = [{"network": n, "ref": r} for n, r in (("AU:M", "1"), ("AU:M", "1"), ("AU:A", "2"))]
    assert one(spark, rows, A.ROUTES, A.route_count, A.has_national_route) == (2, True)
    assert one(spark, [{"network": "XAU:A", "ref": "1"}], A.ROUTES, A.has_national_route) == (False,)
    assert one(spark, None, A.ROUTES, A.route_count, A.has_national_route) == (0, False)


def test_alternates_and_names(spark):
    assert one(spark, ["a", None, "b"], "array<string>", A.joined_alternates) == ("a|b",)
    assert one(spark, [None], "array<string>", A.joined_alternates) == (None,)
    assert one(spark, {"primary": ""}, A.NAMES, A.primary_name) == (None,)


def test_epoch(spark):
    assert one(spark, 1730435174000, "bigint", V.epoch_ms) == (dt.datetime(2024, 11, 1, 4, 26, 14),)
    for none in (0, -1, None):
        assert one(spark, none, "bigint", V.epoch_ms) == (None,)


@pytest.mark.parametrize("text, expected", [
    ("2026-04-16T08:00:00", dt.datetime(2026, 4, 15, 22)),
    ("2026-04-16T08:00:00+10:00", dt.datetime(2026, 4, 15, 22)),
    ("2026-04-16T08:00:00+1000", dt.datetime(2026, 4, 15, 22)),
    ("2026-04-16 08:00:00+10:00", dt.datetime(2026, 4, 15, 22)),
    ("20260416T080000Z", dt.datetime(2026, 4, 16, 8)), ("20260416T0800+1000", dt.datetime(2026, 4, 15, 22)),
    ("2026-04-16", dt.datetime(2026, 4, 15, 14)), ("2026-04-16 08:00:00", dt.datetime(2026, 4, 15, 22)),
    ("2026-04-16T08:00:00Z", dt.datetime(2026, 4, 16, 8)), ("junk", None), ("", None), (None, None)])
def test_iso(spark, text, expected):
    assert one(spark, text, "string", lambda c: V.iso_time(c, "Australia/Melbourne")) == (expected,)


def test_safe_values(spark):
    for text, number in (("", None), ("2", 2), ("2.5", None), (None, None)):
        assert one(spark, text, "string", V.safe_int) == (number,)
    for text, clean in ((" null ", None), (" a ", "a"), ("Main St\r\n", "Main St"), ("\n", None),
                        ("\tnull ", None), ("\u00a0a\n b\u3000", "a\n b"), ("", None), (None, None)):
        assert one(spark, text, "string", V.safe_text) == (clean,)


@pytest.mark.parametrize("subtype, kind, expected", [
    ("Stalled vehicle fire", None, "breakdown"), ("x", "Crash", "crash"), ("Multi COLLISION", "", "crash"),
    ("oil spill", "Incident", "hazard"), ("", "roadworks", "roadwork"), (None, None, "other")])
def test_classifier(spark, subtype, kind, expected):
    df = spark.createDataFrame([(subtype, kind)], "s string, k string")
    assert df.select(V.classify(F.col("s"), F.col("k"))).first()[0] == expected


def test_display(spark):
    assert one(spark, 0, "bigint", D.format_bytes, D.format_number) == ("0 B", "0")
    assert one(spark, 1536, "bigint", D.format_bytes, D.format_number) == ("1.5 KB", "1.5K")
    assert one(spark, 269755993169, "bigint", D.format_bytes) == ("251.2 GB",)
    assert one(spark, "x.tar.gz", "string", lambda c: D.format_label(D.extension(c))) == ("GZ",)
    assert one(spark, "raw/my-set_a/", "string", D.slug, D.title_of_prefix) == ("raw-my-set-a", "My Set A")
    for text, expected in (("raw/dump.tar.gz", "Dump.Tar.Gz"), ("a  (b)\tc1", "A  (B)\tC1"), ("éa", "éA"), ("", "")):
        assert one(spark, text, "string", D.title_of_prefix) == (expected,)
    assert one(spark, "plain", "string", D.extension) == (None,)
