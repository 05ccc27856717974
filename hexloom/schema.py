"""Declared schemas and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexloom.functions import attributes as A

BBOX = "bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>"
_COMMON = f"id string, geometry binary, {BBOX}"

# Input columns of each lake type, with the hive partition it lives in.
LAKE_TYPES: dict[str, tuple[str, str]] = {
    "segment": ("transportation", f"""{_COMMON}, subtype string, class string,
        speed_limits {A.SPEED_LIMITS}, road_surface {A.SURFACES}, width_rules {A.WIDTHS},
        road_flags {A.FLAGS}, level_rules {A.LEVELS}, access_restrictions {A.ACCESS},
        subclass_rules {A.SUBCLASSES}, names {A.NAMES}, routes {A.ROUTES}"""),
    "place": ("places", f"""{_COMMON}, names {A.NAMES},
        categories struct<primary:string,alternate:array<string>>, confidence double"""),
    "building": ("buildings", f"""{_COMMON}, class string, height double, num_floors int,
        facade_material string, roof_material string, roof_shape string, roof_height double,
        num_floors_underground int, is_underground boolean"""),
    "building_part": ("buildings", f"""{_COMMON}, building_id string, height double,
        num_floors int, num_floors_underground int, is_underground boolean, min_height double"""),
    "land_use": ("base", f"{_COMMON}, class string, subtype string, surface string"),
    "land": ("base", f"{_COMMON}, class string, surface string"),
    "water": ("base", f"{_COMMON}, class string, is_salt boolean, is_intermittent boolean"),
    "infrastructure": ("base", f"{_COMMON}, class string, subtype string"),
    "land_cover": ("base", f"{_COMMON}, subtype string"),
    "bathymetry": ("base", _COMMON),
    "address": ("addresses", f"""{_COMMON}, number string, street string, postcode string,
        unit string, country string"""),
    "connector": ("transportation", _COMMON),
    "division": ("divisions", f"""{_COMMON}, subtype string, class string, admin_level int,
        population bigint"""),
    "division_area": ("divisions", f"""{_COMMON}, subtype string, class string, admin_level int,
        is_land boolean"""),
    "division_boundary": ("divisions", _COMMON),
}

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()), "doubles": T.ArrayType(T.DoubleType()),
    "date_range": T.StructType().add("start", T.DateType()).add("end", T.DateType()),
    "rings": T.ArrayType(T.ArrayType(T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()))),
}
_GEOM = [("geom_type", "string"), ("rings", "rings")]


def _struct(required: str, *columns: tuple[str, str]) -> T.StructType:
    must = set(required.split())
    out = T.StructType()
    for name, kind in columns:
        out = out.add(name, _KINDS[kind], name not in must)
    return out


def _listed(text: str) -> T.StructType:
    """Nullable columns written as ``name kind, name kind``."""
    return _struct("", *[tuple(entry.split()) for entry in text.split(",")])


# Declared output schemas of the four main layers.
ROADS = _struct(
    "feature_id road_class geom_type rings", ("feature_id", "string"), ("road_class", "string"),
    ("speed_limit_kmh", "double"), ("lanes", "double"), ("is_bridge", "boolean"),
    ("is_tunnel", "boolean"), ("road_surface", "string"), ("width_m", "double"),
    ("is_link", "boolean"), ("is_under_construction", "boolean"), *_GEOM)
POIS = _struct(
    "feature_id category geom_type rings", ("feature_id", "string"), ("name", "string"),
    ("category", "string"), ("confidence", "double"), ("categories_alt", "string"), *_GEOM)
BUILDINGS = _struct(
    "feature_id geom_type rings", ("feature_id", "string"), ("building_class", "string"),
    ("height", "double"), ("num_floors", "double"), ("area_m2", "double"),
    ("facade_material", "string"), ("roof_material", "string"), ("roof_shape", "string"),
    ("roof_height", "double"), ("num_floors_underground", "double"),
    ("is_underground", "boolean"), *_GEOM)
LANDUSE = _struct(
    "feature_id land_type geom_type rings", ("feature_id", "string"), ("land_type", "string"),
    ("land_class", "string"), ("area_m2", "double"), ("land_subtype", "string"),
    ("surface", "string"), ("is_salt", "boolean"), ("is_intermittent", "boolean"), *_GEOM)

LAYER_SCHEMAS = {"roads": ROADS, "pois": POIS, "buildings": BUILDINGS, "landuse": LANDUSE}

# The 25 columns of a normalised incident.
INCIDENT = _listed("""
    incident_id string, source string, city string, event_type string, event_subtype string,
    severity string, latitude double, longitude double, road_name string, cross_street string,
    suburb string, lga string, region string, description string, headline string,
    start_time timestamp, end_time timestamp, ended boolean, last_updated timestamp,
    lanes_affected int, direction string, attending_groups strings, source_url string,
    collected_at timestamp, raw_payload string""")

DATASET = _listed("""
    id string, name string, category string, region string, stage string, pair_id string,
    timespan string, temporal_range date_range, license string,
    source_url string, maintainer string, size_bytes bigint, file_count bigint, format string,
    last_modified timestamp, bbox doubles, description string, tags strings""")


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    have = set(df.columns)
    return [f.name for f in schema.fields if f.name not in have]


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per problem: (column_name, problem, null_count). One pass over the data.

    Missing columns are known from the schema; nulls in required columns are counted together.
    An empty input has no violations.
    """
    spark = df.sparkSession
    absent = missing_columns(df, schema)
    required = [f.name for f in schema.fields if not f.nullable and f.name not in absent]
    size = F.count(F.lit(1)).alias("_rows")
    counts = df.agg(size, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit("null").alias("problem"),
                        F.col(c).alias("null_count")) for c in required]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit("missing").alias("problem"),
                         F.lit(0).cast("bigint").alias("null_count")) for c in absent]
    if not entries:
        return spark.createDataFrame([], "column_name string, problem string, null_count bigint")
    return (counts.where(F.col("_rows") > 0).select(F.inline(F.array(*entries)))
            .where((F.col("problem") == "missing") | (F.col("null_count") > 0)))
