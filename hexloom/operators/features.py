"""Per-cell feature aggregation for every map layer.

Each function takes rows that already carry ``cell_id`` and returns one row per cell with the
full fixed schema. Wide layers aggregate twice: first by (cell, category), which collapses a
dense cell inside the map tasks, then to one row per cell over the few rows that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom import vocab
from hexloom.functions import hexgrid as H

OTHER = "other"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(value: str, words: Sequence[str]) -> str:
    return f"{value} IN ({', '.join(quoted(w) for w in words)})"


def bucket(value: str, words: Sequence[str]) -> str:
    """The value when listed, else ``other``; null is other."""
    return f"CASE WHEN {any_of(value, words)} THEN {value} ELSE '{OTHER}' END"


def sum_where(condition: str, value: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {value} END), 0D)"


def count_where(condition: str, value: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {value} END), 0L)"


def share(part: str, whole: str) -> str:
    return f"coalesce(try_divide({part}, {whole}), 0D)"


def per_cell(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per cell; columns are SQL aggregates by output name.

    Wide aggregates are written as SQL texts because building a Column costs a round trip to the
    JVM per call, which for hundreds of columns takes longer than the query.
    """
    return df.groupBy("cell_id").agg(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def road_features(pieces: DataFrame, classes: Sequence[str] = vocab.ROAD_CLASSES,
                  subclasses: Sequence[str] = vocab.ROAD_SUBCLASSES,
                  surfaces: Sequence[str] = vocab.ROAD_SURFACES,
                  paved: Sequence[str] = vocab.PAVED_SURFACES,
                  unpaved: Sequence[str] = vocab.UNPAVED_SURFACES) -> DataFrame:
    """Clipped road pieces (one per road and cell, ``length_m``) to 65 columns per cell."""
    ln, total = "length_m", "sum(length_m)"

    def known(name):
        return sum_where(f"{name} IS NOT NULL", ln)

    def weighted_mean(name):
        return share(f"sum({name} * {ln})", f"nullif({known(name)}, 0D)")

    def flagged(name):
        return share(sum_where(name, ln), total)

    def lengths(name, words, prefix):
        """Length per listed value, the rest in one column; null counts only for classes."""
        rest = f"NOT coalesce({any_of(name, words)}, false)"
        if name != "road_class":
            rest = f"{name} IS NOT NULL AND {rest}"
        return {**{f"{prefix}_{w}_m": sum_where(f"{name} = {quoted(w)}", ln) for w in words},
                f"{prefix}_{OTHER}_m": sum_where(rest, ln)}

    surface = "road_surface"
    return per_cell(pieces, {
        "total_road_length_m": total,
        "road_segment_count": "count(1)",
        "avg_edge_length_m": f"avg({ln})",
        **lengths("road_class", classes, "road_length"),
        "avg_maxspeed_kmh": weighted_mean("speed_limit_kmh"),
        "maxspeed_coverage_pct": share(known("speed_limit_kmh"), total),
        "avg_min_speed_kmh": weighted_mean("min_speed_kmh"),
        "min_speed_coverage_pct": share(known("min_speed_kmh"), total),
        "has_variable_speed_pct": flagged("is_variable_speed"),
        **{f"pct_{c}_length": flagged(c)
           for c in ("is_bridge", "is_tunnel", "is_link", "is_under_construction")},
        "road_surface_coverage_pct": share(known(surface), total),
        "road_surface_paved_pct": share(sum_where(any_of(surface, paved), ln), total),
        "road_surface_unpaved_pct": share(sum_where(any_of(surface, unpaved), ln), total),
        **lengths(surface, surfaces, "road_surface_length"),
        "road_width_coverage_pct": share(known("width_m"), total),
        "avg_road_width_m": weighted_mean("width_m"),
        "max_road_width_m": "coalesce(max(width_m), 0D)",
        **{f"pct_{c}_length": flagged(c)
           for c in ("access_denied_foot", "access_denied_bicycle", "access_denied_hgv")},
        "has_access_restriction_pct": flagged("has_access_restriction"),
        **lengths("subclass", subclasses, "road_length_subclass"),
        "named_road_pct": share(known("road_name"), total),
        "unique_road_names": "count(DISTINCT road_name)",
        "route_count_total": "coalesce(sum(route_count), 0L)",
        "has_national_route": "coalesce(max(CAST(has_national_route AS DOUBLE)), 0D)",
    })


def poi_features(pois: DataFrame, categories: Sequence[str] = vocab.POI_CATEGORIES) -> DataFrame:
    """Counts, category diversity and alternate diversity in one scan.

    A place becomes one token for its category and one per alternate; distinct values are then
    the groups of the first aggregation.
    """
    tokens = F.expr("""concat(
        array(struct('category' AS kind, category AS value, 1L AS n,
                     CAST(categories_alt IS NOT NULL AS BIGINT) AS alt)),
        transform(coalesce(array_distinct(split(categories_alt, '[|]')), array()),
                  a -> struct('alternate' AS kind, a AS value, 0L AS n, 0L AS alt)))""")
    by_value = (pois.select("cell_id", F.explode(tokens).alias("t"))
                .groupBy("cell_id", F.col("t.kind").alias("kind"), F.col("t.value").alias("value"))
                .agg(F.sum("t.n").alias("n"), F.sum("t.alt").alias("alt")))
    main = "kind = 'category'"
    rest = f"{main} AND NOT coalesce({any_of('value', categories)}, false)"
    return per_cell(by_value, {
        "poi_count_total": "sum(n)",
        "poi_category_diversity": f"count_if({main} AND value IS NOT NULL)",
        **{f"poi_count_{c}": count_where(f"{main} AND value = {quoted(c)}", "n") for c in categories},
        f"poi_count_{OTHER}": count_where(rest, "n"),
        "poi_alt_category_diversity": f"count_if(NOT {main} AND value IS NOT NULL)",
        "poi_has_alt_category_pct": "sum(alt) / sum(n)",
    })


def building_features(buildings: DataFrame,
                      classes: Sequence[str] = vocab.BUILDING_CLASSES) -> DataFrame:
    cls = bucket("coalesce(building_class, 'unknown')", classes)
    by_class = buildings.groupBy("cell_id", F.expr(cls).alias("cls")).agg(
        F.expr("count(1) AS n"), F.expr("coalesce(sum(area_m2), 0D) AS area"),
        F.expr("sum(height) AS h"), F.expr("count(height) AS hn"))
    names = [*classes, OTHER]
    return per_cell(by_class, {
        "building_count": "sum(n)", "building_total_area_m2": "sum(area)",
        **{f"building_count_{c}": count_where(f"cls = {quoted(c)}", "n") for c in names},
        **{f"building_area_{c}_m2": sum_where(f"cls = {quoted(c)}", "area") for c in names},
        "avg_building_height_m": share("sum(h)", "sum(hn)"),
    })


def _area_by_class(pieces: DataFrame, value: str, words: Sequence[str], prefix: str,
                   shares: dict[str, Sequence[str]]) -> DataFrame:
    by_class = (pieces.groupBy("cell_id", F.expr(bucket(value, words)).alias("cls"))
                .agg(F.sum("area_m2").alias("area")))
    part = lambda group: share(sum_where(any_of("cls", group), "area"), "sum(area)")
    return per_cell(by_class, {
        f"{prefix}_total_area_m2": "sum(area)",
        **{f"{prefix}_area_{c}_m2": sum_where(f"cls = {quoted(c)}", "area") for c in [*words, OTHER]},
        **{name: f"least(greatest({part(group)}, 0D), 1D)" for name, group in shares.items()},
    })


def landuse_features(pieces: DataFrame, classes: Sequence[str] = vocab.LANDUSE_CLASSES,
                     green: Sequence[str] = vocab.GREEN_LANDUSE,
                     built: Sequence[str] = vocab.BUILT_LANDUSE) -> DataFrame:
    """Clipped land-use pieces to areas per class; shares are tested after bucketing."""
    return _area_by_class(pieces, "coalesce(land_class, land_type)", classes, "landuse",
                          {"total_green_fraction": green, "total_built_fraction": built})


def land_cover_features(pieces: DataFrame, subtypes: Sequence[str] = vocab.LAND_COVER_SUBTYPES,
                        green: Sequence[str] = vocab.GREEN_LAND_COVER,
                        urban: Sequence[str] = ("urban",)) -> DataFrame:
    return _area_by_class(pieces, "landcover_subtype", subtypes, "landcover",
                          {"landcover_green_fraction": green, "landcover_urban_fraction": urban})


def address_features(addresses: DataFrame) -> DataFrame:
    return per_cell(addresses, {
        "address_count_total": "count(1)",
        "address_has_postcode_pct": "avg(CAST(postcode IS NOT NULL AS DOUBLE))",
        "address_has_unit_pct": "avg(CAST(unit IS NOT NULL AS DOUBLE))",
        "address_unique_streets": "count(DISTINCT street)",
    })


def infrastructure_features(items: DataFrame,
                            classes: Sequence[str] = vocab.INFRASTRUCTURE_CLASSES) -> DataFrame:
    by_class = items.groupBy("cell_id", "infra_class").agg(F.expr("count(1) AS n"))
    rest = f"NOT coalesce({any_of('infra_class', classes)}, false)"
    return per_cell(by_class, {
        "infra_count_total": "sum(n)", "infra_class_diversity": "count(infra_class)",
        **{f"infra_count_{c}": count_where(f"infra_class = {quoted(c)}", "n") for c in classes},
        f"infra_count_{OTHER}": count_where(rest, "n"),
    })


def connector_features(connectors: DataFrame, res: int) -> DataFrame:
    """Count and density; the density uses the nominal cell area of the resolution."""
    nominal_km2 = 2.598 * (H.edge(res) / 1000) ** 2
    return per_cell(connectors, {"connector_count_total": "count(1)",
                                 "connector_density_per_km2": f"count(1) / {nominal_km2!r}D"})


def building_part_features(parts: DataFrame) -> DataFrame:
    return per_cell(parts, {
        "building_part_count": "count(1)",
        "building_part_total_area_m2": "coalesce(sum(area_m2), 0D)",
        "building_part_avg_height_m": "coalesce(avg(height), 0D)",
        "building_part_avg_num_floors": "coalesce(avg(num_floors), 0D)",
        "building_part_underground_count": "count_if(is_underground)",
    })


def division_features(points: DataFrame, area_pieces: DataFrame, boundary_pieces: DataFrame) -> DataFrame:
    """Three sources with the same key become one relation, so one aggregation serves all."""
    rows = (points.selectExpr("cell_id", "'point' AS k", "CAST(admin_level AS DOUBLE) AS lv",
                              "CAST(NULL AS DOUBLE) AS len")
            .unionByName(area_pieces.selectExpr("cell_id", "'area' AS k", "CAST(NULL AS DOUBLE) AS lv",
                                                "CAST(NULL AS DOUBLE) AS len"))
            .unionByName(boundary_pieces.selectExpr("cell_id", "'line' AS k",
                                                    "CAST(NULL AS DOUBLE) AS lv", "length_m AS len")))
    return per_cell(rows, {
        "division_count": "count_if(k = 'point')",
        "division_min_admin_level": "coalesce(min(lv), 0D)",
        "division_max_admin_level": "coalesce(max(lv), 0D)",
        "division_area_count": "count_if(k = 'area')",
        "division_boundary_length_m": "coalesce(sum(len), 0D)",
    })


def bathymetry_features(pieces: DataFrame, res: int) -> DataFrame:
    return per_cell(pieces, {
        "bathymetry_area_m2": "sum(area_m2)",
        "bathymetry_fraction":
            f"least(greatest(sum(area_m2) / {H.true_cell_area(res)!r}D, 0D), 1D)",
    })


def join_on_grid(grid: DataFrame, layers: Sequence[DataFrame]) -> DataFrame:
    """Grid left join every layer, numeric gaps filled with zero. Cells outside the grid drop out.

    Every layer is already hash-partitioned by ``cell_id`` from its own aggregation, so only the
    grid moves. The merge hint also rules out a broadcast, which would rest on an estimate that
    does not know how many cells a feature expands to.
    """
    wide = grid
    for layer in layers:
        wide = wide.join(layer.hint("merge"), "cell_id", "left")
    fixed = set(grid.columns)
    return wide.selectExpr(*[
        f"`{f.name}`" if f.name in fixed
        else f"coalesce(`{f.name}`, CAST(0 AS {f.dataType.simpleString()})) AS `{f.name}`"
        for f in wide.schema.fields])


def log1p_columns(columns: Sequence[str]) -> list[str]:
    named = set(vocab.LOG1P_COLUMNS)
    return sorted(c for c in columns
                  if c in named or any(c.startswith(p) for p in vocab.LOG1P_PREFIXES))


def ml_features(wide: DataFrame) -> DataFrame:
    """Add log1p companions and 0/1 indicators in one projection."""
    columns = wide.columns
    logs = [f"log1p(CAST(`{c}` AS DOUBLE)) AS `log1p_{c}`" for c in log1p_columns(columns)]
    flags = [f"CAST(`{src}` > 0 AS INT) AS `{dst}`"
             for src, dst in vocab.INDICATORS.items() if src in columns]
    return wide.selectExpr("*", *logs, *flags)


def pixel_means(pixels: DataFrame, bands: int, band: str = "band") -> DataFrame:
    """Mean of every band per cell and the pixel count; a pixel counts when band 0 is a number."""
    valid = pixels.where(f"get({band}, 0) IS NOT NULL AND NOT isnan(get({band}, 0))")
    return per_cell(valid, {"pixel_count": "count(1)", **{
        f"A{i:02d}": f"avg(CAST(get({band}, {i}) AS DOUBLE))" for i in range(bands)}})


def pixel_summary(means: DataFrame) -> DataFrame:
    return means.agg(F.coalesce(F.avg("pixel_count"), F.lit(0.0)).alias("avg_pixels_per_hex"),
                     F.count(F.lit(1)).alias("hexes"))


def merge_embeddings(features: DataFrame, means: DataFrame) -> DataFrame:
    """Left join; cells without pixels keep null bands."""
    return features.join(means.drop("pixel_count"), "cell_id", "left")


def match_counts(features: DataFrame, means: DataFrame) -> DataFrame:
    """How many feature cells have an embedding and how many do not."""
    seen = means.select("cell_id", F.lit(True).alias("hit"))
    joined = features.select("cell_id").join(seen, "cell_id", "left")
    return joined.agg(F.count(F.lit(1)).alias("hexes"), F.count("hit").alias("matched"),
                      F.count_if(F.col("hit").isNull()).alias("unmatched"))
