"""DuckDB statements of the extraction and satellite queries.

The outline test runs on the whole-numbered plane, before anything is turned into degrees; the
projection is written out with numeric coefficients.
"""

from __future__ import annotations

from hexloom.plans.geo_oracles import E, HALF_W, LC, LU, ROADS, W, _box_hit, case_of, cells, px, py, squares

ZONE_MERIDIAN = "153e0"   # zone 56 south holds the whole plane
CLASS = {"ECONOMY": "house", "STANDARD": "garage", "PROMO": "school", "MEDIUM": "castle"}
LAND = {**LU, "LARGE": "moonbase"}
L_BOXES = [("100.3719e0", "100.2917e0", "1900.3719e0", "900.2917e0"),
           ("100.3719e0", "100.2917e0", "900.3719e0", "1900.2917e0")]


def metres(source: str, keep: str) -> str:
    """Adds e, n in metres to a relation with lon, lat."""
    return f"""
      select {keep}, 500000e0 + 0.9996e0*6367449.145823415e0*(eta
          + 0.0008377318188192541e0*cos(2*xi)*sinh(2*eta) + 7.608496958699166e-07*cos(4*xi)*sinh(4*eta)
          + 1.2034877875966644e-09*cos(6*xi)*sinh(6*eta)) e,
        10000000e0 + 0.9996e0*6367449.145823415e0*(xi
          + 0.0008377318188192541e0*sin(2*xi)*cosh(2*eta) + 7.608496958699166e-07*sin(4*xi)*cosh(4*eta)
          + 1.2034877875966644e-09*sin(6*xi)*cosh(6*eta)) n
      from (select *, atan2(tau, cos(lam)) xi, asinh(sin(lam)/sqrt(tau*tau+cos(lam)*cos(lam))) eta
        from (select *, sinh(atanh(sin(phi)) - 0.08181919084262149e0*atanh(0.08181919084262149e0*sin(phi))) tau
          from (select *, radians(lat) phi, radians(lon-{ZONE_MERIDIAN}) lam from ({source}))))"""


def degrees(source: str, keep: str) -> str:
    """Adds lon, lat to a relation with e, n."""
    return f"""
      select {keep}, {ZONE_MERIDIAN} + degrees(atan2(sinh(eta1), cos(xi1))) lon,
        degrees(chi + 0.003356551448628875e0*sin(2*chi) + 6.571913193172695e-06*sin(4*chi) + 1.76774599620756e-08*sin(6*chi)) lat
      from (select *, asin(sin(xi1)/cosh(eta1)) chi
        from (select *,
            xi - 0.000837732164082144e0*sin(2*xi)*cosh(2*eta) - 5.906110863719917e-08*sin(4*xi)*cosh(4*eta)
              - 1.6769911794379754e-10*sin(6*xi)*cosh(6*eta) xi1,
            eta - 0.000837732164082144e0*cos(2*xi)*sinh(2*eta) - 5.906110863719917e-08*cos(4*xi)*sinh(4*eta)
              - 1.6769911794379754e-10*cos(6*xi)*sinh(6*eta) eta1
          from (select *, (n-10000000e0)/(0.9996e0*6367449.145823415e0) xi,
              (e-500000e0)/(0.9996e0*6367449.145823415e0) eta from ({source}))))"""


def lon_lat(x: str, y: str) -> str:
    return f"151e0 + ({x})/100000e0 lon, -34e0 + ({y})/100000e0 lat"


RECTANGLE_HIT = " or ".join(f"(x0<={c} and x1>={a} and y0<={d} and y1>={b})" for a, b, c, d in L_BOXES)
LINE_HIT = " or ".join(_box_hit(*b) for b in L_BOXES)


def extracted(source: str, columns: str, kinds: str | None = None, area: bool = False) -> str:
    """A relation (kind, x0, y0, x1, y1, ...) cut by the outline, with bounds in metres; rings are closed.

    ``columns`` are expressions over the relation; ``kinds`` the geometry types that stay.
    """
    shoelace = " + ".join(
        f"(max(e) filter (where c={i})-min(e))*(max(n) filter (where c={i % 4 + 1})-min(n))"
        f" - (max(e) filter (where c={i % 4 + 1})-min(e))*(max(n) filter (where c={i})-min(n))" for i in (1, 2, 3, 4))
    return f"""
      with f as materialized (
        select *, row_number() over () rid from ({source})
        where (case when kind='LineString' then {LINE_HIT} else {RECTANGLE_HIT} end)
          {f"and kind in ({kinds})" if kinds else ""}),
      corners as (
        select rid, 1 c, {lon_lat('x0', 'y0')} from f
        union all select rid, 2, {lon_lat('x1', 'y0')} from f where kind='Polygon'
        union all select rid, 3, {lon_lat('x1', 'y1')} from f where kind<>'Point'
        union all select rid, 4, {lon_lat('x0', 'y1')} from f where kind='Polygon'),
      b as (select rid, cast(count(*) as integer) vertices, round(min(e),2) xmin, round(min(n),2) ymin,
          round(max(e),2) xmax, round(max(n),2) ymax, round(abs({shoelace})/2, 1) area
        from ({metres('from_corners', 'rid, c').replace('(from_corners)', 'corners')}) group by rid)
      select {columns}{', b.area area_m2' if area else ''}, kind geom_type,
        vertices + case when kind='Polygon' then 1 else 0 end vertices, xmin, ymin, xmax, ymax
      from f join b using (rid)"""


def shaped(kind: str, scale: int = 1, where: str = "true") -> str:
    return f"select *, {kind} kind from ({squares(scale, where).replace('select p_partkey fid', 'select p_brand, p_partkey fid')})"


def spots(table: str, key: str, side: int, kind: str = "'Point'") -> str:
    """Points, or rectangles of five steps where the kind says so."""
    far = f"case when kind='Polygon' then 5 else 0 end"
    return f"""select *, x0 + {far} x1, y0 + {far} y1 from (
      select *, {kind} kind, {px(key, side)} x0, {py(key, side)} y0 from {table})"""


POLYGON = "'Polygon'"
ID = "cast(fid as varchar) feature_id"
NONE = "cast(null as varchar)"
NUMBER = "cast(null as double)"
SOME_LINES = "case when p_size%4=0 then 'LineString' else 'Polygon' end"
UNDERGROUND = "p_size%3<>0 and p_size%7=0 is_underground"
LAND_CLASS = case_of(LAND, "'unknown'")


def sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["extract_roads"] = extracted(
        f"""select *, 'LineString' kind from ({ROADS})
          where split_part(fid,'-',2)<>'7' and cast(split_part(fid,'-',3) as bigint)%50<>0""",
        """fid feature_id, road_class, round(speed_limit_kmh,6) speed_limit_kmh, cast(null as double) lanes, is_bridge,
        is_tunnel, road_surface, round(width_m,6) width_m, is_link, is_under_construction, access_denied_foot,
        access_denied_bicycle, access_denied_hgv, has_access_restriction, subclass, route_count, has_national_route,
        road_name, round(min_speed_kmh,6) min_speed_kmh, is_variable_speed""")
    out["extract_pois"] = extracted(
        spots("customer", "c_custkey", 2000, "case when c_custkey%10=0 then 'Polygon' else 'Point' end"),
        """cast(c_custkey as varchar) feature_id, case when c_custkey%5<>0 then 'Place ' || c_custkey end as name,
        case when c_custkey%7<>0 then c_mktsegment else 'unknown' end category,
        round((c_custkey%100)/100e0,6) confidence,
        case when c_custkey%3=0 then 'S' || (c_custkey%7) || '|shop' end categories_alt""", "'Point'")
    out["extract_buildings"] = extracted(
        shaped(POLYGON), f"""{ID}, {case_of(CLASS, "'unknown'")} building_class,
        case when p_size%5<>0 then round(p_retailprice/100,6) end height,
        case when p_size%4<>0 then cast(p_size%9 as double) end num_floors, {NONE} facade_material, {NONE} roof_material,
        p_brand roof_shape, {NUMBER} roof_height, {NUMBER} num_floors_underground, {UNDERGROUND}""", area=True)
    land = " union all by name ".join(f"({text})" for text in (
        extracted(shaped(POLYGON, 10, "p_partkey%3=0"), f"""{ID}, 'land_use' land_type, {LAND_CLASS} land_class,
          p_brand land_subtype, case when p_size%2=0 then 'grass' end surface, false is_salt, false is_intermittent""", area=True),
        extracted(shaped(SOME_LINES, 10, "p_partkey%3=1"), f"""{ID}, 'land' land_type, {LAND_CLASS} land_class,
          {NONE} land_subtype, case when p_size%2=0 then 'rock' end surface, false is_salt, false is_intermittent""",
                  POLYGON, area=True),
        extracted(shaped(POLYGON, 10, "p_partkey%3=2"), f"""{ID}, 'water' land_type, {LAND_CLASS} land_class,
          {NONE} land_subtype, {NONE} surface, p_size%3<>0 and p_size%2=0 is_salt, p_size%5=0 is_intermittent""", area=True)))
    out["extract_landuse"] = f"select * from ({land})"
    out["extract_addresses"] = extracted(
        spots("supplier", "s_suppkey", 700),
        """cast(s_suppkey as varchar) feature_id, cast(s_suppkey%90 as varchar) number, 'Street ' || s_nationkey street,
        case when s_suppkey%4<>0 then cast(s_suppkey as varchar) end postcode,
        case when s_suppkey%3=0 then cast(s_suppkey as varchar) end unit, 'AU' country""")
    out["extract_infrastructure"] = extracted(
        f"""select * replace (case when kind='Point' then x0 else x1 end as x1, case when kind='Point' then y0 else y1 end as y1)
          from ({shaped("case fid%3 when 0 then 'Point' when 1 then 'LineString' else 'Polygon' end")})""",
        f"{ID}, case when fid%5<>0 then p_brand else 'unknown' end infra_class, p_type infra_subtype")
    out["extract_land_cover"] = extracted(
        shaped(POLYGON, 10), f"""{ID}, {case_of(LC, "'unknown'")} landcover_subtype""", area=True)
    out["extract_connectors"] = extracted(
        spots("orders", "o_orderkey", 5000), "cast(o_orderkey as varchar) feature_id")
    out["extract_building_parts"] = extracted(
        shaped(POLYGON), f"""{ID}, 'b' || (fid%100) building_id,
        case when p_size%5<>0 then round(p_retailprice/100,6) end height, {NUMBER} num_floors,
        case when p_size%2=0 then cast(p_size%3 as double) end num_floors_underground,
        case when p_size%6=0 then round(p_size/10e0,6) end min_height, {UNDERGROUND}""", area=True)
    divisions = " union all by name ".join(f"({text})" for text in (
        extracted(spots("supplier", "s_suppkey", 700), f"""'divisions' file, cast(s_suppkey as varchar) feature_id,
          'locality' division_subtype, case when s_suppkey%2=0 then 'town' end division_class,
          case when s_suppkey%4<>0 then cast(s_suppkey%9+1 as double) end admin_level,
          cast(s_suppkey*1000 as double) population"""),
        extracted(shaped(SOME_LINES, 10), f"""'division_areas' file, {ID}, p_type division_subtype, 'land' area_class,
          cast(p_size%6 as double) admin_level, p_size%2=0 is_land""", POLYGON),
        extracted(shaped("'LineString'", 10), f"'division_boundaries' file, {ID}")))
    out["extract_divisions"] = f"select * from ({divisions})"
    out["extract_bathymetry"] = extracted(shaped(POLYGON, 10, "p_partkey%2=0"), ID, area=True)
    counted = {"roads": "extract_roads", "pois": "extract_pois", "buildings": "extract_buildings",
               "landuse": "extract_landuse", "addresses": "extract_addresses", "infrastructure": "extract_infrastructure",
               "land_cover": "extract_land_cover", "connectors": "extract_connectors",
               "building_parts": "extract_building_parts", "bathymetry": "extract_bathymetry"}
    out["release_layers"] = " union all ".join(
        [f"select 'r1' release, '{layer}' layer, count(*) row_count from ({out[q]})" for layer, q in counted.items()]
        + [f"select 'r1', '{f}', count(*) from ({out['extract_divisions']}) where file='{f}'"
           for f in ("divisions", "division_areas", "division_boundaries")])
    step = "(greatest(10e0, 174e0/4)/111320e0)"
    pixels = f"""select embedding v, p, 151e0 + x/100000e0 + (p%2+0.5e0)*{step} lon,
        -34e0 + y/100000e0 + (1.5e0-p//2)*{step} lat
      from (select *, {px('vec_id', 1000)} x, {py('vec_id', 1000)} y, unnest(range(4)) p from embeddings)"""
    placed = cells(f"select v, p, e x, n y from ({metres(pixels, 'v, p')})")
    out["release_satellite"] = f"""select cell_id, count(*) pixel_count,
      {', '.join(f'round(avg(cast(v[({i}+16*p)%64+1] as double)),6) A{i:02d}' for i in range(64))}
      from ({placed}) where not isnan(v[(16*p)%64+1]) group by 1"""
    outline = ", ".join(f"({i}, {x}.3719e0, {y}.2917e0)" for i, (x, y) in enumerate(
        ((100, 100), (1900, 100), (1900, 900), (900, 900), (900, 1900), (100, 1900))))
    ring = [("1", "-0.5"), ("1", "0.5"), ("0", "1"), ("-1", "0.5"), ("-1", "-0.5"), ("0", "-1")]
    out["release_grid_degrees"] = f"""
      with o as materialized ({metres(f"select i, {lon_lat('x', 'y')} from (values {outline}) t(i, x, y)", 'i')}),
      edges as (select a.e ax, a.n ay, b.e bx, b.n ny from o a join o b on b.i=(a.i+1)%6),
      box as (select min(e) x0, max(e) x1, min(n) y0, max(n) y1 from o),
      c as (select q, r, (q + r/2e0)*{W} cx, r*(1.5e0*{E}) cy from (
        select *, unnest(range(cast(floor(x0/{W}-r/2e0-1) as bigint), cast(ceil(x1/{W}-r/2e0+1) as bigint)+1)) q from (
          select *, unnest(range(cast(floor(y0/(1.5e0*{E})-1) as bigint), cast(ceil(y1/(1.5e0*{E})+1) as bigint)+1)) r from box))),
      inside as (select q, r, cx, cy from c, edges where (ay>cy)<>(ny>cy) and cx < ax+(cy-ay)/(ny-ay)*(bx-ax)
        group by all having count(*)%2=1),
      corners as (select q, r, corner, cx+dx*{HALF_W} e, cy+dy*{E} n from inside,
        (values {', '.join(f'({i}, {dx}e0, {dy}e0)' for i, (dx, dy) in enumerate(ring))}) t(corner, dx, dy))
      select '9:' || q || ':' || r cell_id, corner, round(lon,8) lon, round(lat,8) lat
      from ({degrees('select * from corners', 'q, r, corner')})"""
    return out
