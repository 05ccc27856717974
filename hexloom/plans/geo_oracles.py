"""DuckDB statements that compute the geo queries on their own terms.

The SQL shares no code with the Spark side: it lists candidate cells from the bounding box, clips
lines by three slabs and integrates square-hexagon overlaps between breakpoints.
"""

from __future__ import annotations

E = "174e0"
SQ3 = "1.7320508075688772e0"
W = f"({SQ3}*{E})"
HALF_W = f"({SQ3}*{E}/2e0)"


def px(key: str, side: int) -> str:
    return f"cast((({key})*7919)%{side} as double)"


def py(key: str, side: int) -> str:
    return f"cast((({key})*104729)%{side} as double)"


def cells(source: str, keep: str = "*") -> str:
    """Adds cell_id to a relation with x and y."""
    return f"""
      select {keep}, '9:' || cast(cast(case when dq>dr and dq>ds then -r-s else q end as bigint) as varchar)
        || ':' || cast(cast(case when not (dq>dr and dq>ds) and dr>ds then -q-s else r end as bigint) as varchar) as cell_id
      from (select *, abs(q-fq) dq, abs(r-fr) dr, abs(s-fs) ds
        from (select *, floor(fq+0.5e0) q, floor(fr+0.5e0) r, floor(fs+0.5e0) s
          from (select *, -fq-fr fs
            from (select *, x/{W} - y/(3e0*{E}) fq, y/(1.5e0*{E}) fr from ({source})))))"""


POIS = f"""select c_custkey k, c_mktsegment category,
  case when c_custkey%3=0 then concat_ws('|', n_name, 'S' || cast(c_custkey%7 as varchar)) end alt,
  {px('c_custkey', 2000)} x, {py('c_custkey', 2000)} y
  from customer left join nation on c_nationkey=n_nationkey"""
ADDRESSES = f"""select s_suppkey k, n_name street, case when s_suppkey%4<>0 then s_suppkey end postcode,
  case when s_suppkey%3=0 then s_suppkey end unit, {px('s_suppkey', 700)} x, {py('s_suppkey', 700)} y
  from supplier left join nation on s_nationkey=n_nationkey"""
INFRA = f"""select p_partkey k, p_brand, {px('p_partkey', 2000)} x, {py('p_partkey', 2000)} y from part"""
CONNECTORS = f"""select o_orderkey k, {px('o_orderkey', 5000)} x, {py('o_orderkey', 5000)} y from orders"""

GRID = f"""
  select '9:' || cast(q as varchar) || ':' || cast(r as varchar) as cell_id, q, r, cx, cy
  from (select q, r, (q + r/2e0)*{W} cx, r*(1.5e0*{E}) cy
        from (select unnest(range(-12, 24)) q), (select unnest(range(-4, 16)) r))
  where (cx>100 and cx<1900 and cy>100 and cy<900) or (cx>100 and cx<900 and cy>100 and cy<1900)"""
CELL_AREA = f"1.5e0*{SQ3}*{E}*{E}"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
POI_AGG = f"""
  with p as ({cells(POIS)}),
  alts as (select cell_id, count(distinct a) n from (select cell_id, unnest(string_split(alt,'|')) a from p where alt is not null) group by 1)
  select p.cell_id, count(*) poi_count_total, count(distinct category) poi_category_diversity,
    {', '.join(f"count(*) filter (where category='{c}') poi_count_{c}" for c in SEGMENTS)},
    count(*) filter (where category not in ('{"','".join(SEGMENTS)}')) poi_count_other,
    coalesce(any_value(alts.n), 0) poi_alt_category_diversity,
    avg(case when alt is not null then 1e0 else 0e0 end) poi_has_alt_category_pct
  from p left join alts on p.cell_id=alts.cell_id group by p.cell_id"""

ROADS = f"""
  select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar)) fid,
    {px('l_orderkey*8+l_linenumber', 5000)} x0, {py('l_orderkey*8+l_linenumber', 5000)} y0,
    {px('l_orderkey*8+l_linenumber', 5000)} + (l_partkey%400-200) x1,
    {py('l_orderkey*8+l_linenumber', 5000)} + (l_suppkey%400-200) y1,
    case when l_returnflag='A' then 'primary' when l_returnflag='N' then 'residential'
         when l_orderkey%2=0 then 'goat_track' else 'unknown' end road_class,
    case when l_linenumber%3<>0 then (l_quantity+40) * case when l_linenumber%2=0 then 1.60934e0 else 1e0 end end speed_limit_kmh,
    case when l_linenumber%5=0 then l_quantity * case when l_linenumber%2=0 then 1.60934e0 else 1e0 end end min_speed_kmh,
    l_suppkey%11=0 is_variable_speed, l_suppkey%5-2 > 0 is_bridge, l_suppkey%5-2 < 0 is_tunnel,
    case l_partkey%7 when 0 then 'asphalt' when 1 then 'gravel' when 2 then 'paved' when 3 then 'marble' when 4 then 'dirt' end road_surface,
    case when l_partkey%4=0 then l_quantity/10+3 end width_m,
    l_linestatus='F' is_link, l_suppkey%10=0 is_under_construction,
    l_partkey%12=0 access_denied_foot, l_partkey%18=0 access_denied_bicycle,
    l_partkey%6=0 and l_suppkey%4=0 access_denied_hgv, l_partkey%6=0 has_access_restriction,
    case l_orderkey%5 when 0 then 'link' when 1 then 'alley' when 2 then 'tunnelway' end subclass,
    cast(case when l_suppkey%2<>0 and l_orderkey%4=0 then 1 else 2 end as integer) route_count,
    l_suppkey%2=0 has_national_route,
    case when l_partkey%3=0 then 'Road ' || cast(l_suppkey%50 as varchar) end road_name
  from lineitem"""

SLABS = (("1e0", "0e0"), ("0.5e0", "0.86602540378443865e0"), ("-0.5e0", "0.86602540378443865e0"))


def clip_lines(source: str) -> str:
    """Pieces of straight lines (x0,y0,x1,y1) with their length in each cell."""
    enter, leave = ["0e0"], ["1e0"]
    for a, b in SLABS:
        o, v = f"((x0-cx)*{a}+(y0-cy)*{b})", f"((x1-x0)*{a}+(y1-y0)*{b})"
        enter.append(f"case when abs({v})<1e-12 then (case when abs({o})>{HALF_W} then 2e0 else 0e0 end) "
                     f"else least((-{HALF_W}-{o})/{v}, ({HALF_W}-{o})/{v}) end")
        leave.append(f"case when abs({v})<1e-12 then 1e0 else greatest((-{HALF_W}-{o})/{v}, ({HALF_W}-{o})/{v}) end")
    return f"""
      select * from (
        select *, '9:' || cast(q as varchar) || ':' || cast(r as varchar) as cell_id,
          (least({', '.join(leave)}) - greatest({', '.join(enter)})) * sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) as ln
        from (select *, (q + r/2e0)*{W} cx, r*(1.5e0*{E}) cy
          from (select *, unnest(range(cast(floor(least(x0,x1)/{W}-r/2e0-1) as bigint), cast(ceil(greatest(x0,x1)/{W}-r/2e0+1) as bigint)+1)) q
            from (select *, unnest(range(cast(floor(least(y0,y1)/(1.5e0*{E})-1) as bigint), cast(ceil(greatest(y0,y1)/(1.5e0*{E})+1) as bigint)+1)) r
              from ({source}))))) where ln > 0"""


PIECES = clip_lines(ROADS)


def road(columns: dict[str, str], digits: int = 4) -> str:
    """Road aggregates; text columns are rounded unless marked with a leading '#'."""
    out = []
    for name, sql in columns.items():
        out.append(f"{sql[1:]} as {name}" if sql.startswith("#") else f"round({sql}, {digits}) as {name}")
    return f"select cell_id, {', '.join(out)} from ({PIECES}) group by cell_id"


def total_where(cond: str) -> str:
    return f"coalesce(sum(case when {cond} then ln end), 0e0)"


def mean_of(col: str) -> str:
    return f"coalesce(sum({col}*ln)/nullif({total_where(col + ' is not null')}, 0), 0e0)"


def share(cond: str) -> str:
    return f"{total_where(cond)}/sum(ln)"


def squares(scale: int, where: str = "true") -> str:
    return f"""select p_partkey fid, p_type, p_size, p_retailprice, {px('p_partkey', 2000)} x0, {py('p_partkey', 2000)} y0,
      {px('p_partkey', 2000)} + p_size*{scale} x1, {py('p_partkey', 2000)} + p_size*{scale} y1 from part where {where}"""


def overlap(source: str) -> str:
    """Squares (x0,y0,x1,y1) with their exact overlap area in each cell."""
    bottom, top = f"greatest(y0, cy-{E})", f"least(y1, cy+{E})"
    raw = [bottom, top, f"cy-{E}/2", f"cy+{E}/2"]
    for x in ("x0", "x1"):
        raw += [f"cy-({E}-abs({x}-cx)/{SQ3})", f"cy+({E}-abs({x}-cx)/{SQ3})"]
    clamped = [f"least(greatest({v}, {bottom}), {top})" for v in raw]
    half = lambda y: f"least({HALF_W}, {SQ3}*({E}-abs({y}-cy)))"
    width = lambda y: f"greatest(0e0, least(x1, cx+{half(y)}) - greatest(x0, cx-{half(y)}))"
    return f"""
      select * from (
        select * exclude (bp), list_sum(list_transform(range(1, len(bp)),
          lambda i: (bp[i+1]-bp[i]) * ({width('bp[i]')} + {width('bp[i+1]')}) / 2e0)) area
        from (select *, list_sort([{', '.join(clamped)}]) bp, '9:' || cast(q as varchar) || ':' || cast(r as varchar) as cell_id
          from (select *, (q + r/2e0)*{W} cx, r*(1.5e0*{E}) cy
            from (select *, unnest(range(cast(floor(x0/{W}-r/2e0-1) as bigint), cast(ceil(x1/{W}-r/2e0+1) as bigint)+1)) q
              from (select *, unnest(range(cast(floor(y0/(1.5e0*{E})-1) as bigint), cast(ceil(y1/(1.5e0*{E})+1) as bigint)+1)) r
                from ({source}))))
          where {bottom} < {top} and least(x1, cx+{HALF_W}) > greatest(x0, cx-{HALF_W}))) where area > 1e-9"""


# Cells with their centre in each square; a centre on the lower or left side counts as inside.
COVERED = f"""select *, '9:' || cast(q as varchar) || ':' || cast(r as varchar) as cell_id
  from (select *, (q + r/2e0)*{W} cx, r*(1.5e0*{E}) cy
    from (select *, unnest(range(cast(floor(x0/{W}-r/2e0-1) as bigint), cast(ceil(x1/{W}-r/2e0+1) as bigint)+1)) q
      from (select *, unnest(range(cast(floor(y0/(1.5e0*{E})-1) as bigint), cast(ceil(y1/(1.5e0*{E})+1) as bigint)+1)) r
        from ({squares(10)}))))
  where cx>=x0 and cx<x1 and cy>=y0 and cy<y1"""


def case_of(words: dict[str, str], other: str = "null") -> str:
    return "case p_type " + " ".join(f"when '{k}' then '{v}'" for k, v in words.items()) + f" else {other} end"


LU = {"ECONOMY": "forest", "STANDARD": "park", "PROMO": "residential", "MEDIUM": "industrial"}
LC = {"ECONOMY": "forest", "STANDARD": "grass", "PROMO": "urban", "MEDIUM": "crop"}
CENTRED = cells(f"select *, (x0+x1)/2 x, (y0+y1)/2 y, (x1-x0)*(y1-y0) area from ({squares(1)})")

LANDUSE_AGG = f"""
  select cell_id, sum(area) total, {', '.join(f"coalesce(sum(area) filter (where cls='{c}'), 0e0) a_{c}" for c in ['forest','park','residential','industrial','other'])}
  from (select *, {case_of(LU, "'other'")} cls from ({overlap(squares(10))})) group by 1"""

BRANDS = [f"Brand#{i}" for i in range(1, 21)]

INFRA_SQL = f"""select cell_id, count(*) infra_count_total, count(distinct p_brand) infra_class_diversity,
  {', '.join(f"count(*) filter (where p_brand='{b}') as infra_count_{b.replace('#', '_')}" for b in BRANDS)},
  count(*) filter (where p_brand not in ({','.join(f"'{b}'" for b in BRANDS)})) as infra_count_other
  from ({cells(INFRA)}) group by 1"""
CONNECTOR_SQL = f"""select cell_id, count(*) connector_count_total,
  round(count(*)/(2.598e0*0.174e0*0.174e0), 6) connector_density_per_km2 from ({cells(CONNECTORS)}) group by 1"""
PIXELS = f"select vec_id, embedding band, {px('vec_id', 1000)} x, {py('vec_id', 1000)} y from embeddings"
PIXEL_MEANS = f"""select cell_id, count(*) pixel_count,
  {', '.join(f"avg(cast(band[{i + 1}] as double)) as A{i:02d}" for i in range(64))}
  from ({cells(PIXELS)}) where not isnan(band[1]) group by 1"""

DIVISION_SQL = f"""
  with pts as (select cell_id, count(*) n, min(lv) lo, max(lv) hi from (
      {cells(f"select case when s_suppkey%4<>0 then s_suppkey%9+1 end lv, {px('s_suppkey', 700)} x, {py('s_suppkey', 700)} y from supplier")}) group by 1),
  ars as (select cell_id, count(*) n from ({overlap(squares(10))}) group by 1),
  lns as (select cell_id, sum(ln) l from ({clip_lines(f'''
      select fid, x0, y0, x1, y0 as y1 from ({squares(10)}) union all
      select fid, x1 as x0, y0, x1, y1 from ({squares(10)}) union all
      select fid, x1 as x0, y1 as y0, x0 as x1, y1 from ({squares(10)})''')}) group by 1),
  ids as (select cell_id from pts union select cell_id from ars union select cell_id from lns)
  select ids.cell_id, coalesce(pts.n,0) division_count, coalesce(cast(pts.lo as double),0e0) division_min_admin_level,
    coalesce(cast(pts.hi as double),0e0) division_max_admin_level, coalesce(ars.n,0) division_area_count,
    round(coalesce(lns.l,0e0),4) division_boundary_length_m
  from ids left join pts using(cell_id) left join ars using(cell_id) left join lns using(cell_id)"""

WIDE = f"""
  with g as ({GRID}),
  rd as (select cell_id, sum(ln) v, max(case when is_bridge then 1 else 0 end) b, max(case when is_tunnel then 1 else 0 end) t,
      max(case when is_link then 1 else 0 end) k, max(case when is_under_construction then 1 else 0 end) u,
      max(case when has_access_restriction then 1 else 0 end) ar, max(case when access_denied_foot then 1 else 0 end) af,
      max(case when access_denied_bicycle then 1 else 0 end) ab, max(case when access_denied_hgv then 1 else 0 end) ah,
      count(distinct road_name) nm from ({PIECES}) group by 1),
  po as ({POI_AGG}),
  bu as (select cell_id, count(*) n, count(*) filter (where p_type='ECONOMY') nh,
      coalesce(sum(area) filter (where p_type='ECONOMY'), 0e0) ah, coalesce(avg(case when p_size%5<>0 then p_retailprice/100 end),0e0) hh
      from ({CENTRED}) group by 1),
  lu as ({LANDUSE_AGG}),
  ad as (select cell_id, count(*) n from ({cells(ADDRESSES)}) group by 1),
  inf as (select cell_id, count(*) n from ({cells(INFRA)}) group by 1),
  co as (select cell_id, count(*) n from ({cells(CONNECTORS)}) group by 1),
  dv as (select cell_id, count(*) n from ({cells(f"select {px('s_suppkey', 700)} x, {py('s_suppkey', 700)} y from supplier")}) group by 1),
  ba as (select cell_id, sum(area) v from ({overlap(squares(10))}) group by 1)"""
WIDE_FROM = """ from g left join rd using(cell_id) left join po using(cell_id) left join bu using(cell_id)
  left join lu using(cell_id) left join ad using(cell_id) left join inf using(cell_id)
  left join co using(cell_id) left join dv using(cell_id) left join ba using(cell_id)"""


def _l(expr: str) -> str:
    return f"round(ln(1e0+coalesce({expr},0)), 6)"


_H = f"(2.598e0*0.174e0*0.174e0)"

# Krueger series with numeric coefficients of the WGS 84 ellipsoid.
_UTM = """
  select o_orderkey, 'EPSG:' || case when lat>=0 then '326' else '327' end || lpad(cast(zone as varchar), 2, '0') crs,
    round(500000e0 + 0.9996e0*6367449.145823415e0*(eta
      + 0.0008377318188192541e0*cos(2*xi)*sinh(2*eta) + 7.608496958699166e-07*cos(4*xi)*sinh(4*eta)
      + 1.2034877875966644e-09*cos(6*xi)*sinh(6*eta)), 3) easting,
    round(case when lat<0 then 10000000e0 else 0e0 end + 0.9996e0*6367449.145823415e0*(xi
      + 0.0008377318188192541e0*sin(2*xi)*cosh(2*eta) + 7.608496958699166e-07*sin(4*xi)*cosh(4*eta)
      + 1.2034877875966644e-09*sin(6*xi)*cosh(6*eta)), 3) northing
  from (select *, atan2(tau, cos(lam)) xi, asinh(sin(lam)/sqrt(tau*tau+cos(lam)*cos(lam))) eta
    from (select *, sinh(atanh(sin(phi)) - 0.08181919084262149e0*atanh(0.08181919084262149e0*sin(phi))) tau
      from (select *, radians(lat) phi, radians(lon-(zone*6-183)) lam
        from (select *, least(greatest(cast(floor((lon+180)/6) as integer)+1, 1), 60) zone
          from (select o_orderkey, (o_orderkey*7919%360000)/1000e0-180e0 lon, (o_orderkey*104729%160000)/1000e0-80e0 lat from orders)))))"""

_L_HIT = """((x0<=1900 and x1>=100 and y0<=900 and y1>=100) or (x0<=900 and x1>=100 and y0<=1900 and y1>=100))"""


# The outline of boundary_filter_slit as closed rectangles.
SLIT_BOXES = [(100, 100, 600, 1500), (100, 100, 1500, 300), (640, 100, 900, 1500), (1200, 100, 1500, 1500),
              (640, 100, 1500, 700), (640, 1100, 1500, 1500), (1600, 1600, 1900, 1900)]


def _box_hit(ax, ay, bx, by):
    """Straight line against a closed box by clipping the parameter range."""
    lo, hi = ["0e0"], ["1e0"]
    ok = []
    for p, d, a, b in (("x0", "(x1-x0)", ax, bx), ("y0", "(y1-y0)", ay, by)):
        lo.append(f"case when {d}=0 then 0e0 else least(({a}-{p})/{d}, ({b}-{p})/{d}) end")
        hi.append(f"case when {d}=0 then 1e0 else greatest(({a}-{p})/{d}, ({b}-{p})/{d}) end")
        ok.append(f"({d}<>0 or {p} between {a} and {b})")
    return f"({' and '.join(ok)} and greatest({', '.join(lo)}) <= least({', '.join(hi)}))"


def sql() -> dict[str, str]:
    out: dict[str, str] = {}
    pct = "poi_has_alt_category_pct"
    counts = ["poi_count_total", "poi_category_diversity", *[f"poi_count_{c}" for c in SEGMENTS],
              "poi_count_other", "poi_alt_category_diversity"]
    out["poi_hex_features"] = f"""
      with g as ({GRID}), a as ({POI_AGG})
      select g.cell_id, round({CELL_AREA}, 6) cell_area_m2, {', '.join(f'coalesce(a.{c}, 0) {c}' for c in counts)},
        round(coalesce(a.{pct}, 0e0), 6) {pct} from g left join a on g.cell_id=a.cell_id"""
    out["address_hex"] = f"""select cell_id, count(*) address_count_total,
      round(avg(case when postcode is not null then 1e0 else 0e0 end), 6) address_has_postcode_pct,
      round(avg(case when unit is not null then 1e0 else 0e0 end), 6) address_has_unit_pct,
      count(distinct street) address_unique_streets from ({cells(ADDRESSES)}) group by 1"""
    out["infra_hex"] = INFRA_SQL
    out["connector_density"] = CONNECTOR_SQL
    out["road_hex_core"] = road({"total_road_length_m": "sum(ln)", "road_segment_count": "#count(*)",
                                 "avg_edge_length_m": "avg(ln)"})
    known_cls = {"primary": "primary", "residential": "residential", "unknown": "unknown",
                 "motorway": "motorway", "other": "goat_track"}
    known_sub = {"link": "link", "alley": "alley", "driveway": "driveway", "other": "tunnelway"}
    known_srf = {"asphalt": "asphalt", "gravel": "gravel", "paved": "paved", "dirt": "dirt",
                 "sett": "sett", "other": "marble"}
    out["road_class_lengths"] = road({
        **{f"road_length_{k}_m": total_where(f"road_class='{v}'") for k, v in known_cls.items()},
        **{f"road_length_subclass_{k}_m": total_where(f"subclass='{v}'") for k, v in known_sub.items()}})
    out["road_speed_weighted"] = road({
        "avg_maxspeed_kmh": mean_of("speed_limit_kmh"),
        "maxspeed_coverage_pct": share("speed_limit_kmh is not null"),
        "avg_min_speed_kmh": mean_of("min_speed_kmh"),
        "min_speed_coverage_pct": share("min_speed_kmh is not null"),
        "has_variable_speed_pct": share("is_variable_speed")})
    out["road_flag_fractions"] = road({
        **{f"pct_{c}_length": share(c) for c in (
            "is_bridge", "is_tunnel", "is_link", "is_under_construction", "access_denied_foot",
            "access_denied_bicycle", "access_denied_hgv")},
        "has_access_restriction_pct": share("has_access_restriction")})
    out["road_surface_width"] = road({
        "road_surface_coverage_pct": share("road_surface is not null"),
        "road_surface_paved_pct": share("road_surface in ('asphalt','paved')"),
        "road_surface_unpaved_pct": share("road_surface in ('gravel','dirt')"),
        **{f"road_surface_length_{k}_m": total_where(f"road_surface='{v}'") for k, v in known_srf.items()},
        "road_width_coverage_pct": share("width_m is not null"),
        "avg_road_width_m": mean_of("width_m"), "max_road_width_m": "coalesce(max(width_m), 0e0)"})
    out["road_names_routes"] = road({
        "named_road_pct": share("road_name is not null"),
        "unique_road_names": "#count(distinct road_name)",
        "route_count_total": "#cast(sum(route_count) as bigint)",
        "has_national_route": "#max(case when has_national_route then 1e0 else 0e0 end)"})
    out["road_attributes"] = f"""select fid feature_id, road_class, round(speed_limit_kmh,6) speed_limit_kmh,
      cast(null as double) lanes, is_bridge, is_tunnel, road_surface, round(width_m,6) width_m, is_link,
      is_under_construction, access_denied_foot, access_denied_bicycle, access_denied_hgv,
      has_access_restriction, subclass, route_count, has_national_route, road_name,
      round(min_speed_kmh,6) min_speed_kmh, is_variable_speed from ({ROADS})"""
    bcls = {"house": "p_type='ECONOMY'", "garage": "p_type='STANDARD'", "school": "p_type='PROMO'",
            "unknown": "p_type in ('LARGE','SMALL')", "barn": "false", "other": "p_type='MEDIUM'"}
    out["building_hex"] = f"""select cell_id, count(*) building_count, round(sum(area),9) building_total_area_m2,
      round(coalesce(avg(case when p_size%5<>0 then p_retailprice/100 end),0e0),9) avg_building_height_m,
      {', '.join(f"count(*) filter (where {v}) building_count_{k}" for k, v in bcls.items())},
      {', '.join(f"round(coalesce(sum(area) filter (where {v}),0e0),9) building_area_{k}_m2" for k, v in bcls.items())}
      from ({CENTRED}) group by 1"""
    out["building_part_hex"] = f"""select cell_id, count(*) building_part_count, round(sum(area),9) building_part_total_area_m2,
      round(coalesce(avg(case when p_size%5<>0 then p_retailprice/100 end),0e0),9) building_part_avg_height_m,
      round(coalesce(avg(case when p_size%4<>0 then cast(p_size%9 as double) end),0e0),9) building_part_avg_num_floors,
      count(*) filter (where p_size%7=0) building_part_underground_count from ({CENTRED}) group by 1"""
    out["landuse_hex"] = f"""select cell_id, round(total,4) landuse_total_area_m2,
      {', '.join(f'round(a_{c},4) landuse_area_{c}_m2' for c in ['forest', 'park', 'residential', 'industrial', 'other'])},
      0e0 landuse_area_zoo_m2, round((a_forest+a_park)/total,4) total_green_fraction,
      round((a_residential+a_industrial)/total,4) total_built_fraction from ({LANDUSE_AGG})"""
    lc_words = ["barren", "crop", "forest", "grass", "mangrove", "moss", "shrub", "snow", "urban", "wetland"]
    lc_sum = lambda cond: f"coalesce(sum(area) filter (where {cond}),0e0)"
    out["landcover_fraction"] = f"""select cell_id, round(sum(area),4) landcover_total_area_m2,
      {', '.join(f'''round({lc_sum(f"cls='{c}'")},4) landcover_area_{c}_m2''' for c in lc_words)},
      round({lc_sum("cls='other'")},4) landcover_area_other_m2,
      round({lc_sum("cls in ('forest','grass')")}/sum(area),4) landcover_green_fraction,
      round({lc_sum("cls='urban'")}/sum(area),4) landcover_urban_fraction
      from (select *, {case_of(LC, "'other'")} cls from ({overlap(squares(10))})) group by 1"""
    out["bathymetry_hex"] = f"""select cell_id, round(sum(area),4) bathymetry_area_m2,
      round(least(greatest(sum(area)/({CELL_AREA}),0e0),1e0),4) bathymetry_fraction
      from ({overlap(squares(10))}) group by 1"""
    out["division_counts"] = DIVISION_SQL
    out["hex_grid"] = f"select fid feature_id, cell_id, q, r, round({CELL_AREA},4) cell_area_m2 from ({COVERED})"
    out["cell_outline"] = f"""select fid feature_id, cell_id, 9 resolution, round(cx-{HALF_W},4) xmin, round(cy-{E},4) ymin,
      round(cx+{HALF_W},4) xmax, round(cy+{E},4) ymax, round({CELL_AREA},4) area_m2 from ({COVERED})"""
    out["bbox_filter"] = f"""select fid feature_id, x0 xmin, y1 ymax from ({squares(1)})
      where x0<=1500 and x1>=500 and y0<=1200 and y1>=500"""
    out["polygon_filter"] = f"select fid feature_id from ({squares(10)}) where {_L_HIT}"
    out["line_filter"] = f"""select fid feature_id from ({ROADS})
      where {_box_hit('100e0', '100e0', '1900e0', '900e0')} or {_box_hit('100e0', '100e0', '900e0', '1900e0')}"""
    boxes = lambda test: " or ".join(test(*(f"{v}e0" for v in b)) for b in SLIT_BOXES)
    over = boxes(lambda a, b, c, d: f"(x0<={c} and x1>={a} and y0<={d} and y1>={b})")
    out["boundary_filter_slit"] = f"""select 'p' || k feature_id from (select k, x x0, y y0, x x1, y y1 from ({POIS})) where {over}
      union all select 's' || fid from ({squares(10)}) where {over}
      union all select 'l' || fid from ({squares(100)}) where {over}
      union all select 'r' || fid from ({ROADS}) where {boxes(_box_hit)}"""
    out["utm_project"] = _UTM
    out["geometry_decode"] = f"""select fid p_partkey,
      case fid%3 when 0 then 'Point' when 1 then 'LineString' else 'Polygon' end geom_type,
      case when fid%3=2 then round(cast(p_size*p_size as double),4) end area,
      case when fid%3=1 then round(cast(3*p_size as double),4) end length,
      round(case when fid%3=0 then x0 else x0+p_size/2e0 end,4) cx,
      round(case fid%3 when 0 then y0 when 1 then y0+p_size*2e0/3 else y0+p_size/2e0 end,4) cy
      from ({squares(1)})"""
    out["geometry_decode_bytes"] = out["geometry_decode"]
    out["hex_features_wide"] = f"""{WIDE} select g.cell_id, round({CELL_AREA},4) cell_area_m2,
      round(coalesce(rd.v,0e0),4) total_road_length_m, coalesce(po.poi_count_total,0) poi_count_total,
      coalesce(bu.n,0) building_count, round(coalesce(lu.total,0e0),4) landuse_total_area_m2,
      coalesce(ad.n,0) address_count_total, coalesce(inf.n,0) infra_count_total,
      round(coalesce(lu.total,0e0),4) landcover_total_area_m2, coalesce(co.n,0) connector_count_total,
      coalesce(bu.n,0) building_part_count, coalesce(dv.n,0) division_count,
      round(coalesce(ba.v,0e0),4) bathymetry_area_m2 {WIDE_FROM}"""
    flags = {"has_bridge": "b", "has_tunnel": "t", "has_link": "k", "has_under_construction": "u",
             "has_access_restrictions": "ar", "has_foot_restriction": "af",
             "has_bicycle_restriction": "ab", "has_hgv_restriction": "ah"}
    out["hex_ml_features"] = f"""{WIDE} select g.cell_id, {_l('rd.v')} log1p_total_road_length_m,
      {_l('po.poi_count_total')} log1p_poi_count_total, {_l('po.poi_count_BUILDING')} log1p_poi_count_BUILDING,
      {_l('bu.nh')} log1p_building_count_house, {_l('bu.ah')} log1p_building_area_house_m2,
      {_l('lu.a_forest')} log1p_landuse_area_forest_m2,
      {_l(f'co.n/{_H}')} log1p_connector_density_per_km2, {_l('bu.hh')} log1p_building_part_avg_height_m,
      {_l('rd.nm')} log1p_unique_road_names,
      {', '.join(f'cast(coalesce(rd.{v},0) as integer) {k}' for k, v in flags.items())} {WIDE_FROM}"""
    out["schema_violations"] = """
      select * from (
        select 'feature_id' column_name, 'null' problem, count(*) filter (where p_partkey%10=0) null_count from part
        union all select 'rings', 'null', count(*) filter (where p_partkey%4=0) from part
        union all select unnest(['num_floors','area_m2','facade_material','roof_material','roof_shape','roof_height',
          'num_floors_underground','is_underground']), 'missing', 0)"""
    out["layer_manifest"] = """
      select 'roads' layer, count(*) row_count from lineitem union all select 'pois', count(*) from customer
      union all select 'buildings', count(*) from part union all select 'addresses', count(*) from supplier
      union all select 'connectors', count(*) from orders
      union all select 'bathymetry', count(*) from part"""
    out["satellite_hex_mean"] = f"""select cell_id, pixel_count,
      {', '.join(f'round(A{i:02d},6) A{i:02d}' for i in range(64))} from ({PIXEL_MEANS})"""
    out["satellite_stream_mean"] = out["satellite_hex_mean"]
    # roads 65, pois 9, buildings 155, landuse 130, addresses 4, infrastructure 23, land cover 14,
    # connectors 2, parts 5, divisions 5, bathymetry 2, cell id and area
    out["hex_ml_schema"] = f"""select count(*) hexes, cast(65+9+155+130+4+23+14+2+5+5+2+2 as integer) raw_columns,
      cast(26+13+3 + 8 + 153+5 + 128 + 23 + 12 + 2 + 2 + 3 + 1 as integer) log_columns, 8 indicator_columns from ({GRID})"""
    out["satellite_summary"] = f"""select round(avg(pixel_count),6) avg_pixels_per_hex, count(*) hexes from ({PIXEL_MEANS})"""
    out["merge_features_embeddings"] = f"""select c.cell_id, c.connector_count_total,
      {', '.join(f'round(m.A{i:02d},6) A{i:02d}' for i in range(64))} from ({CONNECTOR_SQL}) c left join ({PIXEL_MEANS}) m on c.cell_id=m.cell_id"""
    out["merge_match_counts"] = f"""select count(*) hexes, count(m.cell_id) matched, count(*)-count(m.cell_id) unmatched
      from ({CONNECTOR_SQL}) c left join ({PIXEL_MEANS}) m on c.cell_id=m.cell_id"""
    out["pixel_grid"] = f"""select tile, cast(px as integer) px, cast(py as integer) py,
      round(x0+(px+0.5e0)*10,6) x, round(y0+30-(py+0.5e0)*10,6) y
      from (select s_suppkey tile, {px('s_suppkey', 700)} x0, {py('s_suppkey', 700)} y0 from supplier),
        (select unnest(range(3)) px), (select unnest(range(3)) py)"""
    return out
