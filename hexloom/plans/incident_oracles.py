"""DuckDB statements for the incident queries."""

from __future__ import annotations

from hexloom.plans.geo_oracles import px, py

KEY = "user_id*31+event_id"
BOXES = {"a": (150.5, -34.2, 151.5, -33.5), "b": (152.7, -27.8, 153.3, -27.2), "c": (144.5, -38.1, 145.5, -37.5)}


def located(box) -> str:
    x0, y0, x1, y1 = (f"({v!r}e0)" for v in box)
    return f"""(select *, {x0}-0.1e0 + {px(KEY, 5000)}*(({x1}-{x0}+0.2e0)/5000e0) lon,
      {y0}-0.1e0 + {py(KEY, 5000)}*(({y1}-{y0}+0.2e0)/5000e0) lat, event_id i from events)"""


def inside(box) -> str:
    return (f"i%17<>0 and lon between {box[0]!r}e0 and {box[2]!r}e0 and lat between {box[1]!r}e0 and {box[3]!r}e0")


def text(v: str) -> str:
    return f"cast({v} as varchar)"


SEC = "date_trunc('second', ts)"
MS = "date_trunc('milliseconds', ts)"
NONE = "cast(null as varchar)"


def sql() -> dict[str, str]:
    out: dict[str, str] = {}
    a, b, c = BOXES["a"], BOXES["b"], BOXES["c"]
    out["incident_normalise_a"] = f"""
      select 'tfnsw:' || {text('i%3000')} incident_id, 'tfnsw' source, 'sydney' city,
        case event_type when 'click' then 'crash' when 'view' then 'breakdown' else 'hazard' end event_type,
        case when i%3=0 then 'Car' else 'Unplanned' end event_subtype,
        case when value>20 then 'major' else 'normal' end severity, round(lat,9) latitude, round(lon,9) longitude,
        case when i%11<>0 then 'Main ' || {text('user_id')} end road_name, {NONE} cross_street,
        case when i%11<>0 and i%2<>0 then 'Kensington' end suburb, {NONE} lga,
        case when i%11<>0 and i%3=0 then 'SYD_MET' end region, 'Event ' || {text('i')} description,
        case when i%7<>0 then 'Take care' end headline,
        case when i%4=0 then {MS} else {MS} - interval 1 minute end start_time,
        case when i%2<>0 and i%6<>0 then {MS} + interval 1 hour end end_time, event_type='purchase' ended,
        {MS} last_updated, cast(case when i%11<>0 and i%4>0 then i%4 end as integer) lanes_affected, {NONE} direction,
        case when i%5<>0 then 'Police,' || {text('user_id')} end attending_groups,
        case when i%3=0 then 'http://l/' || {text('i')} when i%3=1 then 'http://w/' end source_url, ts collected_at
      from {located(a)} where i%10<>0 and event_type<>'signup' and {inside(a)}"""
    out["incident_normalise_b"] = f"""
      select 'qldtraffic:' || {text('user_id%10')} incident_id, 'qldtraffic' source, 'brisbane' city,
        case event_type when 'click' then 'crash' when 'view' then 'hazard' when 'error' then 'flood' else 'congestion' end event_type,
        case when i%3<>0 then 'Multi' end event_subtype,
        case i%4 when 0 then 'high' when 1 then 'major' end severity, round(lat,9) latitude, round(lon,9) longitude,
        'Road ' || {text('user_id')} road_name, {NONE} cross_street, 'Milton' suburb, 'Brisbane' lga, {NONE} region,
        'Event ' || {text('i')} description, case when i%2=0 then 'Info' else 'Slow down' end headline,
        case when i%6<>0 then {SEC} else {SEC} - interval 10 hours end start_time, cast(null as timestamp) end_time,
        false ended, case when i%5<>0 then {SEC} + interval 5 minutes - interval 10 hours else {SEC} - interval 10 hours end last_updated,
        cast(null as integer) lanes_affected, 'Northbound' direction, {NONE} attending_groups,
        case when i%2=0 then 'http://u' else 'http://w' end source_url, date_trunc('hour', ts) collected_at
      from (select *, row_number() over (partition by date_trunc('hour', ts), user_id%10 order by i%2 desc, i desc) n from {located(b)})
      where n=1 and event_type<>'signup' and {inside(b)}"""
    out["incident_normalise_c"] = f"""
      select 'dtpvic:' || case when i%3=1 then {text('i')} when i%2=0 then 'E' || {text('i')} else 'I' || {text('i')} end incident_id,
        'dtpvic' source, 'melbourne' city,
        case when i%7=1 or i%9=0 then 'crash' when i%7=0 then 'breakdown' when i%7=2 then 'flood' when i%7=3 then 'fire'
             when i%7=4 then 'hazard' when i%9=1 or i%7=5 then 'roadwork' else 'other' end event_type,
        case i%7 when 0 then 'Stalled vehicle fire' when 1 then 'Rear-end COLLISION' when 2 then 'Road flooded'
          when 3 then 'Grass fire' when 4 then 'Animal on road' when 5 then 'Roadwork ahead' else 'Other' end event_subtype,
        {NONE} severity, round(lat,9) latitude, round(lon,9) longitude,
        case when i%3=0 then 'M1' else 'Local ' || {text('user_id')} end road_name, 'Cross' cross_street,
        case when i%2=0 then 'Fitzroy' else 'Carlton' end suburb, 'Yarra' lga, 'Metro' region, 'Event ' || {text('i')} description,
        {NONE} headline, {SEC} - interval 11 hours start_time, case when i%4=0 then {SEC} - interval 11 hours end end_time,
        i%4=0 ended, case when i%2=0 then {SEC} - interval 10 hours else {SEC} - interval 11 hours end last_updated,
        cast(case when i%4=0 then 2 end as integer) lanes_affected, 'Inbound' direction, {NONE} attending_groups,
        'http://v' source_url, ts collected_at
      from {located(c)} where {inside(c)}"""
    src = "case event_id%3 when 0 then 'tfnsw' when 1 then 'qldtraffic' else 'dtpvic' end"
    plain = f"""(select {src} || ':' || {text('event_id%300')} incident_id, {src} source,
      case event_id%3 when 0 then 'sydney' when 1 then 'brisbane' else 'melbourne' end city, event_type,
      event_type='signup' ended, ts collected_at, date_trunc('day', ts)::timestamp last_updated,
      date_trunc('hour', ts) start_time, {text('event_id')} raw_payload, lon, lat from {located(a)})"""
    out["incident_latest"] = f"""
      select incident_id, source, event_type, last_updated, collected_at, raw_payload from (
        select *, row_number() over (partition by incident_id order by last_updated desc, collected_at desc, raw_payload desc) n
        from {plain}) where n=1"""
    out["incident_counts"] = f"select city, event_type, count(*) n from {plain} group by 1, 2"
    life = f"""select incident_id, min(collected_at) first_seen, max(collected_at) last_seen, count(*) sightings,
      bool_or(ended) ended from {plain} group by 1"""
    out["incident_lifecycle"] = life
    out["incident_stream_lifecycle"] = life
    hav = """2e0*6371.0088e0*asin(sqrt(least(1e0, power(sin(radians(-33.8688e0-la)/2),2)
      + cos(radians(la))*cos(radians(-33.8688e0))*power(sin(radians(151.2093e0-lo)/2),2))))"""
    out["incident_history"] = f"""
      select incident_id, raw_payload, round(d,6) distance_km from (select *, {hav} d from (
        select *, round(lat,9) la, round(lon,9) lo from {plain}))
      where d<=40 and start_time between timestamp '2024-01-05' and timestamp '2024-01-15'"""
    out["backfill_windows"] = """
      select o_orderkey, w window_start, least(w + interval 90 day, e) window_end from (
        select o_orderkey, e, unnest(generate_series(o_orderdate, e, interval 90 day)) w
        from (select o_orderkey, o_orderdate, o_orderdate + to_days(cast(o_orderkey%400 as integer)) e from orders))
      where w < e"""
    out["poll_outcomes"] = """select event_type msg, count(*) n from events
      where ts > timestamp '2024-01-19' and ts <= timestamp '2024-01-20' group by 1"""
    out["partition_keys"] = """select strftime(ts, '%Y-%m-%d') dt, strftime(ts, '%H') as "hour",
      strftime(date_trunc('hour', ts), '%Y%m%dT%H%M%SZ') stamp, count(*) n from events group by 1, 2, 3"""
    out["incident_durations"] = f"""select {text('event_id')} raw_payload,
      cast((epoch_us(ts)-epoch_us(date_trunc('hour', ts)))//60000000 as bigint) as minutes from events"""
    out["incident_stream_dedup"] = f"select distinct incident_id, last_updated from {plain}"
    out["incident_closed"] = f"""select incident_id, first_seen, last_seen, sightings from (
        select incident_id, min(ts) first_seen, max(ts) last_seen, count(*) sightings from (
          select incident_id, ts, sum(fresh) over (partition by incident_id order by ts) spell from (
            select incident_id, collected_at ts, case when collected_at - lag(collected_at) over (
              partition by incident_id order by collected_at) <= interval 60 minute then 0 else 1 end fresh from {plain}))
        group by incident_id, spell)
      where last_seen + interval 60 minute <= (select max(ts) from events) - interval 1 hour"""
    out["incident_hourly"] = f"""select date_trunc('hour', collected_at) as "hour", source, count(*) n from {plain} group by 1, 2"""
    return out
