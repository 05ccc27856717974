"""DuckDB statements for the catalogue queries."""

from __future__ import annotations

from hexloom.plans.geo_oracles import ROADS

CATS = ["traffic", "eta", "gps-trajectory", "satellite", "energy", "weather", "demographics"]
LABELS = ["Traffic", "ETA", "GPS & Trajectory", "Satellite", "Energy", "Weather", "Demographics"]
NOW = "timestamp '2025-03-01 00:00:00'"


def _case(expr: str, values: list[str], default: str) -> str:
    return f"case {expr} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + f" else {default} end"


D = f"""(select 'doc-' || cast(doc_id as varchar) id, 'Doc ' || cast(doc_id as varchar) as name,
  {_case("cast(substr(source,4) as integer)%8", CATS, "'unlisted'")} category, lang region,
  case when doc_id%2=0 then 'raw' else 'processed' end stage,
  case when doc_id%7<>0 then 'pair-' || cast(doc_id//4 as varchar) end pair_id,
  case when doc_id%10=0 then '2020 only' end timespan,
  case when doc_id%3=0 then date '2019-01-01' + cast(doc_id%1000 as integer) end t0,
  case when doc_id%3=0 and doc_id%6<>0 then date '2019-01-01' + cast(doc_id%1000 + doc_id%900 as integer) end t1,
  case when doc_id%3=0 then '' when doc_id%3=1 then 'Team ' || cast(doc_id%11 as varchar) end maintainer,
  n_chars size_bytes, case when doc_id%5<>0 then doc_id%100 end file_count,
  case doc_id%6 when 0 then 'CSV' when 1 then 'Parquet' when 2 then 'JSON' end format,
  timestamp '2025-01-01' + to_hours(cast(doc_id//3 as integer)) last_modified, doc_id, text description,
  case when doc_id%6<>5 then list_transform(range(1, cast(doc_id%6+2 as bigint)), lambda i: 'Tag' || cast((doc_id+i)%40 as varchar)) end tags
  from documents)"""

F = """(select case when page_id%2=0 then 'raw/' else 'processed/' end || regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1)
    || case page_id%5 when 0 then '.parquet' when 1 then '.csv' when 2 then '.JSON' when 3 then '.tar.gz' else '' end as key,
  case when page_id%50=0 then 0 else length(html) end as size,
  timestamp '2025-01-01' + to_minutes(cast(page_id as integer)) last_modified from pages)"""

EXT = "case when position('.' in key)>0 then nullif(lower(split_part(key, '.', -1)), '') end"
FORMAT = """case ext when 'parquet' then 'Parquet' when 'csv' then 'CSV' when 'json' then 'JSON' when 'nc' then 'NetCDF'
  when 'netcdf' then 'NetCDF' when 'tif' then 'GeoTIFF' when 'tiff' then 'GeoTIFF' when 'geojson' then 'GeoJSON'
  when 'zip' then 'ZIP' when 'gz' then 'GZ' when 'tar' then 'TAR' when 'png' then 'PNG' when 'avro' then 'Avro'
  else coalesce(upper(ext), 'Unknown') end"""
PREFIX = "case when regexp_extract(key, '^([^/]+/[^/]+/)', 1)<>'' then regexp_extract(key, '^([^/]+/[^/]+/)', 1) else key end"

STATS = f"""(select s.prefix, s.size_bytes, s.file_count, s.last_modified, {FORMAT} format from
  (select {PREFIX} prefix, cast(sum(size) as bigint) size_bytes, count(*) file_count, max(last_modified) last_modified
   from {F} where size>0 group by 1) s left join
  (select prefix, ext from (select {PREFIX} prefix, {EXT} ext,
     row_number() over (partition by {PREFIX} order by count(*) desc, {EXT}) n
   from {F} where size>0 and {EXT} is not null group by 1, 2) where n=1) m using (prefix))"""


def title(v: str) -> str:
    runs = rf"regexp_extract_all(regexp_replace({v}, '[_-]', ' ', 'g'), '\w+|\W+')"
    return (f"array_to_string(list_transform({runs}, "
            rf"lambda w: case when regexp_matches(w, '^\w') then upper(substr(w,1,1)) || substr(w,2) else w end), '')")


def slug(v: str) -> str:
    return f"lower(regexp_replace(regexp_replace({v}, '/+$', ''), '[^A-Za-z0-9-]', '-', 'g'))"


def last_part(v: str) -> str:
    return f"split_part(regexp_replace({v}, '/+$', ''), '/', -1)"


def tenths(n: str, unit: int) -> str:
    return f"printf('%.1f', floor({n}/{unit}e0*10+0.5e0)/10)"


def sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["catalogue_kpis"] = f"""
      select cast(sum(size_bytes) as bigint) total_size_bytes, cast(sum(coalesce(file_count,0)) as bigint) file_count_total,
        count(*) dataset_count, count(distinct category) category_count, count(distinct region) region_count,
        count(distinct nullif(maintainer,'')) maintainer_count, max(last_modified) last_updated,
        cast((select count(*) from {D} r where stage='raw' and pair_id in (select pair_id from {D} where stage='processed' and pair_id is not null)) as bigint) raw_with_processed,
        cast((select count(*) from {D} where stage='raw' and pair_id is not null) as bigint) raw_total from {D}"""
    dim = ", ".join(f"('{c}', '{lab}', {i})" for i, (c, lab) in enumerate(zip(CATS, LABELS)))
    out["category_stats"] = f"""
      select c.category, c.label, c.ordinal, count(d.id) as count, cast(coalesce(sum(d.size_bytes),0) as bigint) size_bytes
      from (values {dim}) c(category, label, ordinal) left join {D} d using (category) group by 1, 2, 3"""
    out["region_stats"] = f"select region, count(*) as count, cast(sum(size_bytes) as bigint) size_bytes from {D} group by 1"
    out["growth_curve"] = f"""
      select last_modified as date, cast(sum(size_bytes) over (order by last_modified, id rows unbounded preceding) as bigint) total_bytes,
        name dataset_name, category, size_bytes from {D}
      union all select min(last_modified) - interval 1 month, 0, '', 'traffic', 0 from {D}"""
    st = lambda s, c: f"cast(coalesce(sum({c}) filter (where stage='{s}'),0) as bigint)"
    fm = lambda s: f"coalesce(array_to_string(list_sort(list(distinct coalesce(format,'Unknown')) filter (where stage='{s}')), ', '),'')"
    out["pair_impact"] = f"""
      select *, {title('pair_id')} label, round((raw_bytes-processed_bytes)*100e0/nullif(raw_bytes,0),6) size_reduction_pct,
        round((raw_files-processed_files)*100e0/nullif(raw_files,0),6) file_reduction_pct from (
        select pair_id, count(*) filter (where stage='raw') raw_count, count(*) filter (where stage='processed') processed_count,
          {st('raw', 'size_bytes')} raw_bytes, {st('raw', 'file_count')} raw_files,
          {st('processed', 'size_bytes')} processed_bytes, {st('processed', 'file_count')} processed_files,
          {fm('raw')} raw_formats, {fm('processed')} processed_formats
        from {D} where pair_id is not null group by 1) where raw_count>0 and processed_count>0"""
    out["format_histogram"] = f"select stage, coalesce(format,'Unknown') format, count(*) n from {D} group by 1, 2"
    out["prefix_stats"] = f"select * from {STATS}"
    out["prefix_datasets"] = f"""
      select {slug('s.prefix')} id, coalesce('Set ' || e.part, {title(last_part('s.prefix'))}) as name,
        case when e.part is null then 'demographics' else 'weather' end category, 'Unknown' region,
        case when e.part='en' or s.prefix not like 'processed/%' then 'raw' else 'processed' end stage,
        s.size_bytes, s.file_count, s.format, s.last_modified
      from {STATS} s left join (select distinct regexp_extract(key, '^raw/([^/]+)/', 1) part from {F}
        where regexp_extract(key, '^raw/([^/]+)/', 1)<>'') e on s.prefix='processed/' || e.part || '/'"""
    out["bbox_union"] = f"""select min(cast(doc_id%360 as double)-180) west, min(cast(doc_id%150 as double)-80) south,
      max(cast(doc_id%360 as double)-179) east, max(cast(doc_id%150 as double)-78) north from {D} where doc_id%4=0"""
    out["category_lists"] = f"""
      select category, chunk, array_to_string(list_sort(list(id)), ',') ids from (
        select category, id, cast('0x' || substr(md5(id),1,8) as bigint) % cast(ceil(count(*) over (partition by category)/100e0) as bigint) chunk
        from {D}) group by 1, 2"""
    out["raw_with_processed"] = f"""select id from {D} where stage='raw' and pair_id in
      (select pair_id from {D} where stage='processed' and pair_id is not null)"""
    out["pair_siblings"] = f"""
      select d.id, d.pair_id, cast(count(s.id) as bigint) sibling_count, min(s.id) first_sibling, count(s.id)>0 has_pair
      from {D} d left join {D} s on d.pair_id=s.pair_id and d.id<>s.id group by 1, 2"""
    out["related_top3"] = f"""
      select id, cast(n-1 as integer) as rank, other related_id from (
        select a.id, b.id other, row_number() over (partition by a.id order by b.size_bytes desc, b.id) n
        from {D} a join {D} b on a.category=b.category and a.id<>b.id) where n<=3"""
    def hit(w):
        fields = " or ".join(f"contains(lower({c}), '{w}')" for c in ("name", "description", "region"))
        return (f"({fields} or coalesce(contains(lower(maintainer), '{w}'), false) or "
                f"coalesce(len(list_filter(tags, lambda t: contains(lower(t), '{w}')))>0, false))")
    out["dataset_search"] = f"""select id, size_bytes from {D} where stage='processed' and {hit('tag7')}
      and category in ('traffic','weather','energy')"""
    out["text_search"] = f"select id from {D} where {hit('en the')}"
    label = _case("category", [], "category").replace("case category  else", "case category " + " ".join(
        f"when '{c}' then '{lab}'" for c, lab in zip(CATS, LABELS)) + " else")
    out["palette_search"] = f"""select id from {D} where contains(lower(concat_ws(' ', name, array_to_string(tags, ' '), region, {label})), 'tag1 tag2')"""
    ordinal = "case category " + " ".join(f"when '{c}' then {i}" for i, c in enumerate(CATS)) + " else -1 end"
    fy = lambda v: f"round(year({v}) + (month({v})-1)/12e0 + day({v})/365e0, 6)"
    out["timeline"] = f"""
      select id, category, {ordinal} ordinal, t0 as start, e as "end", {fy('t0')} start_year, {fy('e')} end_year,
        epoch_ms(cast(t0 as timestamp)) start_ms, epoch_ms(cast(e as timestamp)) end_ms
      from (select *, coalesce(t1, date '2025-03-01') e from {D}) where t0 is not null"""
    out["undated_datasets"] = f"select id, name, timespan from {D} where t0 is null"
    side = lambda v: f"case when doc_id%4=0 then cast({v} as double) end"
    out["catalogue_document"] = f"""select id, name, category, region, stage, pair_id, timespan, cast(null as varchar) license,
      cast(null as varchar) source_url, maintainer, cast(size_bytes as bigint) size_bytes, cast(file_count as bigint) file_count,
      format, last_modified, description, cast(t0 as date) as start, cast(t1 as date) as "end", {side('doc_id%360-180')} west,
      {side('doc_id%150-80')} south, {side('doc_id%360-179')} east, {side('doc_id%150-78')} north,
      array_to_string(tags, ',') tags from {D}"""
    out["visible_tags"] = f"""select id, coalesce(array_to_string(tags[1:3], ','), '') visible,
      cast(greatest(coalesce(len(tags),0)-3, 0) as integer) hidden from {D}"""
    age = f"(epoch({NOW})-epoch(last_modified))"
    units = (("year", 31536000), ("month", 2592000), ("week", 604800), ("day", 86400), ("hour", 3600), ("minute", 60))
    ago = "case " + " ".join(
        f"when floor({age}/{s})>=1 then cast(cast(floor({age}/{s}) as bigint) as varchar) || ' {u}' || case when floor({age}/{s})>1 then 's' else '' end || ' ago'"
        for u, s in units) + " else 'just now' end"
    sz = "(size_bytes*size_bytes*37)"
    bytes_label = (f"case when {sz}=0 then '0 B' when {sz}<1024 then cast({sz} as varchar) || ' B' "
                   + " ".join(f"when {sz}<{1024 ** (k + 1)} then {tenths(sz, 1024 ** k)} || ' {u}'"
                              for k, u in ((1, 'KB'), (2, 'MB'), (3, 'GB')))
                   + f" else {tenths(sz, 1024 ** 4)} || ' TB' end")
    number_label = (f"case when {sz}>=1000000000 then {tenths(sz, 10 ** 9)} || 'B' when {sz}>=1000000 then {tenths(sz, 10 ** 6)} || 'M' "
                    f"when {sz}>=1000 then {tenths(sz, 1000)} || 'K' else cast({sz} as varchar) end")
    days = f"cast(floor({age}/86400) as bigint)"
    y0, y1 = "cast(year(t0) as varchar)", "coalesce(cast(year(t1) as varchar), 'now')"
    out["dataset_labels"] = f"""
      select id, {bytes_label} size_label, {number_label} number_label, {ago} as ago, {days} as days,
        case when {days}<=30 then 'fresh' when {days}>180 then 'stale' end recency,
        round(least({days},365)/365e0*100, 6) age_pct,
        coalesce(timespan, case when t0 is not null then case when {y0}={y1} then {y0} else {y0} || '–' || {y1} end end, '—') span,
        {title('pair_id')} pair_label from {D}"""
    out["path_labels"] = f"""select key, {slug('key')} slug, {title(last_part('key'))} title, ext extension, {FORMAT} format,
      case when key like '%.csv' or key not like 'processed/%' then 'raw' else 'processed' end stage
      from (select *, {EXT} ext from {F})"""
    city = "'city' || cast(page_id%3 as varchar)"
    out["file_routing"] = f"""select page_id, case page_id%5
        when 0 then 'raw/map-lake/' || {city} || '/2026-02-18.0/roads.parquet'
        when 1 then 'processed/map-lake/' || {city} || '/2026-02-18.0/hex_features_res09.parquet'
        when 3 then 'processed/map-lake_satellite/' || {city} || '/satellite_hex_embeddings_res09.parquet'
        when 4 then 'raw/map-lake/' || {city} || '/2026-02-18.0/extraction_metadata.json' end target,
      case when page_id%5=4 then 'application/json' else 'application/octet-stream' end content_type from pages"""
    out["layer_gaps"] = f"""select 'doc-' || cast(doc_id as varchar) id from labels
      where 'doc-' || cast(doc_id as varchar) not in (select id from {D} where stage='raw')"""
    v = "speed_limit_kmh"
    out["speed_summary"] = f"""select count({v}) as count, round(avg({v}),6) mean, round(stddev_samp({v}),6) std, round(min({v}),6) as min,
      round(quantile_cont({v},0.25),6) q25, round(quantile_cont({v},0.5),6) q50, round(quantile_cont({v},0.75),6) q75,
      round(max({v}),6) as max from ({ROADS})"""
    return out
