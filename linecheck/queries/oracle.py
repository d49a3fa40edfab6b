"""The queries of the catalog in SQL, for a comparison in another engine."""

from __future__ import annotations

from linecheck.queries.inputs import MARK, TEMPLATE_LINES


def fixed(number: str, places: int) -> str:
    """Text rounded half up on the shortest decimal form; ``printf`` would round the binary value."""
    return f"round(({number})::varchar::decimal(38, 18), {places})::decimal(38, {places})::varchar"


READINGS = """
readings as (
  select l_linenumber as linenmb,
         'EQ' || s_suppkey as equipmentid,
         'C ' || s_suppkey || '#' || s_nationkey as mcid,
         replace(split_part('C ' || s_suppkey || '#' || s_nationkey, '#', 1), ' ', '') as model_key,
         l_shipdate as datetime,
         l_quantity as leadx,
         l_extendedprice / 1000 as leady,
         round(l_discount * 100) as padx,
         round(l_tax * 100) as pady
  from lineitem join supplier on l_suppkey = s_suppkey)"""

TEMPLATES = f"""
template as (
  select 'C' || s_suppkey as model_key,
         k::int as line,
         case when k = 1 then 0::double else s_nationkey::double / 8 + 24 end as lead_diff,
         case when k = 1 then 0::double else 4::double end as pad_diff,
         case when k = 1 then 0::double else 20::double end as lead_limit,
         case when k = 1 then 0::double else 5::double end as pad_limit
  from supplier, range(1, {TEMPLATE_LINES} + 1) n(k)
  where s_acctbal >= 0),
std as (
  select model_key,
         row_number() over (partition by model_key
                            order by line, lead_diff, pad_diff, lead_limit, pad_limit)::int as pos,
         line, lead_diff, pad_diff, lead_limit, pad_limit,
         (count(*) over (partition by model_key))::int as n_std
  from template)"""

SEGMENTED = """
segmented as (
  select *, max(case when linenmb = 1 then datetime end)
              over (partition by equipmentid, mcid order by datetime) as sample_ts
  from readings)"""

STEPS = """
lines as (
  select distinct equipmentid, mcid, model_key, sample_ts, linenmb, leadx, leady, padx, pady
  from segmented),
placed as (
  select *,
         (row_number() over w)::int as pos,
         (count(*) over (partition by equipmentid, mcid, sample_ts))::int as n_lines,
         lag(leadx) over w as leadx0, lag(leady) over w as leady0,
         lag(padx) over w as padx0, lag(pady) over w as pady0
  from lines
  window w as (partition by equipmentid, mcid, sample_ts order by linenmb, leadx, leady, padx, pady)),
steps as (
  select equipmentid, mcid, model_key, sample_ts, pos, n_lines,
         case when pos = 1 then 1 else linenmb end as line,
         coalesce(sqrt((leadx - leadx0) * (leadx - leadx0) + (leady - leady0) * (leady - leady0)), 0) as lead_step,
         coalesce(sqrt((padx - padx0) * (padx - padx0) + (pady - pady0) * (pady - pady0)), 0) as pad_step
  from placed),
compared as (
  select s.*, n_std, abs(lead_diff - lead_step) as lead_offset, abs(pad_diff - pad_step) as pad_offset,
         ((not isnan(abs(lead_diff - lead_step)) and abs(lead_diff - lead_step) > lead_limit)
          or (not isnan(abs(pad_diff - pad_step)) and abs(pad_diff - pad_step) > pad_limit)) as bad
  from steps s join std using (model_key, pos)
  where n_lines <= n_std)"""

CHECKED = f"with {READINGS}, {TEMPLATES}, {SEGMENTED}, {STEPS}"

VERDICTS = f"""{CHECKED},
verdicts as (
  select equipmentid, mcid, sample_ts as datetime,
         case when n_lines < n_std then 2 when bool_or(bad) then 1 else 0 end as code,
         case when n_lines < n_std then '少线: 【实际/标准: ' || n_lines || '/' || n_std || '】'
              when bool_or(bad) then
                string_agg('lineNmb' || line || '_leadOffset_' || {fixed("lead_offset", 2)}
                           || '_padOffset_' || {fixed("pad_offset", 2)}, '|' order by pos) filter (where bad)
              else 'qualified' end as description
  from compared
  group by equipmentid, mcid, sample_ts, n_lines, n_std)"""

EQUIPMENT = """
equipment as (
  select s_name as "机台号", 'EQ' || s_suppkey as "盒子编码", n_name as "厂", r_name as "区"
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  where r_name <> 'EUROPE')"""

ALERTS = f"""{VERDICTS}, {EQUIPMENT},
alerts as (
  select equipmentid as "盒子编码", mcid as "机型",
         case when code in (1, 2) then 'NG' else 'OK' end as "对比结果",
         datetime as "时间",
         case code when 1 then '不合格' when 2 then '缺线' else '正常' end as "一级详细信息",
         description as "二级详细信息",
         "机台号", "厂", "区"
  from verdicts join equipment on equipmentid = "盒子编码"
  where code <> 0)"""

ALERT_LINES = """
  select '(' || "盒子编码" || ',' || "机型" || ',' || "对比结果" || ',' || coalesce("时间"::varchar, '') || ','
         || "一级详细信息" || ',' || "二级详细信息" || ')' as line
  from alerts"""

SEGMENTED_LINES = f"""with {READINGS}, {SEGMENTED}
  select linenmb, equipmentid, mcid, datetime, leadx, leady, padx, pady, sample_ts from segmented"""

SAMPLE_SIZES = f"""with {READINGS}, {SEGMENTED},
  lines as (
    select distinct equipmentid, mcid, sample_ts, linenmb, leadx, leady, padx, pady from segmented)
  select equipmentid, mcid, sample_ts, count(*)::int as n_lines from lines
  group by equipmentid, mcid, sample_ts"""

SEGMENTED_EVENTS = """
  select event_id, user_id, ts, event_type,
         max(case when event_type = 'signup' then ts end) over (partition by user_id order by ts) as started
  from events"""

NEW_CUSTOMERS = """
  select c_custkey + 10000000 as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  from customer where c_acctbal < 0"""

OPEN_SAMPLES = """
open_samples as (
  select equipmentid, mcid,
         coalesce(max(case when linenmb = 1 then datetime end), min(datetime)) as open_from,
         max(case when linenmb = 1 then datetime end) as closes
  from readings group by equipmentid, mcid)"""

TEMPLATE_FILE = """
  select model_key, line as "lineNmb", lead_diff as "leadDiff", pad_diff as "padDiff",
         lead_limit as "leadThreshold", pad_limit as "padThreshold"
  from template"""

STREAMED_LATE = f"""with {READINGS},
arrived as (
  select *, (datetime >= timestamp '1997-07-01')::int + (datetime >= timestamp '1999-07-01')::int
            + (linenmb = 4)::int as batch
  from readings),
taken0 as (select * from arrived where batch = 0)"""
for _n in (1, 2, 3):
    STREAMED_LATE += f""",
open{_n} as (
  select equipmentid, mcid, coalesce(max(case when linenmb = 1 then datetime end), min(datetime)) as open_from
  from taken{_n - 1} group by equipmentid, mcid),
seen{_n} as (
  select arrived.*, open_from, coalesce(datetime < open_from, false) as late
  from arrived left join open{_n} using (equipmentid, mcid) where batch = {_n}),
taken{_n} as (
  select * from taken{_n - 1} union all select * exclude (open_from, late) from seen{_n} where not late)"""

TEXT_VERDICTS = f"""{VERDICTS}
  select equipmentid, mcid, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime, code, description
  from verdicts"""

LATE_ROWS = f"""{STREAMED_LATE}
  select equipmentid, mcid, linenmb, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime,
         strftime(open_from, '%Y-%m-%d %H:%M:%S') as open_from, batch
  from (select * from seen1 union all select * from seen2 union all select * from seen3)
  where late"""

LINE_STEPS = f"""{CHECKED}
  select equipmentid, mcid, sample_ts, n_lines, pos, line, lead_step, pad_step from steps"""

# A checksum as a fold over the bits of the bytes: each byte is mixed in, then shifted out in eight steps.
CRC32 = """xor(list_reduce(
  list_prepend(4294967295::bigint, flatten(list_transform(
    range(1, length(hex(encode({0}))), 2),
    lambda i: [('0x' || substr(hex(encode({0})), i, 2))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295)"""

UPDATED = """
  select c_custkey, c_name, c_nationkey,
         case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment
  from customer"""

UPSERTED = f"{UPDATED} union all {NEW_CUSTOMERS}"

ORACLE: dict[str, str] = {
    "scan_since_mark": f"""with {READINGS}
        select linenmb, equipmentid, mcid, datetime from readings
        where linenmb > 0 and datetime > timestamp '{MARK}'""",
    "keyed_scan": "select * from customer where c_acctbal < 0 and c_mktsegment = 'BUILDING'",
    "named_view": "select * from customer where c_acctbal > 9000",
    "new_mark": f"with {READINGS} select max(datetime) as datetime from readings",
    "clean_coordinates": """
        select l_linenumber as linenmb, l_orderkey::varchar as equipmentid,
               l_linestatus || '#' || l_partkey as mcid, l_shipdate as datetime,
               coalesce(try_cast(l_returnflag as double), 0) as leadx,
               coalesce(try_cast(l_quantity::varchar as double), 0) as leady,
               coalesce(try_cast(l_linestatus || l_tax::varchar as double), 0) as padx,
               coalesce(try_cast(l_discount::varchar as double), 0) as pady,
               l_linestatus as model_key
        from lineitem""",
    "model_keys": f"with {READINGS} select mcid, model_key, count(*) as n_rows from readings group by mcid, model_key",
    "listed_lines": f"""with {READINGS},
        listed as (
          select distinct replace(case when s_acctbal >= 0 then 'C ' || s_suppkey
                                       else 'C ' || s_suppkey || '#' || s_nationkey end, ' ', '') as model_key
          from supplier)
        select model_key, count(*) as n_rows from readings
        where model_key in (select model_key from listed) group by model_key""",
    "segment_lines": SEGMENTED_LINES,
    "segment_lines_in_slots": SEGMENTED_LINES,
    "segment_events": SEGMENTED_EVENTS,
    "segment_events_in_slots": SEGMENTED_EVENTS,
    "sample_sizes": SAMPLE_SIZES,
    "sample_sizes_in_slots": SAMPLE_SIZES,
    "template_lines": f"""with {TEMPLATES}
        select model_key, pos, line, lead_diff, pad_diff, lead_limit, pad_limit, n_std from std""",
    "template_counts": f"with {TEMPLATES} select model_key, count(*)::int as n_std from template group by model_key",
    "line_steps": LINE_STEPS,
    "line_steps_in_slots": LINE_STEPS,
    "line_offsets": f"""{CHECKED}
        select equipmentid, mcid, sample_ts, pos, lead_offset, pad_offset, bad::int as bad
        from compared where n_lines = n_std""",
    "sample_codes": f"""{CHECKED}
        select equipmentid, mcid, sample_ts as datetime, n_lines, n_std,
               case when n_lines < n_std then 2 when bool_or(bad) then 1 else 0 end as code
        from compared group by equipmentid, mcid, sample_ts, n_lines, n_std""",
    "sample_verdicts": f"{VERDICTS} select * from verdicts",
    "sample_verdicts_in_slots": f"{VERDICTS} select * from verdicts",
    "models_without_template": f"""with {READINGS}, {TEMPLATES}
        select distinct model_key from readings where model_key not in (select model_key from template)""",
    "alerts": f"{ALERTS} select * from alerts",
    "alert_lines": f"{ALERTS} {ALERT_LINES}",
    "report_files": f"{ALERTS} {ALERT_LINES}",
    "first_alerts": f"""{ALERTS} select * from alerts
        order by "时间" nulls first, "盒子编码", "机型" limit 128""",
    "quality_summary": f"""{VERDICTS},
        counted as (
          select replace(split_part(mcid, '#', 1), ' ', '') as model_key, code from verdicts),
        summed as (
          select model_key, grouping(model_key)::int as all_models, count(*) as samples,
                 count(*) filter (where code = 0) as qualified,
                 count(*) filter (where code = 1) as out_of_tolerance,
                 count(*) filter (where code = 2) as lines_missing
          from counted group by rollup(model_key))
        select *, out_of_tolerance::double / samples as out_ratio,
               lines_missing * 100::double / samples as missing_percent,
               out_of_tolerance * 100::double / samples as out_percent,
               qualified * 100::double / samples as qualified_percent
        from summed""",
    "stacked_parties": """
        select c_custkey as party, c_name as name, c_acctbal as balance from customer
        union all select s_suppkey, s_name, s_acctbal from supplier""",
    "tagged_parts": """
        select vec_id, label,
               case when ('0x' || substr(md5('7:' || vec_id), 1, 8))::bigint / 4294967296.0 < 0.25
                    then 'test' else 'train' end as part
        from embeddings""",
    "keyed_insert": f"select * from customer union all {NEW_CUSTOMERS}",
    "keyed_upsert": UPSERTED,
    "keyed_update": UPDATED,
    "results_once": f"{VERDICTS} select * from verdicts",
    "files_upsert": UPSERTED,
    "files_update": UPDATED,
    "merged_deltas": f"""
        with once as ({UPSERTED}),
        twice as (
          select * replace (case when c_nationkey < 5 then c_acctbal + 100 else c_acctbal end as c_acctbal) from once)
        select *, unnest(['merged', 'compacted']) as part from twice""",
    "zoned_since_mark": f"""with {READINGS}
        select linenmb, equipmentid, mcid, datetime from readings where datetime > timestamp '1997-07-01'""",
    "zoned_mark": f"with {READINGS} select max(datetime) as datetime from readings",
    "whole_job": TEXT_VERDICTS,
    "boosted_stump": """
        with whole as (
          select vec_id, (label > 4)::int as y, list_transform(embedding, lambda x: floor(8 * x::double)) as f,
                 ('0x' || substr(md5('7:' || vec_id), 1, 8))::bigint / 4294967296.0 >= 0.25 as train
          from embeddings),
        long as (
          select unnest(f) as v, generate_subscripts(f, 1) as j, 2 * y - 1 as s from whole where train),
        vals as (select j, v, count(*)::double as n, sum(s)::double as s from long group by j, v),
        sums as (
          select j, v, lead(v) over w as next, sum(n) over w as n_left, sum(s) over w as s_left,
                 sum(n) over (partition by j) as n, sum(s) over (partition by j) as s
          from vals window w as (partition by j order by v)),
        best as (
          select j, (v + next) / 2 as split, s_left / n_left as below, (s - s_left) / (n - n_left) as above
          from sums where next is not null
          order by s_left * s_left / n_left + (s - s_left) * (s - s_left) / (n - n_left) desc, j, v limit 1)
        select vec_id, y::double as label,
               case when case when f[j] <= split then below else above end > 0 then 1.0 else 0.0 end::double as prediction
        from whole, best where not train""",
    "score_thresholds": """
        with scored as (
          select floor(40 * embedding[1]::double)::bigint as score, (label > 4)::int as y from embeddings),
        counts as (
          select score, sum(y)::bigint as hits, sum(1 - y)::bigint as misses
          from scored where score is not null and y is not null group by score),
        above as (
          select score, hits, misses,
                 (sum(hits) over (order by score desc))::bigint as hits_above,
                 (sum(misses) over (order by score desc))::bigint as misses_above
          from counts)
        select *, (sum((2 * hits_above - hits) * misses) over ())::double
                  / (2 * ((sum(hits) over ())::double * (sum(misses) over ())::double)) as area
        from above""",
    "table_life": "select c_custkey, c_name, c_acctbal from customer",
    "stored_mark": f"""with {READINGS}
        select '{MARK}' as before, strftime(max(datetime), '%Y-%m-%d %H:%M:%S') as mark from readings""",
    "cutoff_rows": f"""with {READINGS}
        select linenmb, equipmentid, datetime from readings where datetime >= timestamp '1997-05-20 00:00:00'""",
    "number_texts": f"""
        select price, tax, count(*) as n_rows
        from (select {fixed("l_extendedprice / 7", 2)} as price, {fixed("l_tax / 8", 3)} as tax from lineitem)
        group by price, tax""",
    "url_suffixes": "select page_id, regexp_replace(url, '.*\\.', '') as suffix from pages",
    "packed_ids": f"""with {READINGS}
        select equipmentid || '_' || mcid || '_' || datetime::varchar as packed, equipmentid, mcid, count(*) as n_rows
        from readings group by equipmentid, mcid, datetime""",
    "later_times": f"""with {READINGS}
        select equipmentid, greatest(max(datetime), timestamp '{MARK}') as datetime
        from readings group by equipmentid""",
    "point_states": f"""with {READINGS},
        measured as (
          select equipmentid, datetime, linenmb,
                 sqrt((leadx - padx) * (leadx - padx) + (leady - pady) * (leady - pady)) as apart
          from readings)
        select *, abs(50 - apart) as "offset", (abs(50 - apart) > 20)::int as state from measured""",
    "verdict_texts": f"""{VERDICTS}
        select code, case when code in (1, 2) then 'NG' else 'OK' end as result,
               case code when 1 then '不合格' when 2 then '缺线' else '正常' end as text, count(*) as samples
        from verdicts group by code""",
    "withheld_runs": f"{VERDICTS} select * from verdicts",
    "open_samples": f"with {READINGS}, {OPEN_SAMPLES} select * from open_samples",
    "closed_rows": f"""with {READINGS}, {OPEN_SAMPLES}
        select equipmentid, mcid, count(*) as n_rows
        from readings join open_samples using (equipmentid, mcid)
        where datetime < closes group by equipmentid, mcid""",
    "template_files": f"""with {TEMPLATES}
        select model_key, line, lead_diff, pad_diff, lead_limit, pad_limit from template""",
    "json_scan": f"with {TEMPLATES} {TEMPLATE_FILE}",
    "template_kinds": f"""with {TEMPLATES}, files as ({TEMPLATE_FILE})
        select *, ['csv', 'json', 'parquet'][({CRC32.format("model_key")} % 3 + 1)::int] as kind from files""",
    "csv_scan": f"with {EQUIPMENT} select * from equipment",
    "parquet_scan": "select * from part",
    "streamed_verdicts": TEXT_VERDICTS,
    "streamed_late_rows": LATE_ROWS,
    "stated_verdicts": TEXT_VERDICTS,
    "stated_late_rows": LATE_ROWS,
}
