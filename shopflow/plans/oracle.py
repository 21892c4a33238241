"""DuckDB oracle SQL for every catalogue query with a SQL form.

Each query is one statement: the fixture views (FIXTURES.md §3) and shared
intermediate results are common table expressions, prepended as needed.
"""

from __future__ import annotations

import re

from shopflow.plans import params as P

# Written out, not imported from the code under test: (label, from, to).
VISIT_BUCKETS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
                 ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None)]
STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def compose(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    head = ",\n".join(f"{n} AS (\n{CTES[n][0].strip()}\n)" for n in order)
    return f"WITH {head}\n{body.strip()}"


def _in_bucket(c: str, lo: int, hi: int | None) -> str:
    return f"{c} >= {lo}" if hi is None else f"{c} BETWEEN {lo} AND {hi}"


def _half_up(n: str, d: str, places: int) -> str:
    s = 10 ** places
    return f"cast(({2 * s} * {n} + {d}) // (2 * {d}) as double) / {s}"


def _half_up_text(n: str, d: str, places: int) -> str:
    s = 10 ** places
    q = f"(({2 * s} * {n} + {d}) // (2 * {d}))"
    return f"cast({q} // {s} as varchar) || '.' || lpad(cast({q} % {s} as varchar), {places}, '0')"


def _quote_list(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


T = "strftime({c}, '%Y-%m-%d %H:%M:%S')"

# --- fixture views ---------------------------------------------------------
cte("user_visit_action", """
select strftime(ts, '%Y-%m-%d') as date, user_id,
       concat(cast(user_id as varchar), '_', strftime(ts, '%Y-%m-%d')) as session_id,
       event_id, k % 10 as page_id,
       date_trunc('day', ts) + to_hours(cast(user_id % 23 as integer)) + to_seconds(cast(off as integer)) as action_time,
       case when event_type = 'view' then concat('kw', cast(k % 10 as varchar)) end as search_keyword,
       case when event_type = 'click' then k else cast(-1 as bigint) end as click_category_id,
       case when event_type = 'click' then event_id % 100 else cast(-1 as bigint) end as click_product_id,
       case when event_type = 'signup' then concat(cast(k as varchar), ',', cast((k + 1) % 100 as varchar)) end as order_category_ids,
       case when event_type = 'signup' then cast(event_id % 100 as varchar) end as order_product_ids,
       case when event_type = 'purchase' then cast(k as varchar) end as pay_category_ids,
       case when event_type = 'purchase' then cast(event_id % 100 as varchar) end as pay_product_ids,
       user_id % 25 as city_id
from (select *, cast(json_extract_string(props, '$.k') as bigint) as k,
             case event_id % 4 when 0 then (event_id * 37) % 10
                               when 1 then (event_id * 37) % 60
                               when 2 then (event_id * 37) % 600
                               else (event_id * 37) % 3600 end as off
      from events)""")

cte("user_info", """
select c_custkey as user_id, c_name as username, c_name as name,
       cast(18 + c_custkey % 42 as integer) as age, c_mktsegment as professional,
       n_name as city, case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
from customer join nation on c_nationkey = n_nationkey""")

cte("product_info", """
select p_partkey as product_id, p_name as product_name,
       concat('{"product_status": ', cast(p_partkey % 2 as varchar), '}') as extend_info
from part""")

cte("city_area", """
select cast(n_nationkey as bigint) as city_id, n_name as city_name, r_name as area
from nation join region on n_regionkey = r_regionkey""")

cte("ad_log", """
select event_id, concat(cast(epoch_us(ts) // 1000 as varchar), ' ', replace(r_name, ' ', '-'), ' ', n_name, ' ',
              cast(user_id as varchar), ' ', cast(cast(json_extract_string(props, '$.k') as bigint) % 20 as varchar)) as value
from events join nation on user_id % 25 = n_nationkey
            join region on n_regionkey = r_regionkey""")

# --- session statistics ----------------------------------------------------
cte("session_rollup", """
select b.session_id, b.user_id, b.start_time, b.end_time, b.visit_length, b.step_length,
       coalesce(k.s, '') as search_keywords, coalesce(c.s, '') as click_category_ids
from (select session_id, min(user_id) as user_id, min(action_time) as start_time, max(action_time) as end_time,
             cast(epoch(max(action_time)) - epoch(min(action_time)) as bigint) as visit_length,
             count(*) as step_length
      from user_visit_action group by session_id) b
left join (select session_id, string_agg(v, ',' order by f) as s
           from (select session_id, search_keyword as v, min((action_time, event_id)) as f
                 from user_visit_action where search_keyword is not null group by session_id, search_keyword)
           group by session_id) k using (session_id)
left join (select session_id, string_agg(v, ',' order by f) as s
           from (select session_id, cast(click_category_id as varchar) as v, min((action_time, event_id)) as f
                 from user_visit_action where click_category_id <> -1 group by session_id, click_category_id)
           group by session_id) c using (session_id)""", "user_visit_action")

cte("session_full_info", """
select r.session_id, r.user_id, r.start_time, r.end_time, r.visit_length, r.step_length,
       r.search_keywords, r.click_category_ids, u.age, u.professional, u.sex, u.city
from session_rollup r join user_info u using (user_id)""", "session_rollup", "user_info")


def _overlap(col: str, vals) -> str:
    return (f"coalesce(len(list_intersect(list_filter(string_split({col}, ','), lambda x: x <> '' and x <> '-1'), "
            f"[{_quote_list(vals)}])) > 0, false)")


F = P.FILTER
cte("session_filtered", f"""
select * from session_full_info
where coalesce(age between {F['start_age']} and {F['end_age']}, false)
  and coalesce(professional in ({_quote_list(F['professionals'])}), false)
  and coalesce(sex = '{F['sex']}', false)
  and {_overlap('search_keywords', F['keywords'])}""", "session_full_info")

_bucket_aggs = ",\n       ".join(
    [f"count(*) filter (where {_in_bucket('visit_length', lo, hi)}) as v_{n}" for n, lo, hi in VISIT_BUCKETS]
    + [f"count(*) filter (where {_in_bucket('step_length', lo, hi)}) as s_{n}" for n, lo, hi in STEP_BUCKETS])
cte("session_bucket_counts", f"""
select count(*) as session_count,
       {_bucket_aggs}
from session_full_info""", "session_full_info")

cte("session_start_keys", """
select *, strftime(start_time, '%Y-%m-%d') as date, strftime(start_time, '%H') as hour
from session_full_info""", "session_full_info")

cte("session_hour_counts", """
select date, hour, count(*) as session_count from session_start_keys group by date, hour""",
    "session_start_keys")

cte("session_sample_quota", f"""
select date, hour, session_count, day_session_count,
       cast(least(session_count, session_count * ({P.SAMPLE_TOTAL} // (select count(distinct date) from session_hour_counts))
                  // day_session_count) as bigint) as quota
from (select *, cast(sum(session_count) over (partition by date) as bigint) as day_session_count
      from session_hour_counts)""",
    "session_hour_counts")

cte("session_sample", f"""
select session_id, start_time, search_keywords, click_category_ids
from (select s.*, q.quota,
             row_number() over (partition by s.date, s.hour
                                order by md5(s.session_id || '_{P.SAMPLE_SEED}'), s.session_id) as rn
      from session_start_keys s join session_sample_quota q using (date, hour))
where rn <= quota""", "session_start_keys", "session_sample_quota")

SQL: dict[str, str] = {}

SQL["actions_in_range"] = compose(f"""
select date, user_id, session_id, event_id, page_id, {T.format(c='action_time')} as action_time,
       search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
       pay_category_ids, pay_product_ids, city_id
from user_visit_action where date between '{P.RANGE_START}' and '{P.RANGE_END}'""", "user_visit_action")

_rollup_cols = (f"session_id, user_id, {T.format(c='start_time')} as start_time, "
                f"{T.format(c='end_time')} as end_time, visit_length, step_length, search_keywords, "
                f"click_category_ids")
SQL["session_rollup"] = compose(f"select {_rollup_cols} from session_rollup", "session_rollup")
SQL["session_full_info"] = compose(
    f"select {_rollup_cols}, age, professional, sex, city from session_full_info", "session_full_info")
SQL["session_filtered"] = compose(
    f"select {_rollup_cols}, age, professional, sex, city from session_filtered", "session_filtered")
SQL["filtered_session_actions"] = compose(f"""
select a.date, a.user_id, a.session_id, a.event_id, a.page_id, {T.format(c='a.action_time')} as action_time,
       a.search_keyword, a.click_category_id, a.click_product_id, a.order_category_ids, a.order_product_ids,
       a.pay_category_ids, a.pay_product_ids, a.city_id
from user_visit_action a
where a.session_id in (select session_id from session_full_info
                       where coalesce(age between {P.FILTER_AGE_ONLY['start_age']} and {P.FILTER_AGE_ONLY['end_age']}, false))""",
    "user_visit_action", "session_full_info")

_hist_rows = " union all ".join(
    [f"select 'visit' as kind, '{n}' as bucket, v_{n} as n from session_bucket_counts" for n, _, _ in VISIT_BUCKETS]
    + [f"select 'step' as kind, '{n}' as bucket, s_{n} as n from session_bucket_counts" for n, _, _ in STEP_BUCKETS])
SQL["session_length_histogram"] = compose(_hist_rows, "session_bucket_counts")

_ratio_cols = ",\n       ".join(
    [f"{_half_up(f'v_{n}', 'greatest(session_count, 1)', 2)} as visit_length_{n}_ratio" for n, _, _ in VISIT_BUCKETS]
    + [f"{_half_up(f's_{n}', 'greatest(session_count, 1)', 2)} as step_length_{n}_ratio" for n, _, _ in STEP_BUCKETS])
SQL["session_stat"] = compose(f"select session_count,\n       {_ratio_cols}\nfrom session_bucket_counts",
                              "session_bucket_counts")
SQL["session_hour_counts"] = compose("select * from session_hour_counts", "session_hour_counts")
SQL["session_sample_quota"] = compose("select * from session_sample_quota", "session_sample_quota")
SQL["session_sample"] = compose(f"""
select session_id, {T.format(c='start_time')} as start_time, search_keywords, click_category_ids
from session_sample""", "session_sample")
SQL["session_sample_detail"] = compose(f"""
select user_id, session_id, page_id, {T.format(c='action_time')} as action_time, search_keyword,
       click_category_id, click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids
from user_visit_action where session_id in (select session_id from session_sample)""",
    "user_visit_action", "session_sample")

# --- categories --------------------------------------------------------------
cte("category_events", """
select session_id, 'click' as kind, click_category_id as category_id from user_visit_action where click_category_id <> -1
union all
select session_id, 'order', cast(c as bigint) from (select session_id, unnest(string_split(order_category_ids, ',')) as c
                                                    from user_visit_action where order_category_ids is not null) where c <> ''
union all
select session_id, 'pay', cast(c as bigint) from (select session_id, unnest(string_split(pay_category_ids, ',')) as c
                                                  from user_visit_action where pay_category_ids is not null) where c <> ''""",
    "user_visit_action")
cte("category_full_counts", """
select category_id, count(*) filter (where kind = 'click') as click_count,
       count(*) filter (where kind = 'order') as order_count,
       count(*) filter (where kind = 'pay') as pay_count
from category_events group by category_id""", "category_events")
cte("category_top10", f"""
select * from category_full_counts
order by click_count desc, order_count desc, pay_count desc, category_id asc limit {P.TOP_CATEGORIES}""",
    "category_full_counts")
cte("session_category_clicks", """
select click_category_id as category_id, session_id, count(*) as click_count
from user_visit_action where click_category_id in (select category_id from category_top10)
group by click_category_id, session_id""", "user_visit_action", "category_top10")

SQL["category_touched"] = compose("select distinct category_id from category_events", "category_events")
for _k, _n in (("click", "click_count"), ("order", "order_count"), ("pay", "pay_count")):
    SQL[f"category_{_k}_counts"] = compose(
        f"select category_id, count(*) as {_n} from category_events where kind = '{_k}' group by category_id",
        "category_events")
SQL["category_full_counts"] = compose("select * from category_full_counts", "category_full_counts")
SQL["category_top10"] = compose("select * from category_top10", "category_top10")
SQL["session_category_clicks"] = compose("select * from session_category_clicks", "session_category_clicks")
SQL["category_top10_sessions"] = compose(f"""
select category_id, session_id, click_count
from (select *, row_number() over (partition by category_id order by click_count desc, session_id asc) as rn
      from session_category_clicks)
where rn <= {P.TOP_SESSIONS}""", "session_category_clicks")

# --- page conversion ---------------------------------------------------------
_flow = [int(p) for p in P.PAGE_FLOW.split(",")]
_pair_rows = ", ".join(f"({i + 1}, {a}, {b})" for i, (a, b) in enumerate(zip(_flow, _flow[1:])))
cte("page_flow_pairs", f"select * from (values {_pair_rows}) as t(step, from_page, to_page)")
cte("page_transitions", """
select from_page, to_page from (
  select page_id as from_page,
         lead(page_id) over (partition by session_id order by action_time, event_id) as to_page
  from user_visit_action)
where to_page is not null""", "user_visit_action")
cte("page_flow_counts", f"""
select cast(p.step as integer) as step, cast(p.from_page as varchar) || '_' || cast(p.to_page as varchar) as page_pair,
       coalesce(c.n, 0) as pair_count
from page_flow_pairs p
left join (select from_page, to_page, count(*) as n from page_transitions group by from_page, to_page) c
  on c.from_page = p.from_page and c.to_page = p.to_page
union all
select 0, '{_flow[0]}', count(*) from user_visit_action where page_id = {_flow[0]}""",
    "page_flow_pairs", "page_transitions", "user_visit_action")
cte("page_conversion", """
select c.step, c.page_pair, c.pair_count, p.pair_count as prev_count,
       case when p.pair_count > 0 then c.pair_count / p.pair_count end as convert_rate
from page_flow_counts c join page_flow_counts p on c.step = p.step + 1
where c.step > 0""", "page_flow_counts")

SQL["page_transition_counts"] = compose(
    "select from_page, to_page, count(*) as pair_count from page_transitions group by from_page, to_page",
    "page_transitions")
SQL["page_flow_counts"] = compose("select * from page_flow_counts", "page_flow_counts")
SQL["page_conversion"] = compose("select * from page_conversion", "page_conversion")
SQL["page_conversion_packed"] = compose(f"""
select string_agg(page_pair || '=' || case when prev_count > 0 then {_half_up_text('pair_count', 'prev_count', 4)}
                                           else 'null' end, '|' order by step) as convert_rate
from page_conversion""", "page_conversion")

# --- area top products -------------------------------------------------------
cte("area_clicks", """
select a.city_id, d.city_name, d.area, a.click_product_id as pid
from user_visit_action a join city_area d on a.city_id = d.city_id
where a.click_product_id <> -1""", "user_visit_action", "city_area")
cte("area_product_counts", """
select area, pid, sum(n) as click_count, string_agg(ci, ',' order by ci) as city_infos
from (select area, pid, cast(city_id as varchar) || ':' || city_name as ci, count(*) as n
      from area_clicks group by area, pid, city_id, city_name)
group by area, pid""", "area_clicks")
cte("area_product_info", """
select c.area, c.pid, c.click_count, c.city_infos, p.product_name,
       case when json_extract_string(p.extend_info, '$.product_status') = '0' then 'Self' else 'Third Party' end
         as product_status
from area_product_counts c join product_info p on c.pid = p.product_id""", "area_product_counts", "product_info")

_level_case = " ".join(f"when area = '{a}' then '{lv}'" for a, lv in P.AREA_LEVELS.items())
SQL["area_clicks"] = compose("select * from area_clicks", "area_clicks")
SQL["area_product_counts"] = compose(
    "select area, pid, cast(click_count as bigint) as click_count, city_infos from area_product_counts",
    "area_product_counts")
SQL["area_product_info"] = compose(
    "select area, pid, cast(click_count as bigint) as click_count, city_infos, product_name, product_status "
    "from area_product_info", "area_product_info")
SQL["area_top3_products"] = compose(f"""
select area, case {_level_case} else 'D_Level' end as area_level, pid, city_infos,
       cast(click_count as bigint) as click_count, product_name, product_status
from (select *, row_number() over (partition by area order by click_count desc, pid asc) as rn
      from area_product_info)
where rn <= {P.TOP_PRODUCTS}""", "area_product_info")

# --- ad statistics -------------------------------------------------------------
_CLICK_COLS = "ts_ms, date, hour, minute, minute_key, province, city, userid, adid"
cte("ad_click_log", """
select event_id, ts_ms, epoch_ms(ts_ms) as ts, strftime(epoch_ms(ts_ms), '%Y%m%d') as date,
       strftime(epoch_ms(ts_ms), '%H') as hour, strftime(epoch_ms(ts_ms), '%M') as minute,
       strftime(epoch_ms(ts_ms), '%Y%m%d%H%M') as minute_key, province, city, userid, adid
from (select event_id, cast(p[1] as bigint) as ts_ms, p[2] as province, p[3] as city,
             cast(p[4] as bigint) as userid, cast(p[5] as bigint) as adid
      from (select event_id, string_split(value, ' ') as p from ad_log))""", "ad_log")
cte("ad_blocked", f"""
select userid, min(ts_ms) as blocked_at
from (select userid, ts_ms, row_number() over (partition by date, userid, adid order by ts_ms) as rn
      from ad_click_log)
where rn = {P.AD_THRESHOLD + 1}
group by userid""", "ad_click_log")
cte("ad_allowed", """
select c.* from ad_click_log c left join ad_blocked b using (userid)
where b.blocked_at is null or c.ts_ms <= b.blocked_at""", "ad_click_log", "ad_blocked")


def _daily(src: str) -> str:
    return f"select date, userid, adid, count(*) as click_count from {src} group by date, userid, adid"


def _stat(src: str) -> str:
    return f"select date, province, city, adid, count(*) as click_count from {src} group by date, province, city, adid"


def _top(stat_src: str) -> str:
    return f"""
select date, province, adid, click_count
from (select *, row_number() over (partition by date, province order by click_count desc, adid asc) as rn
      from (select date, province, adid, cast(sum(click_count) as bigint) as click_count
            from ({stat_src}) group by date, province, adid))
where rn <= {P.TOP_ADS}"""


def _blacklist(src: str) -> str:
    return f"select distinct userid from ({_daily(src)}) where click_count > {P.AD_THRESHOLD}"


def _trend(src: str) -> str:
    return f"select date, hour, minute, adid, count(*) as click_count from {src} group by date, hour, minute, adid"


SQL["ad_click_log"] = compose(f"select {_CLICK_COLS} from ad_click_log", "ad_click_log")
SQL["ad_user_daily_clicks"] = compose(_daily("ad_click_log"), "ad_click_log")
SQL["ad_blacklist"] = compose(_blacklist("ad_click_log"), "ad_click_log")
SQL["ad_clicks_allowed"] = compose(f"select {_CLICK_COLS} from ad_allowed", "ad_allowed")
SQL["ad_stat"] = compose(_stat("ad_allowed"), "ad_allowed")
SQL["ad_province_top3"] = compose(_top(_stat("ad_allowed")), "ad_allowed")
SQL["ad_click_trend"] = compose(_trend("ad_allowed"), "ad_allowed")
SQL["ad_recent_hour"] = compose(_trend(
    f"(select * from ad_allowed where ts_ms - ts_ms % 60000 > "
    f"(select max(ts_ms) from ad_allowed) - {P.WINDOW_MINUTES * 60000})"), "ad_allowed")
_W, _S = P.WINDOW_MINUTES, P.SLIDE_MINUTES
SQL["ad_hourly_sliding"] = compose(f"""
select strftime(ws, '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(ws + to_minutes({_W}), '%Y-%m-%d %H:%M:%S') as window_end, adid, count(*) as click_count
from (select adid, unnest(range(b - to_minutes({_W - _S}), b + to_minutes({_S}), to_minutes({_S}))) as ws
      from (select adid, time_bucket(to_minutes({_S}), ts) as b from ad_allowed))
group by ws, adid""", "ad_allowed")

# --- broken lines: what does not parse is rejected with a reason -----------------
cte("ad_log_dirty", """
select event_id, case event_id % 40
    when 0 then array_to_string(p[1:4], ' ')
    when 1 then array_to_string(p[1:3] || ['x'] || p[4:5], ' ')
    when 2 then array_to_string(['oops'] || p[2:5], ' ')
    when 3 then array_to_string(p[1:3] || ['abc'] || p[5:5], ' ')
    when 4 then '' else value end as value
from (select event_id, value, string_split(value, ' ') as p from ad_log)""", "ad_log")
cte("ad_dirty_parsed", """
select value, try_cast(p[1] as bigint) as ts_ms, p[2] as province, p[3] as city,
       try_cast(p[4] as bigint) as userid, try_cast(p[5] as bigint) as adid,
       case when len(p) <> 5 then 'not five fields' when try_cast(p[1] as bigint) is null then 'bad time'
            when try_cast(p[4] as bigint) is null or try_cast(p[5] as bigint) is null then 'bad user or ad' end as reason
from (select value, string_split(value, ' ') as p from ad_log_dirty)""", "ad_log_dirty")
SQL["ad_log_rejects"] = compose("select value, reason from ad_dirty_parsed where reason is not null", "ad_dirty_parsed")
SQL["ad_log_dirty_clicks"] = compose("""
select ts_ms, strftime(epoch_ms(ts_ms), '%Y%m%d') as date, strftime(epoch_ms(ts_ms), '%H') as hour,
       strftime(epoch_ms(ts_ms), '%M') as minute, strftime(epoch_ms(ts_ms), '%Y%m%d%H%M') as minute_key,
       province, city, userid, adid
from ad_dirty_parsed where reason is null""", "ad_dirty_parsed")

# --- keyed merges -----------------------------------------------------------------
_split_ms = f"(epoch_us(timestamp '{P.SPLIT_TS}') // 1000)"
cte("ad_early", f"select * from ad_click_log where ts_ms < {_split_ms}", "ad_click_log")
cte("ad_late", f"select * from ad_click_log where ts_ms >= {_split_ms}", "ad_click_log")


def _tagged_merge(t: str, u: str, keys: str, value: str, agg: str) -> str:
    return f"""
select {keys}, {agg} as {value},
       case when max(in_t) = 1 and max(in_u) = 1 then 'updated' when max(in_u) = 1 then 'inserted' else 'kept' end
         as action
from (select {keys}, {value}, 1 as in_t, 0 as in_u from ({t})
      union all
      select {keys}, {value}, 0 as in_t, 1 as in_u from ({u}))
group by {keys}"""


SQL["lookup_by_key"] = compose(f"""
select b.date, b.userid, b.adid, b.click_count as batch_count, coalesce(s.click_count, 0) as stored_count
from ({_daily('ad_late')}) b left join ({_daily('ad_early')}) s using (date, userid, adid)""",
    "ad_early", "ad_late")
SQL["upsert_add"] = compose(_tagged_merge(_daily("ad_early"), _daily("ad_late"), "date, userid, adid",
                                          "click_count", "cast(sum(click_count) as bigint)"),
                            "ad_early", "ad_late")
SQL["upsert_set"] = compose(_tagged_merge(
    _stat("ad_early"),
    f"select * from ({_stat('ad_click_log')}) where (date, province, city, adid) in "
    f"(select (date, province, city, adid) from ad_late)",
    "date, province, city, adid", "click_count", "arg_max(click_count, in_u)"), "ad_early", "ad_late")
SQL["replace_groups"] = compose(f"""
select t.*, 'kept' as action from ({_top(_stat('ad_early'))}) t
where (date, province) not in (select (date, province) from ad_late)
union all
select u.*, case when (u.date, u.province) in (select (date, province) from ({_top(_stat('ad_early'))}))
                 then 'replaced' else 'inserted' end as action
from ({_top(_stat('ad_click_log'))}) u
where (date, province) in (select (date, province) from ad_late)""", "ad_early", "ad_late")
SQL["append_distinct"] = compose(f"""
select userid, 'kept' as action from ({_blacklist('ad_early')})
union all
select userid, 'inserted' from ({_blacklist('ad_click_log')})
where userid not in (select userid from ({_blacklist('ad_early')}))""", "ad_early", "ad_late")

# --- utilities as table jobs -----------------------------------------------------
SQL["session_time_gaps"] = compose("""
select session_id, count(*) as pair_count, max(gap) as max_gap,
       count(*) filter (where t < t_next) as forward_steps, count(*) filter (where t > t_next) as back_steps
from (select session_id, action_time as t, t_next, cast(epoch(t_next) - epoch(action_time) as bigint) as gap
      from (select session_id, action_time, lead(action_time) over (partition by session_id order by event_id) as t_next
            from user_visit_action)
      where t_next is not null)
group by session_id""", "user_visit_action")

_asof = P.AS_OF_DAY
SQL["daily_activity"] = compose(f"""
select k.kind, strftime(date '{_asof}', '%Y%m%d') as day_key, strftime(date '{_asof}' - 1, '%Y%m%d') as prev_day_key,
       strftime(date '{_asof}' - 1, '%Y-%m-%d') as prev_day,
       coalesce(c.day_count, 0) as day_count, coalesce(c.prev_day_count, 0) as prev_day_count,
       coalesce(c.day_count, 0) - coalesce(c.prev_day_count, 0) as diff
from (values ('search'), ('click'), ('order'), ('pay'), ('view')) k(kind)
left join (select case when search_keyword is not null then 'search' when click_category_id <> -1 then 'click'
                       when order_category_ids is not null then 'order' when pay_category_ids is not null then 'pay'
                       else 'view' end as kind,
                  count(*) filter (where date = '{_asof}') as day_count,
                  count(*) filter (where date = strftime(date '{_asof}' - 1, '%Y-%m-%d')) as prev_day_count
           from user_visit_action
           where date in ('{_asof}', strftime(date '{_asof}' - 1, '%Y-%m-%d'))
           group by 1) c using (kind)""", "user_visit_action")


def _clean(c: str) -> tuple[str, str]:
    items = f"string_split(regexp_replace(',' || {c} || ',', '^,|,$', '', 'g'), ',')"
    clean = (f"list_sort(list_distinct(list_transform(list_filter({items}, lambda x: x <> ''), "
             f"lambda x: case when length(x) >= 2 then x else lpad(x, 2, '0') end)))")
    return f"array_to_string({clean}, ',')", f"coalesce(len({items}) - len({clean}), 0)"


_clean_cols = [_clean(c) for c in ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")]
SQL["clean_id_lists"] = compose(f"""
select event_id, {_clean_cols[0][0]} as order_category_ids, {_clean_cols[1][0]} as order_product_ids,
       {_clean_cols[2][0]} as pay_category_ids, {_clean_cols[3][0]} as pay_product_ids,
       {' + '.join(r for _, r in _clean_cols)} as removed_ids
from user_visit_action where order_category_ids is not null or pay_category_ids is not null""", "user_visit_action")

_PACKED = [("sessionid", "session_id"), ("searchKeywords", "search_keywords"),
           ("clickCategoryIds", "click_category_ids"), ("visitLength", "visit_length"),
           ("stepLength", "step_length"), ("startTime", "start_time"), ("age", "age"),
           ("professional", "professional"), ("sex", "sex"), ("city", "city")]


def _packed_value(c: str) -> str:
    if c == "start_time":
        return T.format(c="start_time")
    return f"coalesce(cast({c} as varchar), '')"


_step_label = " ".join(
    f"when step_length between {lo} and {hi} then '{n}'" if hi is not None else f"when step_length >= {lo} then '{n}'"
    for n, lo, hi in STEP_BUCKETS)
_repacked = " || '|' || ".join(
    f"'{k}=' || " + (f"(case {_step_label} else '0' end)" if k == "stepLength" else _packed_value(c))
    for k, c in sorted(_PACKED))
SQL["packed_sessions"] = compose(f"""
select session_id, visit_length, step_length, age,
       {" || '|' || ".join(f"'{k}=' || {_packed_value(c)}" for k, c in _PACKED)} as packed,
       {_repacked} as repacked
from session_full_info""", "session_full_info")

# --- the composed paths: the same statements over filtered or ranged actions -----


def over(actions: str, suffix: str, *names: str) -> None:
    """Copies of the statements ``names`` that read ``actions`` and each other."""
    swap = {"user_visit_action": actions, **{n: f"{n}{suffix}" for n in names}}
    for n in names:
        sql, deps = CTES[n]
        for a, b in swap.items():
            sql = re.sub(rf"\b{a}\b", b, sql)
        cte(f"{n}{suffix}", sql, *[swap.get(d, d) for d in deps])


_PL = P.FILTER_PLACES
SQL["session_filtered_places"] = compose(f"""
select {_rollup_cols}, age, professional, sex, city from session_full_info
where coalesce(city in ({_quote_list(_PL['cities'])}), false) and {_overlap('click_category_ids', _PL['category_ids'])}""",
    "session_full_info")
cte("actions_of_filtered", """
select * from user_visit_action where session_id in (select session_id from session_filtered)""",
    "user_visit_action", "session_filtered")
cte("actions_ranged", f"select * from user_visit_action where date between '{P.RANGE_START}' and '{P.RANGE_END}'",
    "user_visit_action")
over("actions_of_filtered", "_f", "category_events", "category_full_counts", "category_top10", "session_category_clicks")
over("actions_ranged", "_r", "page_transitions", "page_flow_counts", "page_conversion",
     "area_clicks", "area_product_counts", "area_product_info")
SQL["filtered_category_top10"] = compose("select * from category_top10_f", "category_top10_f")
SQL["filtered_category_top10_sessions"] = compose(f"""
select category_id, session_id, click_count
from (select *, row_number() over (partition by category_id order by click_count desc, session_id asc) as rn
      from session_category_clicks_f)
where rn <= {P.TOP_SESSIONS}""", "session_category_clicks_f")
SQL["page_conversion_in_range"] = compose("select * from page_conversion_r", "page_conversion_r")
SQL["area_top3_in_range"] = compose(f"""
select area, case {_level_case} else 'D_Level' end as area_level, pid, city_infos,
       cast(click_count as bigint) as click_count, product_name, product_status
from (select *, row_number() over (partition by area order by click_count desc, pid asc) as rn
      from area_product_info_r)
where rn <= {P.TOP_PRODUCTS}""", "area_product_info_r")

# --- sinks ---------------------------------------------------------------------
SQL["sink_append"] = compose("""
select *, 'run-1' as task_id from category_top10
union all
select *, 'run-2' as task_id from category_top10""", "category_top10")
SQL["sink_overwrite_table"] = SQL["area_top3_products"]
SQL["actions_partitioned_range"] = SQL["actions_in_range"]

# --- streams: checked against the batch forms over all clicks ---------------------
SQL["stream_ad_stat"] = compose(_stat("ad_click_log"), "ad_click_log")
SQL["stream_province_top3"] = compose(_top(_stat("ad_click_log")), "ad_click_log")
SQL["stream_click_trend"] = compose(_trend("ad_click_log"), "ad_click_log")
SQL["stream_hourly_sliding"] = compose(f"""
select strftime(ws, '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(ws + to_minutes({_W}), '%Y-%m-%d %H:%M:%S') as window_end, adid, count(*) as click_count
from (select adid, unnest(range(b - to_minutes({_W - _S}), b + to_minutes({_S}), to_minutes({_S}))) as ws
      from (select adid, time_bucket(to_minutes({_S}), ts) as b from ad_click_log))
group by ws, adid""", "ad_click_log")
SQL["stream_blacklist"] = compose(_blacklist("ad_click_log"), "ad_click_log")

# --- the filtered stream: one micro-batch per arrival; arrival i holds the
# event-id range i of STREAM_BATCHES equal ranges; a user listed by the end of
# batch i loses their clicks from batch i + 1 on ---------------------------------
cte("ad_batched", f"""
select c.*, (c.event_id - (select min(event_id) from ad_click_log))
            // (select (max(event_id) - min(event_id)) // {P.STREAM_BATCHES} + 1 from ad_click_log) as batch
from ad_click_log c""", "ad_click_log")


for _i in range(P.STREAM_BATCHES):
    _src = "ad_batched where batch = 0" if _i == 0 else (
        f"ad_batched where batch = {_i} and userid not in (select userid from listed_{_i - 1})")
    cte(f"allowed_{_i}", f"select * from {_src}", "ad_batched", *([f"listed_{_i - 1}"] if _i else []))
    _so_far = " union all ".join(f"select * from allowed_{j}" for j in range(_i + 1))
    cte(f"listed_{_i}", _blacklist(f"({_so_far})"), *[f"allowed_{j}" for j in range(_i + 1)])
cte("ad_stream_allowed", " union all ".join(f"select * from allowed_{j}" for j in range(P.STREAM_BATCHES)),
    *[f"allowed_{j}" for j in range(P.STREAM_BATCHES)])
SQL["stream_filtered_ad_stat"] = compose(_stat("ad_stream_allowed"), "ad_stream_allowed")
SQL["stream_filtered_province_top3"] = compose(_top(_stat("ad_stream_allowed")), "ad_stream_allowed")
SQL["stream_filtered_click_trend"] = compose(_trend("ad_stream_allowed"), "ad_stream_allowed")
