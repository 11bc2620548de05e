"""DuckDB SQL for the queries, always computed from the given tables' own columns."""

from __future__ import annotations

EV = """
ev as (
  select event_id, ts, user_id, event_type,
    concat('30.', 128 + user_id % 4, '.', user_id // 256, '.', user_id % 256) sip,
    cast(1024 + event_id % 60000 as varchar) sport,
    concat(100 + event_id % 27, '.', event_id % 4, '.7.9') dip,
    case event_id % 3 when 0 then '80' when 1 then '443' else '53' end dport,
    case event_id % 2 when 0 then 'TCP' else 'UDP' end proto,
    concat('203.0.113.', event_id % 10) nip,
    cast(10000 + event_id % 20 as varchar) nport
  from events)"""

LINES = """
lines as (
  select event_id, ts, case
    when event_id % 20 = 9 then concat('10.254.', event_id % 7, '.25.2000 > 30.1.1.1.514: syslog')
    when event_id % 20 = 19 then concat('Msg: garbage ', event_id)
    when event_id % 10 in (6, 7, 8) then concat(
      'Msg: ', strftime(ts, '%b'), '  ', strftime(ts, '%-d %H:%M:%S'),
      ' 2200000000000017(root) 10000001 Traffic@FLOW: NAT: ', sip, ':', sport, '->', dip,
      ':', dport, '(', proto, '), snat to ', nip, ':', nport,
      ', vr vr-one, user -@UNKNOWN, host -, rule 7')
    else concat(
      'Msg: ', strftime(ts, '%Y-%m-%d %H:%M:%S'), ' fw1 nat=1,proto=', proto,
      ',sip=', sip, ',dip=', dip, ',sport=', sport, ',dport=', dport,
      ',nip=', nip, ',nport=', nport)
    end as value
  from ev)"""

FIELDS = 'sip "sourceIp", sport "sourcePort", dip "targetIp", dport "targetPort", \
proto protocol, nip "convertedIp", nport "convertedPort"'


def _key(ip: str, port: str, at: str) -> str:
    seconds = f"(epoch_us({at}) // 1000000)"
    return (
        f"concat(substr(md5(concat({ip}, '_', {port})), 9, 16), '_', "
        f"cast(9223372036854775807 - {seconds} * 1000 as varchar))"
    )


SES = f"""
ses as (
  select event_id, event_type, date_trunc('second', ts) accesstime, {FIELDS},
    time_bucket(interval 5 minutes, ts) slot,
    {_key('nip', 'nport', "date_trunc('second', ts)")} rowkey
  from ev where event_id % 20 not in (9, 19))"""

COARSE = f"""
coarse as (
  select event_type, date_trunc('hour', ts) accesstime, {FIELDS},
    {_key('nip', 'nport', "date_trunc('hour', ts)")} rowkey
  from ev where event_id % 20 not in (9, 19))"""

RADIUS = """
radius as (
  select concat('30.', 128 + c_custkey % 4, '.', c_custkey // 256, '.', c_custkey % 256) ip,
    max(c_name) account
  from customer where c_custkey % 5 <> 0 group by 1)"""

GEO = """
geo as (
  select 100 + n_nationkey octet, n_name province, concat('city_', n_nationkey % 7) city,
    r_name as operator
  from nation join region on n_regionkey = r_regionkey)"""

DETAIL = """
detail as (
  select accesstime, t."targetIp", coalesce(province, 'UnKnown') province,
    coalesce(g.operator, 'UnKnown') as operator, coalesce(city, 'UnKnown') city, n
  from (select {at} accesstime, "targetIp", count(*) n from ses group by 1, 2) t
  left join geo g on g.octet = cast(split_part("targetIp", '.', 1) as int))"""

USERS = """
users as (
  select {at} accesstime, account username, count(*) n
  from ses join radius on ip = "sourceIp" group by 1, 2)"""

SUBSCRIBERS = """
subscribers as (
  select c_custkey id, c_name username, r_name rid1, n_name rid2, c_mktsegment rid3,
    cast(c_custkey % 10 as varchar) rid4
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

MANIFEST = """
manifest as (
  select concat('/nat_log/', lpad(cast(o_orderkey as varchar), 10, '0')) path,
    cast(floor(o_totalprice) as bigint) size_mb, o_orderkey % 10 = 0 backlog
  from orders),
chosen as (
  select *, coalesce(cast(sum(size_mb) over (order by backlog desc, path
      rows between unbounded preceding and 1 preceding) as bigint), 0) // 1024
    <= (select cast(sum(size_mb) as bigint) // 2048 from manifest) admitted
  from manifest)"""

DISTINCT_COARSE = """
least as (
  select rowkey, min({'a': accesstime, 'b': "sourceIp", 'c': "sourcePort", 'd': "targetIp",
    'e': "targetPort", 'f': protocol, 'g': "convertedIp", 'h': "convertedPort"}) r
  from coarse group by rowkey),
dedup as (
  select r.a accesstime, r.b "sourceIp", r.c "sourcePort", r.d "targetIp", r.e "targetPort",
    r.f protocol, r.g "convertedIp", r.h "convertedPort", rowkey
  from least)"""

SLOT = "timestamp '2024-01-14 23:55:00'"
EVENT = "time_bucket(interval 5 minutes, accesstime)"
CUTOFF = "timestamp '2024-01-14 21:00:00'"


def _report(at: str, host_at: str = SLOT) -> str:
    """CTEs up to ``report``: all seven dimensions with the time expression ``at``."""
    return f"""with {EV}, {SES}, {RADIUS}, {GEO}, {DETAIL.format(at=at)}, {USERS.format(at=at)},
hosts as (
  select {host_at} accesstime, concat('10.254.', event_id % 7, '.25') host, count(*) n
  from events where event_id % 20 = 9 group by 1, 2),
sources as (select {at} accesstime, "sourceIp", count(*) n from ses group by 1, 2),
report as (
  select 'hostIP' types, accesstime, host as data, n from hosts
  union all (select 'targetIp', accesstime, "targetIp", n from detail
    order by n desc, accesstime, "targetIp" limit 100)
  union all (select 'username', accesstime, username, n from users
    order by n desc, accesstime, username limit 100)
  union all (select 'sourceIp', accesstime, "sourceIp", n from sources
    order by n desc, accesstime, "sourceIp" limit 100)
  union all select 'province', accesstime, province, sum(n) from detail group by 2, 3
  union all select 'operator', accesstime, operator, sum(n) from detail group by 2, 3
  union all select 'city', accesstime, city, sum(n) from detail group by 2, 3)
"""


def _rows(alias: str = "report") -> str:
    return f'select types, accesstime, data, cast(n as bigint) as "count" from {alias}'


def _part(name: str) -> str:
    return f"{_report(SLOT)} {_rows()} where types = '{name}'"


SESSION = '"sourceIp", "sourcePort", "targetIp", "targetPort", protocol, "convertedIp", "convertedPort"'

COUNTERS = """
totals as ({inner}),
counters as (
  select counter, n count_5min, n // 300 count_sec, update_time, {slot} accesstime
  from (select 'nat_count' counter, update_time, raw n from totals
    union all select 'nat_hbase_count', update_time, uniq from totals))"""

SLOT_TOTALS = f"""select {EVENT} update_time, count(*) raw, count(distinct rowkey) uniq
  from {{rows}} {{where}} group by 1"""


def _traced(where: str, limit: str = "limit 11") -> str:
    return f"""with {EV}, {SES}, {RADIUS},
one as (
  select rowkey, min({{'a': accesstime, 'b': "sourceIp", 'c': "sourcePort", 'd': "targetIp",
    'e': "targetPort", 'f': protocol, 'g': "convertedIp", 'h': "convertedPort"}}) r
  from ses group by rowkey),
stored as (
  select r.a accesstime, r.b "sourceIp", r.c "sourcePort", r.d "targetIp", r.e "targetPort",
    r.f protocol, r.g "convertedIp", r.h "convertedPort",
    coalesce(account, 'UnKnown') username, rowkey
  from one left join radius on ip = r.b)
select * from stored where {where} order by rowkey {limit}"""


def _in_days(where: str) -> str:
    """What ``_traced`` finds in a day with all sessions, and in the next day with a third of them."""
    return f"""with all_of as ({_traced(where, "")}),
late as (select * from all_of where second(accesstime) % 3 = 0)
select '20240114' dt, * from all_of
union all select '20240115', * replace ('next day' as username) from late"""


def _backfill() -> str:
    return f"""with {EV}, {SES}, {RADIUS}, {GEO}, {DETAIL.format(at=EVENT)}, {USERS.format(at=EVENT)},
hosts as (
  select time_bucket(interval 5 minutes, ts) accesstime,
    concat('10.254.', event_id % 7, '.25') host, count(*) n
  from events where event_id % 20 = 9 group by 1, 2),
sources as (select {EVENT} accesstime, "sourceIp", count(*) n from ses group by 1, 2),
ranked as (
  select *, row_number() over (partition by types, accesstime order by n desc, data) r from (
    select 'targetIp' types, accesstime, "targetIp" as data, n from detail
    union all select 'username', accesstime, username, n from users
    union all select 'sourceIp', accesstime, "sourceIp", n from sources)),
report as (
  select types, accesstime, data, n from ranked where r <= 100
  union all select 'hostIP', accesstime, host, n from hosts
  union all select 'province', accesstime, province, sum(n) from detail group by 2, 3
  union all select 'operator', accesstime, operator, sum(n) from detail group by 2, 3
  union all select 'city', accesstime, city, sum(n) from detail group by 2, 3)
select accesstime + interval 5 minutes as batch, types, accesstime, data, cast(n as bigint) as "count"
from report"""


def _rerun() -> str:
    """What one line in twenty leaves, all of them sessions, and a batch without any."""
    fewer = "from (select * from events where event_id % 20 = 0)"
    return f"""{_report(SLOT).replace("from events", fewer)},
n as (select count(*) n from ses)
select types as name, data, cast(n as bigint) as "count" from report
union all select 'counter', c || ' ' || slot, case when slot < '2024-01-15' then n.n else 0 end
from n, (values ('nat_count'), ('nat_hbase_count')) c(c),
  (values ('2024-01-14 23:55:00'), ('2024-01-15 00:00:00')) a(slot)
union all select 'sessions', '', n from n"""


def _broken() -> str:
    return f"""with {EV}, k as (select *, event_id % 9 k, date_trunc('second', ts) accesstime from ev)
select event_id, accesstime, sip "sourceIp",
  case when k in (3, 4, 8) then '' else sport end "sourcePort",
  case when k = 3 then '0.0.0.0' else dip end "targetIp",
  case when k in (3, 4, 5) then '' else dport end "targetPort",
  proto protocol,
  case when k in (3, 4, 5, 6) then '0.0.0.0' else nip end "convertedIp",
  case when k in (3, 4, 5, 6, 7) then '' else nport end "convertedPort"
from k where k not in (1, 2)"""


def _hours() -> str:
    hours = " || ',' || ".join(
        f"'{h:02d}=' || coalesce(max(case when h = {h} then cast(n as varchar) end), '0')"
        for h in range(24)
    )
    return f"""with c as (
  select event_type, hour(ts) h, count(*) n from events group by 1, 2)
select event_type, {hours} as hours from c group by event_type"""


def _buckets() -> str:
    day = "date_trunc('day', ts)"
    ends = {
        "hour": ("date_trunc('hour', ts)", 3600),
        "six_hours": (f"{day} + to_hours(hour(ts) // 6 * 6)", 21600),
        "day": (day, 86400),
        "five_minutes": ("time_bucket(interval 5 minutes, ts)", 300),
    }
    columns = ", ".join(
        f"cast({end} as timestamp) as {name}_end, "
        f"cast({end} - to_seconds({length}) as timestamp) as {name}_start"
        for name, (end, length) in ends.items()
    )
    return f"select event_id, {columns} from events"


def _number(ip: str) -> str:
    octets = [f"cast(split_part({ip}, '.', {i}) as bigint)" for i in (1, 2, 3, 4)]
    return f"(({octets[0]} * 256 + {octets[1]}) * 256 + {octets[2]}) * 256 + {octets[3]}"


ORACLES: dict[str, str] = {
    # sources
    "minute_scan": f"with {EV}, {LINES} select value from lines where minute(ts) between 25 and 29",
    "mtime_scan": f"with {EV}, {LINES} select value from lines",
    "admit_files": f"with {MANIFEST} select path, size_mb, backlog, admitted from chosen",
    "admit_backlog": f"with {MANIFEST} select path, size_mb, true backlog from chosen where not admitted",
    "quota_setting": "select 'one' as source, 7::bigint limit_gb union all select 'many', 40::bigint",
    "clean_lines": f"with {EV}, {LINES} select value from lines",
    "radius_dim": f"with {RADIUS} select ip, account from radius",
    "account_lookup": f"""with {RADIUS}
select account, max(ip) ip from radius where account = 'Customer#000000042' group by 1
union all select 'nobody', 'null'""",
    "dim_sample": f"with {RADIUS} select ip, account from radius order by ip limit 100",
    "hash_partitions": """select c_custkey % 100 as bucket, cast(count(*) as bigint) as "count"
from customer group by 1""",
    "tuple_scan": """select concat(c_name, ',', c_mktsegment, ',x') username, c_custkey as "count"
from customer""",
    "group_offsets": """select o_orderstatus topic, cast(o_custkey % 4 as int) "partitionNum",
  max(o_orderkey) offsets
from orders where o_orderpriority = '1-URGENT' group by 1, 2""",
    "starting_offsets": """with o as (
  select o_orderstatus topic, cast(o_custkey % 4 as int) p, max(o_orderkey) n
  from orders where o_orderpriority = '1-URGENT' group by 1, 2),
t as (select topic, concat('"', topic, '":{',
  string_agg(concat('"', p, '":', n), ',' order by p), '}') s from o group by 1)
select concat('{', string_agg(s, ',' order by topic), '}') as "startingOffsets" from t""",
    "trace_time": _traced(
        "accesstime >= timestamp '2024-01-10' and accesstime < timestamp '2024-01-10 06:00:00'"
    ),
    "trace_converted_ip": _traced("\"convertedIp\" = '203.0.113.3'"),
    "trace_source_ip": _traced("\"sourceIp\" = '30.130.0.74'"),
    "trace_endpoint": _traced(
        "\"convertedIp\" = '203.0.113.7' and \"convertedPort\" = '10007' and "
        "accesstime >= timestamp '2024-01-05' and accesstime < timestamp '2024-01-20'",
        "",
    ),
    # sinks
    "report_roundtrip": f"""{_report(SLOT)} select b.batch, types, accesstime, data,
  cast(n as bigint) as "count"
from report, (values ('202401142355'), ('202401150000')) b(batch)""",
    "user_counts_roundtrip": f"""with {EV}, {SES}, {RADIUS}, {USERS.format(at=SLOT)}
select username, cast(n as bigint) as "count" from users""",
    "session_upsert": f"""with {EV}, {COARSE}, {DISTINCT_COARSE},
again as (select rowkey, count(*) n from coarse where event_type = 'error' group by 1)
select rowkey, accesstime, "convertedIp", "convertedPort",
  case when n is null then 'first' else 'again' end username
from dedup left join again using (rowkey)""",
    "session_cells": f"""with {EV}, {COARSE}, {DISTINCT_COARSE},
texts as (select strftime(accesstime, '%Y-%m-%d %H:%M:%S') accesstime, "convertedIp",
  "convertedPort", protocol, "sourceIp", "sourcePort", "targetIp", "targetPort",
  'UnKnown' username, rowkey from dedup)
select rowkey, name as qualifier, value from texts unpivot (value for name in (accesstime,
  "convertedIp", "convertedPort", protocol, "sourceIp", "sourcePort", "targetIp", "targetPort",
  username))""",
    "region_counts": f"""with {EV}, {COARSE}
select cast(('0x' || substr(rowkey, 1, 8))::bigint * 20 // 4294967296 as int) region,
  cast(count(distinct rowkey) as bigint) as "count"
from coarse group by 1""",
    "batch_counters": f"""with {EV}, {COARSE},
{COUNTERS.format(inner=f"select {SLOT} update_time, count(*) raw, count(distinct rowkey) uniq from coarse", slot=SLOT)}
select * from counters""",
    # parser
    "host_lines": f"with {EV}, {LINES} select value from lines where event_id % 20 = 9",
    "msg_lines": f"with {EV}, {LINES} select value from lines where event_id % 20 <> 9",
    "format_counts": """select case when event_id % 20 = 19 or event_id % 10 in (6, 7, 8)
  then 'A' else 'B' end as format, cast(count(*) as bigint) as "count"
from events where event_id % 20 <> 9 group by 1""",
    "parse_a": f"with {EV}, {SES} select accesstime, {SESSION} from ses where event_id % 10 in (6, 7, 8)",
    "parse_b": f"with {EV}, {SES} select accesstime, {SESSION} from ses where event_id % 10 not in (6, 7, 8)",
    "parse_partial": _broken(),
    "parse_border": f"""with {EV}
select event_id, date_trunc('second', ts - interval 14 day) accesstime from ev""",
    "flows": f"with {EV}, {SES} select accesstime, {SESSION} from ses",
    "rejects": f"""with {EV}, {LINES}
select value, 'A' as format, 'shape' reason from lines where event_id % 20 = 19""",
    "rowkeys": f"with {EV}, {SES} select event_id, rowkey from ses",
    "secondary_index": f"""with {EV}, {SES} select accesstime, substr(md5(concat("targetIp",
  "targetPort", "convertedIp", "convertedPort")), 9, 16) "partKey", rowkey from ses""",
    "geo_fields": """select n_nationkey, case when k then 'continent' end continent,
  case when k then r_name end country, case when k then n_name end province,
  case when k then concat('city_', n_nationkey % 7) end city,
  case when k then 'district' end district, case when k then r_name end as operator,
  case when k then cast(n_nationkey as varchar) end area_code,
  case when k then 'english' end english, case when k then 'code' end short_code,
  case when k then '1.5' end lon, case when k then '2.5' end lat
from (select *, n_nationkey % 5 <> 0 k from nation join region on n_regionkey = r_regionkey)""",
    # joins
    "flows_with_account": f"""with {EV}, {SES}, {RADIUS}
select accesstime, {SESSION}, coalesce(account, 'UnKnown') username
from ses left join radius on ip = "sourceIp\"""",
    "geo_join": f"""with {EV}, {GEO} select distinct dip, coalesce(province, 'UnKnown') province,
  coalesce(g.operator, 'UnKnown') as operator, coalesce(city, 'UnKnown') city
from ev left join geo g on octet = cast(split_part(dip, '.', 1) as int)""",
    "geo_overlaps": f"""with {EV}, t as (select distinct dip, {_number('dip')} n from ev),
g as (
  select (100 + n_nationkey::bigint) * 16777216 lo, (101 + n_nationkey::bigint) * 16777216 - 1 hi,
    n_name province, concat('city_', n_nationkey % 7) city, r_name as operator
  from nation join region on n_regionkey = r_regionkey
  union all
  select (100 + n_nationkey::bigint) * 16777216 + (n_nationkey % 3) * 65536,
    (101 + n_nationkey::bigint) * 16777216 + 65536 * n_nationkey, concat('over_', n_name),
    'over_city', 'over'
  from nation where n_nationkey % 2 = 0),
r as (
  select dip, n, hi, province, city, g.operator as op, row_number() over (
    partition by dip order by lo desc nulls last, hi desc, province, g.operator, city) k
  from t left join g on lo <= n)
select dip, case when hi >= n then province else 'UnKnown' end province,
  case when hi >= n then op else 'UnKnown' end as operator,
  case when hi >= n then city else 'UnKnown' end city
from r where k = 1""",
    "geo_dense": """with t as (select event_id % 65536 k, count(*)::bigint n from events group by 1),
g as (select distinct o_orderkey % 65536 k from orders)
select concat('100.0.', t.k // 256, '.', t.k % 256) dip, n as "count",
  case when g.k is null then 'UnKnown' else concat('p_', t.k) end province,
  case when g.k is null then 'UnKnown' else concat('o_', t.k % 2) end as operator,
  case when g.k is null then 'UnKnown' else 'dense' end city
from t left join g on t.k = g.k""",
    "liveness": f"""with {EV}, {SES}, {RADIUS}, {USERS.format(at=SLOT)}, {SUBSCRIBERS}
select s.username, coalesce(n, 0)::bigint resolver, timestamp '2024-01-14' accesstime,
  rid1, rid2, rid3, rid4
from subscribers s left join users u on u.username = s.username""",
    "app_lookup": f"""with {EV}, t as (select distinct dip from ev),
r as (select n_nationkey p, (100 + n_nationkey) * 16777216 lo, (102 + n_nationkey) * 16777216 hi,
  n_name app from nation)
select dip, coalesce(max_by(app, p), '其他') app
from t left join r on {_number('dip')} >= lo and {_number('dip')} < hi group by dip""",
    # counts
    "salted_count": f"""with {EV}, {SES} select "targetIp", cast(count(*) as bigint) as "count"
from ses group by 1""",
    "host_report": _part("hostIP"),
    "target_detail": f"""with {EV}, {SES}, {GEO}, {DETAIL.format(at=EVENT)}
select accesstime, "targetIp", province, operator, city, cast(n as bigint) as "count" from detail""",
    "geo_rollup": f"{_report(EVENT)} {_rows()} where types in ('province', 'operator', 'city')",
    "province_report": _part("province"),
    "operator_report": _part("operator"),
    "city_report": _part("city"),
    "user_counts": f"""with {EV}, {SES}, {RADIUS}, {USERS.format(at=EVENT)}
select accesstime, username, cast(n as bigint) as "count" from users""",
    "source_counts": f"""with {EV}, {SES} select {EVENT} accesstime, "sourceIp",
  cast(count(*) as bigint) as "count" from ses group by 1, 2""",
    "dedup_sessions": f"with {EV}, {COARSE}, {DISTINCT_COARSE} select * from dedup",
    "window_counters": f"""with {EV}, {COARSE},
{COUNTERS.format(inner=SLOT_TOTALS.format(rows="coarse", where=f"where {EVENT} >= {CUTOFF}"), slot=SLOT)}
select * from counters""",
    "late_windows": f"""with {EV}, {COARSE} select {EVENT} accesstime,
  cast(count(*) as bigint) as "count" from coarse where {EVENT} < {CUTOFF} group by 1""",
    "daily_user_sum": f"""with {EV}, {SES}, {RADIUS}, {USERS.format(at=SLOT)}
select username, cast(sum(n) as bigint) as "count" from users group by 1""",
    "daily_totals": f"""with {EV}, {COARSE},
t as (select count(*) raw, count(distinct rowkey) uniq from coarse
  where accesstime >= timestamp '2024-01-10' and accesstime < timestamp '2024-01-11')
select 'nat_count' counter, raw::bigint count_day, timestamp '2024-01-10' as date from t
union all select 'nat_hbase_count', uniq::bigint, timestamp '2024-01-10' from t""",
    "top_targets": f"{_report(EVENT)} {_rows()} where types = 'targetIp'",
    "top_users": f"{_report(EVENT)} {_rows()} where types = 'username'",
    "top_sources": f"{_report(EVENT)} {_rows()} where types = 'sourceIp'",
    "top_target_detail": f"""with {EV}, {SES}, {GEO}, {DETAIL.format(at=SLOT)}
select "targetIp" ip, replace(province, 'UnKnown', '未知') province,
  replace(city, 'UnKnown', '未知') city, replace(operator, 'UnKnown', '未知') as operator
from detail order by n desc, "targetIp" limit 500""",
    # reports
    "nat_report": f"{_report(SLOT)} {_rows()}",
    "delay_report": f"{_report(EVENT)} {_rows()}",
    "backfill": _backfill(),
    "consolidate": f"""with {EV}, {SES} select 'targetIp' types, {EVENT} accesstime,
  "targetIp" as data, cast(count(*) as bigint) as "count" from ses group by 2, 3""",
    # scalar functions
    "ip_to_long": f"""with {EV} select event_id, {_number('dip')} target, {_number('sip')} source,
  0::bigint longer from ev""",
    "five_minute_counts": """select time_bucket(interval 5 minutes, ts) accesstime,
  cast(count(*) as bigint) as "count" from events group by 1""",
    "task_buckets": _buckets(),
    "iso_floor": "select event_id, time_bucket(interval 5 minutes, ts) slot from events",
    "format_time": """select event_id, strftime(ts, '%Y%m%d/%H/%M') folder,
  strftime(ts, '%Y-%m-%d %H:%M:%S') "second" from events""",
    "hour_fill": _hours(),
    # streams
    "stream_report": f"""{_report(EVENT, "timestamp '1970-01-01'")} {_rows()}""",
    "stream_windows": """select event_type, time_bucket(interval 5 minutes, ts) accesstime,
  cast(count(*) as bigint) as "count" from events group by 1, 2""",
    "stream_late": """select time_bucket(interval 5 minutes, ts) accesstime,
  cast(count(*) as bigint) as "count"
from events where ts >= timestamp '2024-01-11' or event_type <> 'error' group by 1""",
    "stream_dedup": f"""with {EV}, {COARSE}
select distinct rowkey, accesstime, "convertedIp", "convertedPort" from coarse""",
    "stream_quota": f"""with {EV}, {SES}
select protocol as name, count(*)::bigint as "count" from ses group by 1
union all select * from (values ('split', 1::bigint), ('carried', 1), ('files', 6), ('bytes_left', 0)) v""",
    # jobs
    "batch_job": f"""{_report(SLOT)},
{COUNTERS.format(inner=f"select {SLOT} update_time, count(*) raw, count(distinct rowkey) uniq from ses", slot=SLOT)}
select types as name, data, accesstime, cast(n as bigint) as "count" from report
union all select 'counter', counter, accesstime, count_5min from counters
union all select 'cells', qualifier, accesstime, count from (
  select q as qualifier, {SLOT} accesstime, (select count(distinct rowkey) from ses) as count
  from (values ('accesstime'), ('convertedIp'), ('convertedPort'), ('protocol'), ('sourceIp'),
    ('sourcePort'), ('targetIp'), ('targetPort'), ('username')) v(q))""",
    "rerun_job": _rerun(),
    "backfill_job": _backfill(),
    "rejects_table": f"""with {EV}, {LINES}
select value, 'A' as format, 'shape' reason from lines where event_id % 20 = 19""",
    "target_places_job": f"""with {EV}, {SES}, {GEO}, {DETAIL.format(at=SLOT)}
select "targetIp" ip, replace(province, 'UnKnown', '未知') province,
  replace(city, 'UnKnown', '未知') city, replace(operator, 'UnKnown', '未知') as operator
from detail order by n desc, "targetIp" limit 100""",
    "session_compacted": f"""select dt, protocol, count(*)::bigint as "count"
from ({_traced("true", "")}), (values ('20240114'), ('20240115')) d(dt) group by 1, 2""",
    "trace_indexed": _in_days("\"sourceIp\" = '30.130.0.74'"),
    "trace_endpoints_indexed": _in_days(
        "\"targetIp\" = '101.1.7.9' and \"targetPort\" = '443' and "
        "\"convertedIp\" = '203.0.113.3' and \"convertedPort\" = '10013'"
    ),
    "trace_hours": _in_days(
        "accesstime >= timestamp '2024-01-14' and accesstime < timestamp '2024-01-14 06:00:00'"
    ),
    "trace_pages": _in_days("accesstime >= timestamp '2024-01-01' and accesstime < timestamp '2024-01-16'"),
    "fold_increments": f"""with n as (select protocol, count(*)::bigint n from ({_traced("true", "")}) group by 1)
select layout, protocol as name, n as "count" from n, (values ('by key'), ('by time')) l(layout)
union all select 'index', c, (select sum(n)::bigint from n)
from (values ('sourceIp'), ('convertedIp'), ('username'), ('endpoints')) v(c)""",
    "delayed_job": f"""{_report(EVENT)},
{COUNTERS.format(inner=SLOT_TOTALS.format(rows="ses", where=f"where {EVENT} >= {CUTOFF}"), slot=SLOT)}
select types as name, data, accesstime, cast(n as bigint) as "count" from report
union all select 'counter', counter, update_time, count_5min from counters""",
    "daily_job": f"""with {EV}, {SES}, {RADIUS}, {USERS.format(at=SLOT)}, {SUBSCRIBERS},
t as (select count(*) raw, count(distinct rowkey) uniq from ses)
select s.username as name, coalesce(n, 0)::bigint as "count" from subscribers s
left join users u on u.username = s.username
union all select 'nat_count', raw from t union all select 'nat_hbase_count', uniq from t""",
}
