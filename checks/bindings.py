"""Inputs of every query, made by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = 2024

SQL = {
    "ev": """
        select event_id, cast(ts as timestamp) ts, user_id, event_type,
          concat('30.', 128 + user_id % 4, '.', user_id div 256, '.', user_id % 256) sip,
          cast(1024 + event_id % 60000 as string) sport,
          concat(100 + event_id % 27, '.', event_id % 4, '.7.9') dip,
          case event_id % 3 when 0 then '80' when 1 then '443' else '53' end dport,
          case event_id % 2 when 0 then 'TCP' else 'UDP' end proto,
          concat('203.0.113.', event_id % 10) nip,
          cast(10000 + event_id % 20 as string) nport
        from {events}""",
    "lines": """
        select event_id, ts, case
          when event_id % 20 = 9
            then concat('10.254.', event_id % 7, '.25.2000 > 30.1.1.1.514: syslog')
          when event_id % 20 = 19 then concat('Msg: garbage ', event_id)
          when event_id % 10 in (6, 7, 8) then concat(
            'Msg: ', date_format(ts, 'MMM'), '  ', date_format(ts, 'd HH:mm:ss'),
            ' 2200000000000017(root) 10000001 Traffic@FLOW: NAT: ', sip, ':', sport, '->', dip,
            ':', dport, '(', proto, '), snat to ', nip, ':', nport,
            ', vr vr-one, user -@UNKNOWN, host -, rule 7')
          else concat(
            'Msg: ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' fw1 nat=1,proto=', proto,
            ',sip=', sip, ',dip=', dip, ',sport=', sport, ',dport=', dport,
            ',nip=', nip, ',nport=', nport)
          end value
        from {ev}""",
    "geo": """
        select (100 + n_nationkey) * 16777216L lo, (100 + n_nationkey) * 16777216L + 16777215L hi,
          n_name province, concat('city_', n_nationkey % 7) city, r_name operator
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "geo_text": """
        select n_nationkey, concat_ws('|', 'continent', r_name, n_name,
          concat('city_', n_nationkey % 7), 'district', r_name, cast(n_nationkey as string),
          'english', 'code',
          case when n_nationkey % 5 = 0 then '' else '1.5' end,
          case when n_nationkey % 5 = 0 then '' else '2.5' end) text
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "radius_json": """
        select to_json(named_struct('ip', concat('30.', 128 + c_custkey % 4, '.',
          c_custkey div 256, '.', c_custkey % 256), 'account', c_name)) value
        from {customer} where c_custkey % 5 <> 0""",
    "subscribers": """
        select c_custkey id, c_name username, r_name rid1, n_name rid2, c_mktsegment rid3,
          cast(c_custkey % 10 as string) rid4
        from {customer} join {nation} on c_nationkey = n_nationkey
          join {region} on n_regionkey = r_regionkey""",
    "manifest": """
        select concat('/nat_log/', lpad(o_orderkey, 10, '0')) path,
          cast(floor(o_totalprice) as bigint) size_mb, cast(o_orderdate as timestamp) mtime,
          o_orderkey % 10 = 0 backlog
        from {orders}""",
    "app_ranges": """
        select n_nationkey position, (100 + n_nationkey) * 16777216L lo,
          (102 + n_nationkey) * 16777216L hi, n_name app
        from {nation}""",
    "offsets": """
        select o_orderpriority groupId, o_orderstatus topic,
          cast(o_custkey % 4 as int) partitionNum, max(o_orderkey) offsets
        from {orders} group by o_orderpriority, o_orderstatus, o_custkey % 4""",
    # Ranges inside, across and around those of ``geo``; a third of them start where one of it does.
    "geo_overlaps": """
        select lo, hi, province, city, operator from {geo}
        union all
        select (100 + n_nationkey) * 16777216L + (n_nationkey % 3) * 65536L lo,
          (101 + n_nationkey) * 16777216L + 65536L * n_nationkey hi,
          concat('over_', n_name), 'over_city', 'over'
        from {nation} where n_nationkey % 2 = 0""",
    # Single addresses of one /16 cell as ranges, and events at addresses of that cell.
    "geo_dense": """
        select distinct 1677721600L + o_orderkey % 65536 lo, 1677721600L + o_orderkey % 65536 hi,
          concat('p_', o_orderkey % 65536) province, 'dense' city, concat('o_', o_orderkey % 2) operator
        from {orders}""",
    "ev_dense": """
        select concat('100.0.', event_id % 65536 div 256, '.', event_id % 256) dip, count(*) count
        from {events} group by 1""",
    # Lines of format A around a new year, without the year.
    "border_lines": """
        select event_id, timestampadd(day, -14, ts) ts, concat(
          'Msg: ', date_format(timestampadd(day, -14, ts), 'MMM d HH:mm:ss'),
          ' 2200000000000017(root) 10000001 Traffic@FLOW: NAT: ', sip, ':', sport, '->', dip, ':', dport,
          '(', proto, '), snat to ', nip, ':', nport, ', vr vr-one') value
        from {ev}""",
    "settings": "select n_nationkey performance from {nation}",
}

TABLES = {"events", "customer", "nation", "region", "orders"}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input by name; a given table or a query over others."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = SQL[name]
    needed = {n: frame(spark, sf_dir, n) for n in [*TABLES, *SQL] if "{" + n + "}" in sql}
    return spark.sql(sql, **needed)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered lines; the explode keeps filters on a line from rendering it again."""
    lines = frame(spark, sf_dir, "lines")
    return lines.select(F.explode_outer(F.array("value")).alias("value"))


def ev_sessions(
    spark: SparkSession, sf_dir: str, hourly: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """Parsed columns of ``ev``; with ``hourly`` times cut to the hour, so that row keys meet."""
    unit = "hour" if hourly else "second"
    return (
        frame(spark, sf_dir, "ev")
        .where("event_id % 20 not in (9, 19)")
        .select(
            *(keep or []),
            F.date_trunc(unit, "ts").alias("accesstime"),
            F.col("sip").alias("sourceIp"),
            F.col("sport").alias("sourcePort"),
            F.col("dip").alias("targetIp"),
            F.col("dport").alias("targetPort"),
            F.col("proto").alias("protocol"),
            F.col("nip").alias("convertedIp"),
            F.col("nport").alias("convertedPort"),
        )
    )
