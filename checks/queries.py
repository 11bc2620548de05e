"""One query per operator, each over the whole given tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeledger.functions import net, times
from edgeledger.operators import counts as C
from edgeledger.operators import lookups, parse, tops
from edgeledger.plans import daily, jobs
from edgeledger.plans import report as R
from edgeledger.schemas import GEO_FIELDS
from edgeledger.schemas import REPORT as R_SCHEMA
from edgeledger.session import scratch_path, settle
from edgeledger.sinks import sessions as session_sink
from edgeledger.sinks import tables as sink
from edgeledger.sources import accounts, admission, tables
from edgeledger.sources import days as D
from edgeledger.sources import lines as L
from edgeledger.sources import sessions as S
from edgeledger.streaming import streams

from .bindings import YEAR, ev_sessions, frame, raw_lines

BATCH = datetime(2024, 1, 15)
REPORT = R.REPORT_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def shared_folder(spark: SparkSession) -> None:
    """A session on one machine without a shared folder gets one; on a cluster it must name its own."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="edgeledger-checks-"))


def query(function):
    @wraps(function)
    def run(spark, sf):
        shared_folder(spark)
        return function(spark, sf)

    QUERIES[function.__name__] = run
    return run


def lines(spark, sf) -> DataFrame:
    return parse.clean_lines(raw_lines(spark, sf))


def flows(spark, sf) -> DataFrame:
    return parse.flows(lines(spark, sf), YEAR)


def keyed(spark, sf) -> DataFrame:
    return parse.with_row_key(flows(spark, sf))


def coarse(spark, sf) -> DataFrame:
    return parse.with_row_key(ev_sessions(spark, sf, hourly=True))


def radius(spark, sf) -> DataFrame:
    return accounts.radius_sessions(frame(spark, sf, "radius_json"))


def geo(spark, sf) -> DataFrame:
    return frame(spark, sf, "geo")


def counts(spark, sf, event_time: bool) -> DataFrame:
    entries = parse.counted(lines(spark, sf), YEAR)
    return R.dimension_counts(R.slot_entries(entries, BATCH, event_time))


# Sources


@query
def minute_scan(spark, sf):
    root = scratch_path(spark, "minutes")
    tree = frame(spark, sf, "lines").select(
        "value",
        F.lit("20240110").alias("dt"),
        F.lit("00").alias("hh"),
        F.date_format("ts", "mm").alias("mm"),
    )
    tree.write.partitionBy("dt", "hh", "mm").text(root)
    return L.read_minutes(spark, root, datetime(2024, 1, 10, 0, 30), layout=L.PARTITIONED)


@query
def mtime_scan(spark, sf):
    root = scratch_path(spark, "changed")
    raw_lines(spark, sf).write.text(f"{root}/20240110/00")
    return L.read_modified(spark, root, datetime.now() + timedelta(minutes=1))


def _admission(spark, sf):
    manifest = frame(spark, sf, "manifest").drop("mtime")
    half = manifest.agg(F.floor(F.sum("size_mb") / 2048).alias("limit_gb"))
    return admission.admit(manifest, half)


@query
def admit_files(spark, sf):
    return _admission(spark, sf)


@query
def admit_backlog(spark, sf):
    return admission.backlog(_admission(spark, sf))


@query
def quota_setting(spark, sf):
    settings = frame(spark, sf, "settings")
    one = admission.quota(settings.where("performance = 7"))
    many = admission.quota(settings)
    return one.select(F.lit("one").alias("source"), "limit_gb").union(
        many.select(F.lit("many").alias("source"), "limit_gb")
    )


@query
def clean_lines(spark, sf):
    padded = F.concat(F.lit("\t "), F.col("value"), F.lit(" \r\x00"))
    return parse.clean_lines(raw_lines(spark, sf).select(padded.alias("value")))


@query
def radius_dim(spark, sf):
    return radius(spark, sf)


@query
def account_lookup(spark, sf):
    dim = radius(spark, sf)
    found = accounts.ip_of_account(dim, "Customer#000000042")
    return found.union(accounts.ip_of_account(dim, "nobody"))


@query
def dim_sample(spark, sf):
    return accounts.sample(radius(spark, sf), "ip")


@query
def hash_partitions(spark, sf):
    bucket = tables.key_bucket("id").alias("bucket")
    return C.count_by(frame(spark, sf, "subscribers"), bucket)


@query
def tuple_scan(spark, sf):
    path = scratch_path(spark, "tuples")
    rows = frame(spark, sf, "customer").select(
        F.format_string("(%s,%s,x,%d)", "c_name", "c_mktsegment", "c_custkey")
    )
    rows.write.text(path)
    return tables.read_user_counts(spark, path)


@query
def group_offsets(spark, sf):
    return tables.group_offsets(frame(spark, sf, "offsets"), "1-URGENT")


@query
def starting_offsets(spark, sf):
    return tables.starting_offsets(frame(spark, sf, "offsets"), "1-URGENT")


def _store(spark, sf) -> DataFrame:
    path = scratch_path(spark, "store")
    sessions = jobs.sessions_of(lines(spark, sf), radius(spark, sf), YEAR)
    session_sink.upsert_sessions(sessions, path, BATCH)
    return S.read_store(spark, path)


@query
def trace_time(spark, sf):
    stored = _store(spark, sf)
    return S.trace_time(stored, "2024-01-10 00:00:00", "2024-01-10 06:00:00").drop("dt")


@query
def trace_converted_ip(spark, sf):
    return S.trace_value(_store(spark, sf), "convertedIp", "203.0.113.3").drop("dt")


@query
def trace_source_ip(spark, sf):
    return S.trace_value(_store(spark, sf), "sourceIp", "30.130.0.74").drop("dt")


@query
def trace_endpoint(spark, sf):
    return S.trace_endpoint(
        _store(spark, sf), "203.0.113.7", "10007", "2024-01-05 00:00:00", "2024-01-20 00:00:00"
    ).drop("dt")


# Sinks


@query
def report_roundtrip(spark, sf):
    path = scratch_path(spark, "report")
    report = nat_report(spark, sf)
    for at in (BATCH, BATCH + timedelta(minutes=5), BATCH):
        sink.write_batch(report, path, at)
    schema = "types string, accesstime timestamp, data string, count long, dt string, batch string"
    return spark.read.schema(schema).parquet(path).select("batch", *REPORT)


@query
def user_counts_roundtrip(spark, sf):
    path = scratch_path(spark, "user_counts")
    users = R.user_counts(counts(spark, sf, event_time=False), radius(spark, sf))
    for _ in range(2):
        sink.write_user_counts(users, path, BATCH)
    return tables.read_user_counts(spark, f"{path}/dt=20240114/*/*/*")


@query
def session_upsert(spark, sf):
    path = scratch_path(spark, "upsert")
    sessions = ev_sessions(spark, sf, hourly=True, keep=["event_type"])
    all_of = parse.with_row_key(sessions)
    errors = all_of.where("event_type = 'error'").withColumn("username", F.lit("again"))
    first = all_of.withColumn("username", F.lit("first"))
    # Both batches belong to one day of the store; the second is tried twice.
    later = BATCH - timedelta(minutes=5)
    for rows, at in [(first, later - timedelta(minutes=5)), (errors, later), (errors, later)]:
        distinct = C.distinct_sessions(rows.drop("event_type"))
        session_sink.upsert_sessions(distinct, path, at)
    day = S.newest(S.read_store(spark, path))
    return day.select("rowkey", "accesstime", "convertedIp", "convertedPort", "username")


@query
def session_cells(spark, sf):
    distinct = C.distinct_sessions(coarse(spark, sf))
    return session_sink.to_cells(distinct.withColumn("username", F.lit("UnKnown")))


@query
def region_counts(spark, sf):
    """Sessions per region of a written batch; a file that spans two regions gives no row."""
    path = scratch_path(spark, "regions")
    distinct = C.distinct_sessions(coarse(spark, sf)).withColumn("username", F.lit("u"))
    session_sink.upsert_sessions(distinct, path, BATCH)
    region = net.region_of(F.col("rowkey"), session_sink.REGIONS)
    stored = S.read_store(spark, path).select(region.alias("region"), F.input_file_name().alias("file"))
    files = stored.groupBy("file").agg(F.min("region").alias("region"), F.max("region").alias("last"), C.row_count())
    return files.where("region = last").groupBy("region").agg(F.sum("count").alias("count"))


def _coarse_counts(spark, sf, batch_time, event_time: bool) -> DataFrame:
    """The counts that a job settles, of sessions of which some share a row key."""
    source = F.col("sourceIp").alias("data")
    entries = coarse(spark, sf).select(F.lit("sourceIp").alias("types"), "accesstime", source)
    return R.dimension_counts(R.slot_entries(entries, batch_time, event_time))


def _slot_counters(spark, sf, batch_time) -> DataFrame:
    stored = C.distinct_sessions(coarse(spark, sf))
    return jobs.slot_counters(_coarse_counts(spark, sf, batch_time, True), stored, batch_time)


@query
def batch_counters(spark, sf):
    stored = C.distinct_sessions(coarse(spark, sf))
    return jobs.batch_counters(_coarse_counts(spark, sf, BATCH, False), stored, BATCH)


# Parser


@query
def host_lines(spark, sf):
    return parse.host_lines(lines(spark, sf))


@query
def msg_lines(spark, sf):
    return parse.msg_lines(lines(spark, sf))


@query
def format_counts(spark, sf):
    messages = parse.msg_lines(lines(spark, sf))
    kind = F.when(parse.is_dated(F.col("value")), "B").otherwise("A")
    return C.count_by(messages, kind.alias("format"))


def _sessions_in(spark, sf, kind: str) -> DataFrame:
    return parse.sessions_in(lines(spark, sf), YEAR, kind)


@query
def parse_a(spark, sf):
    return _sessions_in(spark, sf, "A")


@query
def parse_b(spark, sf):
    return _sessions_in(spark, sf, "B")


@query
def parse_border(spark, sf):
    """Times without a year around a new year, each put nearest to the batch."""
    border = parse.clean_lines(frame(spark, sf, "border_lines").select("event_id", "value"))
    return parse.flows(border, times.moment("2024-01-01 00:00:00")).select("event_id", "accesstime")


@query
def parse_partial(spark, sf):
    """Format B lines with item ``event_id % 9`` damaged."""
    item = F.col("event_id") % 9
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    pairs = [
        F.when(item == 1, "proto").otherwise(F.concat(F.lit("proto="), "proto")),
        F.when(item == 2, "sip=").otherwise(F.concat(F.lit("sip="), "sip")),
        F.when(item == 3, "dip=").otherwise(F.concat(F.lit("dip="), "dip")),
        F.when(item == 4, "sport=").when(item == 8, "sport==9").otherwise(
            F.concat(F.lit("sport="), "sport")
        ),
        F.when(item == 5, "dport").otherwise(F.concat(F.lit("dport="), "dport", F.lit("=x"))),
        F.when(item == 6, "nip==").otherwise(F.concat(F.lit("nip="), "nip")),
        F.when(item == 7, F.lit(None)).otherwise(F.concat(F.lit("nport="), "nport")),
    ]
    value = F.concat(F.lit("Msg: "), text, F.lit(" fw1 nat=1,"), F.concat_ws(",", *pairs))
    return parse.flows(frame(spark, sf, "ev").select("event_id", value.alias("value")), YEAR)


QUERIES["flows"] = flows


@query
def rejects(spark, sf):
    return parse.rejects(lines(spark, sf), YEAR)


@query
def rowkeys(spark, sf):
    with_id = parse.clean_lines(frame(spark, sf, "lines").drop("ts"))
    return parse.with_row_key(parse.flows(with_id, YEAR)).select("event_id", "rowkey")


@query
def secondary_index(spark, sf):
    return parse.secondary_index(keyed(spark, sf))


@query
def geo_fields(spark, sf):
    texts = frame(spark, sf, "geo_text")
    fields = net.geo_fields(F.col("text"))
    return texts.withColumns(fields).select("n_nationkey", *GEO_FIELDS)


# Joins


@query
def flows_with_account(spark, sf):
    return lookups.with_account(flows(spark, sf), radius(spark, sf))


@query
def geo_join(spark, sf):
    targets = frame(spark, sf, "ev").select("dip").distinct()
    return lookups.with_region(targets, "dip", geo(spark, sf))


@query
def geo_overlaps(spark, sf):
    """Places where ranges overlap: of those that start at or before an address the last one counts."""
    targets = frame(spark, sf, "ev").select("dip").distinct()
    return lookups.with_region(targets, "dip", frame(spark, sf, "geo_overlaps"))


@query
def geo_dense(spark, sf):
    """Places in a table with a range for each address: one cell holds all ranges and all addresses."""
    return lookups.with_region(frame(spark, sf, "ev_dense"), "dip", frame(spark, sf, "geo_dense"))


@query
def liveness(spark, sf):
    users = R.user_counts(counts(spark, sf, event_time=False), radius(spark, sf))
    return daily.liveness(frame(spark, sf, "subscribers"), users, "2024-01-14 00:00:00")


@query
def app_lookup(spark, sf):
    return lookups.app_names(frame(spark, sf, "ev"), "dip", frame(spark, sf, "app_ranges"))


# Counts


@query
def salted_count(spark, sf):
    return C.salted_count(flows(spark, sf), "targetIp")


@query
def host_report(spark, sf):
    hosts = C.count_by(parse.hosts(lines(spark, sf)), "host")
    at = sink.batch_slot(BATCH)
    return R.report_rows(hosts.withColumn("accesstime", at), "hostIP", "host")


@query
def target_detail(spark, sf):
    targets = C.count_slots(flows(spark, sf), "targetIp")
    return lookups.with_region(targets, "targetIp", geo(spark, sf))


@query
def geo_rollup(spark, sf):
    return C.roll_up(target_detail(spark, sf))


def _region_report(spark, sf, name: str) -> DataFrame:
    targets = R.target_detail(counts(spark, sf, event_time=False), geo(spark, sf))
    summed = targets.groupBy("accesstime", name).agg(F.sum("count").alias("count"))
    return R.report_rows(summed, name, name)


@query
def province_report(spark, sf):
    return _region_report(spark, sf, "province")


@query
def operator_report(spark, sf):
    return _region_report(spark, sf, "operator")


@query
def city_report(spark, sf):
    return _region_report(spark, sf, "city")


@query
def user_counts(spark, sf):
    return C.accounts_of_sources(source_counts(spark, sf), radius(spark, sf))


@query
def source_counts(spark, sf):
    return C.count_slots(flows(spark, sf), "sourceIp")


@query
def dedup_sessions(spark, sf):
    return C.distinct_sessions(coarse(spark, sf))


@query
def window_counters(spark, sf):
    return _slot_counters(spark, sf, BATCH)


@query
def late_windows(spark, sf):
    return C.late_windows(coarse(spark, sf), BATCH)


@query
def daily_user_sum(spark, sf):
    return C.daily_sum(user_counts(spark, sf))


@query
def daily_totals(spark, sf):
    counters = _slot_counters(spark, sf, datetime(2024, 1, 1, 3))
    return C.daily_totals(counters, "2024-01-10 00:00:00", "2024-01-11 00:00:00")


@query
def top_targets(spark, sf):
    first = tops.top(C.count_slots(flows(spark, sf), "targetIp"), "targetIp")
    return R.report_rows(first, "targetIp", "targetIp")


@query
def top_users(spark, sf):
    first = tops.top(user_counts(spark, sf), "username")
    return R.report_rows(first, "username", "username")


@query
def top_sources(spark, sf):
    first = tops.top(source_counts(spark, sf), "sourceIp")
    return R.report_rows(first, "sourceIp", "sourceIp")


@query
def top_target_detail(spark, sf):
    targets = R.of_kind(counts(spark, sf, event_time=False), "targetIp", "targetIp")
    report = R.report_rows(targets, "targetIp", "targetIp")
    return daily.target_places(report, geo(spark, sf), "2024-01-14 23:55:00")


# Reports


@query
def nat_report(spark, sf):
    return R.nat_report(lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, YEAR)


@query
def delay_report(spark, sf):
    return R.nat_report(
        lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, YEAR, event_time=True
    )


@query
def backfill(spark, sf):
    arrived = frame(spark, sf, "lines").select(F.col("ts").alias("arrival"), "value")
    return R.backfill(
        parse.clean_lines(arrived), geo(spark, sf), radius(spark, sf),
        datetime(2024, 1, 1), datetime(2024, 2, 1), YEAR,
    )


@query
def consolidate(spark, sf):
    """Partial rows of one report per protocol and port, added up."""
    partial = C.count_slots(flows(spark, sf), "targetIp", "protocol", "targetPort")
    return C.consolidate(R.report_rows(partial, "targetIp", "targetIp"))


# Scalar functions


@query
def ip_to_long(spark, sf):
    five = F.concat("dip", F.lit(".1"))
    return frame(spark, sf, "ev").select(
        "event_id",
        net.ip_to_long(F.col("dip")).alias("target"),
        net.ip_to_long(F.col("sip")).alias("source"),
        net.ip_to_long(five).alias("longer"),
    )


@query
def five_minute_counts(spark, sf):
    return C.count_by(frame(spark, sf, "ev"), times.slot(F.col("ts")).alias("accesstime"))


@query
def task_buckets(spark, sf):
    buckets = times.task_buckets(F.col("ts"))
    return frame(spark, sf, "ev").select(
        "event_id", *[column.alias(name) for name, column in buckets.items()]
    )


@query
def iso_floor(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+08:00'")
    return frame(spark, sf, "ev").select("event_id", times.iso_slot(text).alias("slot"))


@query
def format_time(spark, sf):
    millis = F.unix_millis("ts")
    return frame(spark, sf, "ev").select(
        "event_id",
        times.format_millis(millis, "yyyyMMdd/HH/mm").alias("folder"),
        times.format_millis(millis, "yyyy-MM-dd HH:mm:ss").alias("second"),
    )


@query
def hour_fill(spark, sf):
    """Events per hour and type; an early wrong value of each hour is overridden."""
    hourly = C.count_by(frame(spark, sf, "ev"), "event_type", F.hour("ts").alias("h"))
    rows = hourly.select(
        "event_type",
        F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"),
        F.explode(F.array(
            F.struct(F.lit(1).alias("position"), F.lit("-1").alias("value")),
            F.struct(F.lit(2).alias("position"), F.col("count").cast("string").alias("value")),
        )).alias("v"),
    )
    return C.hour_fill(rows.select("event_type", "hour", "v.*"), "event_type")


# Streams


def _finish(running) -> None:
    running.awaitTermination()


@query
def stream_report(spark, sf):
    root, out = scratch_path(spark, "arriving"), scratch_path(spark, "stream")
    raw_lines(spark, sf).write.text(f"{root}/20240110/00/05")
    _finish(
        streams.report_stream(
            L.stream_lines(spark, f"{root}/*/*/*"),
            lambda: (geo(spark, sf), radius(spark, sf)),
            out, f"{out}/checkpoint", trigger=streams.ONCE, year=YEAR,
        )
    )
    # Host rows carry the time of the run.
    report = C.consolidate(spark.read.parquet(f"{out}/report"))
    fixed = F.when(F.col("types") == "hostIP", times.moment("1970-01-01 00:00:00"))
    return report.withColumn("accesstime", fixed.otherwise(F.col("accesstime")))


def _event_stream(spark, path: str, schema, **options) -> DataFrame:
    stream = spark.readStream.schema(schema).options(**options).parquet(path)
    return stream.withColumn("accesstime", F.col("ts").cast("timestamp"))


@query
def stream_windows(spark, sf):
    out = scratch_path(spark, "windows")
    schema = frame(spark, sf, "events").schema
    events = _event_stream(spark, f"{sf}/events.parquet*", schema)
    counted = streams.slot_counts(events, "event_type")
    _finish(
        streams.write_stream(counted, f"{out}/table", f"{out}/checkpoint", "update", streams.ONCE)
    )
    return streams.read_updates(spark, f"{out}/table", ["accesstime", "event_type"])


@query
def stream_late(spark, sf):
    """Errors of the first ten days come after the twentieth, too late to be counted."""
    root, out = scratch_path(spark, "chunks"), scratch_path(spark, "late")
    events = frame(spark, sf, "events")
    day, early = F.dayofmonth("ts"), F.dayofmonth("ts") <= 10
    held = early & (F.col("event_type") == "error")
    chunks = [early & ~held, (day > 10) & (day <= 20), (day > 20) | held]
    for number, chunk in enumerate(chunks):
        events.where(chunk).write.parquet(f"{root}/chunk{number}")
        counted = streams.slot_counts(_event_stream(spark, f"{root}/*", events.schema))
        _finish(
            streams.write_stream(
                counted, f"{out}/table", f"{out}/checkpoint", "update", streams.ONCE
            )
        )
    return streams.read_updates(spark, f"{out}/table", ["accesstime"])


@query
def stream_dedup(spark, sf):
    root, out = scratch_path(spark, "sessions"), scratch_path(spark, "dedup")
    sessions = coarse(spark, sf)
    # Two micro-batches; half of the sessions come in both.
    for part in (sessions, sessions.where(F.crc32("rowkey") % 2 == 0)):
        part.write.mode("append").parquet(root)
        arriving = spark.readStream.schema(sessions.schema).parquet(root)
        _finish(
            streams.write_stream(
                streams.distinct_stream(arriving), f"{out}/table", f"{out}/checkpoint",
                trigger=streams.ONCE,
            )
        )
    table = spark.read.parquet(f"{out}/table")
    return table.select("rowkey", "accesstime", "convertedIp", "convertedPort")


@query
def stream_quota(spark, sf):
    """Six files within a quota of a third of their bytes: all sessions come, in several micro-batches."""
    root, out = scratch_path(spark, "quota"), scratch_path(spark, "split")
    raw_lines(spark, sf).repartition(6).write.text(f"{root}/20240110/00/05")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    third = files.agg(F.sum("length")).first()[0] // 3
    arriving = L.stream_lines(spark, f"{root}/*/*/*", maxBytesPerTrigger=third)
    sessions = parse.flows(parse.clean_lines(arriving), YEAR)
    _finish(streams.write_stream(sessions, f"{out}/table", f"{out}/checkpoint", trigger=streams.ONCE))
    carried = streams.carry_over(files, streams.taken_files(spark, f"{out}/checkpoint"))
    ends = carried.agg(
        (F.count("*") >= 3).cast("long").alias("split"), (F.max("files_left") > F.min("files_left")).cast("long").alias("carried"),
        F.sum("files").alias("files"), F.min("bytes_left").alias("bytes_left"),
    )
    stored = spark.read.parquet(f"{out}/table")
    counted = C.count_by(stored, "protocol").withColumnRenamed("protocol", "name")
    return counted.unionByName(ends.unpivot([], ends.columns, "name", "count"))


# Jobs


@query
def batch_job(spark, sf):
    """All tables of one batch, run twice, with cells."""
    out = scratch_path(spark, "batch")
    for _ in range(2):
        jobs.run_batch(
            raw_lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, out,
            year=YEAR, as_cells=True,
        )
    written = jobs.Tables(out)
    report = spark.read.parquet(written.report)
    counters = spark.read.parquet(written.counters)
    cells = C.count_by(spark.read.parquet(written.cells), "qualifier")
    frames = [
        report.select(F.col("types").alias("name"), "data", "accesstime", "count"),
        counters.select(
            F.lit("counter").alias("name"), F.col("counter").alias("data"), "accesstime",
            F.col("count_5min").alias("count"),
        ),
        cells.select(
            F.lit("cells").alias("name"), F.col("qualifier").alias("data"),
            sink.batch_slot(BATCH).alias("accesstime"), "count",
        ),
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def rerun_job(spark, sf):
    """A batch, run again with fewer lines and then a second batch with none: what is left."""
    out, fewer = scratch_path(spark, "rerun"), frame(spark, sf, "lines").where("event_id % 20 = 0")
    later = BATCH + timedelta(minutes=5)
    none = raw_lines(spark, sf).limit(0)
    for lines_, at in ((raw_lines(spark, sf), BATCH), (fewer.select("value"), BATCH),
                       (raw_lines(spark, sf), later), (none, later)):
        jobs.run_batch(lines_, geo(spark, sf), radius(spark, sf), at, out, year=YEAR)
    written = jobs.Tables(out)
    frames = [
        spark.read.parquet(written.report).select(F.col("types").alias("name"), "data", "count"),
        spark.read.parquet(written.counters).select(
            F.lit("counter").alias("name"), F.concat_ws(" ", "counter", "accesstime").alias("data"),
            F.col("count_5min").alias("count"),
        ),
        spark.read.parquet(written.sessions).select(
            F.lit("sessions").alias("name"), F.lit("").alias("data"), F.lit(1).alias("count"),
        ).groupBy("name", "data").agg(F.sum("count").alias("count")),
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def backfill_job(spark, sf):
    """All batches of a range written twice; the report of every batch as it is stored."""
    out = scratch_path(spark, "backfill")
    arrived = frame(spark, sf, "lines").select(F.col("ts").alias("arrival"), "value")
    for _ in range(2):
        jobs.run_backfill(
            arrived, geo(spark, sf), radius(spark, sf), datetime(2024, 1, 1), datetime(2024, 2, 1), out,
            year=YEAR,
        )
    report = tables.read_batches(spark, jobs.Tables(out).report, R_SCHEMA)
    start = F.unix_timestamp(F.to_timestamp("batch", sink.BATCH))
    at = F.timestamp_seconds(start + times.SLOT_SECONDS)
    return report.select(at.alias("batch"), *REPORT)


@query
def rejects_table(spark, sf):
    """Lines that gave no session, as the batch job stores them."""
    out = scratch_path(spark, "rejected")
    jobs.run_batch(raw_lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, out, year=YEAR)
    return spark.read.parquet(jobs.Tables(out).rejects).select("value", "format", "reason")


@query
def target_places_job(spark, sf):
    """Places of the main targets of a slot, from the stored report."""
    out = scratch_path(spark, "places")
    jobs.run_batch(raw_lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, out, year=YEAR)
    daily.run_target_places(spark, out, geo(spark, sf), "2024-01-14 23:55:00", out)
    return spark.read.parquet(f"{out}/ip_detail")


@query
def session_compacted(spark, sf):
    """Sessions per protocol of a folded day, beside one that is not folded, both written twice."""
    path, whole = scratch_path(spark, "store"), scratch_path(spark, "days")
    sessions = jobs.sessions_of(lines(spark, sf), radius(spark, sf), YEAR)
    for at in (BATCH, BATCH - timedelta(minutes=5), BATCH + timedelta(days=1)):
        session_sink.upsert_sessions(sessions, path, at)
    for _ in range(2):
        session_sink.compact_day(spark, path, whole, "20240114")
    return C.count_by(S.newest(D.read_days(spark, path, whole)), "dt", "protocol")


def _folded(spark, sf) -> D.Days:
    """A folded day of all sessions, to which a second batch came, and one that isn't folded."""
    path, whole = scratch_path(spark, "store"), scratch_path(spark, "days")
    sessions = jobs.sessions_of(lines(spark, sf), radius(spark, sf), YEAR)
    late = F.second("accesstime") % 3 == 0
    session_sink.upsert_sessions(sessions.where(~late), path, BATCH - timedelta(minutes=5))
    session_sink.compact_day(spark, path, whole, "20240114")
    session_sink.upsert_sessions(sessions.where(late), path, BATCH)
    session_sink.upsert_sessions(sessions.where(late).withColumn("username", F.lit("next day")), path, BATCH + timedelta(minutes=5))
    return D.Days.open(spark, path, whole)


@query
def trace_indexed(spark, sf):
    """Sessions of a source address by the index, of a day folded twice and of one that isn't folded."""
    days = _folded(spark, sf)
    session_sink.compact_day(spark, days.store, days.folded, "20240114")
    again = D.Days.open(spark, days.store, days.folded)
    return again.trace_value("sourceIp", "30.130.0.74", n=100_000)


@query
def trace_endpoints_indexed(spark, sf):
    """Sessions between two outer endpoints by the index, with a batch that came after the day was folded."""
    return _folded(spark, sf).trace_value("endpoints", ("101.1.7.9", "443", "203.0.113.3", "10013"), n=100_000)


@query
def trace_hours(spark, sf):
    """Sessions of six hours from the layout by time, and from batches that aren't folded."""
    return _folded(spark, sf).trace_time("2024-01-14 00:00:00", "2024-01-14 06:00:00", n=100_000)


@query
def trace_pages(spark, sf):
    """Pages of 1000 of half a month, each begun where the one before ended, put together."""
    days, span = _folded(spark, sf), ("2024-01-01 00:00:00", "2024-01-16 00:00:00")
    first = settle(days.trace_time(*span, 1000))
    after = S.cursor_of(first)
    if first.count() < 1000:
        return first
    return first.unionByName(days.trace_pages(*span, 1000, after).drop("page"))


@query
def fold_increments(spark, sf):
    """A day folded, a late batch, and the day folded again: its rows by key, by time and in the index."""
    days = _folded(spark, sf)
    session_sink.compact_day(spark, days.store, days.folded, "20240114")
    again = D.Days.open(spark, days.store, days.folded, ["20240114"])
    rows = S.newest(again.by_key())
    timed = S.newest(again.by_time("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    index = spark.read.parquet(f"{days.folded}/{D.INDEX_FOLDER}/dt=20240114")
    frames = [
        C.count_by(rows, "protocol").select(F.lit("by key").alias("layout"), F.col("protocol").alias("name"), "count"),
        C.count_by(timed, "protocol").select(F.lit("by time").alias("layout"), F.col("protocol").alias("name"), "count"),
        C.count_by(index, "column").select(F.lit("index").alias("layout"), F.col("column").alias("name"), "count"),
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def delayed_job(spark, sf):
    """Files by change time and quota, then all tables of the event-time batch."""
    root, out = scratch_path(spark, "files"), scratch_path(spark, "delayed")
    raw_lines(spark, sf).write.text(f"{root}/00/05")
    backlog = L.list_files(spark, root).select("path", "size_mb", "mtime", F.lit(True).alias("backlog"))
    settings = frame(spark, sf, "settings")
    jobs.run_delayed(
        spark, root, backlog, settings, geo(spark, sf), radius(spark, sf), BATCH, out, year=YEAR
    )
    written = jobs.Tables(out)
    report = spark.read.parquet(written.report)
    counters = spark.read.parquet(written.counters)
    return report.select(F.col("types").alias("name"), "data", "accesstime", "count").unionByName(
        counters.select(
            F.lit("counter").alias("name"), F.col("counter").alias("data"),
            F.col("update_time").alias("accesstime"), F.col("count_5min").alias("count"),
        )
    )


@query
def daily_job(spark, sf):
    """Activity and totals of the day of one batch."""
    batches, out = scratch_path(spark, "batches"), scratch_path(spark, "day")
    day = datetime(2024, 1, 14)
    jobs.run_batch(
        raw_lines(spark, sf), geo(spark, sf), radius(spark, sf), BATCH, batches, year=YEAR
    )
    daily.run_day(spark, batches, frame(spark, sf, "subscribers"), day, out)
    activity = spark.read.parquet(f"{out}/liveness")
    totals = spark.read.parquet(f"{out}/count_day")
    return activity.select(F.col("username").alias("name"), F.col("resolver").alias("count")).union(
        totals.select("counter", "count_day")
    )
