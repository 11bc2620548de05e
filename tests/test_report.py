"""Plans of the report, and its forms against each other."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.bindings import YEAR, frame
from checks.queries import BATCH, geo, lines, radius
from edgeledger.operators import parse
from edgeledger.plans import daily, jobs
from edgeledger.plans import report as R
from edgeledger.schemas import COUNTERS, FLOWS, REPORT
from edgeledger.sources import lines as L
from edgeledger.sources.sessions import read_store, trace_endpoint, trace_time
from edgeledger.sources.tables import read_batches, read_user_counts

from conftest import executed_plan

SF = "/root/testdata/sf0.001"


def written(spark, name, rows):
    path = str(name)
    rows.write.text(path)
    return spark.read.text(path)


@pytest.mark.parametrize("event_time", [False, True])
def test_lines_are_scanned_once(spark, tmp_path, event_time):
    text = written(spark, tmp_path / "lines", lines(spark, SF))
    report = R.nat_report(text, geo(spark, SF), radius(spark, SF), BATCH, YEAR, event_time)
    plan = executed_plan(report)
    assert plan.count("FileScan text") == 1
    assert plan.count("TakeOrderedAndProject") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_backfill_is_the_union_of_its_batches(spark, rows):
    arrived = parse.clean_lines(
        frame(spark, SF, "lines").select(F.col("ts").alias("arrival"), "value")
    )
    start, end = datetime(2024, 1, 2, 0, 0), datetime(2024, 1, 9, 0, 0)
    whole = R.backfill(arrived, geo(spark, SF), radius(spark, SF), start, end, YEAR)
    assert executed_plan(whole).count("NestedLoop") == 0
    some = whole.select("batch").distinct().orderBy("batch").limit(2).collect()
    assert some
    for (batch,) in some:
        end_of = F.lit(batch).cast("timestamp")
        inside = (F.col("arrival") < end_of) & (
            F.col("arrival") >= end_of - F.expr("interval 5 minutes")
        )
        one = R.nat_report(
            arrived.where(inside).drop("arrival"), geo(spark, SF), radius(spark, SF), batch, YEAR,
            event_time=True,
        )
        mine = whole.where(F.col("batch") == end_of).select(*one.columns)
        assert rows(mine) == rows(one)


def test_run_minutes_reads_its_folders_only(spark, rows, tmp_path):
    batch = datetime(2024, 1, 10, 0, 5)
    line = "Msg: 2024-01-10 00:0{}:00 fw n=1,p=TCP,s=30.128.0.{},d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np={}"
    for minute in range(7):
        folder = tmp_path / "in" / f"20240110/00/{minute:02d}"
        folder.mkdir(parents=True)
        (folder / "log").write_text(line.format(minute, minute, minute) + "\n")
    out = str(tmp_path / "out")
    jobs.run_minutes(spark, str(tmp_path / "in"), geo(spark, SF), radius(spark, SF), batch, out)
    report = spark.read.parquet(jobs.Tables(out).report)
    sources = report.where("types = 'sourceIp'")
    assert rows(sources, "data", "count") == [(f"30.128.0.{i}", 1) for i in range(5)]
    stored = jobs.stored_batch(spark, jobs.Tables(out).sessions, batch)
    assert stored.count() == 5
    counters = spark.read.parquet(jobs.Tables(out).counters)
    assert rows(counters, "counter", "count_5min") == [("nat_count", 5), ("nat_hbase_count", 5)]


def test_empty_batch_writes_zero_counters(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    none = L.read_paths(spark, [])
    jobs.run_batch(none, geo(spark, SF), radius(spark, SF), BATCH, out)
    counters = spark.read.parquet(jobs.Tables(out).counters)
    assert rows(counters, "counter", "count_5min") == [("nat_count", 0), ("nat_hbase_count", 0)]


def test_delayed_job_carries_its_backlog(spark, rows, tmp_path):
    """A zero quota still admits files until a whole GB is above it; the rest waits."""
    root = tmp_path / "in"
    root.mkdir()
    line = "Msg: 2024-01-10 00:01:00 fw n=1,p=TCP,s=30.128.0.1,d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np=1"
    (root / "log").write_text(line + "\n")
    changed = (root / "log").stat().st_mtime
    batch = datetime.fromtimestamp(changed // 300 * 300 + 300)
    kept = tmp_path / "kept"
    kept.mkdir()
    for name in ("a", "b"):
        (kept / name).write_text("x\n")
    stored = [(str(kept / name), 1, batch, True) for name in ("a", "b", "gone")]
    backlog = spark.createDataFrame(stored, "path string, size_mb long, mtime timestamp, backlog boolean")
    settings = spark.createDataFrame([(-1,)], "performance int")
    out = str(tmp_path / "out")
    left = jobs.run_delayed(
        spark, str(root), backlog, settings, geo(spark, SF), radius(spark, SF), batch, out
    )
    assert sorted(r.path.split("/")[-1] for r in left.collect()) == ["a", "b", "log"]
    assert rows(spark.read.parquet(jobs.Tables(out).vanished), "path") == [(str(kept / "gone"),)]
    taken = jobs.run_delayed(
        spark, str(root), backlog.where("false"), settings.where("false"), geo(spark, SF),
        radius(spark, SF), batch, out, year=2024,
    )
    assert taken.count() == 0
    stored = jobs.stored_batch(spark, jobs.Tables(out).sessions, batch)
    assert rows(stored, "sourceIp") == [("30.128.0.1",)]


def test_backfill_job_equals_single_batches(spark, rows, tmp_path):
    arrived = frame(spark, SF, "lines").select(F.col("ts").alias("arrival"), "value")
    start, end = datetime(2024, 1, 2, 0, 5), datetime(2024, 1, 2, 3, 0)
    whole, single = str(tmp_path / "whole"), str(tmp_path / "single")
    for _ in range(2):
        jobs.run_backfill(arrived, geo(spark, SF), radius(spark, SF), start, end, whole, YEAR)
    inside = R.batched(parse.clean_lines(arrived), start, end)
    batches = sorted(r.batch for r in inside.select("batch").distinct().collect())
    assert len(batches) > 2 and batches[0] >= start and batches[-1] <= end
    for at in batches:
        lines_of = inside.where(F.col("batch") == F.lit(at)).select("value")
        jobs.run_batch(
            lines_of, geo(spark, SF), radius(spark, SF), at, single, YEAR, event_time=True
        )
    same_tables(spark, rows, single, whole)

    # One of the batches again, now without lines, and the rest of the range as it was.
    none = inside.limit(0).select("value")
    for out in (single, whole):
        jobs.run_batch(none, geo(spark, SF), radius(spark, SF), batches[1], out, YEAR, event_time=True)
    same_tables(spark, rows, single, whole)
    left = read_batches(spark, jobs.Tables(whole).report, REPORT).select("batch").distinct().count()
    assert left == len(batches) - 1

    # A range that takes the first half of the one before.
    middle = start + (end - start) / 2
    jobs.run_backfill(arrived.limit(0), geo(spark, SF), radius(spark, SF), start, middle, whole, YEAR)
    later = sum(at > middle for at in batches if at != batches[1])
    for name, schema in (("report", REPORT), ("sessions", FLOWS)):
        kept = read_batches(spark, getattr(jobs.Tables(whole), name), schema)
        assert kept.select("batch").distinct().count() == later, name


def same_tables(spark, rows, single, whole):
    for name, schema in (("report", REPORT), ("counters", COUNTERS), ("sessions", FLOWS)):
        one, many = (read_batches(spark, getattr(jobs.Tables(root), name), schema) for root in (single, whole))
        assert rows(many) == rows(one), name
    one, many = (read_user_counts(spark, f"{jobs.Tables(root).user_counts}/*/*/*/*") for root in (single, whole))
    assert rows(many) == rows(one)


def test_calls_of_a_backfill_grow_with_days(spark, tmp_path, monkeypatch):
    """Clearing lists and deletes days, not batches, whatever was written there."""
    from edgeledger.sinks import tables as sink

    calls = []
    for name in ("matching", "remove", "move"):
        whole = getattr(sink, name)
        monkeypatch.setattr(sink, name, lambda *a, whole=whole: calls.append(a) or whole(*a))
    start, path = datetime(2024, 1, 1), str(tmp_path / "t")
    batches = spark.range(0, 288 * 6).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,5*id) batch", "id")
    for days in (2, 6):
        end = start + timedelta(days=days) - timedelta(minutes=5)
        sink.add_range(batches.where(F.col("batch") <= F.lit(end)), path, start, end)
        calls.clear()
        sink.clear_batches(spark, path, start, end)
        assert len(calls) <= 2 * (days + 1) + 1
        assert spark.createDataFrame([], "a int").count() == 0 and not list((tmp_path / "t").glob("dt=*"))


def test_a_cleared_range_leaves_its_neighbours(spark, rows, tmp_path):
    from edgeledger.sinks import tables as sink

    start, path = datetime(2024, 1, 1, 0, 5), str(tmp_path / "t")
    batches = spark.range(0, 600).selectExpr("timestamp'2024-01-01 00:05:00' + make_interval(0,0,0,0,0,5*id) batch", "id")
    sink.add_range(batches, path, start, start + timedelta(minutes=5 * 599))
    one = spark.createDataFrame([(-1,)], "id long")
    sink.write_batch(one, path, start + timedelta(minutes=50))
    sink.write_batch(one, path, start + timedelta(minutes=55), number=3)
    sink.clear_batches(spark, path, start + timedelta(minutes=100), start + timedelta(minutes=5 * 500))
    got = rows(read_batches(spark, path, T.StructType([T.StructField("id", T.LongType())])), "id", "batch")
    label = lambda k: f"{start - timedelta(minutes=5) + timedelta(minutes=5 * k):%Y%m%d%H%M}"
    wanted = [(k, label(k)) for k in [*range(20), *range(501, 600)] if k != 10] + [(-1, label(10)), (-1, label(11) + "-000000003")]
    assert got == sorted(wanted, key=repr)


def test_second_run_replaces_the_first(spark, rows, tmp_path):
    """With fewer lines, and with none, all tables are those of the second run alone."""
    line = "Msg: 2024-01-10 00:0{}:00 fw n=1,p=TCP,s=30.128.0.{},d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np={}"
    lines_ = [line.format(i, i, i) for i in range(4)] + ["Msg: bad"]
    frame_ = lambda texts: spark.createDataFrame([(t,) for t in texts], "value string")
    tables = ("report", "counters", "sessions", "cells", "rejects")
    for second in (lines_[:1], []):
        twice, alone = (str(tmp_path / f"{name}{len(second)}") for name in ("twice", "alone"))
        for out, runs in ((twice, (lines_, second)), (alone, (second,))):
            for texts in runs:
                jobs.run_batch(frame_(texts), geo(spark, SF), radius(spark, SF), BATCH, out, as_cells=True)
        for name in tables:
            one, two = (spark.read.parquet(getattr(jobs.Tables(out), name)) for out in (alone, twice))
            assert rows(two) == rows(one), name
        one, two = (read_user_counts(spark, f"{jobs.Tables(out).user_counts}/*/*/*/*") for out in (alone, twice))
        assert rows(two) == rows(one)


def test_second_backfill_empties_batches(spark, tmp_path):
    arrived = frame(spark, SF, "lines").select(F.col("ts").alias("arrival"), "value")
    start, end, out = datetime(2024, 1, 2, 0, 5), datetime(2024, 1, 2, 3, 0), str(tmp_path / "out")
    for rows_ in (arrived, arrived.limit(0)):
        jobs.run_backfill(rows_, geo(spark, SF), radius(spark, SF), start, end, out, YEAR)
    tables = jobs.Tables(out)
    assert L.load_or_nothing(spark.read.schema(REPORT), tables.report, REPORT).count() == 0
    assert read_store(spark, tables.sessions).count() == 0


def test_a_job_reads_its_lines_once(spark, tmp_path):
    """Lines give other rows each time they are read; all tables agree only if they come from one reading."""
    text = "Msg: 2024-01-10 00:01:00 fw n=1,p=TCP,s=30.128.0.1,d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np="
    drawn = spark.range(4000).select(F.concat(F.lit(text), F.col("id"), F.lit("-"), F.expr("uuid()")).alias("value"))
    lines_ = drawn.where(F.expr("rand() < 0.5 or value is null"))
    out = str(tmp_path / "out")
    jobs.run_batch(lines_, geo(spark, SF), radius(spark, SF), BATCH, out, YEAR, as_cells=True)
    tables = jobs.Tables(out)
    found = {r.count_5min for r in spark.read.parquet(tables.counters).collect()}
    stored = spark.read.parquet(tables.sessions).count()
    assert found == {stored} and 1000 < stored < 3000
    report = spark.read.parquet(tables.report).where("types in ('targetIp', 'sourceIp', 'province')")
    assert [r["count"] for r in report.collect()] == [stored] * 3
    assert spark.read.parquet(tables.cells).count() == 9 * stored


def test_lines_of_december_in_a_batch_of_january(spark, rows, tmp_path):
    text = "Msg: Dec 31 23:56:00 1(r) 2 T@F: NAT: 1.1.1.1:1->101.0.7.9:2(UDP), snat to 9.9.9.9:3, vr x"
    lines_ = spark.createDataFrame([(text,)], "value string")
    out, batch = str(tmp_path / "out"), datetime(2025, 1, 1)
    jobs.run_batch(lines_, geo(spark, SF), radius(spark, SF), batch, out, event_time=True)
    stored = jobs.stored_batch(spark, jobs.Tables(out).sessions, batch)
    assert rows(stored, "accesstime") == [(datetime(2024, 12, 31, 23, 56),)]


def test_daily_readers_are_pruned(spark, tmp_path):
    """The day job and traces list only the days that can hold what they look for."""
    from conftest import executed_plan

    out = str(tmp_path / "out")
    jobs.run_batch(lines(spark, SF), geo(spark, SF), radius(spark, SF), BATCH, out, YEAR)
    tables = jobs.Tables(out)
    stored = read_store(spark, tables.sessions)
    for found in (trace_time(stored, "2024-01-10 00:00:00", "2024-01-11 00:00:00"),
                  trace_endpoint(stored, "203.0.113.7", "10007", "2024-01-05 00:00:00", "2024-01-20 00:00:00")):
        assert "(dt" in executed_plan(found).split("PartitionFilters: [")[1].split("]")[0]
    people = frame(spark, SF, "subscribers")
    daily.run_day(spark, out, people, datetime(2024, 3, 1), out)
    activity = spark.read.parquet(f"{out}/liveness")
    assert activity.count() == people.count() and activity.where("resolver > 0").count() == 0


def test_target_places_job(spark, rows, tmp_path):
    batches, out = str(tmp_path / "batches"), str(tmp_path / "out")
    jobs.run_batch(lines(spark, SF), geo(spark, SF), radius(spark, SF), BATCH, batches, YEAR)
    at = datetime(2024, 1, 14, 23, 55)
    for _ in range(2):
        daily.run_target_places(spark, batches, geo(spark, SF), at, out)
    found = spark.read.parquet(f"{out}/ip_detail")
    assert found.columns == ["ip", "province", "city", "operator"] and found.count() == 100
