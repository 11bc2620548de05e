"""Writers leave one copy after a retry; the store gives the newest row of a key."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from edgeledger.functions.net import row_key
from edgeledger.schemas import CELL_NAMES, FLOWS
from edgeledger.sinks import sessions as store
from edgeledger.sinks import tables as sink
from edgeledger.sources import days as D
from edgeledger.sources import sessions as S
from edgeledger.sources.tables import read_user_counts

from conftest import executed_plan

BATCH = datetime(2024, 1, 10, 12, 5)


def flows(spark, names):
    rows = [
        (BATCH, "1.1.1.1", "1", "2.2.2.2", "2", "TCP", "3.3.3.3", str(i), user, key)
        for i, (key, user) in enumerate(names)
    ]
    return spark.createDataFrame(rows, FLOWS)


def test_report_retry(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    report = spark.createDataFrame([("city", BATCH, "x", 3)], "types string, accesstime timestamp, data string, count long")
    for at in (BATCH, BATCH, BATCH + timedelta(minutes=5), BATCH):
        sink.write_batch(report, path, at)
    sink.write_batch(report, path, BATCH, number=4)
    table = spark.read.parquet(path)
    assert sorted(str(r.batch) for r in table.collect()) == [
        "202401101200", "202401101200-000000004", "202401101205",
    ]


def test_user_counts_text(spark, rows, tmp_path):
    path = str(tmp_path / "users")
    users = spark.createDataFrame([("a,b", 3), ("c", 4)], "username string, count long")
    for _ in range(2):
        sink.write_user_counts(users, path, BATCH)
    assert rows(read_user_counts(spark, f"{path}/dt=20240110/*/*/*")) == [("a,b", 3), ("c", 4)]
    assert (tmp_path / "users/dt=20240110/hh=12/mm=00/batch=202401101200").is_dir()


def test_newest_batch_holds(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    first, second = BATCH, BATCH + timedelta(minutes=5)
    store.upsert_sessions(flows(spark, [("00000000a", "old"), ("ff000000b", "old")]), path, first)
    for _ in range(2):
        store.upsert_sessions(flows(spark, [("ff000000b", "new"), ("cc000000c", "new")]), path, second)
    # A late retry of the older batch changes nothing.
    store.upsert_sessions(flows(spark, [("00000000a", "old"), ("ff000000b", "old")]), path, first)
    stored = S.read_store(spark, path)
    wanted = [("00000000a", "old"), ("cc000000c", "new"), ("ff000000b", "new")]
    assert stored.count() == 4
    assert rows(S.newest(stored), "rowkey", "username") == wanted
    # A value that a key had only before its last batch is not found.
    assert rows(S.trace_value(stored, "username", "old"), "rowkey") == [("00000000a",)]
    assert rows(S.trace_value(stored, "rowkey", "ff000000b"), "username") == [("new",)]
    later = S.trace_time(stored, BATCH, BATCH + timedelta(seconds=1))
    assert rows(later, "rowkey", "username") == wanted

    whole = str(tmp_path / "days")
    for _ in range(2):
        store.compact_day(spark, path, whole, "20240110")
    assert rows(spark.read.parquet(whole), "rowkey", "username") == wanted


def test_days_of_the_store_are_apart(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    for at in (datetime(2024, 1, 10, 0, 0), datetime(2024, 1, 10, 0, 5)):
        store.upsert_sessions(flows(spark, [("00000000a", "u")]), path, at)
    assert rows(S.newest(S.read_store(spark, path)), "dt") == [("20240109",), ("20240110",)]
    for days in (["20240110"], ["20240110", "20240111"]):
        assert rows(S.read_store(spark, path, days), "dt") == [("20240110",)]
    assert S.read_store(spark, path, ["20240111"]).count() == 0
    # A table of whole days is read in the same way.
    store.compact_day(spark, path, str(tmp_path / "days"), "20240110")
    whole = S.read_store(spark, str(tmp_path / "days"), ["20240110"])
    assert rows(S.newest(whole), "dt", "username") == [("20240110", "u")]


def test_batches_after_folding_are_found(spark, rows, tmp_path):
    path, whole = str(tmp_path / "store"), str(tmp_path / "days")
    found = lambda: rows(S.newest(D.read_days(spark, path, whole)), "rowkey", "username")
    later = BATCH + timedelta(minutes=5)
    store.upsert_sessions(flows(spark, [("00000000a", "old"), ("ff000000b", "old")]), path, BATCH)
    store.compact_day(spark, path, whole, "20240110")
    assert found() == [("00000000a", "old"), ("ff000000b", "old")]
    store.upsert_sessions(flows(spark, [("ff000000b", "new"), ("cc000000c", "new")]), path, later)
    assert found() == [("00000000a", "old"), ("cc000000c", "new"), ("ff000000b", "new")]
    store.compact_day(spark, path, whole, "20240110")
    # A rerun that took a row out.
    store.upsert_sessions(flows(spark, [("cc000000c", "new")]), path, later)
    assert found() == [("00000000a", "old"), ("cc000000c", "new"), ("ff000000b", "old")]
    # A folded day whose batches are no longer in the store, then with a late batch.
    store.compact_day(spark, path, whole, "20240110")
    path = str(tmp_path / "other")
    assert found() == [("00000000a", "old"), ("cc000000c", "new"), ("ff000000b", "old")]
    store.upsert_sessions(flows(spark, [("00000000a", "late")]), path, later + timedelta(minutes=5))
    assert found() == [("00000000a", "late"), ("cc000000c", "new"), ("ff000000b", "old")]


def test_days_between():
    days = S.days_between(datetime(2024, 2, 28, 23, 55), datetime(2024, 3, 1, 0, 5))
    assert days == ["20240228", "20240229", "20240301"]


def test_trace_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert_sessions(flows(spark, [("00000000a", "u")]), path, BATCH)
    stored = S.read_store(spark, path, ["20240110"]).where("dt = '20240110'")
    start, end = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    plan = executed_plan(S.trace_endpoint(stored, "3.3.3.3", "1", start, end))
    assert "PushedFilters: [IsNotNull(rowkey), GreaterThan(rowkey," in plan
    assert "PartitionFilters: [isnotnull(dt" in plan
    plan = executed_plan(S.trace_time(stored, start, end))
    assert "PushedFilters: [IsNotNull(accesstime), GreaterThanOrEqual(accesstime," in plan
    plan = executed_plan(S.trace_value(stored, "convertedIp", "3.3.3.3"))
    assert "PushedFilters: [IsNotNull(convertedIp), EqualTo(conv" in plan


def test_endpoint_range_is_half_open(spark):
    times = [BATCH + timedelta(seconds=s) for s in range(4)]
    frame = spark.createDataFrame([(t,) for t in times], "accesstime timestamp").withColumn(
        "rowkey", row_key(F.lit("3.3.3.3"), F.lit("1"), F.col("accesstime"))
    )
    found = frame.where(S.endpoint_keys("3.3.3.3", "1", times[1], times[3])).orderBy("rowkey")
    assert [r.accesstime for r in found.collect()] == [times[2], times[1]]


def test_cells_are_in_order(spark, tmp_path):
    names = [(f"{i * 7919 % 256:02x}000000{i:03d}", "u") for i in range(100)]
    path = str(tmp_path / "cells")
    store.write_cells(store.to_cells(flows(spark, names)), path, BATCH)
    got, files = [], sorted((tmp_path / "cells").rglob("*.parquet"))
    for file in files:
        part = spark.read.parquet(str(file)).collect()
        got += [(r.rowkey, r.qualifier) for r in part]
    assert len(got) == 100 * len(CELL_NAMES) and got == sorted(got)


def test_day_table_file_size(spark, tmp_path):
    path = tmp_path / "day"
    for _ in range(2):
        sink.write_day(spark.range(25).coalesce(1), str(path), datetime(2024, 1, 10), max_records=10)
    assert len(list(path.rglob("*.parquet"))) == 3
    assert spark.read.parquet(str(path)).count() == 25
