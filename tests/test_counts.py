"""Counts, totals, de-duplication and top lists on small frames."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edgeledger.operators import counts as C
from edgeledger.operators import parse, tops
from edgeledger.plans import jobs
from edgeledger.plans import report as R

from conftest import executed_plan

T0 = datetime(2024, 1, 10, 12, 0)


def sessions(spark, rows):
    """``(seconds, source, target, port)`` as keyed sessions."""
    made = [
        (T0 + timedelta(seconds=s), source, "1", target, "80", "TCP", "9.9.9.9", port)
        for s, source, target, port in rows
    ]
    names = "accesstime timestamp, sourceIp string, sourcePort string, targetIp string, \
        targetPort string, protocol string, convertedIp string, convertedPort string"
    return parse.with_row_key(spark.createDataFrame(made, names))


def job_counts(frame, at, event_time):
    """Counts and stored sessions, as the jobs have them."""
    entries = frame.select(F.lit("sourceIp").alias("types"), "accesstime", F.col("sourceIp").alias("data"))
    return R.dimension_counts(R.slot_entries(entries, at, event_time)), C.distinct_sessions(frame)


def test_salted_equals_plain_on_a_hot_key(spark, rows):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", i) for i in range(3000)]
    frame = spark.createDataFrame(data, "k string, i int")
    wanted = sorted(Counter(k for k, _ in data).items())
    assert rows(C.salted_count(frame, "k")) == wanted
    assert rows(C.count_by(frame, "k")) == wanted


def test_counts_combine_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"))
    plan = executed_plan(C.count_by(frame, "k"))
    assert plan.count("HashAggregate") == 2


def test_distinct_sessions_keep_the_least(spark, rows):
    frame = sessions(spark, [(0, "b", "t", "1"), (0, "a", "z", "1"), (0, "a", "t", "2"), (1, "a", "t", "1")])
    assert rows(C.distinct_sessions(frame), "sourceIp", "targetIp", "convertedPort") == [
        ("a", "t", "1"), ("a", "t", "2"), ("a", "z", "1"),
    ]
    assert C.distinct_sessions(frame).columns == frame.columns


def test_counters(spark, rows):
    frame = sessions(spark, [(0, "a", "t", "1")] * 601 + [(1, "a", "t", "1"), (300, "a", "t", "1")])
    at = T0 + timedelta(minutes=5)
    batch = jobs.batch_counters(*job_counts(frame, at, False), at)
    assert rows(batch, "counter", "count_5min", "count_sec", "update_time") == [
        ("nat_count", 603, 2, T0), ("nat_hbase_count", 3, 0, T0),
    ]
    empty = jobs.batch_counters(*job_counts(frame.where("false"), T0, False), T0)
    assert rows(empty, "counter", "count_5min") == [("nat_count", 0), ("nat_hbase_count", 0)]


@pytest.mark.parametrize("minutes, kept", [(0, 2), (180, 2), (181, 1), (185, 1), (186, 0)])
def test_cutoff_is_on_whole_slots(spark, rows, minutes, kept):
    """A slot stays while its start is not more than three hours before the batch."""
    frame = sessions(spark, [(0, "a", "t", "1"), (299, "a", "t", "1"), (300, "a", "t", "1")])
    at = T0 + timedelta(minutes=minutes)
    counted = jobs.slot_counters(*job_counts(frame, at, True), at).where("counter = 'nat_count'")
    late = C.late_windows(frame, at)
    assert counted.count() == kept and late.count() == 2 - kept
    total = counted.agg(F.sum("count_5min")).head()[0] or 0
    assert total + (late.agg(F.sum("count")).head()[0] or 0) == 3


def test_daily_totals(spark, rows):
    counters = spark.createDataFrame(
        [("nat_count", 5, T0), ("nat_count", 6, T0 + timedelta(hours=12)), ("nat_hbase_count", 4, T0)],
        "counter string, count_5min long, update_time timestamp",
    )
    day, after = datetime(2024, 1, 10), datetime(2024, 1, 11)
    assert rows(C.daily_totals(counters, day, after)) == [
        ("nat_count", 5, day), ("nat_hbase_count", 4, day),
    ]
    old = C.daily_totals(counters, datetime(2023, 1, 1), datetime(2023, 1, 2))
    assert rows(old, "counter", "count_day") == [("nat_count", 0), ("nat_hbase_count", 0)]


def test_hour_fill(spark):
    data = [("k", 1, "03", "a"), ("k", 2, "03", "b"), ("k", 3, "24", "x"), ("none", 1, "7", "y")]
    frame = spark.createDataFrame(data, "key string, position int, hour string, value string")
    got = dict(tuple(r) for r in C.hour_fill(frame, "key").collect())
    zeros = [f"{h:02d}=0" for h in range(24)]
    assert got["none"] == ",".join(zeros)
    assert got["k"] == ",".join(zeros[:3] + ["03=b"] + zeros[4:])


def test_top_breaks_ties_by_value(spark, rows):
    frame = spark.createDataFrame(
        [(T0, v, n) for v, n in [("c", 1), ("a", 1), ("b", 1), ("z", 2)]],
        "accesstime timestamp, v string, count long",
    )
    first = tops.top(frame, "v", 3)
    assert [r.v for r in first.collect()] == ["z", "a", "b"]
    assert "TakeOrderedAndProject" in executed_plan(first)
    grouped = frame.withColumn("g", F.lit(1)).union(frame.withColumn("g", F.lit(2)))
    per = tops.top_per(grouped, ["g"], "v", 2)
    assert rows(per, "g", "v") == [(1, "a"), (1, "z"), (2, "a"), (2, "z")]
    assert "WindowGroupLimit" in executed_plan(per)


def test_accounts_from_source_counts(spark, rows):
    counts = spark.createDataFrame([(T0, "a", 3), (T0, "b", 4), (T0, "c", 5), (T0, "d", 6)], "accesstime timestamp, sourceIp string, count long")
    dim = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "UnKnown"), ("e", "v")], "ip string, account string")
    assert rows(C.accounts_of_sources(counts, dim), "username", "count") == [("u", 7)]


def test_consolidate_adds_deltas(spark, rows):
    deltas = spark.createDataFrame([("city", T0, "x", 2), ("city", T0, "x", 3), ("city", T0, "y", 1)], "types string, accesstime timestamp, data string, count long")
    assert rows(C.consolidate(deltas), "data", "count") == [("x", 5), ("y", 1)]


def test_dimension_counts_share_one_kind_column(spark, rows):
    entries = spark.createDataFrame(
        [("hostIP", T0, "h"), ("targetIp", T0, "t"), ("targetIp", T0, "t"), ("sourceIp", T0, "t")],
        "types string, accesstime timestamp, data string",
    )
    counted = R.dimension_counts(entries)
    assert rows(R.of_kind(counted, "targetIp", "x"), "x", "count") == [("t", 2)]
    assert rows(R.of_kind(counted, "sourceIp", "x"), "x", "count") == [("t", 1)]
