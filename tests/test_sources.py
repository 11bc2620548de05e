"""Log folders, quota, stored tables."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from edgeledger.sources import admission, tables
from edgeledger.sources import lines as L


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return folder / name


@pytest.mark.parametrize("layout", [L.PLAIN, L.PARTITIONED])
def test_minute_folders(spark, rows, tmp_path, layout):
    batch = datetime(2024, 1, 2, 0, 2)
    for minutes in (-6, -5, -3, -1, 0):
        folder = tmp_path / (batch + timedelta(minutes=minutes)).strftime(layout)
        put(folder, "log", f"line {minutes}")
    read = L.read_minutes(spark, str(tmp_path), batch, layout=layout)
    assert rows(read) == [("line -1",), ("line -3",), ("line -5",)]
    none = L.read_minutes(spark, str(tmp_path), batch + timedelta(days=3), layout=layout)
    assert none.columns == ["value"] and none.count() == 0


def test_folders_cross_midnight():
    assert L.minute_folders(datetime(2024, 1, 1, 0, 1), 2) == ["20231231/23/59", "20240101/00/00"]


def test_modified_files(spark, rows, tmp_path):
    end = datetime(2024, 1, 1, 0, 5, tzinfo=timezone.utc)
    for name, seconds in [("before", -301), ("first", -300), ("last", -1), ("after", 0)]:
        path = put(tmp_path / "00" / name, "log", name)
        stamp = end.timestamp() + seconds
        os.utime(path, (stamp, stamp))
    read = L.read_modified(spark, str(tmp_path), end)
    assert rows(read) == [("first",), ("last",)]
    # Other files are dropped from the listing: no partition holds them.
    assert read.rdd.getNumPartitions() <= 2
    listed = L.list_files(spark, str(tmp_path))
    assert listed.count() == 4 and {r.size_mb for r in listed.collect()} == {0}
    none = L.list_files(spark, str(tmp_path / "missing"))
    assert none.columns == listed.columns and none.count() == 0


def by_loop(files, limit):
    """The rule as a loop: admit while the whole GB so far are not above the limit."""
    done, taken = 0, set()
    for backlog in (True, False):
        for path, mb, old in sorted(files):
            if old == backlog and done // 1024 <= limit:
                taken.add(path)
                done += mb
    return taken


@pytest.mark.parametrize("limit", [0, 1, 7, 40, 10**6])
def test_admission_equals_loop(spark, limit):
    rng = random.Random(limit)
    files = [(f"/f{i:04d}", rng.choice([0, 1, 300, 2000]), rng.random() < 0.3) for i in range(400)]
    frame = spark.createDataFrame(files, "path string, size_mb long, backlog boolean")
    limits = spark.createDataFrame([(limit,)], "limit_gb long")
    chosen = admission.admit(frame, limits, slices=7)
    got = {r.path for r in chosen.where("admitted").collect()}
    assert got == by_loop(files, limit)
    left = admission.backlog(chosen)
    assert {r.path for r in left.collect()} == {p for p, _, _ in files} - got
    assert all(r.backlog for r in left.collect())
    assert set(admission.admitted_paths(chosen)) == got


def test_admission_of_nothing(spark):
    frame = spark.createDataFrame([], "path string, size_mb long, backlog boolean")
    limits = spark.createDataFrame([(1,)], "limit_gb long")
    assert admission.admit(frame, limits).count() == 0


@pytest.mark.parametrize("values, wanted", [([], 40), ([7], 7), ([7, 8], 40)])
def test_quota(spark, values, wanted):
    frame = spark.createDataFrame([(v,) for v in values], "performance int")
    assert admission.quota(frame).head().limit_gb == wanted


def test_user_counts_are_cut_at_the_last_comma(spark, rows):
    lines = ["(a,1)", "(a,b,2)", "(a,b,c,3)", "(a,b,c,d,4)", "(,5)", "broken", "(a,x)"]
    frame = spark.createDataFrame([(v,) for v in lines], "value string")
    assert rows(tables.parse_user_counts(frame)) == [
        ("", 5), ("a", 1), ("a,b", 2), ("a,b,c", 3), ("a,b,c,d", 4),
    ]


def test_key_predicates_are_a_partition(spark):
    """Every row, also one without a key, meets exactly one condition."""
    frame = spark.createDataFrame([(v,) for v in [*range(-250, 250), None]], "id int")
    frame.createOrReplaceTempView("people")
    parts = tables.key_predicates("id", 10)
    sizes = [spark.sql(f"select 1 from people where {p}").count() for p in parts]
    assert sum(sizes) == 501 and max(sizes) <= 52
    buckets = {r.b: r.n for r in frame.groupBy(tables.key_bucket("id", 10).alias("b")).count()
               .withColumnRenamed("count", "n").collect()}
    assert [buckets[i] for i in range(10)] == sizes


def test_starting_offsets(spark):
    frame = spark.createDataFrame(
        [("g", "b", 0, 5), ("g", "a", 1, 7), ("g", "a", 10, 8), ("h", "a", 1, 9)],
        "groupId string, topic string, partitionNum int, offsets long",
    )
    assert tables.starting_offsets(frame, "g").head()[0] == '{"a":{"1":7,"10":8},"b":{"0":5}}'
    assert tables.starting_offsets(frame, "none").head()[0] == "{}"


def test_tables_by_format(spark, rows, tmp_path):
    from edgeledger.sinks.tables import save_table

    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    for _ in range(2):
        save_table(frame, path=str(tmp_path / "t"))
    assert rows(tables.read_table(spark, path=str(tmp_path / "t"))) == [(1, "x")]


UTC = timezone.utc
BACKLOG = "path string, size_mb long, mtime timestamp, backlog boolean"


def test_files_of_a_batch(spark, rows, tmp_path):
    """Yesterday's folder at midnight, backlog that is gone, grown, named as a pattern or new as well."""
    batch = datetime(2024, 1, 2, 0, 5)

    def old(day, name, at):
        path = put(tmp_path / "logs" / day, name, name)
        stamp = at.replace(tzinfo=UTC).timestamp()
        os.utime(path, (stamp, stamp))
        return str(path)

    late = datetime(2024, 1, 2, 0, 2)
    yesterday, today = old("20240101", "a", late), old("20240102", "b", late)
    old("20240102", "early", datetime(2024, 1, 1, 23, 59))
    odd, both = old("20231224", "x[1]{2}*", datetime(2023, 12, 24)), old("20240102", "both", late)
    stored = [(p, 9, late, True) for p in (odd, f"file:{both}", str(tmp_path / "gone/file"), odd)]
    backlog = spark.createDataFrame(stored, BACKLOG)
    days = L.day_folders(str(tmp_path / "logs"), batch)
    files, gone = L.manifest(spark, days, backlog, batch)
    plain = sorted((L_path(r.path), r.backlog) for r in files.collect())
    assert plain == sorted([(yesterday, False), (today, False), (odd, True), (both, True)])
    assert rows(gone) == [(str(tmp_path / "gone/file"),)]
    read = L.read_paths(spark, [r.path for r in files.collect()])
    assert rows(read) == [("a",), ("b",), ("both",), ("x[1]{2}*",)]
    first, none = L.manifest(spark, days, backlog.limit(0), batch)
    assert first.count() == 3 and none.count() == 0


def L_path(path):
    return path.removeprefix("file:").replace("///", "/")


def test_whole_folders_are_read_as_one(spark, rows, tmp_path):
    """Folders that the quota takes whole, one that it cuts, one with a file of another time, and a later file."""
    batch = datetime(2024, 1, 2, 0, 10)

    def old(folder, name, at=datetime(2024, 1, 2, 0, 7), size=0):
        path = put(tmp_path / "20240102" / folder, name, f"{folder}/{name}" + "x" * size)
        os.utime(path, (at.replace(tzinfo=UTC).timestamp(),) * 2)
        return str(path)

    for folder in ("a", "b", "cut", "mixed"):
        for k in range(20):
            old(folder, f"f{k:02d}")
    old("mixed", "early", datetime(2024, 1, 2, 0, 1))
    none = spark.createDataFrame([], BACKLOG)
    files, _ = L.manifest(spark, L.day_folders(str(tmp_path), batch), none, batch)
    assert {(r.path.split("/")[-2], r.outside) for r in files.collect()} == {("a", 0), ("b", 0), ("cut", 0), ("mixed", 1)}
    limits = spark.createDataFrame([(1,)], "limit_gb long")
    sized = files.withColumn("size_mb", F.lit(60).cast("long"))  # 35 files and one more are two GB
    chosen = admission.admit(sized, limits)
    folders, single = admission.admitted_cover(chosen)
    assert sorted(f.split("/")[-1] for f in folders) == ["a"]
    assert sorted(set(f.split("/")[-2] for f in single)) == ["b"] and len(single) == 15
    folders, single = admission.admitted_cover(chosen.withColumn("admitted", F.lit(True)))
    assert sorted(f.split("/")[-1] for f in folders) == ["a", "b", "cut"] and len(single) == 20
    old("a", "late", datetime(2024, 1, 2, 0, 11))
    wanted = sorted((f"{d}/f{k:02d}",) for d in ("a", "b", "cut", "mixed") for k in range(20))
    assert rows(L.read_cover(spark, folders, single, batch)) == wanted
    assert L.read_cover(spark, [], [], batch).count() == 0


def test_number_of_files_is_bounded(spark):
    files = [(f"/f{i:04d}", 0, i % 7 == 0) for i in range(100)]
    frame = spark.createDataFrame(files, "path string, size_mb long, backlog boolean")
    chosen = admission.admit(frame, spark.createDataFrame([(1,)], "limit_gb long"), max_files=30)
    got = sorted(r.path for r in chosen.where("admitted").collect())
    assert len(got) == 30 and {p for p, _, b in files if b} < set(got)
    assert admission.backlog(chosen).count() == 70
