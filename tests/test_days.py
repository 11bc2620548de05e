"""Folded days: what is read, what is written again, and what holds when batches come, change and go."""

import shutil
from datetime import datetime, timedelta

import pytest

from edgeledger.functions.net import row_key
from edgeledger.schemas import FLOWS
from edgeledger.sinks import sessions as store
from edgeledger.sources import days as D
from edgeledger.sources import sessions as S
from pyspark.sql import functions as F

BATCH = datetime(2024, 1, 10, 12, 5)
DAY = "20240110"


def sessions(spark, rows):
    """``(source, public port, second, user)`` as distinct sessions."""
    made = [
        (BATCH + timedelta(seconds=s), source, "1", "9.9.9.9", "443", "TCP", "3.3.3.3", str(port), user, None)
        for source, port, s, user in rows
    ]
    frame = spark.createDataFrame(made, FLOWS)
    key = row_key(F.col("convertedIp"), F.col("convertedPort"), F.col("accesstime"))
    return frame.withColumn("rowkey", key)


def many(spark, n, user="u"):
    return sessions(spark, [(f"10.0.{k % 7}.{k % 50}", k, 60 * k, user) for k in range(n)])


def users(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*(columns or ("convertedPort", "username"))).collect())


def scanned(frame) -> tuple[int, int]:
    """Files and rows that the Parquet scans of one run read."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.collect()
    files = rows = 0
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            if name.startswith("Scan parquet"):
                files += node.metrics().get("numFiles").get().value()
                rows += node.metrics().get("numOutputRows").get().value()
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return files, rows


def files_below(folder):
    return {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in folder.rglob("*.parquet")}


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "store"), str(tmp_path / "days")


def test_days_by_their_files(spark, places):
    path, whole = places
    later, last = BATCH + timedelta(minutes=5), BATCH + timedelta(minutes=10)
    store.upsert_sessions(sessions(spark, [("a", 1, 0, "old"), ("a", 2, 0, "old")]), path, BATCH)
    store.upsert_sessions(sessions(spark, [("a", 3, 0, "old")]), path, later)
    assert D.days_of(spark, path, whole) == [D.Day(DAY, False, ("202401101200", "202401101205"))]
    store.compact_day(spark, path, whole, DAY)
    assert D.days_of(spark, path, whole) == [D.Day(DAY, True)]
    store.upsert_sessions(sessions(spark, [("a", 2, 0, "new")]), path, last)
    assert D.days_of(spark, path, whole) == [D.Day(DAY, True, added=("202401101210",))]
    assert users(S.newest(D.read_days(spark, path, whole))) == [("1", "old"), ("2", "new"), ("3", "old")]
    # Some of the folded batches are deleted: their rows stay.
    shutil.rmtree(f"{path}/dt={DAY}/batch=202401101200")
    assert D.days_of(spark, path, whole) == [D.Day(DAY, True, added=("202401101210",), gone=("202401101200",))]
    assert users(S.newest(D.read_days(spark, path, whole))) == [("1", "old"), ("2", "new"), ("3", "old")]
    # Another one changes too: the store holds, and the folded rows of the deleted batch beside it.
    store.upsert_sessions(sessions(spark, [("a", 4, 0, "new")]), path, later)
    assert users(S.newest(D.read_days(spark, path, whole))) == [("1", "old"), ("2", "new"), ("4", "new")]
    # Folded anew, and again after the whole store is gone.
    store.compact_day(spark, path, whole, DAY)
    assert D.days_of(spark, path, whole) == [D.Day(DAY, True, gone=("202401101200",))]
    assert users(S.newest(D.read_days(spark, path, whole))) == [("1", "old"), ("2", "new"), ("4", "new")]
    store.compact_day(spark, path + "-none", whole, DAY)
    for frame in (D.read_days(spark, path + "-none", whole), D.Days.open(spark, path + "-none", whole).by_time(BATCH, last)):
        assert users(S.newest(frame)) == [("1", "old"), ("2", "new"), ("4", "new")]


def test_a_late_batch_rewrites_nothing(spark, places, tmp_path):
    path, whole = places
    store.upsert_sessions(many(spark, 400), path, BATCH)
    store.compact_day(spark, path, whole, DAY)
    before = files_below(tmp_path / "days")
    store.compact_day(spark, path, whole, DAY)  # nothing is new
    assert files_below(tmp_path / "days") == before
    store.upsert_sessions(many(spark, 6, "late"), path, BATCH + timedelta(minutes=5))
    store.compact_day(spark, path, whole, DAY)
    after = files_below(tmp_path / "days")
    kept = {f: x for f, x in before.items() if D.FILES_FOLDER not in str(f)}
    assert all(after[f] == x for f, x in kept.items())
    added = [spark.read.parquet(str(f)).count() for f in after.keys() - before.keys() if D.FILES_FOLDER not in str(f)]
    assert sum(added) == 6 * (2 + len(D.INDEXED))
    days = D.Days.open(spark, path, whole)
    assert days.unfolded().count() == 0
    assert users(S.newest(days.by_key())) == sorted((str(k), "late" if k < 6 else "u") for k in range(400))
    # The index still leads to the keys of the old value; their newest rows have another.
    assert users(days.trace_value("username", "late"), "convertedPort") == [(str(k),) for k in range(6)]
    assert days.trace_value("username", "u", n=1000).count() == 394
    first = users(days.by_key().orderBy("rowkey"), "rowkey")
    assert users(days.trace_value("username", "u", n=390), "rowkey") == users(S.page(S.newest(days.by_key()).where("username = 'u'"), 390), "rowkey")
    assert len(first) == 406


def test_a_fold_cut_short_is_done_again(spark, places):
    path, whole = places
    store.upsert_sessions(many(spark, 30), path, BATCH)
    store.compact_day(spark, path, whole, DAY)
    store.upsert_sessions(many(spark, 4, "late"), path, BATCH + timedelta(minutes=5))
    listed = D.folded_files(spark, whole).collect()
    store.compact_day(spark, path, whole, DAY)
    spark.createDataFrame(listed, D.FILE_LIST).write.mode("overwrite").partitionBy("dt").parquet(f"{whole}/{D.FILES_FOLDER}")
    wanted = sorted((str(k), "late" if k < 4 else "u") for k in range(30))
    assert users(S.newest(D.read_days(spark, path, whole))) == wanted
    store.compact_day(spark, path, whole, DAY)
    assert users(S.newest(D.read_days(spark, path, whole))) == wanted
    shutil.rmtree(f"{whole}/{D.FILES_FOLDER}")
    store.compact_day(spark, path, whole, DAY)
    assert D.read_days(spark, path, whole).count() == 30


def test_traces_read_what_they_need(spark, places):
    """Files and rows of a trace stay the same while the day, and the number of days, grow."""
    path, whole = places
    value, start, end = "10.0.3.3", BATCH, BATCH + timedelta(minutes=30)
    read = {}
    for n, days in ((200, 1), (1200, 3)):
        for k in range(days):
            store.upsert_sessions(many(spark, n), path, BATCH + timedelta(days=k))
            store.compact_day(spark, path, whole, f"{BATCH + timedelta(days=k):%Y%m%d}")
        all_days = D.Days.open(spark, path, whole, [DAY])
        read[n] = [
            scanned(all_days._index_keys("sourceIp", D.index_hash("sourceIp", [F.lit(value)]))),
            scanned(all_days.trace_value("sourceIp", value, n=3)),
            scanned(all_days.trace_time(start, end)),
            scanned(all_days.trace_endpoint("3.3.3.3", "7", start, end)),
            scanned(S.newest(all_days.by_key())),
        ]
    small, large = read[200], read[1200]
    assert [small[k][0] for k in (0, 2, 3)] == [large[k][0] for k in (0, 2, 3)]
    assert large[0][0] == 1 and large[1][0] <= 3 and small[1][0] == 1 and large[2][0] <= 2 and large[3][0] == 1
    assert large[2][1] <= 120 and large[3][1] <= 1200 / 20 * 2 < large[4][1]


def test_pages(spark, places):
    """Rows with one key on two days, and pages that end between them."""
    path, whole = places
    for day in range(2):
        store.upsert_sessions(many(spark, 25, f"d{day}"), path, BATCH + timedelta(days=day))
    store.compact_day(spark, path, whole, DAY)
    days, stored = D.Days.open(spark, path, whole), S.read_store(spark, path)
    begin, end = BATCH, BATCH + timedelta(days=1)
    ways = [
        lambda n, after: days.trace_time(begin, end, n, after),
        lambda n, after: S.trace_time(stored, begin, end, n, after),
        lambda n, after: days.trace_value("convertedIp", "3.3.3.3", n, after),
        lambda n, after: S.trace_value(stored, "convertedIp", "3.3.3.3", n, after),
    ]
    whole_list = [(r.rowkey, r.dt) for r in S.newest(stored).orderBy("rowkey", "dt").collect()]
    for way in ways:
        got, after = [], None
        while True:
            rows = way(17, after)
            got += [(r.rowkey, r.dt) for r in rows.orderBy("rowkey", "dt").collect()]
            after = S.cursor_of(rows)
            if after is None:
                break
        assert got == whole_list


def test_both_endpoints(spark, places):
    path, whole = places
    store.upsert_sessions(many(spark, 20), path, BATCH)
    store.compact_day(spark, path, whole, DAY)
    days = D.Days.open(spark, path, whole)
    assert users(days.trace_value("endpoints", ("9.9.9.9", "443", "3.3.3.3", "11"))) == [("11", "u")]
    assert days.trace_value("endpoints", ("9.9.9.9", "80", "3.3.3.3", "11")).count() == 0
    for column, value in (("targetPort", "443"), ("endpoints", "9.9.9.9")):
        with pytest.raises(ValueError):
            days.trace_value(column, value)
    assert D.Days.open(spark, path + "-none", whole + "-none").trace_value("username", "u").count() == 0


def test_hours_far_from_the_day(spark, places):
    path, whole = places
    rows = [("a", 1, 0, "u"), ("a", 2, -86400 * 2, "u"), ("a", 3, -86400 * 40, "u"), ("a", 4, 86400 * 400, "u")]
    store.upsert_sessions(sessions(spark, rows), path, BATCH)
    store.compact_day(spark, path, whole, DAY)
    hours = {r.hour for r in spark.read.parquet(f"{whole}/{D.TIME_FOLDER}").select("hour").distinct().collect()}
    assert hours == {"2024011012", "2024010812", D.OTHER_HOUR}
    days = D.Days.open(spark, path, whole)
    for _, port, seconds, _ in rows[:3]:
        at = BATCH + timedelta(seconds=seconds)
        assert users(days.trace_time(at, at + timedelta(seconds=1)), "convertedPort") == [(str(port),)]


def test_all_pages_are_those_read_one_by_one(spark, places):
    path, whole = places
    store.upsert_sessions(many(spark, 50), path, BATCH)
    store.compact_day(spark, path, whole, DAY)
    store.upsert_sessions(many(spark, 20, "late"), path, BATCH + timedelta(days=1))
    days, span = D.Days.open(spark, path, whole), (BATCH, BATCH + timedelta(days=1))
    one_by_one, after = [], None
    for number in range(8):
        page = days.trace_time(*span, 9, after)
        one_by_one += [(number, *r) for r in page.collect()]
        after = S.cursor_of(page)
    assert len(one_by_one) == 70
    at_once = days.trace_pages(*span, 9)
    assert sorted(tuple(r) for r in at_once.select("page", *page.columns).collect()) == sorted(one_by_one)
    # From a cursor on, and after the last row.
    third = days.trace_time(*span, 18)
    rest = days.trace_pages(*span, 9, S.cursor_of(third)).select("page", "rowkey", "dt").collect()
    assert sorted((r.page + 2, r.dt, r.rowkey) for r in rest) == sorted((r[0], r[1], r[1 + page.columns.index("rowkey")]) for r in one_by_one if r[0] > 1)
    assert days.trace_pages(*span, 9, S.Cursor("~", DAY)).count() == 0


def test_work_of_all_pages_does_not_grow_with_pages(spark, places):
    path, whole = places
    store.upsert_sessions(many(spark, 60), path, BATCH)
    days, jobs = D.Days.open(spark, path, whole), {}
    for n in (2, 30):
        spark.sparkContext.setJobGroup(f"pages of {n}", "")
        assert days.trace_pages(BATCH, BATCH + timedelta(days=1), n).select("page").distinct().count() == 60 // n
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"pages of {n}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[2] == jobs[30]
