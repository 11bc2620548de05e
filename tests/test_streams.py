"""Streams against the batch forms, and their restarts."""

from datetime import datetime

from edgeledger.operators import parse
from edgeledger.sources import lines as L
from edgeledger.streaming import streams

from checks.queries import geo, radius

SF = "/root/testdata/sf0.001"
LINE = "Msg: 2024-01-10 {}:00 fw n=1,p=TCP,s=30.128.0.1,d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np={}"


def put(root, name, *lines):
    folder = root / "20240110/00" / name
    folder.mkdir(parents=True)
    (folder / "log").write_text("\n".join(lines) + "\n")


def flows(spark, root):
    stream = L.stream_lines(spark, f"{root}/*/*/*")
    return parse.with_row_key(parse.flows(parse.clean_lines(stream), 2024))


def run(rows, path, mode="append"):
    streams.write_stream(rows, f"{path}/table", f"{path}/checkpoint", mode, streams.ONCE).awaitTermination()


def test_late_sessions_leave_the_counters(spark, rows, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    put(root, "00", LINE.format("12:01", 1), LINE.format("12:04", 2))
    run(streams.slot_counts(flows(spark, root)), out, "update")
    # In time by three hours, and too late.
    put(root, "01", LINE.format("09:06", 3), LINE.format("08:59", 4), LINE.format("12:02", 5))
    run(streams.slot_counts(flows(spark, root)), out, "update")
    # A restart without new files adds nothing.
    run(streams.slot_counts(flows(spark, root)), out, "update")
    got = streams.read_updates(spark, f"{out}/table", ["accesstime"])
    assert rows(got) == [(datetime(2024, 1, 10, 12), 3), (datetime(2024, 1, 10, 9, 5), 1)]


def test_duplicates_across_batches(spark, rows, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    put(root, "00", LINE.format("12:01", 1), LINE.format("12:01", 1))
    run(streams.distinct_stream(flows(spark, root)), out)
    put(root, "01", LINE.format("12:01", 1), LINE.format("12:01", 2))
    run(streams.distinct_stream(flows(spark, root)), out)
    assert rows(spark.read.parquet(f"{out}/table"), "convertedPort") == [("1",), ("2",)]


def test_report_stream_adds_deltas(spark, rows, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    for name, ports in [("00", (1, 2)), ("01", (3,))]:
        put(root, name, *[LINE.format("12:01", port) for port in ports])
        streams.report_stream(
            L.stream_lines(spark, f"{root}/*/*/*"), lambda: (geo(spark, SF), radius(spark, SF)),
            out, f"{out}/checkpoint", trigger=streams.ONCE, year=2024,
        ).awaitTermination()
    report = spark.read.parquet(f"{out}/report").where("types = 'sourceIp'")
    assert rows(report, "accesstime", "data", "count") == [
        (datetime(2024, 1, 10, 12), "30.128.0.1", 1), (datetime(2024, 1, 10, 12), "30.128.0.1", 2),
    ]
    assert spark.read.parquet(f"{out}/sessions").count() == 3


def test_quota_splits_a_stream(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    for name in ("00", "01", "02"):
        put(root, name, LINE.format("12:01", int(name)))
    stream = L.stream_lines(spark, f"{root}/*/*/*", maxBytesPerTrigger=100)
    run(parse.flows(parse.clean_lines(stream), 2024), out)
    table = spark.read.parquet(f"{out}/table")
    assert table.count() == 3 and table.select("micro").distinct().count() == 3


def test_batch_time_of_a_run():
    assert streams.slot_end("2024-01-10 12:34:56") == datetime(2024, 1, 10, 12, 30)
