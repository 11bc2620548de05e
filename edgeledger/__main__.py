"""Command line: ``python -m edgeledger <job> ...``, also by ``spark-submit``.

Dimensions are tables of files: geography ``(lo, hi, province, operator, city)`` or
``(lo, hi, text)``, accounts as JSON lines, the others as Parquet.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.net import geo_fields
from .plans import daily, jobs
from .schemas import BACKLOG, LINES, SETTINGS
from .session import build_session
from .sinks.tables import save_table
from .sources import accounts
from .sources import days as D
from .sources import lines as L
from .sources import sessions as S
from .sources.tables import read_table
from .streaming import streams


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    geo = read_table(spark, path=path)
    return geo.withColumns(geo_fields(F.col("text"))) if "text" in geo.columns else geo


def dimensions(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    """Geography and accounts; without an account file every account is unknown."""
    values = L.load_or_nothing(spark.read.format("text").schema(LINES), args.accounts, LINES)
    return read_geo(spark, args.geo), accounts.radius_sessions(values)


def minutes(spark, args) -> None:
    jobs.run_minutes(
        spark, args.root, *dimensions(spark, args), args.time, args.out, year=args.year,
        event_time=args.event_time, as_cells=args.cells,
    )


def delayed(spark, args) -> None:
    """The new backlog replaces the old one only after the batch has been written.

    A first run has no backlog, and without a settings table the default quota holds.
    """
    parquet = spark.read.format("parquet")
    backlog = L.load_or_nothing(parquet.schema(BACKLOG), args.backlog, BACKLOG)
    settings = L.load_or_nothing(parquet.schema(SETTINGS), args.settings, SETTINGS)
    left = jobs.run_delayed(
        spark, L.day_folders(args.root, args.time), backlog, settings, *dimensions(spark, args),
        args.time, args.out, args.max_files, year=args.year,
    )
    left.write.mode("overwrite").parquet(args.new_backlog)


def stream(spark, args) -> None:
    lines = L.stream_lines(
        spark, f"{args.root}/{args.folders}", args.max_file_age, maxBytesPerTrigger=args.max_bytes
    )
    running = streams.report_stream(
        lines, lambda: dimensions(spark, args), args.out, args.checkpoint,
        trigger=streams.ONCE if args.once else streams.EVERY_SLOT, year=args.year,
    )
    running.awaitTermination()


def backfill(spark, args) -> None:
    jobs.run_backfill(
        L.read_arrivals(spark, args.root), *dimensions(spark, args), args.start, args.end,
        args.out, args.year,
    )


def day(spark, args) -> None:
    subscribers = read_table(spark, path=args.subscribers)
    daily.run_day(spark, args.batches, subscribers, args.time, args.out)


def targets(spark, args) -> None:
    daily.run_target_places(spark, args.batches, read_geo(spark, args.geo), args.time, args.out)


def trace(spark, args) -> None:
    """Shows the first rows, or those after ``--after``, and the cursor to go on from.

    ``--out`` gets all that were found.
    """
    after = S.Cursor(*args.after.split("/")) if args.after else None
    if args.compacted:
        days = D.Days.open(spark, args.store, args.compacted, args.days)
        stored = days.by_key()
    else:
        stored = S.read_store(spark, args.store, args.days)
    column, _, value = (args.where or "").partition("=")
    if args.endpoint:
        ip, port = args.endpoint.rsplit(":", 1)
        found = (days if args.compacted else S).trace_endpoint(*([] if args.compacted else [stored]), ip, port, args.start, args.end)
    elif args.compacted and column in D.INDEXED:
        values = tuple(value.split(",")) if column == D.ENDPOINTS else value
        found = days.trace_value(column, values, args.n, after)
    elif args.where:
        found = S.trace_value(stored, column, value, args.n, after)
    elif args.compacted:
        found = days.trace_time(args.start, args.end, args.n, after)
    else:
        found = S.trace_time(stored, args.start, args.end, args.n, after)
    if args.out:
        save_table(found, path=args.out)
        found = read_table(spark, path=args.out).orderBy("rowkey", "dt")
    found.show(args.n, truncate=False)
    last = S.cursor_of(found.limit(args.n))
    if last:
        print(f"go on with --after {last.rowkey}/{last.dt}")


# Arguments of each job: name and whether it is a time.
ARGUMENTS = {
    minutes: ["root", "geo", "accounts", "time", "out"],
    delayed: ["root", "geo", "accounts", "backlog", "new-backlog", "settings", "time", "out"],
    stream: ["root", "geo", "accounts", "checkpoint", "out"],
    backfill: ["root", "geo", "accounts", "start", "end", "out"],
    day: ["batches", "subscribers", "time", "out"],
    targets: ["batches", "geo", "time", "out"],
    trace: ["store"],
}
TIMES = {"time", "start", "end"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="edgeledger", description=__doc__)
    names = top.add_subparsers(required=True)
    for job, needed in ARGUMENTS.items():
        sub = names.add_parser(job.__name__)
        sub.set_defaults(job=job)
        for name in needed:
            kind = datetime.fromisoformat if name in TIMES else str
            sub.add_argument(f"--{name}", required=True, type=kind)
        sub.add_argument("--year", type=int, help="year of times without one; else the one nearest to the batch")
        sub.add_argument("--zone", default="UTC", help="time zone of log times, folders and batch times")
        if job is minutes:
            sub.add_argument("--event-time", action="store_true")
            sub.add_argument("--cells", action="store_true")
        if job is delayed:
            sub.add_argument("--max-files", type=int, help="files of a batch beside the quota of size; others wait")
        if job is stream:
            sub.add_argument("--once", action="store_true", help="read what is there and end")
            sub.add_argument("--max-bytes", default=str(40 << 30), help="input quota of a batch")
            sub.add_argument("--max-file-age", default="3650d", help="older files are not read")
            sub.add_argument("--folders", default="*/*/*", help="pattern of the folders to list, as 2024*/*/*")
        if job is trace:
            sub.add_argument("--endpoint", help="ip:port")
            sub.add_argument("--compacted", help="whole days that the day job has folded")
            sub.add_argument("--out", help="where to write all found rows")
            sub.add_argument("--days", nargs="+", help="days of the store to look at, as yyyyMMdd")
            sub.add_argument("--where", help="column=value; with folded days also endpoints=ip,port,public ip,public port")
            sub.add_argument("--start", type=datetime.fromisoformat, default=datetime(1970, 1, 1))
            sub.add_argument("--end", type=datetime.fromisoformat, default=datetime(2100, 1, 1))
            sub.add_argument("-n", type=int, default=S.PAGE, help="rows of a page")
            sub.add_argument("--after", help="rowkey/day of the last row of the page before")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    zone = {"spark.sql.session.timeZone": args.zone}
    args.job(spark or build_session(f"edgeledger-{args.job.__name__}", **zone), args)


if __name__ == "__main__":
    main()
