"""The session store, and traces in it.

The store has one partition per day and batch. Batches only add; where a row key is
in several batches of a day, the newest one holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.net import endpoint_hash, reversed_millis
from ..functions.times import moment
from ..schemas import FLOWS
from ..session import settle
from .lines import load_or_nothing

STORE_COLUMNS = FLOWS.fieldNames()
PAGE = 11
KEY_COLUMNS = {"rowkey", "convertedIp", "convertedPort", "accesstime"}


STORED = T.StructType(
    [*FLOWS, T.StructField("dt", T.StringType()), T.StructField("batch", T.StringType())]
)
#: The files of the store; rows of a folder that holds a range of batches have their own batch in ``slot``.
STORE_FILES = T.StructType([*FLOWS, T.StructField("slot", T.StringType()), *STORED[-2:]])


@dataclass(frozen=True)
class Cursor:
    """The last row of a page; the next page begins after it."""

    rowkey: str
    dt: str


def read_store(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """Stored rows with ``dt`` and ``batch``; with ``days`` only their folders are listed."""
    return read_folders(spark, path, path if days is None else f"{path}/dt={{{','.join(days)}}}").drop("folder")


def read_folders(spark: SparkSession, path: str, folders: str) -> DataFrame:
    """Stored rows below some folders, with ``dt``, their ``batch``, and the ``folder`` of a day they are in."""
    reader = spark.read.format("parquet").schema(STORE_FILES).option("basePath", path)
    rows = load_or_nothing(reader, folders, STORE_FILES)
    batch = F.coalesce("slot", "batch")
    return rows.select(*STORE_COLUMNS, "dt", batch.alias("batch"), F.col("batch").alias("folder"))


def days_between(first: datetime, last: datetime) -> list[str]:
    """Store days from ``first`` to ``last`` inclusive."""
    n = (last.date() - first.date()).days + 1
    return [f"{first + timedelta(days=i):%Y%m%d}" for i in range(n)]


def newest_batches(stored: DataFrame) -> DataFrame:
    """One row per day and row key, that of the newest batch, with its ``batch`` and, if there is one, ``folder``."""
    others = [c for c in STORE_COLUMNS if c != "rowkey"]
    places = [c for c in ("batch", "folder") if c in stored.columns]
    latest = stored.groupBy("dt", "rowkey").agg(F.max(F.struct("batch", *others, *places[1:])).alias("_row"))
    return latest.select("dt", *[f"_row.{c}" for c in places], *[f"_row.{c}" if c != "rowkey" else c for c in STORE_COLUMNS])


def newest(stored: DataFrame) -> DataFrame:
    """One row per day and row key: that of the newest batch.

    Filters on ``dt`` or ``rowkey`` reach the files; put others on the result.
    """
    return newest_batches(stored).drop("batch", "folder")


def in_time(start, end) -> Column:
    """``start <= accesstime < end``."""
    at = F.col("accesstime")
    return (at >= moment(start)) & (at < moment(end))


def since(stored: DataFrame, start) -> DataFrame:
    """The days that can hold sessions from ``start`` on: a session is stored on its own day
    or later, or a day before if the clock of its device is ahead."""
    day = F.date_format(F.date_sub(moment(start).cast("date"), 1), "yyyyMMdd")
    return stored.where(F.col("dt") >= day)


def newest_where(stored: DataFrame, test: Column, on_key: bool) -> DataFrame:
    """Newest rows of the store that meet ``test``.

    A row key fixes the public endpoint and the time. A test of these alone
    (``on_key``) reaches the files. Other columns may change from batch to batch:
    the keys that ever met the test are looked up, and their newest rows are tested.
    """
    met = stored.where(test)
    if on_key:
        return newest(met)
    keys = met.select("dt", "rowkey").distinct()
    return newest(stored.join(keys, ["dt", "rowkey"], "left_semi")).where(test)


def trace_time(stored: DataFrame, start, end, n: int = PAGE, after: Cursor | None = None) -> DataFrame:
    """First ``n`` stored sessions by row key with ``start <= time < end``, or the next ``n`` after a cursor."""
    inside = from_cursor(since(stored, start), after)
    return page(newest_where(inside, in_time(start, end), on_key=True), n, after)


def trace_value(stored: DataFrame, column: str, value: str, n: int = PAGE, after: Cursor | None = None) -> DataFrame:
    """First ``n`` stored sessions by row key with one value in one column, or the next ``n`` after a cursor."""
    test = F.col(column) == value
    return page(newest_where(from_cursor(stored, after), test, column in KEY_COLUMNS), n, after)


def endpoint_keys(ip: str, port: str, start, end) -> Column:
    """Row keys of a public endpoint with ``start <= time < end``, as one range of keys."""
    prefix = endpoint_hash(F.lit(ip), F.lit(port))
    newest_key = F.concat_ws("_", prefix, reversed_millis(moment(end)))
    oldest_key = F.concat_ws("_", prefix, reversed_millis(moment(start)))
    return (F.col("rowkey") > newest_key) & (F.col("rowkey") <= oldest_key)


def trace_endpoint(stored: DataFrame, ip: str, port: str, start, end) -> DataFrame:
    """All stored sessions of a public endpoint in a time range, newest first."""
    found = newest_where(since(stored, start), endpoint_keys(ip, port, start, end), on_key=True)
    return found.orderBy("rowkey")


def from_cursor(rows: DataFrame, after: Cursor | None) -> DataFrame:
    """Rows at or after a cursor's key; the bound is on the key alone and reaches the files."""
    return rows if after is None else rows.where(F.col("rowkey") >= after.rowkey)


def beyond(sessions: DataFrame, after: Cursor | None) -> DataFrame:
    """The rows that come after a cursor."""
    if after is None:
        return sessions
    key, dt = F.col("rowkey"), F.col("dt")
    return from_cursor(sessions, after).where((key > after.rowkey) | (dt > after.dt))


def page(sessions: DataFrame, n: int, after: Cursor | None = None) -> DataFrame:
    """The first ``n`` rows in order of row key and day, or the next ``n`` after a cursor."""
    return beyond(sessions, after).orderBy("rowkey", "dt").limit(n)


def pages(sessions: DataFrame, n: int, after: Cursor | None = None) -> DataFrame:
    """All pages of ``n`` rows from a cursor on, each begun where the one before ended, with their number in ``page``.

    The rows are put in order once, in the shared folder; a row's place is the number of rows in the tasks before its own and
    its place there, so the work grows with the rows and not with the pages.
    """
    at, bits = F.col("_at"), 33  # the task, and the row in the task
    ordered = settle(beyond(sessions, after).orderBy("rowkey", "dt").withColumn("_at", F.monotonically_increasing_id()))
    tasks = ordered.groupBy(F.shiftright(at, bits).alias("_task")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = ordered.withColumn("_task", F.shiftright(at, bits)).join(before, "_task")
    place = F.col("_before") + at.bitwiseAND((1 << bits) - 1)
    return placed.withColumn("page", F.floor(place / n).cast("long")).drop("_task", "_before", "_at")


def cursor_of(page: DataFrame) -> Cursor | None:
    """The cursor after a page; none after an empty one."""
    last = page.select("rowkey", "dt").orderBy(F.desc("rowkey"), F.desc("dt")).first()
    return last and Cursor(last.rowkey, last.dt)
