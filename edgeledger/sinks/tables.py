"""Report, counter and daily tables as partitioned files."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import SLOT_SECONDS, minus_seconds, moment
from ..session import matching, move, remove

BATCH = "yyyyMMddHHmm"
DAY = "yyyyMMdd"
#: Between the first and the last batch in the name of a folder that holds several.
RANGE = "+"
#: The folders of account counts have hour and minute as well.
USER_CLOCK = "/hh=%H/mm=%M"


def batch_slot(batch_time) -> Column:
    """Start of the five minutes that a batch covers; names its day and batch."""
    return minus_seconds(moment(batch_time), SLOT_SECONDS)


def replace_partitions(rows: DataFrame, path: str, keys: list[str], fmt: str = "parquet", **options):
    """Write ``rows`` and replace just the partitions they are in."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**options).partitionBy(*keys).format(fmt).save(path)


def add_partitions(rows: DataFrame, path: str, keys: list[str], fmt: str = "parquet", **options) -> None:
    """Write ``rows`` beside what is in their partitions."""
    rows.write.mode("append").options(**options).partitionBy(*keys).format(fmt).save(path)


def replace_folder(rows: DataFrame, path: str, folder: str, keys: list[str]) -> None:
    """Write ``rows``, all of one first partition, aside and put that folder in the place of the old one.

    Partitions that have no rows now are gone with it. Rows may come from the old folder if they are settled.
    """
    spark, aside = rows.sparkSession, f"{path}/_aside-{uuid.uuid4().hex}"
    rows.write.partitionBy(*keys).parquet(aside)
    remove(spark, f"{path}/{folder}")
    move(spark, f"{aside}/{folder}", f"{path}/{folder}")
    remove(spark, aside)


def batch_label(batch_time, number: int | None = None) -> Column:
    """Name of a batch; names sort by time. ``number`` tells micro-batches of one slot apart."""
    label = F.date_format(batch_slot(batch_time), BATCH)
    return label if number is None else F.concat(label, F.lit(f"-{number:09d}"))


def with_batch(rows: DataFrame, batch_time, number: int | None = None) -> DataFrame:
    """Adds the partition columns; ``batch_time`` may be a column of ``rows``."""
    day = F.date_format(batch_slot(batch_time), DAY)
    return rows.withColumns({"dt": day, "batch": batch_label(batch_time, number)})


def batch_folder(batch_time: datetime, number: int | None = None, clock: str = "") -> str:
    """The folder of one batch below a table, as ``partitionBy`` names it."""
    at = batch_time - timedelta(seconds=SLOT_SECONDS)
    label = f"{at:%Y%m%d%H%M}" + ("" if number is None else f"-{number:09d}")
    return f"dt={at:%Y%m%d}{at.strftime(clock)}/batch={label}"


def replace_batch(
    rows: DataFrame, path: str, batch_time, number: int | None = None, fmt: str = "parquet",
    clock: str = "",
) -> None:
    """Write the folder of one batch anew; a run without rows leaves none of an earlier run.

    A range that an earlier run wrote, and that holds the batch, is written anew without it.
    """
    if number is None:
        clear_ranges(rows.sparkSession, path, batch_time, fmt, clock)
    rows.write.mode("overwrite").format(fmt).save(f"{path}/{batch_folder(batch_time, number, clock)}")


def clear_ranges(spark: SparkSession, path: str, batch_time: datetime, fmt: str, clock: str) -> None:
    """Take one batch out of the ranges of its day."""
    at = batch_time - timedelta(seconds=SLOT_SECONDS)
    label, levels = f"{at:%Y%m%d%H%M}", "/*" * clock.count("/")
    for folder in matching(spark, f"{path}/dt={at:%Y%m%d}{levels}/batch=*{RANGE}*"):
        low, _, high = folder.rsplit("batch=", 1)[1].partition(RANGE)
        if low <= label <= high:
            _take_out(spark, folder, label, label, fmt)


def write_batch(rows: DataFrame, path: str, batch_time, number: int | None = None) -> None:
    """Replace a batch's report, counters or rejects."""
    replace_batch(rows.hint("rebalance"), path, batch_time, number)


def range_folder(first: Column, last: Column) -> Column:
    """Name of a folder that holds all batches from one to another; its rows have their batch in ``slot``."""
    return F.concat(first, F.lit(RANGE), last)


def with_range(rows: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Adds ``dt``, ``batch`` and ``slot`` to rows of the batches from ``start`` to ``end``, by their ``batch`` time.

    Batches of one day share a folder, so that a range of a month is 31 folders and not 8,928.
    """
    first, last = (F.lit(f"{at - timedelta(seconds=SLOT_SECONDS):%Y%m%d%H%M}") for at in (start, end))
    dated = with_batch(rows, F.col("batch")).withColumnRenamed("batch", "slot")
    day = [F.concat("dt", F.lit(clock)) for clock in ("0000", "2355")]
    return dated.withColumn("batch", range_folder(F.greatest(first, day[0]), F.least(last, day[1])))


def add_range(rows: DataFrame, path: str, start: datetime, end: datetime) -> None:
    """Write rows of the batches from ``start`` to ``end``, which have been cleared, by their ``batch`` time."""
    add_partitions(with_range(rows, start, end).hint("rebalance", "dt", "batch"), path, ["dt", "batch"])


def clear_batches(
    spark: SparkSession, path: str, start: datetime, end: datetime, clock: str = "", fmt: str = "parquet"
) -> None:
    """Delete all batches from ``start`` to ``end`` inclusive that are there, in folders of their own or of ranges.

    Days are listed once, and folders once for each day that is there. A day of which all goes is deleted as one
    folder, and a range that goes only in part is written anew without it. Micro-batches, which have a number, stay.
    """
    first, last = (f"{at - timedelta(seconds=SLOT_SECONDS):%Y%m%d%H%M}" for at in (start, end))
    levels = "/*" * clock.count("/")
    for day in matching(spark, f"{path}/dt=*"):
        if not first[:8] <= day.rsplit("=", 1)[1] <= last[:8]:
            continue
        folders = matching(spark, f"{day}{levels}/batch=*")
        going = []
        for folder in folders:
            low, _, high = folder.rsplit("batch=", 1)[1].partition(RANGE)
            high = high or low
            if "-" not in low and first <= low and high <= last:
                going.append(folder)
            elif low <= last and first <= high and "-" not in low:
                _take_out(spark, folder, first, last, fmt)
        for folder in [day] if len(going) == len(folders) else going:
            remove(spark, folder)


def _take_out(spark: SparkSession, folder: str, first: str, last: str, fmt: str) -> None:
    """Write the folder of a range anew without the batches from ``first`` to ``last``."""
    slot = F.col("slot") if fmt == "parquet" else F.substring("value", 1, len(first))
    aside = f"{folder.split('/dt=')[0]}/_aside-{uuid.uuid4().hex}"
    spark.read.format(fmt).load(folder).where(~slot.between(first, last)).write.format(fmt).save(aside)
    remove(spark, folder)
    move(spark, aside, folder)


def _tuples(users: DataFrame) -> Column:
    return F.concat(F.lit("("), F.col("username"), F.lit(","), F.col("count"), F.lit(")")).alias("value")


def write_user_counts(users: DataFrame, path: str, batch_time, number: int | None = None) -> None:
    """``(user,count)`` text lines under the day, hour and minute of the batch."""
    lines = users.select(_tuples(users)).hint("rebalance")
    replace_batch(lines, path, batch_time, number, "text", USER_CLOCK)


def add_user_counts(users: DataFrame, path: str, start: datetime, end: datetime) -> None:
    """``write_user_counts`` for the batches of a range: each line begins with its batch."""
    timed = with_range(users, start, end)
    rows = timed.select(
        F.concat("slot", F.lit(" "), _tuples(users)).alias("value"), "dt", F.lit("00").alias("hh"), F.lit("00").alias("mm"), "batch"
    )
    add_partitions(rows.hint("rebalance", "dt", "batch"), path, ["dt", "hh", "mm", "batch"], "text")


def write_day(rows: DataFrame, path: str, day, max_records: int = 500_000) -> None:
    """A daily table (activity, totals); no file holds more than ``max_records`` rows."""
    dated = rows.withColumn("dt", F.date_format(moment(day), DAY))
    replace_partitions(dated, path, ["dt"], maxRecordsPerFile=max_records)


def save_table(rows: DataFrame, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Any table, as ``read_table`` reads it."""
    rows.write.format(fmt).mode(mode).options(**options).save()


def append_jdbc(
    rows: DataFrame, url: str, table: str, properties: dict, tasks: int = 1, batch: int = 100_000
) -> None:
    """Append to a database table in ``tasks`` connections without a transaction."""
    writer = rows.write.mode("append").option("batchsize", batch)
    writer = writer.option("isolationLevel", "NONE").option("numPartitions", tasks)
    writer.jdbc(url, table, properties=properties)
