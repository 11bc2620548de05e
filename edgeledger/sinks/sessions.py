"""The session store and the cell layout for bulk loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.net import region_of
from ..schemas import CELL_NAMES
from ..session import settling
from ..sources import days as D
from ..sources.days import REGIONS
from ..sources.sessions import STORE_COLUMNS, newest_batches
from .tables import add_partitions, replace_batch, replace_folder, replace_partitions, with_range


def by_region(sessions: DataFrame, regions: int = REGIONS) -> DataFrame:
    """Even ranges of row keys, one task each, sorted by row key.

    There are as many tasks as the session shuffles to, in whole multiples of
    ``regions``, so that no task spans two regions. The range is a function of the
    hashed key and needs no sampling, and distinct keys bound an endpoint to one
    row per second.
    """
    wanted = int(sessions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = regions * max(1, -(-wanted // regions))
    part = region_of(F.col("rowkey"), tasks)
    return sessions.repartitionById(tasks, part).sortWithinPartitions("rowkey")


def upsert_sessions(
    sessions: DataFrame, path: str, batch_time, regions: int = REGIONS, number: int | None = None
) -> None:
    """Add a batch of distinct sessions; a later batch holds where row keys meet.

    Nothing of other batches is read or rewritten. A second run replaces the first.
    """
    replace_batch(by_region(sessions.select(*STORE_COLUMNS), regions), path, batch_time, number)


def add_session_range(sessions: DataFrame, path: str, start: datetime, end: datetime) -> None:
    """``upsert_sessions`` for the batches of a range, by their ``batch`` time, which have been cleared.

    A day's rows go to as many tasks as their size asks for.
    """
    rows = with_range(sessions.select("batch", *STORE_COLUMNS), start, end)
    placed = rows.hint("rebalance", "dt", "batch").sortWithinPartitions("dt", "batch", "rowkey")
    add_partitions(placed, path, ["dt", "batch"])


def compact_day(spark: SparkSession, path: str, target: str, dt: str) -> None:
    """Fold a day of the store: the newest row of each key, by key, by time and with an index.

    Only what is new is folded: rows of batches that came since are added to the day's folders, and a day to which
    nothing came is left alone. If a batch changed, the day is written anew, with the folded
    rows of batches that the store no longer has. Files are listed before they are read, so a batch that comes in
    between is new the next time; their list is written last, so a fold that was cut short is done again, and rows
    that are then there twice count once.
    """
    days = D.Days.open(spark, path, target, [dt])
    day = days.state[0] if days.state else D.Day(dt, False)
    if day.folded and not day.added and not day.changed:
        return
    listed = {tuple(r) for r in D.store_files(spark, path, [dt]).collect()}
    earlier = {tuple(r) for r in D.folded_files(spark, target, [dt]).where(F.col("batch").isin(*day.gone)).collect()} if day.gone else set()
    again = not day.folded or bool(day.changed)
    with settling(spark) as settled:
        rows = settled(by_region(newest_batches(days.by_key() if again else days.unfolded())))
        keyed = rows.withColumn("region", region_of(F.col("rowkey"), REGIONS)).sortWithinPartitions("dt", "region", "rowkey")
        timed = rows.withColumn("hour", D.hour_of(F.col("accesstime"), F.col("dt"))).hint("rebalance", "dt", "hour")
        index = D.index_rows(rows).hint("rebalance", "dt", "column", "part")
        layouts = [
            ("", ["dt", "region"], keyed),
            (f"/{D.TIME_FOLDER}", ["dt", "hour"], timed.sortWithinPartitions("dt", "hour", "accesstime")),
            (f"/{D.INDEX_FOLDER}", ["dt", "column", "part"], index.sortWithinPartitions("dt", "column", "part", "hash")),
        ]
        for folder, keys, written in layouts:
            if again:
                replace_folder(written, f"{target}{folder}", f"dt={dt}", keys)
            else:
                add_partitions(written, f"{target}{folder}", keys)
    files = spark.createDataFrame(sorted(listed | earlier), D.FILE_LIST).coalesce(1)
    replace_partitions(files, f"{target}/{D.FILES_FOLDER}", ["dt"])


def to_cells(sessions: DataFrame, regions: int = REGIONS) -> DataFrame:
    """``(rowkey, qualifier, value)`` of distinct sessions, in order of key and qualifier.

    Sessions are put in order before they are taken apart, and the cells of one
    session come out in order of their names, so nine times fewer rows are moved.
    """
    text = F.date_format("accesstime", "yyyy-MM-dd HH:mm:ss")
    rows = by_region(sessions, regions).withColumn("accesstime", text)
    return rows.unpivot(["rowkey"], CELL_NAMES, "qualifier", "value")


def write_cells(cells: DataFrame, path: str, batch_time, number: int | None = None) -> None:
    """Cells of a batch; each file is sorted, and later files hold later keys."""
    replace_batch(cells, path, batch_time, number)
