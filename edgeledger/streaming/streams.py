"""Streams over files of lines or sessions.

All sinks write one partition per micro-batch and replace it on a retry, so a
restart from the checkpoint leaves each batch once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import run_batch
from ..sinks.tables import replace_partitions
from ..sources.admission import sums_before
from ..sources.lines import plain_path

WATERMARK = "3 hours"
SLOT = "5 minutes"
STAMP = "yyyy-MM-dd HH:mm:ss"

EVERY_SLOT = {"processingTime": SLOT}
ONCE = {"availableNow": True}


def slot_counts(sessions: DataFrame, *keys: str) -> DataFrame:
    """Running counts per five-minute event slot and ``keys``.

    Rows from more than three hours before the newest event of earlier batches are
    left out, and finished slots leave the state.
    """
    slots = F.window("accesstime", SLOT)
    counted = sessions.withWatermark("accesstime", WATERMARK).groupBy(slots, *keys)
    return counted.agg(F.count(F.lit(1)).alias("count")).select(
        F.col("window.start").alias("accesstime"), *keys, "count"
    )


def distinct_stream(sessions: DataFrame) -> DataFrame:
    """First session of each row key while duplicates come within the watermark."""
    marked = sessions.withWatermark("accesstime", WATERMARK)
    return marked.dropDuplicatesWithinWatermark(["rowkey"])


def write_stream(
    rows: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Each micro-batch as one ``micro`` partition of a table."""

    def write(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("micro", F.lit(number)), path, ["micro"])

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or EVERY_SLOT)).start()


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Last value per key of a table written in update mode."""
    table = spark.read.parquet(path)
    return table.groupBy(*keys).agg(F.max_by("count", "micro").alias("count"))


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(path, micro)``: which micro-batch took each file, from the file source's log in a checkpoint."""
    logged = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId long")
    # Older entries are repeated where Spark has put its log files together.
    return logged.select(entry.alias("e")).groupBy("e.path").agg(F.min("e.batchId").alias("micro"))


def carry_over(files: DataFrame, taken: DataFrame) -> DataFrame:
    """``micro, files, bytes, files_left, bytes_left``: what each micro-batch took of ``files`` (``path, length``), and left.

    A file that came after a micro-batch counts as left by it.
    """
    sized = files.select(plain_path(F.col("path")).alias("path"), "length").join(
        taken.select(plain_path(F.col("path")).alias("path"), "micro"), "path", "left"
    )
    per = sized.where("micro is not null").groupBy("micro").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    own = {"_files": F.col("files"), "_bytes": F.col("bytes")}
    summed = sums_before(per, [F.asc("micro")], own)
    total = lambda c: files.agg(c).scalar()
    return summed.select(
        "micro", "files", "bytes",
        (total(F.count("*")) - F.col("_files") - F.col("files")).alias("files_left"),
        (total(F.sum("length")) - F.col("_bytes") - F.col("bytes")).alias("bytes_left"),
    )


def report_stream(
    lines: DataFrame,
    load_dimensions: Callable[[], tuple[DataFrame, DataFrame]],
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """The batch job for each micro-batch of lines; reports are event-time deltas.

    ``load_dimensions`` gives geography and accounts anew for each micro-batch. The
    batch time is the micro-batch's time in the checkpoint, which a retry keeps.
    """

    def run(batch: DataFrame, number: int) -> None:
        started = batch.select("_started").head()
        if started is None:
            return
        geo, accounts = load_dimensions()
        run_batch(
            batch.drop("_started"), geo, accounts, slot_end(started[0]), out,
            event_time=True, number=number, **options,
        )

    timed = lines.withColumn("_started", F.date_format(F.current_timestamp(), STAMP))
    writer = timed.writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(run).trigger(**(trigger or EVERY_SLOT)).start()


def slot_end(stamp: str) -> datetime:
    """The batch time of a run: the last full five minutes in the session time zone."""
    at = datetime.fromisoformat(stamp)
    return at.replace(minute=at.minute // 5 * 5, second=0)
