"""Raw log lines from folders."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import SLOT_SECONDS, minus_seconds, moment, whole
from ..schemas import LINES

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)

# Layouts of a folder tree by minute: the loggers' own and the partitioned one of
# this library's writers.
PLAIN = "%Y%m%d/%H/%M"
PARTITIONED = "dt=%Y%m%d/hh=%H/mm=%M"


def minute_folders(batch_time: datetime, n: int = 5, layout: str = PLAIN) -> list[str]:
    """Folders of the ``n`` minutes before ``batch_time``, oldest first."""
    return [(batch_time - timedelta(minutes=i)).strftime(layout) for i in range(n, 0, -1)]


def day_folders(root: str, batch_time: datetime) -> str:
    """The folders of the day that a batch covers and of the day before, as one pattern.

    A file under the folder of a day may be finished after midnight.
    """
    day = batch_time - timedelta(seconds=SLOT_SECONDS)
    return f"{root}/{{{day - timedelta(days=1):%Y%m%d},{day:%Y%m%d}}}"


def literal(path: str) -> str:
    """A path that is read by its name, whatever characters of patterns it holds."""
    return re.sub(r"([{}\[\]*?\\,])", r"\\\1", path)


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many files or folders, by their names, as one input; nothing for no path."""
    if not paths:
        return spark.createDataFrame([], LINES)
    return spark.read.schema(LINES).text([literal(path) for path in paths])


def read_minutes(
    spark: SparkSession, root: str, batch_time: datetime, n: int = 5, layout: str = PLAIN
) -> DataFrame:
    """Lines of the minute folders before a batch time; missing folders are skipped."""
    glob = "{" + ",".join(minute_folders(batch_time, n, layout)) + "}"
    return load_or_nothing(spark.read.format("text").schema(LINES), f"{root}/{glob}", LINES)


def load_or_nothing(reader: DataFrameReader, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` from a path, or no rows if nothing is there."""
    try:
        return reader.load(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return SparkSession.getActiveSession().createDataFrame([], schema)


def modified_within(end: datetime, seconds: int = SLOT_SECONDS):
    """``end - seconds <= modification time < end`` of a file, as a filter on its metadata."""
    changed = F.col("_metadata.file_modification_time")
    return (changed >= minus_seconds(moment(end), seconds)) & (changed < moment(end))


def read_modified(
    spark: SparkSession, root: str, end: datetime, seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Lines of files below ``root`` changed in the time before ``end``.

    The filter is on file metadata, so other files are dropped from the listing
    and never opened.
    """
    lines = spark.read.schema(LINES).option("recursiveFileLookup", True).text(root)
    return lines.where(modified_within(end, seconds)).select("value")


def read_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """``(arrival, value)`` of all lines below ``root``; arrival is the change time of the file.

    A filter on ``arrival`` drops files from the listing.
    """
    lines = spark.read.schema(LINES).option("recursiveFileLookup", True).text(root)
    return lines.select(F.col("_metadata.file_modification_time").alias("arrival"), "value")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, size_mb, mtime, backlog)`` of the files below a folder or pattern; sizes in whole MB."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = load_or_nothing(reader, root, FILES)
    return files.select(
        "path",
        whole(F.col("length"), 1024 * 1024).alias("size_mb"),
        F.col("modificationTime").alias("mtime"),
        F.lit(False).alias("backlog"),
    )


def stream_lines(
    spark: SparkSession, glob: str, max_file_age: str = "3650d", **options
) -> DataFrame:
    """Lines as new files arrive; ``maxBytesPerTrigger`` is the input quota of one batch.

    Files that are older than the newest one by ``max_file_age`` are left out, so it is
    far above any lateness; Spark's own seven days would drop late files without a word.
    """
    reader = spark.readStream.schema(LINES).option("maxFileAge", max_file_age)
    return reader.options(**options).text(glob)


#: Scheme and host of a path.
STORE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"


def plain_path(path):
    """A path without scheme and host, for comparing listings with stored paths."""
    return F.regexp_replace(path, STORE, "")


def manifest(
    spark: SparkSession, days: str, backlog: DataFrame, batch_time, seconds: int = SLOT_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """Files of a batch, one row for each path, and the backlog paths that are gone.

    Files below ``days`` that changed in the time before the batch are new. Backlog files
    are looked up where they were; one that is there stands with its present size. ``outside``
    is how many files of the same folder aren't of the batch, or changed after it.
    """
    kept = backlog.select(plain_path(F.col("path")).alias("_plain")).distinct()
    folder = F.regexp_replace(plain_path(F.col("path")), "/[^/]*$", "")
    store = F.regexp_extract("path", STORE, 0)
    there, folders = list_files(spark, days), {}
    for row in backlog.select(store.alias("store"), folder.alias("folder")).distinct().toLocalIterator():
        folders.setdefault(row.store, []).append(literal(row.folder.lstrip("/")))
    for root, names in folders.items():
        for at in range(0, len(names), 500):
            there = there.unionByName(list_files(spark, f"{root}/{{{','.join(names[at : at + 500])}}}"))
    plain = plain_path(F.col("path"))
    there = there.withColumn("_plain", plain).dropDuplicates(["_plain"]).drop("backlog")
    marked = there.join(kept.withColumn("backlog", F.lit(True)), "_plain", "left")
    marked = marked.withColumn("backlog", F.coalesce("backlog", F.lit(False)))
    new = (F.col("mtime") >= minus_seconds(moment(batch_time), seconds)) & (F.col("mtime") < moment(batch_time))
    gone = kept.join(there, "_plain", "left_anti").select(F.col("_plain").alias("path"))
    placed = marked.withColumns({"_mine": F.col("backlog") | new, "_folder": folder_of(F.col("_plain"))})
    other = ~F.col("_mine") | (F.col("mtime") >= moment(batch_time))
    around = placed.groupBy("_folder").agg(F.sum(other.cast("long")).alias("outside"))
    return placed.where("_mine").join(around, "_folder").drop("_plain", "_mine", "_folder"), gone


def folder_of(path):
    return F.regexp_replace(path, "/[^/]*$", "")


def read_cover(spark: SparkSession, folders: list[str], files: list[str], end: datetime) -> DataFrame:
    """Lines of whole folders, but for files that came from ``end`` on, and of single files."""
    whole = read_paths(spark, folders)
    if folders:
        whole = whole.where(F.col("_metadata.file_modification_time") < moment(end)).select("value")
    return whole.union(read_paths(spark, files)) if files else whole
