"""Folded days of the session store, and traces that read only what they need of them.

A folded day holds the sessions of a day three times, each copy in an order of its own:

- by row key, in a folder for each key range: for a public endpoint, and for keys that are known;
- by time, in a folder for each hour: for a range of times;
- as an index from the values of some columns to row keys, in a folder for each column and range of hashes.

Rows keep the batch they came from. The files of the store that went into a day are listed beside it, so a reader
knows, from one listing and one join, which batches came, changed or went since. New batches are read
from the store beside the folded rows; a changed one makes the store hold for its day, but for batches that it no
longer has.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.net import endpoint_hash, half_md5, part_key, region_of
from ..functions.times import moment
from ..schemas import FLOWS
from .lines import load_or_nothing
from .sessions import (
    PAGE,
    Cursor,
    endpoint_keys,
    in_time,
    newest,
    page,
    pages,
    read_folders,
)

REGIONS = 20
#: Layouts beside the rows by key; readers of rows skip folders that begin with an underscore.
FILES_FOLDER, TIME_FOLDER, INDEX_FOLDER = "_folded", "_by_time", "_index"
#: The index of both outer endpoints together, beside those of single columns.
ENDPOINTS = "endpoints"
INDEXED = ("sourceIp", "convertedIp", "username", ENDPOINTS)
INDEX_PARTS = 16
#: The hour folder of sessions whose time is not near their day.
OTHER_HOUR = "other"

FILE_LIST = T.StructType(
    [
        T.StructField("batch", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("size", T.LongType()), T.StructField("written", T.LongType()),
        T.StructField("dt", T.StringType()),
    ]
)
#: A row's batch, and the folder of its day in the store that it came from.
_KEY = [*FLOWS, *(T.StructField(c, T.StringType()) for c in ("batch", "folder", "dt"))]
_ROWS = T.StructType(_KEY)
BY_KEY = T.StructType([*_KEY, T.StructField("region", T.IntegerType())])
BY_TIME = T.StructType([*_KEY, T.StructField("hour", T.StringType())])
INDEX = T.StructType(
    [
        T.StructField("hash", T.StringType()), T.StructField("rowkey", T.StringType()),
        T.StructField("dt", T.StringType()), T.StructField("column", T.StringType()),
        T.StructField("part", T.IntegerType()),
    ]
)


def _days(days: list[str] | None) -> str:
    return "dt=*" if days is None else f"dt={{{','.join(days)}}}"


def _files(spark: SparkSession, root: str, folders: str) -> DataFrame:
    listed = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType())])
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return load_or_nothing(reader, f"{root}/{folders}", listed)


def store_files(spark: SparkSession, store: str, days: list[str] | None = None) -> DataFrame:
    """``batch, name, size, written, dt`` of the files of the store; folders are listed, no file is opened."""
    part = lambda k: F.element_at(F.split("path", "/"), k)
    return _files(spark, store, _days(days)).select(
        part(-2).alias("batch"), part(-1).alias("name"), F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("written"), F.replace(part(-3), F.lit("dt="), F.lit("")).alias("dt"),
    ).withColumn("batch", F.replace("batch", F.lit("batch="), F.lit("")))


def folded_files(spark: SparkSession, folded: str, days: list[str] | None = None) -> DataFrame:
    """What ``store_files`` gave for each day when it was folded."""
    reader = spark.read.schema(FILE_LIST).format("parquet").option("basePath", f"{folded}/{FILES_FOLDER}")
    return load_or_nothing(reader, f"{folded}/{FILES_FOLDER}/{_days(days)}", FILE_LIST)


@dataclass(frozen=True)
class Day:
    """How a day stands: its folders of batches that are new in the store, changed there, and gone, since it was folded."""

    dt: str
    folded: bool
    added: tuple[str, ...] = ()
    changed: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()


def days_of(spark: SparkSession, store: str, folded: str, days: list[str] | None = None) -> list[Day]:
    """One entry for each day of the store or of the folded days, from two listings and one join."""
    files = F.sort_array(F.collect_list(F.struct("name", "size", "written")))
    per_batch = lambda listed, name: listed.groupBy("dt", "batch").agg(files.alias(name))
    now, then = per_batch(store_files(spark, store, days), "now"), per_batch(folded_files(spark, folded, days), "then")
    both = now.join(then, ["dt", "batch"], "full")
    of = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("batch"))))
    added, gone = F.col("then").isNull(), F.col("now").isNull()
    per_day = both.groupBy("dt").agg(
        F.max(~added).alias("folded"), of(added).alias("added"), of(F.col("now") != F.col("then")).alias("changed"), of(gone).alias("gone")
    )
    return sorted((Day(r.dt, r.folded, tuple(r.added), tuple(r.changed), tuple(r.gone)) for r in per_day.collect()), key=lambda d: d.dt)


def _either(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))


@dataclass(frozen=True)
class Days:
    """The sessions of a store and of its folded days; what a day needs is looked up once."""

    spark: SparkSession
    store: str
    folded: str
    state: list[Day] = field(default_factory=list)

    @classmethod
    def open(cls, spark: SparkSession, store: str, folded: str, days: list[str] | None = None) -> Days:
        return cls(spark, store, folded, days_of(spark, store, folded, days))

    def since(self, start) -> Days:
        """The days that can hold sessions from ``start`` on, as ``sessions.since`` has it."""
        at = datetime.fromisoformat(start) if isinstance(start, str) else start
        first = "00000000" if at.date() == date.min else f"{at.date() - timedelta(days=1):%Y%m%d}"
        return Days(self.spark, self.store, self.folded, [d for d in self.state if d.dt >= first])

    def unfolded(self) -> DataFrame:
        """Rows that only the store has or that hold there; folders of other days and batches aren't listed."""
        whole = [f"dt={d.dt}" for d in self.state if not d.folded or d.changed]
        parts = [f"dt={d.dt}/batch={b}" for d in self.state if d.folded and not d.changed for b in d.added]
        if not whole + parts:
            return self.spark.createDataFrame([], _ROWS)
        return read_folders(self.spark, self.store, f"{self.store}/{{{','.join(whole + parts)}}}")

    def _valid(self) -> Column:
        """Which folded rows hold."""
        whole = [d.dt for d in self.state if d.folded and not d.changed]
        parts = [(F.col("dt") == d.dt) & F.col("folder").isin(*d.gone) for d in self.state if d.folded and d.changed and d.gone]
        return _either(([F.col("dt").isin(*whole)] if whole else []) + parts)

    def _layout(self, folder: str, schema: T.StructType) -> DataFrame:
        days = [d.dt for d in self.state if d.folded]
        if not days:
            return self.spark.createDataFrame([], schema)
        root = f"{self.folded}/{folder}".rstrip("/")
        reader = self.spark.read.format("parquet").schema(schema).option("basePath", root)
        return load_or_nothing(reader, f"{root}/{_days(days)}", schema)

    def by_key(self, test: Column | None = None) -> DataFrame:
        """All rows with ``dt`` and ``batch``; ``test`` may use ``region`` and the row key."""
        kept = self._layout("", BY_KEY).where(self._valid())
        kept = kept if test is None else kept.where(test)
        return self.unfolded().unionByName(kept.drop("region"))

    def by_time(self, start, end) -> DataFrame:
        """Rows with ``start <= accesstime < end``; of folded days only the folders of these hours are read."""
        hour = lambda at: F.date_format(moment(at), "yyyyMMddHH")
        inside = F.col("hour").between(hour(start), hour(end)) | (F.col("hour") == OTHER_HOUR)
        kept = self._layout(TIME_FOLDER, BY_TIME).where(self._valid() & inside).drop("hour")
        return self.unfolded().unionByName(kept).where(in_time(start, end))

    def trace_time(self, start, end, n: int = PAGE, after: Cursor | None = None) -> DataFrame:
        """The page of sessions with ``start <= time < end`` that comes after ``after``, by row key."""
        return page(newest(self.since(start).by_time(start, end)), n, after)

    def trace_pages(self, start, end, n: int = PAGE, after: Cursor | None = None) -> DataFrame:
        """All pages that ``trace_time`` gives from ``after`` on, with their number in ``page``; files are read once."""
        return pages(newest(self.since(start).by_time(start, end)), n, after)

    def trace_endpoint(self, ip: str, port: str, start, end) -> DataFrame:
        """All sessions of a public endpoint in a time range, newest first, from the one key range that can hold them."""
        region = F.col("region") == region_of(endpoint_hash(F.lit(ip), F.lit(port)), REGIONS)
        inside = endpoint_keys(ip, port, start, end)
        return newest(self.since(start).by_key(region & inside).where(inside)).orderBy("rowkey")

    def _index_keys(self, column: str, hashed: Column) -> DataFrame:
        """``dt, rowkey`` that the index has for a value."""
        asked = (F.col("column") == column) & (F.col("part") == index_part(hashed)) & (F.col("hash") == hashed)
        return self._layout(INDEX_FOLDER, INDEX).where(asked).select("dt", "rowkey")

    def trace_value(self, column: str, value: str | tuple[str, ...], n: int = PAGE, after: Cursor | None = None) -> DataFrame:
        """The page of sessions with one value in an indexed column that comes after ``after``, by row key.

        ``endpoints`` takes target address and port and public address and port. Keys come from the index and, for
        days that aren't folded, from the store; so many of them are looked up as make a page, in the
        key ranges that hold them. A key whose newest row has another value by now doesn't count, and
        the next ones are looked up in its place.
        """
        if column not in INDEXED:
            raise ValueError(f"no index of {column}; there is one of {', '.join(INDEXED)}")
        texts = [value] if isinstance(value, str) else list(value)
        test, hashed = indexed_test(column, texts), index_hash(column, [F.lit(t) for t in texts])
        keys = self._index_keys(column, hashed).unionByName(self.unfolded().where(test).select("dt", "rowkey")).distinct()
        wanted, at = [], after
        while True:
            more = page(keys, n, at).select("dt", "rowkey").collect()
            wanted += [(r.dt, r.rowkey) for r in more]
            found = newest(self._rows_of(wanted)).where(test)
            if len(more) < n or found.count() >= n:
                return page(found, n, after)
            at = Cursor(more[-1].rowkey, more[-1].dt)

    def _rows_of(self, keys: list[tuple[str, str]]) -> DataFrame:
        """Rows of known days and keys, from the days and key ranges that hold them."""
        if not keys:
            return self.spark.createDataFrame([], _ROWS)
        days = {dt for dt, _ in keys}
        some = Days(self.spark, self.store, self.folded, [d for d in self.state if d.dt in days])
        by_region: dict[int, list[str]] = {}
        for _, key in keys:
            by_region.setdefault(int(key[:8], 16) * REGIONS >> 32, []).append(key)
        spans = _either([F.col("rowkey").between(min(k), max(k)) for k in by_region.values()])
        rows = some.by_key(F.col("region").isin(*by_region) & spans).where(spans)
        return rows.where(_exactly(keys))


def _exactly(keys: list[tuple[str, str]]) -> Column:
    """Whether a row is one of many, day by day."""
    days: dict[str, list[str]] = {}
    for dt, key in keys:
        days.setdefault(dt, []).append(key)
    return _either([(F.col("dt") == dt) & F.col("rowkey").isin(*of) for dt, of in days.items()])


def read_days(spark: SparkSession, store: str, folded: str, days: list[str] | None = None) -> DataFrame:
    """All rows of the store and of its folded days, with ``dt`` and ``batch``."""
    return Days.open(spark, store, folded, days).by_key()


def index_hash(column: str, values: list[Column]) -> Column:
    """What the index has for the value of a column, or for the four of ``endpoints``."""
    return part_key(*values) if column == ENDPOINTS else half_md5(values[0])


def index_part(hashed: Column) -> Column:
    return region_of(hashed, INDEX_PARTS)


def indexed_columns(column: str) -> list[str]:
    return ["targetIp", "targetPort", "convertedIp", "convertedPort"] if column == ENDPOINTS else [column]


def indexed_test(column: str, values: list[str]) -> Column:
    names = indexed_columns(column)
    if len(names) != len(values):
        raise ValueError(f"{column} takes {len(names)} values")
    return reduce(Column.__and__, [F.col(c) == v for c, v in zip(names, values)])


def index_rows(rows: DataFrame) -> DataFrame:
    """``hash, rowkey, dt, column, part`` of all indexed columns of folded rows; null values have no entry."""
    entry = lambda c: F.struct(F.lit(c).alias("column"), index_hash(c, [F.col(k) for k in indexed_columns(c)]).alias("hash"))
    spread = rows.select("dt", "rowkey", F.explode(F.array(*map(entry, INDEXED))).alias("_entry"))
    named = spread.select("_entry.hash", "rowkey", "dt", "_entry.column").where(F.col("hash").isNotNull())
    return named.withColumn("part", index_part(F.col("hash")))


def hour_of(at: Column, dt: Column) -> Column:
    """The hour folder of a session: its hour, if that is from two days before its day to the day after."""
    apart = F.datediff(at.cast("date"), F.to_date(dt, "yyyyMMdd"))
    return F.when(apart.between(-2, 1), F.date_format(at, "yyyyMMddHH")).otherwise(F.lit(OTHER_HOUR))
