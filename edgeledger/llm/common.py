"""What the operators share: the shared folder, landed tables, row numbers, text columns."""

from __future__ import annotations

import string
import sys
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage go to the executors by value: these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules["edgeledger.llm"])

#: What separates words: a space and the control characters tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Rows that one Arrow batch holds at most, so that a batch of long texts stays small.
BATCH_ROWS = 256


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; on one machine, as in tests, a new one if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


class _Landed(threading.local):
    """The folders that this thread has landed: those of no scope, then those of each open scope, and those of stages."""

    def __init__(self):
        self.scopes, self.held = [[]], []


_landed = _Landed()


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what was landed inside; only tables landed with ``stays`` go to the scope around.

    What leaves the scope must not read a deleted table any more, so it is landed itself.
    """
    _landed.scopes.append([])
    try:
        yield
    finally:
        _delete(spark, _landed.scopes.pop())


def _folders_read(df: DataFrame) -> set[str]:
    """The names of the folders that ``df`` reads, from its plan: no files are listed."""
    leaves, names = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                names.update(relation.location().rootPaths().mkString("\n").split("\n"))
    return {name.rstrip("/").rsplit("/", 1)[-1] for name in names}


@contextmanager
def stage(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """One stage of a chain whose results are stored: what it lands is deleted when a later stage of this thread begins.

    A result is lazy, so what it reads has to last until it is stored. Folders that ``docs`` reads stay.
    """
    read = _folders_read(docs)
    gone = [folder for folder in _landed.held if folder.rsplit("/", 1)[-1] not in read]
    _landed.held = [folder for folder in _landed.held if folder not in gone]
    _delete(spark, gone)
    _landed.scopes.append([])
    try:
        yield
    finally:
        _landed.held += _landed.scopes.pop()


def land_at(df: DataFrame, name: str, stays: bool = False) -> str:
    """The folder in the shared folder to which ``df`` was written."""
    path = f"{shared_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    _landed.scopes[max(0, len(_landed.scopes) - 2) if stays else -1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return path


def land_for(df: DataFrame, name: str, readers: int, stays: bool = False) -> list[DataFrame]:
    """``df`` written once to the shared folder, and so many reads of it that can be joined with each other."""
    path = land_at(df, name, stays)
    return [df.sparkSession.read.schema(df.schema).parquet(path) for _ in range(readers)]


def land(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read from there, so that its lineage ends."""
    return land_for(df, name, 1, stays)[0]


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of the batches that go to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have; names are compared without case, as Spark does."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def slim(stored: DataFrame, row: str) -> DataFrame:
    """``row, doc_id, text`` (null: empty) of documents that ``numbered`` has stored."""
    return stored.select(F.col(row).alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` landed with a number for each row, and the name of that column.

    The number tells repeated and null ids apart and stays the same however often the table is read.
    """
    row = free_name(docs, "row")
    return land(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Texts of ASCII alone take the quick way."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids count as the text ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod).cast("int")


def bounded_sample(df: DataFrame, rows: int, key: str, *others: str) -> DataFrame:
    """At most ``rows`` rows of ``df``: those whose ``key`` has the least hash, however large the table is.

    The greatest hash that still counts is found from the keys alone, so that Spark can filter by it before
    joins and all tasks share the rows. Rows that repeat a key have one hash; only if they go beyond
    ``rows`` are they put in order, by ``others`` too, and cut.
    """
    draw = F.shiftrightunsigned(F.xxhash64(key), 1)
    count = df.count()
    if count <= rows:
        return df
    first = df.select(draw.alias("draw")).where(F.col("draw") <= min(2**63 - 1, int(1.2 * rows / count * 2**63)))
    last = first.orderBy("draw").limit(rows).agg(F.max("draw")).first()[0]
    if last is not None:
        within = df.where(draw <= last)
        if within.count() <= rows:
            return within
        df = within
    return df.orderBy(draw, key, *others).limit(rows)
