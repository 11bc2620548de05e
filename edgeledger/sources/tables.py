"""Stored tables, read through Spark's own data sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LINES
from .lines import load_or_nothing

#: A count of an account; where a file holds several batches, their labels come first.
TUPLE = r"^(?:[0-9]{12} )?\((.*),(-?\d+)\)$"


def read_table(spark: SparkSession, fmt: str = "parquet", **options) -> DataFrame:
    """Any table: ``parquet`` with ``path``, ``jdbc`` with ``url``, ``dbtable`` and so on."""
    return spark.read.format(fmt).options(**options).load()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of batches with ``dt`` and ``batch``; filters on ``dt`` reach the listing."""
    labels = [T.StructField(name, T.StringType()) for name in ("slot", "dt", "batch")]
    stored = T.StructType([*schema, *labels])
    rows = load_or_nothing(spark.read.format("parquet").schema(stored), path, stored)
    return rows.withColumn("batch", F.coalesce("slot", "batch")).drop("slot")


def key_predicates(key: str, parts: int = 100) -> list[str]:
    """Disjoint conditions that cover an integer key evenly, rows without a key included."""
    rest = [f"mod(abs({key}), {parts}) = {i}" for i in range(parts)]
    return [f"{rest[0]} or {key} is null", *rest[1:]]


def read_partitioned(
    spark: SparkSession, url: str, table: str, key: str, properties: dict, parts: int = 100
) -> DataFrame:
    """A JDBC table in ``parts`` tasks."""
    predicates = key_predicates(key, parts)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def key_bucket(key: str, parts: int = 100):
    """The part of ``key_predicates`` that takes a row."""
    return F.coalesce(F.pmod(F.abs(F.col(key)), F.lit(parts)), F.lit(0))


def read_user_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(username, count)`` of ``(user,count)`` lines, cut at the last comma."""
    return parse_user_counts(load_or_nothing(spark.read.format("text").schema(LINES), path, LINES))


def parse_user_counts(lines: DataFrame) -> DataFrame:
    name, number = (F.regexp_extract("value", TUPLE, i) for i in (1, 2))
    return lines.where(F.col("value").rlike(TUPLE)).select(
        name.alias("username"), number.cast("long").alias("count")
    )


def group_offsets(offsets: DataFrame, group: str) -> DataFrame:
    return offsets.where(F.col("groupId") == group).select("topic", "partitionNum", "offsets")


def starting_offsets(offsets: DataFrame, group: str) -> DataFrame:
    """One JSON text ``{"topic":{"0":n}}`` for a stream's ``startingOffsets``.

    It has one number per topic partition of the group.
    """
    # Of several rows of a partition the largest offset holds.
    own = group_offsets(offsets, group).groupBy("topic", "partitionNum").agg(F.max("offsets").alias("offsets"))
    numbers = F.map_from_entries(F.array_sort(F.collect_list(F.struct("partitionNum", "offsets"))))
    topics = own.groupBy("topic").agg(numbers.alias("numbers"))
    member = F.regexp_replace(F.to_json(F.create_map("topic", "numbers")), r"^\{|\}$", "")
    members = F.concat_ws(",", F.array_sort(F.collect_list(member)))
    return topics.agg(F.concat(F.lit("{"), members, F.lit("}")).alias("startingOffsets"))
