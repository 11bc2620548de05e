"""Top lists: most first, equal counts by time and value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REPORT_TOP = 100
DETAIL_TOP = 500


def top(counts: DataFrame, value: str, n: int = REPORT_TOP) -> DataFrame:
    """The ``n`` largest rows over all times; each task keeps only its own ``n``."""
    return counts.orderBy(F.desc("count"), "accesstime", value).limit(n)


def top_per(counts: DataFrame, group: list[str], value: str, n: int = REPORT_TOP) -> DataFrame:
    """The ``n`` largest rows of each group; each task keeps ``n`` per group before the shuffle."""
    order = Window.partitionBy(*group).orderBy(F.desc("count"), "accesstime", value)
    return counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")
