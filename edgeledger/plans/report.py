"""The seven-dimension report.

Lines are read and parsed once. Every dimension starts from the counts of that one
pass: a subscriber is found by a source address and a region by a target address, so
both are joined to counts, never to sessions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import SLOT_SECONDS, minus_seconds, moment, slot
from ..operators import counts as C
from ..operators.lookups import with_region
from ..operators.parse import counted
from ..operators.tops import REPORT_TOP, top, top_per
from ..schemas import HOST, SOURCE, TARGET, USER

REPORT_COLUMNS = ["types", "accesstime", "data", "count"]
KINDS = [HOST, TARGET, SOURCE]
BATCHED = ("batch", "accesstime")
BATCH_SALTS = 16


def slot_entries(entries: DataFrame, batch_time, event_time: bool) -> DataFrame:
    """Sets the report time: the batch's own slot or, for sessions, the event's slot."""
    batch_slot = minus_seconds(moment(batch_time), SLOT_SECONDS)
    at = F.coalesce(slot(F.col("accesstime")), batch_slot) if event_time else batch_slot
    return entries.withColumn("accesstime", at)


def dimension_counts(entries: DataFrame, keys: tuple[str, ...] = ("accesstime",)) -> DataFrame:
    """``(kind, *keys, data, count)`` of hosts, targets and sources, in one shuffle.

    ``kind`` is a place in ``KINDS``. It is given out as an aggregate so that a
    filter on it stays above the shuffle, which all dimensions then share.
    """
    kind = reduce(
        lambda rest, i: F.when(F.col("types") == KINDS[i], i).otherwise(rest),
        range(len(KINDS)),
        F.lit(None).cast("int"),
    )
    grouped = entries.withColumn("_kind", kind).groupBy("_kind", *keys, "data")
    return grouped.agg(F.max("_kind").alias("kind"), C.row_count()).drop("_kind")


def of_kind(counts: DataFrame, name: str, column: str) -> DataFrame:
    return (
        counts.where(F.col("kind") == KINDS.index(name))
        .withColumnRenamed("data", column)
        .drop("kind")
    )


def target_detail(counts: DataFrame, geo: DataFrame) -> DataFrame:
    """Counts per target address with its region, looked up once per address and slot.

    Counts of many batches have more rows per address and are dealt to more tasks.
    """
    salts = BATCH_SALTS if "batch" in counts.columns else 1
    return with_region(of_kind(counts, TARGET, "targetIp"), "targetIp", geo, salts=salts)


def user_counts(
    counts: DataFrame, accounts: DataFrame, keys: tuple[str, ...] = ("accesstime",)
) -> DataFrame:
    return C.accounts_of_sources(of_kind(counts, SOURCE, "sourceIp"), accounts, keys)


def report_rows(counts: DataFrame, name: str, column: str) -> DataFrame:
    """Shapes counts to report rows of one type; a ``batch`` column is kept."""
    kept = ["batch"] if "batch" in counts.columns else []
    return counts.select(
        *kept, F.lit(name).alias("types"), "accesstime", F.col(column).alias("data"), "count"
    )


def assemble(
    counts: DataFrame,
    geo: DataFrame,
    accounts: DataFrame,
    keys: tuple[str, ...] = ("accesstime",),
    n: int = REPORT_TOP,
) -> DataFrame:
    """All seven dimensions as one frame.

    Targets, accounts and sources are the first ``n`` over all slots of the batch;
    with a ``batch`` key, of each batch.
    """

    def first(rows: DataFrame, value: str) -> DataFrame:
        return top_per(rows, ["batch"], value, n) if "batch" in keys else top(rows, value, n)

    targets = of_kind(counts, TARGET, "targetIp")
    sources = of_kind(counts, SOURCE, "sourceIp")
    users = user_counts(counts, accounts, keys)
    regions = C.roll_up(target_detail(counts, geo), keys)
    frames = [
        report_rows(of_kind(counts, HOST, "host"), HOST, "host"),
        report_rows(first(targets, "targetIp"), TARGET, "targetIp"),
        report_rows(first(users, "username"), USER, "username"),
        report_rows(first(sources, "sourceIp"), SOURCE, "sourceIp"),
        regions.select(*(["batch"] if "batch" in keys else []), *REPORT_COLUMNS),
    ]
    return reduce(DataFrame.unionByName, frames)


def nat_report(
    lines: DataFrame, geo: DataFrame, accounts: DataFrame, batch_time, year: int,
    event_time: bool = False,
) -> DataFrame:
    """Report of one batch of clean lines.

    Give the lines as they are read. Spark does not share the counts' shuffle above
    a cached frame; where lines are cached, settle ``dimension_counts`` as the jobs
    do and ``assemble`` from it.
    """
    entries = slot_entries(counted(lines, year), batch_time, event_time)
    return assemble(dimension_counts(entries), geo, accounts)


def batched(lines: DataFrame, start, end) -> DataFrame:
    """Lines of the batches from ``start`` to ``end`` inclusive, with a ``batch`` time.

    ``lines`` has an ``arrival`` time; a batch takes what arrived in the five
    minutes before it.
    """
    batch = F.timestamp_seconds(F.unix_timestamp(slot(F.col("arrival"))) + SLOT_SECONDS)
    first = minus_seconds(moment(start), SLOT_SECONDS)
    inside = lines.where((F.col("arrival") >= first) & (F.col("arrival") < moment(end)))
    return inside.withColumn("batch", batch).drop("arrival")


def batched_counts(lines: DataFrame, year: int) -> DataFrame:
    entries = slot_entries(counted(lines, year), F.col("batch"), event_time=True)
    return dimension_counts(entries, BATCHED)


def backfill(
    lines: DataFrame, geo: DataFrame, accounts: DataFrame, start, end, year: int
) -> DataFrame:
    """Event-time reports of all batches from ``start`` to ``end``, as one job.

    A ``batch`` column tells the reports apart.
    """
    return assemble(batched_counts(batched(lines, start, end), year), geo, accounts, BATCHED)
