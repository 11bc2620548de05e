"""The five-minute batch jobs.

A job parses its lines once and caches nothing. What lines give, and the counts, are settled
in the shared folder while the job runs, and every table is taken from there; the counters
are taken from the counts and from the stored sessions. Lines that give no session go to a
table of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import SLOT_SECONDS, minus_seconds, moment, whole
from ..operators import counts as C
from ..operators import parse
from ..operators.lookups import with_account
from ..schemas import COUNTERS, DISTINCT_COUNTER, FLOWS, RAW_COUNTER, SOURCE
from ..session import settle, settling
from ..sinks.sessions import REGIONS, add_session_range, to_cells, upsert_sessions, write_cells
from ..sinks.tables import (
    BATCH,
    USER_CLOCK,
    add_range,
    add_user_counts,
    batch_folder,
    batch_label,
    batch_slot,
    clear_batches,
    write_batch,
    write_user_counts,
)
from ..sources import admission, lines as L
from ..sources.lines import load_or_nothing
from ..sources.sessions import days_between, read_store
from . import report as R


@dataclass(frozen=True)
class Tables:
    """Where a job writes; all are folders of one shared root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("report", "user_counts", "counters", "sessions", "cells", "rejects", "vanished"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def distinct_with_account(
    flows: DataFrame, accounts: DataFrame, keys: tuple[str, ...] = ("rowkey",)
) -> DataFrame:
    """Distinct sessions with row key and account; the account is joined after the duplicates go."""
    return with_account(C.distinct_sessions(parse.with_row_key(flows), keys), accounts)


def sessions_of(lines: DataFrame, accounts: DataFrame, year: int | Column) -> DataFrame:
    """``distinct_with_account`` of clean lines."""
    return distinct_with_account(parse.flows(lines, year), accounts)


def _counter_rows(raw: DataFrame, distinct: DataFrame, batch_slot: Column) -> DataFrame:
    named = raw.withColumn("counter", F.lit(RAW_COUNTER)).unionByName(
        distinct.withColumn("counter", F.lit(DISTINCT_COUNTER))
    )
    rows = named.withColumnsRenamed({"accesstime": "update_time", "count": "count_5min"})
    rate = whole(F.col("count_5min"), SLOT_SECONDS)
    return rows.withColumns({"count_sec": rate, "accesstime": batch_slot})


def _sessions_per(counts: DataFrame, *keys: str) -> DataFrame:
    """All sessions, as the sum of the counts per source."""
    sources = R.of_kind(counts, SOURCE, "sourceIp")
    return sources.groupBy(*keys).agg(F.sum("count").alias("count"))


def batch_counters(counts: DataFrame, stored: DataFrame, batch_time) -> DataFrame:
    """Counters of a whole batch from its counts and stored sessions, also if it is empty."""
    at = batch_slot(batch_time)
    raw = _sessions_per(counts).select(F.coalesce("count", F.lit(0)).alias("count"))
    distinct = stored.agg(C.row_count())
    timed = [frame.withColumn("accesstime", at) for frame in (raw, distinct)]
    return _counter_rows(*timed, at).select(*COUNTERS.fieldNames())


def slot_counters(
    counts: DataFrame, stored: DataFrame, batch_time, cutoff_seconds: int = 10800
) -> DataFrame:
    """Counters per event slot, without slots from before ``batch_time - cutoff``.

    ``batch_time`` may be the ``batch`` column of both frames.
    """
    kept = ["batch"] if "batch" in stored.columns else []
    raw = _sessions_per(counts, *kept, "accesstime")
    rows = _counter_rows(raw, C.count_slots(stored, *kept), batch_slot(batch_time))
    oldest = minus_seconds(moment(batch_time), cutoff_seconds)
    return rows.where(F.col("update_time") >= oldest).select(*kept, *COUNTERS.fieldNames())


def run_batch(
    lines: DataFrame,
    geo: DataFrame,
    accounts: DataFrame,
    batch_time: datetime,
    out: str,
    year: int | None = None,
    event_time: bool = False,
    as_cells: bool = False,
    regions: int = REGIONS,
    number: int | None = None,
) -> None:
    """Write report, account counts, sessions and counters of one batch of raw lines.

    ``event_time`` stamps rows with their own slot and applies the counter cut-off;
    ``as_cells`` also writes the sessions as sorted cells. Without a ``year`` each line
    that has none gets the one that puts it nearest to the batch. A second run of a
    batch replaces all that the first one wrote.
    """
    spark, tables = lines.sparkSession, Tables(out)
    year = year or moment(batch_time)
    with settling(spark) as settled:
        entries = settled(parse.entries(parse.clean_lines(lines), year))
        slots = R.slot_entries(parse.counted_of(entries), batch_time, event_time)
        counts = settled(R.dimension_counts(slots))
        write_batch(R.assemble(counts, geo, accounts), tables.report, batch_time, number)
        users = R.user_counts(counts, accounts)
        write_user_counts(users, tables.user_counts, batch_time, number)

        sessions = distinct_with_account(parse.flows_of(entries), accounts)
        upsert_sessions(sessions, tables.sessions, batch_time, regions, number)
        stored = stored_batch(spark, tables.sessions, batch_time, number)
        if as_cells:
            write_cells(to_cells(stored, regions), tables.cells, batch_time, number)
        make = slot_counters if event_time else batch_counters
        write_batch(make(counts, stored, batch_time), tables.counters, batch_time, number)
        write_batch(parse.rejects_of(entries), tables.rejects, batch_time, number)


def stored_batch(
    spark: SparkSession, path: str, batch_time: datetime, number: int | None = None
) -> DataFrame:
    """Stored sessions of one batch, from its folder alone."""
    folder = f"{path}/{batch_folder(batch_time, number)}"
    return load_or_nothing(spark.read.format("parquet").schema(FLOWS), folder, FLOWS)


def run_minutes(
    spark: SparkSession, root: str, geo: DataFrame, accounts: DataFrame, batch_time: datetime,
    out: str, layout: str = L.PLAIN, **options,
) -> None:
    """Batch job over the five minute folders before ``batch_time``."""
    lines = L.read_minutes(spark, root, batch_time, layout=layout)
    run_batch(lines, geo, accounts, batch_time, out, **options)


def run_delayed(
    spark: SparkSession, days: str, backlog: DataFrame, settings: DataFrame, geo: DataFrame,
    accounts: DataFrame, batch_time: datetime, out: str, max_files: int | None = None, **options,
) -> DataFrame:
    """Event-time job over the files changed in the last five minutes, within the quota.

    ``days`` is the folder or pattern to list, as ``lines.day_folders`` gives it. ``backlog``
    holds files left by earlier batches; the new backlog is given back. Backlog files that
    are gone are written to the table ``vanished``.
    """
    files, gone = L.manifest(spark, days, backlog, batch_time)
    chosen = settle(admission.admit(files, admission.quota(settings), max_files=max_files))
    write_batch(gone, Tables(out).vanished, batch_time)
    lines = L.read_cover(spark, *admission.admitted_cover(chosen), batch_time)
    run_batch(lines, geo, accounts, batch_time, out, event_time=True, **options)
    return admission.backlog(chosen)


def run_backfill(
    lines: DataFrame, geo: DataFrame, accounts: DataFrame, start: datetime, end: datetime,
    out: str, year: int | None = None,
) -> None:
    """All event-time batches from ``start`` to ``end`` inclusive, each table in one job.

    ``lines`` has an ``arrival`` time. The tables are those that ``run_batch`` would
    write batch by batch. What an earlier run left of these batches goes first, so that
    batches which now have no rows are empty.
    """
    spark, tables, batch = lines.sparkSession, Tables(out), F.col("batch")
    year = year or batch
    inside = R.batched(parse.clean_lines(lines), start, end)
    for name in ("report", "sessions", "counters", "rejects"):
        clear_batches(spark, getattr(tables, name), start, end)
    clear_batches(spark, tables.user_counts, start, end, USER_CLOCK, "text")
    with settling(spark) as settled:
        entries = settled(parse.entries(inside, year))
        slots = R.slot_entries(parse.counted_of(entries), batch, event_time=True)
        counts = settled(R.dimension_counts(slots, R.BATCHED))
        add_range(R.assemble(counts, geo, accounts, R.BATCHED), tables.report, start, end)
        add_user_counts(R.user_counts(counts, accounts, R.BATCHED), tables.user_counts, start, end)

        sessions = distinct_with_account(parse.flows_of(entries), accounts, ("batch", "rowkey"))
        add_session_range(sessions, tables.sessions, start, end)
        first, last = (batch_label(at) for at in (start, end))
        days = days_between(start - timedelta(seconds=SLOT_SECONDS), end)
        stored = read_store(spark, tables.sessions, days).where(batch.between(first, last))
        at = F.to_timestamp(batch, BATCH)
        timed = stored.withColumn("batch", F.timestamp_seconds(F.unix_timestamp(at) + SLOT_SECONDS))
        add_range(slot_counters(counts, timed, batch), tables.counters, start, end)
        add_range(parse.rejects_of(entries), tables.rejects, start, end)
