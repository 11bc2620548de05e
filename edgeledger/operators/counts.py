"""Counts, totals and de-duplication.

Plain grouped counts are combined inside each task before the shuffle, so a hot key
sends one row per task. ``salted_count`` is the explicit two-phase form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import SLOT_SECONDS, minus_seconds, moment, slot
from ..schemas import CITY, DISTINCT_COUNTER, OPERATOR, PROVINCE, RAW_COUNTER, UNKNOWN


def row_count() -> Column:
    return F.count(F.lit(1)).alias("count")


def count_by(rows: DataFrame, *keys: str | Column) -> DataFrame:
    return rows.groupBy(*keys).agg(row_count())


def salted_count(rows: DataFrame, *keys: str, salts: int = 100) -> DataFrame:
    """Same result as ``count_by`` through one more shuffle on key and salt."""
    values = [F.col(c) for c in rows.columns]
    salt = F.pmod(F.xxhash64(*values), F.lit(salts)).alias("_salt")
    partial = rows.groupBy(*keys, salt).agg(row_count())
    return partial.groupBy(*keys).agg(F.sum("count").alias("count"))


def count_slots(sessions: DataFrame, *keys: str) -> DataFrame:
    """Sessions per five-minute event slot and ``keys``."""
    return count_by(sessions, slot(F.col("accesstime")).alias("accesstime"), *keys)


def roll_up(target_detail: DataFrame, keys: tuple[str, ...] = ("accesstime",)) -> DataFrame:
    """``(types, *keys, data, count)`` of provinces, operators and cities, in one shuffle."""
    long = target_detail.unpivot([*keys, "count"], [PROVINCE, OPERATOR, CITY], "types", "data")
    return long.groupBy("types", *keys, "data").agg(F.sum("count").alias("count"))


def accounts_of_sources(
    source_counts: DataFrame, accounts: DataFrame, keys: tuple[str, ...] = ("accesstime",)
) -> DataFrame:
    """Counts per known account from counts per source address.

    An address has one account, so the join takes counts instead of sessions.
    """
    dim = accounts.select(F.col("ip").alias("sourceIp"), F.col("account").alias("username"))
    joined = source_counts.join(dim, "sourceIp").where(F.col("username") != UNKNOWN)
    return joined.groupBy(*keys, "username").agg(F.sum("count").alias("count"))


def distinct_sessions(sessions: DataFrame, keys: tuple[str, ...] = ("rowkey",)) -> DataFrame:
    """One session per key, the least by all other columns.

    Equal keys meet in each task before the shuffle, so a hot key stays small.
    """
    others = [c for c in sessions.columns if c not in keys]
    least = sessions.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return least.select(*[c if c in keys else f"_row.{c}" for c in sessions.columns])


def slot_ceiling(ts: Column) -> Column:
    """Start of the first slot that does not begin before ``ts``."""
    micros, width = F.unix_micros(ts), SLOT_SECONDS * 1_000_000
    return F.timestamp_micros(micros + F.pmod(-micros, F.lit(width)))


def late_windows(sessions: DataFrame, batch_time, cutoff_seconds: int = 10800) -> DataFrame:
    """Sessions per event slot that the cut-off leaves out of the counters."""
    oldest = slot_ceiling(minus_seconds(moment(batch_time), cutoff_seconds))
    return count_slots(sessions.where(F.col("accesstime") < oldest))


def daily_sum(user_counts: DataFrame) -> DataFrame:
    return user_counts.groupBy("username").agg(F.sum("count").alias("count"))


def daily_totals(counters: DataFrame, day_start, day_end) -> DataFrame:
    """``(counter, count_day, date)`` over slots in ``[day_start, day_end)``; 0 if there are none."""
    start, end = moment(day_start), moment(day_end)
    inside = counters.where((F.col("update_time") >= start) & (F.col("update_time") < end))
    of = lambda name: F.sum(F.when(F.col("counter") == name, F.col("count_5min")))
    names = [RAW_COUNTER, DISTINCT_COUNTER]
    totals = inside.agg(*[F.coalesce(of(name), F.lit(0)).alias(name) for name in names])
    dated = totals.withColumn("date", start)
    return dated.unpivot(["date"], names, "counter", "count_day").select(
        "counter", "count_day", "date"
    )


def consolidate(report: DataFrame) -> DataFrame:
    """Sums the partial rows that batches added for one slot and value."""
    return report.groupBy("types", "accesstime", "data").agg(F.sum("count").alias("count"))


def hour_fill(values: DataFrame, key: str) -> DataFrame:
    """``00=v,01=v,..,23=v`` per key from ``(key, position, hour, value)`` text rows.

    A missing hour is 0; the value at the last position of an hour wins. A key
    holds at most 24 values when they are put together.
    """
    hours = [f"{h:02d}" for h in range(24)]
    known = F.when(F.col("hour").isin(hours), F.col("hour")).alias("hour")
    last = values.groupBy(key, known).agg(F.max_by("value", "position").alias("value"))
    pair = F.when(F.col("hour").isNotNull(), F.struct("hour", "value"))
    by_hour = last.groupBy(key).agg(F.map_from_entries(F.collect_list(pair)).alias("_by_hour"))
    pairs = [
        F.concat(F.lit(f"{hour}="), F.coalesce(F.try_element_at("_by_hour", F.lit(hour)), F.lit("0")))
        for hour in hours
    ]
    return by_hour.select(key, F.concat_ws(",", *pairs).alias("hours"))
