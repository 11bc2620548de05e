"""The daily activity job and the target detail job."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import moment
from ..operators import counts as C
from ..operators.lookups import with_activity, with_region
from ..operators.tops import DETAIL_TOP, top
from ..schemas import COUNTERS, REPORT, TARGET, UNKNOWN_PLACE
from ..sinks.sessions import compact_day
from ..sinks.tables import DAY, save_table, write_day
from ..sources.tables import read_batches, read_user_counts


def liveness(subscribers: DataFrame, user_counts: DataFrame, day) -> DataFrame:
    """Activity of every subscriber on one day."""
    return with_activity(subscribers, C.daily_sum(user_counts), moment(day))


def run_day(
    spark: SparkSession, batches: str, subscribers: DataFrame, day: datetime, out: str
) -> None:
    """Daily activity and totals from the tables that the batch jobs wrote below ``batches``.

    A day without account counts gives 0 for every subscriber. Counters of a day are in
    the batches of that day and, up to their cut-off, of the next. The sessions of the
    day are folded to whole days in ``session_days``.
    """
    counts = read_user_counts(spark, f"{batches}/user_counts/dt={day:%Y%m%d}/*/*/*")
    write_day(liveness(subscribers, counts, day), f"{out}/liveness", day)
    days = [f"{day + timedelta(days=k):%Y%m%d}" for k in (0, 1)]
    counters = read_batches(spark, f"{batches}/counters", COUNTERS).where(F.col("dt").isin(days))
    totals = C.daily_totals(counters, day, day + timedelta(days=1))
    write_day(totals, f"{out}/count_day", day)
    compact_day(spark, f"{batches}/sessions", f"{out}/session_days", days[0])


def target_places(report: DataFrame, geo: DataFrame, at, n: int = DETAIL_TOP) -> DataFrame:
    """``(ip, province, city, operator)`` of the targets with most sessions at one time."""
    rows = report.where((F.col("types") == TARGET) & (F.col("accesstime") == moment(at)))
    first = top(rows, "data", n).select(F.col("data").alias("ip"))
    return with_region(first, "ip", geo, UNKNOWN_PLACE).select("ip", "province", "city", "operator")


def run_target_places(spark: SparkSession, batches: str, geo: DataFrame, at, out: str) -> None:
    """Write the places of the main targets of one slot from the stored report.

    Rows of a slot are in the batch after it and, late ones, in later batches.
    """
    since = F.col("dt") >= F.date_format(moment(at), DAY)
    report = consolidated(read_batches(spark, f"{batches}/report", REPORT).where(since))
    save_table(target_places(report, geo, at), path=f"{out}/ip_detail")


def consolidated(report: DataFrame) -> DataFrame:
    """The stored report with the partial rows of all batches added up."""
    return C.consolidate(report.drop("dt", "batch"))
