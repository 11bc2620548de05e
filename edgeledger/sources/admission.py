"""Input quota: which files a batch takes, and which it leaves for later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import whole
from ..session import settle
from .lines import folder_of

DEFAULT_QUOTA_GB = 40


def quota(settings: DataFrame, default: int = DEFAULT_QUOTA_GB) -> DataFrame:
    """One row ``limit_gb``: the setting if there is exactly one, else ``default``."""
    one = F.count(F.lit(1)) == 1
    value = F.when(one, F.max("performance")).otherwise(default).cast("long")
    return settings.agg(value.alias("limit_gb"))


def sums_before(
    rows: DataFrame, order: list[Column], values: dict[str, Column], slices: int | None = None
) -> DataFrame:
    """Adds, for each name, the sum of a value over all earlier rows of a total order.

    Rows are cut into ranges of the order, sums of whole ranges are added up first,
    and each range then runs on its own. The cut is kept in the shared folder, so
    both uses see the same ranges.
    """
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = settle(
        rows.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id())
    )
    zero = F.lit(0)
    sums = cut.groupBy("_slice").agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    # At most ``slices`` rows, whatever the input.
    slices_before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_slice",
        *[F.coalesce(F.sum(f"_sum_{n}").over(slices_before), zero).alias(f"_start_{n}") for n in values],
    )
    inner = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = {f"_within_{n}": F.coalesce(F.sum(v).over(inner), zero) for n, v in values.items()}
    totals = {n: F.col(f"_start_{n}") + F.col(f"_within_{n}") for n in values}
    return (
        cut.withColumns(within)
        .join(F.broadcast(starts), "_slice")
        .withColumns(totals)
        .select(*rows.columns, *values)
    )


def admit(
    manifest: DataFrame, limit: DataFrame, slices: int | None = None, max_files: int | None = None
) -> DataFrame:
    """Adds ``admitted``: backlog files first, then new ones, each in path order.

    A file is admitted while the whole GB of those before it are not above the
    limit and, if ``max_files`` is given, they are fewer than that: sizes are whole megabytes,
    so the quota alone lets in any number of small files. Sums only stop growing at the first
    refusal, so the rule is the same for all files before it as for those admitted.
    """
    order = [F.desc("backlog"), F.asc("path")]
    values = {"_before": F.col("size_mb"), "_files": F.lit(1)}
    summed = sums_before(manifest, order, values, slices)
    admitted = whole(F.col("_before"), 1024) <= limit.scalar()
    if max_files is not None:
        admitted = admitted & (F.col("_files") < max_files)
    return summed.withColumn("admitted", admitted).drop("_before", "_files")


def admitted_paths(files: DataFrame) -> list[str]:
    """Paths to read, on the driver, which lists the files of a scan in any case."""
    return [row.path for row in files.where("admitted").select("path").toLocalIterator()]


def admitted_cover(files: DataFrame) -> tuple[list[str], list[str]]:
    """What to read, on the driver: folders of which all files are admitted, and the admitted files of other folders.

    ``files`` has ``outside``, as ``lines.manifest`` gives it. The quota cuts one folder, and a backlog few, so
    the lists grow with folders and not with files.
    """
    placed = files.withColumn("_folder", folder_of(F.col("path")))
    all_in = F.min(F.col("admitted") & (F.col("outside") == 0))
    whole_ones = placed.groupBy("_folder").agg(all_in.alias("_whole")).where("_whole").select("_folder")
    single = placed.where("admitted").join(whole_ones, "_folder", "left_anti").select("path")
    return [row[0] for row in whole_ones.toLocalIterator()], [row[0] for row in single.toLocalIterator()]


def backlog(files: DataFrame) -> DataFrame:
    """The refused files, as backlog of the next batch."""
    return files.where("not admitted").drop("admitted", "outside").withColumn("backlog", F.lit(True))
