"""Joins of sessions and counts to accounts, geography, subscribers and applications.

No side is broadcast by a hint: Spark broadcasts a dimension while its estimated or
measured size is below the session's thresholds, and otherwise shuffles both sides
and splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.net import geo_key, ip_to_long
from ..schemas import CITY, OPERATOR, PROVINCE, UNKNOWN, UNKNOWN_APP
from .ranges import as_of, disjoint, last_covers


def with_account(sessions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adds ``username`` by source address; ``UnKnown`` where there is no account."""
    dim = accounts.select(F.col("ip").alias("sourceIp"), F.col("account").alias("_account"))
    joined = sessions.join(dim, "sourceIp", "left")
    return joined.withColumn("username", F.coalesce("_account", F.lit(UNKNOWN))).drop("_account")


def with_region(
    rows: DataFrame, ip: str, geo: DataFrame, missing: str = UNKNOWN, salts: int = 1
) -> DataFrame:
    """Adds ``province``, ``operator`` and ``city`` of an address column.

    ``missing`` is for addresses that no range holds. A text that is no address
    gets the region of 0.0.0.0. Ranges may overlap; ``disjoint`` says which one holds.
    Give counts per address; ``salts`` is for tables with many rows per address.
    """
    places = [PROVINCE, OPERATOR, CITY]
    keyed = rows.withColumn("_ip", geo_key(F.col(ip)))
    joined = as_of(keyed, "_ip", disjoint(geo.select("lo", "hi", *places)), salts)
    named = {name: F.coalesce(F.col(name), F.lit(missing)) for name in places}
    return joined.withColumns(named).drop("_ip")


def app_names(addresses: DataFrame, ip: str, ranges: DataFrame) -> DataFrame:
    """``(ip, app)`` of each distinct address: the last half-open range that holds it wins."""
    distinct = addresses.select(ip).distinct().withColumn("_ip", ip_to_long(F.col(ip)))
    named = as_of(distinct, "_ip", last_covers(ranges))
    return named.select(ip, F.coalesce("app", F.lit(UNKNOWN_APP)).alias("app"))


def with_activity(subscribers: DataFrame, daily: DataFrame, day) -> DataFrame:
    """Every subscriber with the day's session count, 0 where there is none."""
    counts = daily.select("username", F.col("count").alias("resolver"))
    joined = subscribers.join(counts, "username", "left")
    return joined.select(
        "username",
        F.coalesce("resolver", F.lit(0)).cast("long").alias("resolver"),
        day.alias("accesstime"),
        *["rid1", "rid2", "rid3", "rid4"],
    )
