"""The dimension that maps addresses to subscriber accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCOUNT_SESSION


def radius_sessions(values: DataFrame) -> DataFrame:
    """``(ip, account)`` of JSON texts, one row per address: the largest account."""
    parsed = values.select(F.from_json("value", ACCOUNT_SESSION).alias("s")).select("s.*")
    return parsed.where("ip is not null").groupBy("ip").agg(F.max("account").alias("account"))


def ip_of_account(sessions: DataFrame, account: str) -> DataFrame:
    """One row ``(account, ip)``: the largest address of the account, or the text ``null``."""
    mine = sessions.where(F.col("account") == account)
    return mine.agg(F.coalesce(F.max("ip"), F.lit("null")).alias("ip")).select(
        F.lit(account).alias("account"), "ip"
    )


def sample(rows: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows by key."""
    return rows.orderBy(key).limit(n)
