"""Column lists and types of every table that is read or written."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


ENDPOINTS = [
    "sourceIp", "sourcePort", "targetIp", "targetPort",
    "protocol", "convertedIp", "convertedPort",
]

LINES = T.StructType(_strings("value"))

FLOWS = T.StructType(
    [T.StructField("accesstime", T.TimestampType()), *_strings(*ENDPOINTS, "username", "rowkey")]
)

REPORT = T.StructType(
    [
        T.StructField("types", T.StringType()),
        T.StructField("accesstime", T.TimestampType()),
        T.StructField("data", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

BACKLOG = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size_mb", T.LongType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("backlog", T.BooleanType()),
    ]
)

SETTINGS = T.StructType([T.StructField("performance", T.IntegerType())])

ACCOUNT_SESSION = T.StructType(_strings("ip", "account"))

COUNTERS = T.StructType(
    [
        T.StructField("counter", T.StringType()),
        T.StructField("count_5min", T.LongType()),
        T.StructField("count_sec", T.LongType()),
        T.StructField("update_time", T.TimestampType()),
        T.StructField("accesstime", T.TimestampType()),
    ]
)

# Names of the report dimensions and of the two counters.
HOST, TARGET, SOURCE, USER = "hostIP", "targetIp", "sourceIp", "username"
PROVINCE, OPERATOR, CITY = "province", "operator", "city"
RAW_COUNTER, DISTINCT_COUNTER = "nat_count", "nat_hbase_count"

# What stands for a missing address, account or region.
NO_IP = "0.0.0.0"
UNKNOWN = "UnKnown"
UNKNOWN_PLACE = "未知"
UNKNOWN_APP = "其他"

# Cells of a stored session, in byte order of their names.
CELL_NAMES = [
    "accesstime", "convertedIp", "convertedPort", "protocol",
    "sourceIp", "sourcePort", "targetIp", "targetPort", "username",
]

# Fields of one geography text, in the order they are written.
GEO_FIELDS = [
    "continent", "country", "province", "city", "district", "operator",
    "area_code", "english", "short_code", "lon", "lat",
]
