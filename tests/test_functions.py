"""Column functions on literal values."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edgeledger.functions import net, text, times
from edgeledger.schemas import GEO_FIELDS


@pytest.fixture
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).head().v


@pytest.mark.parametrize(
    "given, delimiters, wanted",
    [
        ("k=", "=", ["k"]), ("k==9", "=", ["k", "", "9"]), ("===", "=", None), ("", "=", [""]),
        ("a.b.c.d..", ".", ["a", "b", "c", "d"]), ("a|b||", "|", ["a", "b"]),
        ("a:b->c(d)", ":->()", ["a", "b", "", "c", "d"]), ("=a", "=", ["", "a"]),
    ],
)
def test_pieces(value, given, delimiters, wanted):
    assert value(text.pieces(F.lit(given), delimiters)) == wanted


def test_clean(value):
    assert value(text.clean(F.lit("\x00\t a b\x1f\r\n "))) == "a b"


@pytest.mark.parametrize(
    "ip, wanted",
    [
        ("1.2.3.4", 16909060), ("0.0.0.0", 0), ("255.255.255.255", 4294967295), ("1.2.3", 0),
        ("1.2.3.4.5", 0), ("1.2.3.4.", 16909060), ("", 0), ("...", 0), ("1.2.x.4", None),
        ("1.2.3.300", (16909056 | 300)),
    ],
)
def test_ip_to_long(value, ip, wanted):
    assert value(net.ip_to_long(F.lit(ip))) == wanted


@pytest.mark.parametrize(
    "ip, wanted",
    [
        ("1.2.3.4", 16909060), ("1.2.3.4.5", 16909060), ("1.2.3.4.", 16909060), ("1.2.3", 0),
        ("x", 0), ("", 0), ("1.2.3.x", 0), ("1.2.3.99999999999", 0), ("1.300.0.0", -1),
        ("300.1.1.1", 300 * 16777216 + 65536 + 256 + 1), ("1.2.3. 4", 0),
    ],
)
def test_geo_key(value, ip, wanted):
    assert value(net.geo_key(F.lit(ip))) == wanted


def test_row_key_sorts_newest_first(value):
    key = lambda at: net.row_key(F.lit("203.0.113.32"), F.lit("14872"), times.moment(at))
    old, new = value(key("2024-01-01 00:00:00")), value(key("2024-01-01 00:00:01"))
    assert new < old and new[:17] == old[:17]
    assert old[17:] == str(9223372036854775807 - 1704067200000)
    # MD5 of "203.0.113.32_14872", middle 16 digits.
    assert old[:16] == hashlib.md5(b"203.0.113.32_14872").hexdigest()[8:24]


@pytest.mark.parametrize("key, region", [("00000000", 0), ("0ccccccc", 0), ("0ccccccd", 1), ("ffffffff", 19)])
def test_region_edges(value, key, region):
    assert value(net.region_of(F.lit(key + "00000000_1"), 20)) == region


def test_geo_fields(spark):
    whole = "|".join(GEO_FIELDS)
    frame = spark.createDataFrame([(whole,), (whole + "||",), ("a|b",), ("",), (whole[:-3] + "||",)], "t string")
    got = [tuple(r) for r in frame.select(*net.geo_fields(F.col("t")).values()).collect()]
    none = (None,) * 11
    assert got == [tuple(GEO_FIELDS), tuple(GEO_FIELDS), none, none, none]


def test_task_buckets(spark):
    row = spark.range(1).select(
        *[c.alias(n) for n, c in times.task_buckets(times.moment("2024-03-10 13:47:59")).items()]
    ).head()
    assert row.hour_end == datetime(2024, 3, 10, 13) and row.hour_start == datetime(2024, 3, 10, 12)
    assert row.six_hours_end == datetime(2024, 3, 10, 12)
    assert row.six_hours_start == datetime(2024, 3, 10, 6)
    assert row.day_end == datetime(2024, 3, 10) and row.day_start == datetime(2024, 3, 9)
    assert row.five_minutes_end == datetime(2024, 3, 10, 13, 45)
    assert row.five_minutes_start == datetime(2024, 3, 10, 13, 40)


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2020-08-17T09:14:58+08:00", datetime(2020, 8, 17, 9, 10)),
        ("2020-08-17T09:14:58-03:00", datetime(2020, 8, 17, 9, 10)),
        ("2020-08-17T09", None),
    ],
)
def test_iso_slot(value, given, wanted):
    assert value(times.iso_slot(F.lit(given))) == wanted


def test_short_time(value):
    at = lambda month, day, year: value(
        times.short_time(F.lit(month), F.lit(day), F.lit("09:07:06"), year)
    )
    assert at("Feb", "29", 2024) == datetime(2024, 2, 29, 9, 7, 6)
    assert at("Feb", "29", 2023) is None
    assert at("Dec", "1", 2023) == datetime(2023, 12, 1, 9, 7, 6)
    assert at("Foo", "1", 2023) is None


def test_slot_of_times_before_1970(value):
    assert value(times.slot(times.moment("1969-12-31 23:59:59"))) == datetime(1969, 12, 31, 23, 55)


def test_format_millis(value):
    assert value(times.format_millis(F.lit(1623897300000), "yyyyMMdd/HH/mm")) == "20210617/02/35"


def test_year_of_a_line(spark):
    """A line is put nearest to its batch, also across a new year."""
    near = times.moment("2025-01-01 00:00:00")
    cases = [("Dec", "31", 2024), ("Jan", "1", 2025), ("Jun", "30", 2025), ("Jul", "1", 2025), ("Aug", "1", 2024)]
    for month, day, year in cases:
        got = spark.range(1).select(times.short_time(F.lit(month), F.lit(day), F.lit("09:00:00"), near)).head()[0]
        assert (got.year, got.strftime("%b"), got.day) == (year, month, int(day))
