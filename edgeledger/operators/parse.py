"""From raw lines to session records, host names and rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.net import part_key, row_key
from ..functions.text import clean, has_line_end, pieces
from ..functions.times import full_time, short_time
from ..schemas import ENDPOINTS, HOST, NO_IP, SOURCE, TARGET

# A line is read in one pass: its pattern picks the parts, ``PARTS`` of them are
# written one per line end, and one split gives the fields. A part that is set
# starts with "=", a part that the line does not reach is empty.
PARTS = [
    "month", "day", "clock", "protocol", "sourceIp", "sourcePort",
    "targetIp", "targetPort", "convertedIp", "convertedPort", "noConverted",
]

# Quantifiers are possessive: neighbouring classes never share a character, so
# there is nothing to go back for.
_BLANK = r"[ \t\n\x0B\f\r]++"
_WORD = r"[^ \t\n\x0B\f\r]"
_CLOCK = r"([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"

# Format A: Msg: Jun 7 09:07:06 w w w w ip:port->ip:port(PROTO), w w ip:port, ...
# The endpoints are the ninth word, cut at each of : - > ( ). The translated
# endpoint is the fourth text between single spaces after the first comma. All
# of these must be there; only the parts of the translated endpoint may be missing.
_PLAIN = r"[^ \t\n\x0B\f\r,]"
_CUT = r"[:\->()]"
_TEXT = r"[^ \t\n\x0B\f\r,:\->()]"
_PIECE = rf"({_TEXT}*+)"
_CONVERTED = r"(?:(:++)(?=[ ,]|\z)|([^ ,:]*+)(?::([^ ,:]*+)[^ ,]*+)?+)"
SHORT_DATED = (
    rf"(?s)\A{_PLAIN}++{_BLANK}([A-Za-z]{{3}}){_BLANK}([0-9]{{1,2}}){_BLANK}{_CLOCK}{_PLAIN}*+"
    rf"(?:{_BLANK}{_PLAIN}++){{4}}{_BLANK}"
    rf"{_PIECE}{_CUT}{_PIECE}{_CUT}{_TEXT}*+{_CUT}{_PIECE}{_CUT}{_PIECE}{_CUT}"
    rf"(?={_CUT}*+{_TEXT}){_PIECE}[^,]*+,"
    rf"[^ ,]*+ [^ ,]*+ [^ ,]*+ (?= *+[^ ,]){_CONVERTED}.*+\z"
)
SHORT_PARTS = "$1\n$2\n$3\n=$8\n=$4\n=$5\n=$6\n=$7\n=$10\n=$11\n$9"

# Format B: Msg: 2021-06-07 09:07:06 w k=v,k=v,... of exactly five words. The
# items count by place: 1 protocol, 2 and 3 addresses, 4 and 5 ports, 6 and 7 the
# translated endpoint. An item without a value ends the list.
_NAME = r"[^ \t\n\x0B\f\r,=]"
_ITEM = rf",{_NAME}*+(=(?==*+{_NAME}){_NAME}*+)(?:={_PLAIN}*+)?+"


def full_dated(items: int) -> str:
    """Pattern of format B that reads the first ``items`` items."""
    later = ""
    for _ in range(items - 1):
        later = f"(?:{_ITEM}{later})?+"
    return (
        rf"\AMsg:{_BLANK}([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}){_BLANK}{_CLOCK}{_WORD}*+{_BLANK}"
        rf"{_WORD}++{_BLANK}{_PLAIN}*+{_ITEM}{later}{_WORD}*+\z"
    )


# Pattern and parts of all fields, and of just those that reports count.
ALL_FIELDS = (full_dated(7), "\n$1\n$2\n$3\n$4\n$6\n$5\n$7\n$8\n$9\n")
ADDRESSES_ONLY = (full_dated(3), "\n$1\n$2\n$3\n$4\n\n$5\n\n\n\n")

# Longer than any text.
MAX_TEXT = 2147483647

ADDRESSES = {"sourceIp", "targetIp", "convertedIp"}


def clean_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", clean(F.col("value")))


def _digits(value: Column, first: int, count: int) -> Column:
    tests = [F.substring(value, i, 1).between("0", "9") for i in range(first, first + count)]
    return reduce(Column.__and__, tests)


def is_host_line(value: Column) -> Column:
    """Exactly two digits, then a dot."""
    dotted = _digits(value, 1, 2) & (F.substring(value, 3, 1) == ".")
    return dotted & ~has_line_end(value)


def is_message(value: Column) -> Column:
    return value.startswith("Msg")


def is_dated(value: Column) -> Column:
    """Messages of format B: a digit follows the tag."""
    return value.startswith("Msg: ") & _digits(value, 6, 1) & ~has_line_end(value)


def host_of(value: Column) -> Column:
    """First four dot parts of the first word; NULL if it has fewer."""
    head = F.substring_index(value, " ", 1)
    return F.when(F.size(pieces(head, ".")) >= 4, F.substring_index(head, ".", 4))


def host_lines(lines: DataFrame) -> DataFrame:
    return lines.where(is_host_line(F.col("value")))


def msg_lines(lines: DataFrame) -> DataFrame:
    return lines.where(is_message(F.col("value")))


def hosts(lines: DataFrame) -> DataFrame:
    """One ``host`` per host line; lines without a whole address are left out."""
    return host_lines(lines).withColumn("host", host_of(F.col("value"))).where("host is not null")


def line_format(value: Column) -> Column:
    """``A`` or ``B`` for messages, ``host`` for host lines, else NULL."""
    return (
        F.when(is_dated(value), "B").when(is_message(value), "A").when(is_host_line(value), "host")
    )


def _read_fields(
    lines: DataFrame, year: int, listed: tuple[str, str] = ALL_FIELDS
) -> DataFrame:
    """Adds format, and for messages time, endpoint fields and why a line gives no session."""
    value = F.col("value")
    part = {name: F.get("_parts", F.lit(i)) for i, name in enumerate(PARTS)}
    missing = {"convertedIp": part["noConverted"] != ""}
    fields = {}
    for name in ENDPOINTS:
        unset = (part[name] == "") | missing.get(name, F.lit(False))
        default = NO_IP if name in ADDRESSES else ""
        fields[name] = F.when(unset, default).otherwise(F.substring(part[name], 2, MAX_TEXT))
    at = F.when(part["month"] == "", full_time(part["day"], part["clock"])).otherwise(
        short_time(part["month"], part["day"], part["clock"], year)
    )
    reason = (
        F.when(F.get("_parts", F.lit(len(PARTS) - 1)).isNull(), "shape")
        .when(F.col("accesstime").isNull(), "time")
        .when(F.col("sourceIp") == NO_IP, "source")
    )
    parts = F.when(F.col("format") == "B", F.regexp_replace(value, *listed)).when(
        F.col("format") == "A", F.regexp_replace(value, SHORT_DATED, SHORT_PARTS)
    )
    return (
        lines.withColumn("format", line_format(value))
        .withColumn("_parts", F.split(parts, "\n"))
        .withColumns({"accesstime": at, **fields})
        .withColumn("reason", reason)
        .drop("_parts")
    )


def _keep(parsed: DataFrame, test: Column, columns: list[Column | str]) -> DataFrame:
    """``where(test)`` without a second parse.

    Catalyst moves a filter below the projections that its columns come from, and
    the whole parse would run once in the filter and once more after it. A filter
    on what an outer explode gives stays where it is.
    """
    rows = parsed.select(F.when(test, F.array(F.struct(*columns))).alias("_rows"))
    rows = rows.select(F.explode_outer("_rows").alias("_row"))
    return rows.where(F.col("_row").isNotNull()).select("_row.*")


def parse_messages(lines: DataFrame, year: int) -> DataFrame:
    """Every ``Msg`` line with its format, time and fields, and a ``reason`` if it is no session.

    ``year`` completes the year-less time of format A. A line is a session if and
    only if its source address was set. ``lines`` must be clean.
    """
    return _read_fields(msg_lines(lines), year)


def _others(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != "value"]


def flows(lines: DataFrame, year: int, fields: list[str] = ENDPOINTS) -> DataFrame:
    """Session records of clean lines; other columns of ``lines`` are kept."""
    parsed = parse_messages(lines, year)
    return _keep(parsed, F.col("reason").isNull(), [*_others(lines), "accesstime", *fields])


def rejects(lines: DataFrame, year: int) -> DataFrame:
    """``Msg`` lines that gave no session, with the reason."""
    parsed = parse_messages(lines, year)
    return _keep(
        parsed, F.col("reason").isNotNull(), [*_others(lines), "value", "format", "reason"]
    )


def sessions_in(lines: DataFrame, year: int, line_format: str) -> DataFrame:
    """``flows`` of the messages of one format, ``A`` or ``B``."""
    dated = is_dated(F.col("value"))
    return flows(lines.where(dated if line_format == "B" else ~dated), year)


def with_row_key(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn(
        "rowkey", row_key(F.col("convertedIp"), F.col("convertedPort"), F.col("accesstime"))
    )


def secondary_index(sessions: DataFrame) -> DataFrame:
    """``(accesstime, partKey, rowkey)``: finds stored keys by both outer endpoints."""
    endpoints = ["targetIp", "targetPort", "convertedIp", "convertedPort"]
    key = part_key(*map(F.col, endpoints))
    return sessions.select("accesstime", key.alias("partKey"), "rowkey")


#: Kinds of what ``entries`` gives.
SESSION_ENTRY, HOST_ENTRY, REJECT_ENTRY = 0, 1, 2


def entries(lines: DataFrame, year: int) -> DataFrame:
    """All that lines give, in one pass: sessions, hosts, and messages that gave no session.

    A job stores this and takes every output from it, so a line is parsed once. ``kind`` says
    what a row is; columns of other kinds are NULL, so a row holds its line only if it was rejected.
    Other columns of ``lines`` are kept.
    """
    value = F.col("value")
    parsed = _read_fields(lines, year).withColumn("host", F.when(F.col("format") == "host", host_of(value)))
    message, session = F.col("format").isin("A", "B"), F.col("reason").isNull()
    kind = (
        F.when(message & session, SESSION_ENTRY)
        .when(message, REJECT_ENTRY)
        .when(F.col("host").isNotNull(), HOST_ENTRY)
    )
    is_a = lambda k, column: F.when(F.col("kind") == k, F.col(column)).alias(column)
    columns = [is_a(SESSION_ENTRY, c) for c in ("accesstime", *ENDPOINTS)]
    columns += ["host", *(is_a(REJECT_ENTRY, c) for c in ("value", "format", "reason"))]
    marked = parsed.withColumn("kind", kind)
    return _keep(marked, F.col("kind").isNotNull(), [*_others(lines), "kind", *columns])


def _entry_columns(stored: DataFrame) -> list[str]:
    own = {"kind", "host", "value", "format", "reason", "accesstime", *ENDPOINTS}
    return [c for c in stored.columns if c not in own]


def flows_of(stored: DataFrame) -> DataFrame:
    """``flows`` from stored entries."""
    return stored.where(F.col("kind") == SESSION_ENTRY).select(*_entry_columns(stored), "accesstime", *ENDPOINTS)


def rejects_of(stored: DataFrame) -> DataFrame:
    """``rejects`` from stored entries."""
    return stored.where(F.col("kind") == REJECT_ENTRY).select(*_entry_columns(stored), "value", "format", "reason")


def counted_of(stored: DataFrame) -> DataFrame:
    """``counted`` from stored entries."""
    none = F.lit(None).cast("timestamp")
    listed = F.when(F.col("kind") == HOST_ENTRY, F.array(_count(HOST, none, F.col("host")))).otherwise(_session_counts())
    counts = stored.where(F.col("kind") != REJECT_ENTRY).select(*_entry_columns(stored), F.explode(listed).alias("_entry"))
    return counts.select(*_entry_columns(stored), "_entry.*")


def _count(kind: str, at: Column, data: Column) -> Column:
    return F.struct(F.lit(kind).alias("types"), at.alias("accesstime"), data.alias("data"))


def _session_counts() -> Column:
    at = F.col("accesstime")
    return F.array(_count(TARGET, at, F.col("targetIp")), _count(SOURCE, at, F.col("sourceIp")))


def counted(lines: DataFrame, year: int) -> DataFrame:
    """``(types, accesstime, data)``: the host of each host line, target and source of each session.

    One pass over the lines; ``accesstime`` is NULL for hosts. Other columns of
    ``lines`` are kept.
    """
    value = F.col("value")
    kept = _others(lines)
    of_session = _session_counts()
    of_host = F.array(_count(HOST, F.lit(None).cast("timestamp"), F.col("_host")))
    parsed = _read_fields(lines, year, ADDRESSES_ONLY)
    host = parsed.withColumn("_host", F.when(F.col("format") == "host", host_of(value)))
    entries = F.when(F.col("_host").isNotNull(), of_host).when(
        F.col("format").isin("A", "B") & F.col("reason").isNull(), of_session
    )
    listed = host.select(*kept, entries.alias("_entries"))
    rows = listed.select(*kept, F.explode_outer("_entries").alias("_entry"))
    found = rows.where(F.col("_entry").isNotNull()).select(*kept, "_entry.*")
    # Never NULL, and said so: a join on it then adds no filter of its own below
    # the counts, and all dimensions share them.
    return found.withColumn("data", F.coalesce("data", F.lit("")))
