"""Parser rules: fixed lines, and random damage against a plain model of the format."""

import random
import re
from datetime import datetime

from edgeledger.operators import parse

B = (
    "Msg: 2021-06-07 09:07:06 fw1 k0=v,proto=UDP,sip=192.0.2.41,dip=198.51.100.48,"
    "sport=44652,dport=1939,nip=203.0.113.32,nport=14872"
)
A = (
    "Msg: Jun  7 09:07:06 2200000000000017(root) 10000001 Traffic@FLOW: NAT: "
    "192.0.2.41:44652->198.51.100.48:1939(UDP), snat to 203.0.113.32:14872, vr vr-one, "
    "user -@UNKNOWN, host -, rule 7"
)
FULL = {
    "accesstime": datetime(2021, 6, 7, 9, 7, 6), "protocol": "UDP", "sourceIp": "192.0.2.41",
    "sourcePort": "44652", "targetIp": "198.51.100.48", "targetPort": "1939",
    "convertedIp": "203.0.113.32", "convertedPort": "14872",
}
FULL_A = {**FULL, "accesstime": datetime(2024, 6, 7, 9, 7, 6)}
NO_NAT = {"convertedIp": "0.0.0.0", "convertedPort": ""}

GOLDEN = [
    (B, FULL),
    ("\t" + B + "\r", FULL),
    (B.replace("proto=UDP", "proto"), None),
    (B.replace("proto=UDP", "proto="), None),
    (B.replace("sip=192.0.2.41", "sip="), None),
    (B.replace("sip=192.0.2.41", "sip=0.0.0.0"), None),
    (
        B.replace("dip=198.51.100.48", "dip="),
        {**FULL, "sourcePort": "", "targetIp": "0.0.0.0", "targetPort": "", **NO_NAT},
    ),
    (B.replace("sport=44652", "sport="), {**FULL, "sourcePort": "", "targetPort": "", **NO_NAT}),
    (B.replace("nip=203.0.113.32", "nip"), {**FULL, **NO_NAT}),
    (B.replace(",nport=14872", ""), {**FULL, "convertedPort": ""}),
    (B.replace("sport=44652", "sport=44652=9"), FULL),
    (B.replace("sport=44652", "sport==9"), {**FULL, "sourcePort": ""}),
    (B.replace("fw1 ", ""), None),
    (B + " tail", None),
    (B.replace("09:07:06", "xx:07:06"), None),
    (A, FULL_A),
    (A.replace(":14872", ""), {**FULL_A, "convertedPort": ""}),
    (A.replace("(UDP)", ""), None),
    (A.replace("(UDP)", "()"), None),
    (A[: A.index(",")], None),
    (A.replace("Jun", "Jux"), None),
    (A.replace("snat", "dnat"), FULL_A),
    ("hello", None),
    # Text after the seconds is cut; fields out of range are no time.
    (B.replace("09:07:06", "09:07:06.123"), FULL),
    (B.replace("09:07:06", "25:07:06"), None),
    (A.replace("Jun  7", "Feb 30"), None),
    # The translated endpoint is the fourth text between single spaces.
    (A.replace("203.0.113.32:14872", ":::"), {**FULL_A, **NO_NAT}),
    (A.replace("203.0.113.32:14872", ":9"), {**FULL_A, "convertedIp": "", "convertedPort": "9"}),
    (A.replace(" snat to", " snat  to"), {**FULL_A, "convertedIp": "to", "convertedPort": ""}),
]


def test_golden_lines(spark):
    frame = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(GOLDEN)], "n int, value string")
    got = {r.n: r.asDict() for r in parse.flows(parse.clean_lines(frame), 2024).collect()}
    for i, (line, wanted) in enumerate(GOLDEN):
        found = got.get(i)
        assert (found and {k: found[k] for k in FULL}) == wanted, line


def java_split(text, pattern):
    found = re.split(pattern, text)
    if found == [text]:
        return found
    while found and found[-1] == "":
        found.pop()
    return found


def model(line, year):
    """Fields in the order they are set; the first that fails leaves the rest alone."""
    got = {"sourceIp": "0.0.0.0", "targetIp": "0.0.0.0", "convertedIp": "0.0.0.0"}
    got |= {"protocol": "", "sourcePort": "", "targetPort": "", "convertedPort": ""}
    space = r"[ \t\n\x0b\f\r]+"
    try:
        if re.fullmatch(r"Msg: [0-9]+.*", line):
            words = java_split(line, space)
            got["accesstime"] = datetime.strptime(f"{words[1]} {words[2]}", "%Y-%m-%d %H:%M:%S")
            items = java_split(words[4], ",")
            names = ["protocol", "sourceIp", "targetIp", "sourcePort", "targetPort"]
            names += ["convertedIp", "convertedPort"]
            for i, name in enumerate(names, 1):
                if i > 1 and len(words) != 5:
                    break
                got[name] = java_split(items[i], "=")[1]
        else:
            segments = java_split(line, ",")
            words = java_split(segments[0], space)
            at = datetime.strptime(f"{words[1]} {words[2]} {words[3]} {year}", "%b %d %H:%M:%S %Y")
            ends = java_split(words[8], r"[:\->()]")
            nat = java_split(java_split(segments[1], " ")[3], "[ :]")
            got["accesstime"] = at
            for name, i in [("protocol", 5), ("sourceIp", 0), ("targetIp", 3)]:
                got[name] = ends[i]
            got["sourcePort"], got["targetPort"] = ends[1], ends[4]
            got["convertedIp"] = nat[0]
            got["convertedPort"] = nat[1]
    except (IndexError, ValueError):
        pass
    return None if got["sourceIp"] == "0.0.0.0" else got


def damaged(line, rng):
    chars = list(line)
    for _ in range(rng.choice([1, 1, 2, 3, 5])):
        at = rng.randrange(5, len(chars))
        action = rng.random()
        if action < 0.4:
            del chars[at : at + rng.choice([1, 1, 2, 8])]
        elif action < 0.8:
            chars.insert(at, rng.choice(list(" ,=:->()=,\t x")))
        else:
            chars[at] = rng.choice(list(" ,=:->()9"))
    return "".join(chars).strip()


def test_damaged_lines_equal_model(spark):
    rng = random.Random(7)
    lines = [damaged(rng.choice([A, B]), rng) for _ in range(4000)]
    frame = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = {r.n: r.asDict() for r in parse.flows(frame, 2024).collect()}
    kept = 0
    for i, line in enumerate(lines):
        wanted = model(line, 2024)
        found = got.get(i)
        if _odd_time(line):
            continue
        kept += wanted is not None
        assert (found and {k: found[k] for k in FULL}) == wanted, line
    assert kept > 800

    # The counting pass reads fewer items of format B and must find the same.
    ends = sorted((r.n, r.types, r.data) for r in parse.counted(frame, 2024).collect() if r.types != "hostIP")
    assert ends == sorted(
        (n, name, found[name]) for n, found in got.items() for name in ("sourceIp", "targetIp")
    )


def _odd_time(line):
    """Times that only one of the two date readers takes, such as 09:07: 6 or 009:07:06."""
    return not re.match(
        r"Msg: (2021-06-07|Jun {1,2}7) 09:07:06[ \t]", re.sub(r"\t", " ", line)
    )


def test_hosts_need_two_digits_and_four_parts(spark, rows):
    lines = [
        "10.254.1.2.2000 > 30.1.1.1.514: x", "192.0.2.4.5 > x", "3.2.3.4.5 > x", "10.254.1 > x",
        "10.254.1.2 > x", "Msg: 30.1.1.1.1", "30x",
    ]
    frame = spark.createDataFrame([(v,) for v in lines], "value string")
    assert rows(parse.hosts(frame), "host") == [("10.254.1.2",), ("10.254.1.2",)]
    counted = parse.counted(frame, 2024)
    assert rows(counted, "types", "data") == [("hostIP", "10.254.1.2")] * 2


def test_rejects_hold_every_other_message(spark):
    frame = spark.createDataFrame([(line,) for line, _ in GOLDEN], "value string")
    lines = parse.clean_lines(frame)
    reasons = {r.value: r.reason for r in parse.rejects(lines, 2024).collect()}
    messages = [line.strip() for line, want in GOLDEN if want is None and line != "hello"]
    assert set(reasons) == set(messages)
    assert reasons[B.replace("sip=192.0.2.41", "sip=0.0.0.0")] == "source"
    assert reasons[A.replace("Jun", "Jux")] == "time"
    assert reasons[A.replace("(UDP)", "")] == "shape"


def test_other_columns_stay(spark, rows):
    frame = spark.createDataFrame([(1, B), (2, "x"), (3, A)], "n int, value string")
    assert rows(parse.flows(frame, 2024), "n") == [(1,), (3,)]
    assert rows(parse.counted(frame, 2024), "n", "types") == [
        (1, "sourceIp"), (1, "targetIp"), (3, "sourceIp"), (3, "targetIp"),
    ]


def test_parse_runs_once(spark):
    """No filter repeats the patterns below the projection that uses them."""
    frame = spark.createDataFrame([(B,)], "value string")
    for parsed in (parse.flows(frame, 2024), parse.counted(frame, 2024)):
        plan = parsed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 2
