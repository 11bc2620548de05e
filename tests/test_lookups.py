"""Joins against brute force, and their plans."""

import random

from pyspark.sql import functions as F

from edgeledger.operators import lookups, ranges as spans_of
from edgeledger.sources import accounts

from conftest import executed_plan


def text(number):
    return ".".join(str(number >> shift & 255) for shift in (24, 16, 8, 0))


def disjoint_ranges(rng, n):
    edges = sorted(rng.sample(range(2**32), 2 * n))
    return [(edges[2 * i], edges[2 * i + 1]) for i in range(n)]


def geo_frame(spark, ranges):
    rows = [(lo, hi, f"p{i}", f"c{i % 5}", f"o{i % 3}") for i, (lo, hi) in enumerate(ranges)]
    return spark.createDataFrame(rows, "lo long, hi long, province string, city string, operator string")


def test_regions_equal_brute_force(spark):
    rng = random.Random(3)
    ranges = disjoint_ranges(rng, 40)
    ips = [text(rng.randrange(2**32)) for _ in range(300)]
    ips += [text(edge) for pair in ranges for edge in pair]
    frame = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    got = lookups.with_region(frame, "ip", geo_frame(spark, ranges)).collect()
    assert len(got) == len(ips)
    for row in got:
        a, b, c, d = map(int, row.ip.split("."))
        number = (a << 24) + (b << 16) + (c << 8) + d
        wanted = [f"p{i}" for i, (lo, hi) in enumerate(ranges) if lo <= number <= hi]
        assert [row.province] == (wanted or ["UnKnown"])


def test_region_of_texts_that_are_no_address(spark, rows):
    """They have the region of 0.0.0.0; an address without a range is unknown."""
    ranges = geo_frame(spark, [(0, 255), (16777216, 16777216 + 300 * 65536)])
    frame = spark.createDataFrame([(v,) for v in ("x", "1.2", "9.9.9.9", "1.1.1.1", "1.300.0.0")], "ip string")
    assert rows(lookups.with_region(frame, "ip", ranges), "ip", "province") == [
        ("1.1.1.1", "p1"), ("1.2", "p0"), ("1.300.0.0", "UnKnown"), ("9.9.9.9", "UnKnown"), ("x", "p0"),
    ]


def test_region_join_without_broadcast(spark, rows):
    rng = random.Random(5)
    ranges = geo_frame(spark, disjoint_ranges(rng, 30))
    frame = spark.createDataFrame([(text(rng.randrange(2**32)),) for _ in range(200)], "ip string")
    small = rows(lookups.with_region(frame, "ip", ranges))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {key: spark.conf.get(key) for key in keys}
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        joined = lookups.with_region(frame, "ip", ranges)
        plan = executed_plan(joined)
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert rows(joined) == small
    finally:
        for key in keys:
            spark.conf.set(key, before[key])


def test_wide_range_grows_by_cells_only(spark):
    grid = spans_of.on_grid(geo_frame(spark, [(0, 2**32 - 1)]))
    assert grid.count() == 65536
    assert spans_of.on_grid(geo_frame(spark, [(5, 4)])).count() == 0


def rows_made(frame) -> dict[str, int]:
    """The most rows that any node of a kind gave in one run of ``frame``."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.collect()
    most, todo = {}, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        count = node.metrics().get("numOutputRows")
        if count.isDefined():
            most[name] = max(most.get(name, 0), count.get().value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return most


def test_every_address_of_a_cell_as_a_range(spark):
    """Ranges and addresses fill one cell: rows stay in proportion, and every address finds its own range."""
    n = 65536
    first = 100 << 24
    geo = spark.range(n).selectExpr(f"id + {first} as lo", f"id + {first} as hi", "cast(id as string) province", "'o' operator", "'c' city")
    ips = spark.range(n).selectExpr("concat('100.0.', id div 256, '.', id % 256) ip", "id")
    joined = lookups.with_region(ips, "ip", geo)
    assert joined.where("province = cast(id as string)").count() == n
    made = rows_made(lookups.with_region(ips, "ip", geo))
    assert max(made.values()) <= 2 * n + 300, made

    apps = spark.range(n).selectExpr(
        "cast(id as int) position", f"{first} + id as lo", f"{first} + {n} as hi", "cast(id as string) app"
    )
    named = lookups.app_names(ips, "ip", apps)
    assert named.join(ips, "ip").where("app = cast(id as string)").count() == n
    made = rows_made(named)
    assert max(made.values()) <= 33 * 2 * n, made


def test_salted_lookup(spark, rows):
    rng = random.Random(9)
    geo = geo_frame(spark, disjoint_ranges(rng, 30))
    ips = [text(rng.randrange(2**32)) for _ in range(50)]
    frame = spark.createDataFrame([(rng.choice(ips[:3]) if k % 3 else ips[k % 50], k) for k in range(400)], "ip string, n int")
    assert rows(lookups.with_region(frame, "ip", geo, salts=7)) == rows(lookups.with_region(frame, "ip", geo))


def test_ranges_beyond_the_addresses(spark, rows):
    geo = geo_frame(spark, [(-70000, 5), (2**32 - 3, 2**33)])
    frame = spark.createDataFrame([(v,) for v in ("0.0.0.5", "0.0.0.6", "255.255.255.255", "255.255.255.252")], "ip string")
    assert rows(lookups.with_region(frame, "ip", geo), "ip", "province") == [
        ("0.0.0.5", "p0"), ("0.0.0.6", "UnKnown"), ("255.255.255.252", "UnKnown"), ("255.255.255.255", "p1"),
    ]
    apps = spark.createDataFrame([(1, -5, 2**40, "all"), (2, 2**32 - 1, 2**32, "last")], "position int, lo long, hi long, app string")
    assert rows(lookups.app_names(frame, "ip", apps), "ip", "app") == [
        ("0.0.0.5", "all"), ("0.0.0.6", "all"), ("255.255.255.252", "all"), ("255.255.255.255", "last"),
    ]


def test_disjoint_ranges(spark, rows):
    """The last range that starts at or before an address holds, if it reaches it."""
    rng = random.Random(3)
    spans = [tuple(sorted(rng.sample(range(2**26), 2))) for _ in range(80)]
    spans += [(5, 9), (5, 20), (7, 7), (30, 29), (2**25, 2**25), (2**25, 2**26)]
    frame = spark.createDataFrame([(a, b, f"p{k}") for k, (a, b) in enumerate(spans)], "lo long, hi long, p string")
    cut = rows(spans_of.disjoint(frame))
    assert all(a[1] < b[0] for a, b in zip(sorted(cut), sorted(cut)[1:]))
    for n in [*(rng.randrange(2**26) for _ in range(300)), 5, 7, 8, 20, 2**25, 2**25 + 1]:
        before = [(a, b, k) for k, (a, b) in enumerate(spans) if a <= n and a <= b]
        wanted = max(before, key=lambda r: (r[0], r[1], [-ord(c) for c in f"p{r[2]}"]), default=None)
        got = [p for a, b, p in cut if a <= n <= b]
        assert got == ([f"p{wanted[2]}"] if wanted and wanted[1] >= n else [])


def test_places_are_not_counted_twice(spark, rows):
    geo = spark.createDataFrame(
        [(0, 2**32 - 1, "a", "a", "a"), (16777216, 2 * 16777216, "b", "b", "b")],
        "lo long, hi long, province string, operator string, city string",
    )
    ips = spark.createDataFrame([("1.2.3.4",), ("0.2.3.4",), ("9.9.9.9",)], "ip string")
    assert rows(lookups.with_region(ips, "ip", geo), "ip", "city") == [
        ("0.2.3.4", "a"), ("1.2.3.4", "b"), ("9.9.9.9", "UnKnown"),
    ]


def test_account_join_keeps_rows(spark, rows):
    texts = ['{"ip":"a","account":"u1"}', '{"ip":"a","account":"u2"}', '{"ip":"b"}', "bad", '{"account":"z"}']
    values = spark.createDataFrame([(t,) for t in texts], "value string")
    dim = accounts.radius_sessions(values)
    assert rows(dim) == [("a", "u2"), ("b", None)]
    sessions = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "sourceIp string, n int")
    assert rows(lookups.with_account(sessions, dim), "n", "username") == [
        (1, "u2"), (2, "u2"), (3, "UnKnown"), (4, "UnKnown"),
    ]
    assert rows(accounts.ip_of_account(dim, "u2")) == [("u2", "a")]
    assert rows(accounts.ip_of_account(dim, "nobody")) == [("nobody", "null")]


def test_last_application_wins(spark, rows):
    ranges = spark.createDataFrame(
        [(0, 0, 100, "a"), (1, 50, 200, "b"), (2, 60, 61, "c")], "position int, lo long, hi long, app string"
    )
    ips = spark.createDataFrame([(text(n),) for n in (0, 50, 60, 61, 99, 199, 200)], "ip string")
    assert rows(lookups.app_names(ips, "ip", ranges)) == sorted(
        [(text(0), "a"), (text(50), "b"), (text(60), "c"), (text(61), "b"), (text(99), "b"),
         (text(199), "b"), (text(200), "其他")], key=repr
    )


def test_overlapping_wide_ranges(spark):
    """Against brute force; the cut pieces are no more than the ends of ranges."""
    rng = random.Random(11)
    spans = [sorted(rng.sample(range(2**26), 2)) for _ in range(60)]
    spans += [(5 * 65536, 6 * 65536), (5 * 65536 + 1, 6 * 65536 - 1)]
    ranges = spark.createDataFrame(
        [(i, lo, hi, f"a{i}") for i, (lo, hi) in enumerate(spans)],
        "position int, lo long, hi long, app string",
    )
    pieces = sorted(tuple(r) for r in spans_of.last_covers(ranges).select("lo", "hi").collect())
    assert len(pieces) <= 2 * len(spans) and all(a[1] < b[0] for a, b in zip(pieces, pieces[1:]))
    numbers = [rng.randrange(2**26) for _ in range(400)] + [e + d for p in spans for e in p for d in (-1, 0)]
    ips = spark.createDataFrame([(text(n),) for n in numbers if n >= 0], "ip string")
    got = dict(tuple(r) for r in lookups.app_names(ips, "ip", ranges).collect())
    for n in numbers:
        if n >= 0:
            wanted = [f"a{i}" for i, (lo, hi) in enumerate(spans) if lo <= n < hi]
            assert got[text(n)] == (wanted[-1] if wanted else "其他")


def test_activity_lists_every_subscriber(spark, rows):
    people = spark.createDataFrame(
        [("u1", "1", "2", "3", "4"), ("u2", "1", "2", "3", "4")],
        "username string, rid1 string, rid2 string, rid3 string, rid4 string",
    )
    daily = spark.createDataFrame([("u1", 7), ("other", 9)], "username string, count long")
    joined = lookups.with_activity(people, daily, F.lit("2024-01-01").cast("timestamp"))
    assert rows(joined, "username", "resolver") == [("u1", 7), ("u2", 0)]
