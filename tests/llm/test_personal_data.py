"""Base spans against plain regular expressions; what trees add; redaction."""

import hashlib
import random
import re

import numpy as np

from edgeledger.llm import pii_boost
from tests.llm import cases
from pyspark.sql import functions as F


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out, text = [], text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def noise(n, seed=1):
    rng = random.Random(seed)
    return [(10_000 + k, "".join(rng.choice("a@.1 2-+()é\U0001f6005.7_%x") for _ in range(rng.randint(0, 70))), None, None, 0) for k in range(n)]


FIXED = [
    (1, "mail a@b.cd_ef@g.hi or 1.2.3.4.5, 256.1.1.1 0255.1.1.1 and 4111 1111 1111 1111", None, None, 0),
    (2, "é\U0001f600 +1 (476) 555-5473 x@y.z", None, None, 0),
    (3, "a" * 30_000 + "@" + "b." * 5000, None, None, 0),
    (4, "1" * 30_000 + " 1.1.1", None, None, 0),
]


def test_base_spans(spark):
    docs = cases.table(spark, cases.ODD + FIXED + noise(800)).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    rows = [(r["row"], r["doc_id"], r["text"]) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "row long, doc_id long, text string")
    got = {r["row"]: r for r in pii_boost.personal_data(docs).collect()}
    assert len(got) == len(rows)
    for row, _, text in rows:
        found = [tuple(x) for x in got[row]["base"]]
        assert found == base(text)
        assert set(found) <= {tuple(x) for x in got[row]["spans"]}


def test_trees_add_numbers_that_look_like_valid_ones(spark):
    rows = [(k, k, f"word call +1 ({200 + k % 700}) 555-{1000 + k} end") for k in range(300)]
    rows += [(1000 + k, 1000 + k, f"word call (476) 555-{2000 + k} end") for k in range(20)]
    rows += [(2000 + k, 2000 + k, f"number {10**15 + 7919 * k}x of {k}-{k}") for k in range(300)]
    got = pii_boost.personal_data(spark.createDataFrame(rows, "row long, doc_id long, text string"))
    spans = {r["row"]: r for r in got.collect()}
    assert all(spans[1000 + k]["base"] == [] and len(spans[1000 + k]["spans"]) == 1 for k in range(20))
    assert all(spans[2000 + k]["spans"] == spans[2000 + k]["base"] for k in range(300))


def test_loose_numbers_need_no_hyphen(spark):
    texts = ["call 555.123.4567 now", "call (555) 123 4567 now", "call 555 123 4567", "call (555) 123-4567 - or not"]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    found = pii_boost.candidates(docs).where("gen = 5").orderBy("row").collect()
    assert [(r["row"], texts[r["row"]][r["start"] : r["end"]]) for r in found] == [
        (0, "555.123.4567"), (1, "(555) 123 4567"), (2, "555 123 4567"), (3, "(555) 123-4567"),
    ]


def test_trees_and_their_columns_agree(spark):
    rng = np.random.default_rng(2)
    table = {f: rng.integers(0, n, 400) for f, n in pii_boost.LEVELS.items()}
    right = ((table["digits"] > 3) & (table["marks"] < 2)) * 5.0
    trees = pii_boost.boosted(table, right, 5 - right)
    margin = sum(pii_boost._value(t, table) for t in trees)
    assert ((margin > 0) == (right > 0)).all()
    frame = spark.createDataFrame([tuple(int(table[f][k]) for f in table) for k in range(50)], list(table))
    column = sum((pii_boost._column(t) for t in trees), F.lit(0.0))
    assert np.allclose([r[0] for r in frame.select(column).collect()], margin[:50])
    assert pii_boost.boosted({f: np.zeros(0, int) for f in table}, np.zeros(0), np.zeros(0)) == []


def test_redaction(spark):
    docs = spark.createDataFrame([(1, 1, "é mail a@b.cd or +1 (476) 555-5473."), (2, 2, ""), (3, 3, "clean")], "row long, doc_id long, text string")
    found = docs.join(pii_boost.personal_data(docs).drop("doc_id"), "row").orderBy("row")
    texts = [r[0] for r in found.select(pii_boost.redacted(F.col("text"), F.col("base"))).collect()]
    assert texts == ["é mail [email] or [phone].", "", "clean"]


def test_query_columns(spark, tmp_path):
    folder = cases.on_disk(cases.table(spark, FIXED[:2] + cases.ODD), tmp_path)
    got = {r["doc_id"]: r for r in pii_boost.op6_personal_data(spark, folder).collect() if r["doc_id"] in (1, 2)}
    text = FIXED[1][1]
    spans = ",".join(f"{pii_boost.KINDS[k]}:{a}:{b}" for a, k, b in base(text))
    row = [r for r in pii_boost.op6_personal_data(spark, folder).collect() if r["n_phone"]][0]
    assert got and row["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    empty = cases.on_disk(cases.empty(spark), tmp_path / "empty")
    assert pii_boost.op6_personal_data(spark, empty).count() == 0
