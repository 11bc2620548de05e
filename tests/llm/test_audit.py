"""Survival words and carry-save counts against plain counting over every order."""

import re
from itertools import permutations

import numpy as np
import pytest

from edgeledger.llm import filter_audit
from tests.llm import cases


def plain(docs, marks):
    """The table by applying the filters one after another to each document."""
    rows = [(i, t or "", s or "") for i, t, _, s, *_ in docs]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}

    def fails(i, t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {
            f
            for f, bad in zip(
                "ABCDE",
                [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 bool(re.search("[#$%&*|]", t)), i is not None and i > first[t]],
            )
            if bad
        }

    out, shapley = {}, {}
    parts = {}
    for i, t, s in rows:
        parts.setdefault(s, []).append((i, fails(i, t)))
    for part, members in parts.items():
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in m[1] for m in members) - len(gone), sum(m[1] == {f} for m in members),
                    sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone),
                ]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
MARKS = [(101, 1, 0), (101, 0, 1), (102, 1, None), (103, 0, 1), (4, 1, 1), (None, 1, 1), (9999, 1, 1), (500, 1, 0), (501, None, 1)]


def as_dict(frame):
    got = frame.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in NAMES) for r in got}
    assert len(found) == len(got)
    return found


def long_rows():
    """Texts of 200 words and more that fail each filter and no other, and copies of them."""
    fine = cases.sentence(3, 260)
    texts = [fine, "same " * 300, fine + " " + "X" * 90, fine + " $", fine, "same " * 300, fine + " É" * 50]
    return [(500 + k, t, "en", "s" if k % 2 else None, 0) for k, t in enumerate(texts)] + [(None, fine, "en", "s", 0)]


@pytest.mark.parametrize("shared", [0, 3])
def test_against_plain_counts(spark, shared):
    docs = cases.ODD + cases.PLAIN + long_rows() * (1 + shared)
    marks = spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")
    assert as_dict(filter_audit.audit(cases.table(spark, docs), marks)) == plain(docs, MARKS)


def test_planes_count_every_bit():
    rng = np.random.default_rng(1)
    planes, total = filter_audit.Planes(), np.zeros(32, np.int64)
    for n in (0, 1, 2, 3, 7, 1000, 4097):
        words = rng.integers(0, 2**32, n, dtype=np.uint32)
        planes.add(words)
        total += ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(0).astype(np.int64)
        assert all(len(p) < 3 for p in planes.planes)
    assert planes.counts() == total.tolist()
    assert len(planes.planes) <= 14


def test_words_of_masks():
    for mask in range(32):
        assert [bool(int(filter_audit.WORD_OF[mask]) >> s & 1) for s in range(32)] == [mask & s == 0 for s in range(32)]


def test_many_parts_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 2)
    docs = [(k, f"text {k}", "en", f"s{k % 9}", 0) for k in range(90)]
    marks = spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")
    assert as_dict(filter_audit.audit(cases.table(spark, docs), marks)) == plain(docs, MARKS)


def test_empty_and_clashing(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(cases.empty(spark), marks).count() == 0
    more = cases.clashing(spark).selectExpr("*", "1 as part", "2 as fails", "3 as digest", "4 as first", "5 as label")
    assert as_dict(filter_audit.audit(more, marks.selectExpr("*", "1 as part", "2 as good"))) == plain(cases.PLAIN, [])
