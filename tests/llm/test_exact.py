"""Block naming against equality of whole texts."""

import hashlib
import string

import pytest

from edgeledger.llm import block_names
from edgeledger.llm.common import numbered, slim
from tests.llm import cases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for place, (doc_id, text) in enumerate(rows):
        groups.setdefault((text or "").translate(LOWER), []).append((doc_id is not None, doc_id or 0, place))
    out = []
    for text, members in groups.items():
        known, top, _ = max(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(k and i or (i if k else None), top if known else None, len(members), sha) for k, i, _ in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,bits", [(4096, 64), (7, 64), (40, 3), (5, 1)])
def test_groups(spark, size, bits):
    stored, row = numbered(cases.odd(spark).limit(30) if size < 10 else cases.odd(spark), "t")
    got = block_names.exact_groups(slim(stored, row), size, bits)
    rows = [(r["doc_id"], r["text"]) for r in stored.collect()]
    plain = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got.collect()), key=repr)
    assert plain == brute(rows)
    kept = got.where("kept").groupBy("text_sha256").count()
    assert {r["count"] for r in kept.collect()} == {1}


def test_blocks_that_only_meet_at_another_place_differ(spark):
    texts = ["abcdefgh", "efghabcd", "abcdabcd", "abcd", "abcdabcdabcd", "abcdefgh"]
    stored, row = numbered(cases.table(spark, [(k, t, None, None, 0) for k, t in enumerate(texts)]), "t")
    got = {r["doc_id"]: r["keep_id"] for r in block_names.exact_groups(slim(stored, row), 4).collect()}
    assert got == {0: 5, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5}


def test_survivors_keep_their_columns(spark):
    docs = cases.clashing(spark).union(cases.clashing(spark).where("doc_id < 110"))
    left = block_names.deduplicate(docs)
    assert left.columns == docs.columns
    assert left.count() == len(cases.PLAIN)


def test_empty(spark):
    stored, row = numbered(cases.empty(spark), "t")
    assert block_names.exact_groups(slim(stored, row)).count() == 0
    assert block_names.deduplicate(cases.empty(spark)).count() == 0
