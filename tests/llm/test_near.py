"""Near duplicates against all pairs, on the full shingle sets."""

import random
from itertools import combinations
from math import comb

import numpy as np

from edgeledger.llm import minhash
from edgeledger.llm.common import numbered, slim
from edgeledger.llm.words import WordHashes, shingle_set
from tests.llm import cases


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def roots(rows, size, percent):
    sets, parent = [shingles(t, size) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[find(b)] = find(a)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least.setdefault(find(k), []).append(doc_id)
    known = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((rows[k][0], len(sets[k]), known[find(k)]) for k in range(len(rows))), key=repr)


def families():
    """Families of copies with single words changed, and texts that share a long passage."""
    rng, rows = random.Random(5), []
    passage = cases.sentence(400, 40)
    for family in range(6):
        base = cases.sentence(family + 50, 40 + 30 * family).split()
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, 4 + family)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((1000 + len(rows), " ".join(copy), None, None, 0))
    for k in range(30):
        rows.append((5000 + k, passage + " " + cases.sentence(700 + k, 30), None, None, 0))
    return rows


def test_components(spark):
    docs = cases.table(spark, cases.ODD + cases.PLAIN + families())
    for size, percent in ((3, 85), (5, 80)):
        stored, row = numbered(docs, "t")
        got = minhash.near_groups(slim(stored, row), size, percent)
        plain = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr)
        assert plain == roots([(r["doc_id"], r["text"]) for r in stored.collect()], size, percent)
        for r in got.collect():
            assert r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"])


def twins(families=60, n=400):
    """Two near copies in each family of a text that is not there; copies of different families are not near."""
    rng, base, rows = random.Random(8), [f"base{k}" for k in range(n)], []
    for family in range(families):
        first = list(base)
        for at in rng.sample(range(0, n, 5), 7):
            first[at] = f"own{family}x{at}"
        second = list(first)
        for at in rng.sample(range(2, n, 5), 8):
            second[at] = f"other{family}x{at}"
        rows += [(10 * family + k, " ".join(t), None, None, 0) for k, t in enumerate((first, second))]
    return rows


def test_copies_without_their_original_are_linked(spark):
    rows = twins()
    wanted = roots([(r[0], r[1]) for r in rows], 3, 85)
    assert sum(doc_id != root for doc_id, _, root in wanted) >= 60
    stored, row = numbered(cases.table(spark, rows), "t")
    got = minhash.near_groups(slim(stored, row), 3, 85).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == wanted


def drifted(copies=90, n=300, changed=22):
    """Copies of a text that is not there, each changed in places of its own: a few are near each other, most are not."""
    rng, base, rows = random.Random(4), cases.sentence(31, n).split(), []
    for k in range(copies):
        copy = list(rows[-1][1].split()) if k % 9 == 1 else list(base)
        for at in rng.sample(range(n), 4 if k % 9 == 1 else changed):
            copy[at] = f"at{k}x{at}"
        rows.append((k, " ".join(copy), None, None, 0))
    return rows


def test_mixed_buckets_are_banded_anew(spark, monkeypatch):
    rows, rounds = drifted(), []
    anew = minhash.banded_anew
    monkeypatch.setattr(minhash, "FEW", 2)
    monkeypatch.setattr(minhash, "banded_anew", lambda *a: rounds.append(1) or anew(*a))
    stored, row = numbered(cases.table(spark, rows), "t")
    got = minhash.near_groups(slim(stored, row), 3, 85).collect()
    wanted = roots([(r[0], r[1]) for r in rows], 3, 85)
    assert rounds and 5 <= sum(doc_id != root for doc_id, _, root in wanted) <= 80
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == wanted


def test_sketches_drop_no_near_pair():
    """The bound against exact binomial tails, and drawn sets at and far below the threshold."""
    least = minhash.least_equal(85)
    for k in (5, 40, 130, minhash.BINS):
        tail = sum(comb(k, m) * 0.85**m * 0.15 ** (k - m) for m in range(least[k]))
        assert tail <= minhash.DROPPED
    assert least[minhash.BINS] > minhash.BINS // 2 and least[5] == 0
    rng, probes = np.random.default_rng(2), minhash._probes()
    for n in (3, 50, 400, 5000):
        for share, dropped in ((0.85, False), (0.3, True)) if n >= 400 else ((0.85, False),):
            union = rng.integers(0, 2**64 - 1, n, dtype=np.uint64)
            both = int(np.ceil(n * share))
            a, b = np.sort(union[: both + (n - both) // 2]), np.sort(np.r_[union[:both], union[both + (n - both) // 2 :]])
            x, y = minhash.signature(a, probes)[0], minhash.signature(b, probes)[0]
            equal, filled = ((x == y) & (x != 0)).sum(), ((x | y) != 0).sum()
            assert (equal < least[filled]) == dropped


def test_one_of_each_group_stays(spark):
    docs = cases.clashing(spark).union(cases.clashing(spark))
    left = minhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in cases.PLAIN)
    assert minhash.deduplicate(cases.empty(spark)).count() == 0


def test_texts_without_words_stay(spark):
    docs = cases.table(spark, [(1, "", None, None, 0), (2, " ", None, None, 0), (3, None, None, None, None)])
    assert minhash.deduplicate(docs).count() == 3


def test_densified_bins_agree_as_the_sets_do():
    hashes, probes = WordHashes(), minhash._probes()
    for n in (1, 2, 7, 60, 800):
        a = shingle_set(cases.sentence(9, n).encode(), 3, hashes)
        b = shingle_set((cases.sentence(9, n) + " more words here").encode(), 3, hashes)
        share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = (minhash.densified(a, probes) == minhash.densified(b, probes)).mean()
        assert abs(same - share) < 0.25
        assert (minhash.densified(a, probes) == minhash.densified(a.copy(), probes)).all()


def test_chains_and_stars_become_components(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(30)] + [(7, 7)]
    got = minhash.components(spark.createDataFrame(links, "a long, b long"))
    assert {(r["node"], r["root"]) for r in got.collect()} == (
        {(k, 0) for k in range(1, 61)} | {(200 + k, 100) for k in range(30)}
    )


def test_pairs_of_a_few_nodes_are_those_that_the_plain_rule_names(spark, monkeypatch):
    """Groups of several sizes, one of them of one component, against each pair by itself; pairs of larger groups are
    compared in a task, so that only those that stay are rows."""
    rng, rows = np.random.default_rng(6), []
    base = rng.integers(1, 256, minhash.BINS, dtype=np.uint8)
    for bucket, size in enumerate((2, 5, 5, 9, 1, 3)):
        for k in range(size):
            sketch = np.where(rng.random(minhash.BINS) < 0.1 * rng.random(), 0, base).astype(np.uint8)
            own = rng.random(minhash.BINS) < 0.3 * rng.random()
            sketch[own] = rng.integers(1, 256, own.sum())
            node = 100 * bucket + 10 - k
            rows.append((bucket, node, 100 + int(rng.integers(0, 30)), 7 if bucket == 5 else node // 2, sketch.tobytes()))
    least, wanted = minhash.least_equal(85), set()
    for x, y in combinations(rows, 2):
        s, t = (np.frombuffer(r[4], np.uint8) for r in (x, y))
        if x[0] == y[0] and x[3] != y[3] and 100 * min(x[2], y[2]) >= 85 * max(x[2], y[2]):
            if ((s == t) & (s != 0)).sum() >= least[((s | t) != 0).sum()]:
                wanted.add((min(x[1], y[1]), max(x[1], y[1])))
    live = [(bucket, node, n, root, sum(r[0] == bucket for r in rows)) for bucket, node, n, root, _ in rows]
    live = spark.createDataFrame(live, "bucket long, node long, n long, root long, size long")
    nodes = spark.createDataFrame([(r[1], r[4]) for r in rows], "node long, sketch binary")
    paired, alike = [], minhash.alike
    monkeypatch.setattr(minhash, "alike", lambda pairs, *rest: paired.append(pairs) or alike(pairs, *rest))
    for as_rows in (0, 4, 100):
        monkeypatch.setattr(minhash, "AS_ROWS", as_rows)
        pairs, rest = minhash.further_pairs(live, nodes, 1, 85)
        assert {tuple(r) for r in pairs.collect()} == wanted and 3 <= len(wanted) <= 50 and rest.count() == 0
    rows_, few_rows, all_rows = (frame.count() for frame in paired)
    assert rows_ == 0 and few_rows < len(wanted) < all_rows


def test_the_centre_of_a_bucket_shares_most_places(spark, monkeypatch):
    """The places of a node are summed beside them, without a join of places with nodes."""
    live = [(1, 5, 9, 5, 3), (1, 6, 9, 6, 3), (1, 7, 9, 7, 3), (2, 6, 9, 6, 2), (2, 8, 9, 8, 2)]
    found = []
    monkeypatch.setattr(minhash, "stars", lambda live, centres, percent: found.append(centres) or (centres.selectExpr("0L a", "0L b"), centres))
    monkeypatch.setattr(minhash, "alike", lambda pairs, *_: pairs)
    landed = minhash.land
    monkeypatch.setattr(minhash, "land", lambda df, name, **k: found.append(df) or landed(df, name, **k))
    minhash.central_stars(spark.createDataFrame(live, "bucket long, node long, n long, root long, size long"), None, 85)
    assert {(r["bucket"], r["c"]["node"]) for r in found[-1].collect()} == {(1, 6), (2, 6)}
    assert not any("Join" in df._jdf.queryExecution().executedPlan().toString() for df in found)
