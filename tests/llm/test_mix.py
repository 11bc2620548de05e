"""The mixture against the distribution it is drawn from."""

from collections import Counter
from math import exp

from edgeledger.llm import poisson_mix
from tests.llm import cases

import hashlib


def many(spark, per_source):
    rows = [(k, f"text {s} {k}", "en", s, 0) for s, n in per_source.items() for k in range(sum(map(ord, s)) * 10**6, sum(map(ord, s)) * 10**6 + n)]
    return cases.table(spark, rows)


def brute(rows, weights):
    """Copies of each row by summing Poisson probabilities until they reach its uniform number."""
    sizes = Counter(s for _, s in rows)
    total = sum(weights.get(s, 0) for s in sizes)
    out = {}
    for doc_id, source in rows:
        mean = weights.get(source, 0) / total * len(rows) / sizes[source]
        digest = hashlib.md5(f"{poisson_mix.SEED}:{doc_id}".encode()).hexdigest()
        u, k = (int(digest[:13], 16) + 0.5) / 16**13, 0
        p = below = exp(-mean)
        while mean and below < u:
            k += 1
            p *= mean / k
            below += p
        if mean and k:
            out[doc_id] = k
    return out


def test_copies(spark):
    docs = many(spark, {"a": 900, "b": 60, "c": 40})
    weights = {"a": 1.0, "b": 2.0, "c": 1.0, "absent": 5.0}
    got = Counter(r["doc_id"] for r in poisson_mix.mixed(docs, weights)[0].collect())
    assert dict(got) == brute([(r["doc_id"], r["source"]) for r in docs.collect()], weights)
    shares = Counter()
    for doc_id, n in got.items():
        shares["abc"[doc_id // 10**6 - 97]] += n
    assert abs(shares["b"] / sum(shares.values()) - 0.5) < 0.1


def test_order_is_shuffled_and_repeatable(spark):
    docs = many(spark, {"a": 300, "b": 300})
    first, second = ([r["doc_id"] for r in poisson_mix.mixed(docs)[0].collect()] for _ in range(2))
    assert sorted(first) == sorted(second) and sorted(first) != first
    assert Counter(first) != Counter(r["doc_id"] for r in poisson_mix.mixed(docs, seed="other")[0].collect())


def test_awkward_tables(spark):
    got, copy = poisson_mix.mixed(cases.odd(spark))
    assert got.columns == [*cases.odd(spark).columns, copy] and got.count() > 0
    assert poisson_mix.mixed(cases.empty(spark))[0].count() == 0
    assert poisson_mix.mixed(cases.odd(spark), {"absent": 1.0})[0].count() == 0
    clashing, copy = poisson_mix.mixed(cases.clashing(spark))
    assert copy not in cases.clashing(spark).columns and set(cases.clashing(spark).columns) < set(clashing.columns)


def test_rows_without_an_id_are_drawn_apart(spark):
    docs = cases.table(spark, [(None, f"text {k}", "en", "ab"[k % 2], 0) for k in range(1000)])
    mixture, copy = poisson_mix.mixed(docs, {"a": 3.0, "b": 1.0})
    got = mixture.rdd.mapPartitions(lambda rows: [[(r["source"], r["text"]) for r in rows]]).collect()
    counts = Counter(s for part in got for s, _ in part)
    assert abs(counts["a"] - 750) < 100 and abs(counts["b"] - 250) < 60
    assert len(set(Counter(x for part in got for x in part).values())) > 1
    assert sum(bool(part) for part in got) == len(got) or max(map(len, got)) < 1000


def test_inverse_of_a_large_mean(spark):
    from pyspark.sql import functions as F

    cdf = spark.range(1).select(poisson_mix.poisson_cdf(F.lit(900.0))).first()[0]
    assert abs(cdf[-1] - 1) < 1e-9 and abs(cdf[900] - 0.5089) < 0.01
