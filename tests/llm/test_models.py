"""The learned scores: counts against brute force, gradients, held-out accuracy, awkward tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from edgeledger.llm import classifier_chain, gru_lm, random_indexing
from edgeledger.llm.common import bounded_sample, documents, labels, numbered, slim
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def crc(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def test_language_model_counts(spark):
    stored, row = numbered(cases.odd(spark), "t")
    got = gru_lm.scored(slim(stored, row)).collect()
    texts = [(r["doc_id"], re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode().lower()) + [b"\n"]) for r in stored.collect()]
    c = Counter(w for i, ws in texts if crc(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    wanted = sorted(
        ((i, crc(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in texts),
        key=repr,
    )
    assert sorted(((*r[:5], round(r[5], 4)) for r in got), key=repr) == wanted
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_language_model_empty(spark):
    stored, row = numbered(cases.empty(spark), "t")
    assert gru_lm.scored(slim(stored, row)).count() == 0


def test_every_training_document_teaches(spark):
    for doc_id in (i for i in range(100, 104) if crc(i, 7) != 2):
        docs = cases.table(spark, [(doc_id, "one two three " * 400, "en", "a", 0)]).selectExpr("doc_id row", "doc_id", "text", "1 flag")
        corpus = gru_lm.Corpus(1201, 4, [b"one", b"three", b"two", b"\n"], np.array([400, 400, 400, 1]))
        begun = gru_lm.start(corpus.weights()).flat()
        assert np.abs(gru_lm.trained(docs, corpus).flat() - begun).max() > 0.01


def test_language_model_takes_texts_apart_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    docs = cases.table(spark, cases.PLAIN).select(F.col("doc_id").alias("row"), "doc_id", counted.asNondeterministic()("text").alias("text"))
    assert gru_lm.scored(docs).count() == len(cases.PLAIN) == read.value


def test_learning_is_plain_adam():
    rng = np.random.default_rng(6)
    begun = gru_lm.start(np.array([9, 8, 5, 5, 3, 2]))
    width = 2 * gru_lm.STEPS + 5  # the last window is shorter
    stream = rng.integers(0, 6, width * gru_lm.STREAMS + 1)
    x, y = stream[:-1].reshape(-1, width).T, stream[1:].reshape(-1, width).T
    theta, first, second = begun.flat().astype(np.float64), 0.0, 0.0
    state = np.zeros((gru_lm.STREAMS, gru_lm.SIZE))
    for step, at in enumerate(range(0, width, gru_lm.STEPS), 1):
        model = begun.over(theta)
        slopes, state = gru_lm._learn_window(model, x[at : at + gru_lm.STEPS], y[at : at + gru_lm.STEPS], state, 2)
        g = np.concatenate([slopes[k].ravel() for k in model.learned()])
        g *= min(1, 1 / np.sqrt(g @ g))
        first, second = 0.9 * first + 0.1 * g, 0.995 * second + 0.005 * g * g
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.995**step)) + 1e-6)
        theta = theta - 0.01 * (1 - 0.9 * step / 3) * move
    learned = gru_lm.learn(begun, stream, 2, 0.01).flat()
    assert np.abs(learned - begun.flat()).max() > 0.005
    assert np.allclose(learned, theta, atol=2e-4)


def test_words_far_from_likely_keep_their_logs():
    model = gru_lm.start(np.array([50, 20, 9, 9, 4, 2, 1, 1]))
    flat = np.random.default_rng(7).normal(0, 60, len(model.flat()))
    states, targets = np.random.default_rng(8).uniform(-1, 1, (40, gru_lm.SIZE)), np.arange(40) % 8
    model = model.with_flat(flat)
    logs = gru_lm.log_likelihoods(model, states.astype(np.float32), targets)
    classes = np.repeat(np.arange(len(model.first) - 1), np.diff(model.first))
    for state, target, log in zip(states, targets, logs):
        own = classes[target]
        of_class = state @ model.to_class + model.class_bias
        a, b = model.first[own], model.first[own + 1]
        of_word = model.to_word[a:b] @ state + model.word_bias[a:b]
        wanted = of_class[own] - np.logaddexp.reduce(of_class) + of_word[target - a] - np.logaddexp.reduce(of_word)
        assert abs(log - wanted) < 1e-3 * max(1, abs(wanted))


def test_probabilities_sum_to_one():
    model = gru_lm.start(np.array([50, 20, 9, 9, 4, 2, 1, 1]))
    rng = np.random.default_rng(1)
    model = model.with_flat(model.flat() + rng.normal(0, 0.3, len(model.flat())))
    states = rng.normal(0, 1, (5, gru_lm.SIZE)).astype(np.float32)
    logs = np.array([gru_lm.log_likelihoods(model, states, np.full(5, w)) for w in range(8)])
    assert np.allclose(np.exp(logs).sum(axis=0), 1, atol=1e-5)


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    model = gru_lm.start(np.array([9, 8, 5, 5, 3, 2]))
    flat = (model.flat() + rng.normal(0, 0.4, len(model.flat()))).astype(np.float64)
    x, y = rng.integers(0, 6, (5, 3)), rng.integers(0, 6, (5, 3))

    def double(values):
        m = model.with_flat(values)
        at = 0
        for name in m.learned():
            old = getattr(m, name)
            setattr(m, name, values[at : at + old.size].reshape(old.shape))
            at += old.size
        return m

    def loss(values):
        m, state, states = double(values), np.zeros((3, gru_lm.SIZE)), []
        given = m.embed[x] @ m.into + m.gate
        for t in range(5):
            state = gru_lm._step(m, given[t], state * (x[t] != 2)[:, None])[0]
            states.append(state)
        return -gru_lm.log_likelihoods(m, np.concatenate(states), y.ravel()).mean()

    slopes, _ = gru_lm._learn_window(double(flat), x, y, np.zeros((3, gru_lm.SIZE)), 2)
    slope = np.concatenate([slopes[k].ravel() for k in model.learned()])
    for k in rng.choice(len(flat), 60, replace=False):
        step = np.zeros_like(flat)
        step[k] = 1e-4
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-4 - slope[k]) < 2e-3


def test_state_goes_through_windows(monkeypatch):
    rng = np.random.default_rng(5)
    model = gru_lm.start(np.arange(20, 0, -1))
    model = model.with_flat(model.flat() + rng.normal(0, 0.3, len(model.flat())))
    sizes = np.array([1, 200, 3, 0, 77, 130])
    numbers = rng.integers(0, 20, sizes.sum())
    whole = gru_lm.document_scores(model, numbers, sizes, 1)
    monkeypatch.setattr(gru_lm, "SCORED_STEPS", 7)
    monkeypatch.setattr(gru_lm, "SCORED", 2)
    assert np.allclose(gru_lm.document_scores(model, numbers, sizes, 1), whole, rtol=1e-4)


def test_language_model_beats_frequencies(spark):
    stored, row = numbered(documents(spark, SF).select("doc_id", "text"), "t")
    held = gru_lm.scored(slim(stored, row)).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_quality_on_held_out_labels(spark):
    got = random_indexing.op5_quality_classifier(spark, SF).join(labels(spark, SF), "doc_id").where("held_out")
    rows = got.select("score", "predicted", "quality").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.95


def test_quality_awkward_tables(spark, tmp_path):
    marks = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(cases.PLAIN)] + [(None, 1), (100, None)], "doc_id long, quality int")
    got = random_indexing.op5_quality_classifier(spark, cases.on_disk(cases.odd(spark), tmp_path, marks)).collect()
    assert len(got) == len(cases.ODD) + len(cases.PLAIN)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in got)
    nothing = spark.createDataFrame([], marks.schema)
    folder = cases.on_disk(cases.empty(spark), tmp_path / "empty", nothing)
    assert random_indexing.op5_quality_classifier(spark, folder).count() == 0


def test_neighbours_stay_in_their_text():
    index = random_indexing.index_vectors(50, 1)
    codes, sizes = np.array([1, 2, 3, 4, 5]), np.array([2, 0, 3])
    got = random_indexing.neighbour_sums(codes, sizes, index)
    assert np.array_equal(got[0], index[2]) and np.array_equal(got[1], index[1])
    assert np.array_equal(got[3], index[3] + index[5]) and np.array_equal(got[2], index[4] + index[5])


def test_toxicity_finds_planted_words(spark):
    bad = ["scoundrel", "blockhead", "numbskull"]
    rows = [(k, cases.sentence(k, 80) + (f" {bad[k % 3]}! and {bad[(k + 1) % 3]}" if k % 4 == 0 else ""), "en", "a", 0) for k in range(400)]
    docs = cases.table(spark, rows + cases.ODD)
    marks = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(0, 300)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    known, chain = classifier_chain.learned_chain(docs, marks)
    got = {r["doc_id"]: r for r in classifier_chain.chain_scores(docs, known, chain).collect() if r["doc_id"] is not None and r["doc_id"] >= 10}
    assert all((got[k]["p_toxic"] >= 0.5) == (k % 4 == 0) for k in range(300, 400))
    assert len(chain) == 3 and [len(m.column) for m in chain] == [3, 4, 5]


def test_labels_as_bits(spark):
    ids = [0, 1, 63, 64, -1, -64, -65, 10**12, 2**62]
    docs = spark.createDataFrame([(k, f"t{k}", "x") for k in [*ids, 2, 1, None]] + [(3, None, "x")], "doc_id long, text string, toxic string")
    marks = spark.createDataFrame([(k, j % 2) for j, k in enumerate(ids)] + [(1, 0), (3, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    got = sorted(map(tuple, classifier_chain.labelled(docs, marks).collect()))
    assert got == sorted([(k, j % 2, f"t{k}") for j, k in enumerate(ids)] + [(1, 1, "t1"), (3, 1, "")])


def test_labels_as_bits_shuffle_no_text(spark):
    docs = documents(spark, SF)
    plan = classifier_chain.labelled(docs, labels(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_bounded_sample(spark):
    df = spark.range(10_000).withColumnRenamed("id", "doc_id").withColumn("draw", F.lit("a column of this name"))
    got = {r["doc_id"] for r in bounded_sample(df, 500, "doc_id").collect()}
    assert len(got) == 500 and got == {r["doc_id"] for r in bounded_sample(df.repartition(7), 500, "doc_id").collect()}
    assert [bounded_sample(df, n, "doc_id").count() for n in (8334, 9000, 9999, 10_000)] == [8334, 9000, 9999, 10_000]
    same = df.withColumn("n", F.col("doc_id")).withColumn("doc_id", F.lit(1))
    assert {r["n"] for r in bounded_sample(same, 20, "doc_id", "n").collect()} == set(range(20))
    assert bounded_sample(df.where("doc_id < 0"), 5, "doc_id").count() == 0


def test_every_cue_counts(spark):
    """30 toxic rows for each of 100 groups of 15 words; each word brings four candidates, the last group is rarest."""
    bad = [[f"{chr(97 + g // 26)}{chr(97 + g % 26)}{chr(97 + w)}{chr(122 - w)}{g:02d}{w:02d}x" for w in range(15)] for g in range(100)]
    rows = [(k, 1, " ".join(bad[k % 100])) for k in range(3000) if k % 100 < 99 or k < 2400]
    rows += [(3000 + k, 0, f"plain words {k % 7}") for k in range(3000)]
    marked = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    found = set(classifier_chain.cues(marked))
    assert len(found) > 4096 and {w.encode() for group in bad for w in group} <= found


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    known, chain = classifier_chain.learned_chain(cases.odd(spark), none)
    assert known == {} and classifier_chain.chain_scores(cases.odd(spark), known, chain).count() == len(cases.ODD + cases.PLAIN)
    assert classifier_chain.chain_scores(cases.empty(spark), known, chain).count() == 0


def test_later_models_see_out_of_fold_probabilities(monkeypatch):
    seen = []
    real = classifier_chain.fit
    monkeypatch.setattr(classifier_chain, "fit", lambda rows, *a, **k: seen.append(rows.dense) or real(rows, *a, rounds=5))
    hits = [([0], [1], 1, 10) if k % 2 else ([], [], 0, 10) for k in range(50)]
    target = np.arange(50) % 3 == 1
    classifier_chain.fit_chain(classifier_chain.as_rows(hits), [target, target], np.arange(50) % 5, 1)
    full = [d for d in seen if len(d) == 50]
    assert [d.shape[1] for d in full] == [3, 4] and len(seen) == 12
    assert len({round(float(p), 6) for p in full[1][:, 3]}) > 2  # five models, not one
