"""Quality rules: base counts against plain Python, learning on planted junk."""

import re
from collections import Counter

import numpy as np

from edgeledger.llm import decision_list
from edgeledger.llm.common import numbered, slim
from tests.llm import cases

JUNK = [(500 + k, " ".join([f"w{k}"] * 30 + [f"v{k}"] * 40 + cases.sentence(k, 40 + k).split()), "en", "a", 0) for k in range(60)]
GOOD = [(700 + k, cases.sentence(k + 90, 100 + k), "en", "b", 0) for k in range(90)]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
    )


def test_base_counts(spark):
    extra = [(900, "a b c a b c x a b c\na b\n\n a b\na b", None, None, 0), (901, "t " * 500, None, None, 0), (902, "#*# <a>|$\t%&", None, None, 0)]
    docs = cases.table(spark, cases.ODD + cases.PLAIN + JUNK[:5] + extra)
    stored, row = numbered(docs, "t")
    got = decision_list.text_statistics(slim(stored, row)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    wanted = sorted(((r["doc_id"], *base(r["text"])) for r in stored.collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == wanted


def test_rules_reject_junk_and_keep_the_rest(spark):
    docs = cases.table(spark, JUNK + GOOD)
    marks = spark.createDataFrame([(r[0], int(r[0] >= 700)) for r in JUNK + GOOD] + [(None, 0), (700, None)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in decision_list.keep_good(docs, marks).collect()}
    assert kept >= {r[0] for r in GOOD} and len(kept) <= len(GOOD) + 3


def test_no_labels_no_rules(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    docs = cases.clashing(spark)
    left = decision_list.keep_good(docs, marks)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert decision_list.keep_good(cases.empty(spark), marks).count() == 0


def test_first_rule_that_holds_decides(spark):
    rules = [
        [decision_list.Condition("n_words", True, 10.0), decision_list.Condition("digit_share", False, 0.5)],
        [decision_list.Condition("n_words", True, 5.0)],
    ]
    frame = spark.createDataFrame([(20, 0.1), (20, 0.9), (7, 0.0), (1, 0.0)], "n_words int, digit_share double")
    assert [r[0] for r in frame.select(decision_list.rule_number(rules)).collect()] == [1, 2, 2, 0]


def test_learning_grows_and_prunes():
    rng = np.random.default_rng(1)
    table = {f: rng.random(600) for f in decision_list.FEATURES}
    junk = rng.random(600) < 0.3
    table["symbol_share"] = np.where(junk, 0.8, 0.1) + 0.1 * table["symbol_share"]
    rules = decision_list.learn(table, junk, rng.random(600) < 0.66)
    found = np.zeros(600, bool)
    for rule in rules:
        found |= decision_list._covers(rule, table, 600)
    assert (found & junk).sum() >= 0.9 * junk.sum() and (found & ~junk).sum() <= 3
    assert decision_list.learn(table, np.zeros(600, bool), rng.random(600) < 0.5) == []


def found_by(table, junk, seed=1):
    rules = decision_list.learn(table, junk, np.random.default_rng(seed).random(len(junk)) < 0.66)
    found = np.zeros(len(junk), bool)
    for rule in rules:
        found |= decision_list._covers(rule, table, len(junk))
    return found


def test_two_thresholds_are_learned_together():
    rng = np.random.default_rng(1)
    table = {f: rng.random(600) for f in decision_list.FEATURES}
    junk = (table["symbol_share"] > 0.8) & (table["upper_share"] < 0.6)
    found = found_by(table, junk)
    assert (found & junk).sum() >= 0.9 * junk.sum() and (found & ~junk).sum() <= 3


def test_all_kinds_of_junk_are_learned_beside_wrong_labels():
    rng = np.random.default_rng(3)
    table = {f: rng.random(6000) for f in decision_list.FEATURES}
    junk = np.any([values > 0.97 for values in table.values()], axis=0)
    for noise, least in ((0.0, 0.9), (0.01, 0.9), (0.03, 0.6)):
        found = found_by(table, junk ^ (rng.random(6000) < noise))
        assert (found & junk).sum() >= least * junk.sum() and (found & ~junk).sum() <= 10
    assert not found_by(table, rng.random(6000) < 0.1).any()
