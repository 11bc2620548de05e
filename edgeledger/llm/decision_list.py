"""Quality rules: a decision list learned by sequential covering.

Statistics of every whole text are Spark columns. From the statistics of labelled texts, rules for
the junk class are learned one after another: a rule grows by the threshold that gains most, is
pruned on rows that did not grow it, takes its rows out, and the next rule is learned from the
rest. The list becomes one ordered Spark ``CASE`` expression; the first rule that holds decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeledger.llm.common import SPACES, bounded_sample, documents, labels, land, let, numbered, passing, slim

#: Labelled rows that rules are learned from, at most: those with the least hash of their id.
LEARN_ROWS = 20_000
MAX_CONDITIONS = 3
#: A rule must not be below this share of right rows, on the growing and on the pruning rows, beyond what chance
#: explains: the upper end of Wilson's interval, of so many deviations, for the rows it covers.
LEAST_PRECISION = 0.98
DEVIATIONS = 1.64
#: ... and cover so many junk rows while it grows.
LEAST_COVER = 5
#: Thresholds tried for a statistic at each step: quantiles of the rows still covered.
THRESHOLDS = 64

FEATURES = [
    "n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "mark_share", "digit_share",
]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more, the first window included.

    Windows are compared by 64-bit hashes of their words, within one text only.
    """
    none = F.lit(0).cast("long")

    def windows(w: Column) -> Column:
        last = F.size(w) - 3
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def count(hashes: Column) -> Column:
        marked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(marked, covered)

    def covered(s: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        starts = F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))
        begin = F.struct(F.lit(0).alias("end"), none.alias("n"))
        return F.aggregate(
            starts,
            begin,
            lambda acc, i: F.struct(
                (i + 3).alias("end"), (acc["n"] + (i + 3 - F.greatest(acc["end"], i)).cast("long")).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def if_any(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count(hashes)).otherwise(none)

    return F.when(F.size(words) < 4, none).otherwise(let(windows(words), if_any))


def _word_figures(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeated_words(words).alias("n_repeat_words"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
    )


def _line_figures(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """``row, doc_id``, the base counts and the statistics that rules use, for each row of ``docs``.

    A text that is null or empty has no words: all its counts are 0, and shares of nothing are 0.
    """
    text = F.col("text")
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    counted = docs.select(
        "row",
        "doc_id",
        let(words, _word_figures).alias("w"),
        let(lines, _line_figures).alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[!?;:=_~^{}\\[\\]]")).cast("long").alias("n_marks"),
        F.regexp_count(text, F.lit("[0-9]")).cast("long").alias("n_digits"),
    )
    flat = counted.select("row", "doc_id", "w.*", "l.*", "n_symbols", "n_upper", "n_marks", "n_digits")

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(0.0)

    return flat.withColumns(
        {
            "word_length": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "distinct_share": share("n_distinct", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
            "mark_share": share("n_marks", "word_chars"),
            "digit_share": share("n_digits", "word_chars"),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value <= self.threshold


def _covers(rule: list[Condition], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for condition in rule:
        held &= condition.holds(table)
    return held


def _grow(table: dict[str, np.ndarray], junk: np.ndarray, aside: set[tuple[str, bool]]) -> list[Condition]:
    """Adds the condition of largest information gain until all covered rows are junk; the first is none ``aside``."""
    rule, held = [], np.ones(len(junk), bool)
    while len(rule) < MAX_CONDITIONS and (held & ~junk).any():
        right, all_now = (held & junk).sum(), held.sum()
        best, best_gain = None, 1e-9
        for feature in FEATURES:
            values = table[feature][held]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS), method="nearest"))
            for above in (True, False):
                if not rule and (feature, above) in aside:
                    continue
                for cut in cuts:
                    now = values >= cut if above else values <= cut
                    n, p = now.sum(), (now & junk[held]).sum()
                    if p < LEAST_COVER or n == all_now:
                        continue
                    gain = p * (log2(p / n) - log2(right / all_now))
                    if gain > best_gain:
                        best, best_gain = Condition(feature, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        held &= best.holds(table)
    return rule


def _worth(rule: list[Condition], table: dict[str, np.ndarray], junk: np.ndarray) -> float:
    held = _covers(rule, table, len(junk))
    right, wrong = (held & junk).sum(), (held & ~junk).sum()
    return (right - wrong) / max(1, right + wrong)


def _sound(rule: list[Condition], table: dict[str, np.ndarray], junk: np.ndarray) -> bool:
    """Whether the rule covers some of the rows, if there are any, and may have ``LEAST_PRECISION`` by those it covers."""
    held = _covers(rule, table, len(junk))
    n, z = held.sum(), DEVIATIONS
    if not n:
        return not len(junk)
    p = (held & junk).sum() / n
    return (p + z * z / (2 * n) + z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n) >= LEAST_PRECISION


def learn(table: dict[str, np.ndarray], junk: np.ndarray, grow: np.ndarray) -> list[list[Condition]]:
    """Rules in order. ``grow`` marks the rows that grow rules; the others prune them.

    Where no beginning of a rule is sound, its first condition is set aside until another rule is
    found. No rule is learned if there is no junk row, or no other row, to learn from.
    """
    rules, left, aside = [], np.ones(len(junk), bool), set()
    while True:
        a, b = left & grow, left & ~grow
        if (a & junk).sum() < LEAST_COVER or not (a & ~junk).any():
            break
        part = lambda rows: ({f: v[rows] for f, v in table.items()}, junk[rows])
        rule = _grow(*part(a), aside)
        if not rule:
            break
        sound = [r for k in range(1, len(rule) + 1) if _sound(r := rule[:k], *part(a)) and _sound(r, *part(b))]
        if not sound:
            aside.add((rule[0].feature, rule[0].above))
            continue
        rule, aside = max(sound, key=lambda r: (_worth(r, *part(b)), -len(r))), set()
        rules.append(rule)
        left &= ~_covers(rule, table, len(junk))
    return rules


def learned_rules(statistics: DataFrame, marks: DataFrame, rows: int = LEARN_ROWS) -> list[list[Condition]]:
    """Rules from the statistics of at most ``rows`` labelled rows (``doc_id, quality``; nulls are no label)."""
    marked = marks.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    one = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = statistics.where("doc_id is not null").join(one, "doc_id")
    grow = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) != 0
    values = [F.col(f).cast("double").alias(f) for f in FEATURES]
    got = sorted(bounded_sample(known, rows, "doc_id", "row").select("doc_id", "quality", grow.alias("grow"), *values).collect())
    table = {f: np.array([r[f] for r in got], float) for f in FEATURES}
    return learn(table, np.array([r["quality"] == 0 for r in got], bool), np.array([r["grow"] for r in got], bool))


def rule_number(rules: list[list[Condition]]) -> Column:
    """The place of the first rule that holds, from 1; 0 if none does."""
    chain = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        chain = F.when(held, k).otherwise(chain)
    return chain


def judged(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Statistics of every row with ``rule`` (which rejects it, 0: none) and ``kept``.

    ``docs`` has ``row, doc_id, text``. Ids that are null or repeat are judged by their own text;
    an empty table gives an empty one. Rows fail by the base conditions even if no rule is learned.
    """
    statistics = land(text_statistics(docs), "statistics")
    rules = learned_rules(statistics, marks)
    return statistics.withColumn("rule", rule_number(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def keep_good(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they are."""
    stored, row = numbered(docs, "documents")
    with passing(docs.sparkSession):
        kept = judged(slim(stored, row), marks).where("kept").select(F.col("row").alias(row))
        kept = land(kept, "kept", stays=True)
    return stored.join(kept, row, "left_semi").drop(row)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = documents(spark, sf_dir).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    return judged(docs, labels(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
