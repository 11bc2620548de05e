"""Personal data by boosted candidates, in Spark expressions only.

Generators propose spans with high recall: the base patterns, matched or failed, and looser ones.
Each candidate gets a few small whole-number features of its format and context. Boosted trees
learn from the counts of feature vectors, a table whose size is bounded by the features' levels, to
tell candidates that overlap a valid base span; thresholds calibrated on the other half of the texts
pick what is added. The trees become Spark ``CASE`` expressions. Base spans always stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, land, let

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
#: Generators: kind, pattern, and what a text must hold to be looked at. The first four are the base;
#: possessive where nothing is lost by it, and begun only where an earlier match ended or no
#: character of the same kind precedes, so that long runs cost no more than their length.
GENERATORS = [
    ("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"[0-9](?:[ -]?[0-9])++", ""),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+"),
    ("email", rf"(?<!{LOCAL}){LOCAL}++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++", "at"),
    ("phone", r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", ""),
    ("phone", r"(?<![0-9])00[1-9](?:[ .()-]?[0-9]){8,13}(?![0-9])", "00"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ .][0-9]{4}){3}(?![0-9])", ""),
]
BASE = 4
VALID_IP = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
CUES = r"(?i)(?:mail|contact|call|phone|tel|mobile|fax|card|visa|credit|payment|\bip\b|address|host)[^\n]{0,12}$"
#: Features and how many levels each has; their product bounds the table that trees learn from.
LEVELS = {"gen": 8, "digits": 7, "marks": 5, "luhn": 2, "before": 4, "after": 4, "cue": 2, "flat": 2}
TREES = 24
RATE = 0.3
#: Share of right candidates that a threshold must reach on the calibration half.
LEAST_PRECISION = 0.95
CONTEXT = 24


def _spans(text: Column, gen: int) -> Column:
    """``gen, start, end, value`` of a generator's matches; places count code points, the end is exclusive."""
    _, pattern, needs = GENERATORS[gen]
    element = "array<struct<gen:int,start:int,end:int,value:string>>"

    def placed(found: Column, gaps: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(element).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            value = F.get(found, i)
            start = acc["at"] + F.char_length(F.get(gaps, i))
            end = start + F.char_length(value)
            span = F.struct(F.lit(gen).alias("gen"), start.alias("start"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), begin, step, lambda acc: acc["out"])

    def if_any(found: Column) -> Column:
        none = F.array().cast(element)
        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps)))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), if_any)
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(F.array().cast(element)) if needs else found


def _valid(gen: Column, value: Column) -> Column:
    """Whether a base match passes its check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(gen == 0, True)
        .when(gen == 1, value.rlike(VALID_IP))
        .when(gen == 2, F.when(n.between(14, 19), F.call_function("luhn_check", digits)).otherwise(False))
        .when(gen == 3, n.between(10, 15))
        .otherwise(False)
    )


def _side(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike("^[0-9]$"), 1).when(c.rlike(r"^\p{L}$"), 2).otherwise(3)


def candidates(docs: DataFrame) -> DataFrame:
    """``row, gen, kind, start, end, base, label`` and the features of every candidate of ``docs`` (``row, text``)."""
    text = F.col("text")
    has_digits = text.rlike("[0-9]")
    groups = [_spans(text, g) for g in range(len(GENERATORS))]
    none = F.array().cast("array<struct<gen:int,start:int,end:int,value:string>>")
    groups = [F.when(has_digits, g).otherwise(none) if GENERATORS[k][0] != "email" else g for k, g in enumerate(groups)]
    kinds = F.array(*(F.lit(KINDS.index(g[0])) for g in GENERATORS))
    found = docs.select("row", text, F.concat(*groups).alias("spans")).where(F.size("spans") > 0)

    def marked(s: Column) -> Column:
        return F.struct(
            s["gen"].alias("gen"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            F.get(kinds, s["gen"]).alias("kind"), _valid(s["gen"], s["value"]).alias("base"),
            F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT))).alias("left"),
            F.substring(text, s["end"] + 1, F.lit(1)).alias("right"),
        )

    def labelled(all_: Column) -> Column:
        base = F.filter(all_, lambda x: x["base"])

        def with_label(bases: Column) -> Column:
            def overlaps(s: Column) -> Column:
                return F.exists(bases, lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]))

            return F.transform(all_, lambda s: F.struct(s.alias("s"), (s["base"] | overlaps(s)).alias("label")))

        return let(base, with_label)

    spread = found.select("row", F.explode(let(F.transform("spans", marked), labelled)).alias("x")).select("row", "x.s.*", "x.label")
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    rest = F.regexp_replace("value", r"[A-Za-z0-9]", "")
    return spread.select(
        "row", "gen", "kind", "start", "end", "base", "label",
        F.when(n < 7, 0).when(n < 10, 1).when(n == 10, 2).when(n < 13, 3).when(n < 16, 4).when(n == 16, 5).otherwise(6).alias("digits"),
        F.when(rest == "", 0).when(rest.rlike("^ +$"), 1).when(rest.rlike("^-+$"), 2).when(rest.rlike(r"^\.+$"), 3).otherwise(4).alias("marks"),
        F.when(n.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False).cast("int").alias("luhn"),
        _side(F.right("left", F.lit(1))).alias("before"),
        _side(F.col("right")).alias("after"),
        F.col("left").rlike(CUES).cast("int").alias("cue"),
        ((n > 0) & (F.size(F.array_distinct(F.split(digits, ""))) <= 2)).cast("int").alias("flat"),
    )


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: str
    cut: int
    low: Leaf | Split
    high: Leaf | Split


def _value(node, table):
    if isinstance(node, Leaf):
        return np.full(len(next(iter(table.values()))), node.value)
    return np.where(table[node.feature] <= node.cut, _value(node.low, table), _value(node.high, table))


def _column(node) -> Column:
    if isinstance(node, Leaf):
        return F.lit(float(node.value))
    return F.when(F.col(node.feature) <= node.cut, _column(node.low)).otherwise(_column(node.high))


def _tree(table, slope, weight, rows, depth):
    """The split that lessens the loss most, by sums of slopes and curvatures, or a leaf."""
    g, h = slope[rows].sum(), weight[rows].sum()
    leaf = Leaf(float(RATE * g / (h + 1.0)))
    if not depth:
        return leaf
    best, gain = None, 1e-6
    for feature, levels in LEVELS.items():
        values = table[feature][rows]
        gs, hs = (np.cumsum(np.bincount(values, x[rows], levels)) for x in (slope, weight))
        for cut in range(levels - 1):
            a, b = hs[cut], h - hs[cut]
            if min(a, b) < 1e-3:
                continue
            better = gs[cut] ** 2 / (a + 1) + (g - gs[cut]) ** 2 / (b + 1) - g * g / (h + 1)
            if better > gain:
                best, gain = (feature, cut), better
    if best is None:
        return leaf
    low = table[best[0]] <= best[1]
    return Split(*best, _tree(table, slope, weight, rows & low, depth - 1), _tree(table, slope, weight, rows & ~low, depth - 1))


def boosted(table: dict[str, np.ndarray], right: np.ndarray, wrong: np.ndarray) -> list:
    """Trees of depth 2 over counted feature vectors, each fitted to what the sum of the earlier ones lacks."""
    trees, margin, n = [], np.zeros(len(right)), right + wrong
    for _ in range(TREES if n.sum() else 0):
        p = 1 / (1 + np.exp(-margin))
        trees.append(_tree(table, right - n * p, n * p * (1 - p), n > 0, 2))
        margin = margin + _value(trees[-1], table)
    return trees


def thresholds(kind: np.ndarray, margin: np.ndarray, right: np.ndarray, wrong: np.ndarray) -> dict[int, float]:
    """For each kind the least margin above which ``LEAST_PRECISION`` of the candidates are right; none if there is none."""
    out = {}
    for k in range(len(KINDS)):
        rows = (kind == k) & (right + wrong > 0)
        order = np.argsort(-margin[rows], kind="stable")
        m, r, w = margin[rows][order], np.cumsum(right[rows][order]), np.cumsum(wrong[rows][order])
        last = np.append(m[1:] != m[:-1], True) if len(m) else np.zeros(0, bool)
        good = np.flatnonzero(last & (r >= LEAST_PRECISION * (r + w)) & (r >= 20))
        if len(good):
            out[k] = float(m[good[-1]])
    return out


def learned(found: DataFrame) -> tuple[list, dict[int, float]]:
    """Trees and thresholds from all candidates, by the counts of their feature vectors."""
    half = F.pmod(F.xxhash64("row"), F.lit(2)).cast("int").alias("half")
    label = F.col("label").cast("int")
    counted = found.groupBy("kind", half, *LEVELS).agg(F.sum(label).alias("right"), F.sum(1 - label).alias("wrong"))
    got = counted.orderBy("half", *LEVELS).collect()
    column = lambda name: np.array([r[name] for r in got], int)
    table, part = {f: column(f) for f in LEVELS}, column("half")
    right, wrong = column("right").astype(float), column("wrong").astype(float)
    trees = boosted(table, right * (part == 0), wrong * (part == 0))
    margin = sum((_value(t, table) for t in trees), np.zeros(len(got)))
    return trees, thresholds(column("kind"), margin, right * (part == 1), wrong * (part == 1))


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, spans`` for each row of ``docs`` (``row, doc_id, text``; text not null).

    Both are arrays of ``start, kind, end`` in order; ``spans`` is the base and what the trees add:
    candidates of the looser generators above their kind's threshold that overlap no base span and no
    better addition. A base match that fails its check only serves to learn from. Texts
    without candidates, empty ones too, have empty arrays. With no candidates to learn from nothing is added.
    """
    found = land(candidates(docs), "candidates")
    trees, least = learned(found)
    margin = F.lit(0.0)
    for tree in trees:
        margin = margin + _column(tree)
    enough = F.lit(False)
    for kind, value in least.items():
        enough = enough | ((F.col("kind") == kind) & (F.col("margin") >= value - 1e-9))
    scored = found.withColumn("margin", margin).where(F.col("base") | ((F.col("gen") >= BASE) & enough))
    place = F.struct("start", "kind", "end", "base", F.when(F.col("base"), float("inf")).otherwise(F.col("margin")).alias("margin"))
    per_row = scored.groupBy("row").agg(F.sort_array(F.collect_set(place)).alias("all"))

    def chosen(all_: Column) -> Column:
        def beaten(s: Column) -> Column:
            def better(o: Column) -> Column:
                ahead = (o["margin"] > s["margin"]) | (
                    (o["margin"] == s["margin"])
                    & (F.struct(o["start"], -o["end"], o["kind"]) < F.struct(s["start"], -s["end"], s["kind"]))
                )
                return (o["start"] < s["end"]) & (s["start"] < o["end"]) & ahead

            return ~s["base"] & F.exists(all_, better)

        return F.filter(all_, lambda s: ~beaten(s))

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    picked = land(
        per_row.select("row", plain(F.filter("all", lambda s: s["base"])).alias("base"), plain(let(F.col("all"), chosen)).alias("spans")),
        "spans",
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return docs.select("row", "doc_id").join(picked, "row", "left").select(
        "row", "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, in order and merged where spans overlap, replaced by its kind in brackets."""
    names = F.array(*map(F.lit, KINDS))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.get(names, s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.aggregate(spans, begin, step)
    return let(end, lambda e: F.concat(e["out"], F.substring(text, e["at"] + 1, F.char_length(text))))


def op6_personal_data(spark, sf_dir: str) -> DataFrame:
    """Base counts and the spans of every document."""
    docs = land(
        documents(spark, sf_dir).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
        ),
        "documents",
    )
    found = personal_data(docs)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(len(KINDS))]
    return found.select(
        "doc_id", *counts, F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans")
    )
