"""Interaction of filters by truth-table survival words and positional popcounts.

A document fails some of five filters. For each of the 32 subsets of filters it survives the subset
if it fails none of its members; bit S of the document's 32-bit word says so for subset S. How many
documents survive each subset is then the number of words with each bit set: a positional popcount.
Tasks take it by carry-save adders, three words of one weight to one word of that weight and one of
the next, until each weight has one word left; these are the binary digits of all 32 counts at once.
Every order of the filters, and the Shapley value of each, follows from the 32 counts of a part and label.

A text's words, letters and symbols are read once; after that only narrow rows are shuffled. Equal
texts are those with one SHA-256 digest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, labels, land, land_for, small_batches
from edgeledger.llm.words import batches, texts_of

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
UPPER, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
#: Words (bit S: survives subset S) by the mask of failed filters.
WORD_OF = np.array([sum(1 << s for s in range(SUBSETS) if not mask & s) for mask in range(SUBSETS)], np.uint32)
#: Counts of a part: of all its documents, of those with quality 1, of those with toxic 1.
LABELS = ("all", "good", "toxic")
#: Parts whose counts a task holds before it passes them on.
HELD_PARTS = 10_000

PROFILE = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("fails", pa.int8()), ("digest", pa.binary())])
COUNTS = pa.schema([("part", pa.string()), ("label", pa.int8()), ("survivors", pa.list_(pa.int64()))])


def fails_alone(text: bytes) -> int:
    """The filters A to D that a text fails by itself, as bits 0 to 3."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, UPPER))
    points = len(text) if text.isascii() else len(text.decode())
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 2 * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id, part, fails, digest`` of every row of ``docs`` (``doc_id, text, source``); nulls count as empty."""

    def of(batch: pa.RecordBatch) -> tuple:
        texts = texts_of(batch, "text")
        parts = [p or "" for p in batch.column("part").to_pylist()]
        return batch.column("doc_id"), parts, [fails_alone(t) for t in texts], [sha256(t).digest() for t in texts]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(frames, PROFILE, of)

    small_batches(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("part"), F.col("text").cast("string"))
    return named.mapInArrow(run, "doc_id long, part string, fails byte, digest binary")


def with_earlier(profile: DataFrame) -> DataFrame:
    """``fails`` with bit 4 (filter E) set where a smaller doc_id of the table has the same text.

    Rows without an id are never later than another and make none later; rows that share the least id stay.
    """
    stored, again = land_for(profile, "profiles", 2)
    groups = again.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = land(groups.where("first < last").select("digest", "first"), "equal-texts")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    mask = F.col("fails").bitwiseOR(F.when(later, F.lit(1 << 4)).otherwise(F.lit(0)).cast("byte"))
    return stored.join(shared, "digest", "left").select("doc_id", "part", mask.alias("fails"))


def with_labels(masks: DataFrame, marks: DataFrame) -> DataFrame:
    """``part, fails, good, toxic``: whether any row of ``marks`` gives the document quality 1 or toxic 1."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    marked = marks.where("doc_id is not null").groupBy("doc_id").agg(one("quality"), one("toxic"))
    marked = land(marked.where("quality or toxic"), "marked")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("byte")
    return land(masks, "masks").join(marked, "doc_id", "left").select(
        "part", "fails", flag("quality").alias("good"), flag("toxic").alias("toxic")
    )


class Planes:
    """Carry-save sums of words: ``planes[k]`` holds words of weight 2^k, fewer than three when at rest."""

    def __init__(self):
        self.planes: list[np.ndarray] = []

    def add(self, words: np.ndarray) -> None:
        carry, k = words, 0
        while len(carry):
            if k == len(self.planes):
                self.planes.append(np.empty(0, np.uint32))
            rest, carry = self._saved(np.concatenate([self.planes[k], carry]))
            self.planes[k], k = rest, k + 1

    @staticmethod
    def _saved(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """At most two words of the weight, and all carries to the next."""
        carries = []
        while (third := len(words) // 3) > 0:
            a, b, c = (words[k * third : (k + 1) * third] for k in range(3))
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        return words, np.concatenate(carries) if carries else words[:0]

    def counts(self) -> list[int]:
        """How many words had each bit."""
        bits = np.arange(SUBSETS, dtype=np.uint32)
        total = np.zeros(SUBSETS, np.int64)
        for k, words in enumerate(self.planes):
            for word in words:
                total += ((word >> bits) & np.uint32(1)).astype(np.int64) << k
        return total.tolist()


def survivors(flagged: DataFrame) -> DataFrame:
    """``part, label, n0 .. n31``: documents of each part and label that survive each subset of filters."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], Planes] = {}

        def passed_on() -> pa.RecordBatch:
            rows = [(part, label, p.counts()) for (part, label), p in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), COUNTS.types)], schema=COUNTS)

        for batch in frames:
            coded = batch.column("part").dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            words = WORD_OF[batch.column("fails").to_numpy(zero_copy_only=False)]
            chosen = [np.ones(len(words), bool), *(batch.column(c).to_numpy(zero_copy_only=False) == 1 for c in LABELS[1:])]
            order = np.argsort(code, kind="stable")
            edges = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
            for k, part in enumerate(coded.dictionary.to_pylist()):
                rows = order[edges[k] : edges[k + 1]]
                for label, rule in enumerate(chosen):
                    if len(picked := words[rows][rule[rows]]):
                        held.setdefault((part, label), Planes()).add(picked)
            if len(held) >= HELD_PARTS:
                yield passed_on()
        if held:
            yield passed_on()

    counted = flagged.mapInArrow(run, "part string, label byte, survivors array<long>")
    sums = [F.sum(F.get("survivors", F.lit(s))).alias(f"n{s}") for s in range(SUBSETS)]
    return counted.groupBy("part", "label").agg(*sums)


def _steps() -> list[tuple[str, int, int, int, int]]:
    """``order, step, filter's bit, subset before, subset after`` of all steps of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[k] for k in order), step, f, before, before | 1 << f))
            before |= 1 << f
    return out


def interactions(counted: DataFrame) -> DataFrame:
    """One row per part, order and step from the survivors of all subsets."""
    none = F.array(*[F.lit(0).cast("long")] * SUBSETS)
    of = lambda k: F.coalesce(
        F.max(F.when(F.col("label") == k, F.array(*(F.col(f"n{s}") for s in range(SUBSETS))))), none
    ).alias(LABELS[k])
    wide = counted.groupBy("part").agg(*(of(k) for k in range(len(LABELS))))
    steps = _steps()

    def lost(label: str) -> Column:
        return F.get(label, F.col("x.before")) - F.get(label, F.col("x.after"))

    def lost_in_all(f: int) -> Column:
        """Over the subsets that can stand before the filter, each as often as orders have it there."""
        times = Counter((before, after) for _, _, g, before, after in steps if g == f)
        terms = [(F.get("all", F.lit(b)) - F.get("all", F.lit(a))) * n for (b, a), n in sorted(times.items())]
        return reduce(Column.__add__, terms)

    every = SUBSETS - 1
    per_filter = F.array(*(
        F.struct(
            (F.get("all", F.lit(0)) - F.get("all", F.lit(1 << f))).alias("fails"),
            (F.get("all", F.lit(every ^ 1 << f)) - F.get("all", F.lit(every))).alias("unique_fails"),
            lost_in_all(f).alias("shapley"),
        )
        for f in range(len(FILTERS))
    ))
    table = "array<struct<filter_order:string,step:int,f:int,before:int,after:int>>"
    literal = F.from_json(
        F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{s},"f":{f},"before":{b},"after":{a}}}' for o, s, f, b, a in steps) + "]"), table
    )
    known = land(wide.select("part", *LABELS, per_filter.alias("per_filter")), "per-filter")
    spread = known.select("*", F.explode(literal).alias("x"))
    own = F.get("per_filter", F.col("x.f"))
    return spread.select(
        "part", "x.filter_order", "x.step", F.get("all", F.col("x.after")).alias("kept"), lost("all").alias("removed"),
        (own["fails"] - lost("all")).alias("redundant"), own["unique_fails"].alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), own["shapley"].alias("shapley"),
    )


def audit(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of what each filter does there, for every source of ``docs``.

    ``docs`` has ``doc_id, text, source``, ``marks`` has ``doc_id, quality, toxic``; further columns, whatever
    their names, are not looked at. Null texts and sources count as empty. Every row is a document, also one
    that repeats an id. A document is good or toxic if any of its label rows says so; label rows without an id
    or without a document count for nothing. An empty table gives no rows.
    """
    masks = with_earlier(profiles(docs))
    return interactions(survivors(with_labels(masks, marks)))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """What each of five filters does in every order of them, by source."""
    return audit(documents(spark, sf_dir), labels(spark, sf_dir))


OP13_SQL = r"""
with w as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as txt,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
m as (
  select doc_id, part,
    (len(words) < 200)::int as a,
    (100 * len(list_distinct(words)) < 50 * len(words))::int as b,
    (100 * length(regexp_replace(txt, '[^A-Z]', '', 'g')) > 2 * length(txt))::int as c,
    regexp_matches(txt, '[#$%&*|]')::int as d,
    coalesce(doc_id > min(doc_id) over (partition by txt), false)::int as e
  from w),
l as (select doc_id, coalesce(bool_or(quality = 1), false)::int as good, coalesce(bool_or(toxic = 1), false)::int as toxic
  from labels where doc_id is not null group by doc_id),
f as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from m left join l using (doc_id)),
g as (select part, mask, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic from f group by part, mask),
k as (select unnest(['A', 'B', 'C', 'D', 'E']) as name, unnest([1, 2, 4, 8, 16]) as bit),
o as (
  select k1.name || k2.name || k3.name || k4.name || k5.name as filter_order, [k1.bit, k2.bit, k3.bit, k4.bit, k5.bit] as bits
  from k k1, k k2, k k3, k k4, k k5
  where k1.bit | k2.bit | k3.bit | k4.bit | k5.bit = 31),
s as (select filter_order, step, bits[step] as own, list_sum(bits[1:step])::bigint - bits[step] as earlier
  from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (
  select part, filter_order, step, own,
    sum(case when mask & (earlier | own) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & earlier = 0 and mask & own <> 0 then n else 0 end)::bigint as removed,
    sum(case when mask & earlier <> 0 and mask & own <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = own then n else 0 end)::bigint as unique_fails,
    sum(case when mask & earlier = 0 and mask & own <> 0 then n_good else 0 end)::bigint as good_lost,
    sum(case when mask & earlier = 0 and mask & own <> 0 then n_toxic else 0 end)::bigint as toxic_lost
  from g, s group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
