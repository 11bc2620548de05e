"""Toxicity by a chain of linear classifiers.

Cues are words and word beginnings that stand in toxic labelled texts far more often than chance
allows; they are counted over all labelled texts. Categories are predicted in order: each has a
linear model over a text's cues and over the probabilities of the categories before it. For
learning, these are out-of-fold: a row's probability comes from a model that has not seen the row.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from edgeledger.llm.common import bounded_sample, crc_mod, documents, labels, land, small_batches
from edgeledger.llm.words import batches, lowered_words, texts_of

#: Labelled rows that the linear models are fitted on, at most. Cues are counted over all labelled rows.
LEARN_ROWS = 30_000
FOLDS = 5
#: Least log-likelihood ratio of a cue, and least share of toxic texts among those that have it.
LEAST_RATIO = 30.0
LEAST_SHARE = 0.5
#: Word beginnings of these lengths are cue candidates besides whole words.
BEGINNINGS = (4, 5, 6)
#: Flags by checksum that tell tasks which candidates may still be cues.
FLAGS = 1 << 20
EDGES = b".,;:!?\"'()[]{}<>|*#$%&_-"

#: The categories in order. The tables label one, ``toxic``, which comes last, so that its model is fed by
#: the others. These are grades of it, by the number of a toxic text's cue words and by their share of its words.
CATEGORIES = ("repeated", "dense", "toxic")
REPEATED_CUES = 3
DENSE_SHARE = 0.02


def _candidates(word: bytes) -> list[bytes]:
    """A word without marks at its ends, and its beginnings, marked by a star."""
    bare = word.strip(EDGES).decode()
    return [bare.encode(), *(bare[:k].encode() + b"*" for k in BEGINNINGS if len(bare) > k)] if bare else []


class Candidates(dict):
    """word -> its candidates; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> list[bytes]:
        if len(self) >= 100_000:
            self.clear()
        value = self[word] = _candidates(word)
        return value


def cue_counts(texts: DataFrame, marked: np.ndarray | None = None) -> DataFrame:
    """``cue, n``: how many rows of ``texts`` (``text``) have each candidate.

    With ``marked``, flags by checksum, only candidates whose flag is set.
    """
    schema = pa.schema([("cue", pa.binary()), ("n", pa.int64())])

    def run(frames):
        counts: dict[bytes, int] = {}
        known = Candidates()

        def flush():
            columns = (list(counts), list(counts.values()))
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
            counts.clear()
            return batch

        for batch in frames:
            for text in texts_of(batch, "text"):
                for cue in {c for w in set(lowered_words(text)) for c in known[w]}:
                    if marked is None or marked[crc32(cue) % FLAGS]:
                        counts[cue] = counts.get(cue, 0) + 1
            if len(counts) > 1_000_000:
                yield flush()
        if counts:
            yield flush()

    counted = texts.select("text").mapInArrow(run, from_arrow_schema(schema))
    return counted.groupBy("cue").agg(F.sum("n").alias("n"))


def cues(marked: DataFrame, least_ratio: float = LEAST_RATIO) -> list[bytes]:
    """All cues of labelled texts, those in most toxic texts first; none if no text, or every text, is toxic.

    A candidate in t toxic texts can reach a ratio of 2 t log(1 / rate) at most. Those that this
    rules out are dropped after a count of the toxic texts, and the other texts are counted for the
    rest alone, which flags of a fixed number tell well enough; a join tells exactly.
    """
    n, toxic = marked.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not toxic or toxic == n:
        return []
    rate = toxic / n
    needed = least_ratio / (2 * np.log(1 / rate))
    found = land(cue_counts(marked.where("toxic = 1")).where(F.col("n") >= float(needed)), "toxic-cues")
    flags = np.zeros(FLAGS, bool)
    flags[[r[0] for r in found.select(F.crc32("cue") % FLAGS).distinct().collect()]] = True
    rest = cue_counts(marked.where("toxic = 0"), flags).withColumnRenamed("n", "others")
    a, b = F.col("n").cast("double"), F.coalesce("others", F.lit(0)).cast("double")
    share = a / (a + b)
    part = F.when(b > 0, b * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    ratio = 2 * (a * F.log(share / rate) + part)
    kept = found.join(rest, "cue", "left").where((share >= max(LEAST_SHARE, rate)) & (ratio >= least_ratio))
    top = kept.orderBy(F.desc("n"), b, "cue").select("cue")
    return [bytes(r["cue"]) for r in top.collect()]


def cue_hits(text: bytes, known: dict[bytes, int]) -> tuple[list[int], list[int], int, int]:
    """Cues in a text and how often, how many of its words have a cue, and its number of words."""
    words = lowered_words(text)
    found: dict[int, int] = {}
    uses = 0
    for word in set(words):
        have = {known[c] for c in _candidates(word) if c in known}
        if have:
            times = words.count(word)
            uses += times
            for c in have:
                found[c] = found.get(c, 0) + times
    order = sorted(found)
    return order, [found[c] for c in order], uses, len(words)


@dataclass
class Rows:
    """Rows of sparse cue counts, and the columns that every row has."""

    row: np.ndarray
    cue: np.ndarray
    value: np.ndarray
    dense: np.ndarray

    def pick(self, rows: np.ndarray) -> Rows:
        place = np.full(len(self.dense), -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.row] >= 0
        return Rows(place[self.row[keep]], self.cue[keep], self.value[keep], self.dense[rows])

    def also(self, column: np.ndarray) -> Rows:
        return Rows(self.row, self.cue, self.value, np.column_stack([self.dense, column]))


def as_rows(hits: list[tuple]) -> Rows:
    sizes = [len(h[0]) for h in hits]
    flat = lambda k: np.array([x for h in hits for x in h[k]], float)
    uses, words = (np.array([h[k] for h in hits], float) for k in (2, 3))
    dense = np.column_stack([np.log1p(uses), np.log1p(words), np.minimum(1, 20 * uses / np.maximum(1, words))])
    return Rows(np.repeat(np.arange(len(hits)), sizes), flat(0).astype(int), np.log1p(flat(1)), dense.reshape(len(hits), 3))


@dataclass
class Linear:
    """A logistic model over sparse cues and standardised columns."""

    cue: np.ndarray
    column: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bias: float

    def margin(self, rows: Rows) -> np.ndarray:
        sparse = np.bincount(rows.row, rows.value * self.cue[rows.cue], minlength=len(rows.dense))
        return sparse + (rows.dense - self.mean) / self.scale @ self.column + self.bias

    def probability(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit(rows: Rows, label: np.ndarray, n_cues: int, rounds: int = 300, decay: float = 1e-4) -> Linear:
    """Logistic regression by Adam on all rows; one class alone gives a constant."""
    mean, scale = rows.dense.mean(axis=0), rows.dense.std(axis=0) + 1e-6
    share = (label.sum() + 0.5) / (len(label) + 1)
    model = Linear(np.zeros(n_cues), np.zeros(rows.dense.shape[1]), mean, scale, float(np.log(share / (1 - share))))
    if label.all() or not label.any():
        return model
    standard = (rows.dense - mean) / scale
    theta = np.concatenate([model.cue, model.column, [model.bias]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        model.cue, model.column, model.bias = theta[:n_cues], theta[n_cues:-1], theta[-1]
        wrong = (model.probability(rows) - label) / len(label)
        slope = np.concatenate(
            [np.bincount(rows.cue, rows.value * wrong[rows.row], minlength=n_cues), standard.T @ wrong, [wrong.sum()]]
        )
        slope[:-1] += decay * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    model.cue, model.column, model.bias = theta[:n_cues], theta[n_cues:-1], float(theta[-1])
    return model


def fit_chain(rows: Rows, targets: list[np.ndarray], fold: np.ndarray, n_cues: int) -> list[Linear]:
    """A model for each category, in order; later ones learn from out-of-fold margins of earlier ones."""
    chain = []
    for target in targets:
        chain.append(fit(rows, target, n_cues))
        unseen = np.zeros(len(target))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(inside) and len(outside):
                unseen[outside] = fit(rows.pick(inside), target[inside], n_cues).probability(rows.pick(outside))
        rows = rows.also(unseen)
    return chain


def chain_probabilities(chain: list[Linear], rows: Rows) -> list[np.ndarray]:
    out = []
    for model in chain:
        out.append(model.probability(rows))
        rows = rows.also(out[-1])
    return out


def _graded(hits: list[tuple], toxic: np.ndarray) -> list[np.ndarray]:
    uses, words = (np.array([h[k] for h in hits], float) for k in (2, 3))
    return [toxic & (uses >= REPEATED_CUES), toxic & (uses >= DENSE_SHARE * np.maximum(1, words)), toxic]


def label_bits(marks: DataFrame) -> DataFrame:
    """``block, known, toxic``: which of 64 ids in a row have a label, and which of them a toxic one, as bits.

    A row for 64 ids in place of one for each label; where ids lie far apart it is one for each, as the labels are.
    Of several labels of an id a toxic one holds; nulls are no label.
    """
    one = marks.where("toxic is not null and doc_id is not null").selectExpr(
        "shiftright(cast(doc_id as long), 6) block", "shiftleft(1L, cast(doc_id & 63 as int)) bit", "toxic"
    )
    toxic = F.bit_or(F.when(F.col("toxic") == 1, F.col("bit")).otherwise(F.lit(0).cast("long")))
    return one.groupBy("block").agg(F.bit_or("bit").alias("known"), toxic.alias("toxic"))


def labelled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``doc_id, toxic, text`` (null: empty) of the rows of ``docs`` that have a label.

    The bits are landed first, so that Spark knows their size: while it broadcasts them no text is shuffled.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text)
    own = rows.selectExpr("*", "shiftright(doc_id, 6) block", "shiftleft(1L, cast(doc_id & 63 as int)) bit")
    found = own.join(land(label_bits(marks), "toxic-bits"), "block").where("(known & bit) != 0")
    return found.selectExpr("doc_id", "cast((toxic & bit) != 0 as int) toxic", "text")


def learned_chain(docs: DataFrame, marks: DataFrame, rows: int = LEARN_ROWS) -> tuple[dict[bytes, int], list[Linear]]:
    """Cues and models from labelled documents; ``marks`` is ``doc_id, toxic``, nulls are no label."""
    marked = land(labelled(docs, marks), "toxic-labels")
    known = {c: k for k, c in enumerate(cues(marked))}
    sample = bounded_sample(marked.withColumn("fold", crc_mod(F.col("doc_id"), FOLDS)), rows, "doc_id", "text")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("toxic", pa.int64()), ("fold", pa.int64()), ("cue", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("uses", pa.int64()), ("words", pa.int64())]
    )

    def run(frames):
        def of(batch):
            hits = [cue_hits(t, known) for t in texts_of(batch, "text")]
            return *map(batch.column, ("doc_id", "toxic", "fold")), *map(list, zip(*hits))

        return batches(frames, schema, of)

    given = sample.selectExpr("doc_id", "cast(toxic as long) toxic", "cast(fold as long) fold", "text")
    got = sorted(given.mapInArrow(run, from_arrow_schema(schema)).collect())
    hits = [(r["cue"], r["times"], r["uses"], r["words"]) for r in got]
    toxic, fold = np.array([r["toxic"] == 1 for r in got], bool), np.array([r["fold"] for r in got], int)
    if not hits:
        hits, toxic, fold = [([], [], 0, 0)], np.zeros(1, bool), np.zeros(1, int)
    return known, fit_chain(as_rows(hits), _graded(hits, toxic), fold, len(known))


def chain_scores(docs: DataFrame, known: dict[bytes, int], chain: list[Linear], names: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """``doc_id`` and the probability of each category, for each row of ``docs``.

    Null and empty texts have no words and no cues and get what the models give for that. Repeated
    rows get the same; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *((f"p_{n}", pa.float64()) for n in names)])

    def run(frames):
        def of(batch):
            rows = as_rows([cue_hits(t, known) for t in texts_of(batch, "text")])
            return batch.column("doc_id"), *chain_probabilities(chain, rows)

        return batches(frames, schema, of)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, from_arrow_schema(schema))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """The category probabilities of every document; ``predicted`` is 1 if it is toxic rather than not."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    known, chain = learned_chain(docs, labels(spark, sf_dir))
    scores = chain_scores(docs, known, chain)
    return scores.withColumns(
        {"score": F.col("p_toxic"), "predicted": (F.col("p_toxic") >= 0.5).cast("int")}
    )
