"""Text quality from random-indexing word vectors and a small network.

Every word has a fixed sparse random index vector; its word vector is the sum of the index vectors
of its neighbours over the whole corpus. The same is done for the words' shapes (letters and digits
folded to one sign, marks kept). A text is the pooled means and deviations of both kinds of vectors.
A two-layer network in numpy learns quality from labelled texts; a temperature, fitted on rows that
the network has not seen, makes its outputs probabilities. Words are told apart by buckets of their
hash, so the table of vectors has one size whatever the corpus.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from xxhash import xxh64_intdigest

from edgeledger.llm.common import bounded_sample, crc_mod, documents, labels, small_batches
from edgeledger.llm.words import REMEMBERED, batches, mix, texts_of

#: Buckets of words and of shapes, dimensions of a vector, signs in an index vector.
WORDS, SHAPES, SIZE, SIGNS = 8192, 1024, 32, 4
#: Neighbours on each side that count.
WINDOW = 2
#: Labelled rows that the network is fitted on, at most; a fifth of them calibrates its temperature.
LEARN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH = 32, 60, 128
#: Rows whose id's checksum leaves this remainder are never learned from.
HELD_OUT, OUT_OF = 2, 4
THRESHOLD = 0.7

_LOWER, _UPPER, _DIGIT = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[A-Z]+"), re.compile(rb"[0-9]+")


class Buckets(dict):
    """word -> its word bucket and its shape bucket, as one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = _DIGIT.sub(b"0", _LOWER.sub(b"a", _UPPER.sub(b"A", word)))
        value = xxh64_intdigest(word.lower()) % WORDS * SHAPES + xxh64_intdigest(shape) % SHAPES
        self[word] = value
        return value


def buckets_of(texts: list[bytes], known: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all words of all texts, and the number of words of each text."""
    split = [t.split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    total = int(sizes.sum())
    return np.fromiter((c for s in split for c in map(known.__getitem__, s)), np.int64, total), sizes


def index_vectors(count: int, seed: int) -> np.ndarray:
    """Fixed vectors with ``SIGNS`` entries of 1 or -1 at random places."""
    draw = mix(mix(np.arange(count * SIGNS, dtype=np.uint64) + np.uint64(seed << 32 | 1)))
    out = np.zeros((count, SIZE), np.float32)
    place, sign = (draw % np.uint64(SIZE)).astype(int), np.where(draw >> np.uint64(60) & np.uint64(1), 1, -1)
    np.add.at(out, (np.repeat(np.arange(count), SIGNS), place), sign)
    return out


def neighbour_sums(codes: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each word the sum of the index vectors of its neighbours in its own text.

    Empty places part the texts, so that neighbours are shifts of one line. A sum of 2 * ``WINDOW`` vectors
    fits a byte, as no entry is beyond ``SIGNS``.
    """
    if not len(codes):
        return np.zeros((0, SIZE), np.int8)
    place = np.arange(len(codes)) + WINDOW * np.repeat(np.arange(len(sizes)), sizes)
    span = len(codes) + WINDOW * len(sizes)
    line = np.full(span + 2 * WINDOW, len(index))
    line[place + WINDOW] = codes
    vectors = np.vstack([index, np.zeros((1, SIZE))]).astype(np.int8)[line]
    out = np.zeros((span, SIZE), np.int8)
    for k in range(2 * WINDOW + 1):
        if k != WINDOW:
            out += vectors[k : k + span]
    return out[place]


def summed_by(codes: np.ndarray, values: np.ndarray, table: np.ndarray) -> None:
    """Adds ``values`` to the rows of ``table`` that ``codes`` name."""
    if len(codes):
        order = np.argsort(codes.astype(np.uint16) if len(table) <= 1 << 16 else codes, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
        table[codes[order][starts]] += np.add.reduceat(values[order], starts, axis=0, dtype=table.dtype)


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of word and shape buckets from every word of ``docs`` (``text``), each of length 1 or 0.

    A task adds up its texts; the sums of all tasks are added by bucket. Only the two tables, whose
    size is fixed, come to the driver.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("bucket", pa.int64()), ("sums", pa.list_(pa.float64()))])

    def run(frames):
        known, index = Buckets(), both_index_vectors()
        tables = np.zeros((WORDS, SIZE)), np.zeros((SHAPES, SIZE))
        for batch in frames:
            codes, sizes = buckets_of(texts_of(batch, "text"), known)
            for own, vectors, table in zip((codes // SHAPES, codes % SHAPES), index, tables):
                summed_by(own, neighbour_sums(own, sizes, vectors), table)
        all_ = np.concatenate(tables)
        used = np.flatnonzero(np.abs(all_).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(list(all_[used]), schema.types[1])], schema=schema)

    partial = docs.select("text").mapInArrow(run, from_arrow_schema(schema))
    sums = partial.groupBy("bucket").agg(*(F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(SIZE)))
    out = np.zeros((WORDS + SHAPES, SIZE))
    for r in sums.collect():
        out[r[0]] = r[1:]
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    out = out.astype(np.float32)
    return out[:WORDS], out[WORDS:]


FEATURES = 2 * (2 * SIZE + 2) + 1


def both_index_vectors() -> tuple[np.ndarray, np.ndarray]:
    return index_vectors(WORDS, 1), index_vectors(SHAPES, 2)


def pooled(texts: list[bytes], known: Buckets, vectors: tuple, index: tuple) -> np.ndarray:
    """A row for each text, pooled over its words.

    For words and for shapes: means and deviations of their vectors, the squared length of the mean
    index vector, which is large when few words make up the text, and the mean product of adjacent
    index vectors, which is large when words follow themselves. Last, the log of the number of words.
    """
    codes, sizes = buckets_of(texts, known)
    out = np.zeros((len(texts), FEATURES), np.float32)
    full = np.flatnonzero(sizes)
    if len(codes):
        starts = (np.cumsum(sizes) - sizes)[full]
        n = sizes[full][:, None]
        follows = np.ones(len(codes), np.float32)
        follows[starts] = 0
        for k, (own, table, signs) in enumerate(zip((codes // SHAPES, codes % SHAPES), vectors, index)):
            at = (2 * SIZE + 2) * k
            mean = np.add.reduceat(table[own], starts, axis=0) / n
            square = np.add.reduceat((table * table)[own], starts, axis=0) / n
            out[full, at : at + SIZE] = mean
            out[full, at + SIZE : at + 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
            marks = signs[own]
            before = np.roll(marks, 1, axis=0)
            alike = np.einsum("ij,ij->i", marks, before) * follows / SIGNS
            out[full, at + 2 * SIZE] = np.add.reduceat(alike, starts) / n[:, 0]
            middle = np.add.reduceat(marks, starts, axis=0) / n
            out[full, at + 2 * SIZE + 1] = np.einsum("ij,ij->i", middle, middle) / SIGNS
    out[:, -1] = np.log1p(sizes) / 10
    return out


@dataclass
class Network:
    """Two layers with a hyperbolic tangent between, on standardised inputs; ``margin`` is divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    d: float
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.a + self.b) @ self.c + self.d

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, label: np.ndarray, seed: int = 7) -> Network:
    """Adam on shuffled batches with weight decay. One class alone gives a constant."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    share = (label.sum() + 0.5) / (len(label) + 1)
    net = Network(mean, scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))))
    if not label.any() or label.all():
        return net
    standard, first, second, step = (x - mean) / scale, [0.0] * 4, [0.0] * 4, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            hidden = np.tanh(standard[rows] @ net.a + net.b)
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ net.c + net.d, -30, 30))) - label[rows]) / len(rows)
            back = np.outer(wrong, net.c) * (1 - hidden**2)
            slopes = [standard[rows].T @ back + 1e-4 * net.a, back.sum(axis=0), hidden.T @ wrong + 1e-4 * net.c, wrong.sum()]
            step += 1
            moves = []
            for k, g in enumerate(slopes):
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                moves.append(0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8))
            net.a, net.b, net.c, net.d = net.a - moves[0], net.b - moves[1], net.c - moves[2], net.d - moves[3]
    return net


def calibrate(net: Network, x: np.ndarray, label: np.ndarray) -> Network:
    """The temperature of least log loss on rows the network has not seen, by a search on a grid."""
    if len(x):
        margin = net.margin(x.astype(np.float64))
        loss = lambda t: np.logaddexp(0, np.where(label, -margin, margin) / t).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def learned_network(docs: DataFrame, marks: DataFrame, vectors, rows: int = LEARN_ROWS) -> Network:
    """A network from at most ``rows`` labelled rows that are not held out; ``marks`` is ``doc_id, quality``."""
    one = marks.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    open_ = docs.where(F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), OUT_OF) != HELD_OUT))
    sample = bounded_sample(open_.select("doc_id", "text").join(one, "doc_id"), rows, "doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int64()), ("part", pa.int64()), ("x", pa.list_(pa.float32()))])

    def run(frames):
        known, index = Buckets(), both_index_vectors()

        def of(batch):
            return *map(batch.column, ("doc_id", "label", "part")), list(pooled(texts_of(batch, "text"), known, vectors, index))

        return batches(frames, schema, of)

    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)).cast("long").alias("part")
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label")]
    got = sample.select(*own, part, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, from_arrow_schema(schema))
    got = sorted(got.collect())  # tasks give them in any order, and the network depends on it
    x = np.array([r["x"] for r in got], np.float32).reshape(len(got), FEATURES)
    label, part = np.array([r["label"] == 1 for r in got], bool), np.array([r["part"] for r in got], int)
    return calibrate(fit_network(x[part > 0], label[part > 0]), x[part == 0], label[part == 0])


def quality_scores(docs: DataFrame, net: Network, vectors) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    Null and empty texts have no words, which is a text like any other to the network. Repeated rows
    get the same score; null ids count as the id '' for ``held_out``; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(frames):
        known, index = Buckets(), both_index_vectors()

        def of(batch):
            score = net.probability(pooled(texts_of(batch, "text"), known, vectors, index).astype(np.float64))
            return batch.column("doc_id"), batch.column("held_out"), score

        return batches(frames, schema, of)

    held_out = (crc_mod(F.col("doc_id"), OUT_OF) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text")
    scored = rows.mapInArrow(run, from_arrow_schema(schema))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vectors = word_vectors(docs)
    return quality_scores(docs, learned_network(docs, labels(spark, sf_dir), vectors), vectors)
