"""A gated recurrent language model in numpy, and the log-likelihood of whole documents.

The vocabulary is the most frequent training words, the end of a text and one entry for all other
words. The output is factored: first a class, then a word of the class; another word is the entry's
probability times its share by the corpus counts. Learning is truncated backpropagation: tasks
start from the same parameters, each goes through its own training texts in windows with the state
carried on, and the parameters are averaged by the tokens seen; this is done a few times. Scoring
carries the state through all windows of a document, so every token counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from edgeledger.llm import word_blocks
from edgeledger.llm.common import crc_mod, documents, land, land_for, slim
from edgeledger.llm.words import lowered_words

#: A document's last token. No word holds a line feed.
END = b"\n"
#: Words of the vocabulary at most, besides the entry for all others.
VOCABULARY = 2047
SIZE = 24
CLASSES = 64
#: Rows whose id's checksum leaves this remainder are never learned from.
HELD_OUT, OUT_OF = 2, 7
#: Times that every training document teaches the network.
ROUNDS = 3
#: Texts of one task are learned in so many streams at once, in windows of so many tokens.
STREAMS, STEPS = 64, 16
#: Texts scored at once, and the tokens of each in a window.
SCORED, SCORED_STEPS = 512, 64
#: States whose words are scored at once.
SCORED_ROWS = 2048
#: Logits between this and its negative need no shift before exponentials are summed.
LARGE = 60.0
#: How much of the mean slopes and of their mean squares is kept from step to step.
DECAY_FIRST, DECAY_SECOND = np.float32(0.9), np.float32(0.995)
#: Parameters that are moved at once.
PART = 1 << 14
#: Values in a row when parameters are averaged.
PIECE = 32


def tokens(text: bytes) -> list[bytes]:
    return [*lowered_words(text), END]


@dataclass
class Model:
    """The parameters. ``first`` is where each class begins in the vocabulary, which is in class order."""

    embed: np.ndarray
    into: np.ndarray
    again: np.ndarray
    gate: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray
    first: np.ndarray

    def learned(self) -> list[str]:
        return [f.name for f in fields(self) if f.name != "first"]

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.learned()])

    def over(self, values: np.ndarray) -> Model:
        """A model whose parameters are parts of ``values`` and change with them."""
        parts, at = {}, 0
        for n in self.learned():
            old = getattr(self, n)
            parts[n] = values[at : at + old.size].reshape(old.shape)
            at += old.size
        return Model(**parts, first=self.first)

    def with_flat(self, values: np.ndarray) -> Model:
        return self.over(values.astype(np.float32))

    def class_rows(self) -> np.ndarray:
        """A row for each class: its weights, then its bias."""
        return np.column_stack((self.to_class.T, self.class_bias))

    def word_rows(self) -> np.ndarray:
        return np.column_stack((self.to_word, self.word_bias))

    def outputs(self, rows: int) -> Outputs:
        return Outputs(self.class_rows(), self.word_rows(), self.first, rows)


def start(counts: np.ndarray, seed: int = 3) -> Model:
    """A model that begins as the words' frequencies. ``counts`` falls; equal sums of roots make a class."""
    rng = np.random.default_rng(seed)
    n, weight = len(counts), np.cumsum(np.sqrt(counts + 1.0))
    wanted = weight[-1] * np.arange(1, CLASSES) / CLASSES
    first = np.unique(np.concatenate(([0], np.searchsorted(weight, wanted) + 1, [n])))
    first = first[first <= n]
    share = (counts + 0.5) / (counts + 0.5).sum()
    mass = np.add.reduceat(share, first[:-1])
    small = lambda *shape: (rng.normal(0, shape[0] ** -0.5, shape)).astype(np.float32)
    return Model(
        embed=rng.normal(0, 0.3, (n, SIZE)).astype(np.float32), into=small(SIZE, 3 * SIZE), again=small(SIZE, 3 * SIZE),
        gate=np.zeros(3 * SIZE, np.float32), to_class=np.zeros((SIZE, len(mass)), np.float32),
        class_bias=np.log(mass).astype(np.float32), to_word=np.zeros((n, SIZE), np.float32),
        word_bias=np.log(share / np.repeat(mass, np.diff(first))).astype(np.float32), first=first,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _step(model: Model, given: np.ndarray, state: np.ndarray):
    """One step of the cell: ``given`` is the input's part of the gates, the bias included."""
    n = SIZE
    both = given[:, : 2 * n] + state @ model.again[:, : 2 * n]
    gates = _sigmoid(both)
    update, reset = gates[:, :n], gates[:, n:]
    kept = reset * state
    fresh = np.tanh(given[:, 2 * n :] + kept @ model.again[:, 2 * n :])
    return state + update * (fresh - state), update, reset, kept, fresh


class Outputs:
    """The factored output for states in the order of their targets. Its arrays are made once and used again.

    ``classes`` and ``words`` have a row for each class and word: the weights, then the bias.
    """

    def __init__(self, classes: np.ndarray, words: np.ndarray, first: np.ndarray, rows: int):
        kind = classes.dtype
        edges = list(zip(first[:-1].tolist(), first[1:].tolist()))
        self.classes, self.words, self.first, self.rows = classes, words, first, rows
        self.class_of = np.repeat(np.arange(len(edges)), np.diff(first))
        self.wide, self.of = np.diff(first), [words[a:b] for a, b in edges]
        self.turned = [w.T for w in self.of]
        self.states = np.ones((rows, SIZE + 1), kind)  # the last column meets the bias
        self.over_classes, self.ones = np.empty((rows, len(edges)), kind), np.ones(len(edges), kind)
        self.over_words = np.empty(rows * int(self.wide.max()), kind)
        self.class_at = np.arange(rows) * len(edges)

    def meet(self, states: np.ndarray, targets: np.ndarray) -> None:
        """Takes ``rows`` states at most: logits of the classes and of the words of the targets' classes."""
        n = len(targets)
        self.order = np.argsort(targets.astype(np.uint16), kind="stable")
        self.word = targets[self.order]
        own = self.class_of[self.word]
        self.h, self.e = self.states[:n], self.over_classes[:n]
        self.h[:, :SIZE] = states[self.order]
        np.dot(self.h, self.classes.T, out=self.e)
        bounds = np.searchsorted(own, np.arange(len(self.wide) + 1)).tolist()
        sizes = self.wide[own]
        ends = np.cumsum(sizes)
        self.starts, self.inside = ends - sizes, self.over_words[: ends[-1]]
        edges = [0, *ends.tolist()]
        self.parts = [
            (c, a, b, self.inside[edges[a] : edges[b]].reshape(b - a, -1)) for c, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b
        ]
        for c, a, b, part in self.parts:
            np.dot(self.h[a:b], self.turned[c], out=part)
        #: Where the logits of the targets lie.
        self.of_class, self.of_word = self.class_at[:n] + own, self.starts + self.word - self.first[own]

    def exps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Logits become their exponentials: the targets' logits and each row's sum, over classes and over words.

        Rows are shifted by their greatest logit only where sums would leave what numbers hold.
        """
        kept = []
        for logits, at, parts in ((self.e.reshape(-1), self.of_class, [self.e]), (self.inside, self.of_word, [p[-1] for p in self.parts])):
            if not (-LARGE < logits.min() and logits.max() < LARGE):
                for part in parts:
                    part -= part.max(axis=1, keepdims=True)
            kept.append(logits[at])
            np.exp(logits, out=logits)
        return kept[0], np.dot(self.e, self.ones), kept[1], np.add.reduceat(self.inside, self.starts)

    def logs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each target after the state before it."""
        out = np.empty(len(targets), self.states.dtype)
        for at in range(0, len(targets), self.rows):
            self.meet(states[at : at + self.rows], targets[at : at + self.rows])
            of_class, classes, of_word, words = self.exps()
            out[at + self.order] = of_class - np.log(classes) + of_word - np.log(words)
        return out


def log_likelihoods(model: Model, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each target after the state before it."""
    return model.outputs(min(len(targets), SCORED_ROWS)).logs(states, targets)


class Room:
    """The arrays of a window of so many steps and streams, made once: new ones would cost more than the sums."""

    def __init__(self, steps: int, streams: int, classes: np.ndarray, words: np.ndarray, first: np.ndarray):
        kind, flat = classes.dtype, (steps, streams, SIZE)
        self.taken, self.places, self.at = np.empty((steps * streams, SIZE), kind), np.arange(SIZE), np.empty((steps * streams, SIZE), np.intp)
        self.given, self.turns = (np.empty((3, *flat), kind) for _ in range(2))
        self.both, self.before, self.kept, self.fresh, self.states = np.empty((2, *flat), kind), *(np.empty(flat, kind) for _ in range(4))
        self.back, self.by_fresh, self.by_update, self.by_reset, self.stays = (np.empty(flat, kind) for _ in range(5))
        self.two, self.one, self.later = np.empty((2, streams, SIZE), kind), *(np.empty((streams, SIZE), kind) for _ in range(2))
        self.outputs, self.ones = Outputs(classes, words, first, steps * streams), np.ones((1, steps * streams), kind)
        self.back_words, self.scaled = (np.empty((steps * streams, SIZE + 1), kind) for _ in range(2))
        #: Views by step, made once.
        self.steps = list(zip(
            self.given[:2].swapaxes(0, 1), self.given[2], self.both.swapaxes(0, 1), self.before, self.kept, self.fresh, self.states,
        ))
        self.steps_back = list(zip(self.back, self.by_fresh, self.by_update, self.by_reset, self.stays, self.both[1], self.turns.swapaxes(0, 1)))


class Learner:
    """Parameters and their slopes, laid out so that a step's arrays are whole: gates apart, weights beside their bias."""

    def __init__(self, model: Model):
        kind, n, self.first = model.embed.dtype, len(model.embed), model.first
        shapes = {
            "embed": (n, SIZE), "into": (3, SIZE, SIZE), "again": (3, SIZE, SIZE), "gate": (3, 1, SIZE),
            "classes": (len(self.first) - 1, SIZE + 1), "words": (n, SIZE + 1),
        }
        ends = np.cumsum([int(np.prod(s)) for s in shapes.values()]).tolist()
        self.theta, self.g = np.empty(ends[-1], kind), np.zeros(ends[-1], kind)
        self.p, self.s = ({k: v[b - int(np.prod(s)) : b].reshape(s) for (k, s), b in zip(shapes.items(), ends)} for v in (self.theta, self.g))
        self.p["embed"][:] = model.embed
        for k in ("into", "again"):
            self.p[k][:] = getattr(model, k).reshape(SIZE, 3, SIZE).swapaxes(0, 1)
        self.p["gate"][:, 0] = model.gate.reshape(3, SIZE)
        self.p["classes"][:], self.p["words"][:] = model.class_rows(), model.word_rows()
        self.word_slopes = [self.s["words"][a:b] for a, b in zip(self.first, self.first[1:])]
        self.rooms: dict[tuple[int, int], Room] = {}
        self.sign = np.array([-1, -1, 1], kind).reshape(3, 1, 1)

    def _named(self, v: dict) -> dict:
        apart = {k: v[k].swapaxes(0, 1).reshape(SIZE, 3 * SIZE) for k in ("into", "again")}
        return {
            "embed": v["embed"], **apart, "gate": v["gate"].ravel(), "to_class": v["classes"][:, :SIZE].T,
            "class_bias": v["classes"][:, SIZE], "to_word": v["words"][:, :SIZE], "word_bias": v["words"][:, SIZE],
        }

    def model(self) -> Model:
        return Model(**self._named(self.p), first=self.first)

    def slopes(self) -> dict:
        return self._named(self.s)

    def window(self, x: np.ndarray, y: np.ndarray, state: np.ndarray, end: int) -> np.ndarray:
        """Sets the slopes of the mean loss over a window (``x, y``: steps by streams); the state after it."""
        if x.shape not in self.rooms:
            self.rooms[x.shape] = Room(*x.shape, self.p["classes"], self.p["words"], self.first)
        room = self.rooms[x.shape]
        goes_on = (x != end)[:, :, None]  # a text begins without memory of the one before
        begins = (~goes_on.all(axis=(1, 2))).tolist()
        state = self._forward(room, x, state, goes_on, begins)
        self.g.fill(0)
        self._outputs(room, y.ravel())
        self._backward(room, x.ravel(), goes_on, begins)
        return state

    def _forward(self, room: Room, x: np.ndarray, state: np.ndarray, goes_on: np.ndarray, begins: list[bool]) -> np.ndarray:
        steps, streams = x.shape
        # Update and reset with the sign turned: 1 / (1 + exp(-x)) needs no further step.
        into, again, gate = (self.p[k] * self.sign for k in ("into", "again", "gate"))
        np.take(self.p["embed"], x.ravel(), axis=0, out=room.taken, mode="clip")
        np.matmul(room.taken, into, out=room.given.reshape(3, -1, SIZE))
        lines = room.given.reshape(3, steps, -1)
        lines += np.repeat(gate, streams, axis=1).reshape(3, 1, -1)
        two, one, both, new = again[:2], again[2], room.two, room.one
        for t, (given_both, given_new, gates, before, kept, fresh, after) in enumerate(room.steps):
            if begins[t]:
                np.multiply(state, goes_on[t], out=before)
            else:
                before[:] = state
            np.matmul(before, two, out=both)
            both += given_both
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=gates)
            np.multiply(gates[1], before, out=kept)
            np.dot(kept, one, out=new)
            new += given_new
            np.tanh(new, out=fresh)
            np.subtract(fresh, before, out=after)
            after *= gates[0]
            after += before
            state = after
        return state.copy()

    def _outputs(self, room: Room, targets: np.ndarray) -> None:
        """Slopes of the output's parameters, and in ``room.back`` those of the states."""
        n, out, c, w = len(targets), room.outputs, self.p["classes"], self.p["words"]
        out.meet(room.states.reshape(n, SIZE), targets)
        _, class_sums, _, word_sums = out.exps()
        # A row's shares are its exponentials over their sum; the target's slope is its share less one.
        out.e.reshape(-1)[out.of_class] -= class_sums
        out.inside[out.of_word] -= word_sums
        of_class, of_word = (1 / (n * class_sums))[:, None], (1 / (n * word_sums))[:, None]
        back, scaled = room.back_words, room.scaled
        np.multiply(out.h, of_class, out=scaled)
        np.dot(out.e.T, scaled, out=self.s["classes"])
        np.multiply(out.h, of_word, out=scaled)
        for k, a, b, part in out.parts:
            np.dot(part, out.of[k], out=back[a:b])
            np.dot(part.T, scaled[a:b], out=self.word_slopes[k])
        back *= of_word
        np.dot(out.e, c, out=scaled)
        scaled *= of_class
        back += scaled
        room.back.reshape(n, SIZE)[out.order] = back[:, :SIZE]

    def _backward(self, room: Room, x: np.ndarray, goes_on: np.ndarray, begins: list[bool]) -> None:
        """Slopes of all before the states."""
        n, (update, reset) = len(x), room.both
        np.subtract(1, update, out=room.stays)
        np.multiply(room.fresh, room.fresh, out=room.by_fresh)
        np.subtract(1, room.by_fresh, out=room.by_fresh)
        room.by_fresh *= update
        np.subtract(room.fresh, room.before, out=room.by_update)
        room.by_update *= update
        room.by_update *= room.stays
        np.subtract(1, reset, out=room.by_reset)
        room.by_reset *= room.kept  # reset times the state before
        two, one = self.p["again"][:2].swapaxes(1, 2), self.p["again"][2].T
        later, kept, both = room.later, room.one, room.two
        later.fill(0)
        for t in range(len(goes_on) - 1, -1, -1):
            d, by_fresh, by_update, by_reset, stays, own_reset, turns = room.steps_back[t]
            d += later
            np.multiply(d, by_fresh, out=turns[2])
            np.dot(turns[2], one, out=kept)
            np.multiply(d, by_update, out=turns[0])
            np.multiply(kept, by_reset, out=turns[1])
            np.multiply(d, stays, out=later)
            kept *= own_reset
            later += kept
            np.matmul(turns[:2], two, out=both)
            later += both[0]
            later += both[1]
            if begins[t]:
                later *= goes_on[t]
        turns, s = room.turns.reshape(3, n, SIZE), self.s
        np.matmul(room.before.reshape(n, SIZE).T, turns[:2], out=s["again"][:2])
        np.dot(room.kept.reshape(n, SIZE).T, turns[2], out=s["again"][2])
        np.matmul(room.taken.T, turns, out=s["into"])
        np.matmul(room.ones, turns, out=s["gate"])
        given = room.given.reshape(3, n, SIZE)
        np.matmul(turns, self.p["into"].swapaxes(1, 2), out=given)
        given[0] += given[1]
        given[0] += given[2]
        np.add((x * SIZE)[:, None], room.places, out=room.at)
        np.add.at(s["embed"].reshape(-1), room.at.reshape(-1), given[0].reshape(-1))

    def move(self, step: int, rate: float, first: np.ndarray, second: np.ndarray) -> None:
        """A step of Adam by the slopes, no longer than 1. ``first`` and ``second`` are ten and 200 times the means."""
        g = self.g
        if (length := float(np.sqrt(g @ g)) + 1e-9) > 1:
            g *= g.dtype.type(1 / length)
        deep = math.sqrt(0.005 / (1 - 0.995**step))
        by, least = np.float32(0.1 * rate / (1 - 0.9**step) / deep), np.float32(1e-6 / deep)
        for at in range(0, len(g), PART):  # a part of all four stays in the cache
            t, v, a, b = (z[at : at + PART] for z in (self.theta, g, first, second))
            a *= DECAY_FIRST
            a += v
            b *= DECAY_SECOND
            v *= v
            b += v
            np.sqrt(b, out=v)
            v += least
            np.divide(a, v, out=v)
            v *= by
            t -= v


def _learn_window(model: Model, x: np.ndarray, y: np.ndarray, state: np.ndarray, end: int) -> tuple[dict, np.ndarray]:
    """Slopes of the mean loss over a window (``x, y``: steps by streams) and the state after it."""
    learner = Learner(model)
    state = learner.window(x, y, state, end)
    return learner.slopes(), state


def learn(model: Model, stream: np.ndarray, end: int, rate: float) -> Model:
    """One pass of truncated backpropagation over a task's tokens, in parallel streams."""
    width = (len(stream) - 1) // STREAMS
    if width < 1:
        return model
    x = stream[: width * STREAMS].reshape(STREAMS, width)
    y = stream[1 : width * STREAMS + 1].reshape(STREAMS, width)
    learner = Learner(model)
    first, second = np.zeros_like(learner.theta), np.zeros_like(learner.theta)
    state, windows = np.zeros((STREAMS, SIZE), np.float32), range(0, width, STEPS)
    with np.errstate(over="ignore"):  # a gate's exponential may be infinite: the gate is 0
        for step, at in enumerate(windows, 1):
            given, wanted = (np.ascontiguousarray(v[:, at : at + STEPS].T, np.intp) for v in (x, y))
            state = learner.window(given, wanted, state, end)
            learner.move(step, rate * (1 - 0.9 * step / len(windows)), first, second)
    return learner.model()


def document_scores(model: Model, numbers: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The summed log-likelihood of each text's tokens. Windows bound the memory; the state goes through all of them."""
    starts, out = np.cumsum(sizes) - sizes, np.zeros(len(sizes))
    given = model.embed @ model.into + model.gate
    given_both, given_new = -given[:, : 2 * SIZE], np.ascontiguousarray(given[:, 2 * SIZE :])
    two, one = -model.again[:, : 2 * SIZE], np.ascontiguousarray(model.again[:, 2 * SIZE :])
    outputs, order = model.outputs(SCORED_ROWS), np.argsort(-sizes, kind="stable")
    room = np.empty((SCORED * SCORED_STEPS, SIZE), model.embed.dtype)
    for at in range(0, len(order), SCORED):
        texts = order[at : at + SCORED]
        own, begin = sizes[texts], starts[texts]
        state, last = np.zeros((len(texts), SIZE), room.dtype), np.full(len(texts), end, np.intp)
        for t in range(0, int(own[0]) if len(own) else 0, SCORED_STEPS):
            steps = np.arange(t, min(t + SCORED_STEPS, int(own[0])))[:, None]
            goes_on = steps < own[: np.searchsorted(-own, -t, side="left")]  # texts longer than t come first
            words = np.take(numbers, begin[: goes_on.shape[1]] + steps, mode="clip").astype(np.intp)
            to = 0
            for n, word in zip(goes_on.sum(axis=1).tolist(), words):
                before, last = state[:n], last[:n]
                gates = before @ two
                gates += given_both.take(last, axis=0)
                with np.errstate(over="ignore"):
                    np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new = (gates[:, SIZE:] * before) @ one
                new += given_new.take(last, axis=0)
                np.tanh(new, out=new)
                new -= before
                new *= gates[:, :SIZE]
                state, last = np.add(new, before, out=room[to : to + n]), word
                to += n
            state, last = state.copy(), last[:n]  # the room is used again
            logs = outputs.logs(room[:to], words[goes_on])
            out[texts] += np.bincount(np.nonzero(goes_on)[1], logs, minlength=len(texts))
    return out


@dataclass
class Corpus:
    """Counts of all training tokens: ``total`` and ``distinct``, and the vocabulary in its order."""

    total: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray

    @property
    def other(self) -> int:
        """The entry for all other words; it comes last."""
        return len(self.words)

    def weights(self) -> np.ndarray:
        return np.append(self.counts, max(0, self.total - int(self.counts.sum())))

    def rest(self) -> float:
        """The sum of count + 1 over the words that are not in the vocabulary and one that was never seen."""
        return float(self.total + self.distinct + 1 - int((self.counts + 1).sum()))


def corpus_counts(blocks: DataFrame) -> tuple[Corpus, DataFrame]:
    """The counts, and ``block, number, word, c`` of all lists, landed: c is the word's count in training texts."""

    def uses(block: word_blocks.Block, listed: list[bytes]) -> np.ndarray:
        return np.bincount(block.numbers[np.repeat(block.flag != 0, block.sizes)], minlength=len(listed))

    listed = word_blocks.entries(blocks, uses, pa.field("uses", pa.int64()))
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A list has a word once: a word has a row for each block, not for each use.
    own = Window.partitionBy("word")
    counted = listed.repartition(tasks, "word").select(
        "block", "number", "word", "uses", F.sum("uses").over(own).alias("c"),
        F.row_number().over(own.orderBy("block")).alias("place"),
    )
    known, figures = land_for(counted, "lm-words", 2)
    one = figures.where("place = 1 and c > 0")
    total = figures.agg(F.sum("uses")).first()[0] or 0
    top = one.where(F.col("word") != END).orderBy(F.desc("c"), "word").select("word", "c").limit(VOCABULARY - 1).collect()
    ends = one.where(F.col("word") == END).select("c").first()
    entries = sorted([(bytes(r["word"]), r["c"]) for r in top] + [(END, ends["c"] if ends else 0)], key=lambda e: (-e[1], e[0]))
    return Corpus(total, one.count(), [e[0] for e in entries], np.array([e[1] for e in entries])), known


def packed(flagged: DataFrame) -> DataFrame:
    return word_blocks.packed(flagged, word_blocks.Words(tokens), binary=True)


def trained(flagged: DataFrame, corpus: Corpus, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` of learning by all tasks and averaging. Without training tokens it stays as it began."""
    return taught(packed(flagged), corpus, rounds)


def taught(blocks: DataFrame, corpus: Corpus, rounds: int = ROUNDS) -> Model:
    """What ``trained`` gives, from the blocks of the texts."""
    model = start(corpus.weights())
    place, other = {w: k for k, w in enumerate(corpus.words)}, corpus.other
    end = place[END]
    schema = pa.schema([("piece", pa.int64()), ("weight", pa.float64()), ("values", pa.list_(pa.float64()))])
    for k in range(rounds if corpus.total else 0):
        rate = 0.014 / (1 + k)

        def run(frames, model=model, rate=rate):
            seen = [np.array([end], np.uint16)]
            for block, listed in word_blocks.loaded(frames):
                entry = np.fromiter((place.get(w, other) for w in listed), np.uint16, len(listed))
                seen.append(entry[block.numbers[np.repeat(block.flag != 0, block.sizes)]])
            seen = np.concatenate(seen)
            if len(seen) > STREAMS:
                values = learn(model, seen, end, rate).flat().astype(np.float64)
                values = np.append(values, np.zeros(-len(values) % PIECE)).reshape(-1, PIECE) * len(seen)
                columns = (range(len(values)), [float(len(seen))] * len(values), list(values))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        sums = [F.sum(F.get("values", F.lit(j))).alias(f"v{j}") for j in range(PIECE)]
        parts = blocks.mapInArrow(run, from_arrow_schema(schema)).groupBy("piece").agg(F.sum("weight").alias("weight"), *sums)
        got = sorted(tuple(r) for r in parts.collect())
        if got:
            table = np.array(got)
            model = model.with_flat((table[:, 2:] / table[:, 1:2]).ravel()[: len(model.flat())])
    return model


SCORES = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


def scored(docs: DataFrame) -> DataFrame:
    """Token counts, unigram score and model score of each row of ``docs`` (``row, doc_id, text``).

    Scores are log10 probabilities of the whole text and its end. Null and empty texts are the end
    alone. Null ids count as the id '' in the choice of held-out rows; repeated rows get the same; an
    empty table gives an empty one. Without training texts every token is unseen.
    """
    flagged = docs.withColumn("flag", (crc_mod(F.col("doc_id"), OUT_OF) != HELD_OUT).cast("int"))
    # Texts are taken apart once; counting, each round of learning and scoring read the blocks.
    blocks = land(packed(flagged), "lm-blocks")
    with word_blocks.file_by_file(docs.sparkSession):
        corpus, known = corpus_counts(blocks)
        model = taught(blocks, corpus)
    end, other, span = corpus.words.index(END), corpus.other, len(corpus.words) + 1
    spark = docs.sparkSession
    entries = ", ".join(f"(X'{w.hex()}', {k + 1})" for k, w in enumerate(corpus.words))
    vocabulary = spark.sql(f"select * from values {entries} as t(word, entry)")
    figure = F.col("c") * span + F.coalesce("entry", F.lit(0))
    figures = known.join(vocabulary, "word", "left").select("block", "number", figure.alias("figure"))
    total, all_, rest = corpus.total, float(corpus.total + corpus.distinct + 1), max(1.0, corpus.rest())

    def run(block: word_blocks.Block, column: pa.Array) -> pa.Table:
        c, entry = np.divmod(column.to_numpy().astype(np.int64), span)
        entry = np.where(entry == 0, other, entry - 1)
        text = np.repeat(np.arange(len(block)), block.sizes)
        sums = lambda values: np.bincount(text, values[block.numbers], minlength=len(block))
        base = sums(np.log10((c + 1) / all_))
        share = sums(np.where(entry == other, np.log10((c + 1) / rest), 0.0))
        score = document_scores(model, entry[block.numbers], block.sizes, end) / np.log(10) + share
        columns = (
            block.doc_id, block.flag == 0, block.sizes, sums((c > 0).astype(float)).astype(np.int64),
            np.full(len(block), total), base, score,
        )
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, SCORES.types)], schema=SCORES)

    return word_blocks.meet(blocks.select("block", "body"), figures, run, SCORES)


def op1_lm_score(spark, sf_dir: str) -> DataFrame:
    """The scores of every document."""
    stored = documents(spark, sf_dir).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return scored(slim(stored, "row"))
