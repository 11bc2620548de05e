"""Texts as blocks of word numbers, so that figures of distinct words reach every occurrence.

A task takes its texts in blocks. A block has a list of its distinct words, the most frequent
first, and a body, the texts as numbers into that list. Lists are shuffled by word, to learn
whatever the corpus knows of a word, then by block, to meet their bodies; single occurrences are
never shuffled and nothing of the whole vocabulary has to fit in one place. Lists and bodies are
made from the same rows by two passes; a body knows the length and checksum of its list. Where texts
are needed more often, ``packed`` keeps both together, to be landed and read as often as wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from edgeledger.llm.common import small_batches

#: Words after which a block is closed; a text is never split, so a longer one is a block of its own.
BLOCK_WORDS = 6_000_000
#: Occurrences that are taken apart at once.
SLICE = 1_000_000
#: What a file counts for, beside its size, when files are put together for a task.
OPEN_COST = "spark.sql.files.openCostInBytes"
#: Rows of a batch of list entries.
LIST_ROWS = 20_000

BODY = pa.schema([("block", pa.int64()), ("body", pa.binary())])
PACKED = pa.schema([*BODY, ("words", pa.binary())])
ENTRY = [pa.field("block", pa.int64()), pa.field("number", pa.int32()), pa.field("word", pa.binary())]


class Numbers(dict):
    """key -> its place among the keys seen."""

    def __missing__(self, key) -> int:
        value = self[key] = len(self)
        return value

    def of(self, keys: Iterable, size: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int32, size)


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers that are not negative, compressed; the bytes of equal weight stand together."""
    parts = []
    for a in arrays:
        used = (int(a.max(initial=0)).bit_length() + 7) // 8
        width = 4 if used <= 4 else 8
        planes = a.astype(f"<u{width}").view(np.uint8).reshape(len(a), width).T
        parts += [np.array([len(a), used], "<i8").tobytes(), *(planes[k].tobytes() for k in range(used))]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(body: bytes) -> list[np.ndarray]:
    """The numbers again, in four bytes each where all are below 2 ** 24."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    while at < len(raw):
        size, used = np.frombuffer(raw, "<i8", 2, at).tolist()
        width = 4 if used < 4 else 8
        planes = np.zeros((size, width), np.uint8)
        planes[:, :used] = np.frombuffer(raw, np.uint8, size * used, at + 16).reshape(used, size).T
        out.append(planes.reshape(-1).view(f"<i{width}"))
        at += 16 + size * used
    return out


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + size]``, one after another."""
    total = int(sizes.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return values[shift + np.arange(total)]


class Keys:
    """The keys of a block and their numbers, in the order of the texts."""

    def __init__(self):
        self.numbers, self.parts = Numbers(), []

    def closed(self) -> tuple[np.ndarray, list]:
        parts, self.parts, numbers, self.numbers = self.parts, [], self.numbers, Numbers()
        return np.concatenate(parts), list(numbers)


class Words:
    """How texts fall into words; this one takes the words of ``split`` as they are."""

    def __init__(self, split: Callable):
        self.split = split

    def keys(self) -> Keys:
        """What numbers the keys of one block."""
        return Keys()

    def parts(self, column: pa.Array) -> tuple[np.ndarray, Callable]:
        """How many keys each text has, and ``add(i, j, keys)``, which gives those of texts ``i`` to ``j`` to ``keys``."""
        split = list(map(self.split, column.to_pylist()))
        sizes = np.fromiter(map(len, split), np.int64, len(split))

        def add(i: int, j: int, keys: Keys) -> None:
            keys.parts.append(keys.numbers.of(chain.from_iterable(split[i:j]), int(sizes[i:j].sum())))

        return sizes, add

    def refine(self, keys: list) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray] | None:
        """The words of each key: distinct words, then for each key their number and where they start, and the words' places."""
        return None


class Block:
    """A closed block: ``row, doc_id, flag`` and size of each text, and the numbers of all."""

    def __init__(self, row, doc_id, flag, sizes, numbers, words: int, check: int):
        self.row, self.doc_id, self.flag, self.sizes = row, doc_id, flag, sizes
        self.numbers, self.words, self.check = numbers, words, check
        self.ends = np.cumsum(sizes)

    def __len__(self) -> int:
        return len(self.row)

    def text(self, k: int) -> np.ndarray:
        return self.numbers[self.ends[k] - self.sizes[k] : self.ends[k]]

    def dump(self) -> bytes:
        known = np.array([i is not None for i in self.doc_id], np.int64)
        ids = np.array([i or 0 for i in self.doc_id], np.int64)
        return pack(
            self.row, np.abs(ids), known + 2 * (ids < 0), self.flag, self.sizes, self.numbers,
            np.array([self.words, self.check]),
        )

    @classmethod
    def load(cls, body: bytes) -> Block:
        row, ids, state, flag, sizes, numbers, (words, check) = unpack(body)
        ids = [int(-i if s & 2 else i) if s & 1 else None for i, s in zip(ids, state)]
        return cls(row, ids, flag, sizes, numbers, int(words), int(check))


def _taken_apart(flat: np.ndarray, sizes: np.ndarray, counts, starts, places) -> tuple[np.ndarray, np.ndarray]:
    """The words of the keys ``flat`` of texts of ``sizes``, some at a time, and the sizes in words."""
    ends, reached, total, words = np.cumsum(sizes), np.zeros(len(sizes), np.int64), 0, [places[:0]]
    for k in range(0, len(flat), SLICE):
        part = flat[k : k + SLICE]
        own, here = counts[part], np.flatnonzero((ends > k) & (ends <= k + SLICE))
        words.append(gathered(places, starts[part], own))
        steps = np.cumsum(own)
        reached[here] = total + steps[ends[here] - k - 1]
        total += int(steps[-1])
    return np.concatenate(words), np.diff(reached, prepend=0)


def by_bytes(words: list[bytes]) -> np.ndarray:
    """The places of words in the order of their bytes."""
    return pc.sort_indices(pa.array(words, pa.binary())).to_numpy()


def _closed(frames: Iterator[pa.RecordBatch], words: Words, limit: int) -> Iterator[tuple[Block, list[bytes]]]:
    taken, lengths, about, total = words.keys(), [], [], 0

    def close(taken: Keys, sizes: np.ndarray, about: list[tuple]) -> tuple[Block, list[bytes]]:
        flat, keys = taken.closed()  # nothing else holds them, so that they go as soon as words take their place
        if (refined := words.refine(keys)) is not None:
            keys, *where = refined
            flat, sizes = _taken_apart(flat, sizes, *where)
        order = np.argsort(-np.bincount(flat, minlength=len(keys)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        listed = [keys[k] for k in order.tolist()]
        row, doc_id, flag = zip(*about)
        check = crc32(b"\n".join(listed))
        return Block(np.array(row), doc_id, np.array(flag), sizes, rank[flat], len(listed), check), listed

    for batch in frames:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "flag"))))
        sizes, add = words.parts(batch.column("text"))
        reached, at = np.cumsum(sizes), 0
        while at < len(rows):
            before = int(reached[at - 1]) if at else 0
            to = min(int(np.searchsorted(reached[at:], limit - total + before)) + at + 1, len(rows))
            add(at, to, taken)
            lengths.append(sizes[at:to])
            about += rows[at:to]
            total, at = total + int(reached[to - 1]) - before, to
            if total >= limit:
                yield close(taken, np.concatenate(lengths), about)
                taken = words.keys()
                lengths, about, total = [], [], 0
    if about:
        yield close(taken, np.concatenate(lengths), about)


def _rows(docs: DataFrame, binary: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.col("text").cast("binary") if binary else F.col("text")
    return docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("flag").cast("int").alias("flag"))


def _entries(block: Block, listed: list[bytes], about: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    more, name = about(block, listed), int(block.row[0])
    order = by_bytes(listed).tolist()  # neighbours alike compress well
    for at in range(0, len(listed), LIST_ROWS):
        part = order[at : at + LIST_ROWS]
        columns = ([name] * len(part), part, [listed[k] for k in part], [more[k] for k in part])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def lists(docs: DataFrame, words: Words, about: Callable, field: pa.Field, binary: bool = False, limit: int = BLOCK_WORDS) -> DataFrame:
    """``block, number, word`` and the column that ``about(block, words)`` gives for each word.

    ``docs`` has ``row, doc_id, text, flag``; texts are given to ``words`` as bytes if ``binary``. A block
    is named by its first row.
    """
    schema = pa.schema([*ENTRY, field])

    def run(frames):
        for block, listed in _closed(frames, words, limit):
            yield from _entries(block, listed, about, schema)

    return _rows(docs, binary).mapInArrow(run, from_arrow_schema(schema))


def bodies(docs: DataFrame, words: Words, binary: bool = False, limit: int = BLOCK_WORDS) -> DataFrame:
    """``block, body`` of the same blocks."""

    def run(frames):
        for block, _ in _closed(frames, words, limit):
            columns = ([int(block.row[0])], [block.dump()])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, BODY.types)], schema=BODY)

    return _rows(docs, binary).mapInArrow(run, from_arrow_schema(BODY))


def packed(docs: DataFrame, words: Words, binary: bool = False, limit: int = BLOCK_WORDS) -> DataFrame:
    """``block, body, words`` of the same blocks: each with its list, whose words hold no space."""

    def run(frames):
        for block, listed in _closed(frames, words, limit):
            columns = ([int(block.row[0])], [block.dump()], [b" ".join(listed)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PACKED.types)], schema=PACKED)

    return _rows(docs, binary).mapInArrow(run, from_arrow_schema(PACKED))


def loaded(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[bytes]]]:
    """The blocks of ``packed`` and their lists, one at a time."""
    for batch in frames:
        for body, words in zip(batch.column("body"), batch.column("words")):
            yield Block.load(body.as_py()), words.as_py().split(b" ")


def entries(blocks: DataFrame, about: Callable, field: pa.Field) -> DataFrame:
    """What ``lists`` gives, of blocks that ``packed`` has made."""
    schema = pa.schema([*ENTRY, field])

    def run(frames):
        for block, listed in loaded(frames):
            yield from _entries(block, listed, about, schema)

    return blocks.mapInArrow(run, from_arrow_schema(schema))


@contextmanager
def file_by_file(spark: SparkSession) -> Iterator[None]:
    """Tables that are read inside have a task for each file: blocks are small, but there is much to do for each."""
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def meet(packed: DataFrame, known: DataFrame, run: Callable, schema: pa.Schema) -> DataFrame:
    """``run(Block, figures)`` for each block: ``known`` is ``block, number, figure``, the figures come by number.

    Figures travel as one row for each block and task that has made some.
    """
    gathered_ = known.groupBy("block").agg(F.collect_list("number").alias("number"), F.collect_list("figure").alias("figure"))

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.load(left.column("body")[0].as_py())
        if right.num_rows:
            numbers = pa.concat_arrays(right.column("number").chunks).flatten().to_numpy()
            figures = pa.concat_arrays(right.column("figure").chunks).flatten()
        else:
            numbers, figures = np.empty(0, np.int64), pa.array([])
        order = np.argsort(numbers)
        if len(numbers) != block.words or not np.array_equal(numbers[order], np.arange(block.words)):
            raise ValueError(f"block {block.row[0]}: {block.words} words, but a list of {len(numbers)}")
        return run(block, figures.take(pa.array(order)))

    return packed.groupBy("block").cogroup(gathered_.groupBy("block")).applyInArrow(both, from_arrow_schema(schema))
