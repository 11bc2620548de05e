"""Byte-level BPE: ranked merges folded over the bytes of distinct words by Spark expressions.

Every distinct word of the corpus is merged once: a fold starts from its bytes and joins the pair
of least rank, the leftmost of equal ones, until no pair has a rank. The ranks are an array of small
maps from pairs of ids, the map chosen by the pair, as a map's own lookup goes through all its keys;
a scalar subquery gives it, so that no description of the plan holds it. Texts get the ids of their
words through word blocks. Decoding puts the tokens' bytes after one another.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgeledger.llm import word_blocks
from edgeledger.llm.common import documents, let

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Maps that the ranks of pairs are dealt to, and the factor of a pair's first id in the choice.
MAPS = 1 << 15
SPREAD = 7919
#: Taken off ids while they are shuffled, so that those of up to 65,536 tokens take two bytes.
SHIFT = 1 << 15
#: Words of more bytes are merged in a heap, as a fold step costs time in proportion to the word.
FOLD_BYTES = 400


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file, read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pair_ranks(ranks: dict[bytes, int]) -> list[dict[str, int]]:
    """Maps from a pair of ids, as one number, to the id of the token that the two make."""
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                maps[(a * SPREAD + b) % MAPS][str(a << 32 | b)] = rank
    return maps


def rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The maps as a scalar subquery. As a literal they would stand in each description of the plan, megabytes every
    time, all of which the driver keeps."""
    maps = F.from_json("maps", "array<map<string,int>>").cast("array<map<bigint,int>>")
    return spark.createDataFrame([(json.dumps(pair_ranks(ranks)),)], "maps string").select(maps).scalar()


def folded(word: Column, maps: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a word (binary, not empty) by a fold of ranked merges over its bytes. ``maps`` is a column of ``rank_table``."""
    byte_ids = F.from_json(F.lit(json.dumps([ranks[bytes([b])] for b in range(256)])), "array<int>")
    none = F.array().cast("array<int>")

    def rank(table: Column, a: Column, b: Column) -> Column:
        a, b = a.cast("long"), b.cast("long")
        return F.get(table, ((a * SPREAD + b) % MAPS).cast("int"))[a * (1 << 32) + b]

    def start(table: Column, s: Column) -> Column:
        pairs = F.transform(F.slice(s, F.lit(1), F.size(s) - 1), lambda a, i: rank(table, a, F.get(s, i + 1)))
        return F.struct(s.alias("s"), pairs.alias("r"))

    def merge(table: Column, acc: Column, best: Column, at: Column) -> Column:
        """Joins the symbols at ``at`` and after it; only the pairs beside the new one get new ranks."""
        s, r = acc["s"], acc["r"]
        left = F.when(at > 0, F.array(rank(table, F.get(s, at - 1), best))).otherwise(none)
        right = F.when(at + 2 < F.size(s), F.array(rank(table, best, F.get(s, at + 2)))).otherwise(none)
        before = F.slice(r, F.lit(1), F.greatest(at - 1, F.lit(0)))
        return F.struct(
            F.concat(F.slice(s, F.lit(1), at), F.array(best), F.slice(s, at + 3, F.size(s))).alias("s"),
            F.concat(before, left, right, F.slice(r, at + 3, F.size(s))).alias("r"),
        )

    def step(table: Column, acc: Column) -> Column:
        def join(best: Column) -> Column:
            place = (F.array_position(acc["r"], best) - 1).cast("int")
            return F.when(best.isNull(), acc).otherwise(let(place, lambda at: merge(table, acc, best, at)))

        return let(F.array_min(acc["r"]), join)

    def fold(table: Column) -> Column:
        begin = let(symbols, lambda s: start(table, s))
        steps = F.sequence(F.lit(1), F.octet_length(word))
        return F.aggregate(steps, begin, lambda acc, _: step(table, acc), lambda acc: acc["s"])

    symbols = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), lambda c: F.get(byte_ids, F.ascii(c)))
    return let(maps, fold)  # used once, so Spark puts the subquery in its place and no row holds the maps


def heaped(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the same merges, in time near its length."""
    parts = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    pairs = [(ranks[a + b], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
    heapq.heapify(pairs)

    def push(i: int, j: int) -> None:
        if i >= 0 and j < len(parts) and parts[i] + parts[j] in ranks:
            heapq.heappush(pairs, (ranks[parts[i] + parts[j]], i, parts[i], parts[j]))

    while pairs:
        _, i, a, b = heapq.heappop(pairs)
        j = after[i]
        if j >= len(parts) or parts[i] != a or parts[j] != b:
            continue
        parts[i], parts[j], after[i] = a + b, b"", after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        push(before[i], i)
        push(i, after[i])
    return [ranks[p] for p in parts if p]


class Parts(word_blocks.Keys):
    """Parts of texts; those that Arrow has cut are numbered by it when the block is closed, others below zero before."""

    def __init__(self):
        super().__init__()
        self.values = []

    def closed(self):
        flat, single = super().closed()
        coded = pa.chunked_array(self.values, pa.string()).dictionary_encode().unify_dictionaries()
        self.values = []  # a block's texts are not held twice
        keys = coded.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist() if coded.num_chunks else []
        cut = flat >= 0
        flat[~cut] = len(keys) - 1 - flat[~cut]
        flat[cut] = np.concatenate([flat[:0], *(chunk.indices.to_numpy() for chunk in coded.chunks)])
        del coded
        pa.default_memory_pool().release_unused()
        return flat, keys + single


class Pieces(word_blocks.Words):
    """The matches of a pattern as words.

    A text is cut before each space that a character other than white space follows, where a match
    of such a pattern always begins, and the pattern is applied to distinct parts only.
    """

    def __init__(self, pattern: str):
        self.match = regex.compile(pattern).findall
        self.cut = re.compile(r" (?=\S)").split
        self.odd = re.compile(r" (?:\s|$)").search

    def keys(self):
        return Parts()

    def parts(self, column):
        """Texts without a space before white space or at their end are cut by Arrow."""
        texts = column.to_pylist()
        even = np.fromiter((self.odd(t) is None for t in texts), bool, len(texts))
        split = pc.split_pattern(column.filter(pa.array(even)), " ")
        starts, values = split.offsets.to_numpy().astype(np.int64), split.values
        other = {k: self.cut(texts[k]) for k in np.flatnonzero(~even).tolist()}
        sizes = np.empty(len(texts), np.int64)
        sizes[even], sizes[~even] = np.diff(starts), [len(parts) for parts in other.values()]
        place = np.concatenate(([0], np.cumsum(even)))

        def add(i, j, keys):
            own, low, high = np.repeat(even[i:j], sizes[i:j]), int(starts[place[i]]), int(starts[place[j]])
            single, flat = ~own, np.zeros(len(own), np.int32)
            single[np.cumsum(sizes[i:j]) - sizes[i:j]] = True
            keys.values.append(values.slice(low, high - low).filter(pa.array(~single[own])))
            listed = ([texts[k].partition(" ")[0]] if even[k] else other[k] for k in range(i, j))
            found = [key for first, *rest in listed for key in (FIRST + first, *rest)]
            flat[single] = -1 - keys.numbers.of(found, len(found))
            keys.parts.append(flat)

        return sizes, add

    def refine(self, keys):
        """Keys without a space are matched many at a time, put together as in a text: the match that begins with a
        space is the first of its key. Others are matched one by one."""
        numbers, counts = word_blocks.Numbers(), np.empty(len(keys), np.int64)
        plain = [" " not in key and key[:1] not in ("", FIRST) for key in keys]
        together, alone = np.flatnonzero(plain), np.flatnonzero(~np.array(plain, bool))
        order, flat = [], []
        for at in range(0, len(together), KEYS):
            part = together[at : at + KEYS]
            found = self.match("".join([" " + keys[k] for k in part]))
            begins = np.flatnonzero(np.fromiter(map(" ".__eq__, map(FIRST_OF, found)), bool, len(found)))
            if len(begins) != len(part) or begins[0]:  # a match of this pattern doesn't begin at each space
                alone = np.sort(np.concatenate((alone, part)))
                continue
            counts[part] = np.diff(begins, append=len(found))
            order.append(part)
            flat.append(numbers.of(found, len(found)))
        for k in alone.tolist():
            found = self.match(keys[k][1:] if keys[k][:1] == FIRST else " " + keys[k])
            counts[k] = len(found)
            flat.append(numbers.of(found, len(found)))
        order = np.concatenate((*order, alone)).astype(np.int64)
        starts = np.empty(len(keys), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return [w.encode() for w in numbers], counts, starts, np.concatenate((np.empty(0, np.int32), *flat))


#: Marks a text's first part, which no space precedes. No text holds half a surrogate pair.
FIRST = "\ud800"
FIRST_OF = itemgetter(0)
#: Keys that are matched at once.
KEYS = 20_000


def corpus_ids(listed: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``block, number, figure``: the ids of each list's words, less ``SHIFT``; every distinct word is merged once.

    ``listed`` is ``block, number, word, ids``, with ids for words too long to fold. A list has a word
    once, so a word has a row for each block at most.
    """
    own = Window.partitionBy("word").orderBy("block")
    first = listed.withColumn("place", F.row_number().over(own)).withColumn("maps", rank_table(listed.sparkSession, ranks))
    shortcuts = {t: r for t, r in ranks.items() if heaped(t, ranks) != [r]}
    ids = folded(F.col("word"), F.col("maps"), ranks)
    if shortcuts:  # tokens that merges don't reach are still what a word that equals them becomes
        table = F.from_json(F.lit(json.dumps({t.hex().upper(): [r] for t, r in shortcuts.items()})), "map<string,array<int>>")
        ids = F.coalesce(table[F.hex("word")], ids)
    kind = "smallint" if max(ranks.values()) < 2 * SHIFT else "int"
    short = F.transform(F.coalesce("ids", ids), lambda x: (x - SHIFT).cast(kind))
    merged = first.select("block", "number", "word", F.when(F.col("place") == 1, short).alias("ids"))
    return merged.select("block", "number", F.first("ids").over(own).alias("figure"))


class Vocabulary:
    """The tokens' bytes by id, for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return word_blocks.gathered(self.bytes, self.starts[ids], self.sizes[ids]).tobytes()


def encoded(docs: DataFrame, path: str, pattern: str, finish: Callable, schema: pa.Schema) -> DataFrame:
    """Every row of ``docs`` (``row, doc_id, text``; text not null) encoded, and decoded from its ids.

    ``finish(ids, decoded)`` gives the columns of ``schema`` after ``row`` and ``doc_id``; the ids are
    unsigned 32-bit integers, ``decoded`` the bytes that they stand for. Empty texts have no ids.
    The file at ``path`` is read on the driver; each byte must have a rank, as in any byte-level
    vocabulary.
    """
    ranks, words = read_ranks(path), Pieces(pattern)
    flagged = docs.withColumn("flag", F.lit(0))

    def long_ids(block: word_blocks.Block, listed: list[bytes]) -> list[list[int] | None]:
        return [
            None if len(w) <= FOLD_BYTES else [ranks[w]] if w in ranks else heaped(w, ranks) for w in listed
        ]

    listed = word_blocks.lists(flagged, words, long_ids, pa.field("ids", pa.list_(pa.int32())))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = corpus_ids(listed.repartition(tasks, "word"), ranks)
    vocabulary = Vocabulary(ranks)

    def run(block: word_blocks.Block, lists: pa.Array) -> pa.Table:
        if len(lists):
            offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().astype(np.int64) + SHIFT
            starts, sizes = offsets[:-1], np.diff(offsets)
        else:
            starts = sizes = values = np.empty(0, np.int64)
        rows = []
        for k in range(len(block)):
            numbers = block.text(k)
            own = word_blocks.gathered(values, starts[numbers], sizes[numbers]).astype("<u4")
            rows.append((int(block.row[k]), block.doc_id[k], *finish(own, vocabulary.decode(own))))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return word_blocks.meet(word_blocks.bodies(flagged, words), known, run, schema)


DIGESTS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def _digests(ids: np.ndarray, decoded: bytes) -> tuple:
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _digests_and_ids(ids: np.ndarray, decoded: bytes) -> tuple:
    return *_digests(ids, decoded), ids.astype(np.int32)


def _by_the_public_ranks(docs: DataFrame, finish: Callable, schema: pa.Schema) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    return encoded(rows, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, finish, schema).drop("row")


def digest_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row of ``docs``.

    Null texts count as empty; repeated rows give repeated rows, an empty table an empty one.
    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes.
    """
    return _by_the_public_ranks(docs, _digests, DIGESTS)


def token_rows(docs: DataFrame) -> DataFrame:
    """As ``digest_rows``, and the ``ids`` themselves."""
    return _by_the_public_ranks(docs, _digests_and_ids, DIGESTS.append(pa.field("ids", pa.list_(pa.int32()))))


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digests of the ids of every document, and of the text they decode to."""
    return digest_rows(documents(spark, sf_dir))
