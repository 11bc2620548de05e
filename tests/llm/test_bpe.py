"""Ids against the public library, and the way back."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from edgeledger.llm import byte_bpe, word_blocks
from tests.llm import cases

PATH = public_tokenizers.path(byte_bpe.RANKS)
HARD = [
    (9001, "a\x1cb \x85 ᠎​ x  y   \n\n z  ", None, None, 0),
    (9002, "x" * 3000 + " " + "=" * 2000 + "ab" * 700, None, None, 0),
    (9003, "I'll we've 1234 ½ ٣ 漢字 \U0001f600\U0001f600  don't\r\n\r\n", None, None, 0),
    (9004, "  two  spaces   and \n a  tab\t x ", None, None, 0),
]


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, text):
    ids = np.array(library.encode_ordinary(text or ""), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_ids_and_round_trip(spark, library):
    docs = cases.table(spark, cases.ODD + HARD + cases.PLAIN)
    got = byte_bpe.token_rows(docs).collect()
    plain = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got), key=repr)
    assert plain == sorted(((r["doc_id"], *wanted(library, r["text"])) for r in docs.collect()), key=repr)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if r["doc_id"] in (9003, 9004, 101):
            assert library.decode(r["ids"]) == texts[r["doc_id"]]


def test_empty(spark):
    assert byte_bpe.digest_rows(cases.empty(spark)).count() == 0


def test_heap_and_library_agree(library):
    ranks = byte_bpe.read_ranks(PATH)
    for text in ("aaaaabbbbbb", "zwischenzeitlich" * 9, "éééè" * 7):
        assert byte_bpe.heaped(text.encode(), ranks) == library.encode_ordinary(text)


def test_token_that_merges_do_not_reach(spark):
    """A word that is a token is that token, though no pair of tokens makes it."""
    from pyspark.sql import functions as F

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}
    listed = spark.createDataFrame([(0, 0, b"abab", None), (0, 1, b"xyz", None), (0, 2, b"xyzab", None)],
                                   "block long, number int, word binary, ids array<int>")
    got = {r["number"]: [x + byte_bpe.SHIFT for x in r["figure"]] for r in byte_bpe.corpus_ids(listed.where(F.lit(True)), ranks).collect()}
    assert got == {0: [256, 256], 1: [257], 2: [120, 121, 122, 256]}


def test_blocks_pack_and_unpack():
    block = word_blocks.Block(np.array([5, 9]), [None, -3], np.array([1, 0]), np.array([2, 0]), np.array([70000, 1]), 70001, 12)
    back = word_blocks.Block.load(block.dump())
    assert (back.row.tolist(), back.doc_id, back.flag.tolist()) == ([5, 9], [None, -3], [1, 0])
    assert (back.sizes.tolist(), back.numbers.tolist(), back.words, back.check) == ([2, 0], [70000, 1], 70001, 12)


def test_small_blocks_give_the_same(spark, library, monkeypatch):
    docs = cases.table(spark, cases.PLAIN)
    whole = {tuple(r) for r in byte_bpe.digest_rows(docs).collect()}
    bodies, lists = word_blocks.bodies, word_blocks.lists
    monkeypatch.setattr(word_blocks, "bodies", lambda *a, **k: bodies(*a, **k, limit=200))
    monkeypatch.setattr(word_blocks, "lists", lambda *a, **k: lists(*a, **k, limit=200))
    assert {tuple(r) for r in byte_bpe.digest_rows(docs).collect()} == whole


ROUGH = [*(r[1] or "" for r in HARD), "", " ", "x", " x", "a\nb \n c d\u2028 e\x85\n f", "don't  can't\t \tx ", *(f"w{k % 60} v{k}\n\ny" for k in range(200))]


def frames(texts, size):
    rows = pa.table({"row": range(len(texts)), "doc_id": range(len(texts)), "flag": [0] * len(texts), "text": texts})
    return iter(rows.to_batches(max_chunksize=size))


def test_pieces_are_the_matches_of_whole_texts(monkeypatch):
    words = byte_bpe.Pieces(public_tokenizers.PATTERN)
    match = regex.compile(public_tokenizers.PATTERN).findall
    for limit, keys, cut in ((10**6, 20_000, 10**6), (7, 3, 5), (300, 50, 64)):
        monkeypatch.setattr(byte_bpe, "KEYS", keys)
        monkeypatch.setattr(word_blocks, "SLICE", cut)
        found = [[listed[n].decode() for n in b.text(k)] for b, listed in word_blocks._closed(frames(ROUGH, 11), words, limit) for k in range(len(b))]
        assert found == [match(t) for t in ROUGH]


def test_blocks_do_not_depend_on_batches_and_take_four_bytes_a_word():
    words = byte_bpe.Pieces(public_tokenizers.PATTERN)
    by_size = [[(b.dump(), listed) for b, listed in word_blocks._closed(frames(ROUGH, size), words, 150)] for size in (1, 7, 500)]
    assert by_size[0] == by_size[1] == by_size[2] and len(by_size[0]) > 1
    (block, _), *_ = word_blocks._closed(frames(ROUGH, 500), words, 10**6)
    assert block.numbers.itemsize == word_blocks.Block.load(block.dump()).numbers.itemsize == 4


def test_keys_are_matched_many_at_a_time():
    words, calls = byte_bpe.Pieces(public_tokenizers.PATTERN), []
    match = words.match
    words.match = lambda text: calls.append(text) or match(text)
    assert len(words.refine([f"key{k}!" for k in range(1000)])[0]) == 1002
    assert len(calls) == 1


def test_a_pattern_without_spaces_is_matched_key_by_key():
    words = byte_bpe.Pieces(r"[a-z]+|\s")
    found = [[listed[n].decode() for n in b.text(k)] for b, listed in word_blocks._closed(frames(["ab cd", "ef"], 9), words, 99) for k in range(len(b))]
    assert found == [["ab", " ", "cd"], ["ef"]]


def test_no_description_of_the_plan_holds_the_ranks(spark):
    frame = spark.createDataFrame([(1, "so far and so good")], "doc_id long, text string")
    plan = byte_bpe.digest_rows(frame)._jdf.queryExecution().toString()
    assert len(plan) < 200_000
    merged = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "aggregate(" in line]
    assert any("ubquery" in line for line in merged), "the maps are a column of their own, held by each row"


def test_a_closed_block_holds_no_texts():
    before = pa.total_allocated_bytes()
    words = byte_bpe.Pieces(r" ?\S+|\s+")
    keys, column = words.keys(), pa.array(["some words of one text"] * 20_000)
    sizes, add = words.parts(column)
    add(0, len(column), keys)
    del add, column
    flat, _ = keys.closed()
    assert len(flat) == sizes.sum() and not keys.parts and not keys.numbers
    assert pa.total_allocated_bytes() == before
