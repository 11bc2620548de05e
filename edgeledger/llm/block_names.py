"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Equal blocks get one integer: the
distinct blocks are sorted and numbered. Then each document's integers are taken in
pairs and every distinct pair gets an integer of the next level, until a document is one
integer. Two texts have the same level and integer exactly if they are equal; no step
relies on a hash being free of collisions.

Texts travel once, as distinct blocks combined in each task before the shuffle. A block's
occurrences refer to it by a 64-bit hash; the few hashes that stand for several blocks
are looked up by the block itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, land, let, lower_ascii, numbered, passing, slim

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    """The fixed-size blocks of a binary column; an empty text has one empty block."""
    count = F.greatest(F.ceil(F.octet_length(text) / size), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(text, i * size + 1, F.lit(size)))


def _number(distinct: DataFrame, *order: str) -> DataFrame:
    """Integers by place in the sorted partitions; sorting makes a repeated task give the same ones."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _mark(block: Column, bits: int) -> Column:
    """The hash by which occurrences refer to a block."""
    return F.shiftrightunsigned(F.xxhash64(block), 64 - bits)


def _block_names(texts: DataFrame, marks: DataFrame, size: int, bits: int) -> DataFrame:
    """``row, n, pos, name``: the integer of each block of each text."""
    places = marks.select("row", F.size("marks").alias("n"), F.posexplode("marks").alias("pos", "mark"))
    blocks = texts.select("row", F.posexplode(let(F.col("bytes"), lambda b: _blocks(b, size))).alias("pos", "block"))
    distinct = blocks.select("block").distinct().withColumn("mark", _mark(F.col("block"), bits))
    names = land(_number(distinct, "mark", "block").select("mark", "name"), "names")
    by_mark = land(names.groupBy("mark").agg(F.min("name").alias("name"), F.count("*").alias("blocks")), "by-mark")
    found = places.join(by_mark.select("mark", "name"), "mark").drop("mark")

    shared = by_mark.where("blocks > 1").select("mark")
    if shared.isEmpty():
        return land(found, "level-0")
    # Blocks that share a mark: the names of the mark, in order, go to its blocks, in order.
    order = Window.partitionBy("mark")
    contested = blocks.withColumn("mark", _mark(F.col("block"), bits)).join(shared, "mark")
    ranked = contested.select("mark", "block").distinct().withColumn("k", F.row_number().over(order.orderBy("block")))
    given = names.join(shared, "mark").withColumn("k", F.row_number().over(order.orderBy("name")))
    own = ranked.join(given, ["mark", "k"]).select("mark", "block", F.col("name").alias("own"))
    right = contested.join(own, ["mark", "block"]).select("row", "pos", "own")
    mended = found.join(right, ["row", "pos"], "left")
    return land(mended.select("row", "n", "pos", F.coalesce("own", "name").alias("name")), "level-0")


def identities(texts: DataFrame, marks: DataFrame, size: int, bits: int) -> DataFrame:
    """``row, level, name`` of each row of ``texts`` (``row, bytes``): equal exactly if the bytes are."""
    current = _block_names(texts, marks, size, bits)
    longest = current.agg(F.max("n")).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(current.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        half = [F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in (0, 1)]
        pairs = land(
            current.where("n > 1")
            .groupBy("row", F.expr("(n + 1) div 2").cast("int").alias("n"), F.expr("pos div 2").cast("int").alias("pos"))
            .agg(half[0].alias("a"), F.coalesce(half[1], F.lit(-1)).alias("b")),
            "pairs",
        )
        names = land(_number(pairs.select("a", "b").distinct(), "a", "b"), "pair-names")
        longest, level = (longest + 1) // 2, level + 1
        current = pairs.join(names, ["a", "b"]).select("row", "n", "pos", "name")
    frame = done[0]
    for more in done[1:]:
        frame = frame.unionByName(more)
    return frame


def exact_groups(docs: DataFrame, size: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """One row for each row of ``docs``, dropped ones too.

    ``row, doc_id, keep_id, group_size, kept, text_sha256``. Texts are equal when they are after
    A-Z are put in lower case; null counts as empty. The row with the largest doc_id stays (null is
    least); of rows that repeat an id, the last in reading order. ``docs`` has ``row, doc_id, text``.
    An empty table gives an empty table. Other columns are not looked at. ``bits`` is the width of
    the hash that refers to blocks; tests narrow it so that blocks share one.
    """
    texts = docs.select("row", lower_ascii(F.col("text")).cast("binary").alias("bytes"))
    about = let(
        lower_ascii(F.col("text")).cast("binary"),
        lambda b: F.struct(
            F.sha2(b, 256).alias("sha"), F.transform(_blocks(b, size), lambda x: _mark(x, bits)).alias("marks")
        ),
    )
    marks = land(
        docs.select("row", "doc_id", about.alias("about")).select("row", "doc_id", "about.sha", "about.marks"), "marks"
    )
    ids = marks.select("row", "doc_id", F.col("sha").alias("text_sha256"))
    named = land(ids.join(identities(texts, marks, size, bits), "row"), "identities")
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size")
    )
    groups = land(groups, "groups")  # so that the join has exchanges of its own, whose hot keys can be split
    return named.join(groups, ["level", "name"]).select(
        "row", "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are, whatever these are called."""
    stored, row = numbered(docs, "documents")
    with passing(docs.sparkSession):
        kept = exact_groups(slim(stored, row)).where("kept").select(F.col("row").alias(row))
        kept = land(kept, "kept", stays=True)
    return stored.join(kept, row, "left_semi").drop(row)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    stored, row = numbered(documents(spark, sf_dir).select("doc_id", "text"), "documents")
    return exact_groups(slim(stored, row)).drop("row")


OP9_SQL = """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') txt
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(txt) as text_sha256
from t window w as (partition by txt)
"""
