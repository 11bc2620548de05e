"""Lookups of address numbers in tables of ranges, by one sorted pass.

Ranges are first cut into pieces that don't overlap. Pieces and addresses of a /16 cell are then put in one
order, and each address takes the last piece that starts at or before it. A row is handled once, however many
ranges lie in a cell: there is no join of addresses with ranges, and a cell holds at most 65,536 starts. Numbers
are those of the 2^32 addresses; parts of ranges beyond them hold nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.net import grid_cell

CELL_BITS, BLOCK_BITS, ADDRESS_BITS = 16, 8, 32
ADDRESSES = 1 << ADDRESS_BITS


def _cell(number: Column) -> Column:
    return grid_cell(number, CELL_BITS)


def _first_of(cell: Column) -> Column:
    return F.shiftleft(cell.cast("long"), ADDRESS_BITS - CELL_BITS)


def with_next(starts: DataFrame) -> DataFrame:
    """Adds ``_next``, the start after each ``lo``; the starts are distinct, and the last one has NULL.

    Starts are ordered inside cells, the first starts of cells inside /8 blocks, and the 256 first starts of
    blocks reach earlier blocks by a minimum: no step orders more than 65,536 rows in one place.
    """
    celled = starts.withColumn("_cell", _cell(F.col("lo")))
    inside = celled.withColumn("_in_cell", F.lead("lo").over(Window.partitionBy("_cell").orderBy("lo")))
    block = grid_cell(_first_of(F.col("_cell")), BLOCK_BITS)
    cells = celled.groupBy("_cell").agg(F.min("lo").alias("_first")).withColumn("_block", block)
    blocks = cells.groupBy("_block").agg(F.min("_first").alias("_first")).where("_block > 0")
    earlier = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("_block") - 1)).alias("_block"), "_first")
    after_block = earlier.groupBy("_block").agg(F.min("_first").alias("_in_later"))
    in_block = F.lead("_first").over(Window.partitionBy("_block").orderBy("_cell"))
    after_cell = cells.withColumn("_in_block", in_block).join(after_block, "_block", "left")
    after_cell = after_cell.select("_cell", F.coalesce("_in_block", "_in_later").alias("_after_cell"))
    joined = inside.join(after_cell, "_cell")
    return joined.withColumn("_next", F.coalesce("_in_cell", "_after_cell")).drop("_cell", "_in_cell", "_after_cell")


def _clipped(ranges: DataFrame, last: Column) -> DataFrame:
    """``lo`` and ``last`` (the last number that belongs to a range) within the addresses."""
    bounds = {"lo": F.greatest("lo", F.lit(0)).cast("long"), "_last": F.least(last, F.lit(ADDRESSES - 1)).cast("long")}
    return ranges.withColumns(bounds).where("lo <= _last")


def disjoint(ranges: DataFrame) -> DataFrame:
    """Closed ranges cut so that none overlap: a range ends where the next one starts.

    So an address is in the last range that starts at or before it, if that one
    reaches it, and in no other. Of ranges with one start the longest stays, then the
    least by its other columns.
    """
    others = [c for c in ranges.columns if c not in ("lo", "hi")]
    order = F.struct((-F.col("_last")).alias("_far"), "_last", *others)
    one = _clipped(ranges, F.col("hi")).groupBy("lo").agg(F.min(order).alias("_range"))
    end = F.least(F.col("_range._last"), F.col("_next") - 1)
    return with_next(one).select("lo", end.alias("hi"), *[f"_range.{c}" for c in others])


def last_covers(ranges: DataFrame) -> DataFrame:
    """``lo, hi, app``: half-open ranges ``position, lo, hi, app`` cut so that none overlap, the last one winning.

    Each range is taken apart into at most 62 blocks whose size and place are powers of two, and of each block the
    last range stays. Between two neighbouring ends of ranges nothing changes, so one number there, its beginning,
    is asked for: it lies in one block of each size, and of these the last range holds. Rows grow with the
    ranges alone, however many of them overlap and however wide they are. Of ranges with one position the
    greatest name wins.
    """
    spans = _clipped(ranges.select("position", "lo", "hi", "app"), F.col("hi") - 1).withColumn("hi", F.col("_last") + 1)
    height = F.explode(F.sequence(F.lit(0), F.lit(ADDRESS_BITS))).alias("_height")
    size = F.expr("shiftleft(1L, _height)")
    first, end = F.expr("shiftright(lo + shiftleft(1L, _height) - 1, _height)"), F.expr("shiftright(hi, _height)")
    levels = spans.select("*", height).select("*", first.alias("_first"), end.alias("_end")).where("_first < _end")
    odd = lambda c: F.col(c) % 2 == 1
    sides = F.array(F.when(odd("_first"), F.col("_first")), F.when(odd("_end"), F.col("_end") - 1))
    blocks = levels.select("_height", F.explode(F.array_compact(sides)).alias("_block"), F.struct("position", "app").alias("_range"))
    best = blocks.groupBy("_height", "_block").agg(F.max("_range").alias("_range"))

    points = spans.select(F.explode(F.array("lo", "hi")).alias("lo")).where(F.col("lo") < ADDRESSES).distinct()
    asked = points.select("lo", height).select("*", (F.col("lo") / size).cast("long").alias("_block"))
    held = asked.join(best, ["_height", "_block"], "left").groupBy("lo").agg(F.max("_range").alias("_range"))
    pieces = with_next(held).where("_range is not null")
    return pieces.select("lo", F.coalesce(F.col("_next") - 1, F.lit(ADDRESSES - 1)).alias("hi"), "_range.app")


def on_grid(pieces: DataFrame) -> DataFrame:
    """One row per piece and cell that it touches, in ``_cell``; disjoint pieces grow by at most 65,536 rows."""
    cells = F.sequence(_cell(F.col("lo")), _cell(F.col("hi")))
    return pieces.where("lo <= hi").withColumn("_cell", F.explode(cells))


def as_of(rows: DataFrame, key: str, pieces: DataFrame, salts: int = 1) -> DataFrame:
    """Left join of ``rows`` with the piece that holds the number ``key``; adds the pieces' other columns.

    ``pieces`` don't overlap. Rows of a cell meet in one task, so give counts per address rather than single events;
    ``salts`` deals them to so many tasks, each with the pieces of the cell.
    """
    values = [c for c in pieces.columns if c not in ("lo", "hi")]
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    asked = rows.withColumns({"_cell": _cell(F.col(key)), "_at": F.col(key), "_asked": F.lit(True), "_salt": salt})
    held = on_grid(pieces).select(
        "_cell", F.greatest("lo", _first_of(F.col("_cell"))).alias("_at"), F.lit(False).alias("_asked"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt") if salts > 1 else F.lit(0).alias("_salt"),
        F.struct("hi", *values).alias("_piece"),
    )
    order = Window.partitionBy("_cell", "_salt").orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = asked.unionByName(held, allowMissingColumns=True).withColumn("_piece", F.last("_piece", ignorenulls=True).over(order))
    reaches = F.col("_piece.hi") >= F.col("_at")
    return ordered.where("_asked").select(*rows.columns, *[F.when(reaches, F.col(f"_piece.{v}")).alias(v) for v in values])
