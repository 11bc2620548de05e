"""Hard negatives by bounds along a spanning tree of anchors.

Anchors are dealt to trees of a bounded size, with their label where the label has enough of them. A tree is a
minimum spanning tree: each anchor but the root hangs from a near one, its parent. A candidate's score at a
child differs from its score at the parent by at most the length of the edge times the candidate's norm, so
bounds at the parent, widened by that product, hold at the child. Only candidates whose bounds overlap a window
that matters are scored again; the others hand wider bounds on to the next children. Bounds are rounded outwards,
and scores are whole numbers, so that pruning never changes a result.

Two passes go over all rows: one finds each anchor's first rows of its own label (its positives, which set the
windows), one the first rows of other labels in each window. In a pass, groups of rows meet groups of trees (a
stated set of queries against all rows, in blocks); each pair offers a few rows for an anchor, of which the first
of all are taken. No table of anchors or rows passes through the driver or a single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeledger.llm.common import land, land_for

ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10
SCALE = 256
#: Largest whole-number component, so that a 64-bit score can't overflow with up to 2048 of them.
LARGEST = 1 << 26
POSITIVES, NEGATIVES = 5, 3
#: The window of a positive: from 50 to 95 hundredths of its score.
LOWEST, HIGHEST = 50, 95
#: Anchors of a tree, of a group of trees, and rows of a group of rows, on average.
TREE_ANCHORS, GROUP_ANCHORS, GROUP_ROWS = 256, 8192, 4096

OFFERS = "anchor_id long, positive_id long, positive_score long, id long, score long"
_OFFERS = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score", "id", "score")])
_TREE = pa.schema([
    ("tree", pa.string()), ("place", pa.int32()), ("parent", pa.int32()), ("edge", pa.float64()),
    ("anchor_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int32())),
])
TREE_SQL = "tree string, place int, parent int, edge double, anchor_id long, label long, vector array<int>"


def vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, components as whole numbers.

    Rows with a null id, label, vector or component, or a component that is not finite or too large for a
    64-bit score (2^18 and more), take no part. Rows that repeat an id count as one: the least label, then vector.
    """
    x = lambda c: F.floor(c.cast("double") * SCALE)
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST / SCALE)
    shifted = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label").cast("long"))
    valid = embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.forall("embedding", usable), F.lit(False))
    ).select(F.col("vec_id").cast("long").alias("vec_id"), shifted.alias("label"), F.transform("embedding", lambda c: x(c).cast("int")).alias("vector"))
    least = F.min(F.struct("label", "vector")).alias("least")
    return valid.groupBy("vec_id").agg(least).select("vec_id", "least.label", "least.vector")


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` whole numbers; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(column.chunks or [pa.array([], column.type)])
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def width_of(*columns: pa.ChunkedArray) -> int:
    return max([1, *(int(n) for c in columns for k in c.chunks for n in k.value_lengths().to_pylist())])


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point holds them while they are below 2^53."""
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(vector).max(initial=0)) * rows.shape[1]
    if top < 2**53:
        return (rows.astype(float) @ vector.astype(float)).astype(np.int64)
    return (rows * vector).sum(axis=1)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent (as a place in the order, -1 for the root) and edge length of a minimum spanning tree."""
    n, p = len(points), points.astype(float)
    order, parent, edge = np.zeros(n, int), np.full(n, -1), np.zeros(n)
    near, via = np.full(n, np.inf), np.zeros(n, int)
    out = np.ones(n, bool)
    out[0] = False
    for k in range(1, n):
        at = order[k - 1]
        far = np.sqrt(((p - p[at]) ** 2).sum(axis=1))
        closer = far < near
        near, via = np.where(closer, far, near), np.where(closer, k - 1, via)
        order[k] = np.argmin(np.where(out, near, np.inf))
        parent[k], edge[k] = via[order[k]], near[order[k]]
        out[order[k]] = False
    return order, parent, edge


def trees(anchors: DataFrame) -> DataFrame:
    """``tree, place, parent, edge`` and the anchor, parents before children; trees of about ``TREE_ANCHORS`` anchors."""
    sizes = land(anchors.groupBy("label").agg(F.count("*").alias("anchors")), "labels")
    dealt = anchors.join(sizes, "label")
    # Labels with few anchors share trees, those with many are split; equal vectors are dealt as any others.
    pieces = F.greatest(F.ceil(F.col("anchors") / TREE_ANCHORS), F.lit(1))
    own = F.concat_ws(":", "label", F.pmod(F.xxhash64("vec_id"), pieces))
    shared_by = max(1, -(-(anchors.where("vec_id is not null").count()) // TREE_ANCHORS))
    tree = F.when(F.col("anchors") * 2 >= TREE_ANCHORS, own).otherwise(F.concat(F.lit("few:"), F.pmod(F.xxhash64("label", F.lit(1)), F.lit(shared_by))))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        order, parent, edge = spanning_tree(matrix(table["vector"], width_of(table["vector"])))
        picked = table.take(pa.array(order))
        columns = [picked["tree"], np.arange(len(order), dtype=np.int32), parent.astype(np.int32), edge, picked["vec_id"], picked["label"], picked["vector"]]
        return pa.Table.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_TREE)

    return dealt.select("vec_id", "label", "vector", tree.alias("tree")).groupBy("tree").applyInArrow(run, TREE_SQL)


class Bounds:
    """Scores of a group's rows at the anchors of one tree: exact where taken, else bounds through the parent."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, parent: np.ndarray, edge: np.ndarray):
        self.rows, self.anchors, self.parent, self.edge = rows, anchors, parent, edge
        norm = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
        self.norm = norm * (1 + 1e-9) + 1e-6
        self.low: list[np.ndarray | None] = []
        self.high: list[np.ndarray | None] = []
        self.scored = 0
        self.last_child = {int(p): k for k, p in enumerate(parent)}

    def at(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds at anchor ``k``, whose earlier anchors are done; the root is scored."""
        if self.parent[k] < 0:
            self.scored += len(self.rows)
            low = high = products(self.rows, self.anchors[k]).astype(float)
            # floats of scores beyond 2^53 are rounded: leave room for that
            slack = np.abs(low) * 2**-50
            return low - slack, high + slack
        p = int(self.parent[k])
        reach = np.ceil((self.edge[k] * (1 + 1e-9) + 1e-6) * self.norm)
        low, high = self.low[p] - reach, self.high[p] + reach
        if self.last_child[p] == k:
            self.low[p] = self.high[p] = None
        return low, high

    def score(self, k: int, chosen: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen rows, which become their bounds."""
        found = products(self.rows[chosen], self.anchors[k])
        self.scored += len(chosen)
        slack = np.abs(found.astype(float)) * 2**-50
        low[chosen], high[chosen] = found - slack, found + slack
        return found

    def done(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low.append(low)
        self.high.append(high)


def first(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first rows by score downwards, then id upwards."""
    if len(scores) > 4 * count:  # all that reach the count-th score, ties too
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:count]]
    return np.lexsort((ids, -scores))[:count]


def _kth_highest(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _chosen(table: pa.Table) -> list[tuple]:
    """Trees of a group: their anchors' columns, in order of place."""
    table = table.sort_by([("tree", "ascending"), ("place", "ascending")])
    names = table["tree"].combine_chunks().to_pylist()
    edges = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]] + [len(names)]
    return [table.slice(a, b - a) for a, b in zip(edges, edges[1:])]


def positives_in(rows: pa.Table, anchors: pa.Table, count: int) -> Iterator[tuple]:
    """For each anchor the first ``count`` of the rows with its label, itself apart: ``anchor, id, score``."""
    ids, labels = (rows[c].to_numpy() for c in ("vec_id", "label"))
    width = width_of(rows["vector"], anchors["vector"])
    x = matrix(rows["vector"], width)
    for tree in _chosen(anchors):
        a = matrix(tree["vector"], width)
        bounds = Bounds(x, a, tree["parent"].to_numpy(), tree["edge"].to_numpy())
        for k, (anchor, label) in enumerate(zip(tree["anchor_id"].to_pylist(), tree["label"].to_pylist())):
            low, high = bounds.at(k)
            own = np.flatnonzero((labels == label) & (ids != anchor))
            own = own[high[own] >= _kth_highest(low[own], count)]
            scores = bounds.score(k, own, low, high)
            bounds.done(low, high)
            for i in first(scores, ids[own], count):
                yield anchor, int(ids[own[i]]), int(scores[i])


def negatives_in(rows: pa.Table, anchors: pa.Table, count: int) -> Iterator[tuple]:
    """For each anchor and positive the first ``count`` rows of other labels in its window.

    ``anchor, positive, positive's score, id, score``. ``anchors`` has ``positives``, id and score of each.
    """
    ids, labels = (rows[c].to_numpy() for c in ("vec_id", "label"))
    width = width_of(rows["vector"], anchors["vector"])
    x = matrix(rows["vector"], width)
    for tree in _chosen(anchors):
        a = matrix(tree["vector"], width)
        bounds = Bounds(x, a, tree["parent"].to_numpy(), tree["edge"].to_numpy())
        for k, (anchor, label, own) in enumerate(zip(*(tree[c].to_pylist() for c in ("anchor_id", "label", "positives")))):
            low, high = bounds.at(k)
            other = np.flatnonzero(labels != label)
            windows = [(p["id"], p["score"], -(-LOWEST * p["score"] // 100), HIGHEST * p["score"] // 100) for p in own or []]
            need = np.zeros(len(other), bool)
            for _, _, least, most in windows:
                inside = (low[other] >= least) & (high[other] <= most)
                enough = max(float(least), _kth_highest(low[other][inside], count))
                need |= (high[other] >= enough) & (low[other] <= most)
            picked = other[need]
            scores = bounds.score(k, picked, low, high)
            bounds.done(low, high)
            for positive, worth, least, most in windows:
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                for i in inside[first(scores[inside], ids[picked[inside]], count)]:
                    yield anchor, positive, worth, int(ids[picked[i]]), int(scores[i])


def _met(rows: DataFrame, forest: DataFrame, groups: int, waves: int, offers) -> DataFrame:
    """What ``offers`` yields for every group of rows and group of trees."""
    group = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(groups)).cast("int")
    wave = F.pmod(F.xxhash64("tree"), F.lit(waves)).cast("int")
    left = rows.select("*", group.alias("rows_of"), F.explode(F.sequence(F.lit(0), F.lit(waves - 1))).alias("trees_of"))
    right = forest.select("*", wave.alias("trees_of"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("rows_of"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _OFFERS.empty_table()
        found = list(zip(*offers(left, right))) or [[]] * len(_OFFERS)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], schema=_OFFERS)

    keys = ["rows_of", "trees_of"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, OFFERS)


def _ranked(offers: DataFrame, *keys: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return offers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(embeddings: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``embeddings`` (``vec_id, embedding, label``).

    Which rows take part is said at ``vectors``; ids divisible by ``every`` are anchors. Vectors of unequal length
    are compared as if the shorter ended in zeros. Ties go to the smaller id. Anchors without another row of
    their label, and positives without a row in their window, give no rows, nor does an empty table. Further
    columns, whatever their names, are not looked at.
    """
    spark = embeddings.sparkSession
    rows, again = land_for(vectors(embeddings), "vectors", 2)
    total, queries = rows.count(), again.where(F.col("vec_id") % every == 0)
    forest, same = land_for(trees(queries), "trees", 2)
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_ROWS))
    waves = max(1, -(-forest.count() // GROUP_ANCHORS))

    def near(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
        return ((anchor, None, None, i, s) for anchor, i, s in positives_in(left, right, positives))

    def hard(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
        return negatives_in(left, right, negatives)

    best = _ranked(_met(rows, forest, groups, waves, near), "anchor_id", count=positives)
    windows = best.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    known = land(same.join(land(windows, "windows"), "anchor_id", "left"), "windows-of-trees")
    found = _ranked(_met(again, known, groups, waves, hard), "anchor_id", "positive_id", count=negatives)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select * from v where vec_id % 50 = 0),
s as (select a.vec_id as anchor_id, v.vec_id as id, a.label = v.label as same, list_inner_product(a.v, v.v)::bigint as score
  from a join v on a.vec_id <> v.vec_id),
p as (select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, positive_id, (row_number() over w)::int as rank, id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same
where 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, id)
qualify row_number() over w <= 3
"""
