"""Near duplicates by one-permutation hashing.

A text's set is its distinct word shingles. One hash of each shingle gives its bin and its value; a
bin keeps its least value, and an empty bin borrows from the first full one of its own fixed random
order (optimal densification). Bands of bins name buckets. Equal sets become one node first.

A bucket is a star: its centre, the node that shares most buckets with others and so is the least
changed of a family of copies, is a candidate for all its nodes. A byte of each bin tells, with a
stated error, which candidates cannot be near; the others are confirmed on the full sets, and links
make components. Buckets that still hold several components go on: of a few nodes all pairs are
candidates, of more those with a drawn centre, and the rest of these is banded anew by further bins,
so that nodes which only share a passage part and families stay together. This ends when no bucket
holds two nodes that have neither been compared nor are in one component.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, land, land_at, numbered, passing, slim, small_batches
from edgeledger.llm.words import WordHashes, batches, mix, shingle_set, texts_of

BANDS = 32
BAND_BINS = 6
BINS = BANDS * BAND_BINS
#: Nodes of a bucket, beyond the first stars, that are all compared with each other: a node meets at most these.
FEW = 64
#: Nodes of a bucket whose pairs are rows, one for all buckets that they share; those of more nodes are compared in a task.
AS_ROWS = 8
#: Bins that name a bucket when a mixed one is banded anew.
SPLIT_BINS = 8
#: Probability below which a near pair may be dropped by its sketches.
DROPPED = 1e-9
#: Bins that an empty bin tries, in order; beyond these it takes the first full bin.
PROBES = 1024

SKETCH = "row long, doc_id long, print binary, n long, bands array<long>, sketch binary, dense binary"


def _probes() -> np.ndarray:
    at = np.arange(BINS * PROBES, dtype=np.uint64) + np.uint64(1)
    return (mix(mix(at * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(BINS)).astype(np.int64).reshape(PROBES, BINS)


def densified(shingles: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """The least value of each bin of a sorted, non-empty set; empty bins borrow."""
    return signature(shingles, probes)[1]


def signature(shingles: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each bin of a sorted, non-empty set, as a byte (0: empty), and with empty bins borrowing."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    full, first = np.unique(bins.astype(np.int64), return_index=True)
    values, has = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[full], has[full] = shingles[first], True
    empty, step = np.flatnonzero(~has), 0
    out = values.copy()
    while len(empty) and step < PROBES:
        block = probes[step : step + 16, empty]
        found = has[block]
        hit = found.any(axis=0)
        out[empty[hit]] = values[block[found.argmax(axis=0), np.arange(len(empty))][hit]]
        empty, step = empty[~hit], step + 16
    out[empty] = values[full[0]]
    return np.where(has, _byte(values), np.uint8(0)), out


def _byte(values: np.ndarray) -> np.ndarray:
    """1 to 255."""
    return (values % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One bucket name for each band, different for different bands."""
    parts = signature.reshape(BANDS, BAND_BINS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_BINS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return out.view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``row, doc_id, print, n, bands, sketch, dense``: of an empty set no buckets and empty sketches.

    ``print`` is the set's fingerprint, ``n`` its size; ``sketch`` has a byte of each bin, ``dense`` the
    same after densification.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("print", pa.binary()), ("n", pa.int64()),
         ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()), ("dense", pa.binary())]
    )

    def run(frames):
        hashes, probes = WordHashes(), _probes()

        def of(batch):
            prints, sizes, bands, raw, dense = [], [], [], [], []
            for text in texts_of(batch, "text"):
                s = shingle_set(text, words, hashes)
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                own, borrowed = signature(s, probes) if len(s) else (np.empty(0, np.uint8), np.empty(0, np.uint64))
                bands.append(band_hashes(borrowed) if len(s) else [])
                raw.append(own.tobytes())
                dense.append(_byte(borrowed).tobytes())
            return batch.column("row"), batch.column("doc_id"), prints, sizes, bands, raw, dense

        return batches(frames, schema, of)

    return docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SKETCH)


def _near(a: Column, b: Column, percent: int) -> Column:
    """Whether two set sizes allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def least_equal(percent: int) -> np.ndarray:
    """For each number of bins that two sets fill, the least number of equal bins that near ones have.

    A bin of the union holds the least of its shingles, and by symmetry the filled bins hold a drawing
    without replacement from the union. So the equal ones among K are hypergeometric, with at least
    ``percent`` in 100 as their share, and m or fewer have a probability of at most exp(-K * KL(m/K, share)). Bytes that
    are equal by chance only add.
    """
    share, out = percent / 100, np.zeros(BINS + 1, np.int64)
    for k in range(1, BINS + 1):
        for m in range(k):
            q = m / k
            if q >= share:
                break
            apart = (1 - q) * math.log((1 - q) / (1 - share)) + (q * math.log(q / share) if q else 0.0)
            if k * apart <= -math.log(DROPPED):
                break
            out[k] = m + 1
    return out


def _sketches_allow(x: np.ndarray, y: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether two sketches don't tell their sets apart, row by row."""
    filled = ((x | y) != 0).sum(axis=1)
    return ((x == y) & (x != 0)).sum(axis=1) >= least[filled]


def alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sketches don't tell them apart."""
    least = least_equal(percent)

    def run(frames):
        for batch in frames:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                    for c in ("sketch_a", "sketch_b")
                )
                yield batch.select(["a", "b"]).filter(pa.array(_sketches_allow(x, y, least)))

    one = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    both = one.join(nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    return both.mapInArrow(run, "a long, b long")


def alike_in_groups(groups: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of each ``group`` whose components, sizes and sketches allow a link; ``group`` is a list of
    ``node, n, root, sketch``.

    Sketches come once for each member of a group, and only pairs that stay are rows.
    """
    least = least_equal(percent)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def members(sizes):
        """The places of both members of all pairs, groups of one size at a time."""
        starts, found = np.cumsum(sizes) - sizes, [(sizes[:0], sizes[:0])]
        for size in np.unique(sizes):
            one, other = np.triu_indices(size, 1)
            own = starts[sizes == size][:, None]
            found.append(((own + one).ravel(), (own + other).ravel()))
        return (np.concatenate(side) for side in zip(*found))

    def run(frames):
        def of(batch):
            group = batch.column("group")
            rows = group.flatten()
            node, n, root = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "root"))
            sketch = np.frombuffer(b"".join(rows.field("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            x, y = members(np.diff(group.offsets.to_numpy()).astype(np.int64))
            stay = (root[x] != root[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
            x, y = x[stay], y[stay]
            parts = range(0, len(x), 1 << 14)
            stay = [_sketches_allow(sketch[x[k : k + (1 << 14)]], sketch[y[k : k + (1 << 14)]], least) for k in parts]
            stay = np.concatenate([np.empty(0, bool), *stay])
            both = np.stack([node[x[stay]], node[y[stay]]])
            return tuple(np.unique(np.sort(both, axis=0), axis=1))

        return batches(frames, schema, of)

    return groups.select("group").mapInArrow(run, "a long, b long")


def mixed(places: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``bucket, node, n, root, size``: the places in buckets whose nodes are of several components."""
    root = F.col("node") if roots is None else F.coalesce("root", "node")
    held = places if roots is None else places.join(roots, "node", "left")
    held = held.select("bucket", "node", "n", root.alias("root"))
    sizes = held.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("l"), F.max("root").alias("m"))
    # Aggregates are landed before they are joined: then the join has exchanges of its own, whose hot keys can be split.
    sizes = land(sizes.where("l != m").select("bucket", "size"), "mixed")
    return land(held.join(sizes, "bucket"), "live")


def banded_anew(places: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``bucket, node, n``: each place in several buckets instead, each named by the old one and some bins.

    As many as a near pair needs to share one of them in the mean. Pairs share many buckets in the first
    place, so that few near ones part, while pairs of 0.6 share one in fifteen.
    """
    splits = math.ceil((100 / percent) ** SPLIT_BINS)
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])
    turn = np.uint64(0x9E3779B97F4A7C15)

    def run(frames):
        step = np.arange(1, splits * SPLIT_BINS + 1, dtype=np.uint64) * turn

        def of(batch):
            dense = np.frombuffer(b"".join(batch.column("dense").to_pylist()), np.uint8).reshape(-1, BINS)
            old = batch.column("bucket").to_numpy(zero_copy_only=False).view(np.uint64)
            at = mix(mix(old[:, None] + step))
            value = np.take_along_axis(dense, (at % np.uint64(BINS)).astype(np.int64), axis=1)
            value = value.reshape(-1, splits, SPLIT_BINS).astype(np.uint64)
            name = at.reshape(-1, splits, SPLIT_BINS)[:, :, 0]
            for k in range(SPLIT_BINS):
                name = mix(name * turn + value[:, :, k])
            repeat = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), splits) for c in ("node", "n")]
            return name.ravel().view(np.int64), *repeat

        return batches(frames, schema, of)

    found = places.join(nodes.select("node", "dense"), "node").select("bucket", "node", "n", "dense")
    return found.mapInArrow(run, "bucket long, node long, n long")


def _pair(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def stars(live: DataFrame, centres: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of the centre ``c`` of each bucket and its nodes of other components; the places but for the centres'."""
    met = land(live.join(centres, "bucket"), "met")
    pairs = met.where((F.col("root") != F.col("c.root")) & _near(F.col("n"), F.col("c.n"), percent))
    rest = met.where(F.col("node") != F.col("c.node")).select("bucket", "node", "n")
    return pairs.select(*_pair(F.col("node"), F.col("c.node"))), rest


def central_stars(live: DataFrame, nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs that sketches allow in stars around the nodes that share most buckets with others, and the rest of the places."""
    own = F.struct("node", "n", "root")
    central = F.sum("size").over(Window.partitionBy("node"))  # a node has a place for each band at most
    centres = live.withColumn("central", central).groupBy("bucket").agg(F.max(F.struct("central", own.alias("c")))["c"].alias("c"))
    pairs, rest = stars(live, land(centres, "centres"), percent)
    return alike(pairs.distinct(), nodes, percent), rest


def further_pairs(live: DataFrame, nodes: DataFrame, level: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs that sketches allow: all of different components in buckets of a few nodes, stars around drawn centres
    in others; and the rest of these."""
    own = F.struct("node", "n", "root")
    groups = live.where(F.col("size") <= min(AS_ROWS, FEW)).groupBy("bucket").agg(F.collect_list(own).alias("group"))
    few = groups.select("group", F.explode("group").alias("x"))
    other = lambda y: (F.col("x.root") < y["root"]) & _near(F.col("x.n"), y["n"], percent)
    few = few.select("x", F.explode(F.filter("group", other)).alias("y")).select(*_pair(F.col("x.node"), F.col("y.node")))
    more = live.where((F.col("size") > AS_ROWS) & (F.col("size") <= FEW)).join(nodes.select("node", "sketch"), "node")
    groups = more.groupBy("bucket").agg(F.collect_list(F.struct("node", "n", "root", "sketch")).alias("group"))
    many = live.where(F.col("size") > FEW)
    drawn = F.min(F.struct(F.xxhash64("node", F.lit(level)).alias("draw"), own.alias("c")))["c"]
    pairs, rest = stars(many, land(many.groupBy("bucket").agg(drawn.alias("c")), "centres"), percent)
    return alike(pairs.union(few).distinct(), nodes, percent).union(alike_in_groups(groups, percent)).distinct(), rest


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets share ``percent`` of their union. ``texts`` has ``row, text``.

    Sets hold 64-bit hashes of shingles; each pair is compared by itself. Only texts of pairs are shuffled with them.
    """
    involved = land(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "involved")
    texts = land(texts.join(involved, "row", "left_semi"), "involved-texts")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(frames):
        hashes, kept = WordHashes(), {}

        def shingles(row, text):
            if row not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[row] = shingle_set(text, words, hashes)
            return kept[row]

        def of(batch):
            left, right = [], []
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for (a, b), x, y in zip(ids, texts_of(batch, "text_a"), texts_of(batch, "text_b")):
                s, t = shingles(a, x), shingles(b, y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    left.append(a)
                    right.append(b)
            return left, right

        return batches(frames, schema, of)

    one = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    both = one.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node that each linked node reaches.

    Large and small stars in turn until nothing changes: each round moves a node's neighbours to the
    least of them. Only counts and a checksum come to the driver.
    """

    def state(edges):
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = land(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = land(least, "large-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = land(large, "large-star")
        least = land(large.groupBy("u").agg(F.min("v").alias("m")), "small-least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = land(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def linked(nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame | None:
    """``node, root`` of the nodes that links reach, if any. ``nodes`` has ``node, n, bands, sketch, dense``, ``texts`` ``row, text``.

    First all buckets are stars, then those that are still mixed are gone through twice or more, from
    the third time on banded anew. Pairs that were confirmed or refuted on full sets are not again.
    """
    spark, places = nodes.sparkSession, nodes.select("node", "n", F.explode("bands").alias("bucket"))
    roots, tested, level = None, [], 0
    while True:
        with passing(spark):
            live = mixed(places, roots)
            if level > 1 and not live.isEmpty():
                live = mixed(banded_anew(live, nodes, percent), roots)
            if live.isEmpty():
                return roots
            pairs, rest = further_pairs(live, nodes, level, percent) if level else central_stars(live, nodes, percent)
            if tested:
                pairs = pairs.join(spark.read.schema("a long, b long").parquet(*tested), ["a", "b"], "left_anti")
            tested.append(land_at(pairs, "tested", stays=True))
            pairs = spark.read.schema("a long, b long").parquet(tested[-1])
            links = None if pairs.isEmpty() else land(confirmed(pairs, texts, words, percent), "confirmed")
            if links is not None and not links.isEmpty():
                if roots is not None:
                    links = links.union(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))
                roots = land(components(links), "roots", stays=True)
            places, level = land(rest, "rest", stays=True), level + 1


def near_groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, kept, stays`` for each row of ``docs`` (``row, doc_id, text``).

    Rows whose sets share ``percent`` of their union are linked. ``component_id`` is the least doc_id
    that links reach (null only if no row reached has an id); ``kept`` is whether the row has that id, null ids never. Rows
    without words are linked with nothing. ``stays`` is true for one row of each component: the
    first in reading order of those with the least id. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with passing(spark):
        found = land(sketches(docs, words), "sketches")
        full = found.where("n > 0")
        prints = land(full.groupBy("print").agg(F.min("row").alias("node")), "prints")
        nodes = full.join(prints.select(F.col("node").alias("row")), "row")
        nodes = land(nodes.select(F.col("row").alias("node"), "n", "bands", "sketch", "dense"), "nodes")
        roots = linked(nodes, docs.select("row", "text"), words, percent)
        members = full.select("row", "doc_id", "n", "print").join(prints, "print")
        if roots is not None:
            members = members.join(roots, "node", "left").withColumn("node", F.coalesce("root", "node"))
        members = members.select("row", "doc_id", "n", F.col("node").alias("root"))
        alone = found.where("n = 0").select("row", "doc_id", "n", F.col("row").alias("root"))
        members = land(members.unionByName(alone), "members", stays=True)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
        heads = land(members.groupBy("root").agg(first.alias("head")), "heads", stays=True)
    return members.join(heads, "root").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("head.doc_id"), F.lit(False)).alias("kept"),
        (F.col("row") == F.col("head.row")).alias("stays"),
    )


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs`` as they are."""
    stored, row = numbered(docs, "documents")
    with passing(docs.sparkSession):
        kept = near_groups(slim(stored, row), words, percent).where("stays").select(F.col("row").alias(row))
        kept = land(kept, "kept", stays=True)
    return stored.join(kept, row, "left_semi").drop(row)


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The component of every document: three-word shingles, 85 in 100."""
    stored, row = numbered(documents(spark, sf_dir).select("doc_id", "text"), "documents")
    return near_groups(slim(stored, row), 3, 85).drop("row", "stays")
