"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture, and so a mean number of repetitions for each of its
documents. A document's own uniform number, from a seeded hash of its id, is put through the
inverse of the Poisson distribution with that mean; the document appears that often, 0 included.
The copies are then shuffled over all tasks by another hash. Everything is a function of the seed
and the rows, so a repeated task gives the same mixture.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, free_name, land, let

SEED = "mix-1"
#: Share of a source without a weight of its own: its share of the rows to this power.
TEMPERATURE = 0.7
HEX_DIGITS = 13


def uniform(seed: str, key: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of an MD5 of seed and key."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key))
    return (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16**HEX_DIGITS)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k from 0 to mean + 12 deviations + 24, beyond which a double has no probability left."""
    top = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    log_p = F.transform(F.sequence(F.lit(1), top), lambda k: F.log(mean) - F.log(k.cast("double")))
    return F.aggregate(
        log_p,
        F.struct((-mean).cast("double").alias("log_p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda acc, x: F.struct(
            (acc["log_p"] + x).alias("log_p"),
            F.concat(acc["cdf"], F.array(F.get(acc["cdf"], F.size(acc["cdf"]) - 1) + F.exp(acc["log_p"] + x))).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )


def source_means(docs: DataFrame, weights: Mapping[str, float] | None, temperature: float) -> DataFrame:
    """``source, mean, cdf``: the repetitions that give each source its share of as many rows as ``docs`` has.

    Without ``weights`` the shares are the sources' row shares to the power ``temperature``; with them,
    sources that they don't name, and null, get none. Shares are scaled to sum 1 over the sources present.
    """
    counted = docs.groupBy("source").agg(F.count("*").alias("rows"))
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
    weighted = land(counted.withColumn("weight", weight), "source-weights")
    sums = weighted.agg(F.sum("weight"), F.sum("rows")).first()
    scale = float(sums[1]) / float(sums[0]) if sums[0] else 0.0
    mean = F.col("weight") * scale / F.col("rows")
    return land(weighted.select("source", mean.alias("mean")).where("mean > 0"), "source-means")


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
) -> tuple[DataFrame, str]:
    """The mixture: every row of ``docs`` as often as drawn, shuffled, and the name of the copy's column.

    Rows that repeat an id are drawn alike, rows without an id if they have the same text; a null
    source is a source of its own. All other columns pass as they are. An empty table, or weights that name no source
    present, give an empty mixture.
    """
    copy = free_name(docs, "copy")
    means = source_means(docs, weights, temperature).select(
        F.col("source").alias("__source"), poisson_cdf(F.col("mean")).alias("__cdf")
    )
    drawn = docs.join(means, F.col("source").eqNullSafe(F.col("__source")))
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    u = uniform(seed, F.coalesce(F.col("doc_id").cast("string"), unnamed))
    count = let(u, lambda x: F.size(F.filter(F.col("__cdf"), lambda c: c < x)))
    copies = drawn.withColumn("__count", count).where("__count > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("__count"))).alias(copy)
    )
    place = F.xxhash64(F.lit(seed), "doc_id", copy, F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(tasks, place).sortWithinPartitions(place), copy


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    """The whole mixture, texts included."""
    return mixed(documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars"))[0]


OP8_SQL = f"""
with s as (select source, count(*) as rows, pow(count(*)::double, {TEMPERATURE}) as weight from documents group by source),
m as (select source, weight * ((select sum(rows) from s)::double / (select sum(weight) from s)) / rows as mean from s),
g as (select source, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 24)::bigint + 1)) as k from m),
c as (select source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1.0))) over (partition by source order by k) as cdf from g),
u as (select *, (('0x' || substr(md5('{SEED}:' || doc_id::varchar), 1, {HEX_DIGITS}))::bigint::double + 0.5) / {16**HEX_DIGITS}::double as u
  from documents),
n as (select any_value(u.doc_id) as doc_id, u.source, u.doc_id as id, count(*) as copies
  from u join c on u.source = c.source and c.cdf < u.u group by u.doc_id, u.source)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(1, n.copies + 1))::int as copy
from documents d join n on d.doc_id = n.id
"""
