"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.operators.lookup import lookup
from tierwise.runtime import durable

SEED = "mix-1"
# Rates above this are drawn as the sum of equal parts, so that exp(-rate) stays exact enough.
PART = 64.0
CHUNK = 1024
BROADCAST_SOURCES = 5000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the joined parts."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def poisson_table(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... far into the tail, for a rate of at most PART."""
    last = (F.ceil(rate + 12 * F.sqrt(rate)) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("cdf"))

    def step(a, k):
        p = a["p"] * rate / k
        c = a["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(a["cdf"], F.array(c)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["cdf"])


def rates(docs: DataFrame, source: str, weights: dict[str, float] | None, power: float, size: float | None) -> DataFrame:
    """Mean number of copies per source so that sources reach their weights.

    ``weights`` gives target shares (sources it lacks get none); without it a source of n
    documents weighs n ** power. ``size`` is the expected number of output rows, by default as
    many as come in.
    """
    counts = docs.groupBy(F.col(source).alias("mix_source")).agg(F.count("*").alias("mix_n"))
    if weights is None:
        want = counts.withColumn("mix_w", F.pow(F.col("mix_n").cast("double"), F.lit(power)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        want = counts.withColumn("mix_w", F.coalesce(table[F.col("mix_source").cast("string")], F.lit(0.0)))
    total = want.agg(F.sum("mix_w").alias("all_w"), F.sum("mix_n").alias("all_n"))
    rows = F.lit(float(size)) if size is not None else F.col("all_n").cast("double")
    rate = F.when(F.col("all_w") > 0, F.col("mix_w") / F.col("all_w") * rows / F.col("mix_n")).otherwise(F.lit(0.0))
    # ``total`` is one row; there are as many rates as sources.
    return (
        want.crossJoin(total)
        .select(F.col("mix_source").alias(source), "mix_n", rate.alias("mix_rate"))
        .withColumn("mix_parts", F.greatest(F.ceil(F.col("mix_rate") / PART), F.lit(1)).cast("int"))
        .withColumn("mix_cdf", poisson_table(F.col("mix_rate") / F.col("mix_parts")))
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: dict[str, float] | None = None,
    power: float = 0.5,
    size: float | None = None,
    seed: str = SEED,
) -> DataFrame:
    """Each document as often as its Poisson draw says, in a global random order.

    The draw inverts the Poisson distribution of the source's rate at a uniform number hashed
    from seed and doc_id, so it does not depend on partitions, retries or other documents of
    the source. Adds ``mix_copy`` (1, 2, ...) and ``mix_key`` (hex; rows are sorted by it). A null
    source is a source of its own; rows that share a doc_id (null too) draw alike; documents that
    draw zero leave. Other columns pass through, but for those named like the added ones (mix_...).
    """
    docs = docs.drop("mix_n", "mix_rate", "mix_parts", "mix_cdf", "mix_from", "mix_copy", "mix_key")
    table = durable(rates(docs, source, weights, power, size), "mix-rates")
    identity = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    drawn = F.transform(
        F.sequence(F.lit(0), F.col("mix_parts") - 1),
        lambda j: F.size(F.filter("mix_cdf", lambda c: c <= uniform(F.lit(seed), identity, j))),
    )
    drawn = F.aggregate(drawn, F.lit(0).cast("long"), lambda a, x: a + x)
    plain = [F.col(f"`{c}`") for c in docs.columns]
    # Broadcast only if there are few sources; else rows of hot sources are salted.
    counted = lookup(docs, table, source, "mix_n", spread=doc_id, broadcast_rows=BROADCAST_SOURCES).select(
        *plain, drawn.alias("mix_n")
    )
    # Two steps, so that no array of copies is long.
    chunks = counted.where(F.col("mix_n") > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("mix_n") - 1).cast("long"), F.lit(CHUNK).cast("long"))).alias("mix_from")
    )
    top = F.least(F.col("mix_from") + CHUNK, F.col("mix_n"))
    copies = chunks.select(*plain, F.explode(F.sequence(F.col("mix_from") + 1, top)).alias("mix_copy"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), identity, F.col("mix_copy").cast("string")))
    return copies.withColumn("mix_key", key).orderBy("mix_key", "mix_copy")
