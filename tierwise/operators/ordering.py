"""Global order without a global sort in one task.

Ranks, running totals, seeded samples and folds all need "how many rows come
before". Each is done in two levels: totals per slice, offsets over the short
list of slices, and a window inside each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.columns import row_hash
from tierwise.operators.lookup import lookup
from tierwise.runtime import durable

# Hex digits of the row digest that name a slice: 16**4 slices of equal size.
SLICE_DIGITS = 4


def running_totals(grouped: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """Add ``<sum>_before``: the total over smaller ``order`` values of the key.

    ``grouped`` has one row per (keys, order). It is range-partitioned and
    written once with its slice number, so the slices cannot move between the
    offset pass and the window pass.
    """
    sliced = durable(
        grouped.repartitionByRange(*[F.col(c) for c in (*keys, order)]).withColumn("__slice", F.spark_partition_id()),
        "running",
    )
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = by_key.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and slice that holds it.
    offsets = (
        sliced.groupBy(*keys, "__slice")
        .agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
        .select(*keys, "__slice", *[F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums])
    )
    inside = Window.partitionBy(*keys, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("a.__slice") == F.col("b.__slice")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    local = sliced.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__l_{c}") for c in sums])
    return local.alias("a").join(offsets.alias("b"), same).select(
        *[F.col(f"a.{c}") for c in grouped.columns],
        *[(F.col(f"a.__l_{c}") + F.col(f"b.__o_{c}")).alias(f"{c}_before") for c in sums],
    )


def percent_rank_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, percentile) per distinct value; ties share the mean rank."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    ranked = running_totals(counts, ["column"], "value", ["n"])
    totals = ranked.groupBy("column").agg(F.sum("n").alias("rows"))
    rank = F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)
    # One row per column name.
    return ranked.join(F.broadcast(totals), "column").select("column", "value", "n", (rank / F.col("rows")).alias("percentile"))


def percent_ranks(df: DataFrame, columns: Sequence[str], suffix: str = "_percentile", id_col: str | None = None) -> DataFrame:
    """Add the averaged percent rank of each column; missing stays missing."""
    ranks = durable(percent_rank_table(df, columns), "ranks")
    out = df
    for c in columns:
        mine = ranks.where(F.col("column") == c).select(
            F.col("value").alias(c), "n", F.col("percentile").alias(f"{c}{suffix}")
        )
        out = lookup(out, mine, c, weight="n", spread=id_col)
    return out


def _slice(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")


def stratified_folds(
    df: DataFrame, strata: str, id_col: str = "id", folds: int = 5, seed: int = 42, digits: int = SLICE_DIGITS
) -> DataFrame:
    """Add ``fold``: rows of each stratum, in seeded hash order, dealt out in turn.

    The digest slices are even whatever the data, also inside one huge stratum.
    """
    keyed = df.withColumn("__digest", row_hash(F.col(id_col), seed)).withColumn("__slice", _slice(F.col("__digest"), digits))
    earlier = Window.partitionBy(strata).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**digits rows per stratum.
    offsets = (
        keyed.groupBy(strata, "__slice")
        .agg(F.count("*").alias("__n"))
        .select(
            F.col(strata).alias("__stratum"),
            F.col("__slice").alias("__s"),
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
        )
    )
    inside = Window.partitionBy(strata, "__slice").orderBy("__digest", id_col)
    local = keyed.withColumn("__at", F.row_number().over(inside) - 1)
    joined = local.join(
        offsets, F.col(strata).eqNullSafe(F.col("__stratum")) & (F.col("__slice") == F.col("__s"))
    )
    fold = ((F.col("__offset") + F.col("__at")) % folds).cast("int")
    return joined.select(*[F.col(c) for c in df.columns], fold.alias("fold"))


def seeded_sample(df: DataFrame, n: int, id_col: str = "id", seed: int = 42, digits: int = SLICE_DIGITS) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer): the first in seeded hash order.

    Whole digest slices below the cut are taken by a filter; only the one slice
    the cut falls into is ranked.
    """
    digest = row_hash(F.col(id_col), seed)
    keyed = df.withColumn("__slice", _slice(digest, digits))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**digits rows reach this window.
    counts = keyed.groupBy("__slice").agg(F.count("*").alias("c"))
    placed = counts.withColumn("before", F.coalesce(F.sum("c").over(earlier), F.lit(0)))
    cut = placed.where((F.col("before") < n) & (F.col("before") + F.col("c") >= n)).first()
    if cut is None:
        return df if n > 0 else df.limit(0)
    at, left = cut["__slice"], n - cut["before"]
    edge = keyed.where(F.col("__slice") == at).withColumn(
        "__at", F.row_number().over(Window.partitionBy("__slice").orderBy(digest, id_col))
    )
    whole = keyed.where(F.col("__slice") < at)
    return whole.select(*df.columns).unionByName(edge.where(F.col("__at") <= left).select(*df.columns))


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """The k best rows by score; ties by name, so the choice is repeatable."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)


def first_rows(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    return df.orderBy(id_col).limit(n)


def fold_overlap(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Per fold: rows on each side and ids found on both.

    One grouping by id replaces a join per fold: an id overlaps fold k when it
    has rows in k and rows outside k.
    """
    per_id = df.groupBy(id_col, "fold").agg(F.count("*").alias("n"))
    spread = per_id.groupBy(id_col).agg(F.collect_set("fold").alias("in_folds"))
    shared = (
        spread.where(F.size("in_folds") > 1)
        .select(F.explode("in_folds").alias("fold"))
        .groupBy("fold")
        .agg(F.count("*").alias("overlap"))
    )
    sizes = df.groupBy("fold").agg(F.count("*").alias("valid_rows"))
    # One row per fold.
    whole = sizes.agg(F.sum("valid_rows").alias("all_rows"))
    return (
        sizes.join(F.broadcast(shared), "fold", "left")
        .join(F.broadcast(whole))
        .select(
            "fold",
            (F.col("all_rows") - F.col("valid_rows")).alias("train_rows"),
            "valid_rows",
            F.coalesce("overlap", F.lit(0)).alias("overlap"),
        )
        .withColumn("valid", (F.col("overlap") == 0).cast("int"))
    )


