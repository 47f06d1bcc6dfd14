"""How a second table differs from the one a model was trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.runtime import durable

SHIFT = 0.10
FINDINGS = "column_name string, finding string, value string, train_value double, other_value double"


def numeric_profile(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n, mean, std, missing of each side): both tables in one long grouping."""

    def long(df: DataFrame, side: str) -> DataFrame:
        have = [c for c in columns if c in df.columns]
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("x")) for c in have])
        return df.select(F.lit(side).alias("side"), F.inline(cells)) if have else df.select(
            F.lit(side).alias("side"), F.lit("").alias("column_name"), F.lit(0.0).alias("x")
        ).limit(0)

    every = long(train, "train").unionByName(long(other, "other"))

    def of(side: str, f, value=F.col("x")):
        return f(F.when(F.col("side") == side, value))

    return every.groupBy("column_name").agg(
        *[
            e
            for side in ("train", "other")
            for e in (
                of(side, F.count, F.lit(1)).alias(f"{side}_rows"),
                of(side, F.count).alias(f"{side}_n"),
                of(side, F.avg).alias(f"{side}_mean"),
                of(side, F.stddev_samp).alias(f"{side}_std"),
            )
        ]
    )


def category_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored (column_name, value, n) of text columns; copies collapse before the shuffle."""
    have = [c for c in columns if c in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in have])
    frame = df.select(F.inline(cells)) if have else df.select(F.lit("").alias("column_name"), F.lit("").alias("value")).limit(0)
    return durable(frame.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count("*").alias("n")), "categories")


def drift_report(train: DataFrame, other: DataFrame, numeric: Sequence[str], categories: Sequence[str], shift: float = SHIFT) -> DataFrame:
    """(column_name, finding, value, train_value, other_value), a row for each finding.

    ``new_category`` and ``lost_category`` name a value of one table only, with its rows there;
    ``mean_shift`` the two means where they differ by more than ``shift`` of the trained one (any
    difference from a mean of 0); ``missing_shift`` the shares of gaps that differ by more than
    ``shift``; ``only_train`` and ``only_other`` a column one of them lacks or has no value in.
    """
    profile = numeric_profile(train, other, numeric)
    far = F.abs(F.col("other_mean") - F.col("train_mean")) > F.lit(shift) * F.abs(F.col("train_mean"))
    gaps = {side: 1 - F.try_divide(F.col(f"{side}_n"), F.col(f"{side}_rows")) for side in ("train", "other")}

    def finding(name: str, when, a, b):
        return F.when(when, F.struct(F.lit(name).alias("finding"), F.lit(None).cast("string").alias("value"), a.cast("double").alias("train_value"), b.cast("double").alias("other_value")))

    findings = F.array(
        finding("mean_shift", far, F.col("train_mean"), F.col("other_mean")),
        finding("missing_shift", F.abs(gaps["train"] - gaps["other"]) > shift, gaps["train"], gaps["other"]),
        finding("only_train", (F.col("train_n") > 0) & (F.col("other_n") == 0), F.col("train_n"), F.col("other_n")),
        finding("only_other", (F.col("train_n") == 0) & (F.col("other_n") > 0), F.col("train_n"), F.col("other_n")),
    )
    numbers = profile.select("column_name", F.inline(F.array_compact(findings)))

    a, b = category_profile(train, categories), category_profile(other, categories)
    none = F.lit(None).cast("double")
    keys = ["column_name", "value"]
    new = b.join(a.select(*keys), keys, "left_anti").select("column_name", F.lit("new_category").alias("finding"), "value", none.alias("train_value"), F.col("n").cast("double").alias("other_value"))
    lost = a.join(b.select(*keys), keys, "left_anti").select("column_name", F.lit("lost_category").alias("finding"), "value", F.col("n").cast("double").alias("train_value"), none.alias("other_value"))
    return numbers.unionByName(new).unionByName(lost)
