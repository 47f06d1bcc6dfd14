"""Outlier flags and scores: quartile fences, z-scores, domain limits, counts."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions.columns import flag, total
from tierwise.operators.stats import per_column, quantiles_of
from tierwise.spec import DEFAULT, FeatureSpec

FENCE = 2.5
Z_LIMIT = 3
MIN_PRESENT = 10


def fit_outliers(df: DataFrame, spec: FeatureSpec = DEFAULT, **kw) -> dict[str, dict[str, float]]:
    """Quartiles, mean and deviation of each measure with over ten values."""
    columns = spec.present(df, spec.measures)
    stats = per_column(df, {c: F.col(c) for c in columns}, {"n": F.count, "mean": F.avg, "std": F.stddev_samp})
    kept = [c for c in columns if stats[c]["n"] > MIN_PRESENT]
    quartiles = quantiles_of(df, kept, [0.25, 0.75], **kw)
    return {
        c: {"q1": quartiles[c][0], "q3": quartiles[c][1], "mean": stats[c]["mean"], "std": stats[c]["std"]}
        for c in kept
    }


def fence_columns(name: str, s: Mapping[str, Any]) -> dict[str, Column]:
    x, width = F.col(name), s["q3"] - s["q1"]
    low, high = s["q1"] - FENCE * width, s["q3"] + FENCE * width
    beyond = F.when(x < low, F.try_divide(low - x, F.lit(width))).when(x > high, F.try_divide(x - high, F.lit(width)))
    return {
        f"{name}_statistical_outlier": flag((x < low) | (x > high)),
        f"{name}_outlier_score": beyond.otherwise(0.0),
    }


def zscore_columns(name: str, s: Mapping[str, Any]) -> dict[str, Column]:
    if not s["std"]:
        return {}
    z = F.abs((F.col(name) - F.lit(s["mean"])) / F.lit(s["std"]))
    return {f"{name}_zscore_outlier": flag(z > Z_LIMIT), f"{name}_zscore": z}


def domain_columns(df: DataFrame, spec: FeatureSpec = DEFAULT) -> dict[str, Column]:
    # Hours in a day, implausible circle size and posting rate.
    limits = [
        ("time_alone_extreme", spec.alone, lambda c: c > 24),
        ("time_alone_negative", spec.alone, lambda c: c < 0),
        ("friends_extreme", spec.friends, lambda c: c > 1000),
        ("post_frequency_extreme", spec.posts, lambda c: c > 100),
    ]
    return {name: flag(test(F.col(c))) for name, c, test in limits if c in df.columns}


def flag_outliers(df: DataFrame, fitted: Mapping[str, Mapping[str, Any]], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """All fence, z-score and domain columns, and the count over every
    ``*_outlier`` flag (those already in ``df`` too)."""
    new: dict[str, Column] = {}
    for name, s in fitted.items():
        if name in df.columns:
            new.update(fence_columns(name, s))
    for name, s in fitted.items():
        if name in df.columns:
            new.update(zscore_columns(name, s))
    out = df.withColumns({**new, **domain_columns(df, spec)})
    flags = [c for c in out.columns if c.endswith("_outlier")]
    if not flags:
        return out
    count = total([F.col(c) for c in flags])
    return out.withColumns(
        {"multiple_outlier_detected": (count >= 2).cast("int"), "total_outlier_count": count.cast("int")}
    )
