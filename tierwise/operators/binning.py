"""Quantile bins, robust scaling and rare categories: learned once, applied row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.columns import clip
from tierwise.functions.ordered import entries_at_most
from tierwise.operators.lookup import lookup
from tierwise.operators.stats import quantiles_of
from tierwise.runtime import durable

BINS = 10
GAP = -1
RARE = "__rare__"


def fit_bins(df: DataFrame, columns: Sequence[str], bins: int = BINS, **kw) -> dict[str, list[float]]:
    """Ascending inner edges of each column at its quantiles 1/bins, 2/bins, ...

    Equal edges are merged, so a heavily tied column has fewer bins; one without values has none.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    found = quantiles_of(df, columns, [i / bins for i in range(1, bins)], **kw) if bins > 1 else {c: [] for c in columns}
    return {c: sorted({e for e in found[c] if e is not None}) for c in columns}


def bin_columns(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_bin") -> DataFrame:
    """``df`` with ``<name>_bin``: 0 up to the first edge, one more beyond each edge.

    A value on an edge belongs to the bin below it. The infinities fall into the outer bins, a gap
    is -1. One projection, so it also runs on a stream.
    """
    new = {}
    for c, held in edges.items():
        if c in df.columns:
            x = F.col(c).cast("double")
            at = entries_at_most(F.lit([float(e) for e in held]), x, len(held), below=True) if held else F.when(x.isNotNull(), F.lit(0))
            new[f"{c}{suffix}"] = F.coalesce(at, F.lit(GAP)).cast("int")
    return df.withColumns(new) if new else df


def fit_robust(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, list[float]]:
    """(median, distance of the quartiles) of each column; one whose quartiles coincide is left out."""
    found = quantiles_of(df, columns, [0.25, 0.5, 0.75], **kw)
    return {c: [q[1], q[2] - q[0]] for c, q in found.items() if None not in q and q[2] > q[0]}


def robust_scale(df: DataFrame, fitted: Mapping[str, Sequence[float]], limit: float | None = None, suffix: str = "_robust") -> DataFrame:
    """``df`` with (x - median) / quartile distance, within +-``limit`` if one is given."""
    new = {}
    for c, (middle, width) in fitted.items():
        if c in df.columns:
            value = (F.col(c).cast("double") - F.lit(middle)) / F.lit(width)
            new[f"{c}{suffix}"] = clip(value, -limit, limit) if limit is not None else value
    return df.withColumns(new) if new else df


def fit_frequent(df: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """Stored (column, value, n): the values of at least ``least`` rows. Counted in one grouping for
    all columns; very common values collapse before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    return durable(counts.where(F.col("n") >= least), "frequent-values")


def group_rare(df: DataFrame, frequent: DataFrame, columns: Sequence[str], other: str = RARE, suffix: str = "_grouped", id_col: str | None = None, **kw: Any) -> DataFrame:
    """``df`` with ``<name>_grouped``: the value where it is frequent, else ``other``, also for
    values the table never had. Missing stays missing.

    The table of frequent values is broadcast within a bound; beyond it, hot values are spread.
    """
    out = df
    for c in columns:
        mine = frequent.where(F.col("column") == c).select(F.col("value").alias("__value"), "n", F.lit(True).alias("__known"))
        out = lookup(out.withColumn("__value", F.col(c).cast("string")), mine, "__value", weight="n", spread=id_col, **kw)
        grouped = F.when(F.col("__value").isNull(), None).when(F.col("__known"), F.col("__value")).otherwise(F.lit(other))
        out = out.withColumn(f"{c}{suffix}", grouped).drop("__value", "__known")
    return out
