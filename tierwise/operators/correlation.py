"""Correlations of all pairs of many columns from one blocked cross-moment table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.operators.stats import per_column
from tierwise.runtime import durable

# Columns in a tile, and tile pairs whose sums a task holds at once (six numbers for each cell).
TILE = 64
PAIRS = 64
ROWS = 4096
HIGH = 0.95


def _tile_sums(df: DataFrame, tiles: Sequence[range], pairs: Sequence[tuple[int, int]], centres: np.ndarray) -> DataFrame:
    """(left, right, n, x, y, xx, yy, xy) of each task: sums over rows that have both columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {p: np.zeros((6, len(tiles[p[0]]), len(tiles[p[1]]))) for p in pairs}
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                rows = [c.slice(a, ROWS).to_numpy(zero_copy_only=False) for c in batch.columns]
                values = np.stack([np.asarray(c, float) for c in rows], 1) - centres
                there = np.isfinite(values).astype(float)
                values = np.where(there > 0, values, 0.0)
                squares = values * values
                for (i, j), held in sums.items():
                    li, lj = slice(tiles[i].start, tiles[i].stop), slice(tiles[j].start, tiles[j].stop)
                    held[0] += there[:, li].T @ there[:, lj]
                    held[1] += values[:, li].T @ there[:, lj]
                    held[2] += there[:, li].T @ values[:, lj]
                    held[3] += squares[:, li].T @ there[:, lj]
                    held[4] += there[:, li].T @ squares[:, lj]
                    held[5] += values[:, li].T @ values[:, lj]
        for (i, j), held in sums.items():
            left, right = np.meshgrid(np.array(tiles[i]), np.array(tiles[j]), indexing="ij")
            keep = (left < right) & (held[0] > 0)
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left[keep], pa.int32()), pa.array(right[keep], pa.int32()), *[pa.array(h[keep]) for h in held]],
                    ["left", "right", "n", "x", "y", "xx", "yy", "xy"],
                )

    numbers = ", ".join(f"{c} double" for c in ("n", "x", "y", "xx", "yy", "xy"))
    return df.mapInArrow(run, f"left int, right int, {numbers}")


def correlations(df: DataFrame, columns: Sequence[str], tile: int = TILE, pairs: int = PAIRS) -> DataFrame:
    """(left, right, pairs, r) of every two ``columns`` in their order, over rows that have both.

    Values are taken relative to the column's mean, so large offsets cost no digits. A task adds
    up matrix products over tiles of columns and hands on one row for each pair; a few thousand
    columns take several passes, so what a task holds does not grow with them. A pair of which a
    column does not vary, or that has fewer than two common rows, has no r.
    """
    names = list(columns)
    ready = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    finite = {i: F.when(F.abs(F.col(f"x{i}")) < float("inf"), F.col(f"x{i}")) for i in range(len(names))}
    means = per_column(ready, finite, {"mean": F.avg}) if names else {}
    centres = np.array([means[i]["mean"] or 0.0 for i in range(len(names))])
    tiles = [range(a, min(a + tile, len(names))) for a in range(0, len(names), tile)]
    wanted = [(i, j) for i in range(len(tiles)) for j in range(i, len(tiles))]
    parts = [_tile_sums(ready, tiles, wanted[a : a + pairs], centres) for a in range(0, len(wanted), pairs)]
    spark = df.sparkSession
    if not parts:
        return spark.createDataFrame([], "left string, right string, pairs bigint, r double")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    sums = every.groupBy("left", "right").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.col("n")
    both = F.col("xy") - F.col("x") * F.col("y") / n
    left, right = F.col("xx") - F.col("x") * F.col("x") / n, F.col("yy") - F.col("y") * F.col("y") / n
    # What rounding leaves of a column that does not vary is no spread.
    varies = (left > F.col("xx") * 1e-14) & (right > F.col("yy") * 1e-14) & (n > 1)
    r = F.when(varies, F.greatest(F.least(both / F.sqrt(left * right), F.lit(1.0)), F.lit(-1.0)))
    # One row per column name.
    labels = F.lit(names)
    return sums.select(F.get(labels, F.col("left")).alias("left"), F.get(labels, F.col("right")).alias("right"), n.cast("long").alias("pairs"), r.alias("r"))


def correlated_pairs(df: DataFrame, columns: Sequence[str], limit: float = HIGH, **kw) -> DataFrame:
    """The pairs with |r| above ``limit``."""
    return correlations(df, columns, **kw).where(F.abs(F.col("r")) > limit)


def redundant_columns(df: DataFrame, columns: Sequence[str], limit: float = HIGH, **kw) -> list[str]:
    """Columns to leave out so that no pair above ``limit`` stays: each that follows a kept one.

    Decided in the order of ``columns`` on the driver, which sees a row for each high pair.
    """
    high: dict[str, set[str]] = {}
    for r in durable(correlated_pairs(df, columns, limit, **kw), "high-pairs").toLocalIterator():
        high.setdefault(r["right"], set()).add(r["left"])
    gone: set[str] = set()
    for c in columns:
        if any(other not in gone for other in high.get(c, ())):
            gone.add(c)
    return [c for c in columns if c in gone]
