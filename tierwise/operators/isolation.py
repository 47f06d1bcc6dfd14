"""Isolation forest: scores how quickly random splits separate a row."""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.columns import row_hash
from tierwise.operators.ordering import seeded_sample
from tierwise.operators.stats import quantiles, quantiles_of
from tierwise.runtime import durable
from tierwise.spec import DEFAULT, FeatureSpec

TREES = 100
ROWS_PER_TREE = 256
CONTAMINATION = 0.05
NODE_SCHEMA = "tree int, node int, feature int, cut double, low int, high int, depth double"


def _expected_depth(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(x: np.ndarray, seed: list[int]) -> list[tuple[int, int, float, int, int, float]]:
    """(node, feature, cut, low, high, depth) rows; feature -1 marks a leaf."""
    rng = np.random.default_rng(seed)
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[Any] = [None]
    work = [(0, x, 0)]
    while work:
        at, rows, depth = work.pop()
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes[at] = (at, -1, 0.0, at, at, depth + _expected_depth(len(rows)))
            continue
        feature = int(rng.choice(spread))
        column = rows[:, feature]
        cut = float(rng.uniform(column.min(), column.max()))
        low, high = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (at, feature, cut, low, high, 0.0)
        work += [(low, rows[column <= cut], depth + 1), (high, rows[column > cut], depth + 1)]
    return nodes


def fit_forest(
    df: DataFrame,
    spec: FeatureSpec = DEFAULT,
    trees: int = TREES,
    rows_per_tree: int = ROWS_PER_TREE,
    contamination: float = CONTAMINATION,
    seed: int = 42,
    **kw,
) -> dict[str, Any]:
    """Grow the trees on seeded row samples and set the score cut on all rows.

    Trees grow in parallel, one group of ``rows_per_tree`` rows each. What comes
    back is at most trees x (2 x rows_per_tree) nodes, whatever the data size.
    """
    columns = spec.present(df, spec.measures)
    if len(columns) < 2:
        return {"columns": []}
    medians = {c: v[0] for c, v in quantiles_of(df, columns, [0.5], **kw).items()}
    columns = [c for c in columns if medians[c] is not None]
    filled = df.select(spec.id, *[F.coalesce(F.col(c), F.lit(medians[c])).alias(c) for c in columns])
    pool = durable(seeded_sample(filled, trees * rows_per_tree, spec.id, seed), "forest-pool")
    held = pool.count()
    size = min(rows_per_tree, held)
    # At most trees x rows_per_tree rows are numbered here. Small tables are
    # dealt round several times, so every tree gets its full sample.
    place = F.row_number().over(Window.orderBy(row_hash(F.col(spec.id), seed), spec.id)) - 1
    slots = F.sequence(F.col("place"), F.lit(trees * size - 1), F.lit(held))
    dealt = pool.withColumn("place", place).withColumn("slot", F.explode(F.when(F.col("place") < trees * size, slots)))

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = rows.sort_values("slot")[columns].to_numpy(float)
        nodes = grow_tree(x, [seed, int(key[0])])
        return pd.DataFrame([(int(key[0]), *n) for n in nodes], columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])

    tree = F.floor(F.col("slot") / size).cast("int").alias("tree")
    grown = dealt.select(tree, "slot", *columns).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    nodes = [list(r) for r in grown.orderBy("tree", "node").collect()]
    fitted = {"columns": columns, "medians": medians, "nodes": nodes, "size": size}
    scores = durable(df.select(_score(fitted).alias("score")), "forest-scores")
    fitted["offset"] = quantiles(scores, {"score": (F.col("score"), [contamination])}, **kw)["score"][0]
    return fitted


def _score(fitted: Mapping[str, Any]) -> Column:
    """-2 ** (-mean depth / expected depth): lower is easier to isolate."""
    columns, medians = fitted["columns"], fitted["medians"]
    table = np.array(fitted["nodes"], dtype=float)
    starts = np.flatnonzero(table[:, 1] == 0)
    base = np.repeat(starts, np.diff(np.append(starts, len(table))))
    feature = table[:, 2].astype(int)
    cut, depth = table[:, 3], table[:, 6]
    low, high = table[:, 4].astype(int) + base, table[:, 5].astype(int) + base
    levels = math.ceil(math.log2(max(fitted["size"], 2)))
    scale = _expected_depth(fitted["size"]) or 1.0

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(float) for v in values])
        out = np.empty(len(x))
        for start in range(0, len(x), 2048):
            part = x[start : start + 2048]
            at = np.broadcast_to(starts, (len(part), len(starts))).copy()
            rows = np.arange(len(part))[:, None]
            for _ in range(levels):
                goes_low = part[rows, np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(goes_low, low[at], high[at])
            out[start : start + 2048] = -np.exp2(-depth[at].mean(axis=1) / scale)
        return pd.Series(out)

    return score(*[F.coalesce(F.col(c), F.lit(medians[c])) for c in columns])


def score_forest(df: DataFrame, fitted: Mapping[str, Any]) -> DataFrame:
    """Add ``isolation_forest_outlier`` and ``isolation_forest_score``; with
    fewer than two measures both are 0."""
    if not fitted["columns"]:
        return df.withColumns({"isolation_forest_outlier": F.lit(0), "isolation_forest_score": F.lit(0.0)})
    scored = df.withColumn("isolation_forest_score", _score(fitted) - F.lit(fitted["offset"]))
    return scored.withColumn("isolation_forest_outlier", (F.col("isolation_forest_score") < 0).cast("int"))
