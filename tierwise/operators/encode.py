"""Learned encodings: power transform, target means, category codes, mode flags."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.columns import flag, ratio, row_hash, unit_from_hash
from tierwise.operators.lookup import lookup
from tierwise.operators.ordering import percent_ranks, running_totals
from tierwise.operators.stats import corrected_skewness, mean_and_std, per_column
from tierwise.runtime import durable
from tierwise.spec import DEFAULT, FeatureSpec, numeric_columns, text_columns

SKEW_GATE = 0.5
# Lambda grid: first pass over [-4, 4], each later pass ten times finer.
FIRST_GRID = [x / 2 for x in range(-8, 9)]
FINE_STEPS = 10
PASSES = 3
# Columns with no more distinct values than this are fitted on value counts.
FEW_VALUES = 1_000_000


def yeo_johnson(c: Column, lam: Column | float) -> Column:
    """Yeo-Johnson value; NULL stays NULL."""
    if not isinstance(lam, Column):
        lam = F.lit(float(lam))
    rest = 2 - lam
    up = F.when(lam == 0, F.log1p(c)).otherwise(F.try_divide(F.pow(c + 1, lam) - 1, lam))
    down = F.when(rest == 0, -F.log1p(-c)).otherwise(-F.try_divide(F.pow(1 - c, rest) - 1, rest))
    return F.when(c >= 0, up).when(c < 0, down)


def _values_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    return df.select(F.inline(pairs)).where(F.col("x").isNotNull())


def _likelihoods(values: DataFrame, centres: Mapping[str, float], grids: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], float]:
    """Log-likelihood of every (column, lambda) as one grouped aggregate.

    Sums run around the transformed mean of the column, so that the variance
    does not come from the difference of two large numbers.
    """
    spark = values.sparkSession
    grid = spark.createDataFrame(
        [(c, lam, centres[c]) for c, g in grids.items() for lam in g], "column string, lam double, centre double"
    )
    lam, w = F.col("lam"), F.col("w")
    d = yeo_johnson(F.col("x"), lam) - yeo_johnson(F.col("centre"), lam)
    # The grid has a few dozen rows per column.
    sums = (
        values.join(F.broadcast(grid), "column")
        .select("column", "lam", "x", "w", d.alias("d"))
        .groupBy("column", "lam")
        .agg(
            F.sum("w").alias("n"),
            F.sum(w * F.col("d")).alias("s1"),
            F.sum(w * F.col("d") * F.col("d")).alias("s2"),
            F.sum(w * F.signum("x") * F.log1p(F.abs("x"))).alias("logs"),
        )
    )
    out: dict[tuple[str, float], float] = {}
    for r in sums.collect():
        var = r["s2"] / r["n"] - (r["s1"] / r["n"]) ** 2
        usable = math.isfinite(var) and var > 0
        out[r["column"], r["lam"]] = -r["n"] / 2 * math.log(var) + (r["lam"] - 1) * r["logs"] if usable else -math.inf
    return out


def fit_power(df: DataFrame, spec: FeatureSpec = DEFAULT, columns: Sequence[str] | None = None, gate: float = SKEW_GATE) -> dict[str, float]:
    """Lambda of maximum likelihood for each numeric column skewed beyond the gate.

    A grid of lambdas is one grouped aggregate; each pass narrows around the
    best, and the peak of the parabola through the last three points ends it.
    Columns with few distinct values are reduced to value counts first.
    """
    names = list(columns) if columns is not None else [c for c in numeric_columns(df) if c != spec.id]
    first = per_column(
        df,
        {c: F.col(c) for c in names},
        {"skew": corrected_skewness, "mean": F.avg, "values": F.approx_count_distinct},
    )
    gated = [c for c in names if first[c]["skew"] is not None and abs(first[c]["skew"]) > gate]
    if not gated:
        return {}
    centres = {c: first[c]["mean"] for c in gated}
    few = [c for c in gated if first[c]["values"] <= FEW_VALUES]
    many = [c for c in gated if c not in few]
    sources = []
    if few:
        counted = _values_of(df, few).groupBy("column", "x").agg(F.count("*").cast("double").alias("w"))
        sources.append(durable(counted, "value-counts"))
    if many:
        sources.append(_values_of(df, many).withColumn("w", F.lit(1.0)))
    best: dict[str, float] = {}
    scores: dict[tuple[str, float], float] = {}
    step = 0.5
    grids: dict[str, list[float]] = {c: list(FIRST_GRID) for c in gated}
    for _ in range(PASSES):
        todo = dict(grids)
        while todo:
            for source, held in zip(sources, [g for g in (few, many) if g]):
                asked = {c: todo[c] for c in held if c in todo}
                if asked:
                    scores.update(_likelihoods(source, centres, asked))
            # Slide a grid whose best value lies on its edge.
            again: dict[str, list[float]] = {}
            for c, grid in todo.items():
                best[c] = max(grid, key=lambda lam: scores.get((c, lam), -math.inf))
                if best[c] in (grid[0], grid[-1]) and abs(best[c]) < 64:
                    half = len(grid) // 2
                    again[c] = [round(best[c] + (i - half) * step, 10) for i in range(len(grid))]
            todo = again
        width = step
        step /= FINE_STEPS
        grids = {c: [round(best[c] + i * step, 10) for i in range(-FINE_STEPS, FINE_STEPS + 1)] for c in gated}
    for c in gated:
        left, mid, right = (scores.get((c, round(best[c] + s * width, 10)), -math.inf) for s in (-1, 0, 1))
        bend = left - 2 * mid + right
        if math.isfinite(bend) and bend < 0:
            best[c] += 0.5 * width * (left - right) / bend
    return best


def power_transform(df: DataFrame, lambdas: Mapping[str, float]) -> DataFrame:
    new = {f"{c}_power": yeo_johnson(F.col(c).cast("double"), lam) for c, lam in lambdas.items() if c in df.columns}
    return df.withColumns(new) if new else df


SMOOTHING = 1.0
MIN_LEAF = 10


def _smoothed(n: Column, mean: Column, prior: Column, smoothing: float, min_leaf: int) -> Column:
    weight = 1 / (1 + F.exp(-(n - min_leaf) / F.lit(float(smoothing))))
    return prior * (1 - weight) + mean * weight


def fit_target_means(
    df: DataFrame,
    label: Column,
    spec: FeatureSpec = DEFAULT,
    columns: Sequence[str] | None = None,
    smoothing: float = SMOOTHING,
    min_leaf: int = MIN_LEAF,
) -> DataFrame:
    """(column, category, n, prior, encoded): category means drawn to the overall
    mean; missing is a category of its own when it occurs. Stored, one grouping
    for all columns; hot categories collapse before the shuffle."""
    if label is None:
        raise ValueError("target encoding needs a label")
    names = list(columns) if columns is not None else [c for c in text_columns(df) if c != spec.label]
    y = label.cast("double")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in names])
    sums = durable(
        df.where(y.isNotNull())
        .select(y.alias("__y"), F.inline(pairs))
        .groupBy("column", "category")
        .agg(F.count("*").alias("n"), F.sum("__y").alias("total")),
        "target-sums",
    )
    # Every column counts each row once: one row per column name.
    priors = sums.groupBy("column").agg((F.sum("total") / F.sum("n")).alias("prior"))
    n = F.col("n").cast("double")
    return sums.join(F.broadcast(priors), "column").select(
        "column",
        "category",
        "n",
        "prior",
        _smoothed(n, F.col("total") / n, F.col("prior"), smoothing, min_leaf).alias("encoded"),
    )


def target_encode(
    df: DataFrame, means: DataFrame, spec: FeatureSpec = DEFAULT, noise: float = 0.0, seed: int = 42
) -> DataFrame:
    """Add ``<name>_target_encoded``; an unseen category gets the prior.

    ``noise`` adds a repeatable Gaussian term per row, for training data only.
    """
    stored = durable(means, "target-means")
    priors = {r["column"]: r["prior"] for r in stored.groupBy("column").agg(F.first("prior").alias("prior")).collect()}
    out = df
    for c, prior in sorted(priors.items()):
        if c not in df.columns:
            continue
        mine = stored.where(F.col("column") == c).select(F.col("category").alias(c), "n", F.col("encoded").alias("__enc"))
        value = F.coalesce(F.col("__enc"), F.lit(prior))
        if noise > 0:
            value = value + F.lit(float(noise)) * gaussian_from_hash(F.col(spec.id), seed, c)
        out = lookup(out, mine, c, weight="n", spread=spec.id).withColumn(f"{c}_target_encoded", value).drop("__enc")
    return out


def gaussian_from_hash(id_col: Column, seed: int, tag: str) -> Column:
    """Standard normal number of a row, from two digests (Box-Muller)."""
    u = unit_from_hash(F.md5(F.concat(row_hash(id_col, seed), F.lit(f"{tag}/u"))))
    v = unit_from_hash(F.md5(F.concat(row_hash(id_col, seed), F.lit(f"{tag}/v"))))
    return F.sqrt(-2 * F.log1p(-u)) * F.cos(F.lit(2 * math.pi) * v)


def target_encode_out_of_fold(
    df: DataFrame,
    label: Column,
    columns: Sequence[str],
    spec: FeatureSpec = DEFAULT,
    smoothing: float = SMOOTHING,
    min_leaf: int = MIN_LEAF,
) -> DataFrame:
    """Encode each row from the rows of the other folds only.

    One grouping by (category, fold) serves all folds: the other folds' sums are
    the category's total minus the fold's own.
    """
    y = label.cast("double")
    out = df
    for c in columns:
        cells = durable(
            df.where(y.isNotNull())
            .groupBy(F.col(c).alias("__cat"), F.col("fold").alias("__f"))
            .agg(F.count("*").alias("n"), F.sum(y).alias("t")),
            "fold-sums",
        )
        per_fold = cells.groupBy("__f").agg(F.sum("n").alias("fn"), F.sum("t").alias("ft"))
        whole = cells.agg(F.sum("n").alias("an"), F.sum("t").alias("at")).first()
        # One row per fold.
        folds = {r["__f"]: (whole["at"] - r["ft"]) / (whole["an"] - r["fn"]) for r in per_fold.collect() if whole["an"] > r["fn"]}
        by_cat = Window.partitionBy("__cat")
        n_out = (F.sum("n").over(by_cat) - F.col("n")).cast("double")
        t_out = F.sum("t").over(by_cat) - F.col("t")
        prior = F.coalesce(*[F.when(F.col("__f") == k, F.lit(v)) for k, v in folds.items()])
        encoded = F.when(n_out > 0, _smoothed(n_out, F.try_divide(t_out, n_out), prior, smoothing, min_leaf)).otherwise(prior)
        code = F.concat_ws("#", F.col("__f").cast("string"), F.coalesce(F.concat(F.lit("="), F.col("__cat").cast("string")), F.lit("~")))
        mine = durable(cells.select(code.alias("__cell"), "n", encoded.alias(f"{c}_target_encoded")), "fold-means")
        row_code = F.concat_ws("#", F.col("fold").cast("string"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")))
        out = lookup(out.withColumn("__cell", row_code), mine, "__cell", weight="n", spread=spec.id).drop("__cell")
    return out


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, code): categories numbered from 0 in sorted order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    values = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("one", F.lit(1))
    )
    numbered = running_totals(values, ["column"], "value", ["one"])
    return numbered.select("column", "value", "n", F.col("one_before").cast("int").alias("code"))


def encode_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Add ``<name>_encoded`` int codes; missing or unseen is -1."""
    stored = durable(codes, "codes")
    out = df
    for c in columns:
        mine = stored.where(F.col("column") == c).select(F.col("value").alias(c), "n", F.col("code").alias("__code"))
        out = lookup(out, mine, c, weight="n", spread=id_col)
        out = out.withColumn(f"{c}_encoded", F.coalesce("__code", F.lit(-1)).cast("int")).drop("__code")
    return out


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties.

    Counted by a distributed grouping; one row per column comes back.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    top = counts.groupBy("column").agg(F.max("n").alias("top"))
    best = counts.join(F.broadcast(top), "column").where(F.col("n") == F.col("top"))
    rows = best.groupBy("column").agg(F.min("value").alias("mode")).collect()
    return {r["column"]: r["mode"] for r in rows}


def mode_flags(df: DataFrame, modes: Mapping[str, str]) -> DataFrame:
    new = {f"{c}_is_mode": flag(F.col(c) == F.lit(m)) for c, m in modes.items() if c in df.columns and m}
    return df.withColumns(new) if new else df


def key_columns(spec: FeatureSpec = DEFAULT) -> list[str]:
    return [spec.social, spec.alone, spec.friends]


def key_zscores(df: DataFrame, fitted: Mapping[str, Sequence[float]]) -> DataFrame:
    """``<name>_zscore`` as (x - mean) / (deviation + eps)."""
    new = {
        f"{c}_zscore": ratio(F.col(c) - F.lit(m), F.lit(s))
        for c, (m, s) in fitted.items()
        if c in df.columns and s is not None
    }
    return df.withColumns(new) if new else df


def fit_key_zscores(df: DataFrame, spec: FeatureSpec = DEFAULT) -> dict[str, list[float]]:
    return {c: [m, s] for c, (m, s) in mean_and_std(df, spec.present(df, key_columns(spec))).items()}


def key_percentiles(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    return percent_ranks(df, spec.present(df, key_columns(spec)), id_col=spec.id)


def was_missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_was_missing": F.col(c).isNull().cast("int") for c in columns if c in df.columns})
