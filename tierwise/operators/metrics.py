"""Evaluation of predictions and summaries of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.ordered import entries_at_most
from tierwise.operators.ordering import running_totals


def predicted_class(p: Column, threshold: float = 0.5) -> Column:
    return (p > F.lit(threshold)).cast("int")


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half, optionally per group.

    Rows shrink to one per distinct score first; each positive then counts the
    negatives below it and half of those level with it.
    """
    levels = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(
            F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
            F.sum((F.col(label) == 0).cast("bigint")).alias("neg"),
        )
    )
    ranked = running_totals(levels, list(by), score, ["neg"])
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))


def evaluate(df: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """One row: accuracy and auc."""
    # Both sides are a single row.
    return accuracy(df, label, prediction).join(F.broadcast(auc(df, label, score)))


def prediction_distribution(df: DataFrame, prediction: str) -> DataFrame:
    p = F.col(prediction)
    ones, zeros, rows = F.count_if(p == 1), F.count_if(p == 0), F.count("*")
    return df.agg(
        F.try_divide(ones.cast("double"), rows).alias("extrovert_ratio"),
        F.try_divide(zeros.cast("double"), rows).alias("introvert_ratio"),
        ones.alias("extrovert_count"),
        zeros.alias("introvert_count"),
        rows.alias("total_predictions"),
    )


def score_summary(df: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, extremes and median of fold scores.

    A group holds one row per fold.
    """
    c = F.col(score)
    return df.groupBy(*by).agg(
        F.avg(c).alias("mean_score"),
        F.stddev_pop(c).alias("std_score"),
        F.min(c).alias("min_score"),
        F.max(c).alias("max_score"),
        F.percentile(c, F.lit(0.5)).alias("median_score"),
    )


def importance_summary(df: DataFrame) -> DataFrame:
    """Mean, sample deviation and fold count per feature, largest mean first."""
    return (
        df.groupBy("feature")
        .agg(
            F.avg("importance").alias("importance_mean"),
            F.stddev_samp("importance").alias("importance_std"),
            F.count("*").alias("fold_count"),
        )
        .orderBy(F.col("importance_mean").desc(), "feature")
    )


# Pass criteria per training profile as (criterion, metric, limit);
# a metric named in AT_MOST must not exceed its limit, search_score must exceed
# it, data_integrity must hold, and any other must reach it.
CRITERIA: dict[str, list[tuple[str, str, float]]] = {
    "light": [
        ("dev_target_achieved", "mean_score", 0.975),
        ("stable_performance", "std_score", 0.003),
        ("fast_training", "training_time", 60),
        ("ready_for_heavy", "mean_score", 0.973),
    ],
    "base": [
        ("score_achieved", "mean_score", 0.975),
        ("stable_performance", "std_score", 0.002),
        ("reasonable_time", "training_time", 300),
        ("data_integrity", "data_integrity", 1),
    ],
    "enhanced": [
        ("bronze_target_achieved", "mean_score", 0.976518),
        ("stable_performance", "std_score", 0.002),
        ("reasonable_time", "training_time", 600),
        ("data_integrity", "data_integrity", 1),
        ("optimization_successful", "search_score", 0.97),
    ],
    "heavy": [
        ("bronze_target_achieved", "mean_score", 0.976518),
        ("stable_performance", "std_score", 0.002),
        ("reasonable_time", "training_time", 1200),
        ("data_integrity", "data_integrity", 1),
        ("optimization_successful", "search_score", 0.97),
        ("ready_for_submission", "mean_score", 0.975),
    ],
}
AT_MOST = ["std_score", "training_time"]


def success_criteria(metrics: DataFrame, profile: str = "base", keys: Sequence[str] = ()) -> DataFrame:
    """(criterion, passed) per metrics row, and an ``overall_success`` row.

    ``keys`` name the columns that tell several metrics rows apart. A missing
    metric fails.
    """
    lines = []
    overall = F.lit(True)
    for name, metric, limit in CRITERIA[profile]:
        if metric in metrics.columns:
            value = F.col(metric).cast("double")
        else:
            value = F.lit(None).cast("double")
        if metric in AT_MOST:
            test = value <= F.lit(float(limit))
        elif metric == "search_score":
            test = value > F.lit(float(limit))
        else:
            test = value >= F.lit(float(limit))
        passed = F.coalesce(test, F.lit(False))
        overall = overall & passed
        lines.append(F.struct(F.lit(name).alias("criterion"), passed.alias("passed")))
    lines.append(F.struct(F.lit("overall_success").alias("criterion"), overall.alias("passed")))
    return metrics.select(*keys, F.inline(F.array(*lines)))


# Marks in a column name that put it in a family; a column may
# belong to several.
FAMILY_MARKS: dict[str, list[str]] = {
    "interaction": ["interaction"],
    "polynomial": ["poly_"],
    "scaled": ["_scaled"],
    "power": ["_power"],
    "target_encoded": ["_target_encoded"],
    "statistical": ["_mean", "_std", "_skew", "_kurtosis", "_percentile"],
}
LEARNED_FAMILIES = ["power", "target_encoded", "statistical"]


def families_of(name: str) -> list[str]:
    def marked(family: str, mark: str) -> bool:
        if family == "polynomial":
            return name.startswith(mark)
        return name.endswith(mark) if family == "scaled" else mark in name

    found = [family for family, marks in FAMILY_MARKS.items() if any(marked(family, m) for m in marks)]
    return found if set(found) & set(LEARNED_FAMILIES) else [*found, "original"]


def feature_families(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Number of columns per family; metadata only, no rows are read."""
    rows = [(c, family) for c in names for family in families_of(c)]
    frame = spark.createDataFrame(rows, "feature string, family string")
    return frame.groupBy("family").agg(F.count("*").alias("features"))


def score_histogram(df: DataFrame, label: str, score: str, cuts: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., cell, rows, ones): rows between the ascending cut points, cell k holding scores above
    k of them. Histograms of parts of a table add up to that of the whole."""
    cell = entries_at_most(F.lit([float(c) for c in cuts]), F.col(score).cast("double"), len(cuts), below=True)
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(*by, cell.alias("cell")).agg(F.count("*").alias("rows"), F.sum(F.col(label).cast("long")).alias("ones"))


def threshold_table(df: DataFrame, label: str, score: str, cuts: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, accuracy, predicted_ones) when a score above the threshold counts as 1.

    One pass over the rows whatever the number of thresholds: the true and false ones above each
    are sums over the cells above it. Rows without score or label are left out.
    """
    ordered = sorted({float(c) for c in cuts})
    cells = score_histogram(df, label, score, ordered, by)
    sums = cells.groupBy(*by).agg(
        F.sum("rows").alias("all_rows"),
        F.sum("ones").alias("all_ones"),
        # At most one entry per cut point and one more.
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("rows", "ones")))).alias("held"),
    )
    lines = sums.where(F.col("all_rows") > 0).select(*by, "all_rows", "all_ones", "held", F.posexplode(F.lit(ordered)).alias("at", "threshold"))

    def above(part: str) -> Column:
        cells_above = F.sequence(F.col("at") + 1, F.lit(len(ordered)))
        return F.aggregate(cells_above, F.lit(0).cast("long"), lambda n, k: n + F.coalesce(F.try_element_at("held", k)[part], F.lit(0)))

    ready = lines.select(*by, "threshold", "all_rows", "all_ones", above("rows").alias("rows"), above("ones").alias("ones"))
    right = F.col("ones") + (F.col("all_rows") - F.col("all_ones")) - (F.col("rows") - F.col("ones"))
    return ready.select(*by, "threshold", (right / F.col("all_rows")).alias("accuracy"), F.col("rows").alias("predicted_ones"))


# The searched thresholds, 0.10 to 0.89.
THRESHOLDS = [i / 100 for i in range(10, 90)]


def best_threshold(df: DataFrame, label: str, score: str, cuts: Sequence[float] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, accuracy, predicted_ones) of the most accurate threshold, the lowest on ties."""
    table = threshold_table(df, label, score, cuts if cuts is not None else THRESHOLDS, by)
    best = F.max_by(F.struct("threshold", "accuracy", "predicted_ones"), F.struct("accuracy", -F.col("threshold")))
    return table.groupBy(*by).agg(best.alias("b")).where(F.col("b").isNotNull()).select(*by, "b.*")
