"""Result files: submissions, fold scores, cross-validation and search records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.spec import DEFAULT, FeatureSpec


def submission(predictions: DataFrame, score: str, spec: FeatureSpec = DEFAULT, threshold: float = 0.5) -> DataFrame:
    """(id, label text); a score above the threshold is the positive class."""
    text = F.when(F.col(score) > F.lit(threshold), spec.positive).otherwise(spec.negative)
    return predictions.select(spec.id, text.alias(spec.label))


def submission_for(rows: DataFrame, predictions: DataFrame, score: str, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Submission for exactly the ids of ``rows``; every row needs one prediction."""
    asked, given = rows.count(), predictions.count()
    if asked != given:
        raise ValueError(f"{given} predictions for {asked} rows")
    joined = rows.select(spec.id).join(predictions.select(spec.id, score), spec.id)
    if joined.count() != asked:
        raise ValueError("predictions and rows do not carry the same ids")
    return submission(joined, score, spec)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, as a folder of part files."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


CV_RECORD = (
    "timestamp string, model_type string, cv_config map<string,string>, fold_scores array<double>, "
    "training_time double, mean_score double, std_score double, min_score double, max_score double, "
    "median_score double, extra map<string,string>"
)


def cv_record(
    spark: SparkSession,
    model_type: str,
    cv_config: Mapping[str, Any],
    fold_scores: Sequence[float],
    training_time: float,
    **extra: Any,
) -> DataFrame:
    """One row describing a cross-validation run; the scores are one per fold."""
    now = datetime.now(timezone.utc).isoformat()
    scores = [float(s) for s in fold_scores]
    base = spark.createDataFrame(
        [(now, model_type, {k: str(v) for k, v in cv_config.items()}, scores, float(training_time), {k: str(v) for k, v in extra.items()})],
        "timestamp string, model_type string, cv_config map<string,string>, fold_scores array<double>, "
        "training_time double, extra map<string,string>",
    )
    summary = base.select(F.explode("fold_scores").alias("s")).agg(
        F.avg("s").alias("mean_score"),
        F.stddev_pop("s").alias("std_score"),
        F.min("s").alias("min_score"),
        F.max("s").alias("max_score"),
        F.percentile("s", F.lit(0.5)).alias("median_score"),
    )
    # Both sides are a single row.
    joined = base.join(F.broadcast(summary))
    return joined.select(*[c.split()[0] for c in CV_RECORD.split(", ")])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


SEARCH_RECORD = "timestamp string, best_params map<string,double>, best_score double, n_trials int, seconds double"


def search_record(spark: SparkSession, best_params: Mapping[str, float], best_score: float, n_trials: int, seconds: float) -> DataFrame:
    now = datetime.now(timezone.utc).isoformat()
    row = (now, {k: float(v) for k, v in best_params.items()}, float(best_score), int(n_trials), float(seconds))
    return spark.createDataFrame([row], SEARCH_RECORD)


def submission_faults(submitted: DataFrame, wanted: DataFrame, spec: FeatureSpec = DEFAULT, probability: str | None = None) -> DataFrame:
    """(fault, id, value, n): what is wrong with a submission for the ids of ``wanted``; no row if nothing.

    ``missing_column`` and ``unexpected_column`` name a column as value; ``missing_id`` is wanted and not
    submitted, ``unexpected_id`` the other way round, ``duplicate_id`` submitted ``n`` times,
    ``null_id`` submitted without id ``n`` times; ``bad_label`` is neither of the two classes or a gap,
    ``bad_probability`` a gap or outside 0..1. Ids are compared as text. Both anti-joins see each id
    once, so neither copies nor gaps make a hot key.
    """
    id_col, label = spec.id, spec.label
    expected = [id_col, label] + ([probability] if probability else [])
    spark = submitted.sparkSession
    odd = [("missing_column", None, c, 1) for c in expected if c not in submitted.columns]
    odd += [("unexpected_column", None, c, 1) for c in submitted.columns if c not in expected]
    schema = "fault string, id string, value string, n bigint"
    found = spark.createDataFrame(odd, schema)

    def fault(name: str, df: DataFrame, value=None, n=None) -> DataFrame:
        return df.select(
            F.lit(name).alias("fault"), "id", (F.lit(None) if value is None else value).cast("string").alias("value"),
            (F.lit(1) if n is None else n).cast("long").alias("n"),
        )

    if id_col in submitted.columns:
        given = submitted.groupBy(F.col(f"`{id_col}`").cast("string").alias("id")).agg(F.count("*").alias("n"))
        asked = wanted.select(F.col(f"`{id_col}`").cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
        some = given.where(F.col("id").isNotNull())
        found = (
            found.unionByName(fault("missing_id", asked.join(some.select("id"), "id", "left_anti")))
            .unionByName(fault("unexpected_id", some.join(asked, "id", "left_anti"), n=F.col("n")))
            .unionByName(fault("duplicate_id", some.where(F.col("n") > 1), n=F.col("n")))
            .unionByName(fault("null_id", given.where(F.col("id").isNull()), n=F.col("n")))
        )
        ids = submitted.select(F.col(f"`{id_col}`").cast("string").alias("id"), *[F.col(f"`{c}`") for c in (label, probability) if c in submitted.columns and c])
        if label in submitted.columns:
            known = F.coalesce(F.col(f"`{label}`").cast("string").isin(spec.positive, spec.negative), F.lit(False))
            found = found.unionByName(fault("bad_label", ids.where(~known), F.col(f"`{label}`")))
        if probability and probability in submitted.columns:
            p = F.col(f"`{probability}`").cast("double")
            found = found.unionByName(fault("bad_probability", ids.where(~F.coalesce((p >= 0) & (p <= 1), F.lit(False))), p))
    return found
