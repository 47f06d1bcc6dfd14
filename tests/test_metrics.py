import pytest
from pyspark.sql import functions as F

from tierwise.operators import metrics, quality


def integrity(spark, rows):
    return quality.integrity_checks(spark.createDataFrame(rows, "x double, label double"), ["x"]).first().asDict()


def test_integrity_golden_cases(spark):
    clean = integrity(spark, [(1.0, float(i % 2)) for i in range(12)])
    assert all(clean[k] for k in quality.GATES) and clean["has_nan"] is False and clean["n_classes"] == 2
    assert integrity(spark, [(1.0, float(i % 2)) for i in range(5)])["sufficient_samples"] is False
    assert integrity(spark, [(1.0, 1.0)] * 12)["balanced_classes"] is False
    assert integrity(spark, [(1.0, float(i % 3)) for i in range(12)])["binary_targets"] is False
    odd = integrity(spark, [(float("nan"), 0.0), (float("inf"), 1.0), (1.0, None)])
    assert (odd["has_nan"], odd["has_inf"], odd["no_missing_targets"]) == (True, True, False)


def test_gate_names_what_failed(spark):
    df = spark.createDataFrame([(1.0, 1)] * 4, "x double, label int")
    with pytest.raises(ValueError, match="sufficient_samples"):
        quality.require_integrity(df, ["x"])


def test_label_distribution(spark):
    df = spark.createDataFrame([(0,)] + [(1,)] * 7, "y int")
    got = {r["label"]: (r["class_count"], r["class_ratio"]) for r in quality.label_distribution(df, F.col("y")).collect()}
    assert got == {0: (1, 0.125), 1: (7, 0.875)}
    assert quality.label_summary(df, F.col("y")).first().asDict() == {"n_classes": 2, "is_binary": True, "has_both_classes": True}
    three = spark.createDataFrame([(0,), (1,), (3,)], "y int")
    assert quality.label_summary(three, F.col("y")).first().asDict() == {"n_classes": 3, "is_binary": False, "has_both_classes": False}


def test_quality_metrics_count_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 3.0)], "a int, b double")
    assert quality.quality_metrics(df).first().asDict() == {"total_rows": 4, "total_columns": 2, "missing_values": 3, "duplicate_rows": 2}
    assert quality.quality_metrics(df.where("a = 9")).first()["total_rows"] == 0


def test_range_checks_of_text_and_nan(spark):
    df = spark.createDataFrame([("4", 3.0), ("5", float("nan"))], "Time_spent_Alone string, Going_outside double")
    got = {(r["column_name"], r["check_name"]): r["ok"] for r in quality.range_checks(df).collect()}
    assert got["Time_spent_Alone", "within_24hrs"] is False
    assert got["Going_outside", "finite_values"] is False


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, p double")
    assert metrics.auc(df, "y", "p").first()["auc"] == 0.875
    assert metrics.auc(df.where("y = 1"), "y", "p").first()["auc"] is None


def test_importance_summary_sorts_and_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 9.0)], "feature string, importance double")
    got = [tuple(r) for r in metrics.importance_summary(df).collect()]
    assert got[0] == ("b", 9.0, None, 1) and got[1][:2] == ("a", 2.0)
    assert metrics.importance_summary(df.limit(0)).count() == 0


def test_criteria_fail_on_a_missing_metric(spark):
    df = spark.createDataFrame([(0.99, 0.001, 10.0, True)], "mean_score double, std_score double, training_time double, data_integrity boolean")
    base = {r["criterion"]: r["passed"] for r in metrics.success_criteria(df, "base").collect()}
    assert all(base.values()) and "overall_success" in base
    heavy = {r["criterion"]: r["passed"] for r in metrics.success_criteria(df, "heavy").collect()}
    assert heavy["optimization_successful"] is False and heavy["overall_success"] is False


def test_families_overlap(spark):
    assert metrics.families_of("poly_social_interaction") == ["interaction", "polynomial", "original"]
    assert metrics.families_of("a_power") == ["power"]
    got = {r["family"]: r["features"] for r in metrics.feature_families(spark, ["a_power", "b", "x_scaled", "row_mean"]).collect()}
    assert got == {"power": 1, "original": 2, "scaled": 1, "statistical": 1}
