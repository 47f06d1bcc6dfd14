"""Pairs of columns, pairs of tables, thresholds, submissions and runs."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierwise.operators import correlation, drift, metrics
from tierwise.sources import experiments, results


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 9)) + 1e6
    x[:, 3] = 2 * x[:, 0] + 1e-3 * rng.normal(size=400)
    x[:, 5] = -x[:, 1]
    x[:, 7] = 4.0
    x[rng.random((400, 9)) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(9)])
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in frame.to_numpy()]
    return frame, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns)).repartition(5).cache()


@pytest.mark.parametrize("tile, pairs", [(64, 64), (2, 3)])
def test_correlations_over_tiles_with_gaps(wide, tile, pairs):
    frame, df = wide
    got = {(r["left"], r["right"]): (r["pairs"], r["r"]) for r in correlation.correlations(df, list(frame.columns), tile, pairs).collect()}
    want = frame.corr()
    assert len(got) == 36
    for (a, b), (n, r) in got.items():
        assert n == (frame[a].notna() & frame[b].notna()).sum()
        assert r is None if "c7" in (a, b) else r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_correlated_and_redundant_columns(wide):
    frame, df = wide
    high = {(r["left"], r["right"]) for r in correlation.correlated_pairs(df, list(frame.columns)).collect()}
    assert high == {("c0", "c3"), ("c1", "c5")}
    assert correlation.redundant_columns(df, list(frame.columns)) == ["c3", "c5"]
    assert correlation.correlations(df, []).count() == 0 and correlation.correlations(df.limit(0), ["c0", "c1"]).count() == 0


def test_drift_finds_what_was_planted(spark):
    rows = [(float(i % 10), 5.0, None if i % 10 == 0 else 1.0, "a" if i % 2 else "b", None) for i in range(100)]
    train = spark.createDataFrame(rows, "x double, same double, gaps double, kind string, only double")
    other = train.select(
        (F.col("x") + 1).alias("x"), "same", F.when(F.col("x") > 4, None).otherwise(F.col("gaps")).alias("gaps"),
        F.when(F.col("kind") == "a", "new").otherwise(F.col("kind")).alias("kind"), F.lit(1.0).alias("only"),
    )
    found = {(r["column_name"], r["finding"], r["value"]) for r in drift.drift_report(train, other, ["x", "same", "gaps", "only"], ["kind"]).collect()}
    assert found == {
        ("x", "mean_shift", None), ("gaps", "missing_shift", None), ("only", "only_other", None), ("only", "missing_shift", None),
        ("kind", "new_category", "new"), ("kind", "lost_category", "a"),
    }
    assert drift.drift_report(train, train, ["x", "same", "gaps"], ["kind"]).isEmpty()
    assert drift.drift_report(train.limit(0), train.limit(0), ["x"], ["kind"]).isEmpty()


def test_drift_of_a_column_one_table_lacks(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, kind string")
    found = {(r["column_name"], r["finding"], r["value"]) for r in drift.drift_report(train, train.drop("x", "kind").withColumn("z", F.lit(1)), ["x"], ["kind"]).collect()}
    assert found == {("x", "only_train", None), ("kind", "lost_category", "a"), ("kind", "lost_category", "b")}


def test_thresholds_against_each_by_itself(spark):
    rng = random.Random(1)
    rows = [(rng.random(), rng.randint(0, 1), i % 3) for i in range(300)] + [(0.5, 1, 0), (None, 1, 0), (0.4, None, 1), (0.10, 0, 2)]
    df = spark.createDataFrame(rows, "p double, label int, fold int")
    got = {(r["fold"], r["threshold"]): (r["accuracy"], r["predicted_ones"]) for r in metrics.threshold_table(df, "label", "p", metrics.THRESHOLDS, ["fold"]).collect()}
    assert len(got) == 240
    for (fold, t), (accuracy, ones) in got.items():
        mine = [(p, y) for p, y, f in rows if f == fold and p is not None and y is not None]
        assert accuracy == pytest.approx(sum((p > t) == y for p, y in mine) / len(mine)) and ones == sum(p > t for p, _ in mine)
    best = metrics.best_threshold(df, "label", "p").first()
    every = {t: a for t, a in ((r["threshold"], r["accuracy"]) for r in metrics.threshold_table(df, "label", "p", metrics.THRESHOLDS).collect())}
    assert best["threshold"] == min(t for t, a in every.items() if a == max(every.values()))
    assert metrics.best_threshold(df.limit(0), "label", "p").count() == 0


def test_histograms_of_parts_add_up(spark):
    df = spark.createDataFrame([(i / 50, i % 2) for i in range(50)], "p double, label int")
    cuts = [0.25, 0.5, 0.75]
    whole, a, b = (metrics.score_histogram(d, "label", "p", cuts) for d in (df, df.where("p < 0.6"), df.where("p >= 0.6")))
    added = a.unionByName(b).groupBy("cell").agg(F.sum("rows").alias("rows"), F.sum("ones").alias("ones"))
    assert sorted(whole.collect()) == sorted(added.collect())


def test_each_fault_of_a_submission(spark):
    wanted = spark.createDataFrame([(i,) for i in range(1, 7)], "id bigint")
    sent = spark.createDataFrame(
        [(1, "Extrovert", 0.9), (2, "Introvert", 1.2), (2, "Introvert", 0.1), (3, None, 0.5), (9, "extrovert", None), (None, "Extrovert", 0.5), (None, "Extrovert", 0.5), (4, "Introvert", 0.0)],
        "id bigint, Personality string, p double",
    )
    got = {(r["fault"], r["id"], r["value"], r["n"]) for r in results.submission_faults(sent, wanted, probability="p").collect() if r["id"]}
    assert got == {
        ("missing_id", "5", None, 1), ("missing_id", "6", None, 1), ("unexpected_id", "9", None, 1), ("duplicate_id", "2", None, 2),
        ("bad_label", "3", None, 1), ("bad_label", "9", "extrovert", 1), ("bad_probability", "2", "1.2", 1), ("bad_probability", "9", None, 1),
    }
    assert results.submission_faults(sent, wanted).where("fault = 'null_id'").first()["n"] == 2
    good = wanted.select("id", F.lit("Introvert").alias("Personality"))
    assert results.submission_faults(good, wanted).isEmpty()
    lacking = {(r["fault"], r["value"]) for r in results.submission_faults(good.drop("Personality").withColumn("x", F.lit(1)), wanted).collect()}
    assert lacking == {("missing_column", "Personality"), ("unexpected_column", "x")}


def test_experiments_are_appended_and_ranked(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert experiments.read(spark, path).count() == 0
    experiments.append(experiments.record(spark, "r1", "base", {"depth": 5}, {"cv": 0.9}), path)
    experiments.append(experiments.record(spark, "r2", "base", {"depth": 6}, {"auc": 0.99}, ["a"], "no cv"), path)
    experiments.append(experiments.record(spark, "r3", "heavy", {"depth": 5}, {"cv": 0.95}), path)
    experiments.append(experiments.record(spark, "r4", "heavy", {}, {"cv": float("nan")}), path)
    runs = experiments.read(spark, path)
    assert [(r["rank"], r["run"], r["value"]) for r in experiments.top_runs(runs, "cv", 3).orderBy("rank").collect()] == [(1, "r3", 0.95), (2, "r1", 0.9), (3, "r2", 0.0)]
    assert experiments.top_runs(runs, "cv", 1, smallest=True).first()["run"] == "r2"
    assert {(r["value"], r["runs"]) for r in experiments.parameter_values(runs).collect()} == {("5", 2), ("6", 1)}
    assert {r["name"]: (r["runs"], r["best_value"]) for r in experiments.compare(runs, "cv").collect()} == {"base": (2, 0.9), "heavy": (2, 0.95)}
