import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from tierwise.functions import rows
from tierwise.operators import bronze, silver
from tierwise.plans import layers


@pytest.fixture(scope="module")
def encoded(survey):
    return bronze.encode_yes_no(survey)


def test_stage_counts(encoded):
    out = layers.apply_silver(encoded, layers.fit_silver(encoded))
    new = [c for c in out.columns if c not in encoded.columns]
    assert len(new) == 127
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert sum(c.startswith("poly_") for c in new) == 55
    assert out.count() == encoded.count()


def test_row_sum_skips_gaps_and_arithmetic_does_not(encoded):
    out = silver.derive(encoded)
    assert values(out, "extrovert_score")[5] == 3.0
    assert values(out, "Introvert_extrovert_spectrum")[5] is None
    assert values(out, "introvert_std")[10] == pytest.approx(math.sqrt(1 / 3))


def test_missing_inputs_skip_features(encoded):
    out = silver.derive(encoded.select("id", "Going_outside"))
    assert "social_ratio" not in out.columns and "activity_std" not in out.columns
    assert "extrovert_score" in out.columns


def test_polynomial_needs_two_inputs(encoded):
    one = encoded.select("id", "Going_outside")
    assert silver.polynomial_features(one).columns == one.columns
    two = silver.polynomial_features(encoded.select("id", "Going_outside", "Post_frequency"))
    assert values(two, "poly_Going_outside_Post_frequency")[6] == 0.0


def test_scaling_leaves_out_constants(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0, True), (2, 1.0, 6.0, False)], "id bigint, c double, v double, b boolean")
    out = silver.scale(df, silver.fit_scaling(df))
    assert "c_scaled" not in out.columns and "id_scaled" not in out.columns and "b_scaled" in out.columns
    assert values(out, "v_scaled")[2] == pytest.approx(math.sqrt(0.5))


def test_fold_safe_scaling_is_learned_on_train(encoded):
    train = encoded.where("id <= 8")
    fitted = silver.fit_fold_safe_silver(train)
    other = silver.fit_fold_safe_silver(encoded.where("id > 4"))
    assert fitted["scaling"]["Going_outside"] != other["scaling"]["Going_outside"]
    out = silver.fold_safe_silver(train, fitted)
    mean = out.agg(F.avg("Going_outside")).first()[0]
    assert mean == pytest.approx(0.0, abs=1e-12)
    assert values(out, "id")[1] == 1


def test_row_moments_edges(spark):
    data = [(1, None, None, None, None), (2, 5.0, None, None, None), (3, 2.0, 2.0, 2.0, 2.0), (4, 1.0, 2.0, 4.0, None)]
    df = spark.createDataFrame(data, "id bigint, a double, b double, c double, d double")
    got = {r["id"]: r for r in rows.with_row_moments(df, ["a", "b", "c", "d"]).collect()}
    assert (got[1]["row_mean"], got[1]["row_skew"], got[1]["row_kurtosis"], got[1]["row_q25"]) == (None, 0.0, 0.0, None)
    assert (got[2]["row_mean"], got[2]["row_std"], got[2]["row_skew"], got[2]["row_iqr"]) == (5.0, None, None, 0.0)
    assert (got[3]["row_std"], got[3]["row_skew"], got[3]["row_kurtosis"]) == (0.0, 0.0, 0.0)
    assert got[4]["row_skew"] == pytest.approx(0.935219529582825) and got[4]["row_kurtosis"] is None


def test_plan_is_one_pass_over_the_rows(encoded):
    plan = layers.apply_silver(encoded, layers.fit_silver(encoded))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
