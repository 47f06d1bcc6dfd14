import pytest
from conftest import values
from pyspark.sql import functions as F

from tierwise.models import crossval, learners
from tierwise.operators import gold
from tierwise.operators.bronze import encode_yes_no
from tierwise.operators.ordering import stratified_folds
from tierwise.plans import layers
from tierwise.runtime import durable
from tierwise.sources.profile import order_profile, split_profile


@pytest.fixture(scope="module")
def parts(spark):
    profile = durable(order_profile(spark, "/root/testdata/sf0.001").where("id < 400"), "profile")
    return split_profile(profile)


def test_both_tables_get_the_same_columns(parts):
    train, test = (encode_yes_no(df) for df in parts)
    columns = ["Stage_fear", "Drained_after_socializing"]
    fitted, a = layers.fit_enhanced(durable(train, "train"), target_columns=columns)
    b = layers.apply_enhanced(test.drop("Personality"), fitted)
    assert set(a.columns) - {"Personality", "Personality_is_mode"} == set(b.columns)
    assert a.count() == train.count() and b.count() == test.count()
    assert {"Stage_fear_target_encoded", "Stage_fear_was_missing", "Time_spent_Alone_zscore", "row_iqr"} <= set(b.columns)
    gaps = b.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fitted["numeric"]]).first()
    assert not any(gaps)
    assert set(values(b, "Going_outside_was_missing").values()) == {0, 1}


def test_one_call_without_statistics(parts):
    train, test = parts
    a, b = layers.enhanced_silver(train, [test.drop("Personality")], power=False, statistics=False)
    assert set(a.columns) - {"Personality"} == set(b.columns)
    assert "Stage_fear_target_encoded" in b.columns and "poly_social_ratio_pow_2" in b.columns
    assert a.count() == train.count() and b.count() == test.count()


def test_a_row_gets_the_same_features_alone(parts):
    train, test = (encode_yes_no(df) for df in parts)
    fitted, _ = layers.fit_enhanced(durable(train, "train"), power=False, target_means=False)
    many = layers.apply_enhanced(test, fitted)
    one = layers.apply_enhanced(test.where("id = 8"), fitted)
    assert one.select("Time_spent_Alone_percentile", "row_mean").collect() == many.where("id = 8").select("Time_spent_Alone_percentile", "row_mean").collect()


def test_classes_are_evened_out_on_request(parts):
    train, _ = parts
    (out,) = layers.enhanced_silver(train, power=False, target_means=False, statistics=False, oversampled=True)
    sizes = {r["Personality_encoded"]: r["count"] for r in out.groupBy("Personality_encoded").count().collect()}
    assert sizes[0] == sizes[1] and out.where("synthetic = 1").count() > 0


def test_enhanced_features_inside_each_fold(parts):
    rows = durable(stratified_folds(gold.encode_label(parts[0]).withColumn("label", F.col("Personality_encoded")).drop("Personality_encoded"), "label", folds=3), "folded")
    prepare = layers.enhanced_prepare(power=False, statistics=False)
    result = crossval.train_cv(rows, [], prepare=prepare, learner=learners.logistic(iterations=10))
    assert result.oof.count() == rows.count()
    features = {r["feature"] for r in result.importance.collect()}
    assert "Stage_fear_target_encoded" in features and not features & {"id", "label", "fold", "Personality_encoded"}
