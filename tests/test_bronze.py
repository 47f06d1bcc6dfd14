import pytest
from conftest import RAW, values
from pyspark.sql import functions as F

from tierwise.operators import bronze, isolation, outliers
from tierwise.plans import layers
from tierwise.spec import DEFAULT as SPEC


def test_yes_no_spellings(survey):
    got = values(bronze.encode_yes_no(survey), "Stage_fear_encoded")
    assert got == {1: 0.0, 2: 1.0, 3: 0.0, 4: None, 5: 1.0, 6: None, 7: 1.0, 8: 0.0, 9: 1.0, 10: None, 11: 0.0, 12: 1.0}


def test_types_turn_odd_numbers_into_missing(spark):
    rows = [(1, float("nan"), 1, "x"), (2, float("inf"), 2, None), (3, 2.5, None, "y")]
    df = spark.createDataFrame(rows, "id bigint, Going_outside double, Post_frequency int, Stage_fear string")
    out = bronze.normalise_types(df)
    assert values(out, "Going_outside") == {1: None, 2: None, 3: 2.5}
    assert dict(out.dtypes) == {"id": "bigint", "Going_outside": "double", "Post_frequency": "double", "Stage_fear": "string"}


def test_missing_flags_keep_the_gaps(survey):
    encoded = bronze.encode_yes_no(survey)
    out = bronze.missing_flags(encoded)
    assert values(out, "both_missing")[10] == 1 and sum(values(out, "both_missing").values()) == 1
    assert values(out, "Going_outside_missing")[6] == 1
    assert values(out, "Going_outside")[6] is None
    assert out.count() == survey.count()


def test_absent_columns_are_left_out(survey):
    few = survey.select("id", "Time_spent_Alone")
    assert bronze.encode_yes_no(few).columns == few.columns
    assert bronze.missing_flags(few).columns == [*few.columns, "Time_spent_Alone_missing"]
    patterns = bronze.missing_patterns(few, bronze.fit_missing_patterns(few))
    assert patterns.columns == [*few.columns, "Time_spent_Alone_missing"]
    assert bronze.impute_across(few, bronze.fit_cross_imputation(few)).columns == few.columns


def test_conditional_flags(spark):
    rows = [(i, float(2 + i % 4), 5.0, 3.0, 4.0, 3.0, "No", "No", "Extrovert") for i in range(1, 11)]
    rows += [(20, 20.0, None, 3.0, 4.0, 3.0, None, "No", "Introvert"), (21, 3.0, 5.0, 3.0, None, 20.0, None, None, "Introvert")]
    df = bronze.encode_yes_no(spark.createDataFrame(rows, RAW))
    out = bronze.missing_patterns(df, bronze.fit_missing_patterns(df))
    assert values(out, "extreme_introvert_missing")[20] == 1
    assert values(out, "online_social_missing")[21] == 1
    assert values(out, "social_anxiety_partial_missing")[20] == 1
    assert values(out, "social_anxiety_complete_missing")[21] == 1
    for c in [c for c in out.columns if c.endswith("_missing")]:
        assert set(values(out, c).values()) <= {0, 1}


def pairs(spark, linked):
    rows = [(i, 1.0, 1.0, 1.0, 1.0, 1.0, "Yes" if i % 2 else "No", ("Yes" if linked(i) else "No"), "Extrovert") for i in range(40)]
    rows += [(100, 1.0, 1.0, 1.0, 1.0, 1.0, None, "Yes", "Extrovert"), (101, 1.0, 1.0, 1.0, 1.0, 1.0, "No", None, "Extrovert")]
    return bronze.encode_yes_no(spark.createDataFrame(rows, RAW))


@pytest.mark.parametrize(
    "linked, fear, drained",
    [(lambda i: i % 2 == 1, 1.0, 0.0), (lambda i: i % 2 == 0, 0.0, 1.0), (lambda i: i % 4 < 2, None, None)],
)
def test_answers_fill_each_other_by_correlation(spark, linked, fear, drained):
    df = pairs(spark, linked)
    out = bronze.impute_across(df, bronze.fit_cross_imputation(df))
    assert values(out, "Stage_fear")[100] == fear
    assert values(out, "Drained_after_socializing")[101] == drained


def test_few_pairs_are_not_enough(spark):
    df = pairs(spark, lambda i: i % 2 == 1).where("id >= 30")
    assert bronze.fit_cross_imputation(df)["partner"] is None


def test_winsorise_skips_mostly_missing_columns(spark):
    rows = [(i, float(i), 1.0 if i < 40 else None) for i in range(101)]
    df = spark.createDataFrame(rows, "id bigint, Time_spent_Alone double, Going_outside double")
    fitted = bronze.fit_winsorise(df)
    assert list(fitted) == ["Time_spent_Alone"]
    got = values(bronze.winsorise(df, fitted), "Time_spent_Alone")
    assert got[0] == 1.0 and got[100] == 99.0 and got[50] == 50.0


def test_quick_clean_fills_and_drops(survey):
    out = bronze.quick_clean(survey, bronze.fit_quick(survey))
    assert "Stage_fear" not in out.columns
    assert values(out, "Stage_fear_encoded")[2] == 1 and values(out, "Stage_fear_encoded")[9] == 0
    assert values(out, "Time_spent_Alone")[3] == 5.0


def test_domain_flags(spark):
    rows = [(1, 25.0, 1500.0, 150.0), (2, -1.0, 5.0, 5.0), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, Time_spent_Alone double, Friends_circle_size double, Post_frequency double")
    out = outliers.flag_outliers(df, outliers.fit_outliers(df))
    names = ["time_alone_extreme", "time_alone_negative", "friends_extreme", "post_frequency_extreme"]
    assert {r["id"]: [r[n] for n in names] for r in out.collect()} == {1: [1, 0, 1, 1], 2: [0, 1, 0, 0], 3: [0, 0, 0, 0]}


def test_constant_column_has_no_zscore_and_no_division(spark):
    df = spark.createDataFrame([(i, 3.0) for i in range(20)] + [(99, None)], "id bigint, Going_outside double")
    out = outliers.flag_outliers(df, outliers.fit_outliers(df))
    assert "Going_outside_zscore" not in out.columns
    assert set(values(out, "Going_outside_outlier_score").values()) == {0.0}


def test_isolation_forest_finds_the_far_rows(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(400)] + [(1000 + i, 500.0 + i, -300.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, Time_spent_Alone double, Going_outside double")
    fitted = isolation.fit_forest(df, trees=30, contamination=0.0125)
    one = values(isolation.score_forest(df.repartition(1), fitted), "isolation_forest_score")
    again = isolation.fit_forest(df.repartition(7), trees=30, contamination=0.0125)
    seven = values(isolation.score_forest(df.repartition(7), again), "isolation_forest_score")
    assert one == seven
    worst = sorted(one, key=one.get)[:5]
    assert set(worst) == {1000, 1001, 1002, 1003, 1004}
    flags = values(isolation.score_forest(df, fitted), "isolation_forest_outlier")
    assert set(flags.values()) == {0, 1} and all(flags[i] == 1 for i in worst)


def test_forest_needs_two_measures(spark):
    df = spark.createDataFrame([(1, 2.0)], "id bigint, Going_outside double")
    out = isolation.score_forest(df, isolation.fit_forest(df)).first()
    assert (out["isolation_forest_outlier"], out["isolation_forest_score"]) == (0, 0.0)


def test_fold_safe_and_unseen(survey):
    out = bronze.fold_safe_bronze(survey)
    assert values(out, "Stage_fear_missing")[6] == 1
    seen = bronze.fit_categories(survey.where("id <= 6"))
    unseen = {r["value"] for r in bronze.unseen_categories(survey.where("id > 6"), seen).collect() if r["column"] == "Stage_fear"}
    assert unseen == {"y", "False", "yes", "no"}


def test_train_statistics_apply_to_other_rows(survey):
    fitted = layers.fit_bronze(survey.where("id <= 8"))
    out = layers.apply_bronze(survey.where("id > 8"), fitted)
    top = fitted["winsorise"]["Time_spent_Alone"][1]
    assert all(v <= top for v in values(out, "Time_spent_Alone").values())
    assert SPEC.id in out.columns and out.count() == 4


def test_empty_table(survey):
    none = survey.where(F.lit(False))
    out = layers.apply_bronze(none, layers.fit_bronze(none))
    assert out.count() == 0
