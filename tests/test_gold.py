import math

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tierwise.operators import bronze, gold
from tierwise.plans import layers


def test_clean_limits_fills_and_leaves_the_id(spark):
    rows = [(i, float(i % 10)) for i in range(100)] + [(1000, 1000.0), (1001, -1000.0), (1002, None), (1003, float("inf")), (1004, float("nan"))]
    df = spark.createDataFrame(rows, "id bigint, x double")
    got = values(gold.clean(df, gold.fit_clean(df)), "x")
    assert max(got.values()) < 1000 and min(got.values()) > -1000
    assert got[1002] == got[1003] == got[1004] == 4.5
    assert max(got) == 1004


def test_a_rare_flag_survives_unless_asked_otherwise(spark):
    df = spark.createDataFrame([(i, float(i < 5)) for i in range(100)] + [(500, None)], "id bigint, flag double")
    assert values(gold.clean(df, gold.fit_clean(df)), "flag")[0] == 1.0
    assert values(gold.clean(df, gold.fit_clean(df, compat=True)), "flag")[0] == 0.0
    assert values(gold.clean(df, gold.fit_clean(df)), "flag")[500] == 0.0


def test_fill_is_the_median_after_clipping(spark):
    x = [0.0] * 10 + [1e6] * 11 + [None]
    df = spark.createDataFrame(list(enumerate(x)), "id bigint, x double")
    fitted = gold.fit_clean(df)
    clipped = np.clip([v for v in x if v is not None], fitted["x"]["low"], fitted["x"]["high"])
    assert fitted["x"]["fill"] == np.median(clipped)


def test_column_without_values_stays_missing(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "id bigint, none double, x double")
    assert values(gold.clean(df, gold.fit_clean(df)), "none") == {1: None, 2: None}


@pytest.fixture(scope="module")
def linked(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=200)
    rows = [
        (i, float(b), float(0.8 * b + 0.6 * rng.normal()), float(rng.normal()), "Extrovert" if b > 0.1 else "Introvert", None)
        for i, b in enumerate(base)
    ]
    return spark.createDataFrame(rows, "id bigint, one double, two double, noise double, Personality string, word string")


@pytest.mark.parametrize("method", ["statistical", "mutual_info", "combined"])
def test_selection_prefers_what_carries_the_label(linked, method):
    assert gold.select_features(linked, k=2, method=method) == ["one", "two"]


def test_selection_returns_all_when_few(linked):
    assert gold.select_features(linked, k=3) == ["one", "two", "noise"]
    with pytest.raises(ValueError):
        gold.select_features(linked, k=1, method="guess")


def test_f_score_of_a_perfect_split(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (1.0, 5.0, 0), (2.0, 5.0, 1), (2.0, 5.0, 1)], "x double, flat double, y int")
    assert gold.anova_scores(df, ["x", "flat"], F.col("y")) == {"x": math.inf, "flat": 0.0}


def test_label_is_required(survey):
    with pytest.raises(ValueError):
        gold.model_columns(survey.drop("Personality"))


def test_default_list_has_each_column_once(survey):
    encoded = bronze.encode_yes_no(survey)
    names = gold.default_features(layers.apply_silver(encoded, layers.fit_silver(encoded)))
    assert len(names) == len(set(names)) and "Personality_encoded" not in names and len(names) == 26 + 55


def test_test_table_gets_the_train_columns_and_limits(survey):
    train, test = survey.where("id <= 8"), survey.where("id > 8").drop("Personality")
    fitted = gold.fit_gold(train, k=4)
    a, b = gold.apply_gold(train, fitted), gold.apply_gold(test, fitted)
    assert len(fitted["features"]) == 4
    assert a.columns == [*b.columns, "Personality", "Personality_encoded"]
    assert values(b, "id").keys() == {9, 10, 11, 12}
