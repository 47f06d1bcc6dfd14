import math

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tierwise.operators import encode


def likelihood(x, lam):
    y = np.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam
    return -len(x) / 2 * math.log(y.var()) + (lam - 1) * np.log1p(x).sum()


@pytest.mark.parametrize("few_values", [encode.FEW_VALUES, 0])
def test_lambda_is_the_likelihood_peak(spark, monkeypatch, few_values):
    monkeypatch.setattr(encode, "FEW_VALUES", few_values)
    rng = np.random.default_rng(0)
    x = np.round(rng.gamma(1.2, 4.0, 500), 2)
    df = spark.createDataFrame([(float(v), float(i % 2)) for i, v in enumerate(x)], "x double, even double")
    got = encode.fit_power(df)
    assert list(got) == ["x"]
    grid = np.arange(got["x"] - 0.05, got["x"] + 0.05, 0.0005)
    best = grid[np.argmax([likelihood(x, g) for g in grid])]
    assert got["x"] == pytest.approx(best, abs=1e-3)


def test_lambda_beyond_the_first_grid(spark):
    df = spark.createDataFrame([(float(1 - (i / 100) ** 6),) for i in range(100)], "x double")
    assert encode.fit_power(df)["x"] > 4


def test_yeo_johnson_special_cases(spark):
    df = spark.createDataFrame([(1, 3.0), (2, -3.0), (3, None)], "id bigint, v double")
    for lam, up, down in ((0.0, math.log(4), -(4**2 - 1) / 2), (2.0, (16 - 1) / 2, -math.log(4)), (1.0, 3.0, -3.0)):
        got = values(encode.power_transform(df, {"v": lam}), "v_power")
        assert got[1] == pytest.approx(up) and got[2] == pytest.approx(down) and got[3] is None


@pytest.fixture(scope="module")
def answers(spark):
    rows = [(i, "a" if i < 20 else ("b" if i < 24 else None), int(i % 4 == 0), i % 3) for i in range(30)]
    return spark.createDataFrame(rows, "id bigint, c string, y int, fold int")


def smooth(ys, prior):
    w = 1 / (1 + math.exp(-(len(ys) - 10)))
    return prior * (1 - w) + sum(ys) / len(ys) * w


def test_target_means_and_unseen(answers, spark):
    means = encode.fit_target_means(answers, F.col("y"), columns=["c"])
    prior = 8 / 30
    got = values(encode.target_encode(answers, means), "c_target_encoded")
    assert got[0] == pytest.approx(smooth([1, 0, 0, 0] * 5, prior))
    assert got[29] == pytest.approx(smooth([1, 0, 0, 0, 1, 0], prior))
    new = spark.createDataFrame([(1, "zzz")], "id bigint, c string")
    assert values(encode.target_encode(new, means), "c_target_encoded")[1] == pytest.approx(prior)


def test_target_encoding_needs_a_label(answers):
    with pytest.raises(ValueError):
        encode.fit_target_means(answers, None)


def test_out_of_fold_uses_the_other_folds_only(answers):
    rows = answers.collect()
    got = values(encode.target_encode_out_of_fold(answers, F.col("y"), ["c"]), "c_target_encoded")
    for r in rows:
        rest = [s for s in rows if s["fold"] != r["fold"]]
        prior = sum(s["y"] for s in rest) / len(rest)
        same = [s["y"] for s in rest if s["c"] == r["c"]]
        assert got[r["id"]] == pytest.approx(smooth(same, prior) if same else prior)


def test_noise_is_repeatable_and_small(answers):
    means = encode.fit_target_means(answers, F.col("y"), columns=["c"])
    one = values(encode.target_encode(answers.repartition(1), means, noise=0.01), "c_target_encoded")
    five = values(encode.target_encode(answers.repartition(5), means, noise=0.01), "c_target_encoded")
    assert one == five and len(set(one.values())) == 30


def test_codes_are_sorted_and_missing_is_minus_one(answers):
    out = encode.encode_codes(answers, encode.fit_codes(answers, ["c"]), ["c"], "id")
    got = values(out, "c_encoded")
    assert (got[0], got[22], got[29]) == (0, 1, -1)


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert encode.fit_modes(df, ["c"]) == {"c": "a"}
