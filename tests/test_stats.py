import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.operators.stats import WIDE_COLUMNS, corrected_skewness, per_column, quantiles, quantiles_of

PS = [0.0, 0.01, 0.25, 0.5, 0.737, 0.99, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    n = 3000
    frame = {
        "heavy": np.exp(rng.normal(0, 6, n)),
        "signed": rng.normal(0, 1, n) * 1e-3,
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n)).astype(float),
        "flat": np.full(n, 2.5),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.random(n)),
    }
    rows = list(zip(*[[None if math.isnan(v) else float(v) for v in col] for col in frame.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(5).cache(), frame


@pytest.mark.parametrize("one_buffer_rows", [0, 10**6])
def test_quantiles_match_numpy_on_both_paths(numbers, one_buffer_rows):
    df, frame = numbers
    got = quantiles_of(df, list(frame), PS, one_buffer_rows=one_buffer_rows)
    for name, column in frame.items():
        want = np.quantile(column[~np.isnan(column)], PS)
        assert np.allclose(got[name], want, rtol=1e-12, atol=0), name


def test_quantiles_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(None, 3.0), (None, None)], "a double, b double")
    for limit in (0, 10**6):
        assert quantiles_of(df, ["a", "b"], [0.5, 0.9], one_buffer_rows=limit) == {"a": [None, None], "b": [3.0, 3.0]}


def test_extreme_values_do_not_overflow(spark):
    df = spark.createDataFrame([(v,) for v in (-1.7e308, -1.0, 0.0, 1.0, 1.7e308)], "a double")
    assert quantiles(df, {"a": (F.col("a"), [0.25, 0.5, 0.75])}, one_buffer_rows=0) == {"a": [-1.0, 0.0, 1.0]}


def test_wide_and_long_form_agree(spark):
    names = [f"c{i}" for i in range(WIDE_COLUMNS + 4)]
    df = spark.range(50).select(*[(F.col("id") * (i + 1) % 17).cast("double").alias(n) for i, n in enumerate(names)])
    stats = {"n": F.count, "mean": F.avg, "top": F.max}
    long = per_column(df, {n: F.col(n) for n in names}, stats)
    for n in names:
        assert per_column(df, {n: F.col(n)}, stats)[n] == long[n]


def test_skewness_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "two double, flat double")
    row = df.agg(corrected_skewness(F.col("two")), corrected_skewness(F.col("flat"))).first()
    assert row[0] is None and row[1] == 0.0


def test_infinite_values_give_one_answer_on_both_paths(spark):
    inf, nan = math.inf, math.nan
    rows = [(float(i), float(i), 7.0, None) for i in range(60)] + [(inf, nan, 7.0, None), (-inf, inf, 7.0, None), (-inf, 3.5, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    wanted = {c: (F.col(c), [0.0, 0.01, 0.03, 0.25, 0.5, 0.97, 0.99, 1.0]) for c in "abcd"}
    small, large = quantiles(df, wanted), quantiles(df, wanted, one_buffer_rows=0)
    for c in "abcd":
        for x, y in zip(small[c], large[c]):
            assert (x is None and y is None) or x == y or (math.isnan(x) and math.isnan(y)) or abs(x - y) < 1e-9
