import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from tierwise.operators import binning


def test_bins_at_edges_ties_infinities_and_gaps(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "id bigint, x double")
    edges = binning.fit_bins(df, ["x"], bins=4)
    assert edges == {"x": [25.75, 50.5, 75.25]}
    odd = spark.createDataFrame([(1, 25.75), (2, 25.76), (3, math.inf), (4, -math.inf), (5, None), (6, -5.0), (7, 75.25)], "id bigint, x double")
    assert values(binning.bin_columns(odd, edges), "x_bin") == {1: 0, 2: 1, 3: 3, 4: 0, 5: -1, 6: 0, 7: 2}


def test_equal_edges_are_merged(spark):
    tied = spark.createDataFrame([(i, 0.0 if i < 90 else float(i)) for i in range(100)], "id bigint, x double")
    edges = binning.fit_bins(tied.withColumn("none", F.lit(None).cast("double")), ["x", "none"])
    assert edges["x"] == [0.0, pytest.approx(9.0)] and edges["none"] == []
    got = values(binning.bin_columns(tied, edges), "x_bin")
    assert got[0] == 0 and got[95] == 2
    assert set(values(binning.bin_columns(tied.withColumn("none", F.lit(1.0)), edges), "none_bin").values()) == {0}
    assert binning.fit_bins(tied, ["x"], bins=1) == {"x": []}
    with pytest.raises(ValueError):
        binning.fit_bins(tied, ["x"], bins=0)


def test_robust_scaling(spark):
    df = spark.createDataFrame([(i, float(i), 3.0) for i in range(101)] + [(200, None, 3.0)], "id bigint, x double, flat double")
    fitted = binning.fit_robust(df, ["x", "flat"])
    assert fitted == {"x": [50.0, 50.0]}
    got = values(binning.robust_scale(df, fitted), "x_robust")
    assert got[0] == -1.0 and got[75] == 0.5 and got[200] is None
    far = spark.createDataFrame([(1, 1e9), (2, -1e9)], "id bigint, x double")
    assert values(binning.robust_scale(far, fitted, limit=3.0), "x_robust") == {1: 3.0, 2: -3.0}


@pytest.mark.parametrize("bound", [1000, 0])
def test_rare_and_unseen_categories(spark, bound):
    """A hot value, many single ones, gaps; also with the table joined by shuffle."""
    rows = [(i, "hot" if i % 3 else (None if i % 2 else f"one{i}"), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, kind string, flag int")
    frequent = binning.fit_frequent(df, ["kind", "flag"], least=5)
    assert {(r["column"], r["value"]) for r in frequent.collect()} == {("kind", "hot"), ("flag", "0"), ("flag", "1")}
    other = df.unionByName(spark.createDataFrame([(900, "new", 7)], df.schema))
    out = binning.group_rare(other, frequent, ["kind", "flag"], id_col="id", broadcast_rows=bound)
    got, flags = values(out, "kind_grouped"), values(out, "flag_grouped")
    assert got[1] == "hot" and got[6] == "__rare__" and got[3] is None and got[900] == "__rare__"
    assert flags[1] == "1" and flags[900] == "__rare__" and out.count() == 301
    assert binning.group_rare(other, frequent.limit(0), ["kind"]).where("kind_grouped = '__rare__'").count() == other.where("kind is not null").count()
