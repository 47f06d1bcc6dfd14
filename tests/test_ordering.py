import hashlib

import pytest
from pyspark.sql import functions as F

from tierwise.operators import ordering
from tierwise.operators.lookup import lookup


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(1, 1001).select("id", F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("kind"))


def in_hash_order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}#{seed}".encode()).hexdigest(), i))


def test_sample_is_exact_and_does_not_depend_on_partitions(people):
    for n in (0, 1, 7, 333, 1000, 5000):
        want = set(in_hash_order(range(1, 1001))[:n])
        for parts in (1, 8):
            got = [r["id"] for r in ordering.seeded_sample(people.repartition(parts), n).collect()]
            assert len(got) == len(want) and set(got) == want


def test_folds_deal_each_class_out_in_turn(people):
    one, eight = (
        {r["id"]: r["fold"] for r in ordering.stratified_folds(people.repartition(p), "kind", digits=d).collect()}
        for p, d in ((1, 4), (8, 2))
    )
    assert one == eight
    for kind, ids in (("b", range(5, 1001, 5)), ("a", [i for i in range(1, 1001) if i % 5])):
        assert [one[i] for i in in_hash_order(ids)] == [i % 5 for i in range(len(list(ids)))]


def test_running_totals_per_key(spark):
    rows = [("x", float(v), 1 + v % 3) for v in range(200)] + [("y", 1.0, 4), (None, 2.0, 5), (None, 3.0, 6)]
    df = spark.createDataFrame(rows, "k string, v double, n bigint").repartition(6)
    got = {(r["k"], r["v"]): r["n_before"] for r in ordering.running_totals(df, ["k"], "v", ["n"]).collect()}
    for k in ("x", "y", None):
        total = 0
        for _, v, n in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            assert got[k, v] == total
            total += n


def test_percent_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 3.0), (4, None), (5, 9.0)], "id bigint, v double")
    got = {r["id"]: r["v_percentile"] for r in ordering.percent_ranks(df, ["v"], id_col="id").collect()}
    assert got == {1: 0.625, 2: 0.25, 3: 0.625, 4: None, 5: 1.0}


def test_lookup_paths_agree_with_a_hot_key_and_a_missing_key(spark):
    rows = [(i, "hot" if i % 3 else (None if i % 2 else f"k{i % 40}")) for i in range(600)] + [(999, "unseen")]
    df = spark.createDataFrame(rows, "id bigint, k string")
    table = df.where("coalesce(k, '') <> 'unseen'").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    small = {r["id"]: r["first"] for r in lookup(df, table, "k", "n").collect()}
    salted = {r["id"]: r["first"] for r in lookup(df, table, "k", "n", spread="id", broadcast_rows=0, hot_share=50).collect()}
    assert len(small) == 601 and small == salted
    assert small[999] is None and small[0] == 0


def test_lookup_spreads_null_and_unseen_keys(spark):
    rows = [(i, None if i % 3 == 0 else "new" if i % 3 == 1 else f"k{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, k string")
    table = spark.createDataFrame([(f"k{i}", 1, i) for i in range(2, 6000, 3)], "k string, n bigint, code int")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(df, table, "k", "n", spread="id", broadcast_rows=0)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        codes = {r["id"]: r["code"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert codes == {i: i if i % 3 == 2 else None for i in range(6000)}
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_fold_overlap_sees_a_shared_id(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (1, 1), (4, 2)], "id bigint, fold int")
    got = {r["fold"]: (r["train_rows"], r["valid_rows"], r["overlap"], r["valid"]) for r in ordering.fold_overlap(df).collect()}
    assert got == {0: (3, 2, 1, 0), 1: (3, 2, 1, 0), 2: (4, 1, 0, 1)}


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 0.5)], "f string, s double")
    assert [r["f"] for r in ordering.top_k(df, "s", 2, "f").collect()] == ["a", "b"]
