"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions import rows
from tierwise.functions.columns import finite, zero_if_missing
from tierwise.models import boosting, crossval, learners, search
from tierwise.operators import (
    binning,
    bronze,
    correlation,
    drift,
    encode,
    gold,
    isolation,
    metrics,
    neighbours,
    ordering,
    outliers,
    quality,
    ranks,
    silver,
    stats,
)
from tierwise.plans import layers
from tierwise.runtime import durable, scratch_root
from tierwise.sources import experiments, results, runlog
from tierwise.sources.layers import LayerStore
from tierwise.sources.profile import order_profile, split_profile, table
from tierwise.spec import DEFAULT, DRAINED, FEAR, numeric_columns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEC = DEFAULT
MEASURES = SPEC.measures
ALONE, SOCIAL, OUTSIDE, FRIENDS, POSTS = MEASURES


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---- inputs -----------------------------------------------------------------


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.encode_yes_no(order_profile(spark, folder))


def stored(df: DataFrame) -> DataFrame:
    """Input of several passes."""
    return durable(df, "input")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, Personality, label, p, predicted): a fixed score of two measures."""
    profile = order_profile(spark, folder)
    weight = F.coalesce(F.col(OUTSIDE), F.lit(0.0)) + 3 * F.coalesce(F.col(FRIENDS), F.lit(0.0))
    scored = profile.select("id", "Personality", gold.label_value(profile).alias("label"), weight.alias("w"))
    scored = scored.select("id", "Personality", "label", (F.col("w") / (F.col("w") + F.lit(150.0))).alias("p"))
    return scored.withColumn("predicted", metrics.predicted_class(F.col("p")))


def folded_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.stratified_folds(predictions(spark, folder), "Personality")


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None) -> DataFrame:
    """Doubles rounded, for values whose last digits depend on summation order."""
    chosen = set(only) if only is not None else {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in chosen else F.col(c) for c in df.columns])




def learned(spark: SparkSession, values: dict[str, float | None], key: str, value: str, digits: int = 6) -> DataFrame:
    """What a fit returned, one row per entry (bounded by the number of columns)."""
    frame = spark.createDataFrame([(k, float(v) if v is not None else None) for k, v in values.items()], f"{key} string, {value} double")
    return rounded(frame, digits)


# ---- scans, types, layers ---------------------------------------------------


@query
def raw_scan(spark, folder):
    return order_profile(spark, folder)


@query
def raw_split(spark, folder):
    train, test = split_profile(order_profile(spark, folder))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).groupBy("part", "Personality").agg(F.count("*").alias("n"))


def _with_odd_numbers(profile: DataFrame) -> DataFrame:
    odd = (
        F.when(F.col("id") % 7 == 0, F.lit(float("nan")))
        .when(F.col("id") % 11 == 0, F.lit(float("inf")))
        .when(F.col("id") % 13 == 0, F.lit(float("-inf")))
        .otherwise(F.col(OUTSIDE))
    )
    return profile.withColumn(OUTSIDE, odd)


@query
def type_normalise(spark, folder):
    return bronze.normalise_types(_with_odd_numbers(order_profile(spark, folder)))


@query
def infinite_to_missing(spark, folder):
    odd = _with_odd_numbers(order_profile(spark, folder))
    return odd.select("id", finite(F.col(OUTSIDE)).alias("as_missing"), zero_if_missing(F.col(OUTSIDE)).alias("as_zero"))


def _store(spark: SparkSession, folder: str) -> LayerStore:
    import uuid

    store = LayerStore(spark, f"{scratch_root(spark)}/layers-{uuid.uuid4().hex[:12]}")
    train, test = split_profile(order_profile(spark, folder))
    store.write("raw", "train", train)
    store.write("raw", "test", test)
    return store


@query
def bronze_layer(spark, folder):
    store = _store(spark, folder)
    layers.build_bronze(store)
    train, test = store.load("bronze")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def silver_on_demand(spark, folder):
    """Asking for silver builds the missing bronze layer first."""
    store = _store(spark, folder)
    train, test = store.require("silver", layers.build_silver)
    columns = ["id", "extrovert_score", "social_ratio", "triple_interaction", "social_percentage", "poly_social_ratio_pow_2"]
    return train.select(*columns).unionByName(test.select(*columns))


@query
def gold_layer(spark, folder):
    store = _store(spark, folder)
    layers.build_gold(store)
    train, test = store.load("gold")
    return train.select("id", "Personality_encoded").unionByName(test.select("id", F.lit(None).cast("int").alias("Personality_encoded")))


@query
def submission_csv(spark, folder):
    path = f"{durable_folder(spark)}/submission"
    scored = predictions(spark, folder)
    results.write_csv(results.submission_for(order_profile(spark, folder), scored, "p"), path)
    return results.read_csv(spark, path, "id bigint, Personality string")


def durable_folder(spark: SparkSession) -> str:
    import uuid

    return f"{scratch_root(spark)}/files-{uuid.uuid4().hex[:12]}"


@query
def fold_scores_csv(spark, folder):
    path = f"{durable_folder(spark)}/folds"
    results.write_csv(rounded(metrics.accuracy(folded_predictions(spark, folder), "label", "predicted", ["fold"])), path)
    return results.read_csv(spark, path, "fold int, accuracy double")


@query
def cv_record_json(spark, folder):
    path = f"{durable_folder(spark)}/cv"
    scores = metrics.accuracy(folded_predictions(spark, folder), "label", "predicted", ["fold"]).orderBy("fold")
    values = [r["accuracy"] for r in scores.collect()]  # one per fold
    results.write_json(results.cv_record(spark, "boosted", {"n_splits": 5, "seed": 42}, values, 12.5), path)
    back = results.read_json(spark, path, results.CV_RECORD)
    return rounded(
        back.select(
            "model_type",
            F.size("fold_scores").alias("folds"),
            F.element_at("cv_config", "n_splits").alias("n_splits"),
            "training_time",
            "mean_score",
            "std_score",
            "min_score",
            "max_score",
            "median_score",
        )
    )


@query
def seeded_sample(spark, folder):
    return ordering.seeded_sample(order_profile(spark, folder), 2500).select("id", "Personality")


# ---- projections and filters ------------------------------------------------


@query
def model_columns(spark, folder):
    df, _ = gold.model_columns(gold.encode_label(encoded(spark, folder)))
    return df


@query
def drop_missing(spark, folder):
    return order_profile(spark, folder).where(F.col(SOCIAL).isNotNull()).groupBy("Personality").agg(F.count("*").alias("n"))


@query
def threshold_class(spark, folder):
    return predictions(spark, folder).select("id", "predicted")


@query
def fold_subset(spark, folder):
    df = ordering.stratified_folds(order_profile(spark, folder), "Personality")
    train, valid = crossval.fold_parts(df, 2)
    both = train.withColumn("side", F.lit("train")).unionByName(valid.withColumn("side", F.lit("valid")))
    return both.groupBy("side", "Personality").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


# ---- quality and aggregates -------------------------------------------------


@query
def quality_metrics(spark, folder):
    return quality.quality_metrics(order_profile(spark, folder))


@query
def duplicate_rows(spark, folder):
    return quality.duplicate_rows(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


@query
def range_checks(spark, folder):
    return quality.range_checks(bronze.normalise_types(order_profile(spark, folder)))


@query
def range_checks_complete(spark, folder):
    """The same guards where nothing is missing."""
    profile = order_profile(spark, folder)
    return quality.range_checks(profile.select("id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in MEASURES]))


@query
def quantile_table(spark, folder):
    ps = [0.01, 0.2, 0.25, 0.5, 0.75, 0.7, 0.8, 0.99]
    got = stats.quantiles_of(stored(order_profile(spark, folder)), MEASURES, ps)
    lines = [(c, p, v) for c in MEASURES for p, v in zip(ps, got[c])]
    return rounded(spark.createDataFrame(lines, "column_name string, p double, value double"))


@query
def line_item_quantiles(spark, folder):
    """Quantiles of continuous columns, by narrowing whatever the size."""
    names = ["l_extendedprice", "l_discount", "l_quantity"]
    got = stats.quantiles_of(table(spark, folder, "lineitem"), names, [0.25, 0.5, 0.99], one_buffer_rows=0)
    lines = [(c, p, v) for c in names for p, v in zip([0.25, 0.5, 0.99], got[c])]
    return rounded(spark.createDataFrame(lines, "column_name string, p double, value double"), 4)


@query
def medians(spark, folder):
    return learned(spark, bronze.fit_quick(stored(order_profile(spark, folder))), "column_name", "median")


@query
def sample_moments(spark, folder):
    got = stats.mean_and_std(order_profile(spark, folder), MEASURES)
    return rounded(spark.createDataFrame([(c, *v) for c, v in got.items()], "column_name string, mean double, std double"))


@query
def population_moments(spark, folder):
    got = stats.mean_and_std(order_profile(spark, folder), MEASURES, population=True)
    return rounded(spark.createDataFrame([(c, *v) for c, v in got.items()], "column_name string, mean double, std double"))


@query
def answer_correlation(spark, folder):
    df = encoded(spark, folder)
    return rounded(df.agg(F.corr(FEAR, DRAINED).alias("r"), F.count_if(F.col(FEAR).isNotNull() & F.col(DRAINED).isNotNull()).alias("pairs")), 4)


@query
def skewness_table(spark, folder):
    got = stats.per_column(order_profile(spark, folder), {c: F.col(c) for c in MEASURES}, {"skew": stats.corrected_skewness})
    return learned(spark, {c: s["skew"] for c, s in got.items()}, "column_name", "skew", 4)


@query
def column_maximum(spark, folder):
    return order_profile(spark, folder).agg(F.max(SOCIAL).alias("social_max"))


@query
def category_values(spark, folder):
    return bronze.fit_categories(order_profile(spark, folder)).withColumnRenamed("column", "column_name")


@query
def category_modes(spark, folder):
    modes = encode.fit_modes(order_profile(spark, folder), [FEAR, DRAINED, "Personality"])
    return spark.createDataFrame(sorted(modes.items()), "column_name string, mode string")


@query
def label_distribution(spark, folder):
    df = order_profile(spark, folder)
    return rounded(quality.label_distribution(df, gold.label_value(df)))


@query
def label_summary(spark, folder):
    df = order_profile(spark, folder)
    return quality.label_summary(df, gold.label_value(df))


@query
def prediction_distribution(spark, folder):
    return rounded(metrics.prediction_distribution(predictions(spark, folder), "predicted"))


@query
def integrity_checks(spark, folder):
    df = encoded(spark, folder)
    return quality.integrity_checks(df.withColumn("label", gold.label_value(df)), [*MEASURES, FEAR, DRAINED])


@query
def accuracy(spark, folder):
    return rounded(metrics.accuracy(predictions(spark, folder), "label", "predicted"))


@query
def roc_auc(spark, folder):
    return rounded(metrics.auc(predictions(spark, folder), "label", "p"))


@query
def fold_auc(spark, folder):
    return rounded(metrics.auc(folded_predictions(spark, folder), "label", "p", ["fold"]))


@query
def metric_bundle(spark, folder):
    return rounded(metrics.evaluate(stored(predictions(spark, folder)), "label", "predicted", "p"))


@query
def fold_score_summary(spark, folder):
    scores = metrics.accuracy(folded_predictions(spark, folder), "label", "predicted", ["fold"])
    return rounded(metrics.score_summary(scores, "accuracy"))


def _fold_importances(spark, folder) -> DataFrame:
    """Per fold, |correlation| of each measure with the label."""
    df = ordering.stratified_folds(order_profile(spark, folder), "Personality")
    y = gold.label_value(df).cast("double")
    wide = df.groupBy("fold").agg(*[F.abs(F.corr(F.col(c), y)).alias(c) for c in MEASURES])
    parts = [wide.select("fold", F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in MEASURES]
    return reduce(DataFrame.unionByName, parts)


@query
def importance_summary(spark, folder):
    return rounded(metrics.importance_summary(_fold_importances(spark, folder)))


@query
def importance_union(spark, folder):
    return rounded(_fold_importances(spark, folder))


@query
def success_criteria(spark, folder):
    scores = metrics.accuracy(folded_predictions(spark, folder), "label", "predicted", ["fold"])
    one = stored(metrics.score_summary(scores, "accuracy").withColumns({"training_time": F.lit(100.0), "data_integrity": F.lit(True), "search_score": F.lit(0.971)}))
    parts = [metrics.success_criteria(one, name).withColumn("profile", F.lit(name)) for name in metrics.CRITERIA]
    return reduce(DataFrame.unionByName, parts)


def _runs(spark, folder) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(F.col("event_type").alias("workflow"), "ts", F.col("value").alias("duration"))


@query
def workflow_stats(spark, folder):
    return rounded(runlog.workflow_stats(_runs(spark, folder)), 4)


@query
def workflow_estimates(spark, folder):
    return rounded(runlog.estimated_durations(runlog.workflow_stats(_runs(spark, folder))), 4)


@query
def workflow_listing(spark, folder):
    return runlog.workflows(_runs(spark, folder))


@query
def workflow_removal(spark, folder):
    path = f"{durable_folder(spark)}/runs"
    _runs(spark, folder).write.parquet(path)
    runlog.clear_workflow(spark, path, "click")
    return runlog.read_runs(spark, path).groupBy("workflow").agg(F.count("*").alias("n"))


@query
def workflow_latest_runs(spark, folder):
    return runlog.latest_runs(_runs(spark, folder)).groupBy("workflow").agg(F.count("*").alias("n"), F.min("ts").cast("string").alias("oldest"))


# ---- row statistics, ranks, order -------------------------------------------


@query
def row_statistics(spark, folder):
    df = order_profile(spark, folder)
    low, high = rows.row_min(MEASURES), rows.row_max(MEASURES)
    return rounded(
        df.select(
            "id",
            rows.row_sum(MEASURES).alias("row_sum"),
            rows.row_mean(MEASURES).alias("row_mean"),
            rows.row_std(MEASURES).alias("row_std"),
            low.alias("row_min"),
            high.alias("row_max"),
            (high - low).alias("row_range"),
        ),
        only=["row_mean", "row_std"],
    )


@query
def row_moments(spark, folder):
    return rounded(rows.with_row_moments(order_profile(spark, folder), MEASURES).select("id", *[f"row_{s}" for s in ("mean", "std", "skew", "kurtosis", "q25", "q75", "iqr")]))


@query
def percent_rank(spark, folder):
    out = encode.key_percentiles(order_profile(spark, folder))
    return rounded(out.select("id", *[f"{c}_percentile" for c in encode.key_columns()]), 8)


@query
def top_k_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.top_k(orders.withColumn("o_orderkey", F.col("o_orderkey")), "o_totalprice", 50, "o_orderkey")


@query
def first_rows(spark, folder):
    return ordering.first_rows(order_profile(spark, folder), 100).select("id", "Personality")


@query
def label_value_set(spark, folder):
    df = order_profile(spark, folder)
    values = F.array_sort(F.collect_set(gold.label_value(df)))
    return df.agg(values.alias("v")).select((F.col("v") == F.array(F.lit(0), F.lit(1))).alias("is_binary"))


# ---- bronze -----------------------------------------------------------------


@query
def yes_no_encode(spark, folder):
    return encoded(spark, folder).select("id", FEAR, DRAINED, f"{FEAR}_encoded", f"{DRAINED}_encoded")


@query
def missing_flags(spark, folder):
    df = bronze.missing_flags(encoded(spark, folder))
    return df.select("id", *[c for c in df.columns if c.endswith("_missing")])


@query
def missing_patterns(spark, folder):
    df = stored(encoded(spark, folder))
    out = bronze.missing_patterns(df, bronze.fit_missing_patterns(df))
    return out.select("id", *[c for c in out.columns if c.endswith("_missing")])


@query
def cross_imputation(spark, folder):
    df = stored(encoded(spark, folder))
    return bronze.impute_across(df, bronze.fit_cross_imputation(df)).select("id", *MEASURES, FEAR, DRAINED)


@query
def isolation_forest(spark, folder):
    df = stored(encoded(spark, folder))
    scored = isolation.score_forest(df, isolation.fit_forest(df))
    return scored.select("id", "isolation_forest_outlier", F.round("isolation_forest_score", 6).alias("isolation_forest_score"))


@query
def fence_outliers(spark, folder):
    df = stored(order_profile(spark, folder))
    fitted = outliers.fit_outliers(df)
    new = {k: v for c, s in fitted.items() for k, v in outliers.fence_columns(c, s).items()}
    return rounded(df.select("id", *[v.alias(k) for k, v in new.items()]))


@query
def zscore_outliers(spark, folder):
    df = stored(order_profile(spark, folder))
    fitted = outliers.fit_outliers(df)
    new = {k: v for c, s in fitted.items() for k, v in outliers.zscore_columns(c, s).items()}
    return rounded(df.select("id", *[v.alias(k) for k, v in new.items()]))


@query
def outlier_counts(spark, folder):
    df = stored(order_profile(spark, folder))
    out = outliers.flag_outliers(df, outliers.fit_outliers(df))
    return out.select("id", "multiple_outlier_detected", "total_outlier_count")


@query
def domain_flags(spark, folder):
    # Scaled so that the domain limits fall inside the values.
    df = order_profile(spark, folder).withColumns({ALONE: F.col(ALONE) - 1, FRIENDS: F.col(FRIENDS) * 200, POSTS: F.col(POSTS) * 3})
    return df.select("id", *[v.alias(k) for k, v in outliers.domain_columns(df).items()])


@query
def winsorise(spark, folder):
    df = stored(order_profile(spark, folder))
    return bronze.winsorise(df, bronze.fit_winsorise(df)).select("id", *MEASURES)


@query
def winsorise_five_percent(spark, folder):
    df = stored(order_profile(spark, folder))
    return bronze.winsorise(df, bronze.fit_winsorise(df, tail=0.05)).select("id", *MEASURES)


@query
def quick_clean(spark, folder):
    df = stored(order_profile(spark, folder))
    return bronze.quick_clean(df, bronze.fit_quick(df))


@query
def repaired_bronze(spark, folder):
    """Flags, repair, forest and outliers in one: train fit, applied to all."""
    profile = stored(order_profile(spark, folder))
    fitted = layers.fit_repaired_bronze(split_profile(profile)[0])
    return layers.apply_repaired_bronze(profile, fitted)


@query
def fold_safe_bronze(spark, folder):
    df = bronze.fold_safe_bronze(order_profile(spark, folder))
    return df.select("id", FEAR, DRAINED, *[c for c in df.columns if c.endswith("_missing")])


@query
def unseen_categories(spark, folder):
    """Spellings of urgent orders that the other orders do not have."""
    profile = order_profile(spark, folder)
    urgent = F.col(FEAR) == "Yes"
    seen = bronze.fit_categories(profile.where(F.coalesce(~urgent, F.lit(True))))
    return bronze.unseen_categories(profile.where(urgent), seen).withColumnRenamed("column", "column_name")


# ---- silver -----------------------------------------------------------------

BASIC = [
    "social_participation_rate", "communication_ratio", "friend_social_efficiency", "non_social_outings",
    "activity_balance", "social_ratio", "activity_sum", "total_activity", "avg_activity", "activity_std",
    "activity_min", "activity_max", "activity_range", "post_per_friend", "friend_efficiency",
    "fear_drain_interaction", "fear_drain_sum", "fear_drain_ratio", "social_alone_interaction",
    "social_alone_ratio", "friends_post_interaction", "friends_post_ratio", "extrovert_score", "extrovert_avg",
    "extrovert_std", "introvert_score", "introvert_avg", "introvert_std", "personality_balance",
    "personality_ratio", "personality_sum", "alone_percentage", "alone_squared", "alone_log", "social_squared",
    "social_log", "social_percentage",
]


@query
def basic_features(spark, folder):
    df = stored(encoded(spark, folder))
    out = silver.basic_features(df, silver.fit_basic(df))
    return rounded(out.select("id", *BASIC), only=["activity_std", "extrovert_std", "introvert_std", "alone_log", "social_log"])


@query
def participation_features(spark, folder):
    out = silver.participation_features(encoded(spark, folder))
    return out.select("id", "w_participation_rate", "w_non_social_outings", "w_communication_ratio", "w_friend_efficiency")


@query
def drain_features(spark, folder):
    out = silver.drain_features(encoded(spark, folder))
    return out.select("id", "Activity_ratio", "Drain_adjusted_activity", "Introvert_extrovert_spectrum")


@query
def communication_features(spark, folder):
    return silver.communication_features(encoded(spark, folder)).select("id", "Online_offline_ratio", "Communication_balance")


@query
def interaction_features(spark, folder):
    base = silver.basic_features(encoded(spark, folder))
    out = silver.interaction_features(base)
    return out.select("id", *[c for c in out.columns if c not in base.columns])


@query
def polynomial_features(spark, folder):
    base = silver.basic_features(encoded(spark, folder))
    out = silver.polynomial_features(base)
    return out.select("id", *[c for c in out.columns if c.startswith("poly_")])


@query
def zscaling(spark, folder):
    df = stored(encoded(spark, folder).select("id", *MEASURES, FEAR, F.lit(1).alias("constant")))
    out = silver.scale(df, silver.fit_scaling(df))
    return rounded(out.select("id", *[c for c in out.columns if c.endswith("_scaled")]))


@query
def silver_layer(spark, folder):
    """All 127 derived columns, summed per label."""
    df = stored(encoded(spark, folder))
    out = layers.apply_silver(df, layers.fit_silver(df))
    chosen = ["extrovert_score", "total_activity", "fear_drain_sum", "Activity_ratio", "extrovert_alone_interaction", f"poly_{FRIENDS}_{OUTSIDE}"]
    return out.groupBy("Personality").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in chosen])


# Columns whose last digits depend on how a power, a logarithm or a deviation is worked out.
LOOSE = ["activity_std", "extrovert_std", "introvert_std", "alone_log", "social_log"]


@query
def silver_all_columns(spark, folder):
    """Every derived silver column of every row."""
    out, names = _all_silver(spark, folder)
    return rounded(out.select("id", *names), only=LOOSE)


@query
def gold_all_columns(spark, folder):
    """Every silver column after the gold step, as counts, extremes and sums of each."""
    out, names = _all_silver(spark, folder)
    df = stored(rounded(out.select("id", "Personality", *names), only=LOOSE))
    cleaned = gold.apply_gold(df, gold.fit_gold(split_profile(df)[0], features=names))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in names])
    long = cleaned.select("id", F.inline(cells))

    def size(c):
        """On a logarithmic scale, since sums of large numbers differ in their last digits."""
        return F.round(F.signum(c) * F.log1p(F.abs(c)), 6)

    return long.groupBy("feature").agg(
        F.count("x").alias("n"), size(F.min("x")).alias("least"), size(F.max("x")).alias("most"),
        size(F.sum("x")).alias("total"), size(F.sum(F.col("x") * (F.col("id") % 97))).alias("weighted"),
    )


@query
def fold_safe_silver(spark, folder):
    """Scaling learned on the other folds, applied to fold 0."""
    df = stored(ordering.stratified_folds(encoded(spark, folder), "Personality"))
    train, valid = crossval.fold_parts(df, 0)
    out = silver.fold_safe_silver(valid.drop("fold"), silver.fit_fold_safe_silver(train.drop("fold")))
    return rounded(out.select("id", *MEASURES, "extrovert_score", "total_activity"))


# ---- enhanced silver --------------------------------------------------------


@query
def power_lambdas(spark, folder):
    fitted = encode.fit_power(stored(encoded(spark, folder)), columns=MEASURES)
    return learned(spark, fitted, "column_name", "lambda", 2)


@query
def power_transform(spark, folder):
    df = order_profile(spark, folder).withColumn(OUTSIDE, F.col(OUTSIDE) - 100)
    fixed = {SOCIAL: 0.5, OUTSIDE: 1.5, FRIENDS: 0.0, POSTS: -0.5}
    out = encode.power_transform(df, fixed)
    return rounded(out.select("id", *[f"{c}_power" for c in fixed]))


@query
def target_means(spark, folder):
    df = order_profile(spark, folder)
    means = encode.fit_target_means(df, gold.label_value(df))
    return rounded(means.withColumnRenamed("column", "column_name"))


@query
def target_encode(spark, folder):
    df = stored(order_profile(spark, folder))
    train, test = split_profile(df)
    means = encode.fit_target_means(train, gold.label_value(train))
    return rounded(encode.target_encode(test, means).select("id", f"{FEAR}_target_encoded", f"{DRAINED}_target_encoded"))


@query
def target_encode_out_of_fold(spark, folder):
    df = stored(ordering.stratified_folds(order_profile(spark, folder), "Personality"))
    out = encode.target_encode_out_of_fold(df, gold.label_value(df), [FEAR, DRAINED])
    return rounded(out.select("id", f"{FEAR}_target_encoded", f"{DRAINED}_target_encoded"))


@query
def target_encode_noise(spark, folder):
    """Mean and spread of the repeatable noise term."""
    df = stored(order_profile(spark, folder))
    means = encode.fit_target_means(df, gold.label_value(df), columns=[FEAR])
    noisy = encode.target_encode(df, means, noise=0.01).withColumnRenamed(f"{FEAR}_target_encoded", "noisy")
    both = encode.target_encode(noisy, means)
    return both.select("id", F.round(F.col("noisy") - F.col(f"{FEAR}_target_encoded"), 6).alias("noise"))


@query
def knn_impute(spark, folder):
    return rounded(neighbours.knn_impute(stored(order_profile(spark, folder)), columns=MEASURES).select("id", *MEASURES))


@query
def was_missing_flags(spark, folder):
    out = encode.was_missing_flags(order_profile(spark, folder), MEASURES)
    return out.select("id", *[f"{c}_was_missing" for c in MEASURES])


@query
def key_zscores(spark, folder):
    df = stored(order_profile(spark, folder))
    return rounded(encode.key_zscores(df, encode.fit_key_zscores(df)).select("id", *[f"{c}_zscore" for c in encode.key_columns()]))


@query
def mode_flags(spark, folder):
    df = stored(order_profile(spark, folder))
    return encode.mode_flags(df, encode.fit_modes(df, [FEAR, DRAINED])).select("id", f"{FEAR}_is_mode", f"{DRAINED}_is_mode")


@query
def oversample(spark, folder):
    df = encoded(spark, folder)
    out = neighbours.oversample(gold.encode_label(df), "Personality_encoded", MEASURES)
    return out.groupBy("Personality_encoded").agg(F.count("*").alias("n"))


@query
def oversampled_rows(spark, folder):
    df = encoded(spark, folder)
    return rounded(neighbours.oversample(gold.encode_label(df), "Personality_encoded", MEASURES))


@query
def enhanced_features(spark, folder):
    """Power, target means, fills, moments and ranks over the bronze columns:
    learned on train, applied to train and test."""
    train, test = split_profile(stored(order_profile(spark, folder)))
    fitted, enhanced = layers.fit_enhanced(stored(bronze.encode_yes_no(train)), target_columns=SPEC.yes_no)
    return enhanced.unionByName(layers.apply_enhanced(bronze.encode_yes_no(test), fitted))


@query
def enhanced_one_call(spark, folder):
    """Raw rows to all derived columns and target means in one call; train fit, both tables."""
    train, test = split_profile(order_profile(spark, folder))
    parts = layers.enhanced_silver(train, [test.drop("Personality")], power=False, statistics=False)
    names = [c for c in parts[1].columns if c not in (*MEASURES, FEAR, DRAINED, f"{FEAR}_encoded", f"{DRAINED}_encoded")]
    return rounded(parts[0].select(*names).unionByName(parts[1].select(*names)), only=[*LOOSE, f"{FEAR}_target_encoded", f"{DRAINED}_target_encoded"])


@query
def enhanced_oversampled(spark, folder):
    """The one call with the switch that evens out the classes: rows of each, and gaps left."""
    train, _ = split_profile(order_profile(spark, folder))
    (out,) = layers.enhanced_silver(train, power=False, target_means=False, statistics=False, oversampled=True)
    gaps = sum((F.col(c).isNull().cast("int") for c in out.columns if c != "id"), F.lit(0))
    return out.groupBy("Personality_encoded").agg(F.count("*").alias("n"), F.sum(gaps).alias("gaps"))


# ---- gold -------------------------------------------------------------------


@query
def gold_clean(spark, folder):
    df = stored(encoded(spark, folder))
    return gold.clean(df, gold.fit_clean(df)).select("id", *MEASURES, FEAR, DRAINED)


@query
def gold_clean_far_values(spark, folder):
    """Prices beyond the absolute limit, and a column that lies wholly beyond it."""
    df = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice", (F.col("o_totalprice") + 1000000).alias("far"))
    df = stored(df)
    return gold.clean(df, gold.fit_clean(df))


@query
def encode_label(spark, folder):
    return gold.encode_label(order_profile(spark, folder)).select("id", "Personality_encoded")


@query
def category_codes(spark, folder):
    df = stored(order_profile(spark, folder))
    out = encode.encode_codes(df, encode.fit_codes(df, [FEAR, DRAINED]), [FEAR, DRAINED], "id")
    return out.select("id", f"{FEAR}_encoded", f"{DRAINED}_encoded")


def _scores(spark, folder, method: str) -> DataFrame:
    df = stored(gold.encode_label(encoded(spark, folder).drop(f"{FEAR}_encoded", f"{DRAINED}_encoded")))
    return rounded(gold.scores_frame(spark, gold.score_features(df, method=method)), 4)


@query
def anova_scores(spark, folder):
    return _scores(spark, folder, "statistical")


@query
def information_scores(spark, folder):
    return _scores(spark, folder, "mutual_info")


@query
def select_features(spark, folder):
    df = stored(gold.encode_label(encoded(spark, folder).drop(f"{FEAR}_encoded", f"{DRAINED}_encoded")))
    return spark.createDataFrame([(c,) for c in gold.select_features(df, k=4)], "feature string")


@query
def default_features(spark, folder):
    df = encoded(spark, folder)
    return df.select("id", *gold.default_features(df))


@query
def gold_table(spark, folder):
    """Train fit with a given feature list, applied to all orders."""
    profile = stored(order_profile(spark, folder))
    chosen = [*MEASURES, f"{FEAR}_encoded", f"{DRAINED}_encoded"]
    fitted = gold.fit_gold(split_profile(profile)[0], features=chosen)
    return gold.apply_gold(profile, fitted)


# ---- folds, model, search ---------------------------------------------------


@query
def stratified_folds(spark, folder):
    return ordering.stratified_folds(order_profile(spark, folder), "Personality").select("id", "fold")


@query
def fold_leakage(spark, folder):
    return ordering.fold_overlap(ordering.stratified_folds(order_profile(spark, folder), "Personality"))


QUICK = {"iterations": 10, "num_leaves": 16}


TRAINING = [*MEASURES, FEAR, DRAINED]


def _folded_rows(spark, folder) -> DataFrame:
    """(id, fold, label, features as they came): nothing is learned yet."""
    df = encoded(spark, folder)
    folded = ordering.stratified_folds(df, "Personality")
    return stored(folded.select("id", "fold", gold.label_value(folded).alias("label"), *TRAINING))


def _cleaned(train: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both with limits and fills of the training rows."""
    fitted = gold.fit_clean(train.select(*TRAINING))
    return gold.clean(train, fitted), gold.clean(other, fitted), TRAINING


def _training_rows(spark, folder) -> tuple[DataFrame, list[str]]:
    """All rows, cleaned by limits of all: for models that aren't scored on rows held out."""
    df = _folded_rows(spark, folder)
    return stored(_cleaned(df, df)[0]), TRAINING


@query
def boosted_model(spark, folder):
    train, valid, names = _cleaned(*crossval.fold_parts(_folded_rows(spark, folder), 0))
    return boosting.BoostedModel.fit(train, names, QUICK).score(valid).select("id", "label", "p", "predicted")


@query
def model_round_trip(spark, folder):
    """Predictions of a saved and reloaded model."""
    df, names = _training_rows(spark, folder)
    path = f"{durable_folder(spark)}/model"
    boosting.BoostedModel.fit(df, names, QUICK).save(path, model_type="boosted")
    return boosting.BoostedModel.load(spark, path).score(df).select("id", "p", "predicted")


@query
def cross_validation(spark, folder):
    return crossval.train_cv(_folded_rows(spark, folder), [], QUICK, prepare=_cleaned).oof


@query
def cross_validation_summary(spark, folder):
    return crossval.train_cv(_folded_rows(spark, folder), [], QUICK, prepare=_cleaned).summary().drop("training_time")


@query
def feature_importance(spark, folder):
    df, names = _training_rows(spark, folder)
    return boosting.BoostedModel.fit(df, names, QUICK).importance_frame(spark)


@query
def top_model_features(spark, folder):
    df, names = _training_rows(spark, folder)
    model = boosting.BoostedModel.fit(df, names, QUICK)
    return df.select("id", *boosting.top_features(model, 3))


@query
def parameter_search(spark, folder):
    """Few rounds per trial; limits and fills are learned inside each fold."""
    return search.search(_folded_rows(spark, folder), [], n_trials=4, fixed={"iterations": 5}, prepare=_cleaned, parallelism=4).trials


@query
def search_record_json(spark, folder):
    found = search.search(_folded_rows(spark, folder), [], n_trials=2, fixed={"iterations": 3}, prepare=_cleaned)
    path = f"{durable_folder(spark)}/search"
    results.write_json(results.search_record(spark, found.best_params, found.best_score, found.n_trials, found.seconds), path)
    return results.read_json(spark, path, results.SEARCH_RECORD).drop("timestamp", "seconds")


@query
def parameter_importance(spark, folder):
    found = search.search(_folded_rows(spark, folder), [], n_trials=8, fixed={"iterations": 3}, prepare=_cleaned, parallelism=4)
    return found.parameter_importance()


@query
def learning_curve(spark, folder):
    train, valid, names = _cleaned(*crossval.fold_parts(_folded_rows(spark, folder), 0))
    return boosting.learning_curve(boosting.BoostedModel.fit(train, names, QUICK), train, valid)


@query
def batch_scoring(spark, folder):
    """Fit on train, score test, in submission form."""
    train, test, names = _cleaned(*split_profile(_folded_rows(spark, folder)))
    return results.submission(boosting.BoostedModel.fit(train, names, QUICK).score(test), "p")


def _known_answer(spark, folder, learner) -> DataFrame:
    """Per fold: what a right cross-validation must give when the features decide the label."""
    df = _folded_rows(spark, folder)
    decided = df.withColumn("label", F.when(F.coalesce(F.col(OUTSIDE), F.lit(0.0)) > 100, 1).otherwise(0)).withColumn(OUTSIDE, F.coalesce(F.col(OUTSIDE), F.lit(0.0)))
    result = crossval.train_cv(decided, [], prepare=_cleaned, learner=learner)
    return result.oof.groupBy("fold").agg(
        F.count("*").alias("rows"),
        F.countDistinct("id").alias("ids"),
        F.sum(F.col("label").cast("long")).alias("ones"),
        F.every((F.col("p") >= 0) & (F.col("p") <= 1)).alias("p_in_range"),
        (F.avg((F.col("label") == F.col("predicted")).cast("double")) > 0.9).alias("learned"),
    )


@query
def cross_validation_logistic(spark, folder):
    return _known_answer(spark, folder, learners.logistic())


@query
def cross_validation_forest(spark, folder):
    return _known_answer(spark, folder, learners.forest(trees=10, depth=5))


@query
def learner_round_trip(spark, folder):
    """Scores of a logistic model and of its reloaded copy, which must not differ."""
    df, names = _training_rows(spark, folder)
    path = f"{durable_folder(spark)}/learner"
    model = learners.logistic().fit(df, names)
    model.save(path)
    again = learners.PipelineFit.load(spark, path)
    both = model.score(df).withColumnsRenamed({"p": "p1", "predicted": "c1"})
    return again.score(both).select("id", (F.col("p") == F.col("p1")).alias("same"), F.col("p").between(0, 1).alias("p_in_range"))


@query
def search_with_failure(spark, folder):
    """A search begun, left after two trials and gone on with; the third trial always fails."""
    df = _folded_rows(spark, folder)
    log = search.TrialLog(spark, f"{durable_folder(spark)}/trials")
    doomed = search.draw_trials(5)[2]

    def make(params):
        if params == doomed:
            raise RuntimeError("planted")
        return learners.logistic(penalty=params["reg_lambda"] / 10, iterations=10)

    search.search(df, [], n_trials=2, prepare=_cleaned, make=make, log=log)
    found = search.search(df, [], n_trials=5, prepare=_cleaned, make=make, log=log, parallelism=4)
    best = F.lit(found.best_score)
    drawn = sum((F.col(n).isNotNull().cast("int") for n in search.SPACE), F.lit(0))
    return found.trials.select(
        "trial", "state", "attempts", (F.col("score") <= best).alias("not_above_best"), (F.col("score") == search.WORST).alias("worst"), drawn.cast("int").alias("parameters")
    )


@query
def first_slice(spark, folder):
    """Encode, flag, limit, derive and summarise by label."""
    raw = stored(order_profile(spark, folder))
    fitted = layers.fit_bronze(raw)
    out = silver.basic_features(layers.apply_bronze(raw, fitted))
    return rounded(
        out.groupBy("Personality").agg(
            F.count("*").alias("n"),
            F.avg("extrovert_score").alias("avg_extrovert_score"),
            F.avg(F.when(F.col(ALONE) > 0, F.col("social_ratio"))).alias("avg_social_ratio"),
            F.sum("both_missing").alias("both_missing"),
        )
    )


# ---- frozen ranks, bins, rare values ----------------------------------------


@query
def percent_rank_unseen(spark, folder):
    """Ranks learned on train rows, looked up for test rows."""
    train, test = split_profile(stored(encoded(spark, folder)))
    columns = encode.key_columns()
    frozen = ranks.FrozenRanks(ranks.fit_ranks(train, columns))
    return rounded(frozen.add(test.select("id", *columns), columns, id_col="id").select("id", *[f"{c}_percentile" for c in columns]), 8)


@query
def percent_rank_unseen_prices(spark, folder):
    """As above for a column of many different values, in many slices."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    train, test = split_profile(orders)
    frozen = ranks.FrozenRanks(ranks.fit_ranks(train, ["price"]))
    return rounded(frozen.add(test, ["price"], id_col="id").select("id", "price_percentile"), 8)


@query
def rank_gauss(spark, folder):
    """Normal values at the ranks of the skewed measures, learned on train rows, for all rows."""
    df = stored(encoded(spark, folder))
    train, _ = split_profile(df)
    columns = ranks.skewed_columns(train, MEASURES)
    frozen = ranks.FrozenRanks(ranks.fit_ranks(train, columns))
    return rounded(frozen.gauss(df.select("id", *columns), columns, id_col="id").select("id", *[f"{c}_gauss" for c in columns]))


@query
def quantile_bins(spark, folder):
    """Ten bins of the measures with odd numbers in one of them, edges of train rows."""
    df = stored(bronze.encode_yes_no(_with_odd_numbers(order_profile(spark, folder))))
    whole = split_profile(bronze.normalise_types(df))[0]
    out = binning.bin_columns(df, binning.fit_bins(whole, MEASURES))
    return out.select("id", *[f"{c}_bin" for c in MEASURES])


@query
def robust_scaling(spark, folder):
    df = stored(encoded(spark, folder))
    out = binning.robust_scale(df, binning.fit_robust(split_profile(df)[0], MEASURES), limit=3.0)
    return rounded(out.select("id", *[f"{c}_robust" for c in MEASURES]))


@query
def rare_categories(spark, folder):
    """Parts and suppliers of few train lines become one bucket; so do those train never had."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber", F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag")
    )
    frequent = binning.fit_frequent(split_profile(lines)[0], ["part", "flag"], least=25)
    out = binning.group_rare(lines, frequent, ["part", "flag"], id_col="id")
    return out.groupBy("part_grouped", "flag_grouped").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


# ---- pairs, drift, thresholds, submissions, experiments ---------------------


def _all_silver(spark, folder) -> tuple[DataFrame, list[str]]:
    """Every derived silver column by id, and their names."""
    df = stored(encoded(spark, folder))
    out = layers.apply_silver(df, layers.fit_silver(df))
    return out, [c for c in out.columns if c not in df.columns]


@query
def correlated_pairs(spark, folder):
    """All pairs of derived silver columns beyond 0.95; roundings keep clear of the limit itself."""
    out, names = _all_silver(spark, folder)
    found = correlation.correlated_pairs(stored(out.select(*names)), sorted(names))
    return found.select("left", "right", "pairs", F.round("r", 4).alias("r"))


@query
def drift_report(spark, folder):
    """Urgent orders against the others: categories, means and gaps differ between them."""
    profile = stored(order_profile(spark, folder).withColumn(FRIENDS, F.when(F.col(FEAR) == "Yes", F.col(FRIENDS) * 2).otherwise(F.col(FRIENDS))))
    urgent = F.coalesce(F.col(FEAR) == "Yes", F.lit(False))
    return rounded(drift.drift_report(profile.where(~urgent), profile.where(urgent), MEASURES, [FEAR, DRAINED, "Personality"]))


@query
def threshold_search(spark, folder):
    """Accuracy at each of 80 thresholds, from one pass."""
    return rounded(metrics.threshold_table(predictions(spark, folder), "label", "p", metrics.THRESHOLDS))


@query
def best_fold_threshold(spark, folder):
    """The most accurate threshold of each fold."""
    found = metrics.best_threshold(folded_predictions(spark, folder), "label", "p", by=["fold"])
    return rounded(found)


@query
def submission_faults(spark, folder):
    """Each kind of fault, planted in a submission of all orders."""
    rows = order_profile(spark, folder).select("id")
    scored = predictions(spark, folder).where(F.col("id") % 1000 != 3)
    sent = scored.select(
        F.when(F.col("id") % 1000 == 5, -F.col("id")).when(F.col("id") % 1000 != 7, F.col("id")).alias("id"),
        F.when(F.col("id") % 500 == 9, "Ambivert").otherwise(F.col("Personality")).alias("Personality"),
        F.when(F.col("id") % 700 == 1, F.col("p") + 2).otherwise(F.col("p")).alias("p"),
        F.lit(0).alias("comment"),
    )
    sent = sent.unionByName(sent.where(F.col("id") % 900 == 11))
    return rounded_text(results.submission_faults(stored(sent), rows, probability="p"))


def rounded_text(faults: DataFrame) -> DataFrame:
    """Numbers among the values as hundredths, so that engines spell them alike."""
    number = F.col("fault") == "bad_probability"
    return faults.withColumn("value", F.when(number, F.round(F.col("value").try_cast("double") * 100).cast("long").cast("string")).otherwise(F.col("value")))


@query
def experiment_top_runs(spark, folder):
    """One run per nation: metrics of its customers, one of which most runs lack."""
    customers = table(spark, folder, "customer")
    groups = customers.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"), F.count("*").alias("n"))
    runs = groups.select(
        F.format_string("run-%02d", "c_nationkey").alias("run"), F.format_string("group-%d", F.col("c_nationkey") % 3).alias("name"), F.lit("2024-01-01").alias("started"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("params"),
        F.map_filter(F.create_map(F.lit("cv_mean"), F.round("mean", 4), F.lit("rows"), F.col("n").cast("double")), lambda k, v: (k != "cv_mean") | (F.col("c_nationkey") % 4 != 0)).alias("metrics"),
        F.array(F.lit("c_acctbal")).alias("features"), F.lit(None).cast("string").alias("notes"),
    )
    path = f"{durable_folder(spark)}/experiments"
    experiments.append(runs.where("c_nationkey < 12"), path)
    experiments.append(runs.where("c_nationkey >= 12"), path)
    return experiments.top_runs(experiments.read(spark, path), "cv_mean", 20)


@query
def experiment_comparison(spark, folder):
    """Runs of one parameter per ship mode of order status, read back and compared by name."""
    orders = table(spark, folder, "orders")
    runs = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.round(F.avg("o_totalprice"), 2).alias("m")).select(
        F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("run"), F.col("o_orderstatus").alias("name"), F.lit("2024-01-01").alias("started"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("params"), F.create_map(F.lit("price"), F.col("m")).alias("metrics"),
        F.lit([]).cast("array<string>").alias("features"), F.lit(None).cast("string").alias("notes"),
    )
    path = f"{durable_folder(spark)}/experiments"
    experiments.append(runs, path)
    return rounded(experiments.compare(experiments.read(spark, path), "price"), 2)
