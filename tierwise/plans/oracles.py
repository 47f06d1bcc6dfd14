"""The same results in SQL, written by hand against the given tables.

Short names inside the statements: t, s, o, f, p are the five measures in spec
order; sf, dr the two answers as 0/1.
"""

from __future__ import annotations

_RAW = """
li AS (
  SELECT l_orderkey, SUM(l_quantity) AS q, COUNT(*) AS n,
         COUNT(DISTINCT l_partkey) AS p, SUM(ROUND(l_discount * 100)) AS d
  FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey % 27 AS DOUBLE) END AS Time_spent_Alone,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS Social_event_attendance,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE q END AS Going_outside,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(p AS DOUBLE) END AS Friends_circle_size,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE d END AS Post_frequency,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN ' yes'
         WHEN '3-MEDIUM' THEN 'NO' WHEN '4-NOT SPECIFIED' THEN 'n' ELSE NULL END AS Stage_fear,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         WHEN (o_orderpriority IN ('1-URGENT','2-HIGH','5-LOW')) <> (o_orderkey % 5 = 0) THEN 'Y'
         ELSE 'No' END AS Drained_after_socializing,
    CASE WHEN o_totalprice >= 130000 THEN 'Extrovert' ELSE 'Introvert' END AS Personality
  FROM orders LEFT JOIN li ON l_orderkey = o_orderkey)"""

_YES_NO = """CASE WHEN lower(trim({c})) IN ('yes','y','1','true') THEN 1.0
  WHEN lower(trim({c})) IN ('no','n','0','false') THEN 0.0 END"""

_ENC = f"""{_RAW},
e AS (
  SELECT id, Time_spent_Alone AS t, Social_event_attendance AS s, Going_outside AS o,
    Friends_circle_size AS f, Post_frequency AS p,
    CAST({_YES_NO.format(c='Stage_fear')} AS DOUBLE) AS sf,
    CAST({_YES_NO.format(c='Drained_after_socializing')} AS DOUBLE) AS dr, Personality,
    CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END AS y
  FROM raw)"""

_PRED = f"""{_RAW},
w AS (SELECT id, Personality, CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END AS label,
  coalesce(Going_outside, 0.0) + 3 * coalesce(Friends_circle_size, 0.0) AS w FROM raw),
pred AS (SELECT id, Personality, label, w / (w + 150.0) AS p,
  CASE WHEN w / (w + 150.0) > 0.5 THEN 1 ELSE 0 END AS predicted FROM w),
fp AS (SELECT *, CAST((row_number() OVER (PARTITION BY Personality
  ORDER BY md5(CAST(id AS VARCHAR) || '#42'), id) - 1) % 5 AS INTEGER) AS fold FROM pred),
fa AS (SELECT fold, avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END) AS accuracy FROM fp GROUP BY fold)"""

_FOLDS = f"""{_ENC},
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY Personality
  ORDER BY md5(CAST(id AS VARCHAR) || '#42'), id) - 1) % 5 AS INTEGER) AS fold FROM e)"""

# Measures of every row in long form: (id, name, x).
_LONG = f"""{_ENC},
lf AS (
  SELECT id, y, 'Time_spent_Alone' AS name, t AS x FROM e
  UNION ALL SELECT id, y, 'Social_event_attendance', s FROM e
  UNION ALL SELECT id, y, 'Going_outside', o FROM e
  UNION ALL SELECT id, y, 'Friends_circle_size', f FROM e
  UNION ALL SELECT id, y, 'Post_frequency', p FROM e)"""

_NAMES = {
    "t": "Time_spent_Alone",
    "s": "Social_event_attendance",
    "o": "Going_outside",
    "f": "Friends_circle_size",
    "p": "Post_frequency",
}
_MEASURES = ", ".join(f"{k} AS {v}" for k, v in _NAMES.items())

_BRONZE = f"""{_ENC},
part AS (SELECT *, CASE WHEN id % 4 <> 0 THEN 'train' ELSE 'test' END AS part FROM e),
lim AS (SELECT {", ".join(f"quantile_cont({k}, 0.01) AS {k}1, quantile_cont({k}, 0.99) AS {k}9" for k in _NAMES)}
  FROM part WHERE part = 'train'),
b AS (SELECT id, part, Personality, y, sf, dr,
  {", ".join(f"CASE WHEN {k} IS NULL THEN NULL ELSE least(greatest({k}, {k}1), {k}9) END AS {k}" for k in _NAMES)},
  {", ".join(f"CAST({k} IS NULL AS INTEGER) AS {k}_m" for k in (*_NAMES, "sf", "dr"))}
  FROM part CROSS JOIN lim)"""

_SMOOTH = "prior * (1 - 1 / (1 + exp(-(n - 10)))) + mean * (1 / (1 + exp(-(n - 10))))"


def _clean(expr: str, lo: str, hi: str, med: str) -> str:
    return f"coalesce(CASE WHEN {expr} IS NULL THEN NULL ELSE least(greatest({expr}, {lo}), {hi}) END, {med})"


def _bounds(k: str, source: str = "") -> str:
    q1, q3 = f"quantile_cont({k}, 0.25)", f"quantile_cont({k}, 0.75)"
    return (
        f"greatest({q1} - 3 * ({q3} - {q1}), -100000) AS {k}lo, "
        f"least({q3} + 3 * ({q3} - {q1}), 100000) AS {k}hi, quantile_cont({k}, 0.5) AS {k}md"
    )


ORACLES: dict[str, str] = {}

# ---- scans, types, layers ----
ORACLES["raw_scan"] = f"WITH {_RAW} SELECT * FROM raw"
ORACLES["raw_split"] = f"""WITH {_RAW}
SELECT CASE WHEN id % 4 <> 0 THEN 'train' ELSE 'test' END AS part, Personality, count(*) AS n
FROM raw GROUP BY ALL"""
ORACLES["type_normalise"] = f"""WITH {_RAW}
SELECT id, Time_spent_Alone, Social_event_attendance,
  CASE WHEN id % 7 = 0 OR id % 11 = 0 OR id % 13 = 0 THEN NULL ELSE Going_outside END AS Going_outside,
  Friends_circle_size, Post_frequency, Stage_fear, Drained_after_socializing, Personality FROM raw"""
ORACLES["infinite_to_missing"] = f"""WITH {_RAW},
o AS (SELECT id, CASE WHEN id % 7 = 0 OR id % 11 = 0 OR id % 13 = 0 THEN NULL ELSE Going_outside END AS x FROM raw)
SELECT id, x AS as_missing, coalesce(x, 0.0) AS as_zero FROM o"""
_BRONZE_COLUMNS = f"""id, {_MEASURES}, sf AS Stage_fear, dr AS Drained_after_socializing, Personality,
  sf AS Stage_fear_encoded, dr AS Drained_after_socializing_encoded, sf_m AS Stage_fear_missing,
  o_m AS Going_outside_missing, t_m AS Time_spent_Alone_missing,
  dr_m AS Drained_after_socializing_missing, s_m AS Social_event_attendance_missing,
  sf_m * dr_m AS both_missing"""
ORACLES["bronze_layer"] = f"WITH {_BRONZE} SELECT {_BRONZE_COLUMNS}, part FROM b"
ORACLES["silver_on_demand"] = f"""WITH {_BRONZE},
m AS (SELECT max(s) AS smax FROM b WHERE part = 'train'),
d AS (SELECT *, coalesce(s, 0.0) + coalesce(o, 0.0) + coalesce(f, 0.0) AS e, s / (t + 1e-8) AS r FROM b CROSS JOIN m)
SELECT id, e AS extrovert_score, r AS social_ratio, e * r * s AS triple_interaction,
  s / (smax + 1e-8) AS social_percentage, coalesce(r, 0.0) * coalesce(r, 0.0) AS poly_social_ratio_pow_2 FROM d"""
ORACLES["gold_layer"] = f"""WITH {_RAW}
SELECT id, CASE WHEN id % 4 <> 0 THEN CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END END AS Personality_encoded
FROM raw"""
ORACLES["submission_csv"] = f"""WITH {_PRED}
SELECT id, CASE WHEN p > 0.5 THEN 'Extrovert' ELSE 'Introvert' END AS Personality FROM pred"""
ORACLES["fold_scores_csv"] = f"WITH {_PRED} SELECT fold, round(accuracy, 6) AS accuracy FROM fa"
ORACLES["cv_record_json"] = f"""WITH {_PRED}
SELECT 'boosted' AS model_type, CAST(count(*) AS INTEGER) AS folds, '5' AS n_splits, CAST(12.5 AS DOUBLE) AS training_time,
  round(avg(accuracy), 6) AS mean_score, round(stddev_pop(accuracy), 6) AS std_score,
  round(min(accuracy), 6) AS min_score, round(max(accuracy), 6) AS max_score,
  round(quantile_cont(accuracy, 0.5), 6) AS median_score FROM fa"""
ORACLES["seeded_sample"] = f"""WITH {_RAW}
SELECT id, Personality FROM raw ORDER BY md5(CAST(id AS VARCHAR) || '#42'), id LIMIT 2500"""

# ---- projections and filters ----
ORACLES["model_columns"] = f"""WITH {_ENC}
SELECT id, {_MEASURES}, sf AS Stage_fear, dr AS Drained_after_socializing,
  sf AS Stage_fear_encoded, dr AS Drained_after_socializing_encoded, y AS label FROM e"""
ORACLES["drop_missing"] = f"""WITH {_RAW}
SELECT Personality, count(*) AS n FROM raw WHERE Social_event_attendance IS NOT NULL GROUP BY Personality"""
ORACLES["threshold_class"] = f"WITH {_PRED} SELECT id, predicted FROM pred"
ORACLES["fold_subset"] = f"""WITH {_FOLDS}
SELECT CASE WHEN fold = 2 THEN 'valid' ELSE 'train' END AS side, Personality, count(*) AS n,
  CAST(sum(id) AS BIGINT) AS id_sum FROM folds GROUP BY ALL"""

# ---- quality and aggregates ----
ORACLES["quality_metrics"] = f"""WITH {_RAW}
SELECT count(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns,
  CAST(sum((Time_spent_Alone IS NULL)::INT + (Social_event_attendance IS NULL)::INT + (Going_outside IS NULL)::INT
    + (Friends_circle_size IS NULL)::INT + (Post_frequency IS NULL)::INT + (Stage_fear IS NULL)::INT
    + (Drained_after_socializing IS NULL)::INT) AS BIGINT) AS missing_values,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicate_rows FROM raw"""
ORACLES["duplicate_rows"] = """SELECT count(*) - (SELECT count(*) FROM
  (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows FROM lineitem"""


def _range_sql(relation: str, with_: str) -> str:
    lines = [f"SELECT 'Time_spent_Alone' AS column_name, 'within_24hrs' AS check_name, bool_and(coalesce(Time_spent_Alone <= 24, false)) AS ok FROM {relation}"]
    for c in _NAMES.values():
        lines.append(f"SELECT '{c}', 'non_negative', bool_and(coalesce({c} >= 0, false)) FROM {relation}")
        lines.append(f"SELECT '{c}', 'finite_values', bool_and(coalesce(isfinite({c}), false)) FROM {relation}")
    return f"WITH {with_} " + " UNION ALL ".join(lines)


ORACLES["range_checks"] = _range_sql("raw", _RAW)
ORACLES["range_checks_complete"] = _range_sql(
    "z", f"{_RAW}, z AS (SELECT {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in _NAMES.values())} FROM raw)"
)
ORACLES["quantile_table"] = f"""WITH {_LONG},
ps AS (SELECT unnest([0.01, 0.2, 0.25, 0.5, 0.75, 0.7, 0.8, 0.99]) AS i),
q AS (SELECT name, unnest([0.01, 0.2, 0.25, 0.5, 0.75, 0.7, 0.8, 0.99]) AS p,
  unnest(quantile_cont(x, [0.01, 0.2, 0.25, 0.5, 0.75, 0.7, 0.8, 0.99])) AS value FROM lf GROUP BY name)
SELECT name AS column_name, CAST(p AS DOUBLE) AS p, round(value, 6) AS value FROM q"""
ORACLES["line_item_quantiles"] = """WITH l AS (
  SELECT 'l_extendedprice' AS name, l_extendedprice AS x FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem),
q AS (SELECT name, unnest([0.25, 0.5, 0.99]) AS p, unnest(quantile_cont(x, [0.25, 0.5, 0.99])) AS value FROM l GROUP BY name)
SELECT name AS column_name, CAST(p AS DOUBLE) AS p, round(value, 4) AS value FROM q"""
ORACLES["medians"] = f"""WITH {_LONG}
SELECT name AS column_name, round(median(x), 6) AS median FROM lf GROUP BY name"""
ORACLES["sample_moments"] = f"""WITH {_LONG}
SELECT name AS column_name, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM lf GROUP BY name"""
ORACLES["population_moments"] = f"""WITH {_LONG}
SELECT name AS column_name, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM lf GROUP BY name"""
ORACLES["answer_correlation"] = f"""WITH {_ENC}
SELECT round(corr(sf, dr), 4) AS r, count(*) FILTER (sf IS NOT NULL AND dr IS NOT NULL) AS pairs FROM e"""
ORACLES["skewness_table"] = f"""WITH {_LONG}
SELECT name AS column_name, round(skewness(x), 4) AS skew FROM lf GROUP BY name"""
ORACLES["column_maximum"] = f"WITH {_ENC} SELECT max(s) AS social_max FROM e"
ORACLES["category_values"] = f"""WITH {_RAW},
c AS (SELECT 'Stage_fear' AS column_name, Stage_fear AS value FROM raw
  UNION ALL SELECT 'Drained_after_socializing', Drained_after_socializing FROM raw)
SELECT column_name, value, count(*) AS rows FROM c WHERE value IS NOT NULL GROUP BY ALL"""
ORACLES["category_modes"] = f"""WITH {_RAW},
c AS (SELECT 'Stage_fear' AS column_name, Stage_fear AS value FROM raw
  UNION ALL SELECT 'Drained_after_socializing', Drained_after_socializing FROM raw
  UNION ALL SELECT 'Personality', Personality FROM raw),
g AS (SELECT column_name, value, count(*) AS n FROM c WHERE value IS NOT NULL GROUP BY column_name, value),
n AS (SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM g)
SELECT column_name, value AS mode FROM n WHERE r = 1"""
ORACLES["label_distribution"] = f"""WITH {_ENC}
SELECT y AS label, count(*) AS class_count, round(count(*) / (SELECT count(*) FROM e), 6) AS class_ratio FROM e GROUP BY y"""
ORACLES["label_summary"] = f"""WITH {_ENC}
SELECT count(DISTINCT y) AS n_classes, count(DISTINCT y) = 2 AS is_binary,
  count(DISTINCT y) = max(y) + 1 AS has_both_classes FROM e"""
ORACLES["prediction_distribution"] = f"""WITH {_PRED}
SELECT round(avg(predicted), 6) AS extrovert_ratio, round(avg(1 - predicted), 6) AS introvert_ratio,
  count(*) FILTER (predicted = 1) AS extrovert_count, count(*) FILTER (predicted = 0) AS introvert_count,
  count(*) AS total_predictions FROM pred"""
ORACLES["integrity_checks"] = f"""WITH {_ENC},
m AS (SELECT bool_or(t IS NULL OR s IS NULL OR o IS NULL OR f IS NULL OR p IS NULL OR sf IS NULL OR dr IS NULL) AS miss,
  bool_or(coalesce(isinf(t) OR isinf(s) OR isinf(o) OR isinf(f) OR isinf(p), false)) AS inf,
  bool_or(y IS NULL) AS nolabel, count(*) AS n, count(DISTINCT y) AS k, max(y) AS top FROM e)
SELECT NOT miss AS no_missing_features, NOT inf AS no_infinite_features, NOT nolabel AS no_missing_targets,
  k = 2 AND top = 1 AS binary_targets, n >= 10 AS sufficient_samples, k = top + 1 AS balanced_classes,
  miss OR nolabel AS has_nan, inf AS has_inf, k AS n_classes FROM m"""
ORACLES["accuracy"] = f"""WITH {_PRED}
SELECT round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred"""
_AUC = """(sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
  / (CAST(sum(label) AS DOUBLE) * sum(1 - label))"""
ORACLES["roc_auc"] = f"""WITH {_PRED},
r AS (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM pred)
SELECT round({_AUC}, 6) AS auc FROM r"""
ORACLES["fold_auc"] = f"""WITH {_PRED},
r AS (SELECT fold, label, rank() OVER (PARTITION BY fold ORDER BY p)
  + (count(*) OVER (PARTITION BY fold, p) - 1) / 2.0 AS r FROM fp)
SELECT fold, round({_AUC}, 6) AS auc FROM r GROUP BY fold"""
ORACLES["metric_bundle"] = f"""WITH {_PRED},
r AS (SELECT label, predicted, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM pred)
SELECT round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round({_AUC}, 6) AS auc FROM r"""
ORACLES["fold_score_summary"] = f"""WITH {_PRED}
SELECT round(avg(accuracy), 6) AS mean_score, round(stddev_pop(accuracy), 6) AS std_score,
  round(min(accuracy), 6) AS min_score, round(max(accuracy), 6) AS max_score,
  round(quantile_cont(accuracy, 0.5), 6) AS median_score FROM fa"""
_FOLD_IMPORTANCE = f"""{_FOLDS},
fi AS ({" UNION ALL ".join(f"SELECT fold, '{v}' AS feature, abs(corr({k}, y)) AS importance FROM folds GROUP BY fold" for k, v in _NAMES.items())})"""
ORACLES["importance_union"] = f"WITH {_FOLD_IMPORTANCE} SELECT fold, feature, round(importance, 6) AS importance FROM fi"
ORACLES["importance_summary"] = f"""WITH {_FOLD_IMPORTANCE}
SELECT feature, round(avg(importance), 6) AS importance_mean, round(stddev_samp(importance), 6) AS importance_std,
  count(*) AS fold_count FROM fi GROUP BY feature"""
ORACLES["success_criteria"] = f"""WITH {_PRED},
m AS (SELECT avg(accuracy) AS a, stddev_pop(accuracy) AS d FROM fa),
c(profile, criterion, passed) AS (
  SELECT unnest(['light','light','light','light','base','base','base','base','enhanced','enhanced','enhanced',
      'enhanced','enhanced','heavy','heavy','heavy','heavy','heavy','heavy']),
    unnest(['dev_target_achieved','stable_performance','fast_training','ready_for_heavy','score_achieved',
      'stable_performance','reasonable_time','data_integrity','bronze_target_achieved','stable_performance',
      'reasonable_time','data_integrity','optimization_successful','bronze_target_achieved','stable_performance',
      'reasonable_time','data_integrity','optimization_successful','ready_for_submission']),
    unnest([a >= 0.975, d <= 0.003, 100 <= 60, a >= 0.973, a >= 0.975, d <= 0.002, 100 <= 300, true,
      a >= 0.976518, d <= 0.002, 100 <= 600, true, 0.971 > 0.97, a >= 0.976518, d <= 0.002, 100 <= 1200, true,
      0.971 > 0.97, a >= 0.975]) FROM m)
SELECT profile, criterion, passed FROM c
UNION ALL SELECT profile, 'overall_success', bool_and(passed) FROM c GROUP BY profile"""
_RUNS = "runs AS (SELECT event_type AS workflow, ts, value AS duration FROM events)"
ORACLES["workflow_stats"] = f"""WITH {_RUNS}
SELECT workflow, round(avg(duration), 4) AS average, round(median(duration), 4) AS median,
  round(min(duration), 4) AS min, round(max(duration), 4) AS max, count(*) AS count,
  round(stddev_samp(duration), 4) AS std_dev FROM runs GROUP BY workflow"""
ORACLES["workflow_estimates"] = f"""WITH {_RUNS}
SELECT workflow, round(median(duration) * 0.7 + avg(duration) * 0.3, 4) AS estimate FROM runs GROUP BY workflow"""
ORACLES["workflow_listing"] = "SELECT DISTINCT event_type AS workflow FROM events"
ORACLES["workflow_removal"] = "SELECT event_type AS workflow, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY event_type"
ORACLES["workflow_latest_runs"] = f"""WITH {_RUNS},
r AS (SELECT *, row_number() OVER (PARTITION BY workflow ORDER BY ts DESC, duration DESC) AS r FROM runs)
SELECT workflow, count(*) AS n, CAST(min(ts) AS VARCHAR) AS oldest FROM r WHERE r <= 100 GROUP BY workflow"""

# ---- row statistics, ranks, order ----
ORACLES["row_statistics"] = f"""WITH {_LONG}
SELECT id, coalesce(sum(x), 0) AS row_sum, round(avg(x), 6) AS row_mean, round(stddev_samp(x), 6) AS row_std,
  min(x) AS row_min, max(x) AS row_max, max(x) - min(x) AS row_range FROM lf GROUP BY id"""
ORACLES["row_moments"] = f"""WITH {_LONG},
m AS (SELECT id, count(x) AS n, avg(x) AS mean, var_pop(x) AS v, stddev_samp(x) AS std,
  quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.75) AS q75, array_agg(x) FILTER (x IS NOT NULL) AS xs FROM lf GROUP BY id),
k AS (SELECT *, list_sum(list_transform(xs, lambda a: (a - mean) ** 3)) / n AS m3,
  list_sum(list_transform(xs, lambda a: (a - mean) ** 4)) / n AS m4 FROM m)
SELECT id, round(mean, 6) AS row_mean, round(std, 6) AS row_std,
  round(CASE WHEN n = 0 THEN 0 WHEN n < 3 THEN NULL WHEN v < 1e-14 THEN 0
    ELSE sqrt(n * (n - 1)) / (n - 2) * m3 / v ** 1.5 END, 6) AS row_skew,
  round(CASE WHEN n = 0 THEN 0 WHEN n < 4 THEN NULL WHEN v < 1e-14 THEN 0
    ELSE (n - 1) / ((n - 2.0) * (n - 3)) * ((n + 1) * (m4 / (v * v) - 3) + 6) END, 6) AS row_kurtosis,
  round(q25, 6) AS row_q25, round(q75, 6) AS row_q75, round(q75 - q25, 6) AS row_iqr FROM k"""


def _rank_pct(k: str) -> str:
    return f"""CASE WHEN {k} IS NOT NULL THEN round((rank() OVER (ORDER BY {k} NULLS LAST)
      + (count(*) OVER (PARTITION BY {k}) - 1) / 2.0) / (SELECT count({k}) FROM e), 8) END"""


ORACLES["percent_rank"] = f"""WITH {_ENC}
SELECT id, {_rank_pct('s')} AS Social_event_attendance_percentile, {_rank_pct('t')} AS Time_spent_Alone_percentile,
  {_rank_pct('f')} AS Friends_circle_size_percentile FROM e"""
ORACLES["top_k_orders"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"
ORACLES["first_rows"] = f"WITH {_RAW} SELECT id, Personality FROM raw ORDER BY id LIMIT 100"
ORACLES["label_value_set"] = f"WITH {_ENC} SELECT list_sort(array_agg(DISTINCT y)) = [0, 1] AS is_binary FROM e"

# ---- bronze ----
ORACLES["yes_no_encode"] = f"""WITH {_ENC}
SELECT id, sf AS Stage_fear, dr AS Drained_after_socializing, sf AS Stage_fear_encoded,
  dr AS Drained_after_socializing_encoded FROM e"""


def _null(k: str) -> str:
    return f"CAST({k} IS NULL AS INTEGER)"


ORACLES["missing_flags"] = f"""WITH {_ENC}
SELECT id, {_null('sf')} AS Stage_fear_missing, {_null('o')} AS Going_outside_missing,
  {_null('t')} AS Time_spent_Alone_missing, {_null('dr')} AS Drained_after_socializing_missing,
  {_null('s')} AS Social_event_attendance_missing, CAST(sf IS NULL AND dr IS NULL AS INTEGER) AS both_missing FROM e"""
_Q = """q AS (SELECT quantile_cont(s, 0.7) AS s7, quantile_cont(t, 0.8) AS t8, quantile_cont(t, 0.2) AS t2,
  quantile_cont(o, 0.7) AS o7, quantile_cont(p, 0.7) AS p7, quantile_cont(f, 0.7) AS f7 FROM e)"""
ORACLES["missing_patterns"] = f"""WITH {_ENC}, {_Q}
SELECT id, {_null('sf')} AS Stage_fear_missing, {_null('dr')} AS Drained_after_socializing_missing,
  {_null('o')} AS Going_outside_missing, {_null('t')} AS Time_spent_Alone_missing,
  {_null('s')} AS Social_event_attendance_missing, {_null('f')} AS Friends_circle_size_missing,
  CAST(sf IS NULL AND dr IS NULL AS INTEGER) AS social_anxiety_complete_missing,
  CAST((sf IS NULL) <> (dr IS NULL) AS INTEGER) AS social_anxiety_partial_missing,
  CAST(dr IS NULL AND coalesce(s > s7, false) AS INTEGER) AS social_fatigue_missing,
  CAST(coalesce(t > t8, false) AND s IS NULL AS INTEGER) AS extreme_introvert_missing,
  CAST(coalesce(t < t2, false) AND s IS NULL AS INTEGER) AS contradictory_social_missing,
  CAST(coalesce(o > o7, false) AND s IS NULL AS INTEGER) AS non_social_outing_missing,
  CAST(coalesce(p > p7, false) AND f IS NULL AS INTEGER) AS online_social_missing FROM e CROSS JOIN q"""
ORACLES["cross_imputation"] = f"""WITH {_ENC}, {_Q},
c AS (SELECT count(*) FILTER (sf IS NOT NULL AND dr IS NOT NULL) AS n, corr(sf, dr) AS r FROM e),
v AS (SELECT quantile_cont(s, 0.75) FILTER (o > o7) AS so, quantile_cont(o, 0.75) FILTER (t < t2) AS ot,
  quantile_cont(f, 0.75) FILTER (p > p7) AS fp FROM e CROSS JOIN q),
a AS (SELECT e.*, q.*, c.*, v.*, CASE WHEN s IS NULL AND o > o7 THEN so ELSE s END AS s1
  FROM e CROSS JOIN q CROSS JOIN c CROSS JOIN v),
z AS (SELECT quantile_cont(s1, 0.75) FILTER (f > f7) AS sfr FROM a)
SELECT id, t AS Time_spent_Alone, CASE WHEN s1 IS NULL AND f > f7 THEN sfr ELSE s1 END AS Social_event_attendance,
  CASE WHEN o IS NULL AND t < t2 THEN ot ELSE o END AS Going_outside,
  CASE WHEN f IS NULL AND p > p7 THEN fp ELSE f END AS Friends_circle_size, p AS Post_frequency,
  CASE WHEN n > 10 AND abs(r) > 0.3 THEN coalesce(sf, CASE WHEN r > 0 THEN dr ELSE 1 - dr END) ELSE sf END AS Stage_fear,
  CASE WHEN n > 10 AND abs(r) > 0.3 THEN coalesce(dr, CASE WHEN r > 0 THEN sf ELSE 1 - sf END) ELSE dr END
    AS Drained_after_socializing FROM a CROSS JOIN z"""
_FENCES = f"""lim AS (SELECT {", ".join(f"quantile_cont({k}, 0.25) AS {k}1, quantile_cont({k}, 0.75) AS {k}3, avg({k}) AS {k}mean, stddev_samp({k}) AS {k}std" for k in _NAMES)} FROM e)"""


def _fence(k: str) -> tuple[str, str]:
    width = f"({k}3 - {k}1)"
    low, high = f"({k}1 - 2.5 * {width})", f"({k}3 + 2.5 * {width})"
    flag = f"CAST(coalesce({k} < {low} OR {k} > {high}, false) AS INTEGER)"
    score = f"CASE WHEN {k} < {low} THEN ({low} - {k}) / {width} WHEN {k} > {high} THEN ({k} - {high}) / {width} ELSE 0.0 END"
    return flag, score


def _zflag(k: str) -> str:
    return f"CAST(coalesce(abs(({k} - {k}mean) / {k}std) > 3, false) AS INTEGER)"


ORACLES["fence_outliers"] = f"""WITH {_ENC}, {_FENCES}
SELECT id, {", ".join(f"{_fence(k)[0]} AS {v}_statistical_outlier, round({_fence(k)[1]}, 6) AS {v}_outlier_score" for k, v in _NAMES.items())}
FROM e CROSS JOIN lim"""
ORACLES["zscore_outliers"] = f"""WITH {_ENC}, {_FENCES}
SELECT id, {", ".join(f"{_zflag(k)} AS {v}_zscore_outlier, round(abs(({k} - {k}mean) / {k}std), 6) AS {v}_zscore" for k, v in _NAMES.items())}
FROM e CROSS JOIN lim"""
_COUNT = " + ".join(f"{_fence(k)[0]} + {_zflag(k)}" for k in _NAMES)
ORACLES["outlier_counts"] = f"""WITH {_ENC}, {_FENCES}, c AS (SELECT id, {_COUNT} AS n FROM e CROSS JOIN lim)
SELECT id, CAST(n >= 2 AS INTEGER) AS multiple_outlier_detected, n AS total_outlier_count FROM c"""
ORACLES["domain_flags"] = f"""WITH {_ENC}
SELECT id, CAST(coalesce(t - 1 > 24, false) AS INTEGER) AS time_alone_extreme,
  CAST(coalesce(t - 1 < 0, false) AS INTEGER) AS time_alone_negative,
  CAST(coalesce(f * 200 > 1000, false) AS INTEGER) AS friends_extreme,
  CAST(coalesce(p * 3 > 100, false) AS INTEGER) AS post_frequency_extreme FROM e"""


def _winsor(tail: float) -> str:
    limits = ", ".join(f"quantile_cont({k}, {tail}) AS {k}1, quantile_cont({k}, {1 - tail}) AS {k}9" for k in _NAMES)
    out = ", ".join(f"CASE WHEN {k} IS NULL THEN NULL ELSE least(greatest({k}, {k}1), {k}9) END AS {v}" for k, v in _NAMES.items())
    return f"WITH {_ENC}, lim AS (SELECT {limits} FROM e) SELECT id, {out} FROM e CROSS JOIN lim"


ORACLES["winsorise"] = _winsor(0.01)
ORACLES["winsorise_five_percent"] = _winsor(0.05)
ORACLES["quick_clean"] = f"""WITH {_RAW},
m AS (SELECT {", ".join(f"median({v}) AS {k}m" for k, v in _NAMES.items())} FROM raw)
SELECT id, {", ".join(f"coalesce({v}, {k}m) AS {v}" for k, v in _NAMES.items())}, Personality,
  CAST(coalesce(Stage_fear = 'Yes', false) AS INTEGER) AS Stage_fear_encoded,
  CAST(coalesce(Drained_after_socializing = 'Yes', false) AS INTEGER) AS Drained_after_socializing_encoded
FROM raw CROSS JOIN m"""
ORACLES["fold_safe_bronze"] = f"""WITH {_ENC}
SELECT id, sf AS Stage_fear, dr AS Drained_after_socializing, {_null('sf')} AS Stage_fear_missing,
  {_null('o')} AS Going_outside_missing, {_null('t')} AS Time_spent_Alone_missing FROM e"""
ORACLES["unseen_categories"] = f"""WITH {_RAW}
SELECT 'Stage_fear' AS column_name, 'Yes' AS value, count(*) AS rows FROM raw WHERE Stage_fear = 'Yes'"""

# ---- silver ----
ORACLES["basic_features"] = f"""WITH {_ENC},
m AS (SELECT max(s) AS smax FROM e),
a AS (SELECT id, stddev_samp(x) AS std5 FROM (
  SELECT id, unnest([t, s, o, f, p]) AS x FROM e) GROUP BY id),
x AS (SELECT id, stddev_samp(v) AS std3, avg(v) AS avg3 FROM (SELECT id, unnest([s, o, f]) AS v FROM e) GROUP BY id),
i AS (SELECT id, stddev_samp(coalesce(v, 0)) AS istd, avg(v) AS iavg FROM (SELECT id, unnest([t, sf, dr]) AS v FROM e) GROUP BY id),
b AS (SELECT e.*, smax, std5, std3, avg3, istd, iavg,
  coalesce(t, 0) + coalesce(s, 0) + coalesce(o, 0) + coalesce(f, 0) + coalesce(p, 0) AS tot,
  (t IS NOT NULL)::INT + (s IS NOT NULL)::INT + (o IS NOT NULL)::INT + (f IS NOT NULL)::INT + (p IS NOT NULL)::INT AS n5,
  coalesce(s, 0) + coalesce(o, 0) + coalesce(f, 0) AS ex, coalesce(t, 0) + coalesce(sf, 0) + coalesce(dr, 0) AS intr
  FROM e JOIN a USING (id) JOIN x USING (id) JOIN i USING (id) CROSS JOIN m)
SELECT id, s / (o + 1e-8) AS social_participation_rate, p / (s + o + 1e-8) AS communication_ratio,
  s / (f + 1e-8) AS friend_social_efficiency, o - s AS non_social_outings, s / (t + 1e-8) AS activity_balance,
  s / (t + 1e-8) AS social_ratio, o + s AS activity_sum, tot AS total_activity,
  CASE WHEN n5 > 0 THEN tot / n5 END AS avg_activity, round(std5, 6) AS activity_std,
  least(t, s, o, f, p) AS activity_min, greatest(t, s, o, f, p) AS activity_max,
  greatest(t, s, o, f, p) - least(t, s, o, f, p) AS activity_range, p / (f + 1e-8) AS post_per_friend,
  f / (p + 1e-8) AS friend_efficiency, sf * dr AS fear_drain_interaction, sf + dr AS fear_drain_sum,
  sf / (dr + 1e-8) AS fear_drain_ratio, s * t AS social_alone_interaction, s / (t + 1e-8) AS social_alone_ratio,
  f * p AS friends_post_interaction, f / (p + 1e-8) AS friends_post_ratio, ex AS extrovert_score, avg3 AS extrovert_avg,
  round(std3, 6) AS extrovert_std, intr AS introvert_score, iavg AS introvert_avg, round(istd, 6) AS introvert_std,
  ex - intr AS personality_balance, ex / greatest(intr, 1) AS personality_ratio, ex + intr AS personality_sum,
  t / 24.0 AS alone_percentage, t * t AS alone_squared, round(ln(1 + greatest(t, 0) + t - t), 6) AS alone_log,
  s * s AS social_squared, round(ln(1 + s), 6) AS social_log, s / (smax + 1e-8) AS social_percentage FROM b"""
ORACLES["participation_features"] = f"""WITH {_ENC}
SELECT id, s / (o + 1e-8) AS w_participation_rate, o - s AS w_non_social_outings,
  p / (s + o + 1e-8) AS w_communication_ratio, s / (f + 1e-8) AS w_friend_efficiency FROM e"""
ORACLES["drain_features"] = f"""WITH {_ENC},
a AS (SELECT *, coalesce(s, 0) + coalesce(o, 0) + coalesce(p, 0) AS act FROM e)
SELECT id, act AS Activity_ratio, act * (1 - dr) AS Drain_adjusted_activity,
  s + o + f - t AS Introvert_extrovert_spectrum FROM a"""
ORACLES["communication_features"] = f"""WITH {_ENC}
SELECT id, p / (s + o + 1e-8) AS Online_offline_ratio, p / (p + s + 1e-8) AS Communication_balance FROM e"""
_LEAD = f"""{_ENC},
k AS (SELECT *, coalesce(s, 0.0) + coalesce(o, 0.0) + coalesce(f, 0.0) AS e, s / (t + 1e-8) AS r, s / (o + 1e-8) AS g,
  p / (s + o + 1e-8) AS c, s / (f + 1e-8) AS w FROM e)"""
ORACLES["interaction_features"] = f"""WITH {_LEAD}
SELECT id, e * r AS extrovert_social_interaction, e / (r + 1e-8) AS extrovert_social_ratio,
  r / (e + 1e-8) AS social_extrovert_ratio, e * s AS extrovert_social_event_interaction,
  e / (s + 1e-8) AS extrovert_social_event_ratio, e * t AS extrovert_alone_interaction,
  e - t AS extrovert_alone_contrast, e / (t + 1e-8) AS extrovert_alone_ratio, e * dr AS extrovert_drain_interaction,
  CASE WHEN dr IS NOT NULL THEN e / greatest(dr, 1) END AS extrovert_drain_ratio, e * f AS extrovert_friends_interaction,
  e / (f + 1e-8) AS extrovert_friends_ratio, r * f AS social_friends_interaction, r / (f + 1e-8) AS social_friends_ratio,
  r * o AS social_outside_interaction, r / (o + 1e-8) AS social_outside_ratio, r * p AS social_post_interaction,
  r / (p + 1e-8) AS social_post_ratio, g * t AS participation_alone_interaction,
  g / (t + 1e-8) AS participation_alone_ratio, g * f AS participation_friends_interaction,
  g / (f + 1e-8) AS participation_friends_ratio, e * r * s AS triple_interaction,
  e * g * t AS triple_participation_interaction, (r + c + w) / 3.0 AS composite_social_score,
  r * w AS social_efficiency_balance FROM k"""
_POLY = [
    ("extrovert_score", "e"),
    ("social_ratio", "r"),
    ("social_participation_rate", "g"),
    ("communication_ratio", "c"),
    ("friend_social_efficiency", "w"),
    ("Social_event_attendance", "s"),
    ("Time_spent_Alone", "t"),
    ("Friends_circle_size", "f"),
    ("Going_outside", "o"),
    ("Post_frequency", "p"),
]
_TERMS = ", ".join(
    f"coalesce({a}, 0.0) * coalesce({b}, 0.0) AS " + (f"poly_{x}_pow_2" if x == z else f"poly_{x}_{z}")
    for i, (x, a) in enumerate(_POLY)
    for z, b in _POLY[i:]
)
ORACLES["polynomial_features"] = f"WITH {_LEAD} SELECT id, {_TERMS} FROM k"
ORACLES["zscaling"] = f"""WITH {_ENC},
m AS (SELECT {", ".join(f"avg({k}) AS {k}a, stddev_samp({k}) AS {k}d" for k in (*_NAMES, "sf"))} FROM e)
SELECT id, {", ".join(f"round(({k} - {k}a) / {k}d, 6) AS {v}_scaled" for k, v in {**_NAMES, 'sf': 'Stage_fear'}.items())}
FROM e CROSS JOIN m"""
ORACLES["silver_layer"] = f"""WITH {_ENC},
k AS (SELECT *, coalesce(s, 0.0) + coalesce(o, 0.0) + coalesce(f, 0.0) AS ex FROM e)
SELECT Personality, count(*) AS n, sum(ex) AS sum_extrovert_score,
  sum(coalesce(t, 0) + coalesce(s, 0) + coalesce(o, 0) + coalesce(f, 0) + coalesce(p, 0)) AS sum_total_activity,
  sum(sf + dr) AS sum_fear_drain_sum, sum(coalesce(s, 0) + coalesce(o, 0) + coalesce(p, 0)) AS sum_Activity_ratio,
  sum(ex * t) AS sum_extrovert_alone_interaction,
  sum(coalesce(f, 0) * coalesce(o, 0)) AS sum_poly_Friends_circle_size_Going_outside FROM k GROUP BY Personality"""
ORACLES["fold_safe_silver"] = f"""WITH {_FOLDS},
d AS (SELECT *, coalesce(s, 0.0) + coalesce(o, 0.0) + coalesce(f, 0.0) AS ex,
  coalesce(t, 0) + coalesce(s, 0) + coalesce(o, 0) + coalesce(f, 0) + coalesce(p, 0) AS tot FROM folds),
m AS (SELECT {", ".join(f"avg({k}) AS {k}a, stddev_pop({k}) AS {k}d" for k in (*_NAMES, "ex", "tot"))} FROM d WHERE fold <> 0)
SELECT id, {", ".join(f"round(({k} - {k}a) / {k}d, 6) AS {v}" for k, v in {**_NAMES, 'ex': 'extrovert_score', 'tot': 'total_activity'}.items())}
FROM d CROSS JOIN m WHERE fold = 0"""

# ---- enhanced silver ----
ORACLES["power_lambdas"] = f"""WITH {_LONG},
g AS (SELECT name FROM lf GROUP BY name HAVING abs(skewness(x)) > 0.5),
v AS (SELECT name, x, count(*) AS n FROM lf JOIN g USING (name) WHERE x IS NOT NULL GROUP BY name, x),
lam AS (SELECT i / 100.0 AS l FROM range(-400, 401) r(i)),
z AS (SELECT name, l, n, x, CASE WHEN l = 0 THEN ln(1 + x) ELSE ((x + 1) ** l - 1) / l END AS yj FROM v CROSS JOIN lam),
m AS (SELECT name, l, sum(n * yj) / sum(n) AS mean FROM z GROUP BY name, l),
s AS (SELECT name, l, -sum(n) / 2.0 * ln(sum(n * (yj - mean) ** 2) / sum(n)) + (l - 1) * sum(n * ln(1 + x)) AS ll
  FROM z JOIN m USING (name, l) GROUP BY name, l)
SELECT name AS column_name, CAST(round(arg_max(l, ll), 2) AS DOUBLE) AS lambda FROM s GROUP BY name"""
ORACLES["power_transform"] = f"""WITH {_ENC},
h AS (SELECT id, s, o - 100 AS o, f, p FROM e)
SELECT id, round((sqrt(s + 1) - 1) / 0.5, 6) AS Social_event_attendance_power,
  round(CASE WHEN o >= 0 THEN ((o + 1) ** 1.5 - 1) / 1.5 ELSE -((1 - o) ** 0.5 - 1) / 0.5 END, 6) AS Going_outside_power,
  round(ln(1 + f), 6) AS Friends_circle_size_power, round(((p + 1) ** -0.5 - 1) / -0.5, 6) AS Post_frequency_power FROM h"""
_CATS = f"""{_RAW},
c AS (SELECT id, CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END AS y, 'Stage_fear' AS column_name, Stage_fear AS category FROM raw
  UNION ALL SELECT id, CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END, 'Drained_after_socializing', Drained_after_socializing FROM raw)"""
ORACLES["target_means"] = f"""WITH {_CATS},
g AS (SELECT column_name, category, count(*) AS n, avg(y) AS mean FROM c GROUP BY ALL),
r AS (SELECT column_name, avg(y) AS prior FROM c GROUP BY ALL)
SELECT column_name, category, n, round(prior, 6) AS prior, round({_SMOOTH}, 6) AS encoded FROM g JOIN r USING (column_name)"""
ORACLES["target_encode"] = f"""WITH {_CATS},
tr AS (SELECT * FROM c WHERE id % 4 <> 0),
g AS (SELECT column_name, category, count(*) AS n, avg(y) AS mean FROM tr GROUP BY ALL),
r AS (SELECT column_name, avg(y) AS prior FROM tr GROUP BY ALL),
te AS (SELECT c.id, c.column_name, coalesce({_SMOOTH}, prior) AS v FROM c JOIN r USING (column_name)
  LEFT JOIN g ON g.column_name = c.column_name AND g.category IS NOT DISTINCT FROM c.category WHERE c.id % 4 = 0)
SELECT id, round(max(v) FILTER (column_name = 'Stage_fear'), 6) AS Stage_fear_target_encoded,
  round(max(v) FILTER (column_name = 'Drained_after_socializing'), 6) AS Drained_after_socializing_target_encoded
FROM te GROUP BY id"""
ORACLES["target_encode_out_of_fold"] = f"""WITH {_CATS},
fd AS (SELECT id, CAST((row_number() OVER (PARTITION BY Personality ORDER BY md5(CAST(id AS VARCHAR) || '#42'), id) - 1) % 5
  AS INTEGER) AS fold FROM raw),
cf AS (SELECT c.*, fold FROM c JOIN fd USING (id)),
k AS (SELECT i AS fold FROM range(0, 5) x(i)),
g AS (SELECT column_name, category, k.fold, count(*) AS n, avg(y) AS mean FROM cf JOIN k ON cf.fold <> k.fold GROUP BY ALL),
r AS (SELECT column_name, k.fold, avg(y) AS prior FROM cf JOIN k ON cf.fold <> k.fold GROUP BY ALL),
te AS (SELECT cf.id, cf.column_name, coalesce({_SMOOTH}, prior) AS v FROM cf JOIN r USING (column_name, fold)
  LEFT JOIN g ON g.column_name = cf.column_name AND g.fold = cf.fold AND g.category IS NOT DISTINCT FROM cf.category)
SELECT id, round(max(v) FILTER (column_name = 'Stage_fear'), 6) AS Stage_fear_target_encoded,
  round(max(v) FILTER (column_name = 'Drained_after_socializing'), 6) AS Drained_after_socializing_target_encoded
FROM te GROUP BY id"""


def _knn_sql() -> str:
    near = []
    total = " + ".join(f"coalesce((q.{k} - d.{k}) ** 2, 0)" for k in _NAMES)
    shared = " + ".join(f"CAST(q.{k} IS NOT NULL AND d.{k} IS NOT NULL AS INTEGER)" for k in _NAMES)
    for k, v in _NAMES.items():
        near.append(
            f"""SELECT vid, '{v}' AS target, sum(least(n, 5 - before) * x) / sum(least(n, 5 - before)) AS v FROM (
  SELECT vid, x, n, coalesce(sum(n) OVER (PARTITION BY vid ORDER BY d2, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT vid, x, d2, sum(n) AS n FROM (
    SELECT q.vid, d.{k} AS x, d.n, 5.0 / ({shared}) * ({total}) AS d2 FROM vec q JOIN vec d
    ON q.{k} IS NULL AND d.{k} IS NOT NULL AND ({shared}) > 0) GROUP BY ALL))
  WHERE before < 5 GROUP BY vid"""
        )
    keys = " AND ".join(f"e.{k} IS NOT DISTINCT FROM vec.{k}" for k in _NAMES)
    pivot = ", ".join(f"max(v) FILTER (target = '{v}') AS {k}v" for k, v in _NAMES.items())
    out = ", ".join(f"round(coalesce(e.{k}, {k}v, (SELECT avg({k}) FROM e)), 6) AS {v}" for k, v in _NAMES.items())
    return f"""WITH {_ENC},
vec AS (SELECT {", ".join(_NAMES)}, count(*) AS n, row_number() OVER () AS vid FROM e GROUP BY {", ".join(_NAMES)}),
hits AS ({" UNION ALL ".join(near)}),
fills AS (SELECT vid, {pivot} FROM hits GROUP BY vid)
SELECT e.id, {out} FROM e JOIN vec ON {keys} LEFT JOIN fills USING (vid)"""


ORACLES["knn_impute"] = _knn_sql()
ORACLES["was_missing_flags"] = f"WITH {_ENC} SELECT id, {', '.join(f'{_null(k)} AS {v}_was_missing' for k, v in _NAMES.items())} FROM e"
ORACLES["key_zscores"] = f"""WITH {_ENC},
m AS (SELECT {", ".join(f"avg({k}) AS {k}a, stddev_samp({k}) AS {k}d" for k in "stf")} FROM e)
SELECT id, {", ".join(f"round(({k} - {k}a) / ({k}d + 1e-8), 6) AS {_NAMES[k]}_zscore" for k in "stf")} FROM e CROSS JOIN m"""
ORACLES["mode_flags"] = f"""WITH {_RAW},
a AS (SELECT Stage_fear AS v FROM raw WHERE Stage_fear IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
b AS (SELECT Drained_after_socializing AS v FROM raw WHERE Drained_after_socializing IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT id, CAST(coalesce(Stage_fear = a.v, false) AS INTEGER) AS Stage_fear_is_mode,
  CAST(coalesce(Drained_after_socializing = b.v, false) AS INTEGER) AS Drained_after_socializing_is_mode
FROM raw CROSS JOIN a CROSS JOIN b"""
ORACLES["oversample"] = f"""WITH {_ENC}, c AS (SELECT y, count(*) AS n FROM e GROUP BY y)
SELECT y AS Personality_encoded, max(n) OVER () AS n FROM c"""

# ---- gold ----
_CLEAN_KEYS = {**_NAMES}
ORACLES["gold_clean"] = f"""WITH {_ENC},
lim AS (SELECT {", ".join(_bounds(k) for k in _NAMES)}, median(sf) AS sfmd, median(dr) AS drmd FROM e)
SELECT id, {", ".join(f"{_clean(k, k + 'lo', k + 'hi', k + 'md')} AS {v}" for k, v in _NAMES.items())},
  coalesce(sf, sfmd) AS Stage_fear, coalesce(dr, drmd) AS Drained_after_socializing FROM e CROSS JOIN lim"""
ORACLES["gold_clean_far_values"] = f"""WITH x AS (SELECT o_orderkey AS id, o_totalprice AS a, o_totalprice + 1000000 AS b FROM orders),
lim AS (SELECT {_bounds('a')}, {_bounds('b')} FROM x)
SELECT id, least(greatest(a, alo), ahi) AS o_totalprice,
  least(greatest(b, least(blo, bhi)), greatest(blo, bhi)) AS far FROM x CROSS JOIN lim"""
ORACLES["encode_label"] = f"WITH {_ENC} SELECT id, y AS Personality_encoded FROM e"
ORACLES["category_codes"] = f"""WITH {_RAW},
a AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT Stage_fear AS v FROM raw WHERE Stage_fear IS NOT NULL)),
b AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT Drained_after_socializing AS v FROM raw WHERE Drained_after_socializing IS NOT NULL))
SELECT id, coalesce(a.code, -1) AS Stage_fear_encoded, coalesce(b.code, -1) AS Drained_after_socializing_encoded
FROM raw LEFT JOIN a ON a.v = Stage_fear LEFT JOIN b ON b.v = Drained_after_socializing"""
_SCORED = f"""{_LONG},
l7 AS (SELECT * FROM lf UNION ALL SELECT id, y, 'Stage_fear', sf FROM e UNION ALL SELECT id, y, 'Drained_after_socializing', dr FROM e),
md AS (SELECT name, median(x) AS md FROM l7 GROUP BY name),
fx AS (SELECT name, y, coalesce(x, md) AS x FROM l7 JOIN md USING (name)),
cl AS (SELECT name, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM fx GROUP BY name, y),
al AS (SELECT name, count(*) AS n, avg(x) AS m FROM fx GROUP BY name),
anova AS (SELECT name, sum(cl.n * (cl.m - al.m) ** 2) / (count(*) - 1) / (sum(cl.n * v) / (max(al.n) - count(*))) AS f
  FROM cl JOIN al USING (name) GROUP BY name),
ed AS (SELECT name, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM fx GROUP BY name),
bn AS (SELECT name, y, len(list_filter(q, lambda c: x > c)) AS bin FROM fx JOIN ed USING (name)),
ct AS (SELECT name, bin, y, count(*) AS n FROM bn GROUP BY ALL),
mi AS (SELECT name, sum(n / tot * ln(n * tot / (nb * ny))) AS mi FROM (
  SELECT *, sum(n) OVER (PARTITION BY name) AS tot, sum(n) OVER (PARTITION BY name, bin) AS nb,
    sum(n) OVER (PARTITION BY name, y) AS ny FROM ct) GROUP BY name)"""
ORACLES["anova_scores"] = f"WITH {_SCORED} SELECT name AS feature, round(f, 4) AS score FROM anova"
ORACLES["information_scores"] = f"WITH {_SCORED} SELECT name AS feature, round(greatest(mi, 0), 4) AS score FROM mi"
ORACLES["select_features"] = f"""WITH {_SCORED},
n AS (SELECT name, (f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER () + 1e-8)
  + (mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER () + 1e-8) AS score FROM anova JOIN mi USING (name))
SELECT name AS feature FROM n ORDER BY score DESC, name LIMIT 4"""
ORACLES["default_features"] = f"""WITH {_ENC}
SELECT id, s AS Social_event_attendance, t AS Time_spent_Alone, dr AS Drained_after_socializing_encoded,
  sf AS Stage_fear_encoded, f AS Friends_circle_size, o AS Going_outside, p AS Post_frequency FROM e"""
ORACLES["gold_table"] = f"""WITH {_RAW},
tr AS (SELECT Time_spent_Alone AS t, Social_event_attendance AS s, Going_outside AS o, Friends_circle_size AS f,
  Post_frequency AS p FROM raw WHERE id % 4 <> 0),
lim AS (SELECT {", ".join(_bounds(k) for k in _NAMES)} FROM tr),
a AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT Stage_fear AS v FROM raw WHERE id % 4 <> 0 AND Stage_fear IS NOT NULL)),
b AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT Drained_after_socializing AS v FROM raw WHERE id % 4 <> 0 AND Drained_after_socializing IS NOT NULL))
SELECT id, {", ".join(f"{_clean(v, k + 'lo', k + 'hi', k + 'md')} AS {v}" for k, v in _NAMES.items())},
  coalesce(a.code, -1) AS Stage_fear_encoded, coalesce(b.code, -1) AS Drained_after_socializing_encoded, Personality,
  CASE WHEN Personality = 'Extrovert' THEN 1 ELSE 0 END AS Personality_encoded
FROM raw CROSS JOIN lim LEFT JOIN a ON a.v = Stage_fear LEFT JOIN b ON b.v = Drained_after_socializing"""

# ---- folds ----
ORACLES["stratified_folds"] = f"WITH {_FOLDS} SELECT id, fold FROM folds"
ORACLES["fold_leakage"] = f"""WITH {_FOLDS}
SELECT fold, (SELECT count(*) FROM folds) - count(*) AS train_rows, count(*) AS valid_rows,
  CAST(0 AS BIGINT) AS overlap, 1 AS valid FROM folds GROUP BY fold"""
ORACLES["first_slice"] = f"""WITH {_ENC},
lim AS (SELECT {", ".join(f"quantile_cont({k}, 0.01) AS {k}1, quantile_cont({k}, 0.99) AS {k}9" for k in _NAMES)} FROM e),
b AS (SELECT Personality, sf, dr, {", ".join(f"CASE WHEN {k} IS NULL THEN NULL ELSE least(greatest({k}, {k}1), {k}9) END AS {k}" for k in _NAMES)}
  FROM e CROSS JOIN lim)
SELECT Personality, count(*) AS n, round(avg(coalesce(s, 0) + coalesce(o, 0) + coalesce(f, 0)), 6) AS avg_extrovert_score,
  round(avg(CASE WHEN t > 0 THEN s / (t + 1e-8) END), 6) AS avg_social_ratio,
  CAST(sum(CAST(sf IS NULL AND dr IS NULL AS INTEGER)) AS BIGINT) AS both_missing FROM b GROUP BY Personality"""

# ---- frozen ranks, bins, rare values ----


def _frozen_rank(source: str, name: str, x: str) -> str:
    """Rank table of train values x: (v, r), ties at their mean rank."""
    return f"""{name} AS (SELECT x AS v, (sum(n) OVER (ORDER BY x) - n + (n + 1) / 2.0) / sum(n) OVER () AS r, sum(n) OVER () AS rows
  FROM (SELECT {x} AS x, count(*) AS n FROM {source} WHERE id % 4 <> 0 AND {x} IS NOT NULL GROUP BY 1))"""


def _looked_up(k: str) -> str:
    return f"SELECT id, CASE WHEN {k} IS NOT NULL THEN coalesce(r, 0) END AS r, rows FROM q ASOF LEFT JOIN r{k} ON q.{k} >= r{k}.v"


ORACLES["percent_rank_unseen"] = f"""WITH {_ENC}, {", ".join(_frozen_rank("e", "r" + k, k) for k in "stf")},
q AS (SELECT * FROM e WHERE id % 4 = 0), {", ".join(f"l{k} AS ({_looked_up(k)})" for k in "stf")}
SELECT q.id, round(ls.r, 8) AS Social_event_attendance_percentile, round(lt.r, 8) AS Time_spent_Alone_percentile,
  round(lf.r, 8) AS Friends_circle_size_percentile FROM q JOIN ls USING (id) JOIN lt USING (id) JOIN lf USING (id)"""
ORACLES["percent_rank_unseen_prices"] = f"""WITH e AS (SELECT o_orderkey AS id, o_totalprice AS o FROM orders), {_frozen_rank("e", "ro", "o")},
q AS (SELECT * FROM e WHERE id % 4 = 0), l AS ({_looked_up("o")}) SELECT id, round(r, 8) AS price_percentile FROM l"""

# Acklam's rational approximation of the normal quantile (fixed values).
_GAUSS = """
CREATE_MIDDLE AS (SELECT id, k, share, CASE
  WHEN share IS NULL THEN NULL
  WHEN share < 0.02425 THEN ((((((-7.784894002430293e-03 * rl + -3.223964580411365e-01) * rl + -2.400758277161838e00) * rl + -2.549732539343734e00) * rl
    + 4.374664141464968e00) * rl + 2.938163982698783e00)
    / ((((7.784695709041462e-03 * rl + 3.224671290700398e-01) * rl + 2.445134137142996e00) * rl + 3.754408661907416e00) * rl + 1.0))
  WHEN share > 0.97575 THEN -((((((-7.784894002430293e-03 * rh + -3.223964580411365e-01) * rh + -2.400758277161838e00) * rh + -2.549732539343734e00) * rh
    + 4.374664141464968e00) * rh + 2.938163982698783e00)
    / ((((7.784695709041462e-03 * rh + 3.224671290700398e-01) * rh + 2.445134137142996e00) * rh + 3.754408661907416e00) * rh + 1.0))
  ELSE (((((-3.969683028665376e01 * s + 2.209460984245205e02) * s + -2.759285104469687e02) * s + 1.383577518672690e02) * s + -3.066479806614716e01) * s
    + 2.506628277459239e00) * c
    / (((((-5.447609879822406e01 * s + 1.615858368580409e02) * s + -1.556989798598866e02) * s + 6.680131188771972e01) * s + -1.328068155288572e01) * s + 1.0)
  END AS z
  FROM (SELECT *, share - 0.5 AS c, (share - 0.5) * (share - 0.5) AS s, sqrt(-2 * ln(share)) AS rl, sqrt(-2 * ln(1 - share)) AS rh FROM shares))""".replace("CREATE_MIDDLE", "zs")
_SKEWED = {k: v for k, v in _NAMES.items() if k != "t"}
ORACLES["rank_gauss"] = f"""WITH {_ENC}, {", ".join(_frozen_rank("e", "r" + k, k) for k in _SKEWED)},
q AS (SELECT * FROM e), {", ".join(f"l{k} AS ({_looked_up(k)})" for k in _SKEWED)},
tops AS ({" UNION ALL ".join(f"SELECT '{k}' AS k, max(rows) AS n FROM r{k}" for k in _SKEWED)}),
every AS ({" UNION ALL ".join(f"SELECT id, '{k}' AS k, r FROM l{k}" for k in _SKEWED)}),
shares AS (SELECT id, k, CASE WHEN r IS NOT NULL THEN greatest(least(r - 0.5 / n, 1 - 0.5 / n), 0.5 / n) END AS share FROM every JOIN tops USING (k)), {_GAUSS}
SELECT id, {", ".join(f"round(max(z) FILTER (k = '{k}'), 6) AS {v}_gauss" for k, v in _SKEWED.items())} FROM zs GROUP BY id"""

def _binned(k: str, x: str) -> str:
    return f"CAST(CASE WHEN {x} IS NULL THEN -1 ELSE len(list_filter(list_distinct({k}q), lambda c: c < {x})) END AS INTEGER) AS {_NAMES[k]}_bin"


_TENTHS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
ORACLES["quantile_bins"] = f"""WITH {_ENC},
x AS (SELECT id, t, s, f, p, CASE WHEN id % 7 = 0 THEN 'NaN'::DOUBLE WHEN id % 11 = 0 THEN 'Infinity'::DOUBLE WHEN id % 13 = 0 THEN '-Infinity'::DOUBLE ELSE o END AS o FROM e),
qs AS (SELECT {", ".join(f"quantile_cont({k}, {_TENTHS}) AS {k}q" for k in "tsfp")},
  quantile_cont(CASE WHEN isfinite(o) THEN o END, {_TENTHS}) AS oq FROM x WHERE id % 4 <> 0)
SELECT id, {", ".join(_binned(k, k) for k in "tsfp")}, {_binned("o", "o")} FROM x CROSS JOIN qs"""
ORACLES["robust_scaling"] = f"""WITH {_ENC},
qs AS (SELECT {", ".join(f"quantile_cont({k}, 0.25) AS {k}1, quantile_cont({k}, 0.5) AS {k}2, quantile_cont({k}, 0.75) AS {k}3" for k in _NAMES)} FROM e WHERE id % 4 <> 0)
SELECT id, {", ".join(f"round(CASE WHEN {k} IS NOT NULL THEN least(greatest(({k} - {k}2) / ({k}3 - {k}1), -3), 3) END, 6) AS {v}_robust" for k, v in _NAMES.items())}
FROM e CROSS JOIN qs"""
ORACLES["rare_categories"] = """WITH l AS (SELECT l_orderkey AS id, CAST(l_partkey AS VARCHAR) AS part, l_returnflag AS flag FROM lineitem),
fp AS (SELECT part FROM l WHERE id % 4 <> 0 GROUP BY part HAVING count(*) >= 25),
ff AS (SELECT flag FROM l WHERE id % 4 <> 0 GROUP BY flag HAVING count(*) >= 25)
SELECT coalesce(fp.part, '__rare__') AS part_grouped, coalesce(ff.flag, '__rare__') AS flag_grouped, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum
FROM l LEFT JOIN fp USING (part) LEFT JOIN ff USING (flag) GROUP BY ALL"""

# ---- pairs, drift, thresholds, submissions, experiments ----
_PARTS = ["basic_features", "participation_features", "drain_features", "communication_features", "interaction_features", "polynomial_features"]
_SILVER = f"""silver AS (SELECT * FROM ({ORACLES[_PARTS[0]]}) {" ".join(f"JOIN ({ORACLES[n]}) USING (id)" for n in _PARTS[1:])})"""
# The second table of a long join repeats the first; gaps leave with the unpivoting.
ORACLES["correlated_pairs"] = f"""WITH {_SILVER},
l AS (UNPIVOT (SELECT id, CAST(COLUMNS(* EXCLUDE (id)) AS DOUBLE) FROM silver) ON COLUMNS(* EXCLUDE (id)) INTO NAME name VALUE x),
c AS (SELECT a.name AS l, b.name AS r, count(*) AS pairs, corr(a.x, b.x) AS v FROM l a JOIN l b ON a.id = b.id AND a.name < b.name GROUP BY a.name, b.name)
SELECT l AS left, r AS right, pairs, round(v, 4) AS r FROM c WHERE NOT isnan(v) AND abs(v) > 0.95"""
_SHIFTED = f"""{_RAW},
u AS (SELECT id, coalesce(Stage_fear = 'Yes', false) AS urgent, {", ".join(f"{v} AS {k}" for k, v in _NAMES.items() if k != "f")},
  CASE WHEN Stage_fear = 'Yes' THEN Friends_circle_size * 2 ELSE Friends_circle_size END AS f, Stage_fear, Drained_after_socializing, Personality FROM raw)"""
ORACLES["drift_report"] = f"""WITH {_SHIFTED},
n AS ({" UNION ALL ".join(f"SELECT '{v}' AS column_name, urgent, {k} AS x FROM u" for k, v in _NAMES.items())}),
m AS (SELECT column_name, avg(x) FILTER (NOT urgent) AS a, avg(x) FILTER (urgent) AS b,
  1 - count(x) FILTER (NOT urgent) / count(*) FILTER (NOT urgent) AS ga, 1 - count(x) FILTER (urgent) / count(*) FILTER (urgent) AS gb FROM n GROUP BY column_name),
c AS ({" UNION ALL ".join(f"SELECT '{v}' AS column_name, urgent, {v} AS value FROM u" for v in ("Stage_fear", "Drained_after_socializing", "Personality"))}),
g AS (SELECT column_name, value, count(*) FILTER (NOT urgent) AS na, count(*) FILTER (urgent) AS nb FROM c WHERE value IS NOT NULL GROUP BY ALL)
SELECT column_name, 'mean_shift' AS finding, NULL::VARCHAR AS value, round(a, 6) AS train_value, round(b, 6) AS other_value FROM m WHERE abs(b - a) > 0.1 * abs(a)
UNION ALL SELECT column_name, 'missing_shift', NULL, round(ga, 6), round(gb, 6) FROM m WHERE abs(ga - gb) > 0.1
UNION ALL SELECT column_name, 'new_category', value, NULL, nb::DOUBLE FROM g WHERE na = 0
UNION ALL SELECT column_name, 'lost_category', value, na::DOUBLE, NULL FROM g WHERE nb = 0"""
_CUTS = "[" + ", ".join(f"{i / 100}::DOUBLE" for i in range(10, 90)) + "]"
_THRESHOLDS = f"""th AS (SELECT unnest({_CUTS}) AS threshold),
ta AS (SELECT fold, threshold, avg(CASE WHEN (p > threshold)::INT = label THEN 1.0 ELSE 0.0 END) AS accuracy,
  count(*) FILTER (p > threshold) AS predicted_ones FROM fp CROSS JOIN th GROUP BY fold, threshold)"""
ORACLES["threshold_search"] = f"""WITH {_PRED}, th AS (SELECT unnest({_CUTS}) AS threshold)
SELECT threshold, round(avg(CASE WHEN (p > threshold)::INT = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) FILTER (p > threshold) AS predicted_ones FROM pred CROSS JOIN th GROUP BY threshold"""
ORACLES["best_fold_threshold"] = f"""WITH {_PRED}, {_THRESHOLDS},
r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY round(accuracy, 12) DESC, threshold) AS r FROM ta)
SELECT fold, threshold, round(accuracy, 6) AS accuracy, predicted_ones FROM r WHERE r = 1"""
ORACLES["submission_faults"] = f"""WITH {_PRED},
s0 AS (SELECT CASE WHEN id % 1000 = 5 THEN -id WHEN id % 1000 <> 7 THEN id END AS id, CASE WHEN id % 500 = 9 THEN 'Ambivert' ELSE Personality END AS label,
  CASE WHEN id % 700 = 1 THEN p + 2 ELSE p END AS p FROM pred WHERE id % 1000 <> 3),
s AS (SELECT * FROM s0 UNION ALL SELECT * FROM s0 WHERE id % 900 = 11),
g AS (SELECT id, count(*) AS n FROM s GROUP BY id)
SELECT 'unexpected_column' AS fault, NULL::VARCHAR AS id, 'comment' AS value, 1::BIGINT AS n
UNION ALL SELECT 'missing_id', id::VARCHAR, NULL, 1 FROM raw WHERE id NOT IN (SELECT id FROM g WHERE id IS NOT NULL)
UNION ALL SELECT 'unexpected_id', id::VARCHAR, NULL, n FROM g WHERE id NOT IN (SELECT id FROM raw)
UNION ALL SELECT 'duplicate_id', id::VARCHAR, NULL, n FROM g WHERE id IS NOT NULL AND n > 1
UNION ALL SELECT 'null_id', NULL, NULL, n FROM g WHERE id IS NULL
UNION ALL SELECT 'bad_label', id::VARCHAR, label, 1 FROM s WHERE label NOT IN ('Extrovert', 'Introvert')
UNION ALL SELECT 'bad_probability', id::VARCHAR, round(p * 100)::BIGINT::VARCHAR, 1 FROM s WHERE p > 1"""
ORACLES["experiment_top_runs"] = """WITH g AS (SELECT c_nationkey AS k, avg(c_acctbal) AS m FROM customer GROUP BY 1),
r AS (SELECT printf('run-%02d', k) AS run, printf('group-%d', k % 3) AS name, CASE WHEN k % 4 <> 0 THEN round(m, 4) ELSE 0.0 END AS value FROM g),
o AS (SELECT row_number() OVER (ORDER BY value DESC, run) AS rank, * FROM r) SELECT rank::INT AS rank, run, name, value FROM o WHERE rank <= 20"""
ORACLES["experiment_comparison"] = """WITH g AS (SELECT o_orderstatus AS name, o_orderpriority, round(avg(o_totalprice), 2) AS v FROM orders GROUP BY ALL)
SELECT name, count(*) AS runs, round(avg(v), 2) AS mean_value, round(max(v), 2) AS best_value FROM g GROUP BY name"""

# ---- all columns of the layers, known answers of training ----
ORACLES["silver_all_columns"] = f"WITH {_SILVER} SELECT * FROM silver"
_TRAIN_SILVER = _SILVER.replace("SELECT max(s) AS smax FROM e)", "SELECT max(s) AS smax FROM e WHERE id % 4 <> 0)")
ORACLES["enhanced_one_call"] = f"""WITH {_TRAIN_SILVER}, te AS ({ORACLES["target_encode"].replace("WHERE c.id % 4 = 0)", ")").replace("Stage_fear AS category", "CAST(" + _YES_NO.format(c="Stage_fear").replace("1.0", "'1.0'").replace("0.0", "'0.0'") + " AS VARCHAR) AS category").replace("Drained_after_socializing AS category", "Drained_after_socializing AS category")})
SELECT * FROM silver JOIN te USING (id)"""
ORACLES["enhanced_oversampled"] = f"""WITH {_ENC}, c AS (SELECT y, count(*) AS n FROM e WHERE id % 4 <> 0 GROUP BY y)
SELECT y AS Personality_encoded, max(n) OVER () AS n, CAST(0 AS BIGINT) AS gaps FROM c"""
ORACLES["gold_all_columns"] = f"""WITH {_SILVER},
l AS (UNPIVOT (SELECT id, CAST(COLUMNS(* EXCLUDE (id)) AS DOUBLE) FROM silver) ON COLUMNS(* EXCLUDE (id)) INTO NAME feature VALUE x),
lim AS (SELECT feature, {_bounds("x")} FROM l WHERE id % 4 <> 0 GROUP BY feature),
every AS (SELECT id, feature FROM (SELECT id FROM silver) CROSS JOIN (SELECT feature FROM lim)),
g AS (SELECT id, feature, {_clean("x", "least(xlo, xhi)", "greatest(xlo, xhi)", "xmd")} AS x FROM every JOIN lim USING (feature) LEFT JOIN l USING (id, feature))
SELECT feature, count(x) AS n, round(sign(min(x)) * ln(1 + abs(min(x))), 6) AS least, round(sign(max(x)) * ln(1 + abs(max(x))), 6) AS most, round(sign(sum(x)) * ln(1 + abs(sum(x))), 6) AS total,
  round(sign(sum(x * (id % 97))) * ln(1 + abs(sum(x * (id % 97)))), 6) AS weighted FROM g GROUP BY feature"""
_DECIDED = f"""WITH {_FOLDS} SELECT fold, count(*) AS rows, count(DISTINCT id) AS ids, CAST(count(*) FILTER (o > 100) AS BIGINT) AS ones,
  true AS p_in_range, true AS learned FROM folds GROUP BY fold"""
ORACLES["cross_validation_logistic"] = _DECIDED
ORACLES["cross_validation_forest"] = _DECIDED
ORACLES["learner_round_trip"] = "SELECT o_orderkey AS id, true AS same, true AS p_in_range FROM orders"
ORACLES["search_with_failure"] = """SELECT CAST(i AS INTEGER) AS trial, CASE WHEN i = 2 THEN 'failed' ELSE 'complete' END AS state,
  CASE WHEN i = 2 THEN 2 ELSE 1 END AS attempts, true AS not_above_best, i = 2 AS worst, 9 AS parameters FROM range(5) t(i)"""
