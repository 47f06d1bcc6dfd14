"""Gold: limit and fill, code text, score and select features, assemble."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwise.functions.columns import clip, finite, flag, total
from tierwise.operators.encode import encode_codes, fit_codes
from tierwise.operators.stats import per_column, quantiles, unpivot
from tierwise.spec import DEFAULT, FeatureSpec, numeric_columns, text_columns

FENCE = 3.0
ABS_LIMIT = 1e5
BINS = 10


def fit_clean(df: DataFrame, spec: FeatureSpec = DEFAULT, compat: bool = False, **kw) -> dict[str, dict[str, Any]]:
    """Limits and fill value of every numeric column but the id.

    Two-valued columns and the label code are filled but not clipped, because
    fences drawn from quartiles would flatten a rare flag; ``compat`` clips
    them too. The fill is the median after clipping. It is read off together
    with the quartiles: clipping moves no value past the median unless the
    absolute limit does, and that limit is applied before the median is taken.
    """
    columns = [c for c in numeric_columns(df) if c != spec.id and (compat or c != spec.label_code)]
    x = {c: finite(F.col(c)) for c in columns}
    if not columns:
        return {}
    ends = per_column(df, x, {"n": F.count, "low": F.min, "high": F.max})
    kw.setdefault("rows", max(s["n"] for s in ends.values()))
    held = {c: s for c, s in ends.items() if s["n"]}
    wanted: dict[Any, tuple[Column, Sequence[float]]] = {c: (x[c], [0.25, 0.5, 0.75]) for c in held}
    far = [c for c, s in held.items() if s["low"] < -ABS_LIMIT or s["high"] > ABS_LIMIT]
    wanted.update({(c, "limited"): (clip(x[c], -ABS_LIMIT, ABS_LIMIT), [0.5]) for c in far})
    got = quantiles(df, wanted, **kw)
    fitted: dict[str, dict[str, Any]] = {}
    for c in held:
        q1, median, q3 = got[c]
        low = max(q1 - FENCE * (q3 - q1), -ABS_LIMIT)
        high = min(q3 + FENCE * (q3 - q1), ABS_LIMIT)
        fitted[c] = {"low": low, "high": high, "fill": got[c, "limited"][0] if c in far else median}
    biting = [c for c, s in fitted.items() if s["low"] > held[c]["low"] or s["high"] < held[c]["high"]]
    if not compat:
        # A column with nothing strictly between its ends is two-valued.
        inner = {c: F.when((x[c] > held[c]["low"]) & (x[c] < held[c]["high"]), x[c]) for c in biting}
        flags = [c for c, s in per_column(df, inner, {"n": F.count}).items() if not s["n"]]
        for c in flags:
            fitted[c] = {"low": None, "high": None, "fill": got[c][1]}
            biting.remove(c)
    # The whole column lies beyond the absolute limit: the bounds have crossed.
    crossed = {c: (s["high"], s["low"]) for c, s in fitted.items() if c in biting and s["low"] > s["high"]}
    medians = quantiles(df, {c: (clip(x[c], *bounds), [0.5]) for c, bounds in crossed.items()}, **kw)
    for c, (low, high) in crossed.items():
        fitted[c] = {"low": low, "high": high, "fill": medians[c][0]}
    return fitted


def clean(df: DataFrame, fitted: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """+-inf to missing, limit, fill; one projection."""
    new = {}
    for c, s in fitted.items():
        if c in df.columns:
            value = clip(finite(F.col(c)), s["low"], s["high"])
            new[c] = F.coalesce(value, F.lit(s["fill"]).cast("double"))
    return df.withColumns(new) if new else df


def encode_label(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    if spec.label not in df.columns:
        return df
    return df.withColumn(spec.label_code, flag(F.col(spec.label) == spec.positive))


def label_value(df: DataFrame, spec: FeatureSpec = DEFAULT) -> Column:
    """The 0/1 label, from its code column or its text; the positive class is 1."""
    if spec.label_code in df.columns:
        return F.col(spec.label_code).cast("int")
    if spec.label in df.columns:
        return flag(F.col(spec.label) == spec.positive)
    raise ValueError(f"no label column {spec.label!r} or {spec.label_code!r}")


def candidate_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> list[str]:
    return [c for c in numeric_columns(df) if c not in spec.not_features]


def feature_names(df: DataFrame, spec: FeatureSpec = DEFAULT) -> list[str]:
    return [c for c in df.columns if c not in spec.not_features]


def model_columns(df: DataFrame, spec: FeatureSpec = DEFAULT) -> tuple[DataFrame, list[str]]:
    """(id, numeric features, label 0/1) and the feature names."""
    names = candidate_features(df, spec)
    keep = [spec.id] if spec.id in df.columns else []
    return df.select(*keep, *names, label_value(df, spec).alias("label")), names


def fill_medians(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    got = quantiles(df, {c: (finite(F.col(c)), [0.5]) for c in columns}, **kw)
    return df.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(got[c][0]).cast("double")) for c in columns})


def anova_scores(df: DataFrame, columns: Sequence[str], label: Column) -> dict[str, float]:
    """F-score of each feature: one grouping by class, a few numbers per class."""
    got = per_column(df, {c: F.col(c) for c in columns}, {"n": F.count, "m": F.avg, "v": F.var_pop}, by=label)
    out = {}
    for c in columns:
        classes = [s for (name, _), s in got.items() if name == c and s["n"]]
        total, k = sum(s["n"] for s in classes), len(classes)
        if k < 2 or total <= k:
            out[c] = 0.0
            continue
        mean = sum(s["n"] * s["m"] for s in classes) / total
        among = sum(s["n"] * (s["m"] - mean) ** 2 for s in classes) / (k - 1)
        within = sum(s["n"] * s["v"] for s in classes) / (total - k)
        out[c] = among / within if within > 0 else (math.inf if among > 0 else 0.0)
    return out


def information_scores(df: DataFrame, columns: Sequence[str], label: Column, bins: int = BINS, **kw) -> dict[str, float]:
    """Mutual information (nats) of each feature, cut at its quantiles, with the label."""
    edges = quantiles(df, {c: (F.col(c), [i / bins for i in range(1, bins)]) for c in columns}, **kw)
    steps = [f"e{j}" for j in range(bins - 1)]
    cuts = df.sparkSession.createDataFrame(
        [(i, *edges[c]) for i, c in enumerate(columns) if edges[c][0] is not None],
        ", ".join(["fi int", *[f"{e} double" for e in steps]]),
    )
    cell = total([flag(F.col("x") > F.col(e)) for e in steps])
    # One row of cut points per feature.
    counts = (
        unpivot(df, {c: F.col(c) for c in columns}, label.alias("y"))
        .join(F.broadcast(cuts), F.col("f") == F.col("fi"))
        .groupBy("f", cell.alias("bin"), "y")
        .agg(F.count("*").alias("n"))
    )
    # At most bins x classes rows per feature.
    share = lambda *by: F.sum("n").over(Window.partitionBy("f", *by))
    n = F.col("n") / share()
    term = n * F.log(n / ((share("bin") / share()) * (share("y") / share())))
    rows = counts.withColumn("term", term).groupBy("f").agg(F.sum("term").alias("mi")).collect()
    got = {columns[r["f"]]: max(r["mi"], 0.0) for r in rows}
    return {c: got.get(c, 0.0) for c in columns}


def _unit_range(scores: Mapping[str, float]) -> dict[str, float]:
    top = max(scores.values())
    if math.isinf(top):
        return {c: 1.0 if math.isinf(v) else 0.0 for c, v in scores.items()}
    low = min(scores.values())
    return {c: (v - low) / (top - low + 1e-8) for c, v in scores.items()}


def score_features(df: DataFrame, spec: FeatureSpec = DEFAULT, method: str = "combined", columns: Sequence[str] | None = None, filled: bool = False, **kw) -> dict[str, float]:
    """Score per feature. ``filled`` says that no value is missing or infinite."""
    names = list(columns) if columns is not None else candidate_features(df, spec)
    label = label_value(df, spec)
    ready = df if filled else fill_medians(df, names, **kw)
    if method == "statistical":
        return anova_scores(ready, names, label)
    if method == "mutual_info":
        return information_scores(ready, names, label, **kw)
    if method != "combined":
        raise ValueError(f"unknown selection method {method!r}")
    f = _unit_range(anova_scores(ready, names, label))
    mi = _unit_range(information_scores(ready, names, label, **kw))
    return {c: f[c] + mi[c] for c in names}


def scores_frame(spark: SparkSession, scores: Mapping[str, float]) -> DataFrame:
    """One row per feature (bounded by the number of columns)."""
    return spark.createDataFrame(sorted(scores.items()), "feature string, score double")


def select_features(df: DataFrame, spec: FeatureSpec = DEFAULT, k: int = 30, method: str = "combined", **kw) -> list[str]:
    """The k best features, best first; all of them if there are no more than k."""
    names = candidate_features(df, spec)
    if len(names) <= k:
        return names
    scores = score_features(df, spec, method, names, **kw)
    return sorted(names, key=lambda c: (-scores[c], c))[:k]


def default_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> list[str]:
    """The standing feature list, the polynomial terms and the encoded columns,
    as far as present, each once."""
    # The standing feature list, in order.
    standing = [
        "extrovert_score",
        "social_ratio",
        spec.social,
        spec.alone,
        f"{spec.drained}_encoded",
        f"{spec.fear}_encoded",
        spec.friends,
        spec.outside,
        spec.posts,
        "introvert_score",
        "activity_sum",
        "post_per_friend",
        "fear_drain_interaction",
        "total_activity",
        "avg_activity",
        "extrovert_social_interaction",
        "extrovert_social_ratio",
        "social_extrovert_ratio",
        "extrovert_social_event_interaction",
        "extrovert_alone_interaction",
        "extrovert_alone_contrast",
        "extrovert_drain_interaction",
        "social_friends_interaction",
        "social_outside_interaction",
        "social_post_interaction",
        "triple_interaction",
    ]
    grown = [c for c in df.columns if c.startswith("poly_") or c.endswith("_encoded")]
    wanted = [*standing, *[c for c in grown if c not in spec.not_features]]
    return list(dict.fromkeys(spec.present(df, wanted)))


def fit_gold(df: DataFrame, spec: FeatureSpec = DEFAULT, k: int = 30, auto_select: bool = True, features: Sequence[str] | None = None, compat: bool = False, **kw) -> dict[str, Any]:
    """Learn the gold step on training rows: limits, category codes, columns."""
    labelled = encode_label(df, spec)
    fitted: dict[str, Any] = {"clean": fit_clean(labelled, spec, compat, **kw)}
    texts = [c for c in text_columns(labelled) if c != spec.label]
    coded = clean(labelled, fitted["clean"])
    fitted["texts"] = texts
    if texts:
        fitted["codes"] = fit_codes(coded, texts)
        coded = encode_codes(coded, fitted["codes"], texts, spec.id)
    if features is not None:
        chosen = spec.present(coded, list(features))
    elif auto_select and spec.label_code in coded.columns:
        chosen = select_features(coded, spec, k, filled=True, **kw)
    else:
        chosen = default_features(coded, spec)
    fitted["features"] = chosen
    return fitted


def apply_gold(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """id, the chosen features, and the label (text and code) where there is one."""
    out = clean(encode_label(df, spec), fitted["clean"])
    if fitted["texts"]:
        out = encode_codes(out, fitted["codes"], fitted["texts"], spec.id)
    around = [c for c in (spec.id,) if c in out.columns]
    labels = [c for c in (spec.label, spec.label_code) if c in out.columns]
    return out.select(*around, *spec.present(out, fitted["features"]), *labels)
