"""Silver: ratios, row statistics, interactions, polynomial terms, scaling.

Every feature is one column expression; a stage is one projection; features
whose inputs are absent are left out at plan time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions import rows
from tierwise.functions.columns import ratio, zero_if_missing
from tierwise.operators.stats import mean_and_std, summarise
from tierwise.spec import DEFAULT, FeatureSpec, has, numeric_columns


class _Stage:
    """Collects features of one projection, keeping those whose inputs exist."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.new: dict[str, Column] = {}

    def add(self, needs: Sequence[str], **features: Column) -> None:
        if has(self.df, *needs):
            self.new.update(features)

    def done(self) -> DataFrame:
        return self.df.withColumns(self.new) if self.new else self.df


def fit_basic(df: DataFrame, spec: FeatureSpec = DEFAULT) -> dict[str, float | None]:
    """The one table statistic of the basic features: the largest attendance."""
    return summarise(df, {"social_max": F.max(spec.social)}) if has(df, spec.social) else {}


def basic_features(df: DataFrame, fitted: Mapping[str, Any] | None = None, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Participation ratios, row statistics, scores and transforms.

    ``social_percentage`` needs ``fitted``; without it the stage is stateless.
    """
    alone, social, outside, friends, posts = spec.measures
    a, s, o, f, p = (F.col(c) for c in spec.measures)
    fear, drained = f"{spec.fear}_encoded", f"{spec.drained}_encoded"
    sf, dr = F.col(fear), F.col(drained)
    stage = _Stage(df)
    stage.add([social, outside], social_participation_rate=ratio(s, o), non_social_outings=o - s, activity_sum=o + s)
    stage.add([posts, social, outside], communication_ratio=ratio(p, s + o))
    stage.add([social, friends], friend_social_efficiency=ratio(s, f))
    stage.add(
        [alone, social],
        activity_balance=ratio(s, a),
        social_ratio=ratio(s, a),
        social_alone_interaction=s * a,
        social_alone_ratio=ratio(s, a),
    )
    low, high = rows.row_min(spec.measures), rows.row_max(spec.measures)
    stage.add(
        spec.measures,
        total_activity=rows.row_sum(spec.measures),
        avg_activity=rows.row_mean(spec.measures),
        activity_std=rows.row_std(spec.measures),
        activity_min=low,
        activity_max=high,
        activity_range=high - low,
    )
    stage.add(
        [friends, posts],
        post_per_friend=ratio(p, f),
        friend_efficiency=ratio(f, p),
        friends_post_interaction=f * p,
        friends_post_ratio=ratio(f, p),
    )
    stage.add(
        [fear, drained],
        fear_drain_interaction=sf * dr,
        fear_drain_sum=sf + dr,
        fear_drain_ratio=ratio(sf, dr),
    )
    outward = spec.present(df, [social, outside, friends])
    inward = spec.present(df, [alone, fear, drained])
    if outward:
        stage.add(
            outward,
            extrovert_score=rows.row_sum(outward),
            extrovert_avg=rows.row_mean(outward),
            extrovert_std=rows.row_std(outward),
        )
    if inward:
        stage.add(
            inward,
            introvert_score=rows.row_sum(inward),
            introvert_avg=rows.row_mean(inward),
            introvert_std=rows.row_std_zero_filled(inward),
        )
    if outward and inward:
        e, i = rows.row_sum(outward), rows.row_sum(inward)
        stage.add([], personality_balance=e - i, personality_ratio=e / F.greatest(i, F.lit(1.0)), personality_sum=e + i)
    stage.add(
        [alone],
        alone_percentage=a / F.lit(24.0),
        alone_squared=a * a,
        alone_log=F.when(a.isNotNull(), F.log1p(F.greatest(a, F.lit(0.0)))),
    )
    stage.add([social], social_squared=s * s, social_log=F.log1p(s))
    if fitted and fitted.get("social_max") is not None:
        stage.add([social], social_percentage=ratio(s, F.lit(fitted["social_max"])))
    return stage.done()


def participation_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Second set of participation ratios; ``w_`` keeps the names distinct from
    the basic ones, which would differ by case only."""
    alone, social, outside, friends, posts = spec.measures
    s, o, f, p = (F.col(c) for c in (social, outside, friends, posts))
    stage = _Stage(df)
    stage.add([social, outside], w_participation_rate=ratio(s, o), w_non_social_outings=o - s)
    stage.add([posts, social, outside], w_communication_ratio=ratio(p, s + o))
    stage.add([social, friends], w_friend_efficiency=ratio(s, f))
    return stage.done()


def drain_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Activity total, its share left after being drained, and the spectrum."""
    stage = _Stage(df)
    active = spec.present(df, [spec.social, spec.outside, spec.posts])
    if active:
        activity = rows.row_sum(active)
        stage.add([], Activity_ratio=activity)
        if has(df, f"{spec.drained}_encoded"):
            stage.add([], Drain_adjusted_activity=activity * (1 - F.col(f"{spec.drained}_encoded")))
        elif has(df, spec.drained):
            said_yes = F.coalesce(F.col(spec.drained).cast("string") == "Yes", F.lit(False)).cast("double")
            stage.add([], Drain_adjusted_activity=activity * (1 - said_yes))
    outward = spec.present(df, [spec.social, spec.outside, spec.friends])
    if outward or has(df, spec.alone):
        spectrum = F.lit(0.0)
        for c in outward:
            spectrum = spectrum + F.col(c)
        if has(df, spec.alone):
            spectrum = spectrum - F.col(spec.alone)
        stage.add([], Introvert_extrovert_spectrum=spectrum)
    return stage.done()


def communication_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    s, o, p = F.col(spec.social), F.col(spec.outside), F.col(spec.posts)
    stage = _Stage(df)
    stage.add([spec.posts, spec.social, spec.outside], Online_offline_ratio=ratio(p, s + o))
    stage.add([spec.posts, spec.social], Communication_balance=ratio(p, p + s))
    return stage.done()


def interaction_features(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Products and ratios of the three leading features with the others."""
    alone, social, outside, friends, posts = spec.measures
    a, s, o, f, p = (F.col(c) for c in spec.measures)
    drained = f"{spec.drained}_encoded"
    e, r, rate = F.col("extrovert_score"), F.col("social_ratio"), F.col("social_participation_rate")
    stage = _Stage(df)
    stage.add(
        ["extrovert_score", "social_ratio"],
        extrovert_social_interaction=e * r,
        extrovert_social_ratio=ratio(e, r),
        social_extrovert_ratio=ratio(r, e),
    )
    stage.add(
        ["extrovert_score", social],
        extrovert_social_event_interaction=e * s,
        extrovert_social_event_ratio=ratio(e, s),
    )
    stage.add(
        ["extrovert_score", alone],
        extrovert_alone_interaction=e * a,
        extrovert_alone_contrast=e - a,
        extrovert_alone_ratio=ratio(e, a),
    )
    if has(df, drained):
        d = F.col(drained)
        stage.add(
            ["extrovert_score"],
            extrovert_drain_interaction=e * d,
            extrovert_drain_ratio=F.when(d.isNotNull(), e / F.greatest(d, F.lit(1.0))),
        )
    stage.add(
        ["extrovert_score", friends], extrovert_friends_interaction=e * f, extrovert_friends_ratio=ratio(e, f)
    )
    stage.add(["social_ratio", friends], social_friends_interaction=r * f, social_friends_ratio=ratio(r, f))
    stage.add(["social_ratio", outside], social_outside_interaction=r * o, social_outside_ratio=ratio(r, o))
    stage.add(["social_ratio", posts], social_post_interaction=r * p, social_post_ratio=ratio(r, p))
    stage.add(
        ["social_participation_rate", alone],
        participation_alone_interaction=rate * a,
        participation_alone_ratio=ratio(rate, a),
    )
    stage.add(
        ["social_participation_rate", friends],
        participation_friends_interaction=rate * f,
        participation_friends_ratio=ratio(rate, f),
    )
    stage.add(["extrovert_score", "social_ratio", social], triple_interaction=e * r * s)
    stage.add(
        ["extrovert_score", "social_participation_rate", alone], triple_participation_interaction=e * rate * a
    )
    comm, eff = F.col("communication_ratio"), F.col("friend_social_efficiency")
    stage.add(
        ["social_ratio", "communication_ratio", "friend_social_efficiency"],
        composite_social_score=(r + comm + eff) / F.lit(3.0),
        social_efficiency_balance=r * eff,
    )
    return stage.done()


def polynomial_inputs(spec: FeatureSpec = DEFAULT) -> list[str]:
    # The inputs of the degree-2 terms, in order.
    return [
        "extrovert_score",
        "social_ratio",
        "social_participation_rate",
        "communication_ratio",
        "friend_social_efficiency",
        spec.social,
        spec.alone,
        spec.friends,
        spec.outside,
        spec.posts,
    ]


def polynomial_features(df: DataFrame, spec: FeatureSpec = DEFAULT, columns: Sequence[str] | None = None) -> DataFrame:
    """All squares and pairwise products; missing and infinite inputs count as 0."""
    numeric = set(numeric_columns(df))
    names = [c for c in (columns or polynomial_inputs(spec)) if c in numeric]
    if len(names) < 2:
        return df
    new: dict[str, Column] = {}
    for i, left in enumerate(names):
        for right in names[i:]:
            name = f"poly_{left}_pow_2" if left == right else f"poly_{left}_{right}"
            new[name] = zero_if_missing(F.col(left)) * zero_if_missing(F.col(right))
    return df.withColumns(new)


def fit_scaling(df: DataFrame, spec: FeatureSpec = DEFAULT, population: bool = False) -> dict[str, list[float]]:
    """(mean, deviation) of every numeric or boolean column but the id; columns
    without spread are left out."""
    columns = [c for c in numeric_columns(df, booleans=True) if c != spec.id]
    got = mean_and_std(df, columns, population)
    return {c: [m, s] for c, (m, s) in got.items() if s is not None and s > 0}


def scale(df: DataFrame, fitted: Mapping[str, Sequence[float]], in_place: bool = False) -> DataFrame:
    """Add ``<name>_scaled`` z-values, or replace the columns."""
    new = {
        (c if in_place else f"{c}_scaled"): (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
        for c, (m, s) in fitted.items()
        if c in df.columns
    }
    return df.withColumns(new) if new else df


def derive(df: DataFrame, fitted: Mapping[str, Any] | None = None, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """The five feature stages in order, without polynomial terms or scaling."""
    out = basic_features(df, fitted, spec)
    out = participation_features(out, spec)
    out = drain_features(out, spec)
    out = communication_features(out, spec)
    return interaction_features(out, spec)


def fit_fold_safe_silver(train: DataFrame, spec: FeatureSpec = DEFAULT) -> dict[str, Any]:
    """Everything the fold-safe silver step learns, from training rows only."""
    basic = fit_basic(train, spec)
    scaling = fit_scaling(derive(train, basic, spec), spec, population=True)
    return {"basic": basic, "scaling": {c: v for c, v in scaling.items() if c not in spec.not_features}}


def fold_safe_silver(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    return scale(derive(df, fitted["basic"], spec), fitted["scaling"], in_place=True)
