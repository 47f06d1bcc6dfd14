"""Bronze: types, Yes/No text, missing flags, repair, winsorising.

``fit_*`` reads rows and returns a small plain dict; the matching operator
applies it as literals, so train statistics carry over to test data or a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions.columns import clip, finite, flag
from tierwise.operators.stats import quantiles, quantiles_of, summarise
from tierwise.spec import DEFAULT, FeatureSpec, has, numeric_columns

# The spellings of yes and no.
YES = ["yes", "y", "1", "true"]
NO = ["no", "n", "0", "false"]


def normalise_types(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Numbers to double with NaN and +-inf as NULL; text columns to string.

    The id keeps its type.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name != spec.id and isinstance(field.dataType, T.NumericType):
            c = finite(c)
        elif field.name in [*spec.yes_no, spec.label]:
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def yes_no_value(c: Column) -> Column:
    """1.0 for a yes, 0.0 for a no, NULL for anything else."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*YES), 1.0).when(word.isin(*NO), 0.0)


def is_yes(df: DataFrame, name: str) -> Column:
    """Numeric view of a Yes/No column, whether it is still text or encoded."""
    kind = df.schema[name].dataType
    return yes_no_value(F.col(name)) if isinstance(kind, T.StringType) else F.col(name).cast("double")


def encode_yes_no(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Replace each Yes/No column by 0/1/NULL and add ``<name>_encoded``."""
    new: dict[str, Column] = {}
    for name in spec.present(df, spec.yes_no):
        value = yes_no_value(F.col(name))
        new[name] = value
        new[f"{name}_encoded"] = value
    return df.withColumns(new) if new else df


def _missing(name: str) -> Column:
    return F.col(name).isNull()


def missing_flags(df: DataFrame, spec: FeatureSpec = DEFAULT, columns: Sequence[str] | None = None) -> DataFrame:
    """``<name>_missing`` per column and ``both_missing`` for the two answers.

    Values stay missing.
    """
    if columns is None:
        columns = [spec.fear, spec.outside, spec.alone, spec.drained, spec.social]
    new = {f"{c}_missing": _missing(c).cast("int") for c in spec.present(df, list(columns))}
    if has(df, *spec.yes_no):
        new["both_missing"] = (_missing(spec.fear) & _missing(spec.drained)).cast("int")
    return df.withColumns(new) if new else df


def fit_missing_patterns(df: DataFrame, spec: FeatureSpec = DEFAULT, **kw) -> dict[str, float | None]:
    """The quantile thresholds of the conditional flags and of the imputation."""
    wanted = {
        "social_q70": (spec.social, 0.7),
        "alone_q80": (spec.alone, 0.8),
        "alone_q20": (spec.alone, 0.2),
        "outside_q70": (spec.outside, 0.7),
        "posts_q70": (spec.posts, 0.7),
        "friends_q70": (spec.friends, 0.7),
    }
    per_column: dict[str, list[float]] = {}
    for column, p in wanted.values():
        if column in df.columns:
            per_column.setdefault(column, []).append(p)
    got = quantiles(df, {c: (F.col(c), ps) for c, ps in per_column.items()}, **kw)
    return {k: got[c][per_column[c].index(p)] for k, (c, p) in wanted.items() if c in per_column}


def _above(name: str, limit: float | None) -> Column:
    return F.col(name) > F.lit(limit).cast("double")


def _below(name: str, limit: float | None) -> Column:
    return F.col(name) < F.lit(limit).cast("double")


def missing_patterns(df: DataFrame, fitted: dict[str, float | None], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Flags of missing values, alone and in combination with high or low measures."""
    q = fitted.get
    plain = [spec.fear, spec.drained, spec.outside, spec.alone, spec.social, spec.friends]
    new = {f"{c}_missing": _missing(c).cast("int") for c in spec.present(df, plain)}
    if has(df, spec.fear, spec.drained):
        fear, drained = _missing(spec.fear), _missing(spec.drained)
        new["social_anxiety_complete_missing"] = (fear & drained).cast("int")
        new["social_anxiety_partial_missing"] = (fear != drained).cast("int")
        if has(df, spec.social):
            new["social_fatigue_missing"] = flag(drained & _above(spec.social, q("social_q70")))
    if has(df, spec.alone, spec.social):
        new["extreme_introvert_missing"] = flag(_above(spec.alone, q("alone_q80")) & _missing(spec.social))
        new["contradictory_social_missing"] = flag(_below(spec.alone, q("alone_q20")) & _missing(spec.social))
    if has(df, spec.outside, spec.social):
        new["non_social_outing_missing"] = flag(_above(spec.outside, q("outside_q70")) & _missing(spec.social))
    if has(df, spec.posts, spec.friends):
        new["online_social_missing"] = flag(_above(spec.posts, q("posts_q70")) & _missing(spec.friends))
    return df.withColumns(new) if new else df


# Complete pairs needed, and the strength a correlation must exceed, to impute.
MIN_PAIRS = 10
MIN_CORRELATION = 0.3


def fit_cross_imputation(df: DataFrame, spec: FeatureSpec = DEFAULT, **kw) -> dict[str, Any]:
    """Three fused passes: thresholds and correlation; three conditional
    quartiles; and the last quartile, which sees the first repair."""
    fitted: dict[str, Any] = dict(fit_missing_patterns(df, spec, **kw))
    fitted["partner"] = None
    if has(df, *spec.yes_no):
        fear, drained = is_yes(df, spec.fear), is_yes(df, spec.drained)
        both = fear.isNotNull() & drained.isNotNull()
        got = summarise(df, {"pairs": F.count_if(both), "r": F.corr(fear, drained)})
        r = got["r"]
        if got["pairs"] > MIN_PAIRS and r is not None and abs(r) > MIN_CORRELATION:
            fitted["partner"] = "same" if r > 0 else "opposite"
    q = fitted.get
    wanted: dict[str, tuple[Column, Sequence[float]]] = {}
    if has(df, spec.outside, spec.social):
        wanted["social_if_outside"] = (F.when(_above(spec.outside, q("outside_q70")), F.col(spec.social)), [0.75])
    if has(df, spec.alone, spec.outside):
        wanted["outside_if_not_alone"] = (F.when(_below(spec.alone, q("alone_q20")), F.col(spec.outside)), [0.75])
    if has(df, spec.posts, spec.friends):
        wanted["friends_if_posts"] = (F.when(_above(spec.posts, q("posts_q70")), F.col(spec.friends)), [0.75])
    fitted.update({k: v[0] for k, v in quantiles(df, wanted, **kw).items()})
    if has(df, spec.friends, spec.social):
        repaired = _social_from_outside(df, fitted, spec)
        late = {"social_if_friends": (F.when(_above(spec.friends, q("friends_q70")), repaired), [0.75])}
        fitted.update({k: v[0] for k, v in quantiles(df, late, **kw).items()})
    return fitted


def _fill(value: Column, condition: Column, with_: float | None) -> Column:
    return F.when(value.isNull() & condition, F.lit(with_).cast("double")).otherwise(value)


def _social_from_outside(df: DataFrame, fitted: dict[str, Any], spec: FeatureSpec) -> Column:
    if not has(df, spec.outside):
        return F.col(spec.social)
    return _fill(F.col(spec.social), _above(spec.outside, fitted.get("outside_q70")), fitted.get("social_if_outside"))


def impute_across(df: DataFrame, fitted: dict[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Fill gaps from related columns. Conditions see the values before repair,
    except that attendance is filled from outings first, then from friends."""
    q = fitted.get
    new: dict[str, Column] = {}
    if has(df, *spec.yes_no):
        fear, drained = is_yes(df, spec.fear), is_yes(df, spec.drained)
        if q("partner"):
            guess = (lambda c: c) if q("partner") == "same" else (lambda c: 1 - c)
            new[spec.fear] = F.coalesce(fear, guess(drained))
            new[spec.drained] = F.coalesce(drained, guess(fear))
    if has(df, spec.social):
        social = _social_from_outside(df, fitted, spec)
        if has(df, spec.friends):
            social = _fill(social, _above(spec.friends, q("friends_q70")), q("social_if_friends"))
        new[spec.social] = social
    if has(df, spec.outside, spec.alone):
        new[spec.outside] = _fill(F.col(spec.outside), _below(spec.alone, q("alone_q20")), q("outside_if_not_alone"))
    if has(df, spec.friends, spec.posts):
        new[spec.friends] = _fill(F.col(spec.friends), _above(spec.posts, q("posts_q70")), q("friends_if_posts"))
    return df.withColumns(new) if new else df


def fit_winsorise(df: DataFrame, spec: FeatureSpec = DEFAULT, tail: float = 0.01, **kw) -> dict[str, list[float | None]]:
    """(lower, upper) per measure; a measure missing in over half the rows is left out."""
    columns = [c for c in spec.present(df, spec.measures) if c in numeric_columns(df)]
    if not columns:
        return {}
    counts = summarise(df, {"rows": F.count("*"), **{c: F.count(c) for c in columns}})
    kept = [c for c in columns if counts["rows"] - counts[c] <= counts["rows"] * 0.5]
    return quantiles_of(df, kept, [tail, 1 - tail], **kw)


def winsorise(df: DataFrame, fitted: dict[str, list[float | None]]) -> DataFrame:
    new = {c: clip(F.col(c), low, high) for c, (low, high) in fitted.items() if c in df.columns}
    return df.withColumns(new) if new else df


def fit_quick(df: DataFrame, spec: FeatureSpec = DEFAULT, **kw) -> dict[str, float | None]:
    columns = spec.present(df, spec.measures)
    return {c: v[0] for c, v in quantiles_of(df, columns, [0.5], **kw).items()}


def quick_clean(df: DataFrame, medians: dict[str, float | None], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Median fill, exact ``"Yes"`` test (missing is 0), raw answers dropped."""
    new = {c: F.coalesce(F.col(c), F.lit(m).cast("double")) for c, m in medians.items() if c in df.columns}
    answers = spec.present(df, spec.yes_no)
    new.update({f"{c}_encoded": flag(F.col(c) == "Yes") for c in answers})
    return df.withColumns(new).drop(*answers)


def fit_categories(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """The distinct raw spellings per Yes/No column: (column, value, rows)."""
    columns = spec.present(df, spec.yes_no)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("rows"))
    )


def fold_safe_bronze(df: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Encode the answers in place, then flag what is missing after encoding.

    The encoding is a fixed word list, so nothing learned from other rows
    enters; a spelling outside it becomes missing.
    """
    encoded = df.withColumns({c: yes_no_value(F.col(c)) for c in spec.present(df, spec.yes_no)})
    columns = spec.present(df, [spec.fear, spec.outside, spec.alone])
    return encoded.withColumns({f"{c}_missing": _missing(c).cast("int") for c in columns})


def unseen_categories(df: DataFrame, categories: DataFrame, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Spellings in ``df`` that the fitted categories lack, with their row counts."""
    return fit_categories(df, spec).join(categories, ["column", "value"], "left_anti")
