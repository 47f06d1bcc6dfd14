"""Building the layers in order. Everything learned comes from the train table
and is applied to both tables; each layer is written before the next reads it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.columns import zero_if_missing
from tierwise.functions.rows import with_row_moments
from tierwise.operators import bronze, encode, gold, isolation, neighbours, outliers, quality, ranks, silver
from tierwise.runtime import durable
from tierwise.sources.layers import LayerStore
from tierwise.spec import DEFAULT, FeatureSpec, numeric_columns, text_columns


def fit_bronze(train: DataFrame, spec: FeatureSpec = DEFAULT, clip_tails: bool = True, **kw) -> dict[str, Any]:
    encoded = bronze.encode_yes_no(train, spec)
    return {"winsorise": bronze.fit_winsorise(encoded, spec, **kw) if clip_tails else {}}


def apply_bronze(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT, flags: bool = True) -> DataFrame:
    """Encode the answers, flag what is missing, limit the tails."""
    out = bronze.encode_yes_no(df, spec)
    if flags:
        out = bronze.missing_flags(out, spec)
    return bronze.winsorise(out, fitted["winsorise"])


def fit_repaired_bronze(train: DataFrame, spec: FeatureSpec = DEFAULT, **kw) -> dict[str, Any]:
    """Learn the extended bronze step: pattern flags, cross-column repair, outliers."""
    encoded = durable(bronze.encode_yes_no(train, spec), "encoded")
    fitted: dict[str, Any] = {"impute": bronze.fit_cross_imputation(encoded, spec, **kw)}
    repaired = durable(bronze.impute_across(encoded, fitted["impute"], spec), "repaired")
    fitted["forest"] = isolation.fit_forest(repaired, spec, **kw)
    fitted["outliers"] = outliers.fit_outliers(repaired, spec, **kw)
    return fitted


def apply_repaired_bronze(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    out = bronze.encode_yes_no(df, spec)
    out = bronze.missing_patterns(out, fitted["impute"], spec)
    out = bronze.impute_across(out, fitted["impute"], spec)
    out = isolation.score_forest(out, fitted["forest"])
    return outliers.flag_outliers(out, fitted["outliers"], spec)


def fit_silver(train: DataFrame, spec: FeatureSpec = DEFAULT, polynomial: bool = True, scaling: bool = False) -> dict[str, Any]:
    fitted: dict[str, Any] = {"basic": silver.fit_basic(train, spec), "polynomial": polynomial, "scaling": {}}
    if scaling:
        fitted["scaling"] = silver.fit_scaling(durable(apply_silver(train, fitted, spec), "silver"), spec)
    return fitted


def apply_silver(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    out = silver.derive(df, fitted["basic"], spec)
    if fitted["polynomial"]:
        out = silver.polynomial_features(out, spec)
    return silver.scale(out, fitted["scaling"]) if fitted["scaling"] else out


def build_bronze(store: LayerStore, spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Write bronze train and test; returns the range checks of the train table."""
    train, test = (bronze.normalise_types(df, spec) for df in store.load("raw"))
    fitted = fit_bronze(train, spec)
    written = store.write("bronze", "train", apply_bronze(train, fitted, spec))
    store.write("bronze", "test", apply_bronze(test, fitted, spec))
    return quality.range_checks(written, spec)


def build_silver(store: LayerStore, spec: FeatureSpec = DEFAULT) -> None:
    train, test = store.require("bronze", lambda s: build_bronze(s, spec))
    fitted = fit_silver(train, spec)
    store.write("silver", "train", apply_silver(train, fitted, spec))
    store.write("silver", "test", apply_silver(test, fitted, spec))


def build_gold(store: LayerStore, spec: FeatureSpec = DEFAULT, k: int = 30, compat: bool = False) -> dict[str, Any]:
    """Write gold train and test with the same columns; returns what was learned."""
    train, test = store.require("silver", lambda s: build_silver(s, spec))
    fitted = gold.fit_gold(train, spec, k=k, compat=compat)
    store.write("gold", "train", gold.apply_gold(train, fitted, spec))
    store.write("gold", "test", gold.apply_gold(test.drop(spec.label), fitted, spec))
    return fitted


def build_all(store: LayerStore, spec: FeatureSpec = DEFAULT) -> None:
    build_bronze(store, spec)
    build_silver(store, spec)
    build_gold(store, spec)


def fit_enhanced(
    train: DataFrame,
    spec: FeatureSpec = DEFAULT,
    power: bool = True,
    target_means: bool = True,
    statistics: bool = True,
    target_columns: Sequence[str] | None = None,
) -> tuple[dict[str, Any], DataFrame]:
    """Learn the enhanced silver step on training rows; returns what was
    learned and the enhanced training rows.

    The stages feed each other: lambdas, then target means, then the statistics
    of the filled table, which is written once and serves both. ``train``
    should be a stored table.
    """
    fitted: dict[str, Any] = {"power": encode.fit_power(train, spec, _measurable(train, spec)) if power else {}}
    fitted["target"] = None
    columns = list(target_columns) if target_columns is not None else [c for c in text_columns(train) if c != spec.label]
    columns = spec.present(train, columns)
    if target_means and columns:
        fitted["target"] = durable(encode.fit_target_means(train, gold.label_value(train, spec), spec, columns), "means")
    out = _encoded(train, fitted, spec)
    fitted["statistics"] = statistics
    if not statistics:
        return fitted, out
    fitted["numeric"] = _measurable(out, spec)
    fitted["donors"] = durable(out.select(spec.id, *fitted["numeric"]), "donor-rows")
    fitted["modes"] = encode.fit_modes(out, [c for c in text_columns(out) if c != spec.label])
    filled = _filled(out, fitted, spec)
    fitted["zscores"] = encode.fit_key_zscores(filled, spec)
    fitted["ranks"] = ranks.fit_ranks(filled, spec.present(filled, encode.key_columns(spec)))
    return fitted, _described(filled, fitted, spec)


def _measurable(df: DataFrame, spec: FeatureSpec) -> list[str]:
    return [c for c in numeric_columns(df) if c not in spec.not_features]


def _encoded(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec) -> DataFrame:
    out = encode.power_transform(df, fitted["power"])
    return out if fitted["target"] is None else encode.target_encode(out, fitted["target"], spec)


def _filled(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec) -> DataFrame:
    flagged = encode.was_missing_flags(df, fitted["numeric"])
    return durable(neighbours.knn_impute(flagged, spec, fitted["numeric"], fit_on=fitted["donors"]), "filled")


def _described(filled: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec) -> DataFrame:
    out = encode.key_zscores(with_row_moments(filled, fitted["numeric"]), fitted["zscores"])
    keys = spec.present(out, encode.key_columns(spec))
    placed = ranks.FrozenRanks(fitted["ranks"]).add(out, keys, id_col=spec.id)
    return encode.mode_flags(placed, fitted["modes"])


def apply_enhanced(df: DataFrame, fitted: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Power columns, target means, gap flags and fills, row moments, z-scores,
    percent ranks and mode flags, for rows other than the training rows."""
    out = _encoded(df, fitted, spec)
    return _described(_filled(out, fitted, spec), fitted, spec) if fitted["statistics"] else out


def evened_out(train: DataFrame, spec: FeatureSpec = DEFAULT, **kw: Any) -> DataFrame:
    """Numeric columns of the training rows, gaps as 0, and the label code, with interpolated rows
    until every class is as large as the largest. For training rows only."""
    code = gold.encode_label(train, spec) if spec.label_code not in train.columns else train
    names = [c for c in _measurable(code, spec)]
    whole = durable(code.select(spec.id, spec.label_code, *[zero_if_missing(F.col(c)).alias(c) for c in names]), "evened-input")
    return neighbours.oversample(whole, spec.label_code, names, **kw)


def enhanced_silver(
    train: DataFrame, others: Sequence[DataFrame] = (), spec: FeatureSpec = DEFAULT, oversampled: bool = False, **switches: Any
) -> list[DataFrame]:
    """One call from (raw or bronze) rows to enhanced features: learned on
    ``train``, applied to it and to every other table, same columns for all.

    With ``oversampled`` the training rows come evened out (see ``evened_out``)."""

    def base(df: DataFrame) -> DataFrame:
        texts = [c for c in spec.present(df, spec.yes_no) if c in text_columns(df)]
        return bronze.encode_yes_no(df, spec) if texts else df

    ready = [base(df) for df in (train, *others)]
    basic = fit_silver(ready[0], spec)
    tables = [durable(apply_silver(df, basic, spec), "base-silver") for df in ready]
    switches.setdefault("target_columns", spec.yes_no)
    fitted, enhanced = fit_enhanced(tables[0], spec, **switches)
    first = evened_out(enhanced, spec) if oversampled else enhanced
    return [first, *[apply_enhanced(df, fitted, spec) for df in tables[1:]]]


def enhanced_prepare(features: Sequence[str] | None = None, spec: FeatureSpec = DEFAULT, **switches: Any):
    """A ``prepare`` step for cross-validation and search: enhanced features learned on the training
    rows of each fold. Rows need the raw columns, the label's text or code, ``fold`` and ``label``."""

    def prepare(train: DataFrame, valid: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        held = ["fold", "label"]
        a, b = enhanced_silver(train.drop(*held), [valid.drop(*held)], spec, **switches)
        fitted = gold.fit_clean(a.drop(*[c for c in spec.not_features if c in a.columns and c != spec.id]), spec)
        names = [c for c in (features or _measurable(a, spec)) if c in fitted]

        def back(made: DataFrame, rows: DataFrame) -> DataFrame:
            ready = gold.clean(made.select(spec.id, *names), {c: fitted[c] for c in names})
            return ready.join(rows.select(spec.id, *held), spec.id)

        return back(a, train), back(b, valid), names

    return prepare
