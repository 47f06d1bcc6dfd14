"""Statistics across the columns of one row, as plain expressions.

Missing values are skipped. A sum over nothing is 0; mean, min and max over
nothing are NULL; a standard deviation needs two values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions.columns import total

# Below this a central moment counts as rounding noise of equal values.
MOMENT_FLOOR = 1e-14


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n).cast("double") for n in names]


def count_present(names: Sequence[str]) -> Column:
    return total([F.col(n).isNotNull().cast("int") for n in names])


def row_sum(names: Sequence[str]) -> Column:
    return total([F.coalesce(c, F.lit(0.0)) for c in _cols(names)])


def row_mean(names: Sequence[str]) -> Column:
    return F.try_divide(row_sum(names), count_present(names))


def _squares(cols: Sequence[Column], mean: Column, power: int = 2) -> Column:
    terms = []
    for c in cols:
        d = c - mean
        out = d
        for _ in range(power - 1):
            out = out * d
        terms.append(F.coalesce(out, F.lit(0.0)))
    return total(terms)


def row_std(names: Sequence[str]) -> Column:
    n = count_present(names)
    spread = _squares(_cols(names), row_mean(names))
    return F.when(n >= 2, F.sqrt(F.try_divide(spread, n - 1)))


def row_std_zero_filled(names: Sequence[str]) -> Column:
    """Sample deviation after missing -> 0; 0 when there is one column only."""
    if len(names) < 2:
        return F.lit(0.0)
    filled = [F.coalesce(c, F.lit(0.0)) for c in _cols(names)]
    mean = total(filled) / F.lit(float(len(names)))
    return F.sqrt(_squares(filled, mean) / F.lit(float(len(names) - 1)))


def row_min(names: Sequence[str]) -> Column:
    cols = _cols(names)
    return F.least(*cols) if len(cols) > 1 else cols[0]


def row_max(names: Sequence[str]) -> Column:
    cols = _cols(names)
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def sorted_values(names: Sequence[str]) -> Column:
    return F.array_sort(F.array_compact(F.array(*_cols(names))))


def quantile_of_sorted(values: Column, p: float) -> Column:
    """Linear interpolation inside an ascending array; NULL when it is empty."""
    n = F.size(values)
    at = (n - 1) * F.lit(p)
    low = F.floor(at).cast("int")
    high = F.ceil(at).cast("int")
    v_low = F.element_at(values, low + 1)
    v_high = F.element_at(values, high + 1)
    return F.when(n > 0, v_low + (v_high - v_low) * (at - low))


def with_row_moments(df: DataFrame, names: Sequence[str], prefix: str = "row_") -> DataFrame:
    """mean, std, skew, kurtosis, q25, q75 and iqr of each row.

    Staged over temporary columns so that the mean and the moments are computed
    once per row and not copied into every term.
    """
    cols = _cols(names)
    staged = df.withColumns({"__n": count_present(names), "__sum": row_sum(names), "__sorted": sorted_values(names)})
    staged = staged.withColumn("__mean", F.try_divide(F.col("__sum"), F.col("__n")))
    mean = F.col("__mean")
    staged = staged.withColumns({f"__s{p}": _squares(cols, mean, p) for p in (2, 3, 4)})
    n, s2, s3, s4 = (F.col(c) for c in ("__n", "__s2", "__s3", "__s4"))
    # Central moments; values under the floor come from equal inputs.
    flat = s2 < F.lit(MOMENT_FLOOR)
    over = F.try_divide
    m2, m3, m4 = over(s2, n), over(s3, n), over(s4, n)
    skew = over(F.sqrt(n * (n - 1)), n - 2) * over(m3, F.pow(m2, F.lit(1.5)))
    excess = over(m4, m2 * m2) - 3
    kurt = over(n - 1, (n - 2) * (n - 3)) * ((n + 1) * excess + 6)
    q25 = quantile_of_sorted(F.col("__sorted"), 0.25)
    q75 = quantile_of_sorted(F.col("__sorted"), 0.75)
    out = staged.withColumns(
        {
            f"{prefix}mean": mean,
            f"{prefix}std": F.when(n >= 2, F.sqrt(over(s2, n - 1))),
            f"{prefix}skew": F.when(n == 0, 0.0).when(n < 3, None).when(flat, 0.0).otherwise(skew),
            f"{prefix}kurtosis": F.when(n == 0, 0.0).when(n < 4, None).when(flat, 0.0).otherwise(kurt),
            f"{prefix}q25": q25,
            f"{prefix}q75": q75,
            f"{prefix}iqr": q75 - q25,
        }
    )
    return out.drop("__n", "__sum", "__sorted", "__mean", "__s2", "__s3", "__s4")
