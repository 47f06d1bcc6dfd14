"""Column expressions shared by the operators. Missing is NULL everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwise.spec import EPS


def flag(condition: Column) -> Column:
    """0/1 flag; a comparison with a missing value is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def finite(c: Column) -> Column:
    """NaN and +-inf become NULL."""
    x = c.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x)


def ratio(num: Column, den: Column) -> Column:
    """num / (den + eps); NULL where the shifted denominator is exactly 0."""
    return F.try_divide(num, den + F.lit(EPS))


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Limit to [lower, upper]; NULL stays NULL (least/greatest would skip it)."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(c.isNotNull(), out)


def zero_if_missing(c: Column) -> Column:
    return F.coalesce(finite(c), F.lit(0.0))


def total(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def row_hash(id_col: Column, seed: int) -> Column:
    """Order of rows for seeded choices: the same on every partitioning."""
    return F.md5(F.concat(id_col.cast("string"), F.lit(f"#{seed}")))


def unit_from_hash(digest: Column) -> Column:
    """A number in [0, 1) from the first 12 hex digits of a digest."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
