"""Joining a per-key table back to the rows it was computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.runtime import durable

# A table of at most this many (narrow) rows is shipped to every executor.
BROADCAST_ROWS = 200_000
# A key counts as hot when it holds more than 1/HOT_SHARE of all rows, so there
# are fewer than HOT_SHARE hot keys whatever the data.
HOT_SHARE = 2000


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    spread: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left-join ``table`` (one row per ``key``, NULL being a key too) to ``df``.

    A table of checked small size is broadcast. Otherwise the rows of ``df`` are
    counted per key, and those of hot keys are spread over several salted copies of
    that key's entry, so that no task receives more than about 1/hot_share of the
    rows; NULL and keys that the table lacks are spread alike. ``weight``, the column
    of rows each key had when the table was made, is left out of the result.
    ``counted`` has the same keys as ``df`` where that is cheaper to count.
    ``table`` should be stored: it is counted first. A stream can't be counted: beyond the bound
    its rows meet the table by key as they are.
    """
    extra = [c for c in table.columns if c not in (key, weight)]
    right = table.select(F.col(key).alias("__key"), *extra)
    small = table.count() <= broadcast_rows
    if small or df.isStreaming:
        joined = df.join(F.broadcast(right) if small else right, F.col(key).eqNullSafe(F.col("__key")), "left")
        return joined.select(*[F.col(c) for c in df.columns], *extra)

    held = durable((df if counted is None else counted).groupBy(F.col(key).alias("__hot")).agg(F.count("*").alias("__n")), "key-counts")
    limit = (held.agg(F.sum("__n")).first()[0] or 0) / hot_share
    # Fewer than hot_share rows.
    hot = held.where(F.col("__n") > limit).select("__hot", F.ceil(F.col("__n") / F.lit(limit)).cast("int").alias("__copies"))
    row = F.xxhash64(F.col(spread)) if spread else F.xxhash64(*[F.col(c) for c in df.columns])
    marked = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__hot")), "left").withColumn(
        "__salt", F.coalesce(F.pmod(row, F.col("__copies")).cast("int"), F.lit(0))
    )
    salts = F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1)
    salted = right.join(F.broadcast(hot), F.col("__key").eqNullSafe(F.col("__hot")), "left").select(
        "__key", *extra, F.explode(salts).alias("__salt_r")
    )
    joined = marked.join(
        salted, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__salt_r")), "left"
    )
    return joined.select(*[F.col(c) for c in df.columns], *extra)
