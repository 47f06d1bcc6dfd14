"""The survey-shaped view of the order tables: one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.spec import DRAINED, FEAR, FRIENDS, OUTSIDE, POSTS, SOCIAL, TIME_ALONE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _missing_every(n: int, value: Column) -> Column:
    return F.when(F.col("o_orderkey") % n != 0, value)


def order_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Measures per order with gaps, untidy Yes/No text and a two-valued label.

    The line items are reduced to one row per order first, so the join with the
    orders meets the layout of that aggregate and only the orders move.
    """
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("q"),
            F.count("*").alias("n"),
            F.countDistinct("l_partkey").alias("p"),
            F.sum(F.round(F.col("l_discount") * 100)).alias("d"),
        )
    )
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
    priority = F.col("o_orderpriority")
    return (
        table(spark, folder, "orders")
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"),
            _missing_every(13, (F.col("o_custkey") % 27).cast("double")).alias(TIME_ALONE),
            _missing_every(11, F.col("n").cast("double")).alias(SOCIAL),
            _missing_every(17, F.col("q")).alias(OUTSIDE),
            _missing_every(19, F.col("p").cast("double")).alias(FRIENDS),
            _missing_every(23, F.col("d")).alias(POSTS),
            F.when(priority == "1-URGENT", "Yes")
            .when(priority == "2-HIGH", " yes")
            .when(priority == "3-MEDIUM", "NO")
            .when(priority == "4-NOT SPECIFIED", "n")
            .alias(FEAR),
            F.when(F.col("o_orderstatus") == "P", None)
            .when(urgent != (F.col("o_orderkey") % 5 == 0), "Y")
            .otherwise("No")
            .alias(DRAINED),
            F.when(F.col("o_totalprice") >= 130000, "Extrovert").otherwise("Introvert").alias("Personality"),
        )
    )


def split_profile(profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) by id."""
    return profile.where(F.col("id") % 4 != 0), profile.where(F.col("id") % 4 == 0)
