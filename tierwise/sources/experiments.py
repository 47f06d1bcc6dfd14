"""A table of training runs: parameters and metrics as maps, appended and never rewritten."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

EXPERIMENTS = (
    "run string, name string, started string, params map<string,string>, metrics map<string,double>, "
    "features array<string>, notes string"
)


def record(
    spark: SparkSession, run: str, name: str, params: Mapping[str, Any], metrics: Mapping[str, float],
    features: Sequence[str] = (), notes: str | None = None, started: str | None = None,
) -> DataFrame:
    """One row of the table."""
    at = started or datetime.now(timezone.utc).isoformat()
    row = (run, name, at, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()}, list(features), notes)
    return spark.createDataFrame([row], EXPERIMENTS)


def append(runs: DataFrame, path: str) -> None:
    """Add runs; each call has a folder of its own, so writers need not know of each other."""
    runs.select(*[c.split()[0] for c in EXPERIMENTS.split(", ")]).write.parquet(f"{path.rstrip('/')}/{uuid.uuid4().hex}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All runs; an absent table is empty."""
    try:
        return spark.read.schema(EXPERIMENTS).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EXPERIMENTS)


def metric(name: str):
    """A named metric of a run; one that was not recorded, or is not a number, is 0."""
    value = F.try_element_at("metrics", F.lit(name))
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def top_runs(runs: DataFrame, name: str, k: int = 10, smallest: bool = False) -> DataFrame:
    """(rank, run, name, value): the k best runs by a metric, equal ones by run."""
    scored = runs.select("run", "name", metric(name).alias("value"))
    order = [F.col("value").asc() if smallest else F.col("value").desc(), "run"]
    best = scored.orderBy(*order).limit(k)
    # At most k rows.
    lines = F.sort_array(F.collect_list(F.struct((F.col("value") if smallest else -F.col("value")).alias("key"), "run", "name", "value")))
    return best.agg(lines.alias("held")).select(F.posexplode("held").alias("at", "e")).select((F.col("at") + 1).alias("rank"), "e.run", "e.name", "e.value")


def parameter_values(runs: DataFrame) -> DataFrame:
    """(parameter, value, runs): every setting that was tried, and how often."""
    return runs.select(F.explode("params").alias("parameter", "value")).groupBy("parameter", "value").agg(F.count("*").alias("runs"))


def compare(runs: DataFrame, name: str) -> DataFrame:
    """(name, runs, mean_value, best_value) per experiment name."""
    scored = runs.select("name", metric(name).alias("value"))
    return scored.groupBy("name").agg(F.count("*").alias("runs"), F.avg("value").alias("mean_value"), F.max("value").alias("best_value"))
