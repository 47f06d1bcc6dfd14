"""Run times of workflows: an append-only table of (workflow, ts, duration)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwise.operators.ordering import running_totals

RUNS = "workflow string, ts timestamp, duration double"

# Layout of a run log kept as one JSON document.
DOCUMENT = (
    "workflows map<string, struct<executions: array<struct<timestamp: string, duration: double>>, "
    "statistics: struct<average: double, median: double, min: double, max: double, count: bigint, "
    "std_dev: double, last_updated: string>>>"
)


def import_document(spark: SparkSession, path: str) -> DataFrame:
    """Runs held in a JSON run-log document."""
    doc = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    per_flow = doc.select(F.explode("workflows").alias("workflow", "log"))
    return per_flow.select("workflow", F.explode("log.executions").alias("run")).select(
        "workflow", F.to_timestamp("run.timestamp").alias("ts"), F.col("run.duration").alias("duration")
    )


def append_run(spark: SparkSession, path: str, workflow: str, duration: float) -> None:
    row = spark.createDataFrame([(workflow, float(duration))], "workflow string, duration double")
    row.select("workflow", F.current_timestamp().alias("ts"), "duration").write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs; an absent log is empty."""
    try:
        return spark.read.schema(RUNS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def latest_runs(runs: DataFrame, keep: int = 100) -> DataFrame:
    """The newest ``keep`` runs of each workflow.

    Spark keeps only the leading rows of each workflow per task before the
    shuffle (rank limit pushdown), so a busy workflow does not pile up.
    """
    newest = Window.partitionBy("workflow").orderBy(F.col("ts").desc(), F.col("duration").desc())
    return runs.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= keep).drop("__r")


def workflow_stats(runs: DataFrame) -> DataFrame:
    """Average, median, extremes, count and deviation per workflow; one run has
    no deviation.

    The median is found by ranking inside slices of each workflow's range of
    distinct durations, so one workflow may hold most of the log. Runs without a
    duration do not count; a NULL workflow is a workflow of its own.
    """
    runs = runs.where(F.col("duration").isNotNull())
    levels = runs.groupBy("workflow", "duration").agg(F.count("*").alias("n"))
    ranked = running_totals(levels, ["workflow"], "duration", ["n"])
    sizes = runs.groupBy("workflow").agg(
        F.avg("duration").alias("average"),
        F.min("duration").alias("min"),
        F.max("duration").alias("max"),
        F.count("*").alias("count"),
        F.stddev_samp("duration").alias("std_dev"),
    )
    low = F.floor((F.col("count") - 1) / 2)
    high = F.floor(F.col("count") / 2)
    at = lambda k: (F.col("n_before") <= k) & (k < F.col("n_before") + F.col("n"))
    # Range join on the workflow: one row of sizes per workflow.
    middle = (
        ranked.join(
            sizes.select(F.col("workflow").alias("__workflow"), "count"), F.col("workflow").eqNullSafe(F.col("__workflow"))
        )
        .where(at(low) | at(high))
        .groupBy("__workflow")
        .agg(((F.min("duration") + F.max("duration")) / 2).alias("median"))
    )
    return sizes.join(middle, F.col("workflow").eqNullSafe(F.col("__workflow"))).select("workflow", "average", "median", "min", "max", "count", "std_dev")


def estimated_durations(stats: DataFrame) -> DataFrame:
    """0.7 of the median plus 0.3 of the average, per workflow."""
    return stats.select("workflow", (F.col("median") * 0.7 + F.col("average") * 0.3).alias("estimate"))


def workflows(runs: DataFrame) -> DataFrame:
    return runs.select("workflow").distinct()


def without_workflow(runs: DataFrame, workflow: str) -> DataFrame:
    """All other runs, those without a workflow too."""
    return runs.where(~F.col("workflow").eqNullSafe(F.lit(workflow)))


def clear_workflow(spark: SparkSession, path: str, workflow: str) -> bool:
    """Rewrite the log without one workflow; False when it is not in it.

    The new log is written beside the old one and takes its name when it is whole, so a failed
    write loses nothing; the old one stays until then.
    """
    runs = read_runs(spark, path)
    if runs.where(F.col("workflow") == workflow).isEmpty():
        return False
    fresh, old = (f"{path.rstrip('/')}.{part}-{uuid.uuid4().hex[:8]}" for part in ("new", "old"))
    without_workflow(runs, workflow).write.parquet(fresh)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.rename(place, jvm.org.apache.hadoop.fs.Path(old)):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(jvm.org.apache.hadoop.fs.Path(fresh), place):
        files.rename(jvm.org.apache.hadoop.fs.Path(old), place)
        raise OSError(f"{fresh} cannot be moved to {path}")
    files.delete(jvm.org.apache.hadoop.fs.Path(old), True)
    return True
