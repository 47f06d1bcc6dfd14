"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder.

    Only a local session that names none gets a temporary folder; on a cluster
    a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tierwise-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tierwise/{spark.sparkContext.applicationId}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several passes need the same derived rows, or where a value is
    only stable once written. The table is columnar, so later passes prune, and
    it does not depend on executors staying alive.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the table behind a ``durable`` result that nothing will read again."""
    spark = df.sparkSession
    root = scratch_root(spark)
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/tierwise/" in folder and folder.rsplit("/", 1)[0].endswith(root.split("://")[-1].rstrip("/").removeprefix("file:")):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
