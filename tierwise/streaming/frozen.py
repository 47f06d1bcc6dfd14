"""Layer steps on a stream, with everything learned beforehand.

All stateless operators and all ``apply`` steps that take plain fitted values
are projections, so the functions used for tables also take a streaming
DataFrame. What a fit keeps as a table (target means, category codes, rank slices) is
joined to the stream, which is never counted; the table is broadcast within a bound.
Steps that compare rows with each other (neighbour fills) need a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tierwise.models.learners import Fitted
from tierwise.operators import encode
from tierwise.operators.bronze import normalise_types
from tierwise.operators.gold import clean
from tierwise.operators.ranks import FrozenRanks
from tierwise.plans.layers import apply_bronze, apply_silver
from tierwise.spec import DEFAULT, FeatureSpec


def raw_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def features(stream: DataFrame, bronze_fit: Mapping[str, Any], silver_fit: Mapping[str, Any], spec: FeatureSpec = DEFAULT) -> DataFrame:
    """Raw rows to silver features."""
    return apply_silver(apply_bronze(normalise_types(stream, spec), bronze_fit, spec), silver_fit, spec)


def looked_up(
    stream: DataFrame,
    means: DataFrame | None = None,
    codes: tuple[DataFrame, Sequence[str]] | None = None,
    ranks: tuple[FrozenRanks, Sequence[str]] | None = None,
    spec: FeatureSpec = DEFAULT,
) -> DataFrame:
    """Target means, category codes and percent ranks of fitted tables, as on a table."""
    out = stream
    if means is not None:
        out = encode.target_encode(out, means, spec)
    if codes is not None:
        out = encode.encode_codes(out, *codes, id_col=spec.id)
    if ranks is not None:
        out = ranks[0].add(out, ranks[1], id_col=spec.id)
    return out


def scored(stream: DataFrame, gold_fit: Mapping[str, Any], model: Fitted) -> DataFrame:
    """Silver features to predictions, with frozen limits and a fitted model."""
    return model.score(clean(stream, gold_fit["clean"]))


def append_to(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Take what has arrived, append it exactly once, and stop."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
