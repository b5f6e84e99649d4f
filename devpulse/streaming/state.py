"""STR1, STR2, STR4: what a stopped stream holds in state, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEDUP, WINDOWS = "dedupeWithinWatermark", "stateStoreSave"


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId`` of the stateful operators."""
    return spark.read.format("state-metadata").load(checkpoint).drop("numColsPrefixKey", "operatorProperties")


def state_rows(spark: SparkSession, checkpoint: str, operator: str) -> DataFrame:
    """Keys and values in the last committed state of the operator of that name."""
    ids = [r["operatorId"] for r in operators(spark, checkpoint).where(f"operatorName = '{operator}'")
           .select("operatorId").distinct().collect()]
    if len(ids) != 1:
        raise ValueError(f"{len(ids)} operators named {operator!r} in {checkpoint}")
    state = spark.read.format("statestore").option("operatorId", ids[0]).load(checkpoint)
    return state.select("key.*", "value.*")
