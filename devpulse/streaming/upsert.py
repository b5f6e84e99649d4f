"""STR6: the update mode as a table that always holds the latest state of every window.

In update mode a micro-batch brings the windows that have changed. Each batch's
rows are published once under the batch's number: drafted beside the table,
renamed when complete. A batch that the stream replays after a failure finds its
number taken and changes nothing. The latest state is, for each key, the row of
the highest batch; ``fold`` writes it as a new base so that readers need only
the batches after it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from devpulse import constants as C
from devpulse.streaming.compaction import children, publish

KEYS = ("window_start", "window_end", "device_id", "device_type")


def _number(folder: str) -> int:
    return int(re.search(r"-(\d+)$", folder).group(1))


def merge_batch(rows: DataFrame, batch: int, table: str) -> bool:
    """Publish a batch's changed rows; False if the batch is in the table already."""
    spark = rows.sparkSession
    final = f"{table}/batch-{batch:012d}"
    bases = children(spark, table, "base-")
    if children(spark, table, final.rsplit("/", 1)[1]) or bases and _number(bases[-1]) >= batch:
        return False
    draft = f"{table}/_draft-{uuid.uuid4().hex}"
    rows.withColumn("_batch", F.lit(batch).cast("long")).write.parquet(draft)
    return publish(spark, draft, final)


def write_latest_windows(df: DataFrame, table: str, checkpoint: str, trigger: str | None = C.TRIGGER_INTERVAL,
                         available_now: bool = False) -> StreamingQuery:
    """Keep ``table`` at the latest state of a stream's windows (update mode, ``foreachBatch``)."""
    writer = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda rows, batch: merge_batch(rows, batch, table) and None))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def _changes(spark: SparkSession, table: str) -> tuple[DataFrame | None, int]:
    """The newest base and the batches after it, and the highest batch."""
    bases, batches = children(spark, table, "base-"), children(spark, table, "batch-")
    base = _number(bases[-1]) if bases else -1
    folders = bases[-1:] + [b for b in batches if _number(b) > base]
    return (spark.read.parquet(*folders) if folders else None), max([base, *map(_number, batches)])


def latest(spark: SparkSession, table: str, keys=KEYS) -> DataFrame:
    """One row a key: that of the highest batch (with its number as ``_batch``)."""
    rows, _ = _changes(spark, table)
    if rows is None:
        raise ValueError(f"no batch in {table}")
    newest = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def fold(spark: SparkSession, table: str, keys=KEYS) -> str | None:
    """Write the latest state as a new base, up to the highest batch; None if there is nothing new."""
    rows, highest = _changes(spark, table)
    final = f"{table}/base-{highest:012d}"
    if rows is None or children(spark, table, final.rsplit("/", 1)[1]):
        return None
    draft = f"{table}/_draft-{uuid.uuid4().hex}"
    newest = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth").write.parquet(draft)
    publish(spark, draft, final)
    return final
