"""Cut lineage by writing a table to the shared checkpoint folder.

Used for intermediate results that are read more than once: they are computed
once, survive executor loss without recomputation, and come back with exact
file statistics for the planner. A job deletes its staged tables at its end
with ``drop_staged``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devpulse.session import scratch_path

_STAGED: list[str] = []


def stage_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    _STAGED.append(path)
    return df.sparkSession.read.parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables staged so far by this driver; frames that read them are no longer usable."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = hadoop.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
