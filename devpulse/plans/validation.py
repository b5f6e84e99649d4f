"""Whole validation flows as single result tables.

``validate_window_store``: read the stored windows, check the columns (DQ1),
the data (DQ4) and the partition layout (DQ5) and fold them into one row
per flow step with a pass/fail status; the job fails only on what fails it
(missing critical columns, no rows). ``validate_report_file``: the report
checks (DQ6) on a CSV read back by SRC6.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from devpulse.operators import quality as Q
from devpulse.sources.files import read_parquet, read_report_csv

# Spark's classes for a store that is missing or is not Parquet.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER")
STEP_SCHEMA = "step string, passed boolean, detail string"


def window_store_checks(df: DataFrame) -> DataFrame:
    """DQ1 + DQ4 + DQ5 as one findings table (check, scope, observed, status).

    With ``device_type`` present all three come from one grouped scan
    (``store_checks``); otherwise the column check runs alone.
    """
    if "device_type" in df.columns:
        columns, quality, partitions = Q.store_checks(df)
    else:
        columns, quality, partitions = Q.check_columns(df), Q.quality_report(df), None
    cols = columns.select(
        F.concat(F.lit("column:"), F.col("column_name")).alias("check"), F.lit("schema").alias("scope"),
        F.col("null_count").cast("double").alias("observed"), F.col("status"))
    found = [cols, quality]
    if partitions is not None:
        parts = partitions.select(
            F.lit("partition_mismatch").alias("check"), F.lit("all").alias("scope"),
            F.col("mismatched_rows").cast("double").alias("observed"),
            F.when(F.col("mismatched_rows") == 0, "pass").otherwise("fail").alias("status"))
        found.append(parts)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def summarize(findings: DataFrame) -> DataFrame:
    """Fold findings to (step, passed, detail): a step passes unless one of its
    findings has status ``fail``."""
    step = (F.when(F.col("check").startswith("column:"), "schema_valid")
            .when(F.col("check") == "partition_mismatch", "partitions_valid")
            .otherwise("data_quality_valid"))
    return (findings.withColumn("step", step).groupBy("step").agg(
        (F.count_if(F.col("status") == "fail") == 0).alias("passed"),
        F.concat_ws(", ", F.sort_array(F.collect_set(
            F.when(F.col("status").isin("fail", "warn"), F.concat_ws("=", "check", "status"))))).alias("detail")))


def validate_window_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored-window validation flow; ``read_successful`` is a step too."""
    try:
        df = read_parquet(spark, path)
    except (PySparkException, Py4JJavaError) as exc:  # an unreadable store is a failed step, reported as data
        if not any(c in str(exc) for c in UNREADABLE):
            raise
        return spark.createDataFrame([("read_successful", False, str(exc))], STEP_SCHEMA)
    read_ok = spark.createDataFrame([("read_successful", True, "")], STEP_SCHEMA)
    return read_ok.unionByName(summarize(window_store_checks(df)))


def validate_report_file(spark: SparkSession, path: str) -> DataFrame:
    """The report-file validation flow: does the file exist, then DQ6 over the CSV read as text."""
    def exists(status: str) -> DataFrame:
        return spark.createDataFrame([("file_exists", "all", float(status == "pass"), status)], Q.CHECK_SCHEMA)

    try:
        report = read_report_csv(spark, path, typed=False)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return exists("fail")
    return exists("pass").unionByName(Q.validate_report(report))
