"""File readers: envelope stream (SRC2), Parquet (SRC3), JSON lines (SRC4),
Parquet-then-JSON (SRC5) and the report CSV (SRC6)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from devpulse import schemas


def read_event_files_stream(spark: SparkSession, path: str, schema: StructType = schemas.ENVELOPE,
                            fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC2: the Kafka envelope from files, as a stream (stands in for a broker).

    The schema is declared, never inferred; ``maxFilesPerTrigger`` plays the
    role of ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: batch Parquet scan with partition discovery."""
    return spark.read.parquet(path)


def read_json_events(spark: SparkSession, path: str, schema: StructType | None = None,
                     options: dict | None = None) -> DataFrame:
    """SRC4: JSON lines; give a schema to skip the inference pass."""
    reader = spark.read.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


# Error classes that mean "these files are not Parquet" rather than an I/O or
# permission problem (which must surface, not fall through to JSON).
_NOT_PARQUET = ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER")


def read_any(spark: SparkSession, path: str, json_schema: StructType | None = None,
             json_options: dict | None = None) -> DataFrame:
    """SRC5: Parquet first; JSON only when the files are not Parquet.

    Only the two "not Parquet" error classes trigger the JSON retry; every
    other error, a missing path included, is raised.
    """
    try:
        return read_parquet(spark, path)
    except (PySparkException, Py4JJavaError) as exc:   # a footer error comes unconverted
        if not any(c in str(exc) for c in _NOT_PARQUET):
            raise
    return read_json_events(spark, path, json_schema, json_options)


def read_report_csv(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """SRC6: the report CSV with header.

    The header names the columns, in whatever order they come; all are read
    as text (no inference pass). ``typed`` selects the report's columns that
    the file has, in report order, each converted by ``try_cast`` so a bad
    cell becomes NULL and the checks can see it.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if not typed:
        return raw
    from pyspark.sql import functions as F
    return raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name)
                       for f in schemas.REPORT.fields if f.name in raw.columns])
