"""Bounded, reproducible training rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """The fold of a key that no model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """``key, label`` (0 or 1) of about ``rows`` labelled keys outside the held-out fold, at most twice as many.

    Taken by a hash of the key; small enough to be broadcast. Rows with a null
    key or another label are not used, a key with several rows has its largest
    label.
    """
    usable = (labels.where(F.col(label).isin(0, 1) & ~held_out(key))
              .groupBy(key).agg(F.max(label).cast("int").alias("label")))
    every = max(1, usable.count() // rows)
    return usable.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).limit(2 * rows)


def training_texts(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """``label`` and the text of the chosen keys, as ``text``: of a key on several rows the one with the
    smallest hash, so that the bound on the keys holds for the rows."""
    first = Window.partitionBy("_key").orderBy(F.xxhash64(text), text)
    return (docs.select(F.col(key).alias("_key"), text).join(F.broadcast(chosen.withColumnRenamed(key, "_key")), "_key")
            .withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("label", text))
