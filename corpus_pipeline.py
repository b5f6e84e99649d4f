"""The corpus pipeline: quality filter, toxicity filter, near-duplicate removal, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from devpulse.llm import packing, quality, queries, simhash, toxicity
from devpulse.plans.staging import stage_table
from devpulse.sources.tables import load_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, load_table(spark, sf_dir, "labels"), queries.GOOD)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_civil(docs, load_table(spark, sf_dir, "labels"), queries.TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, queries.SHINGLE_WORDS, queries.MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all kept documents with their sequences."""
    return packing.pack(docs, queries.WORD_BPE, queries.END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter), ("toxicity", toxicity_filter), ("simhash_near_duplicates", near_duplicates), ("packing", pack)]

#: The stages train models and build fingerprints: no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; every stage's rows are written before the next reads them."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
