"""Batch form of the ingest chain: envelope -> flat events -> valid events ->
de-duplicated events -> one-minute windows per device.

The same operators run in the streaming plan (``devpulse.streaming.etl``);
this batch form is the reference result the stream is tested against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devpulse import constants as C
from devpulse.functions.predicates import reject_reasons_expr
from devpulse.operators.transform import filter_valid_records, parse_events
from devpulse.operators.windows import deduplicate, window_aggregate


def clean_events(envelope: DataFrame) -> DataFrame:
    """Parse and keep valid rows (PRJ1-4, FLT1, FLT7)."""
    return filter_valid_records(parse_events(envelope))


def unique_events(envelope: DataFrame) -> DataFrame:
    """Valid rows, one per (event_id, device_id): the first arrival."""
    return deduplicate(clean_events(envelope))


def window_table(envelope: DataFrame, duration: str = C.WINDOW_DURATION) -> DataFrame:
    """The stored window table in batch (AGG1 over unique valid events)."""
    return window_aggregate(unique_events(envelope), duration)


def reject_reasons(flat: DataFrame) -> DataFrame:
    """DQ10: every flat event with the list of rules it breaks.

    Rows with an empty list are exactly the rows ``filter_valid_records`` keeps.
    """
    has_corrupt = "_corrupt_record" in flat.columns
    return flat.withColumn("reject_reasons", reject_reasons_expr(has_corrupt))


def split_by_validity(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-reasons) from one reasons column."""
    tagged = reject_reasons(flat)
    accepted = tagged.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    rejected = tagged.filter(F.size("reject_reasons") > 0)
    return accepted, rejected
