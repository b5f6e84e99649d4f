"""Validity predicates for flat events and the reasons a row fails them.

Filters and reject reasons are built from the same expressions, so a row is
dropped by ``filter_valid_records`` exactly when ``reject_reasons`` is
non-empty. Comparisons with NULL are made explicit: every range check is
``x IS NOT NULL AND lo <= x <= hi`` so the result is never NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from devpulse import constants as C


def _between(name: str, lo, hi) -> Column:
    c = F.col(name)
    return c.isNotNull() & (c >= F.lit(lo)) & (c <= F.lit(hi))


def valid_identity() -> Column:
    """FLT2: identity and event time present."""
    return (
        F.col("event_id").isNotNull()
        & F.col("device_id").isNotNull()
        & F.col("device_type").isNotNull()
        & F.col("event_timestamp").isNotNull()
    )


def valid_duration() -> Column:
    """FLT3: 0 < event_duration < 100, both bounds exclusive."""
    d = F.col("event_duration")
    return d.isNotNull() & (d > F.lit(C.DURATION_MIN_EXCLUSIVE)) & (d < F.lit(C.DURATION_MAX_EXCLUSIVE))


def valid_battery() -> Column:
    """FLT4: 0 <= battery_level <= 100."""
    return _between("battery_level", C.BATTERY_MIN, C.BATTERY_MAX)


def valid_signal() -> Column:
    """FLT5: -120 <= signal_strength <= 0."""
    return _between("signal_strength", C.SIGNAL_MIN, C.SIGNAL_MAX)


def valid_coordinates() -> Column:
    """FLT6: latitude in [-90, 90] and longitude in [-180, 180]."""
    return (_between("latitude", C.LATITUDE_MIN, C.LATITUDE_MAX)
            & _between("longitude", C.LONGITUDE_MIN, C.LONGITUDE_MAX))


def valid_record() -> Column:
    """FLT7: conjunction of FLT2..FLT6 (city, country, firmware may be NULL)."""
    return valid_identity() & valid_duration() & valid_battery() & valid_signal() & valid_coordinates()


def positive_event() -> Column:
    """FLT8: the report's input filter (no upper bound on duration)."""
    return (
        F.col("event_duration").isNotNull()
        & F.col("device_type").isNotNull()
        & F.col("event_date").isNotNull()
        & (F.col("event_duration") > F.lit(0.0))
    )


def reasons_array(rules: list[tuple[str, Column]]) -> Column:
    """array<string> of the labels whose condition holds, in rule order.

    Built as a ``concat`` of one- or zero-element arrays: plain expressions
    that stay in whole-stage codegen (with common-subexpression elimination),
    unlike a lambda ``filter`` over an array of NULLs.
    """
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(cond, F.array(F.lit(label))).otherwise(empty) for label, cond in rules])


def reject_rules(has_corrupt_column: bool = False) -> list[tuple[str, Column]]:
    """(label, condition) for every way a flat event fails FLT7, in report order."""
    rules = []
    if has_corrupt_column:
        rules.append(("malformed_json", F.col("_corrupt_record").isNotNull()))
    rules += [
        ("missing_event_id", F.col("event_id").isNull()),
        ("missing_device_id", F.col("device_id").isNull()),
        ("missing_device_type", F.col("device_type").isNull()),
        ("bad_event_time", F.col("event_timestamp").isNull()),
        ("bad_duration", ~valid_duration()),
        ("bad_battery_level", ~valid_battery()),
        ("bad_signal_strength", ~valid_signal()),
        ("bad_coordinates", ~valid_coordinates()),
    ]
    return rules


def reject_reasons_expr(has_corrupt_column: bool = False) -> Column:
    """array<string> of every rule a flat event breaks (empty when valid)."""
    return reasons_array(reject_rules(has_corrupt_column))
