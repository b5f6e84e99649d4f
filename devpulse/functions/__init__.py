"""Column expressions shared by operators (all Spark built-ins, codegen-friendly)."""

from devpulse.functions.time import parse_event_time_expr
from devpulse.functions.predicates import (
    valid_identity, valid_duration, valid_battery, valid_signal,
    valid_coordinates, valid_record, positive_event, reject_reasons_expr,
)
from devpulse.functions.aggregates import first_row_by_time

__all__ = [
    "parse_event_time_expr", "valid_identity", "valid_duration", "valid_battery",
    "valid_signal", "valid_coordinates", "valid_record", "positive_event",
    "reject_reasons_expr", "first_row_by_time",
]
