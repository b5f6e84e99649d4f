"""Deterministic replacements for order-dependent aggregates."""

from pyspark.sql import Column, functions as F


def first_row_by_time(values: list[str], time_col: str = "event_timestamp", tiebreak: str = "event_id") -> Column:
    """Several columns of the earliest row (ties broken by id) as one struct.

    ``first()`` depends on arrival order and gives different answers on
    re-execution; ``min_by`` over ``(time, id)`` is reproducible, partially
    aggregable and allowed in streaming aggregations.
    """
    return F.min_by(F.struct(*[F.col(v) for v in values]), F.struct(F.col(time_col), F.col(tiebreak)))
