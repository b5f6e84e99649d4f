"""Event-time parsing.

The four ISO-8601 shapes are tried in order, then Spark's own ISO parser.
``try_to_timestamp`` returns NULL on a mismatch, so the chain works with ANSI
mode on (``to_timestamp`` would raise on the first pattern that does not fit).
"""

from pyspark.sql import Column, functions as F

from devpulse.constants import EVENT_TIME_FORMATS


def parse_event_time_expr(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP; NULL when no shape fits.

    Each pattern is tried only when the text can match it: the shapes with a
    fraction need a '.', the ones without cannot contain one, and the 'Z'
    shapes need a trailing Z. A failed parse costs far more than these
    checks, and skipping a pattern that cannot match leaves the first
    fitting shape unchanged (tested against the plain chain). The last branch
    needs a year: a time alone would be read as today's, another answer on
    every run.
    """
    with_fraction, no_fraction_offset, with_fraction_z, no_fraction_z = EVENT_TIME_FORMATS
    dot = text.contains(".")
    z = text.endswith("Z") | text.endswith("z")
    return F.coalesce(
        F.when(dot, F.try_to_timestamp(text, F.lit(with_fraction))),
        F.when(~dot, F.try_to_timestamp(text, F.lit(no_fraction_offset))),
        F.when(dot & z, F.try_to_timestamp(text, F.lit(with_fraction_z))),
        F.when(~dot & z, F.try_to_timestamp(text, F.lit(no_fraction_z))),
        F.when(text.rlike(r"^\s*\d{4}"), F.try_to_timestamp(text)),
    )
