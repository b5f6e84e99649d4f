"""Structured Streaming form of the ingest chain (STR1-STR4, STR6).

envelope stream -> parse -> valid rows -> watermark (once) -> bounded
de-duplication -> one-minute windows per device. The watermark is declared a
single time, at the start of the stateful section; both stateful operators
evict their state by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from devpulse import constants as C
from devpulse.operators.transform import filter_valid_records, parse_events
from devpulse.operators.windows import window_aggregate


def with_event_watermark(df: DataFrame, delay: str = C.WATERMARK_DELAY,
                         time_col: str = "event_timestamp") -> DataFrame:
    """STR1: event-time watermark (apply once per query)."""
    return df.withWatermark(time_col, delay)


def _rising_per_key(keys: list[str], time_col: str):
    """Arrow batch -> the rows whose event time exceeds that of all earlier rows of their key, in arrival order.

    Rows without a time are kept.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            key = table.select(keys).to_pandas().groupby(keys, dropna=False, sort=False).ngroup()
            if key.nunique() == len(key):             # no repeats: the batch as it came
                yield batch
                continue
            time = table.column(time_col).cast(pa.int64()).to_pandas()
            highest = time.groupby(key).cummax()
            before = highest.groupby(key).ffill().groupby(key).shift()
            keep = time.isna() | before.isna() | (time > before)
            yield from table.take(pa.array(np.flatnonzero(keep.to_numpy()))).to_batches()
    return run


def pre_deduplicate(df: DataFrame, keys: list[str] | None = None, time_col: str = "event_timestamp") -> DataFrame:
    """Drop repeats of a key inside each Arrow batch before the shuffle.

    Streaming de-duplication shuffles every row by key with no map-side
    combine, so one key repeated millions of times in a micro-batch would
    land in one task. A row stays when its event time is later than that of
    all rows of its key before it in the batch. Whatever the watermark, the
    first row that is not late is such a row (those before it are late, hence
    earlier), so the stateful operator after this step emits the same rows.
    """
    keys = keys or list(C.DEDUP_KEYS)
    return df.mapInArrow(_rising_per_key(keys, time_col), df.schema)


def deduplicate_stream(df: DataFrame, keys: list[str] | None = None, within_watermark: bool = True,
                       pre_dedup: bool = True) -> DataFrame:
    """STR2: one row per key.

    ``within_watermark`` (default) keeps state only for the watermark delay,
    so state stays bounded; duplicates are guaranteed removed when they arrive
    within the delay of each other. ``False`` uses ``dropDuplicates`` on the
    keys alone, which is exact forever but keeps every key in state.
    ``pre_dedup`` (default) first drops rows of a key that are no later than
    one before them in the Arrow batch, so a key with millions of copies does
    not reach one task; the emitted rows stay the same for every watermark.
    Needs a watermark on the frame.
    """
    keys = keys or list(C.DEDUP_KEYS)
    if pre_dedup:
        df = pre_deduplicate(df, keys)
    if within_watermark:
        return df.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def stream_windows(envelope: DataFrame, duration: str = C.WINDOW_DURATION, delay: str = C.WATERMARK_DELAY,
                   within_watermark: bool = True, pre_dedup: bool = True) -> DataFrame:
    """STR4: parse -> filter -> watermark -> de-dup -> tumbling window aggregate."""
    valid = filter_valid_records(parse_events(envelope))
    marked = with_event_watermark(valid, delay)
    unique = deduplicate_stream(marked, within_watermark=within_watermark, pre_dedup=pre_dedup)
    return window_aggregate(unique, duration)
