"""Hold a block of rows in a task and stream other rows of the same block past it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hold_and_stream(held: DataFrame, passing: DataFrame, block: str, schema: str,
                    search: Callable[[pa.Table], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]]) -> DataFrame:
    """For every block: ``search(held rows)`` gives a function that each batch of the passing rows goes through.

    Both frames have the same columns. A task sorts its rows by block, held ones first, so that it keeps one
    block's held rows and one batch of passing rows in memory, however many rows pass.
    """
    columns = held.columns
    both = (held.withColumn("_passes", F.lit(False)).unionByName(passing.withColumn("_passes", F.lit(True)))
            .repartition(block).sortWithinPartitions(block, "_passes").select("_passes", *columns))
    at = both.columns.index(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, through = None, [], None
        for whole in batches:
            for batch in _runs(whole, at):
                number, passes = batch.column(at)[0].as_py(), batch.column(0)[0].as_py()
                if number != now:
                    now, rows, through = number, [], None
                batch = pa.RecordBatch.from_arrays(batch.columns[1:], columns)
                if not passes:
                    rows.append(batch)
                elif rows or through:
                    if through is None:
                        through, rows = search(pa.Table.from_batches(rows)), []
                    yield from through(batch)

    return both.mapInArrow(run, schema)


def _runs(batch: pa.RecordBatch, block: int) -> Iterator[pa.RecordBatch]:
    """Slices of one block and one kind each."""
    if not len(batch):
        return
    kinds = pa.RecordBatch.from_arrays([batch.column(block), batch.column(0)], ["block", "passes"])
    ends = pc.run_end_encode(kinds.column(0)).run_ends.to_pylist()
    ends += pc.run_end_encode(kinds.column(1).cast(pa.int8())).run_ends.to_pylist()
    start = 0
    for end in sorted(set(ends)):
        yield batch.slice(start, end - start)
        start = end
