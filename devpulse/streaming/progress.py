"""STR5: late-data and state figures from a query's progress reports."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = ("query string, run string, batch long, operator int, name string, rows_in_state long, rows_updated long, "
            "rows_dropped long, watermark string, input_rows long")


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of the session's queries while it is attached (a query itself keeps the last 100).

    A row for each batch and stateful operator (operator NULL for a batch without). A batch that reports twice
    (an idle trigger) counts once, with its last report.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.reports, self.ended = spark, {}, threading.Event()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        self.reports[report["runId"], report["batchId"]] = report

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and its last report has arrived (reports come asynchronously)."""
        query.awaitTermination()
        if not self.ended.wait(seconds):
            raise TimeoutError("the query's end was not reported")
        if query.exception():
            raise query.exception()

    def rows(self) -> DataFrame:
        """All reports so far as a table (``PROGRESS``)."""
        out = []
        for (run, batch), r in sorted(self.reports.items(), key=lambda x: x[0][1]):
            mark = r.get("eventTime", {}).get("watermark")
            for i, op in enumerate(r.get("stateOperators") or [{}]):
                out.append((r["id"], run, batch, i if op else None, op.get("operatorName"), op.get("numRowsTotal"),
                            op.get("numRowsUpdated"), op.get("numRowsDroppedByWatermark"), mark, r.get("numInputRows")))
        return self.spark.createDataFrame(out, PROGRESS)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as late, summed over the retained progress reports."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators:
            value = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(value or 0)
    return total


def rows_in_state(query: StreamingQuery) -> dict[str, int]:
    """Rows held by each stateful operator after the last batch, by operator name
    (e.g. ``stateStoreSave`` for the window aggregate, ``dedupeWithinWatermark``)."""
    last = query.lastProgress
    if not last:
        return {}
    ops = last.get("stateOperators", []) if isinstance(last, dict) else last.stateOperators
    out = {}
    for op in ops:
        name = op.get("operatorName") if isinstance(op, dict) else op.operatorName
        total = op.get("numRowsTotal") if isinstance(op, dict) else op.numRowsTotal
        out[name] = out.get(name, 0) + int(total or 0)
    return out
