"""What every batch of every query read, wrote, refused and dropped.

Counts come from `observe`, which counts while the batch runs, and arrive with the batch's
progress; no batch is counted by a second run.  Late events are the exception: the state operators
report dropped groups, after events were combined, so the exact number comes from a balance (see
`late_events`).
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logwarden.sources.shared import child_folders

PROGRESS_DDL = (
    "query string, run_id string, batch_id bigint, started timestamp, watermark timestamp, "
    "source_rows bigint, rows_read bigint, rows_written bigint, rows_refused bigint, "
    "events_written bigint, state_rows bigint, groups_dropped_late bigint"
)
#: Names under which streams observe.
READ, WRITTEN = "read", "written"


def observe_read(events: DataFrame) -> DataFrame:
    return events.observe(READ, F.count("*").alias("rows"))


def observe_written(rows: DataFrame, events: str = "0") -> DataFrame:
    """Counts accepted and refused rows, and sums `events` over the accepted."""
    return rows.observe(
        WRITTEN,
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("refused"),
        F.coalesce(F.sum(F.expr(f"if(accepted, {events}, 0)")), F.lit(0)).cast("bigint").alias("events"),
    )


def _row(progress: dict) -> tuple:
    observed = progress.get("observedMetrics") or {}
    read, written = observed.get(READ) or {}, observed.get(WRITTEN) or {}
    state = progress.get("stateOperators") or []
    return (
        progress.get("name"),
        progress["runId"],
        progress["batchId"],
        progress["timestamp"],
        (progress.get("eventTime") or {}).get("watermark"),
        progress["numInputRows"],
        read.get("rows"),
        written.get("accepted"),
        written.get("refused"),
        written.get("events"),
        sum(s["numRowsTotal"] for s in state),
        sum(s["numRowsDroppedByWatermark"] for s in state),
    )


class ProgressLog(StreamingQueryListener):
    """Collects one row per batch; `flush` appends those since the last call to a table.

    Batches without input are kept only where they wrote or dropped something, so an idle pipeline
    adds no rows.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = _row(json.loads(event.progress.json))
        if any(row[5:10]) or row[11]:
            with self._lock:
                self._rows.append(row)

    def table(self, session: SparkSession) -> DataFrame:
        """The rows not yet flushed."""
        with self._lock:
            rows = list(self._rows)
        text = PROGRESS_DDL.replace("timestamp", "string")
        raw = session.createDataFrame(rows, text)
        times = {name: F.col(name).cast("timestamp") for name in ("started", "watermark")}
        return raw.withColumns(times)

    def flush(self, session: SparkSession, path: str) -> None:
        rows = self.table(session)
        count = rows.count()
        if count:
            rows.limit(count).coalesce(1).write.mode("append").parquet(path)
            with self._lock:
                del self._rows[:count]


def totals(progress: DataFrame) -> DataFrame:
    """Per query: batches, and the sums of what they read, wrote, refused and dropped."""
    sums = [
        F.coalesce(F.sum(name), F.lit(0)).alias(name)
        for name in ("rows_read", "rows_written", "rows_refused", "events_written", "groups_dropped_late")
    ]
    return progress.groupBy("query").agg(F.count_distinct("batch_id").alias("batches"), *sums)


def held_events(session: SparkSession, checkpoint: str) -> int:
    """Events in the open windows of a stopped statistics query, read from its state."""
    if not child_folders(session, f"{checkpoint}/state"):
        return 0
    state = session.read.format("statestore").load(checkpoint)
    # The aggregates of `topic_stats` in order; two of them have the same name in the state.
    sums = F.col("value").cast("struct<events: bigint, fails: bigint, bytes: bigint>")
    return state.agg(F.coalesce(F.sum(sums["events"]), F.lit(0))).first()[0]


def late_events(session: SparkSession, progress: DataFrame, query: str, checkpoint: str) -> int:
    """Exactly how many events a stopped statistics query dropped as late: those it read, less
    those in the rows it wrote, less those its open windows hold."""
    own = progress.where(F.col("query") == query)
    sums = own.agg(F.coalesce(F.sum("rows_read"), F.lit(0)), F.coalesce(F.sum("events_written"), F.lit(0)))
    read, written = sums.first()
    return read - written - held_events(session, checkpoint)
