"""Sinks for alerts, statistics and the event archive.

Executors write everything; no row passes through the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from logwarden.config import DatabaseConfig

BatchWriter = Callable[[DataFrame, int], None]

_log = logging.getLogger(__name__)


def _nonempty(name: str, write: BatchWriter) -> BatchWriter:
    """Skip empty batches, log the others, let errors stop the query.

    Counting and writing are two actions; persisting the batch keeps the second from running
    the stateful plan again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch.count()
            if rows == 0:
                return
            write(batch, batch_id)
            _log.info("%s: wrote %d rows of batch %d", name, rows, batch_id)
        finally:
            batch.unpersist()

    return handle


def _query_id(batch: DataFrame) -> str:
    """Identity of the running query, which its checkpoint keeps over restarts."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query_id is None:
        raise ValueError("this writer works inside foreachBatch of a streaming query only")
    return query_id


def parquet_table(path: str) -> BatchWriter:
    """Idempotent table: a batch owns one folder, so a replayed batch replaces itself.

    Queries may share a table.  Batch numbers are per query, and start again at zero with a new
    checkpoint, so the folder carries the query's identity as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/query={_query_id(batch)}/batch_id={batch_id}"
        # Rebalancing sizes the files by volume, whatever the number of shuffle partitions.
        batch.hint("rebalance").write.mode("overwrite").parquet(target)

    return _nonempty(path, write)


def jdbc_table(table: str, database: DatabaseConfig) -> BatchWriter:
    """Database table, appended in parallel.  At least once: a replayed batch adds its rows
    again, and the added `query_id` and `batch_id` columns let a reader tell them apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        properties = {
            "user": database.user,
            "password": database.password,
            "driver": database.driver,
            "batchsize": "10000",
        }
        stamped = batch.withColumns(
            {"query_id": F.lit(_query_id(batch)), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        stamped.write.jdbc(database.url, table, mode="append", properties=properties)

    return _nonempty(table, write)


def guarded(sink: BatchWriter, refused_path: str) -> BatchWriter:
    """Gives a sink the accepted rows of a judged batch, and keeps the refused ones in files.

    A row that the store would refuse, such as one with an over-long name, so neither stops the
    query nor is lost.  The refused rows of a batch have a folder of their own, written first: a
    batch that fails and is run again replaces it.
    """
    keep_refused = parquet_table(refused_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            keep_refused(batch.where(~F.col("accepted")).drop("accepted"), batch_id)
            accepted = batch.where("accepted").drop("accepted", "date", "violations")
            sink(accepted, batch_id)
        finally:
            batch.unpersist()

    return write


def with_date(events: DataFrame) -> DataFrame:
    return events.withColumn("date", F.to_date("timestamp").cast("string"))


def archive_stream(events: DataFrame, path: str) -> DataStreamWriter:
    """Append-only archive by event date; the file sink's log makes it exactly once."""
    return (
        with_date(events)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", path)
    )


def archive_table(events: DataFrame, path: str) -> None:
    """The same layout from a table.

    Rebalancing by date gives each date few files, and splits a date that holds much more than
    others instead of sending it to one task.
    """
    with_date(events).hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(
        path
    )
