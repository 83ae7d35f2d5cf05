"""Per-minute traffic statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.operators.detect import union_all
from logwarden.schemas import STATS_COLUMNS


def topic_stats(events: DataFrame, topic: str) -> DataFrame:
    """Events, failures and bytes per minute, source address and country.

    Only actions containing "fail" count as failures, so an invalid user or a blocked
    connection does not.
    """
    minutes = events.groupBy(F.window("timestamp", "1 minute"), "source_ip", "country").agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col("action").contains("fail")).alias("fail_count"),
        F.sum("bytes_sent").alias("bytes_total"),
    )
    return minutes.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.lit(topic).alias("topic"),
        *STATS_COLUMNS[3:],
    )


def traffic_stats(events_by_topic: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(topic_stats(events, topic) for topic, events in events_by_topic.items())
