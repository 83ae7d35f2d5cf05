"""Reporting queries over the alert and traffic-statistics tables.

Newest-first lists break ties by rule, address and country, because alert times are window
starts and many alerts share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.schemas import SEVERITIES

_TIE_BREAK = ("rule_triggered", "source_ip", "country")


def total_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("value"))


def critical_alerts(alerts: DataFrame) -> DataFrame:
    return total_alerts(alerts.where(F.col("severity") == "CRIT"))


def events_processed(stats: DataFrame) -> DataFrame:
    """Null for an empty table, like every sum here."""
    return stats.agg(F.sum("event_count").alias("value"))


def total_bytes(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("bytes_total").alias("value"))


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("rule_triggered")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "rule_triggered")
    )


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    return alerts.groupBy("severity").agg(F.count("*").alias("count")).orderBy(rank)


def alerts_by_rule_severity(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("rule_triggered", "severity")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "rule_triggered", "severity")
    )


def _between(table: DataFrame, time: str, start, end) -> DataFrame:
    """Rows of a time range.  Where the table is kept by date, only the range's days are read."""
    dated = "date" in table.columns
    for bound, holds in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            table = table.where(holds(F.col(time), bound))
            if dated:
                # The bound is a constant, so this selects folders before anything is read.
                table = table.where(holds(F.col("date"), F.to_date(F.lit(bound)).cast("string")))
    return table


def _series(stats: DataFrame, measure: str, topics: tuple[str, ...], start, end) -> DataFrame:
    def total(topic: str) -> Column:
        # A conditional sum, not a pivot: a topic without rows shows 0 instead of null.
        value = F.when(F.col("topic") == topic, F.col(measure)).otherwise(0)
        return F.sum(value).alias(topic.capitalize())

    return (
        _between(stats, "window_start", start, end)
        .groupBy(F.col("window_start").alias("time"))
        .agg(*map(total, topics))
        .orderBy("time")
    )


def last_hour() -> tuple[Column, Column]:
    """The default time range of the time series."""
    return F.current_timestamp() - F.expr("INTERVAL '1' HOUR"), F.current_timestamp()


def events_over_time(stats: DataFrame, start=None, end=None) -> DataFrame:
    return _series(stats, "event_count", ("auth", "firewall", "web"), start, end)


def bytes_over_time(stats: DataFrame, start=None, end=None) -> DataFrame:
    """Authentication events carry no bytes and are left out."""
    return _series(stats, "bytes_total", ("firewall", "web"), start, end)


def _newest(alerts: DataFrame, columns: tuple[str, ...], n: int) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), *_TIE_BREAK).limit(n).select(*columns)


def recent_alerts(alerts: DataFrame, n: int = 50, start=None, end=None) -> DataFrame:
    columns = ("timestamp", "source_ip", "country", "destination_ip", "rule_triggered", "severity")
    return _newest(_between(alerts, "timestamp", start, end), columns, n)


def latest_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    columns = ("timestamp", "source_ip", "country", "rule_triggered", "severity")
    return _newest(alerts, columns, n)


def traffic_by_topic(stats: DataFrame) -> DataFrame:
    return stats.groupBy("topic").agg(
        F.sum("event_count").alias("events"), F.sum("bytes_total").alias("bytes")
    )


def top_sources(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Addresses with the most alerts."""
    return (
        alerts.groupBy("source_ip")
        .agg(F.count("*").alias("alerts"))
        .orderBy(F.desc("alerts"), "source_ip")
        .limit(n)
    )
