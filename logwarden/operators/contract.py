"""Output contract of the alert and statistics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.schemas import ALERT_COLUMNS, SEVERITIES, STATS_COLUMNS

# Columns that must be present, and the longest text each column takes.
ALERT_REQUIRED = ("timestamp", "source_ip", "topic", "action", "severity", "rule_triggered")
ALERT_LENGTHS = {
    "source_ip": 45,
    "destination_ip": 45,
    "username": 100,
    "topic": 20,
    "action": 100,
    "protocol": 10,
    "country": 50,
    "severity": 10,
    "rule_triggered": 50,
}
STATS_REQUIRED = ("window_start", "window_end", "topic")
STATS_LENGTHS = {"topic": 20, "source_ip": 45, "country": 50}


def _broken(required: tuple[str, ...], lengths: dict[str, int], domain: bool) -> Column:
    """Names of all broken constraints of a row, separated by commas; empty for a good row."""
    tests = {f"{name}_missing": F.col(name).isNull() for name in required}
    for name, limit in lengths.items():
        tests[f"{name}_too_long"] = F.char_length(name) > limit
    if domain:
        tests["severity_unknown"] = ~F.col("severity").isin(*SEVERITIES)
    broken = F.concat_ws(",", *[F.when(test, name) for name, test in tests.items()])
    # A generator of one value: filters on the result stay above it, so the tests run once.
    return F.explode(F.array(broken))


def alert_violations(alerts: DataFrame) -> DataFrame:
    broken = _broken(ALERT_REQUIRED, ALERT_LENGTHS, domain=True)
    return alerts.select(*ALERT_COLUMNS, broken.alias("violations"))


def stats_violations(stats: DataFrame) -> DataFrame:
    broken = _broken(STATS_REQUIRED, STATS_LENGTHS, domain=False)
    return stats.select(*STATS_COLUMNS, broken.alias("violations"))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, rows that do not, with their violations)."""
    clean = F.col("violations") == ""
    return checked.where(clean).drop("violations"), checked.where(~clean)


def violation_counts(checked: DataFrame) -> DataFrame:
    return (
        checked.where("violations <> ''")
        .select(F.explode(F.split("violations", ",")).alias("violation"))
        .groupBy("violation")
        .agg(F.count("*").alias("n"))
    )
