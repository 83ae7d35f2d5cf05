"""Alerts from events, for one rule or for a set of rules over several topics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.rules import CORE_RULES, Rule
from logwarden.plans.shared import can_share, shared_alerts
from logwarden.plans.windowed import firing_windows
from logwarden.schemas import ALERT_COLUMNS, ALERT_TYPES

def detect(events: DataFrame, rule: Rule, distinct: str = "approx") -> DataFrame:
    """Alerts of one rule, in the 14 alert columns.

    Distinct counts default to Spark's approximate count; "exact" counts exactly.  The alert
    time is the start of the window, and each carried column is its own maximum over the group.
    """
    groups = firing_windows(events, rule, distinct)
    constants = rule.constants()

    def column(name: str) -> Column:
        if name == "timestamp":
            return F.col("window_start").alias(name)
        if name in ("source_ip", "country"):
            return F.col(name)
        if name == "severity":
            return rule.severity(F.col("measure")).alias(name)
        if name == "bytes_sent" and rule.bytes_from_measure:
            return F.col("measure").alias(name)
        if name in rule.carry:
            return F.col(f"max_{name}").alias(name)
        return F.lit(constants[name]).cast(ALERT_TYPES[name]).alias(name)

    return groups.select(*map(column, ALERT_COLUMNS))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def detect_all(
    events_by_topic: Mapping[str, DataFrame],
    rules: Iterable[Rule] = CORE_RULES,
    distinct: str = "approx",
    one_pass: bool = False,
) -> DataFrame:
    """Union of every rule's alerts; a rule reads the events of its own topic.

    With `one_pass`, approximate rules over a table read each topic once, for sources where a scan
    costs more than the wider aggregate does; where scans are cheap, rule by rule is faster.
    """
    rules = list(rules)
    frames = []
    for topic in dict.fromkeys(rule.topic for rule in rules):
        events, own = events_by_topic[topic], [rule for rule in rules if rule.topic == topic]
        alone = not one_pass or events.isStreaming or distinct != "approx"
        together = [] if alone else [rule for rule in own if can_share(rule)]
        if len(together) > 1:
            frames.append(shared_alerts(events, together))
            own = [rule for rule in own if not can_share(rule)]
        frames += [detect(events, rule, distinct) for rule in own]
    return union_all(frames)
