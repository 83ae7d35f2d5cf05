"""Several rules over one topic in one pass, with approximate distinct counts.

Every event goes once into the pane of its address.  A pane holds the aggregates of all rules side by
side: conditional counts, sums and maxima, and a sketch for each distinct rule.  Only then does a pane
become one row per rule that had an event in it, and is spread over the rule's windows.  A topic is
scanned and sorted once however many rules read it.

This pays where reading a topic is the dear part.  On local columnar files the separate passes of
`windowed` are faster, as each sorts only its own rule's events on fewer columns; figures in
`benchmarks/shared_panes.py`.  Exact distinct counts need the values in the keys and stay apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.rules import Rule
from logwarden.operators.sketches import distinct_estimate, distinct_sketch, merged_distinct
from logwarden.schemas import ALERT_COLUMNS, ALERT_TYPES

_WHO = ("rule", "source_ip", "country")


def can_share(rule: Rule) -> bool:
    """Rules whose panes are their slides, without further aggregates or follow-up."""
    return not rule.extras and rule.follow_up is None and rule.window_s % rule.slide_s == 0 and rule.measure.kind != "max"


def shared_alerts(events: DataFrame, rules: list[Rule]) -> DataFrame:
    """The alerts of rules of one topic, like the union of their own approximate alerts; tables only."""
    matches = [F.coalesce(rule.where(), F.lit(False)) for rule in rules]
    # Columns of their own, so that each condition is computed once an event.
    tests = {f"matches_{i}": match for i, match in enumerate(matches)}
    hits = events.where(F.col("timestamp").isNotNull() & reduce(Column.__or__, matches)).withColumns(tests)
    base = gcd(*(rule.slide_s for rule in rules))
    carried = sorted({name for rule in rules for name in rule.carry})

    aggregates = []
    for i, rule in enumerate(rules):
        matched = F.col(f"matches_{i}")
        given = F.when(matched, F.expr(rule.measure.expr) if rule.measure.expr != "*" else F.lit(1))
        aggregates.append(F.count_if(matched).alias(f"hits_{i}"))
        if rule.counts_distinct:
            aggregates.append(distinct_sketch(given).alias(f"measure_{i}"))
        else:
            aggregates.append((F.sum if rule.measure.kind == "sum" else F.count)(given).alias(f"measure_{i}"))
        for name, expr in rule.carry.items():
            aggregates.append(F.max(F.when(matched, F.expr(expr))).alias(f"{name}_{i}"))
    pane = F.window("timestamp", f"{base} seconds")
    panes = (
        hits.withColumn("pane", pane.start)
        .groupBy("pane", "source_ip", "country")
        .agg(*aggregates)
    )
    for slide in sorted({rule.slide_s for rule in rules}):
        panes = panes.withColumn(f"slide_{slide}", F.window("pane", f"{slide} seconds").start)

    def part(i: int, rule: Rule) -> Column:
        """The pane as one rule sees it, with the starts of the rule's windows that hold it."""
        first, slides = F.col(f"slide_{rule.slide_s}"), range(rule.window_s // rule.slide_s)
        starts = F.array(*[first - F.expr(f"INTERVAL '{k * rule.slide_s}' SECOND") for k in slides])
        measure = F.col(f"measure_{i}")
        columns = [
            F.lit(i).alias("rule"),
            starts.alias("starts"),
            (F.lit(None).cast("bigint") if rule.counts_distinct else measure).alias("amount"),
            (measure if rule.counts_distinct else F.lit(None).cast("binary")).alias("values"),
        ]
        for name in carried:
            given = F.col(f"{name}_{i}") if name in rule.carry else F.lit(None)
            columns.append(given.cast(ALERT_TYPES[name]).alias(name))
        return F.when(F.col(f"hits_{i}") > 0, F.struct(*columns))

    parts = F.array_compact(F.array(*[part(i, rule) for i, rule in enumerate(rules)]))
    rows = panes.select("source_ip", "country", F.inline(parts))
    groups = (
        rows.withColumn("start", F.explode("starts"))
        .groupBy(*_WHO, "start")
        .agg(
            F.sum("amount").alias("amount"),
            merged_distinct("values").alias("values"),
            *[F.max(name).alias(name) for name in carried],
        )
    )
    counted = _by_rule(rules, lambda r: r.counts_distinct)
    measure = F.when(counted, distinct_estimate(F.col("values"))).otherwise(F.col("amount"))
    groups = groups.withColumn("measure", measure)
    firing = groups.where(F.col("measure") > _by_rule(rules, lambda r: r.trigger))
    return firing.select(*[_alert_column(name, rules) for name in ALERT_COLUMNS])


def _by_rule(rules: Iterable[Rule], given: Callable[[Rule], object]) -> Column:
    """A constant or column of each rule, chosen by the row's rule number."""
    values = [x if isinstance(x := given(rule), Column) else F.lit(x) for rule in rules]
    if len({str(x) for x in values}) == 1:
        return values[0]
    chosen = F
    for number, value in enumerate(values):
        chosen = chosen.when(F.col("rule") == number, value)
    return chosen


def _alert_column(name: str, rules: list[Rule]) -> Column:
    if name == "timestamp":
        return F.col("start").alias(name)
    if name in ("source_ip", "country"):
        return F.col(name)

    def of(rule: Rule) -> Column:
        if name == "severity":
            return rule.severity(F.col("measure"))
        if name == "bytes_sent" and rule.bytes_from_measure:
            return F.col("measure")
        return F.col(name) if name in rule.carry else F.lit(rule.constants()[name]).cast(ALERT_TYPES[name])

    return _by_rule(rules, of).alias(name)
