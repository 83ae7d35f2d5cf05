"""How a rule's windowed aggregate is laid out for Spark.

Every shape returns the groups that pass the rule: window_start, source_ip, country, measure, the
extras and the carried columns.  The shapes differ only in cost.

* Tables, count/sum rules (`_paned`): an event lies in two to five overlapping windows, and a
  maximum over text makes Spark sort its input.  So events are first reduced to tumbling panes
  of one slide, and only the panes are spread over the windows.  Sorting sees each event once.
* Distinct rules, approximate: a pane holds a mergeable sketch of the values it saw (see
  `logwarden.operators.sketches`), and windows merge sketches.  On tables that is `_paned` again;
  on streams two chained aggregates, so an event touches the state of one pane, not of every window.
* Tables, exact distinct rules (`_split`): the distinct count needs only narrow columns, so it runs
  as a pure hash aggregate beside the paned maxima, and both meet on keys they are already
  partitioned by.  The count goes through Spark's two-step distinct plan, which spreads one hot
  address over all tasks by value.
* Rules with a follow-up (`_followed`), tables and streams alike: events are first reduced to
  seconds.  Windows over the threshold know the second in which they passed it, and meet the
  follow-up's seconds by address and bucket of one slide; the time conditions only narrow what
  these equal keys bring together, so no key gathers more than a few buckets of seconds.
* Other streams (`_direct`, `_chained`): one stateful aggregate per rule; exact distinct counts chain
  a second one, so no group is ever collected into a set.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.rules import Agg, Rule
from logwarden.operators.sketches import distinct_estimate, distinct_sketch, merged_distinct

_MERGE = {"count": F.sum, "sum": F.sum, "max": F.max, "distinct": merged_distinct}


def firing_windows(events: DataFrame, rule: Rule, distinct: str) -> DataFrame:
    """Groups over the rule's threshold.  `distinct` is "approx" or "exact"."""
    if distinct not in ("approx", "exact"):
        raise ValueError(f"distinct must be 'approx' or 'exact', not {distinct!r}")
    hits = _matching(events, rule.where())
    if rule.follow_up is not None:
        return _followed(hits, _matching(events, rule.follow_up.where()), rule)
    exact = rule.counts_distinct and distinct == "exact"
    if events.isStreaming:
        if exact:
            return _chained(hits, rule)
        return _chained_panes(hits, rule) if rule.counts_distinct else _direct(hits, rule)
    return _split(hits, rule) if exact else _paned(hits, rule)


def _matching(events: DataFrame, matches: Column) -> DataFrame:
    if events.isStreaming:
        # A filter that does not mention the event time is moved below the watermark, which then
        # sees matching events only and holds alerts back until the next match.  Mentioning the
        # time keeps every event of the topic advancing the watermark.
        return events.where(F.when(F.col("timestamp").isNotNull(), matches))
    return events.where(matches)


def _seconds(n: int) -> str:
    return f"{n} seconds"


def _sliding(rule: Rule) -> Column:
    return F.window("timestamp", _seconds(rule.window_s), _seconds(rule.slide_s)).alias("window")


# Tables group by the start of a pane or window only: a plain timestamp, unlike the struct of
# both ends, lets Spark sort on an eight-byte prefix.


def _with_window_start(rows: DataFrame, rule: Rule, source: str = "timestamp") -> DataFrame:
    window = F.window(source, _seconds(rule.window_s), _seconds(rule.slide_s))
    return rows.withColumn("window_start", window.start)


def _with_pane(hits: DataFrame, rule: Rule) -> DataFrame:
    """Panes divide both the window and its slide, so a pane lies in the windows its start does."""
    pane = F.window("timestamp", _seconds(gcd(rule.window_s, rule.slide_s)))
    return hits.withColumn("pane", pane.start)


def _evaluate(agg: Agg, name: str) -> Column:
    """The aggregate over events; a distinct count as a sketch that can still be merged."""
    column = F.expr(agg.expr) if agg.expr != "*" else F.lit(1)
    kinds = {"count": F.count, "sum": F.sum, "max": F.max, "distinct": distinct_sketch}
    return kinds[agg.kind](column).alias(name)


def _carried(rule: Rule) -> list[Column]:
    return [F.max(F.expr(expr)).alias(_slot(name)) for name, expr in rule.carry.items()]


def _slot(name: str) -> str:
    return f"max_{name}"


def _merged(rule: Rule, aggs: dict[str, Agg]) -> list[Column]:
    merged = [_MERGE[agg.kind](name).alias(name) for name, agg in aggs.items()]
    return merged + [F.max(_slot(name)).alias(_slot(name)) for name in rule.carry]


def _passing(groups: DataFrame, rule: Rule) -> DataFrame:
    return groups.where((F.col("measure") > rule.trigger) & F.expr(rule.guard))


def _estimated(groups: DataFrame, rule: Rule) -> DataFrame:
    if not rule.counts_distinct:
        return groups
    return groups.withColumn("measure", distinct_estimate(F.col("measure")))


def _direct(hits: DataFrame, rule: Rule) -> DataFrame:
    aggs = {"measure": rule.measure, **rule.extras}
    columns = [_evaluate(agg, name) for name, agg in aggs.items()]
    groups = hits.groupBy(_sliding(rule), "source_ip", "country").agg(*columns, *_carried(rule))
    return _passing(groups, rule).withColumn("window_start", F.col("window.start"))


def _chained(hits: DataFrame, rule: Rule) -> DataFrame:
    per_value = hits.groupBy(
        _sliding(rule), "source_ip", "country", F.expr(rule.measure.expr).alias("value")
    ).agg(*[_evaluate(agg, name) for name, agg in rule.extras.items()], *_carried(rule))
    groups = per_value.groupBy("window", "source_ip", "country").agg(
        F.count("value").alias("measure"), *_merged(rule, rule.extras)
    )
    return _passing(groups, rule).withColumn("window_start", F.col("window.start"))


def _chained_panes(hits: DataFrame, rule: Rule) -> DataFrame:
    aggs = {"measure": rule.measure, **rule.extras}
    columns = [_evaluate(agg, name) for name, agg in aggs.items()]
    pane = F.window("timestamp", _seconds(gcd(rule.window_s, rule.slide_s))).alias("pane")
    panes = hits.groupBy(pane, "source_ip", "country").agg(*columns, *_carried(rule))
    window = F.window("pane", _seconds(rule.window_s), _seconds(rule.slide_s)).alias("window")
    groups = panes.groupBy(window, "source_ip", "country").agg(*_merged(rule, aggs))
    return _passing(_estimated(groups, rule), rule).withColumn(
        "window_start", F.col("window.start")
    )


def _paned(hits: DataFrame, rule: Rule) -> DataFrame:
    aggs = {"measure": rule.measure, **rule.extras}
    columns = [_evaluate(agg, name) for name, agg in aggs.items()]
    keys = ("source_ip", "country")
    panes = _with_pane(hits, rule).groupBy("pane", *keys).agg(*columns, *_carried(rule))
    if rule.window_s == rule.slide_s:
        groups = panes.withColumnRenamed("pane", "window_start")
    else:
        spread = _with_window_start(panes, rule, "pane")
        groups = spread.groupBy("window_start", *keys).agg(*_merged(rule, aggs))
    return _passing(_estimated(groups, rule), rule)


def _split(hits: DataFrame, rule: Rule) -> DataFrame:
    # A struct key equals itself even where a field is null, so a null country still joins.
    hits = hits.withColumn("who", F.struct("source_ip", "country"))
    exact = F.count_distinct(F.expr(rule.measure.expr)).alias("measure")
    counted = (
        _with_window_start(hits, rule)
        .groupBy("window_start", "who")
        .agg(exact, *[_evaluate(agg, name) for name, agg in rule.extras.items()])
    )
    panes = _with_pane(hits, rule).groupBy("pane", "who").agg(*_carried(rule))
    carried = (
        _with_window_start(panes, rule, "pane")
        .groupBy("window_start", "who")
        .agg(*_merged(rule, {}))
    )
    return (
        _passing(counted, rule)
        .join(carried, ["window_start", "who"])
        .select("*", "who.source_ip", "who.country")
        .drop("who")
    )


def _followed(hits: DataFrame, later: DataFrame, rule: Rule) -> DataFrame:
    second = F.window("timestamp", "1 second").alias("second")
    slide = F.expr(f"INTERVAL '{rule.slide_s}' SECOND")
    horizon = F.expr(f"INTERVAL '{rule.follow_up.horizon_s}' SECOND")

    # A window's seconds are at most as many as it is long, so collecting them is bounded.
    per_second = hits.groupBy(second, "source_ip", "country").agg(F.count("*").alias("n"))
    window = F.window("second", _seconds(rule.window_s), _seconds(rule.slide_s)).alias("window")
    entry = F.struct(F.col("second.start").alias("at"), "n")
    windows = per_second.groupBy(window, "source_ip", "country").agg(
        F.sum("n").alias("measure"), F.array_sort(F.collect_list(entry)).alias("seconds")
    )
    # One event-time column a side: Spark clears the state of a join, and of what comes after it, by it.
    firing = _passing(windows, rule).select(
        F.window_time("window").alias("window_time"),
        F.col("window.start").alias("window_start"),
        (F.col("window.end") + horizon).alias("until"),
        F.col("source_ip").alias("by"),
        "country",
        "measure",
        _second_passed(F.col("seconds"), rule.trigger).alias("passed"),
    )
    buckets = F.sequence("window_start", F.col("until") - slide, slide)
    firing = firing.withColumn("bucket", F.explode(buckets))

    carried = [F.max(name).alias(_slot(name)) for name in rule.carry]
    bucket = F.window("second", _seconds(rule.slide_s))
    followers = (
        later.groupBy(second, "source_ip")
        .agg(*carried)
        .select("*", F.window_time("second").alias("second_time"))
        .withColumn("bucket_of_second", bucket.start)
        .withColumn("second_start", F.col("second.start"))
        .drop("second")
    )

    together = (
        (F.col("source_ip") == F.col("by"))
        & (F.col("bucket_of_second") == F.col("bucket"))
        & (F.col("second_start") >= F.col("passed"))
        & (F.col("second_start") < F.col("until"))
    )
    # The same bounds on the columns that carry the watermark.
    length = F.expr(f"INTERVAL '{rule.window_s}' SECOND")
    together &= F.col("second_time") > F.col("window_time") - length
    together &= F.col("second_time") <= F.col("window_time") + horizon
    keys = ("window_time", "window_start", "source_ip", "country")
    met = firing.join(followers, together).select(*keys, "measure", *map(_slot, rule.carry))
    return met.groupBy(*keys).agg(F.max("measure").alias("measure"), *_merged(rule, {}))


def _second_passed(seconds: Column, trigger: int) -> Column:
    """The first of the sorted (at, n) by which more than `trigger` events have come."""
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.get(seconds, F.lit(0))["at"].alias("at"))

    def add(state: Column, entry: Column) -> Column:
        reached = state["total"] > trigger
        return F.struct(
            (state["total"] + entry["n"]).alias("total"),
            F.when(reached, state["at"]).otherwise(entry["at"]).alias("at"),
        )

    return F.aggregate(seconds, start, add)["at"]
