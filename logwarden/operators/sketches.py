"""Distinct counts that can be stored and merged.

A sketch is a binary column made by Spark's HLL sketch functions.  Sketches of parts merge to the
sketch of the whole: minutes to hours, topics to a total, today's to last week's.  With
`LOG_SIZE` = 12 a sketch keeps up to 512 values as such, so its count is then the exact one (apart
from collisions of a 26-bit hash); beyond that the relative standard error is 1.04 / 2 ** 6, 1.6 %,
and a sketch takes at most some 4 KB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12
#: Counts up to this many are kept as values.
EXACT_UP_TO = 512
#: Three standard errors of a larger count.
RELATIVE_ERROR = 3 * 1.04 / 2 ** (LOG_SIZE / 2)


def distinct_sketch(column: Column) -> Column:
    """Aggregate: the sketch of a column's values; nulls don't count."""
    return F.hll_sketch_agg(column, LOG_SIZE)


def merged_distinct(sketch: Column | str) -> Column:
    """Aggregate: the sketch of the union."""
    return F.hll_union_agg(sketch)


def distinct_estimate(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("bigint"))


def distinct_panes(events: DataFrame, keys: list[str], value: str, seconds: int) -> DataFrame:
    """pane_start, the keys, events and values (a sketch): a table worth storing.

    Sketches are merged per task before the shuffle, so a key with very many events sends one
    small row per task and pane.
    """
    pane = F.window("timestamp", f"{seconds} seconds")
    panes = events.groupBy(pane.alias("pane"), *keys).agg(
        F.count("*").alias("events"), distinct_sketch(F.col(value)).alias("values")
    )
    return panes.select(F.col("pane.start").alias("pane_start"), *keys, "events", "values")


def distinct_over(panes: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """window_start, the keys, events and distinct_values of stored panes, over longer tumbling windows.

    `seconds` is a multiple of the panes' length; events outside are not read again.
    """
    window = F.window("pane_start", f"{seconds} seconds")
    merged = panes.groupBy(window.alias("window"), *keys).agg(
        F.sum("events").alias("events"), merged_distinct("values").alias("values")
    )
    return merged.select(
        F.col("window.start").alias("window_start"),
        *keys,
        "events",
        distinct_estimate(F.col("values")).alias("distinct_values"),
    )


def outside_bound(estimated: Column, exact: Column) -> Column:
    """Whether an estimate misses the stated bound: exact up to `EXACT_UP_TO`, then three standard errors."""
    allowed = F.when(exact <= EXACT_UP_TO, 0.0).otherwise(exact * RELATIVE_ERROR)
    return F.abs(estimated - exact) > allowed
