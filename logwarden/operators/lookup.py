"""Networks from a table: longest-prefix match as equi-joins.

The lists are DataFrames and may be of any size.  Each prefix length in the table (33 at most) is
one left join on the address masked to that length.  Whether a length's networks are broadcast or
both sides are shuffled is Spark's choice by their size; nothing here forces a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import UNKNOWN_COUNTRY, ipv4_to_long

_ALL = (1 << 32) - 1


def network_table(networks: DataFrame, value: Column | None = None) -> DataFrame:
    """length, base and value of each network in the column `cidr`, one row per network.

    A plain address is a network of length 32; host bits are cleared; text that is no network is
    left out; of several values of one network the smallest stays.
    """
    parts = F.split(F.trim("cidr"), "/")
    length = F.coalesce(F.get(parts, F.lit(1)), F.lit("32"))
    parsed = networks.select(
        F.when(length.rlike(r"\A[0-9]{1,2}\z"), length.cast("int")).alias("length"),
        ipv4_to_long(F.get(parts, F.lit(0))).alias("number"),
        (F.lit(True) if value is None else value).alias("value"),
        F.size(parts).alias("parts"),
    ).where("parts <= 2 and length <= 32 and number is not null")
    low = F.expr("shiftleft(1L, 32 - length) - 1")
    base = F.col("number").bitwiseAND(F.lit(_ALL) - low)
    return parsed.groupBy("length", base.alias("base")).agg(F.min("value").alias("value"))


def prefix_lengths(table: DataFrame) -> list[int]:
    """The lengths in a network table, longest first."""
    return sorted((r.length for r in table.select("length").distinct().collect()), reverse=True)


def longest_prefix(events: DataFrame, table: DataFrame, address: str, name: str) -> DataFrame:
    """Adds `name`: the value of the longest network that holds the address, or null.

    `table` is the outcome of `network_table`, best stored: it is read once per prefix length.
    Rows are neither lost nor repeated; an address that is null or malformed is in no network.
    """
    result = events.withColumn("_number", ipv4_to_long(F.col(address)))
    found = []
    for length in prefix_lengths(table):
        mask = _ALL ^ ((1 << (32 - length)) - 1)
        side = table.where(F.col("length") == length).select(
            F.col("base").alias("_base"), F.col("value").alias(f"_value_{length}")
        )
        masked = F.col("_number").bitwiseAND(F.lit(mask).cast("bigint"))
        result = result.join(side, masked == F.col("_base"), "left").drop("_base")
        found.append(f"_value_{length}")
    value = F.coalesce(*map(F.col, found)) if found else F.lit(None)
    return result.withColumn(name, value).drop("_number", *found)


def enrich_country_from(events: DataFrame, table: DataFrame) -> DataFrame:
    """Country by the longest matching network, else UNKNOWN."""
    found = longest_prefix(events, table, "source_ip", "_country")
    country = F.coalesce(F.col("_country"), F.lit(UNKNOWN_COUNTRY))
    return found.withColumn("country", country).drop("_country")


def tag_blacklist_from(events: DataFrame, table: DataFrame) -> DataFrame:
    """Whether the address lies in any listed network; malformed addresses do not."""
    found = longest_prefix(events, table, "source_ip", "_listed")
    listed = F.coalesce(F.col("_listed").cast("boolean"), F.lit(False))
    return found.withColumn("blacklisted", listed).drop("_listed")
