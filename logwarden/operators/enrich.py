"""Lookups that add one column to a table of events, without a join or a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import (
    BLOCK_LIST,
    COUNTRY_BY_PREFIX,
    WATCHED_PORTS,
    country_of,
    in_networks,
    ipv4_to_long,
    network_class,
)


def enrich_country(
    events: DataFrame, prefixes: Mapping[str, str] = COUNTRY_BY_PREFIX
) -> DataFrame:
    return events.withColumn("country", country_of(F.col("source_ip"), prefixes))


def _with_number(events: DataFrame) -> DataFrame:
    # A column of its own: used several times, it is still computed once per row.
    return events.withColumn("ip_number", ipv4_to_long(F.col("source_ip")))


def tag_blacklist(events: DataFrame, cidrs: Iterable[str] = BLOCK_LIST) -> DataFrame:
    listed = in_networks(F.col("ip_number"), cidrs)
    return _with_number(events).withColumn("blacklisted", listed).drop("ip_number")


def classify_network(events: DataFrame) -> DataFrame:
    kind = network_class(F.col("ip_number"))
    return _with_number(events).withColumn("network_class", kind).drop("ip_number")


def tag_suspicious_port(events: DataFrame, ports: Iterable[int] = WATCHED_PORTS) -> DataFrame:
    watched = F.coalesce(F.col("destination_port").isin(*ports), F.lit(False))
    return events.withColumn("suspicious_port", watched)
