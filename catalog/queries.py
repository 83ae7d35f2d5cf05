"""One callable per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.operators import (
    contract, enrich, lookup, parse, rawlogs, reports, rules, sketches, stats,
)
from logwarden.operators.detect import detect, detect_all, union_all
from logwarden.schemas import TOPICS
from logwarden.sinks.tables import archive_table
from logwarden.sources import event_views as views
from logwarden.sources.messages import read_archive
from logwarden.sources.shared import shared_folder
from logwarden.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]

_YEAR = 2024


def _rule(rule: rules.Rule, distinct: str = "exact") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = views.topic_view(spark, sf_dir, rule.topic).drop("event_id")
        return detect(events, rule, distinct)

    return run


def web_scan_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failing request becomes a 404, so that the share crosses one half for some."""
    missing = F.when(F.col("action") != "http_200", 404).otherwise(200)
    events = views.topic_view(spark, sf_dir, "web").withColumn("http_status", missing)
    return detect(events, rules.WEB_SCAN_RATIO, "exact")


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.topic_views(spark, sf_dir)
    return detect_all(events, [rules.block_list_rule(topic) for topic in TOPICS])


def alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_all(views.topic_views(spark, sf_dir), distinct="exact")


def alerts_all_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each topic is read once."""
    return detect_all(views.topic_views(spark, sf_dir), one_pass=True)


def traffic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.traffic_stats(views.topic_views(spark, sf_dir))


def _on_alerts(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(alerts_all(spark, sf_dir))


def _on_stats(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(traffic_stats(spark, sf_dir))


def _ranged(report: Callable[..., DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """The time filter of the series, here from the second minute of the data on."""
    def run(table: DataFrame) -> DataFrame:
        first = F.expr("TIMESTAMP_NTZ'2024-01-01 00:01:00'")
        last = F.expr("TIMESTAMP_NTZ'2030-01-01 00:00:00'")
        return report(table, first, last)

    return run


def _parsed(topic: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parse.parse_events(views.faulty_messages(spark, sf_dir, topic), topic, True)

    return run


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        parse.rejected_events(views.faulty_messages(spark, sf_dir, topic), topic)
        for topic in TOPICS
    )


def _archive(spark: SparkSession, sf_dir: str) -> str:
    base = shared_folder(spark, "archive")
    for topic in TOPICS:
        archive_table(views.dated_topic_view(spark, sf_dir, topic), f"{base}/{topic}")
    return base


def archive_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _archive(spark, sf_dir)
    return union_all(
        read_archive(spark, base, topic)
        .groupBy("topic", "date")
        .agg(F.count("*").alias("events"), F.sum("bytes_sent").alias("bytes"))
        for topic in TOPICS
    )


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _archive(spark, sf_dir)
    return union_all(
        read_archive(spark, base, topic, "2024-01-10", "2024-01-12").select(
            "timestamp", "source_ip", "action", "topic", "date"
        )
        for topic in TOPICS
    )


def alert_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.alert_violations(views.alert_candidates(spark, sf_dir))
    return contract.violation_counts(checked)


def alert_contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.alert_violations(views.alert_candidates(spark, sf_dir))
    return contract.split_valid(checked)[0]


def _on_addresses(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(views.address_view(spark, sf_dir))


def _stored(table: DataFrame, purpose: str) -> DataFrame:
    folder = shared_folder(table.sparkSession, purpose)
    table.write.parquet(folder)
    return table.sparkSession.read.parquet(folder)


def enrich_country_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known prefixes, and customers' smaller networks inside one of them."""
    networks = views.country_networks(spark, sf_dir)
    table = _stored(lookup.network_table(networks, F.col("country")), "networks")
    return lookup.enrich_country_from(views.address_view(spark, sf_dir), table)


def tag_blacklist_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed list, and single addresses that suppliers are listed under."""
    table = _stored(lookup.network_table(views.listed_networks(spark, sf_dir)), "networks")
    return lookup.tag_blacklist_from(views.address_view(spark, sf_dir), table)


def distinct_sketch_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per address and window, merged from stored panes, against exact counts:
    how many groups there are and how many miss the stated bound."""
    results = []
    for topic, value in (("auth", "raw"), ("firewall", "destination_port"), ("web", "url")):
        events = views.topic_view(spark, sf_dir, topic)
        panes = _stored(sketches.distinct_panes(events, ["source_ip"], value, 30), "sketches")
        for seconds in (60, 300):
            merged = sketches.distinct_over(panes, ["source_ip"], seconds)
            exact = events.groupBy(
                F.window("timestamp", f"{seconds} seconds").start.alias("window_start"), "source_ip"
            ).agg(F.count_distinct(value).alias("exact"), F.count("*").alias("exact_events"))
            both = merged.join(exact, ["window_start", "source_ip"], "full")
            wrong = sketches.outside_bound(F.col("distinct_values"), F.col("exact"))
            wrong = F.coalesce(wrong | (F.col("events") != F.col("exact_events")), F.lit(True))
            results.append(
                both.agg(F.count("*").alias("groups"), F.count_if(wrong).alias("outside")).select(
                    F.lit(topic).alias("topic"), F.lit(seconds).alias("seconds"), "groups", "outside"
                )
            )
    return union_all(results)


def _raw_lines(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return views.raw_events(spark, sf_dir, topic).select(F.col("raw").alias("line"))


def _raw(topic: str) -> Query:
    return lambda spark, sf_dir: rawlogs.parse_raw(
        _raw_lines(spark, sf_dir, topic), topic, _YEAR, True
    )


def raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        rawlogs.rejected_raw(_raw_lines(spark, sf_dir, topic), topic, _YEAR) for topic in TOPICS
    )


def raw_vs_json_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = {
        "auth": ("timestamp", "source_ip", "source_port", "username", "action"),
        "firewall": (
            "timestamp", "source_ip", "destination_ip", "source_port", "destination_port",
            "action", "bytes_sent", "country",
        ),
        "web": ("timestamp", "source_ip", "url", "http_method", "http_status", "bytes_sent"),
    }
    return union_all(
        rawlogs.raw_vs_json_consistency(
            views.raw_events(spark, sf_dir, topic), topic, _YEAR, compared[topic]
        )
        for topic in TOPICS
    )


def _messages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {topic: views.wire_messages(spark, sf_dir, topic, spread=True) for topic in TOPICS}


def _without_zone(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(replay(spark, _messages(spark, sf_dir), "alerts"), "timestamp")


def stream_alerts_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = replay(spark, _messages(spark, sf_dir), "alerts", distinct="approx")
    return _without_zone(alerts, "timestamp")


def stats_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.stats_violations(views.stats_candidates(spark, sf_dir))
    return contract.violation_counts(checked)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What parsing refuses of damaged messages, kept by the stream that archives the others."""
    messages = {topic: views.faulty_messages(spark, sf_dir, topic, spread=True) for topic in TOPICS}
    return replay(spark, messages, "quarantine")


def stream_traffic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = replay(spark, _messages(spark, sf_dir), "stats")
    return _without_zone(table, "window_start", "window_end")


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    trigger = {"processingTime": "0 seconds"}
    table = replay(spark, _messages(spark, sf_dir), "archive", trigger=trigger)
    return _without_zone(table, "timestamp").withColumn("date", F.col("date").cast("string"))


QUERIES: dict[str, Query] = {
    "detect_brute_force": _rule(rules.BRUTE_FORCE),
    "detect_port_scan": _rule(rules.PORT_SCAN),
    "detect_web_scan": _rule(rules.WEB_SCAN),
    "detect_exfiltration": _rule(rules.EXFILTRATION),
    "detect_lateral_movement": _rule(rules.LATERAL_MOVEMENT),
    "detect_port_scan_approx": _rule(rules.PORT_SCAN, "approx"),
    "detect_web_scan_approx": _rule(rules.WEB_SCAN, "approx"),
    "detect_lateral_movement_approx": _rule(rules.LATERAL_MOVEMENT, "approx"),
    "detect_web_scan_ratio": web_scan_ratio,
    "detect_lateral_internal": _rule(rules.LATERAL_INTERNAL),
    "detect_exfil_internal": _rule(rules.EXFIL_INTERNAL),
    "detect_bruteforce_success": _rule(rules.BRUTE_FORCE_SUCCESS),
    "detect_blacklist": blacklist,
    "alerts_all": alerts_all,
    "alerts_all_one_pass": alerts_all_one_pass,
    "traffic_stats": traffic_stats,
    "q_total_alerts": _on_alerts(reports.total_alerts),
    "q_critical_alerts": _on_alerts(reports.critical_alerts),
    "q_events_processed": _on_stats(reports.events_processed),
    "q_total_bytes": _on_stats(reports.total_bytes),
    "q_alerts_by_rule": _on_alerts(reports.alerts_by_rule),
    "q_alerts_by_severity": _on_alerts(reports.alerts_by_severity),
    "q_events_over_time": _on_stats(_ranged(reports.events_over_time)),
    "q_bytes_over_time": _on_stats(_ranged(reports.bytes_over_time)),
    "q_recent_alerts": _on_alerts(reports.recent_alerts),
    "q_alerts_by_rule_severity": _on_alerts(reports.alerts_by_rule_severity),
    "q_traffic_by_topic": _on_stats(reports.traffic_by_topic),
    "q_latest_alerts": _on_alerts(reports.latest_alerts),
    "q_top_sources": _on_alerts(reports.top_sources),
    "parse_auth": _parsed("auth"),
    "parse_firewall": _parsed("firewall"),
    "parse_web": _parsed("web"),
    "parse_rejects": parse_rejects,
    "archive_daily_counts": archive_daily_counts,
    "archive_scan": archive_scan,
    "alert_contract_violations": alert_contract_violations,
    "alert_contract_valid": alert_contract_valid,
    "stats_contract_violations": stats_contract_violations,
    "enrich_country": _on_addresses(enrich.enrich_country),
    "tag_blacklist": _on_addresses(enrich.tag_blacklist),
    "enrich_country_table": enrich_country_table,
    "tag_blacklist_table": tag_blacklist_table,
    "distinct_sketch_error": distinct_sketch_error,
    "classify_network": _on_addresses(enrich.classify_network),
    "tag_suspicious_port": _on_addresses(enrich.tag_suspicious_port),
    "parse_raw_sshd": _raw("auth"),
    "parse_raw_ufw": _raw("firewall"),
    "parse_raw_httpd": _raw("web"),
    "raw_rejects": raw_rejects,
    "raw_vs_json_consistency": raw_vs_json_consistency,
    "stream_alerts": stream_alerts,
    "stream_alerts_approx": stream_alerts_approx,
    "stream_traffic_stats": stream_traffic_stats,
    "stream_archive": stream_archive,
    "stream_quarantine": stream_quarantine,
}
