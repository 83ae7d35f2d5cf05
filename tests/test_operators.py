"""Lookups, contracts, raw lines, reports, statistics and settings on small tables."""

import datetime as dt

import pytest
from helpers import at, event, frame
from pyspark.sql import functions as F

from logwarden.config import DatabaseConfig, PipelineConfig
from logwarden.functions import ip
from logwarden.operators import contract, enrich, rawlogs, reports
from logwarden.operators.stats import traffic_stats
from logwarden.schemas import ALERT_DDL, STATS_DDL
from logwarden.sources.messages import kafka_options


def column_of(spark, values, expression):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(
        expression(F.col("v")).alias("r")
    )
    return [r.r for r in rows.collect()]


def test_ipv4_to_long(spark):
    values = ["0.0.0.0", "255.255.255.255", "10.0.0.1", "256.0.0.1", "01.2.3.4", "1.2.3", None, "",
              "1.2.3.4 ", "1.2.3.4\n", "a.b.c.d", "1.2.3.4.5"]
    assert column_of(spark, values, ip.ipv4_to_long) == [0, 2**32 - 1, 167772161] + [None] * 9


def test_networks_of_several_lengths(spark):
    values = ["10.9.9.9", "11.0.0.0", "192.168.1.128", "192.168.1.127", "7.7.7.7", "x", None]
    cidrs = ["10.0.0.0/8", "192.168.1.128/25", "7.7.7.7/32"]
    got = column_of(spark, values, lambda c: ip.in_networks(ip.ipv4_to_long(c), cidrs))
    assert got == [True, False, True, False, True, False, False]
    everywhere = column_of(
        spark, values[:1], lambda c: ip.in_networks(ip.ipv4_to_long(c), ["0.0.0.0/0"])
    )
    assert everywhere == [True]


def test_country_by_prefix(spark):
    values = ["13.33.0.1", "13.32.0.1", "1.1.1.1", "1.1.2.1", "8.8.9.9", "192.168.1.1", None]
    assert column_of(spark, values, ip.country_of) == [
        "UNKNOWN", "US", "AU", "UNKNOWN", "US", "INT", "UNKNOWN",
    ]


def test_network_class_and_ports(spark):
    rows = spark.createDataFrame(
        [("10.0.0.1", 23), ("192.168.1.9", 22), ("172.31.1.1", None), ("9.9.9.9", 31337), ("x", 0)],
        "source_ip string, destination_port int",
    )
    tagged = enrich.tag_suspicious_port(enrich.classify_network(rows)).collect()
    assert [r.network_class for r in tagged] == [
        "server", "employee", "private", "external", "invalid",
    ]
    assert [r.suspicious_port for r in tagged] == [True, False, False, True, False]


def test_contract_splits_rows(spark):
    good = (dt.datetime(2024, 1, 1), "1.1.1.1", None, 1, 2, None, "auth", "a", "TCP", 0, "DE",
            "LOW", "r", None)
    bad = (None, "1" * 46, None, 1, 2, None, "auth", "a", "TCP", 0, "DE", "WORST", "r", None)
    checked = contract.alert_violations(spark.createDataFrame([good, bad], ALERT_DDL))
    valid, broken = contract.split_valid(checked)
    assert [r.severity for r in valid.collect()] == ["LOW"]
    assert set(broken.first().violations.split(",")) == {
        "timestamp_missing", "source_ip_too_long", "severity_unknown",
    }
    stats = spark.createDataFrame([(None, None, None, None, None, 1, 1, 1)], STATS_DDL)
    counts = contract.violation_counts(contract.stats_violations(stats)).collect()
    assert {(r.violation, r.n) for r in counts} == {
        ("window_start_missing", 1), ("window_end_missing", 1), ("topic_missing", 1),
    }


RAW = {
    "auth": [
        "Jun 13 03:42:11 web1 sshd[12493]: Failed password for root from 185.220.101.45 port 54832 ssh2",
        "Jun 13 03:42:13 web1 sshd[1]: Accepted password for alice from 192.168.1.10 port 1 ssh2",
        "Jun  3 03:42:13 web1 sshd[1]: Invalid user ftp from 8.8.8.8 port 54832",
    ],
    "firewall": [
        "Jun 13 03:42:11 firewall01 kernel: [UFW BLOCK] IN=eth0 OUT= "
        "MAC=00:11:22:33:44:55:66:77:88:99:aa:bb:08:00 SRC=185.220.101.45 DST=10.0.0.1 LEN=60 "
        "TOS=0x00 PREC=0x00 TTL=49 ID=12345 PROTO=TCP SPT=54832 DPT=22 WINDOW=1024 RES=0x00 SYN",
        "Jun 13 03:42:11 firewall01 kernel: [UFW ALLOW] IN=eth0 OUT= SRC=1.1.1.1 DST=10.0.0.1 "
        "PROTO=UDP SPT=5 DPT=53",
    ],
    "web": [
        '185.220.101.45 - - [13/Jun/2026:03:42:11 +0000] "GET /a.html HTTP/1.1" 404 1234 "-" "x y"',
    ],
}


def test_raw_lines(spark):
    def read(topic):
        lines = spark.createDataFrame([(line,) for line in RAW[topic]], "line string")
        return rawlogs.parse_raw(lines, topic, 2026, True).collect()

    auth = read("auth")
    assert [r.action for r in auth] == ["login_fail", "login_success", "invalid_user"]
    assert [r.username for r in auth] == ["root", "alice", "ftp"]
    assert [r.country for r in auth] == ["DE", "INT", "US"]
    assert auth[2].timestamp == dt.datetime(2026, 6, 3, 3, 42, 13)
    block, allow = read("firewall")
    assert (block.action, block.bytes_sent, block.source_port, block.destination_port) == (
        "block", 60, 54832, 22,
    )
    assert (allow.action, allow.bytes_sent, allow.protocol, allow.destination_port) == (
        "allow", 0, "UDP", 53,
    )
    (web,) = read("web")
    assert (web.action, web.url, web.http_status, web.bytes_sent) == ("http_404", "/a.html", 404, 1234)
    assert web.timestamp == dt.datetime(2026, 6, 13, 3, 42, 11)


def test_raw_rejects_keep_every_other_line(spark):
    lines = [*RAW["auth"], "", None, "Feb 31 03:42:11 h sshd[1]: Invalid user a from 1.1.1.1 port 1",
             "Xyz 13 03:42:11 h sshd[1]: Invalid user a from 1.1.1.1 port 1", "tab\tline"]
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    assert rawlogs.parse_raw(table, "auth", 2026).count() == 3
    assert rawlogs.rejected_raw(table, "auth", 2026).count() == 5


def test_reports_on_empty_tables(spark):
    alerts, stats = (spark.createDataFrame([], ddl) for ddl in (ALERT_DDL, STATS_DDL))
    assert reports.total_alerts(alerts).first().value == 0
    assert reports.events_processed(stats).first().value is None
    assert reports.total_bytes(stats).first().value is None
    assert reports.alerts_by_rule(alerts).collect() == []


def test_report_order_and_missing_topics(spark):
    def alert(second, severity, rule):
        return (at(second), "1.1.1.1", None, 1, 2, None, "auth", "a", "TCP", 0, "DE", severity,
                rule, None)

    ddl = ALERT_DDL.replace("timestamp timestamp", "timestamp timestamp_ntz")
    rows = [alert(0, "CRIT", "b"), alert(1, "LOW", "a"), alert(1, "MED", "b"), alert(1, "HIGH", "c")]
    alerts = spark.createDataFrame(rows, ddl)
    order = [r.severity for r in reports.alerts_by_severity(alerts).collect()]
    assert order == ["LOW", "MED", "HIGH", "CRIT"]
    assert [r.rule_triggered for r in reports.alerts_by_rule(alerts).collect()] == ["b", "a", "c"]
    assert [r.rule_triggered for r in reports.recent_alerts(alerts, 2).collect()] == ["a", "b"]
    ddl = STATS_DDL.replace(" timestamp", " timestamp_ntz")
    stats = spark.createDataFrame([(at(0), at(60), "web", "1.1.1.1", "DE", 3, 0, 9)], ddl)
    (row,) = reports.events_over_time(stats).collect()
    assert (row.Auth, row.Firewall, row.Web) == (0, 0, 3)
    later = F.lit(str(at(1))).cast("timestamp_ntz")
    assert reports.bytes_over_time(stats, start=later).collect() == []
    assert reports.bytes_over_time(stats, *reports.last_hour()).collect() == []


def test_stats_failures_are_fail_actions_only(spark):
    actions = ("login_fail", "invalid_user", "block", "http_404", "login_success")
    events = frame(spark, [event(59.9, action=a, bytes_sent=2) for a in actions] + [event(60)])
    first, second = traffic_stats({"auth": events}).orderBy("window_start").collect()
    assert (first.event_count, first.fail_count, first.bytes_total) == (5, 1, 10)
    assert (first.window_start, first.window_end) == (at(0), at(60))
    assert (second.event_count, second.fail_count) == (1, 1)


def test_settings():
    config = PipelineConfig.from_env(
        {"KAFKA_TOPIC_WEB": "w", "SPARK_BATCH_INTERVAL": "3", "PARQUET_OUTPUT_PATH": "/p"}
    )
    assert (config.topics["web"], config.trigger_seconds, config.archive_root) == ("w", 3, "/p")
    assert kafka_options("web", config) == {
        "kafka.bootstrap.servers": "kafka:9092",
        "subscribe": "w",
        "startingOffsets": "latest",
    }
    unlimited = PipelineConfig.from_env({"MAX_OFFSETS_PER_TRIGGER": "none"})
    assert "maxOffsetsPerTrigger" not in kafka_options("auth", unlimited)


def test_missing_credentials_fail_fast():
    with pytest.raises(OSError, match="POSTGRES_PASSWORD"):
        DatabaseConfig.from_env({"POSTGRES_USER": "u", "POSTGRES_DB": "d"})
    given = {"POSTGRES_USER": "u", "POSTGRES_PASSWORD": "secret", "POSTGRES_DB": "d"}
    database = DatabaseConfig.from_env(given)
    assert database.url == "jdbc:postgresql://postgres:5432/d" and "secret" not in repr(database)
