import json

import pytest

from logwarden.operators.parse import parse_events, rejected_events

GOOD = {
    "raw": "x",
    "timestamp": "2024-01-01T00:00:00.123456",
    "source_ip": "1.1.1.1",
    "action": "login_fail",
    "source_port": 5,
    "destination_port": 6,
    "bytes_sent": 7,
    "country": "DE",
    "unknown_field": 1,
}


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def one(spark, topic="auth", **changes):
    record = {k: v for k, v in {**GOOD, **changes}.items() if v != "drop"}
    rows = parse_events(messages(spark, json.dumps(record)), topic, True).collect()
    return rows[0] if rows else None


def test_good_record_and_binary_value(spark):
    row = one(spark)
    assert row.source_port == 5 and row.timestamp.microsecond == 123456
    binary = messages(spark, json.dumps(GOOD)).selectExpr("cast(value as binary) as value")
    assert parse_events(binary, "auth", True).collect() == [row]


@pytest.mark.parametrize(
    "topic, ports", [("auth", (0, 22)), ("firewall", (0, 0)), ("web", (None, None))]
)
def test_defaults(spark, topic, ports):
    gone = dict.fromkeys(("source_port", "destination_port", "bytes_sent", "country"), "drop")
    row = one(spark, topic, **gone)
    assert (row.source_port, row.destination_port) == ports
    assert row.bytes_sent == 0 and row.country == "UNKNOWN"
    if topic == "web":
        assert row.http_status == 0 and row.url is None


@pytest.mark.parametrize("value", ["22", 1.5, 10**30])
def test_unreadable_number_loses_the_field_only(spark, value):
    assert one(spark, bytes_sent=value).bytes_sent == 0


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"source_ip": None}, "no_source_ip"),
        ({"action": "drop"}, "no_action"),
        ({"timestamp": "yesterday"}, "no_timestamp"),
        ({"timestamp": None}, "no_timestamp"),
    ],
)
def test_record_without_required_field(spark, changes, reason):
    assert one(spark, **changes) is None
    record = {k: v for k, v in {**GOOD, **changes}.items() if v != "drop"}
    rejects = rejected_events(messages(spark, json.dumps(record)), "auth").collect()
    assert [(r.topic, r.reason) for r in rejects] == [("auth", reason)]


def test_unreadable_text_is_rejected_and_nothing_is_lost(spark):
    lines = ["oops", json.dumps(GOOD)[:30], None, "", "[1, 2]", json.dumps(GOOD)]
    table = messages(spark, *lines)
    rejects = rejected_events(table, "auth").collect()
    assert len(rejects) + parse_events(table, "auth").count() == len(lines)
    assert all(r.reason in ("unreadable", "no_source_ip", "no_action") for r in rejects)


def test_each_message_is_parsed_once(spark):
    plan = parse_events(messages(spark, "x"), "auth")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_json") == 1
