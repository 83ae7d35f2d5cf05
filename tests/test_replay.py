"""Finite input replayed through the streaming pipeline."""

import json
import os

import pytest
from helpers import event
from pyspark.sql import functions as F

from logwarden.schemas import ALERT_COLUMNS, STATS_COLUMNS
from logwarden.sources import event_views
from logwarden.streaming.replay import STATE_MESSAGES, replay, run_slices, state_partitions


def messages(spark, *events):
    lines = [json.dumps({**e, "timestamp": e["timestamp"].isoformat()}) for e in events]
    return {"auth": spark.createDataFrame([(line,) for line in lines], "value string")}


def test_events_from_the_flush_address_stay(spark):
    given = messages(spark, *[event(1, source_ip="0.0.0.0")] * 11, event(2, source_ip="2.2.2.2"))
    stats = replay(spark, given, "stats").collect()
    assert {(r.source_ip, r.event_count) for r in stats} == {("0.0.0.0", 11), ("2.2.2.2", 1)}
    alerts = replay(spark, given, "alerts").collect()
    assert {(r.source_ip, r.rule_triggered) for r in alerts} == {("0.0.0.0", "brute_force")}
    archived = replay(spark, given, "archive").collect()
    assert sorted(r.source_ip for r in archived) == ["0.0.0.0"] * 11 + ["2.2.2.2"]


@pytest.mark.parametrize(("product", "columns"), [("alerts", ALERT_COLUMNS), ("stats", STATS_COLUMNS)])
def test_no_batch_gives_an_empty_table(spark, product, columns):
    # No alert, or no usable event at all.
    given = [event(1, action="login_success")] if product == "alerts" else [event(1, source_ip=None)]
    table = replay(spark, messages(spark, *given), product)
    assert table.columns == columns
    assert table.count() == 0


def test_state_partitions_follow_the_messages(spark):
    assert state_partitions(0) == 1
    assert [state_partitions(n * STATE_MESSAGES) for n in (1, 10, 100)] == [2, 11, 101]
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "7")
    done = run_slices(session, messages(spark, event(1), event(90)), stats=True, slices=2)
    state = f"{done.config.checkpoint_root}/stats_auth/state/0"
    assert sorted(name for name in os.listdir(state) if name.isdigit()) == ["0"]
    assert done.stats().count() == 2


def test_messages_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def make(value):
        made.add(1)
        return value

    given = {topic: rows.select(make("value").alias("value")) for topic, rows in messages(spark, *[event(1)] * 5).items()}
    assert replay(spark, given, "archive").count() == 5
    assert made.value == 5


def test_few_splits_of_events_are_dealt_out(spark, tmp_path, monkeypatch):
    rows = spark.range(100).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS user_id",
                                       "'error' AS event_type", "1.0D AS value", "'{\"k\": 1}' AS props")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(event_views, "SPREAD_ROWS", 10)
    plain = event_views.wire_messages(spark, str(tmp_path), "auth")
    spread = event_views.wire_messages(spark, str(tmp_path), "auth", spread=True)
    assert (plain.rdd.getNumPartitions(), spread.rdd.getNumPartitions()) == (1, 11)
    assert sorted(plain.collect()) == sorted(spread.collect())
