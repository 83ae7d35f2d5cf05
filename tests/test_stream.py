"""The same operators on streams: files of JSON lines, one micro-batch per file."""

import dataclasses
import json
import os

import pytest
from helpers import T0, at, event
from pyspark.errors import StreamingQueryException
from test_property import random_events

from logwarden.config import PipelineConfig
from logwarden.operators import rules
from logwarden.operators.detect import detect_all
from logwarden.operators.parse import parse_events
from logwarden.operators.stats import topic_stats
from logwarden.sinks.tables import parquet_table
from logwarden.sources.messages import file_messages, read_archive
from logwarden.streaming import pipeline

NOW = {"availableNow": True}
FLUSH = event(0, source_ip="0.0.0.0", action="flush") | {"timestamp": at(10**8)}


class Feed:
    """A folder of message files with rising modification times, and its queries."""

    def __init__(self, spark, folder):
        self.session = pipeline.streaming_session(spark)
        self.folder = str(folder)
        self.files = 0
        os.makedirs(f"{folder}/wire")
        self.config = PipelineConfig(
            checkpoint_root=f"{folder}/checkpoints",
            archive_root=f"{folder}/archive",
            distinct="exact",
        )

    def add(self, *events):
        self.files += 1
        path = f"{self.folder}/wire/part-{self.files:03d}.txt"
        with open(path, "w") as out:
            for e in events:
                out.write(json.dumps({**e, "timestamp": e["timestamp"].isoformat()}) + "\n")
        os.utime(path, (1_700_000_000 + self.files,) * 2)

    def events(self, topic):
        messages = file_messages(self.session, f"{self.folder}/wire", max_files_per_trigger=1)
        return pipeline.event_stream(messages, topic, self.config)

    def alerts(self, topic, chosen=rules.CORE_RULES, sink=None):
        sink = sink or parquet_table(f"{self.folder}/alerts")
        query = pipeline.start_alerts(
            self.events(topic), topic, self.config, sink, NOW, chosen
        )
        query.awaitTermination()
        return query

    def table(self, name="alerts"):
        return self.session.read.parquet(f"{self.folder}/{name}").drop("query", "batch_id")

    def as_table(self, topic):
        """All messages so far, parsed as a table in the same session."""
        return parse_events(self.session.read.text(f"{self.folder}/wire"), topic).where(
            "source_ip <> '0.0.0.0'"
        )


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rows(df):
    return sorted(map(tuple, df.where("source_ip <> '0.0.0.0'").collect()), key=repr)


def burst(n, second=1.0, **given):
    return [event(second, **given) for _ in range(n)]


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_stream_equals_table(feed, distinct):
    feed.config = dataclasses.replace(feed.config, distinct=distinct)
    events = sorted(random_events(7), key=lambda e: e["timestamp"])
    for first in range(0, len(events), 1000):
        feed.add(*events[first : first + 1000])
    feed.add(FLUSH)
    chosen = (*rules.CORE_RULES, *rules.VARIANT_RULES, rules.block_list_rule("auth"))
    for topic in ("auth", "firewall", "web"):
        feed.alerts(topic, chosen)
    topics = {topic: feed.as_table(topic) for topic in ("auth", "firewall", "web")}
    alerts = detect_all(topics, chosen, distinct)
    expected = rows(alerts)
    fired = {r.rule_triggered for r in alerts.select("rule_triggered").distinct().collect()}
    assert fired == {rule.name for rule in chosen}
    assert rows(feed.table()) == expected


def test_stats_and_archive_streams_equal_table(feed):
    feed.add(*burst(3), *burst(2, 90, source_ip="2.2.2.2"))
    feed.add(*burst(1, 100_000), FLUSH)
    sink = parquet_table(f"{feed.folder}/stats")
    stats = pipeline.start_stats(feed.events("auth"), "auth", feed.config, sink, NOW)
    archive = pipeline.start_archive(feed.events("auth"), "auth", feed.config, NOW)
    stats.awaitTermination()
    archive.awaitTermination()
    assert rows(feed.table("stats")) == rows(topic_stats(feed.as_table("auth"), "auth"))
    archived = read_archive(feed.session, feed.config.archive_root, "auth")
    assert rows(archived.drop("date")) == rows(feed.as_table("auth"))
    one_day = read_archive(
        feed.session, feed.config.archive_root, "auth", "2024-03-11", "2024-03-11"
    )
    assert one_day.count() == 1
    # A restart finds nothing new and writes nothing twice.
    pipeline.start_archive(feed.events("auth"), "auth", feed.config, NOW).awaitTermination()
    assert archived.count() == 7


def test_date_bounds_prune_folders(feed):
    feed.add(*burst(2), *burst(2, 100_000))
    pipeline.start_archive(feed.events("auth"), "auth", feed.config, NOW).awaitTermination()
    scan = read_archive(feed.session, feed.config.archive_root, "auth", "2024-03-11")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in filters


def test_late_events_are_dropped_once_their_windows_closed(feed):
    feed.add(*burst(6))
    feed.add(*burst(1, 600, source_ip="9.9.9.9"))
    feed.add(*burst(1, 601, source_ip="9.9.9.9"))
    feed.add(*burst(6, 2.0))
    feed.add(FLUSH)
    feed.alerts("auth", [rules.BRUTE_FORCE])
    # Six on-time failures are HIGH; with the six late ones it would have been CRIT.
    assert {(r.severity, r.source_ip) for r in feed.table().collect()} == {("HIGH", "1.2.3.4")}


def test_alert_does_not_wait_for_the_next_match(feed):
    feed.add(*burst(6))
    feed.add(*burst(1, 600, action="login_success"))
    query = feed.alerts("auth", [rules.BRUTE_FORCE])
    assert feed.table().count() == 2
    assert query.lastProgress["eventTime"]["watermark"].startswith("2024-03-10T02:39:30")


def test_restart_continues_from_the_checkpoint(feed):
    feed.add(*burst(4))
    feed.alerts("auth", [rules.BRUTE_FORCE])
    feed.add(*burst(4, 2.0))
    feed.add(FLUSH)
    feed.alerts("auth", [rules.BRUTE_FORCE])
    assert [r.severity for r in feed.table().collect()] == ["HIGH", "HIGH"]


def test_failing_sink_stops_the_query_and_loses_nothing(feed):
    def broken(batch, batch_id):
        if batch.count():
            raise RuntimeError("database gone")

    feed.add(*burst(6))
    feed.add(FLUSH)
    with pytest.raises(StreamingQueryException, match="database gone"):
        feed.alerts("auth", [rules.BRUTE_FORCE], broken)
    feed.alerts("auth", [rules.BRUTE_FORCE])
    assert feed.table().count() == 2


def test_replayed_batch_replaces_itself(spark, tmp_path):
    batch = spark.range(5).toDF("n")
    write = parquet_table(f"{tmp_path}/t")
    context = spark.sparkContext
    try:
        for query, batch_id in (("a", 0), ("a", 0), ("a", 1), ("b", 0)):
            context.setLocalProperty("sql.streaming.queryId", query)
            write(batch, batch_id)
        parquet_table(f"{tmp_path}/empty")(batch.limit(0), 0)
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 15
    assert not os.path.exists(f"{tmp_path}/empty")
    with pytest.raises(ValueError):
        write(batch, 2)


def test_rules_with_equal_windows_in_one_query_all_emit(feed):
    twins = [dataclasses.replace(rules.EXFILTRATION, name=name) for name in ("one", "two")]
    for second in (0, 400, 800):
        feed.add(*burst(2, second, action="allow", bytes_sent=60_000_000))
    feed.add(FLUSH)
    feed.alerts("firewall", twins)
    counts = feed.table().groupBy("rule_triggered").count().collect()
    assert {(r.rule_triggered, r["count"]) for r in counts} == {("one", 15), ("two", 15)}


def test_pipeline_shares_tables_and_an_idle_topic_holds_nothing_back(feed):
    feed.add(
        *burst(6),
        *[event(1, action="block", destination_port=p) for p in range(20)],
        FLUSH,
    )
    os.makedirs(f"{feed.folder}/idle")

    def run():
        queries = pipeline.start_pipeline(
            feed.session,
            feed.config,
            messages=lambda session, topic, config: file_messages(
                session, f"{feed.folder}/{'idle' if topic == 'web' else 'wire'}"
            ),
            trigger=NOW,
            alert_sink=parquet_table(f"{feed.folder}/alerts"),
            stats_sink=parquet_table(f"{feed.folder}/stats"),
        )
        for query in queries:
            query.awaitTermination()
        return queries

    # Rules and statistics read what ingest has committed; a second run finds all of it.
    run()
    assert len({q.name for q in run()}) == 3 + 3 + len(rules.CORE_RULES)
    counts = feed.table().groupBy("rule_triggered").count().collect()
    assert {(r.rule_triggered, r["count"]) for r in counts} == {("brute_force", 2), ("port_scan", 2)}
    assert [(r[0], r[2]) for r in rows(feed.table("stats"))] == [
        (T0, "auth"),
        (T0, "firewall"),
    ]
