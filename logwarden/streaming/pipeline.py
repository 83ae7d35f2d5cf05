"""Streaming queries in two steps: topics into the archive, and alerts and statistics from it.

A topic's messages are parsed by one query.  Rules and statistics read the archive's columnar
files, so a further rule costs a scan of the columns it needs, not another parse.  Each topic has its own queries.  One query over all topics would hold back every alert while a
single topic is idle, because a query's watermark is the minimum over its sources.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from logwarden.config import PipelineConfig
from logwarden.operators.contract import alert_violations, stats_violations
from logwarden.operators.detect import detect, detect_all
from logwarden.operators.parse import judged_messages, parse_events
from logwarden.operators.rules import CORE_RULES, Rule, rules_named
from logwarden.operators.stats import topic_stats
from logwarden.schemas import TOPICS, event_columns, wire_types
from logwarden.sinks.dated import judged, part_folder, part_stream, written_rows
from logwarden.sinks.tables import BatchWriter, archive_stream, guarded
from logwarden.sources.messages import kafka_messages
from logwarden.sources.shared import make_folder
from logwarden.streaming.progress import observe_read, observe_written

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Trigger = Mapping[str, object]


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the settings streams need.

    Exchange reuse is off: where two rules of one query share a shuffle, the branch that reuses
    it no longer receives the watermark, and its alerts would never be emitted.  State lives in
    RocksDB, outside the heap, so it may exceed executor memory.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.exchange.reuse", "false")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    # Naive event times are read as UTC, so no clock change can repeat or skip an hour.
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def event_stream(messages: DataFrame, topic: str, config: PipelineConfig) -> DataFrame:
    return parse_events(messages, topic).withWatermark("timestamp", config.watermark)


def _start(
    writer: DataStreamWriter, name: str, config: PipelineConfig, trigger: Trigger
) -> StreamingQuery:
    checkpoint = f"{config.checkpoint_root}/{name}"
    return writer.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_alerts(
    events: DataFrame,
    topic: str,
    config: PipelineConfig,
    sink: BatchWriter,
    trigger: Trigger,
    rules: Iterable[Rule] = CORE_RULES,
) -> StreamingQuery:
    own_rules = [rule for rule in rules if rule.topic == topic]
    alerts = detect_all({topic: events}, own_rules, config.distinct)
    writer = alerts.writeStream.outputMode("append").foreachBatch(sink)
    return _start(writer, f"alerts_{topic}", config, trigger)


def start_archive(
    events: DataFrame, topic: str, config: PipelineConfig, trigger: Trigger
) -> StreamingQuery:
    """An archive of parsed events alone, without what parsing refused."""
    writer = archive_stream(events, f"{config.archive_root}/{topic}")
    return _start(writer, f"archive_{topic}", config, trigger)


def start_stats(
    events: DataFrame, topic: str, config: PipelineConfig, sink: BatchWriter, trigger: Trigger
) -> StreamingQuery:
    writer = topic_stats(events, topic).writeStream.outputMode("append").foreachBatch(sink)
    return _start(writer, f"stats_{topic}", config, trigger)


def start_ingest(
    messages: DataFrame, topic: str, config: PipelineConfig, trigger: Trigger
) -> StreamingQuery:
    """Parses a topic once, into the archive: events by date, and what became none, with the reason.

    Both halves of a batch are committed together.  Everything else reads the archive.
    """
    judged_rows = judged_messages(messages, topic)
    refused = F.col("reason").isNotNull()
    rows = observe_written(judged(judged_rows, refused, "timestamp"))
    writer = part_stream(rows, f"{config.archive_root}/{topic}")
    return _start(writer, f"ingest_{topic}", config, trigger)


def archive_ddl(topic: str) -> str:
    """Columns of what `start_ingest` writes."""
    types = {**wire_types(topic), "timestamp": "timestamp", "reason": "string", "value": "string"}
    types |= {"accepted": "boolean", "date": "string"}
    return ", ".join(f"{name} {kind}" for name, kind in types.items())


def ingested_rows(session: SparkSession, topic: str, config: PipelineConfig) -> DataFrame:
    """The archive as a table: accepted rows, and refused ones with reason and text."""
    return written_rows(session, f"{config.archive_root}/{topic}", archive_ddl(topic))


def ingested_events(session: SparkSession, topic: str, config: PipelineConfig) -> DataFrame:
    """Stream of a topic's events from the archive, which `start_ingest` writes; with watermark."""
    folder = f"{config.archive_root}/{topic}"
    make_folder(session, folder)
    rows = session.readStream.schema(archive_ddl(topic)).parquet(folder).where("accepted")
    return rows.select(*event_columns(topic)).withWatermark("timestamp", config.watermark)


def start_rule(
    events: DataFrame,
    rule: Rule,
    config: PipelineConfig,
    trigger: Trigger,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    """One rule's alerts, with a checkpoint and a part of the alert table of its own.

    A rule added later starts with a new checkpoint and leaves those of the others untouched.
    """
    alerts = alert_violations(detect(events, rule, config.distinct))
    return _start_checked(alerts, "timestamp", f"alerts_{rule.topic}_{rule.name}", config, trigger, sink)


def start_topic_stats(
    events: DataFrame,
    topic: str,
    config: PipelineConfig,
    trigger: Trigger,
    sink: BatchWriter | None = None,
) -> StreamingQuery:
    stats = stats_violations(topic_stats(observe_read(events), topic))
    return _start_checked(stats, "window_start", f"stats_{topic}", config, trigger, sink, "event_count")


def _start_checked(
    checked: DataFrame, time: str, name: str, config: PipelineConfig, trigger: Trigger,
    sink: BatchWriter | None, events: str = "0",
) -> StreamingQuery:
    rows = judged(checked, F.col("violations") != "", time)
    table = config.alert_table if name.startswith("alerts_") else config.stats_table
    if sink is None:
        writer = part_stream(observe_written(rows, events), part_folder(table, name))
    else:
        checked_sink = guarded(sink, f"{table}/refused/{name}")
        writer = rows.writeStream.outputMode("append").foreachBatch(checked_sink)
    return _start(writer, name, config, trigger)


def start_pipeline(
    session: SparkSession,
    config: PipelineConfig,
    rules: Iterable[Rule] | None = None,
    messages: Callable[[SparkSession, str, PipelineConfig], DataFrame] = kafka_messages,
    trigger: Trigger | None = None,
    alert_sink: BatchWriter | None = None,
    stats_sink: BatchWriter | None = None,
) -> list[StreamingQuery]:
    """Starts every query of every topic; wait with `session.streams.awaitAnyTermination()`.

    `rules` are by default those that the settings name.  Without sinks, alerts and statistics go
    to dated tables; a sink gets the accepted rows only, refused ones stay in files.
    """
    trigger = trigger or {"processingTime": f"{config.trigger_seconds} seconds"}
    rules = list(rules_named(config.rules) if rules is None else rules)
    queries = []
    for topic in TOPICS:
        queries.append(start_ingest(messages(session, topic, config), topic, config, trigger))
        events = ingested_events(session, topic, config)
        queries.append(start_topic_stats(events, topic, config, trigger, stats_sink))
        queries += [
            start_rule(events, rule, config, trigger, alert_sink)
            for rule in rules
            if rule.topic == topic
        ]
    return queries
