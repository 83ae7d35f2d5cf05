"""Run a finite set of messages through the streaming pipeline and read the tables back.

Messages arrive in slices of time.  Every slice is a run of the queries that ends when it is
worked off; the next run restarts them from their checkpoints.  So state, watermarks and sinks are
carried over several batches and restarts, as in a pipeline that runs for long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logwarden.config import PipelineConfig
from logwarden.operators.rules import CORE_RULES, Rule
from logwarden.schemas import ALERT_DDL, STATS_DDL, event_columns
from logwarden.sinks.dated import read_parts, read_table
from logwarden.sources.messages import file_messages
from logwarden.sources.shared import make_folder, shared_folder
from logwarden.streaming.pipeline import (
    Trigger,
    ingested_events,
    ingested_rows,
    start_ingest,
    start_rule,
    start_topic_stats,
    streaming_session,
)

SLICES = 5
#: Messages of a topic, over all slices, for each partition of the state.  Every partition of every batch opens, commits
#: and uploads a store of its own, which costs far more than the few groups that a small input would leave in it.
STATE_MESSAGES = 500_000

# One event far in the future moves the watermark past every real window, which closes them.  Its
# own windows never close, so it reaches the archive only, where its time tells it from real events.
_FLUSH_IP = "0.0.0.0"
_FLUSH_TIME = "9000-01-01T00:00:00"


def flush_message(topic: str) -> Column:
    given = {
        "timestamp": F.lit(_FLUSH_TIME),
        "source_ip": F.lit(_FLUSH_IP),
        "action": F.lit("flush"),
    }
    fields = [given[name].alias(name) for name in event_columns(topic) if name in given]
    return F.to_json(F.struct(*fields))


def _timed(messages_by_topic: Mapping[str, DataFrame]) -> DataFrame:
    """`topic`, `value` and `at`, the time in whole microseconds (no rounding may put an event into an
    earlier slice than its predecessor), null where a line has no readable time."""
    time = F.get_json_object("value", "$.timestamp").try_cast("timestamp")
    return _all(
        messages.select(F.lit(topic).alias("topic"), "value", F.unix_micros(time).alias("at"))
        for topic, messages in messages_by_topic.items()
    )


def _sliced(timed: DataFrame, topics: Iterable[str], n: int) -> tuple[DataFrame, int]:
    """`topic`, `value` and `slice`, 0 to n-1 in order of time; lines without a readable time come first.

    Every topic's flush message is in the last slice.  Also the number of messages of the largest topic.
    """
    by_topic = timed.groupBy("topic").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))
    first, last, most = by_topic.agg(F.min("first"), F.max("last"), F.max("n")).first()
    if first is None:
        first = last = 0
    width = (last - first) // n + 1
    place = F.coalesce(F.expr(f"int((at - {first}L) div {width}L)"), F.lit(0))
    ends = _all(
        timed.sparkSession.range(1).select(
            F.lit(topic).alias("topic"), flush_message(topic).alias("value"), F.lit(n - 1).alias("slice")
        )
        for topic in topics
    )
    return timed.select("topic", "value", place.alias("slice")).unionByName(ends), most or 0


def state_partitions(messages: int) -> int:
    """Partitions of the state of queries over so many messages; they grow with the input, without a bound."""
    return messages // STATE_MESSAGES + 1


@dataclass(frozen=True)
class Replayed:
    """Where a replay left its tables, and how many times its queries were started."""

    session: SparkSession
    config: PipelineConfig
    topics: tuple[str, ...]
    runs: int

    def alerts(self) -> DataFrame:
        return read_table(self.session, self.config.alert_table, ALERT_DDL).drop("date")

    def refused_alerts(self) -> DataFrame:
        return read_parts(self.session, self.config.alert_table, ALERT_DDL, accepted=False)

    def stats(self) -> DataFrame:
        return read_table(self.session, self.config.stats_table, STATS_DDL).drop("date")

    def _archive(self, topic: str) -> DataFrame:
        return ingested_rows(self.session, topic, self.config)

    def archive(self) -> DataFrame:
        flush_time = F.lit(f"{_FLUSH_TIME}Z").cast("timestamp")
        return _all(
            self._archive(topic)
            .where(F.col("accepted") & (F.col("timestamp") != flush_time))
            .select("timestamp", "topic", "source_ip", "date")
            for topic in self.topics
        )

    def quarantine(self) -> DataFrame:
        return _all(
            self._archive(topic).where("not accepted").select(
                F.lit(topic).alias("topic"), "reason", "value"
            )
            for topic in self.topics
        )


def _all(frames: Iterable[DataFrame]) -> DataFrame:
    result = None
    for frame in frames:
        result = frame if result is None else result.unionByName(frame)
    return result


def _finish(queries: list[StreamingQuery], trigger: Trigger) -> None:
    """Waits until the queries have worked off what has come; those that would run on are stopped."""
    for query in queries:
        if "processingTime" in trigger:
            query.processAllAvailable()
            query.stop()
        query.awaitTermination()


def run_slices(
    spark: SparkSession,
    messages_by_topic: Mapping[str, DataFrame],
    rules: Iterable[Rule] = (),
    stats: bool = False,
    distinct: str = "exact",
    slices: int = SLICES,
    trigger: Trigger | None = None,
) -> Replayed:
    """Streams the messages slice by slice through ingest, the rules and, if wanted, statistics."""
    folder = shared_folder(spark, "replay")
    session = streaming_session(spark)
    trigger = trigger or {"availableNow": True}
    topics = tuple(messages_by_topic)
    config = PipelineConfig(
        checkpoint_root=f"{folder}/checkpoints",
        archive_root=f"{folder}/archive",
        tables_root=f"{folder}/tables",
        distinct=distinct,
    )
    # Written once, as messages may be costly to make, and read slice by slice.
    _timed(messages_by_topic).write.parquet(f"{folder}/waiting")
    waiting, most = _sliced(spark.read.parquet(f"{folder}/waiting"), topics, slices)
    # A checkpoint keeps the number with which its query was first started.
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions(most)))
    wires = {topic: f"{folder}/wire/topic={topic}" for topic in topics}
    for wire in wires.values():
        make_folder(session, wire)
    for k in range(slices):
        now = waiting.where(F.col("slice") == k).select("topic", "value")
        arrived = now.write.mode("append").option("compression", "gzip").partitionBy("topic")
        arrived.text(f"{folder}/wire")
        arriving = {topic: file_messages(session, wire) for topic, wire in wires.items()}
        _finish([start_ingest(arriving[t], t, config, trigger) for t in topics], trigger)
        queries = []
        for topic in topics:
            events = ingested_events(session, topic, config)
            if stats:
                queries.append(start_topic_stats(events, topic, config, trigger))
            queries += [start_rule(events, r, config, trigger) for r in rules if r.topic == topic]
        _finish(queries, trigger)
    return Replayed(session, config, topics, slices)


_PRODUCTS: dict[str, Callable[[Replayed], DataFrame]] = {
    "alerts": Replayed.alerts,
    "stats": Replayed.stats,
    "archive": Replayed.archive,
    "quarantine": Replayed.quarantine,
}


def replay(
    spark: SparkSession,
    messages_by_topic: Mapping[str, DataFrame],
    product: str,
    distinct: str = "exact",
    trigger: Trigger | None = None,
) -> DataFrame:
    """Streams the messages and returns a product: alerts, stats, archive or quarantine."""
    rules = CORE_RULES if product == "alerts" else ()
    done = run_slices(
        spark, messages_by_topic, rules, product == "stats", distinct, trigger=trigger
    )
    return _PRODUCTS[product](done)
