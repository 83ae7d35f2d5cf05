"""The two-step pipeline: archive first, rules and statistics from it, tables that keep the contract."""

import dataclasses
import glob
import json
import os
import time

import pytest
from helpers import T0, event
from pyspark.sql import functions as F

from logwarden.config import PipelineConfig
from logwarden.operators import reports, rules
from logwarden.operators.detect import detect, detect_all
from logwarden.operators.parse import parse_events
from logwarden.operators.stats import topic_stats
from logwarden.schemas import ALERT_DDL, STATS_DDL
from logwarden.sinks import dated
from logwarden.sinks.tables import guarded, parquet_table
from logwarden.sources.messages import file_messages
from logwarden.streaming import pipeline, progress
from logwarden.streaming.replay import SLICES, run_slices
from test_stream import FLUSH, Feed, burst

NOW = {"availableNow": True}
DAY = 86_400


class Flow(Feed):
    """A feed whose queries run as the pipeline runs them."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.config = dataclasses.replace(self.config, tables_root=f"{folder}/tables")

    def lines(self, *texts):
        self.files += 1
        path = f"{self.folder}/wire/part-{self.files:03d}.txt"
        with open(path, "w") as out:
            out.write("\n".join(texts) + "\n")
        os.utime(path, (1_700_000_000 + self.files,) * 2)

    def ingest(self, topic="auth", **options):
        messages = file_messages(self.session, f"{self.folder}/wire", **options)
        query = pipeline.start_ingest(messages, topic, self.config, NOW)
        query.awaitTermination()
        return query

    def rule(self, rule, sink=None):
        self.ingest(rule.topic)
        events = pipeline.ingested_events(self.session, rule.topic, self.config)
        query = pipeline.start_rule(events, rule, self.config, NOW, sink)
        query.awaitTermination()
        return query

    def stats(self, topic="auth"):
        self.ingest(topic)
        events = pipeline.ingested_events(self.session, topic, self.config)
        query = pipeline.start_topic_stats(events, topic, self.config, NOW)
        query.awaitTermination()
        return query

    def alerts(self, **bounds):
        return dated.read_table(self.session, self.config.alert_table, ALERT_DDL, **bounds)

    def stats_table(self, **bounds):
        return dated.read_table(self.session, self.config.stats_table, STATS_DDL, **bounds)

    def checkpoint(self, name):
        return f"{self.config.checkpoint_root}/{name}"


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


@pytest.fixture
def log(flow):
    found = progress.ProgressLog()
    flow.session.streams.addListener(found)
    yield found
    flow.session.streams.removeListener(found)


def settled(log, session, done):
    """Progress arrives a moment after its batch."""
    for _ in range(100):
        table = log.table(session)
        if done(table):
            return table
        time.sleep(0.1)
    raise AssertionError("no progress")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once_and_rules_read_columns(flow):
    flow.add(*burst(11), FLUSH)
    ingest = flow.ingest()
    assert ingest._jsq.explainInternal(True).split("== Physical Plan ==")[1].count("from_json") == 1
    flow.rule(rules.BRUTE_FORCE)
    events = pipeline.ingested_events(flow.session, "auth", flow.config)
    plan = detect(events, rules.BRUTE_FORCE)._jdf.queryExecution().analyzed().toString()
    assert "from_json" not in plan and "FileSource" in plan
    assert flow.alerts().count() == 2


def test_one_batch_is_split_into_events_and_refused_lines(flow, log):
    good = json.dumps({"timestamp": T0.isoformat(), "source_ip": "1.1.1.1", "action": "x"})
    flow.lines(good, "oops", '{"timestamp": "2024-01-01"}', good)
    flow.ingest()
    archive = pipeline.ingested_rows(flow.session, "auth", flow.config)
    kept = archive.where("accepted").collect()
    assert [(r.source_ip, r.reason, r.value, r.destination_port) for r in kept] == [("1.1.1.1", None, None, 22)] * 2
    refused = {(r.reason, r.value) for r in archive.where("not accepted").collect()}
    assert refused == {("unreadable", "oops"), ("no_source_ip", '{"timestamp": "2024-01-01"}')}
    table = settled(log, flow.session, lambda t: t.count() == 1).first()
    assert (table.source_rows, table.rows_written, table.rows_refused) == (4, 2, 2)
    assert len(glob.glob(f"{flow.config.archive_root}/auth/_spark_metadata/0")) == 1


@pytest.mark.parametrize("own_sink", [False, True])
def test_an_over_long_name_does_not_stop_the_query(flow, own_sink):
    flow.add(*burst(6, username="u" * 101), *burst(6, source_ip="2.2.2.2", username="root"), FLUSH)
    sink = parquet_table(f"{flow.folder}/store") if own_sink else None
    query = flow.rule(rules.BRUTE_FORCE, sink)
    assert query.exception() is None
    if own_sink:
        kept = flow.table("store")
        refused = flow.session.read.parquet(f"{flow.config.alert_table}/refused/alerts_auth_brute_force")
    else:
        kept = flow.alerts()
        refused = dated.read_parts(flow.session, flow.config.alert_table, ALERT_DDL, accepted=False)
    assert {(r.source_ip, r.username) for r in kept.collect()} == {("2.2.2.2", "root")}
    assert {(r.source_ip, r.violations) for r in refused.collect()} == {("1.2.3.4", "username_too_long")}
    assert kept.count() == refused.count() == 2


def test_a_failing_sink_keeps_refused_rows_once(flow):
    def broken(batch, batch_id):
        if batch.count():
            raise RuntimeError("database gone")

    flow.add(*burst(6, username="u" * 101), *burst(6, source_ip="2.2.2.2"), FLUSH)
    with pytest.raises(Exception, match="database gone"):
        flow.rule(rules.BRUTE_FORCE, broken)
    flow.rule(rules.BRUTE_FORCE, parquet_table(f"{flow.folder}/store"))
    refused = flow.session.read.parquet(f"{flow.config.alert_table}/refused/alerts_auth_brute_force")
    assert refused.count() == flow.table("store").count() == 2


def test_a_batch_that_runs_again_adds_nothing(flow):
    flow.add(*burst(6), FLUSH)
    flow.rule(rules.BRUTE_FORCE)
    flow.stats()
    before = sorted(map(tuple, flow.alerts().collect()))
    assert len(before) == 2
    for name in ("ingest_auth", "alerts_auth_brute_force", "stats_auth"):
        # As if the driver had been lost after the write and before the batch was marked done.
        for mark in glob.glob(f"{flow.checkpoint(name)}/commits/[0-9]*"):
            if mark.endswith(("/0", "/1")):
                crc = os.path.join(os.path.dirname(mark), f".{os.path.basename(mark)}.crc")
                last = max(int(os.path.basename(m)) for m in glob.glob(f"{flow.checkpoint(name)}/commits/[0-9]*"))
                if int(os.path.basename(mark)) == last:
                    os.remove(mark)
                    if os.path.exists(crc):
                        os.remove(crc)
    flow.rule(rules.BRUTE_FORCE)
    flow.stats()
    assert sorted(map(tuple, flow.alerts().collect())) == before
    assert flow.stats_table().agg(F.sum("event_count")).first()[0] == 6
    assert pipeline.ingested_rows(flow.session, "auth", flow.config).count() == 7


def three_days(flow):
    for day in range(3):
        flow.add(*burst(6, day * DAY), *burst(7, day * DAY + 200, source_ip="3.3.3.3"))
        flow.rule(rules.BRUTE_FORCE)
        flow.stats()
    flow.add(FLUSH)
    flow.rule(rules.BRUTE_FORCE)
    flow.stats()


def test_reports_read_only_the_days_of_their_range(flow):
    three_days(flow)
    start, end = F.lit("2024-03-11 00:00:00").cast("timestamp"), F.lit("2024-03-11 23:59:59").cast("timestamp")
    stats, alerts = flow.stats_table(), flow.alerts()
    for found in (
        reports.events_over_time(stats, start, end),
        reports.bytes_over_time(stats, start, end),
        reports.recent_alerts(alerts, start=start, end=end),
    ):
        filters = plan_of(found).split("PartitionFilters: [")[1].split("],")[0]
        assert "date" in filters and "2024-03-11" in filters and "accepted" in filters
        assert len(found.inputFiles()) > 0
    got = reports.events_over_time(stats, start, end).collect()
    assert [(r.time.day, r.Auth) for r in got] == [(11, 6), (11, 7)]
    assert len(reports.recent_alerts(alerts, start=start, end=end).collect()) == 4
    assert len(reports.recent_alerts(alerts).collect()) == 12


def test_compaction_leaves_the_same_rows_in_fewer_files(flow):
    three_days(flow)
    path = flow.config.alert_table
    before = sorted(map(tuple, flow.alerts().collect()))
    for _ in range(2):
        dated.compact(flow.session, path, ALERT_DDL, "2024-03-12")
        assert dated.compacted_dates(flow.session, path) == ["2024-03-10", "2024-03-11"]
        assert sorted(map(tuple, flow.alerts().collect())) == before
        assert len(glob.glob(f"{path}/compacted/date=2024-03-10/*.parquet")) == 1
    one_day = flow.alerts(first_date="2024-03-11", last_date="2024-03-11")
    assert one_day.count() == 4
    # What streams add later is read beside the compacted days.
    assert flow.alerts(first_date="2024-03-12").count() == 4


def test_no_rows_yet(flow):
    assert flow.alerts().count() == 0 and flow.alerts().columns[-1] == "date"
    flow.lines("oops")
    flow.rule(rules.BRUTE_FORCE)
    flow.stats()
    assert flow.alerts().count() == flow.stats_table().count() == 0


def test_late_events_are_counted_exactly(flow, log):
    batches = [
        burst(6), burst(1, 600, source_ip="9.9.9.9"), burst(1, 601, source_ip="9.9.9.9"),
        # Six late events of one group, three of two others, and four on time.
        [*burst(6, 2.0), *burst(2, 3.0, source_ip="5.5.5.5"), *burst(1, 65.0), *burst(4, 603.0)],
    ]
    for batch in batches:
        flow.add(*batch)
        flow.stats()
    read = sum(map(len, batches))
    table = settled(log, flow.session, lambda t: t.where("query = 'stats_auth'").agg(F.sum("rows_read")).first()[0] == read)
    log.flush(flow.session, f"{flow.folder}/progress")
    assert log.table(flow.session).count() == 0
    kept = flow.session.read.parquet(f"{flow.folder}/progress")
    assert progress.late_events(flow.session, kept, "stats_auth", flow.checkpoint("stats_auth")) == 9
    sums = {r.query: r for r in progress.totals(kept).collect()}
    assert (sums["stats_auth"].rows_read, sums["stats_auth"].events_written, sums["stats_auth"].rows_written) == (read, 6, 1)
    # The state's own count is of groups, not of events.
    assert sums["stats_auth"].groups_dropped_late == 3
    assert sums["ingest_auth"].rows_written == read and table.count() > 4


def test_rules_are_an_argument_and_one_added_later_keeps_the_others_state(flow):
    names = ("web_scan_ratio", "lateral_internal", "exfil_internal", "brute_force_success", "blacklist")
    chosen = rules.rules_named(names)

    def run(given):
        config = dataclasses.replace(flow.config, rules=given)
        for _ in range(2):  # the second run reads what the first has ingested
            queries = pipeline.start_pipeline(
                flow.session, config, trigger=NOW,
                messages=lambda session, topic, _: file_messages(session, f"{flow.folder}/wire"),
            )
            for query in queries:
                query.awaitTermination()
        return queries

    listed = "185.220.101.9"
    flow.add(*burst(6, source_ip=listed), *burst(1, 1, action="allow", source_ip="10.0.0.1", bytes_sent=60_000_000))
    assert len(run(names)) == 6 + len(chosen)
    flow.add(
        *burst(5, 2, source_ip=listed),
        *burst(1, 3, source_ip=listed, action="login_success", username="root"),
        *burst(1, 4, action="allow", source_ip="10.0.0.1", bytes_sent=60_000_000),
        *[event(5, action="x", source_ip="10.0.0.1", destination_ip=f"10.0.0.{i}") for i in range(30)],
        *[event(5, action="http_404", url=f"/{i}", http_status=404) for i in range(30)],
        FLUSH,
    )
    run((*names, "port_scan", "brute_force"))
    fired = {(r.rule_triggered, r.topic) for r in flow.alerts().select("rule_triggered", "topic").distinct().collect()}
    assert fired == {
        ("web_scan_ratio", "web"), ("lateral_internal", "firewall"), ("exfil_internal", "firewall"),
        ("brute_force_success", "auth"), ("blacklist", "auth"), ("blacklist", "firewall"), ("blacklist", "web"),
        ("brute_force", "auth"),
    }
    tables = {topic: parse_events(flow.session.read.text(f"{flow.folder}/wire"), topic) for topic in ("auth", "firewall", "web")}
    expected = detect_all(tables, [*chosen, rules.BRUTE_FORCE], "exact").where("source_ip <> '0.0.0.0'")
    assert sorted(map(repr, flow.alerts().drop("date").collect())) == sorted(map(repr, expected.collect()))


def test_unknown_rules_are_named():
    with pytest.raises(ValueError, match="nonsense"):
        rules.rules_named(["brute_force", "nonsense"])
    config = PipelineConfig.from_env({"RULES": "brute_force,blacklist"})
    assert [r.topic for r in rules.rules_named(config.rules)] == ["auth", "auth", "firewall", "web"]


@pytest.mark.parametrize("trigger", [NOW, {"processingTime": "0 seconds"}], ids=["now", "timed"])
def test_state_lives_through_slices_and_restarts(spark, trigger):
    # Failures come evenly over ten minutes, so windows reach over every border of slices.
    events = [event(3 * i, raw=f"r{i}") for i in range(200)] + [event(601, action="login_success")]
    lines = [(json.dumps({**e, "timestamp": e["timestamp"].isoformat()}),) for e in events]
    messages = {"auth": spark.createDataFrame(lines, "value string")}
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    chosen = (rules.BRUTE_FORCE, rules.BRUTE_FORCE_SUCCESS)
    done = run_slices(spark, messages, chosen, stats=True, trigger=trigger)
    table = parse_events(messages["auth"], "auth", zone_free=True)
    for got, want, time_column in (
        (done.alerts(), detect_all({"auth": table}, chosen, "exact"), "timestamp"),
        (done.stats().drop("window_end"), topic_stats(table, "auth").drop("window_end"), "window_start"),
    ):
        got = got.withColumn(time_column, F.col(time_column).cast("timestamp_ntz"))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert done.runs == SLICES == 5
    commits = glob.glob(f"{done.config.checkpoint_root}/alerts_auth_brute_force/commits/[0-9]*")
    assert len(commits) >= SLICES


def test_times_with_an_offset_are_one_instant_on_tables_and_streams(spark, flow):
    texts = ["2024-03-10T02:30:00", "2024-03-10T02:30:00Z", "2024-03-10T04:30:00+02:00", "2024-03-09 21:00:00.5-0530"]
    lines = [json.dumps({"timestamp": t, "source_ip": "1.1.1.1", "action": t}) for t in texts]
    flow.lines(*lines)
    flow.ingest()
    streamed = pipeline.ingested_rows(flow.session, "auth", flow.config).where("accepted")
    # The table is parsed in a session whose zone has clock changes.
    messages = spark.createDataFrame([(line,) for line in lines], "value string")
    table = parse_events(messages, "auth", zone_free=True)
    times = {r.action: r.timestamp for r in streamed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).collect()}
    assert times == {r.action: r.timestamp for r in table.collect()}
    assert [times[t] for t in texts[:3]] == [T0] * 3 and times[texts[3]].microsecond == 500_000
