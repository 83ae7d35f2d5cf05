"""Plans that must hold at any size, read from what Spark would execute."""

import pytest

from catalog.queries import QUERIES
from logwarden.operators import rules
from logwarden.operators.detect import detect, detect_all
from logwarden.operators.stats import topic_stats

SF = "/root/testdata/sf0.001"
TABLE_QUERIES = sorted(
    name for name in QUERIES if not name.startswith(("stream_", "archive_"))
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_python_rows_no_cross_joins_no_collected_groups(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    if name == "detect_bruteforce_success":
        # Only the seconds of one window are collected, after each second became one row.
        below = plan.rsplit("partial_collect_list(struct(at", 1)[1]
        assert "Exchange hashpartitioning(window" in below and "HashAggregate(keys=[window" in below
        plan = plan.replace("collect_list(struct(at", "")
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPART",
                 "collect_list", "collect_set", "Window ["):
        assert node not in plan


@pytest.fixture
def stored(spark, tmp_path):
    events = QUERIES["parse_firewall"](spark, SF)
    events.write.parquet(f"{tmp_path}/events")
    return spark.read.parquet(f"{tmp_path}/events")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def scans(plan):
    return [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]


def test_distinct_rule_counts_on_narrow_columns_and_joins_in_place(stored, no_broadcast):
    plan = plan_of(detect(stored, rules.PORT_SCAN, "exact"))
    narrow, wide = sorted(scans(plan), key=len)
    assert "raw" not in narrow and "destination_ip" not in narrow
    assert "raw" in wide and "username" not in wide
    join, below = plan.split("SortMergeJoin")[0], plan.split("SortMergeJoin")[1]
    assert "Exchange" not in join
    # Two exchanges for the exact count, two for panes and windows, none for the join itself.
    assert below.count("Exchange hashpartitioning") == 4
    assert "EqualTo(action,block)" in plan


def test_sum_rule_spreads_panes_not_events(stored):
    plan = plan_of(detect(stored, rules.EXFILTRATION))
    assert len(scans(plan)) == 1
    # Read upwards: the scan is reduced and exchanged before anything is multiplied.
    assert plan.index("Expand") < plan.rindex("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "EqualTo(action,allow)" in plan


def test_statistics_need_one_exchange_and_no_sort(stored):
    plan = plan_of(topic_stats(stored, "firewall"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Sort" not in plan
    assert "raw" not in scans(plan)[0]


def test_one_pass_reads_each_topic_once(spark, tmp_path):
    topics = {}
    for topic in ("auth", "firewall", "web"):
        QUERIES[f"parse_{topic}"](spark, SF).write.parquet(f"{tmp_path}/{topic}")
        topics[topic] = spark.read.parquet(f"{tmp_path}/{topic}")
    plan = plan_of(detect_all(topics, one_pass=True))
    assert len(scans(plan)) == 3
    # Below the first exchange of a topic nothing is multiplied.
    assert "Expand" not in plan.split("FileScan")[1] and "Join" not in plan
    apart = detect_all(topics)
    assert sorted(map(repr, detect_all(topics, one_pass=True).collect())) == sorted(map(repr, apart.collect()))
