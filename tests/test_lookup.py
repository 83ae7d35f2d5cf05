"""Networks from tables, and distinct counts that merge."""

import ipaddress
import random

import pytest
from helpers import at, event, frame
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from logwarden.operators import lookup, sketches
from logwarden.operators.rules import PORT_SCAN
from logwarden.operators.detect import detect

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cidrs(spark, rows):
    return spark.createDataFrame(rows, "cidr string, owner string")


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_longest_prefix_equals_trying_every_network(spark, threshold):
    rng = random.Random(3)
    networks = {}
    for _ in range(300):
        address = f"10.{rng.randrange(3)}.{rng.randrange(3)}.{rng.randrange(256)}"
        network = ipaddress.IPv4Network(f"{address}/{rng.choice([0, 8, 14, 16, 23, 24, 28, 31, 32])}", strict=False)
        networks.setdefault(network, []).append((f"{address}/{network.prefixlen}", f"o{rng.randrange(9)}"))
    # One address has a third of the rows.
    texts = [f"10.{rng.randrange(4)}.{rng.randrange(4)}.{rng.randrange(256)}" for _ in range(600)]
    texts += ["10.0.0.1"] * 300 + [None, "", "10.0.0", "10.0.0.256", "0.0.0.0", "255.255.255.255"]
    events = spark.createDataFrame([(t, 1) for t in texts], "source_ip string, length int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = [row for group in networks.values() for row in group]
        table = lookup.network_table(cidrs(spark, rows), F.col("owner"))
        got = [tuple(r) for r in lookup.longest_prefix(events, table, "source_ip", "owner").select("source_ip", "owner").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def owner(text):
        try:
            address = ipaddress.IPv4Address(text)
        except ValueError:
            return None
        held = [n for n in networks if address in n]
        return min(o for _, o in networks[max(held, key=lambda n: n.prefixlen)]) if held else None

    assert sorted(got, key=repr) == sorted(((t, owner(t)) for t in texts), key=repr)


def test_text_that_is_no_network_is_left_out(spark):
    rows = [(c, "x") for c in ("1.2.3.4", "1.2.3.0/33", "1.2.3/24", "a", "", "1.2.3.4/-1", "1.2.3.4/24/1", None, " 9.0.0.0/8 ")]
    got = {(r.length, r.base) for r in lookup.network_table(cidrs(spark, rows), F.col("owner")).collect()}
    assert got == {(32, 0x01020304), (8, 9 << 24)}
    empty = lookup.network_table(cidrs(spark, []))
    events = frame(spark, [event(0)])
    assert [r.blacklisted for r in lookup.tag_blacklist_from(events, empty).collect()] == [False]
    assert [r.country for r in lookup.enrich_country_from(events, empty).collect()] == ["UNKNOWN"]


@pytest.mark.parametrize("name", ["enrich_country_table", "tag_blacklist_table"])
def test_no_list_in_the_plan_and_no_forced_broadcast(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    listed = int(ipaddress.IPv4Address("185.220.101.0"))
    assert str(listed) not in plan and "185.220" not in plan


def test_merged_sketches_count_like_one(spark):
    events = [event(i % 600, source_ip=f"1.1.1.{i % 3}", destination_port=i % (100 if i % 3 else 5000)) for i in range(60_000)]
    panes = sketches.distinct_panes(frame(spark, events), ["source_ip"], "destination_port", 30)
    got = {r.source_ip: r for r in sketches.distinct_over(panes, ["source_ip"], 3600).groupBy("source_ip").agg(F.sum("events").alias("n"), F.max("distinct_values").alias("d")).collect()}
    exact = {f"1.1.1.{k}": len({e["destination_port"] for e in events if e["source_ip"] == f"1.1.1.{k}"}) for k in range(3)}
    assert sum(r.n for r in got.values()) == len(events)
    for ip, n in exact.items():
        assert abs(got[ip].d - n) <= (0 if n <= sketches.EXACT_UP_TO else n * sketches.RELATIVE_ERROR)
    assert max(exact.values()) > sketches.EXACT_UP_TO


def test_null_values_do_not_count(spark):
    events = frame(spark, [event(0, destination_port=None), event(1, destination_port=None)])
    panes = sketches.distinct_panes(events, ["source_ip"], "destination_port", 30)
    assert [(r.events, r.distinct_values) for r in sketches.distinct_over(panes, ["source_ip"], 60).collect()] == [(2, 0)]


def test_approximate_rule_reads_once_and_spreads_panes(spark, tmp_path):
    frame(spark, [event(i * 0.01, action="block", destination_port=i) for i in range(40)]).write.parquet(f"{tmp_path}/e")
    stored = spark.read.parquet(f"{tmp_path}/e")
    found = detect(stored, PORT_SCAN, "approx")
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert plan.index("Expand") < plan.rindex("Exchange hashpartitioning")
    assert {r.timestamp for r in found.collect()} == {at(-30), at(0)}
