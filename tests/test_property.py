"""Seeded random events against a plain Python window counter."""

import random
from collections import defaultdict

import pytest
from helpers import T0, event, frame

from logwarden.operators import rules
from logwarden.operators.detect import detect, detect_all

PREDICATES = {
    "brute_force": lambda e: e["action"] in ("login_fail", "invalid_user"),
    "port_scan": lambda e: e["action"] == "block",
    "web_scan": lambda e: e["action"] in ("http_404", "http_403", "http_500"),
    "data_exfiltration": lambda e: e["action"] == "allow",
    "lateral_movement": lambda e: e["source_ip"].startswith("10."),
}
MEASURES = {
    "brute_force": len,
    "port_scan": lambda es: len({e["destination_port"] for e in es}),
    "web_scan": lambda es: len({e["url"] for e in es}),
    "data_exfiltration": lambda es: sum(e["bytes_sent"] for e in es),
    "lateral_movement": lambda es: len({e["destination_ip"] for e in es}),
}


def random_events(seed):
    rng = random.Random(seed)
    actions = ["login_fail", "invalid_user", "login_success", "block", "allow"] + ["http_404"] * 3
    # One address has a third of all events.
    sources = ["10.0.0.1"] * 3 + [
        "10.0.0.2", "5.5.5.5", "6.6.6.6", "7.7.7.7", "8.8.8.8", "185.220.101.7",
    ]
    return [
        event(
            rng.choice([rng.uniform(-200, 200), rng.randrange(-5, 5) * 30]),
            action=rng.choice(actions),
            source_ip=rng.choice(sources),
            country=rng.choice(["DE", "DE", None]),
            destination_ip=f"10.0.0.{rng.randrange(12)}",
            destination_port=rng.randrange(25),
            url=f"/{rng.randrange(400)}",
            http_status=rng.choice([404, 404, 200]),
            bytes_sent=rng.randrange(5_000_000),
            raw=f"r{rng.randrange(1000)}",
        )
        for _ in range(3000)
    ]


def expected(rule, events):
    groups = defaultdict(list)
    for e in filter(PREDICATES[rule.name], events):
        offset = (e["timestamp"] - T0).total_seconds()
        start = offset // rule.slide_s * rule.slide_s
        while start > offset - rule.window_s:
            groups[start, e["source_ip"], e["country"]].append(e)
            start -= rule.slide_s
    found = set()
    for (start, ip, country), es in groups.items():
        measure = MEASURES[rule.name](es)
        passed = [label for limit, label in rule.tiers if measure > limit]
        if passed:
            found.add((start, ip, country, passed[-1], max(e["raw"] for e in es)))
    return found


@pytest.mark.parametrize("rule", rules.CORE_RULES, ids=lambda r: r.name)
@pytest.mark.parametrize("seed", [1, 2])
def test_rule_matches_plain_counting(spark, rule, seed):
    events = random_events(seed)
    rows = detect(frame(spark, events), rule, "exact").collect()
    got = {
        ((r.timestamp - T0).total_seconds(), r.source_ip, r.country, r.severity, r.raw)
        for r in rows
    }
    assert got and len(got) == len(rows)
    assert got == expected(rule, events)


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_in_one_pass_match_plain_counting(spark, seed):
    events = random_events(seed)
    # More than enough values for a sketch to count; all rules read all events.
    topics = dict.fromkeys(("auth", "firewall", "web"), frame(spark, events))
    rows = detect_all(topics, rules.CORE_RULES, "approx", one_pass=True).collect()
    got = {
        (r.rule_triggered, (r.timestamp - T0).total_seconds(), r.source_ip, r.country, r.severity, r.raw)
        for r in rows
    }
    want = {(rule.name, *row) for rule in rules.CORE_RULES for row in expected(rule, events)}
    assert len(got) == len(rows) and got == want
