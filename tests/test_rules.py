import pytest
from helpers import at, event, frame

from logwarden.operators import rules
from logwarden.operators.detect import detect, detect_all
from logwarden.schemas import ALERT_COLUMNS


def alerts(spark, rule, events, distinct="exact"):
    result = detect(frame(spark, events), rule, distinct)
    assert result.columns == ALERT_COLUMNS
    return result.orderBy("timestamp", "source_ip", "country").collect()


@pytest.mark.parametrize(
    "n, severity", [(5, None), (6, "HIGH"), (10, "HIGH"), (11, "CRIT")]
)
def test_brute_force_tiers(spark, n, severity):
    found = alerts(spark, rules.BRUTE_FORCE, [event(i * 0.1, username=f"u{i}") for i in range(n)])
    # Every event lies in two overlapping windows, the first of which begins before it.
    assert [r.severity for r in found] == ([severity] * 2 if severity else [])
    if found:
        assert [r.timestamp for r in found] == [at(-30), at(0)]
        assert found[0].rule_triggered == "brute_force" and found[0].bytes_sent == 0


def test_event_on_a_window_edge_counts_in_the_window_that_starts_there(spark):
    events = [event(0) for _ in range(5)] + [event(30)]
    assert [r.timestamp for r in alerts(spark, rules.BRUTE_FORCE, events)] == [at(0)]


def test_one_address_with_two_countries_is_two_groups(spark):
    events = [event(1, country=c) for c in ("DE", "NL") for _ in range(5)]
    assert alerts(spark, rules.BRUTE_FORCE, events) == []
    events += [event(1, country="NL")]
    assert {r.country for r in alerts(spark, rules.BRUTE_FORCE, events)} == {"NL"}


def test_carried_columns_are_independent_text_maxima(spark):
    events = [event(1, destination_ip=f"10.0.0.{i}", source_port=100 - i) for i in range(1, 12)]
    found = alerts(spark, rules.BRUTE_FORCE, events)
    assert {(r.destination_ip, r.source_port) for r in found} == {("10.0.0.9", 99)}


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_port_scan_counts_ports_of_plain_blocks(spark, distinct):
    def blocked(n, action="block"):
        return [event(1, action=action, destination_port=p) for p in range(n) for _ in range(3)]

    assert alerts(spark, rules.PORT_SCAN, blocked(9), distinct) == []
    assert alerts(spark, rules.PORT_SCAN, blocked(40, "block_suspicious_port"), distinct) == []
    found = alerts(spark, rules.PORT_SCAN, blocked(40), distinct)
    assert {(r.severity, r.destination_port, r.username) for r in found} == {("HIGH", 0, None)}


@pytest.mark.parametrize("n, count", [(10, 0), (11, 2)])
def test_port_scan_exact_threshold(spark, n, count):
    events = [event(1, action="block", destination_port=p) for p in range(n)]
    assert len(alerts(spark, rules.PORT_SCAN, events)) == count


def test_group_without_country_keeps_its_alert(spark):
    events = [event(1, action="block", destination_port=p, country=None) for p in range(11)]
    assert [r.country for r in alerts(spark, rules.PORT_SCAN, events)] == [None, None]


@pytest.mark.parametrize("n, severity", [(20, None), (21, "MED"), (50, "MED"), (51, "HIGH")])
def test_web_scan_tiers(spark, n, severity):
    events = [
        event(1, action=("http_404", "http_403", "http_500")[i % 3], url=f"/{i}") for i in range(n)
    ]
    events += [event(1, action="http_200", url=f"/ok{i}") for i in range(60)]
    found = alerts(spark, rules.WEB_SCAN, events)
    assert [r.severity for r in found] == ([severity] * 2 if severity else [])
    assert all(r.destination_port == 80 for r in found)


def test_web_scan_ratio_needs_a_majority_of_404(spark):
    def requests(missing, other):
        return [event(1, action="x", url=f"/{i}", http_status=404) for i in range(missing)] + [
            event(1, action="x", url=f"/o{i}", http_status=403) for i in range(other)
        ]

    assert alerts(spark, rules.WEB_SCAN_RATIO, requests(15, 15)) == []
    assert len(alerts(spark, rules.WEB_SCAN_RATIO, requests(16, 15))) == 2


@pytest.mark.parametrize("extra, count", [(0, 0), (1, 5)])
def test_exfiltration_sum_is_strict_and_reported(spark, extra, count):
    events = [event(61 * i, action="allow", bytes_sent=50_000_000) for i in (0, 0)]
    events += [event(0, action="allow", bytes_sent=extra), event(0, bytes_sent=10**9)]
    found = alerts(spark, rules.EXFILTRATION, events)
    assert len(found) == count
    assert all(r.bytes_sent == 100_000_000 + extra and r.severity == "CRIT" for r in found)


@pytest.mark.parametrize(
    "source, private",
    [
        ("172.15.0.1", False),
        ("172.16.0.1", True),
        ("172.31.0.1", True),
        ("172.32.0.1", False),
        ("192.168.9.9", True),
        ("192.169.0.1", False),
        ("10.1.1.1", True),
        ("100.1.1.1", False),
    ],
)
def test_lateral_movement_sources(spark, source, private):
    events = [
        event(1, action="allow", source_ip=source, destination_ip=f"10.0.0.{i}") for i in range(6)
    ]
    assert len(alerts(spark, rules.LATERAL_MOVEMENT, events)) == (4 if private else 0)


def test_lateral_movement_needs_six_targets(spark):
    events = [event(1, source_ip="10.1.1.1", destination_ip=f"8.0.0.{i}") for i in range(5)]
    assert alerts(spark, rules.LATERAL_MOVEMENT, events) == []
    events.append(event(1, source_ip="10.1.1.1", destination_ip="8.0.0.5"))
    assert len(alerts(spark, rules.LATERAL_MOVEMENT, events)) == 4
    # The stricter variant counts private targets only.
    assert alerts(spark, rules.LATERAL_INTERNAL, events) == []


def test_exfil_internal_ignores_outside_sources(spark):
    events = [event(1, action="allow", bytes_sent=200_000_000)]
    assert alerts(spark, rules.EXFIL_INTERNAL, events) == []
    events = [event(1, action="allow", bytes_sent=200_000_000, source_ip="10.0.0.7")]
    assert len(alerts(spark, rules.EXFIL_INTERNAL, events)) == 5


def success(second, **given):
    return event(second, action="login_success", username="root", **given)


def test_success_must_follow_more_than_ten_failures(spark):
    def fired(*events):
        return alerts(spark, rules.BRUTE_FORCE_SUCCESS, list(events))

    failures = [event(i * 0.1) for i in range(11)]
    found = fired(*failures, success(2))
    assert {(r.severity, r.username, r.action) for r in found} == {
        ("CRIT", "root", "login_success")
    }
    assert fired(*failures) == []
    assert fired(*failures[1:], success(2)) == []
    assert fired(*failures, success(-0.5)) == []
    assert fired(*failures, success(2, source_ip="4.4.4.4")) == []
    # One failure, a success, then ten more failures: not after more than ten.
    assert fired(event(0), success(3), *[event(5 + i) for i in range(10)]) == []


@pytest.mark.parametrize("extra", [[event(4)], [event(4 + i) for i in range(20)]])
def test_success_between_failures_counts(spark, extra):
    events = [event(i * 0.1) for i in range(11)] + [success(3)] + extra
    assert len(alerts(spark, rules.BRUTE_FORCE_SUCCESS, events)) == 2


@pytest.mark.parametrize(("second", "starts"), [(59, [-30, 0]), (89, [-30, 0]), (90, [0]), (119.9, [0]), (120, [])])
def test_success_after_the_window_counts_up_to_the_horizon(spark, second, starts):
    events = [event(i * 0.1) for i in range(11)] + [success(second)]
    found = alerts(spark, rules.BRUTE_FORCE_SUCCESS, events)
    assert [r.timestamp for r in found] == [at(s) for s in starts]


def test_success_shows_only_what_followed(spark):
    events = [success(0, destination_ip="10.9.9.9"), *[event(2 + i * 0.1) for i in range(11)]]
    events += [success(5, destination_ip="10.0.0.1", country="NL"), success(6, destination_ip="10.0.0.2")]
    found = alerts(spark, rules.BRUTE_FORCE_SUCCESS, events)
    assert {(r.destination_ip, r.country) for r in found} == {("10.0.0.2", "DE")}


def test_block_list_rule(spark):
    events = [event(1, source_ip=ip) for ip in ("185.220.101.9", "185.220.102.9", "bad", "45.33.32.1")]
    found = alerts(spark, rules.block_list_rule("auth"), events)
    assert [r.source_ip for r in found] == ["185.220.101.9", "45.33.32.1"]


def test_all_rules_share_the_alert_columns(spark):
    events = frame(spark, [event(i * 0.1) for i in range(11)])
    topics = dict.fromkeys(("auth", "firewall", "web"), events)
    assert detect_all(topics).columns == ALERT_COLUMNS
    with pytest.raises(ValueError):
        detect(events, rules.PORT_SCAN, "guess")
