"""Detection rules as data.

A rule says which events count, over which windows, what is measured per source address, and
which alert to raise above a threshold.  How that is executed is decided in
`logwarden.plans.windowed`; adding a rule means adding a `Rule` here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwarden.functions.ip import BLOCK_LIST, in_networks, ipv4_to_long, is_private_text
from logwarden.schemas import TOPICS


@dataclass(frozen=True)
class Agg:
    """One aggregate: kind is count, sum, max or distinct; `expr` is SQL text."""

    kind: str
    expr: str = "*"


@dataclass(frozen=True)
class FollowUp:
    """What must come after a window has passed its threshold, from the same address.

    Events count from the second in which the threshold was passed until `horizon_s` after the
    window's end.  Order is judged by seconds, the resolution of the log lines: an event in the
    same second counts.
    """

    where: Callable[[], Column]
    horizon_s: int


@dataclass(frozen=True)
class Rule:
    name: str
    topic: str
    where: Callable[[], Column]
    window_s: int
    slide_s: int
    measure: Agg
    tiers: tuple[tuple[int, str], ...]  # (exceeded value, severity), ascending
    carry: dict[str, str]  # alert column -> SQL expression whose maximum it shows
    stamps: dict[str, object]  # alert column -> constant
    extras: dict[str, Agg] = field(default_factory=dict)
    guard: str = "true"  # SQL over `extras`, checked with the threshold
    bytes_from_measure: bool = False
    follow_up: FollowUp | None = None  # carried columns are then those of its events

    @property
    def trigger(self) -> int:
        return self.tiers[0][0]

    @property
    def counts_distinct(self) -> bool:
        return self.measure.kind == "distinct"

    def constants(self) -> dict[str, object]:
        """Alert columns that neither the group nor the carried columns give."""
        return {
            "topic": self.topic,
            "protocol": "TCP",
            "bytes_sent": 0,
            "rule_triggered": self.name,
            "username": None,
            **self.stamps,
        }

    def severity(self, measure: Column) -> Column:
        result = F.lit(self.tiers[0][1])
        for limit, label in self.tiers[1:]:
            result = F.when(measure > limit, label).otherwise(result)
        return result


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _action_in(*actions: str) -> Callable[[], Column]:
    return lambda: F.col("action").isin(*actions)


def _private(column: str) -> Column:
    return is_private_text(F.col(column))


_LOGIN_FAILURES = ("login_fail", "invalid_user")
_FLOW = ("destination_ip", "source_port", "destination_port", "raw")

BRUTE_FORCE = Rule(
    name="brute_force",
    topic="auth",
    where=_action_in(*_LOGIN_FAILURES),
    window_s=60,
    slide_s=30,
    measure=Agg("count"),
    tiers=((5, "HIGH"), (10, "CRIT")),
    carry=_same(*_FLOW, "username"),
    stamps={"action": "login_fail"},
)

PORT_SCAN = Rule(
    name="port_scan",
    topic="firewall",
    where=_action_in("block"),
    window_s=60,
    slide_s=30,
    measure=Agg("distinct", "destination_port"),
    tiers=((10, "HIGH"),),
    carry=_same("destination_ip", "source_port", "raw"),
    stamps={"action": "port_scan_detected", "destination_port": 0},
)

WEB_SCAN = Rule(
    name="web_scan",
    topic="web",
    where=_action_in("http_404", "http_403", "http_500"),
    window_s=60,
    slide_s=30,
    measure=Agg("distinct", "url"),
    tiers=((20, "MED"), (50, "HIGH")),
    carry=_same("destination_ip", "source_port", "raw"),
    stamps={"action": "web_scan_detected", "destination_port": 80},
)

EXFILTRATION = Rule(
    name="data_exfiltration",
    topic="firewall",
    where=_action_in("allow"),
    window_s=300,
    slide_s=60,
    measure=Agg("sum", "bytes_sent"),
    tiers=((100_000_000, "CRIT"),),
    carry=_same(*_FLOW),
    stamps={"action": "exfiltration_detected"},
    bytes_from_measure=True,
)

LATERAL_MOVEMENT = Rule(
    name="lateral_movement",
    topic="firewall",
    where=lambda: _private("source_ip"),
    window_s=120,
    slide_s=30,
    measure=Agg("distinct", "destination_ip"),
    tiers=((5, "CRIT"),),
    carry=_same(*_FLOW),
    stamps={"action": "lateral_movement_detected"},
)

# ---- variants that follow the documented wording instead of the running rules ----

WEB_SCAN_RATIO = Rule(
    name="web_scan_ratio",
    topic="web",
    where=lambda: F.lit(True),
    window_s=60,
    slide_s=30,
    measure=Agg("distinct", "url"),
    tiers=((20, "MED"), (50, "HIGH")),
    carry=_same("destination_ip", "source_port", "raw"),
    stamps={"action": "web_scan_detected", "destination_port": 80},
    extras={
        "requests": Agg("count"),
        "not_found": Agg("sum", "if(http_status = 404, 1, 0)"),
    },
    guard="not_found * 2 > requests",
)

LATERAL_INTERNAL = Rule(
    name="lateral_internal",
    topic="firewall",
    where=lambda: _private("source_ip") & _private("destination_ip"),
    window_s=120,
    slide_s=30,
    measure=Agg("distinct", "destination_ip"),
    tiers=((5, "CRIT"),),
    carry=_same(*_FLOW),
    stamps={"action": "lateral_movement_detected"},
)

EXFIL_INTERNAL = Rule(
    name="exfil_internal",
    topic="firewall",
    where=lambda: (F.col("action") == "allow") & _private("source_ip"),
    window_s=300,
    slide_s=60,
    measure=Agg("sum", "bytes_sent"),
    tiers=((100_000_000, "CRIT"),),
    carry=_same(*_FLOW),
    stamps={"action": "exfiltration_detected"},
    bytes_from_measure=True,
)

# More than ten failures within a minute, and then a success of the same address, at most a
# minute after the window.  The success may come between further failures, or after the window.
BRUTE_FORCE_SUCCESS = Rule(
    name="brute_force_success",
    topic="auth",
    where=_action_in(*_LOGIN_FAILURES),
    window_s=60,
    slide_s=30,
    measure=Agg("count"),
    tiers=((10, "CRIT"),),
    carry=_same(*_FLOW, "username"),
    stamps={"action": "login_success"},
    follow_up=FollowUp(_action_in("login_success"), horizon_s=60),
)


def block_list_rule(topic: str) -> Rule:
    """Any event from a listed network, one alert per minute, address and topic."""
    return Rule(
        name="blacklist",
        topic=topic,
        where=lambda: in_networks(ipv4_to_long(F.col("source_ip")), BLOCK_LIST),
        window_s=60,
        slide_s=60,
        measure=Agg("count"),
        tiers=((0, "HIGH"),),
        carry=_same(*_FLOW, "username"),
        stamps={"action": "blacklist_hit"},
    )


CORE_RULES = (BRUTE_FORCE, PORT_SCAN, WEB_SCAN, EXFILTRATION, LATERAL_MOVEMENT)
VARIANT_RULES = (WEB_SCAN_RATIO, LATERAL_INTERNAL, EXFIL_INTERNAL, BRUTE_FORCE_SUCCESS)

#: All rules by name; the block list has one per topic.
REGISTRY: dict[str, tuple[Rule, ...]] = {
    **{rule.name: (rule,) for rule in (*CORE_RULES, *VARIANT_RULES)},
    "blacklist": tuple(block_list_rule(topic) for topic in TOPICS),
}


def rules_named(names: Iterable[str]) -> list[Rule]:
    """The rules of the names, in order; an unknown name is an error that lists the known ones."""
    names = list(names)
    unknown = [name for name in names if name not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown rules {', '.join(unknown)}; known: {', '.join(REGISTRY)}")
    return [rule for name in names for rule in REGISTRY[name]]
