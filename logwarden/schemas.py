"""Column contracts: wire events, alerts and traffic statistics."""

from __future__ import annotations

TOPICS = ("auth", "firewall", "web")

_COMMON = (
    "raw string, timestamp string, source_ip string, destination_ip string, "
    "source_port int, destination_port int, username string, action string, "
    "protocol string, bytes_sent bigint, country string, topic string"
)

# JSON layout per topic; the timestamp arrives as ISO-8601 text.
WIRE_DDL = {
    "auth": _COMMON,
    "firewall": _COMMON,
    "web": _COMMON + ", url string, http_method string, http_status int",
}

# Value used where an event leaves the field out.  Web ports stay null on purpose.
NULL_DEFAULTS = {
    "auth": {"bytes_sent": 0, "source_port": 0, "destination_port": 22, "country": "UNKNOWN"},
    "firewall": {"bytes_sent": 0, "source_port": 0, "destination_port": 0, "country": "UNKNOWN"},
    "web": {"bytes_sent": 0, "http_status": 0, "country": "UNKNOWN"},
}

REQUIRED_FIELDS = ("source_ip", "action", "timestamp")

ALERT_DDL = (
    "timestamp timestamp, source_ip string, destination_ip string, source_port int, "
    "destination_port int, username string, topic string, action string, protocol string, "
    "bytes_sent bigint, country string, severity string, rule_triggered string, raw string"
)
STATS_DDL = (
    "window_start timestamp, window_end timestamp, topic string, source_ip string, "
    "country string, event_count bigint, fail_count bigint, bytes_total bigint"
)


def column_types(ddl: str) -> dict[str, str]:
    return dict(part.split() for part in ddl.split(", "))


def wire_types(topic: str) -> dict[str, str]:
    return column_types(WIRE_DDL[topic])


def event_columns(topic: str) -> list[str]:
    return list(wire_types(topic))


ALERT_TYPES = column_types(ALERT_DDL)
ALERT_COLUMNS = list(ALERT_TYPES)
STATS_COLUMNS = list(column_types(STATS_DDL))

SEVERITIES = ("LOW", "MED", "HIGH", "CRIT")
