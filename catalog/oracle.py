"""The same results as `queries.py`, as SQL for DuckDB over the test tables.

Written from the rule descriptions, not from the rule objects, so that the two sides can
disagree.
"""

from __future__ import annotations

_VIEWS = """
base AS (
  SELECT event_id, user_id AS u, event_type, value, ts AS original_ts,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (event_id * 100) MILLISECOND AS ts
  FROM events),
auth_0 AS (
  SELECT *, CASE WHEN u % 40 < 10 THEN '10.0.0.' || (u % 40)
                 WHEN u % 40 < 15 THEN '172.' || (14 + u % 40 - 10) || '.0.9'
                 ELSE '185.220.101.' || (u % 40) END AS source_ip,
         CASE event_type WHEN 'error' THEN 'login_fail' WHEN 'signup' THEN 'invalid_user'
              ELSE 'login_success' END AS action
  FROM base),
auth AS (
  SELECT event_id, k, original_ts, action || ' ' || event_id AS raw, ts AS "timestamp", source_ip,
         '10.0.2.' || (k % 8) AS destination_ip, 49152 + k AS source_port,
         22 AS destination_port, 'user_' || (u % 7) AS username, action, 'TCP' AS protocol,
         CAST(0 AS BIGINT) AS bytes_sent,
         CASE WHEN source_ip LIKE '10.0.0.%' THEN 'INT'
              WHEN source_ip LIKE '185.220.101.%' THEN 'DE' ELSE 'UNKNOWN' END AS country,
         'auth' AS topic
  FROM auth_0),
firewall_0 AS (
  SELECT *, CASE WHEN u % 25 < 6 THEN '10.0.0.' || (u % 25)
                 WHEN u % 25 < 12 THEN '172.' || (14 + (u % 25 - 6) * 4) || '.0.9'
                 ELSE '185.220.101.' || (u % 25) END AS source_ip,
         CASE WHEN event_type IN ('error', 'signup') THEN 'block' ELSE 'allow' END AS action
  FROM base),
firewall AS (
  SELECT event_id, k, original_ts, action || ' ' || event_id AS raw, ts AS "timestamp", source_ip,
         CASE WHEN k < 70 THEN '10.0.1.' || (k % 4) ELSE '10.0.1.' || (4 + k % 7) END
           AS destination_ip,
         49152 + k AS source_port, 1000 + k AS destination_port, CAST(NULL AS VARCHAR) AS username,
         action, 'TCP' AS protocol, CAST(floor(value * 30000) AS BIGINT) AS bytes_sent,
         CASE WHEN source_ip LIKE '10.0.0.%' THEN 'INT'
              WHEN source_ip LIKE '185.220.101.%' THEN 'DE' ELSE 'UNKNOWN' END AS country,
         'firewall' AS topic
  FROM firewall_0),
web_0 AS (
  SELECT *, CASE WHEN u % 20 < 4 THEN '93.184.0.0' ELSE '93.184.0.' || (u % 20) END AS source_ip,
         CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 403 WHEN 'view' THEN 500
              ELSE 200 END AS status
  FROM base),
web AS (
  SELECT event_id, k, original_ts, 'http_' || status || ' ' || event_id AS raw,
         ts AS "timestamp", source_ip,
         '10.0.0.10' AS destination_ip, 49152 + k AS source_port, 80 AS destination_port,
         CAST(NULL AS VARCHAR) AS username, 'http_' || status AS action, 'TCP' AS protocol,
         CAST(floor(value * 100) AS BIGINT) AS bytes_sent, 'US' AS country, 'web' AS topic,
         '/p' || k AS url, 'GET' AS http_method, status AS http_status
  FROM web_0)"""

_COMMON = (
    'raw, "timestamp", source_ip, destination_ip, source_port, destination_port, username, '
    "action, protocol, bytes_sent, country, topic"
)
_PRIVATE = "regexp_matches({0}, '^(10\\.|192\\.168\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)')"
_PRIVATE_SOURCE = _PRIVATE.format("source_ip")


def _alerts(
    rule: str,
    topic: str,
    where: str,
    window: int,
    slide: int,
    having: str,
    severity: str,
    action: str,
    port: str = "max(destination_port)",
    username: str = "CAST(NULL AS VARCHAR)",
    bytes_sent: str = "CAST(0 AS BIGINT)",
    condition: str = "true",
    source: str | None = None,
) -> str:
    def top(column: str) -> str:
        return f"max(CASE WHEN {condition} THEN {column} END)"

    if port == "max(destination_port)":
        port = top("destination_port")
    if username == "max(username)":
        username = top("username")
    return f"""
SELECT ws AS "timestamp", source_ip, {top("destination_ip")} AS destination_ip,
       {top("source_port")} AS source_port, {port} AS destination_port, {username} AS username,
       '{topic}' AS topic, '{action}' AS action, 'TCP' AS protocol, {bytes_sent} AS bytes_sent,
       country, {severity} AS severity, '{rule}' AS rule_triggered, {top("raw")} AS raw
FROM (SELECT *, time_bucket(INTERVAL {slide} SECOND, "timestamp")
                - step * INTERVAL {slide} SECOND AS ws
      FROM {source or topic}, range({window // slide}) AS steps(step)
      WHERE {where})
GROUP BY ws, source_ip, country
HAVING {having}"""


_FAILED = "action IN ('login_fail', 'invalid_user')"
_RULES = {
    "detect_brute_force": _alerts(
        "brute_force", "auth", _FAILED, 60, 30, "count(*) > 5",
        "CASE WHEN count(*) > 10 THEN 'CRIT' ELSE 'HIGH' END", "login_fail",
        username="max(username)",
    ),
    "detect_port_scan": _alerts(
        "port_scan", "firewall", "action = 'block'", 60, 30,
        "count(DISTINCT destination_port) > 10", "'HIGH'", "port_scan_detected", port="0",
    ),
    "detect_web_scan": _alerts(
        "web_scan", "web", "action IN ('http_404', 'http_403', 'http_500')", 60, 30,
        "count(DISTINCT url) > 20",
        "CASE WHEN count(DISTINCT url) > 50 THEN 'HIGH' ELSE 'MED' END",
        "web_scan_detected", port="80",
    ),
    "detect_exfiltration": _alerts(
        "data_exfiltration", "firewall", "action = 'allow'", 300, 60,
        "sum(bytes_sent) > 100000000", "'CRIT'", "exfiltration_detected",
        bytes_sent="CAST(sum(bytes_sent) AS BIGINT)",
    ),
    "detect_lateral_movement": _alerts(
        "lateral_movement", "firewall", _PRIVATE_SOURCE, 120, 30,
        "count(DISTINCT destination_ip) > 5", "'CRIT'", "lateral_movement_detected",
    ),
}
_VARIANTS = {
    "detect_web_scan_ratio": _alerts(
        "web_scan_ratio", "web", "true", 60, 30,
        "count(DISTINCT url) > 20 AND 2 * count(*) FILTER (action <> 'http_200') > count(*)",
        "CASE WHEN count(DISTINCT url) > 50 THEN 'HIGH' ELSE 'MED' END",
        "web_scan_detected", port="80",
    ),
    "detect_lateral_internal": _alerts(
        "lateral_internal", "firewall",
        _PRIVATE_SOURCE + " AND " + _PRIVATE.format("destination_ip"), 120, 30,
        "count(DISTINCT destination_ip) > 5", "'CRIT'", "lateral_movement_detected",
    ),
    "detect_exfil_internal": _alerts(
        "exfil_internal", "firewall", "action = 'allow' AND " + _PRIVATE_SOURCE, 300, 60,
        "sum(bytes_sent) > 100000000", "'CRIT'", "exfiltration_detected",
        bytes_sent="CAST(sum(bytes_sent) AS BIGINT)",
    ),
}


# "> 10 failed logins from the same IP within one minute, followed by a login_success from the
# same IP": the success counts from the second of the eleventh failure to a minute past the window.
_SUCCESS_AFTER = f"""
WITH failing AS (
  SELECT ws, source_ip, country, list_sort(list(second))[11] AS eleventh
  FROM (SELECT source_ip, country, date_trunc('second', "timestamp") AS second,
               time_bucket(INTERVAL 30 SECOND, "timestamp") - step * INTERVAL 30 SECOND AS ws
        FROM auth, range(2) AS steps(step) WHERE {_FAILED})
  GROUP BY ws, source_ip, country HAVING count(*) > 10)
SELECT ws AS "timestamp", f.source_ip, max(s.destination_ip) AS destination_ip,
       max(s.source_port) AS source_port, max(s.destination_port) AS destination_port,
       max(s.username) AS username, 'auth' AS topic, 'login_success' AS action, 'TCP' AS protocol,
       CAST(0 AS BIGINT) AS bytes_sent, f.country, 'CRIT' AS severity,
       'brute_force_success' AS rule_triggered, max(s.raw) AS raw
FROM failing AS f JOIN auth AS s
  ON s.source_ip = f.source_ip AND s.action = 'login_success'
  AND date_trunc('second', s."timestamp") >= f.eleventh
  AND s."timestamp" < f.ws + INTERVAL 120 SECOND
GROUP BY ws, f.source_ip, f.country"""


def _with(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join((_VIEWS.strip(), *extra)) + "\n" + body


def _ip_value(ip: str) -> str:
    part = "CAST(split_part({0}, '.', {1}) AS BIGINT)"
    number = " + ".join(
        f"{part.format(ip, i + 1)} * {256 ** (3 - i)}" for i in range(4)
    )
    quad = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    full = r"\.".join([quad] * 4)
    return f"CASE WHEN regexp_full_match({ip}, '{full}') THEN {number} END"


def _number(ip: str) -> int:
    total = 0
    for octet in ip.split("."):
        total = total * 256 + int(octet)
    return total


def _range(first: str, last: str, value: str = "n") -> str:
    return f"coalesce({value} BETWEEN {_number(first)} AND {_number(last)}, false)"


_BLOCKED = " OR ".join(
    _range(f"{prefix}.0", f"{prefix}.255")
    for prefix in (
        "185.220.101", "185.220.100", "45.33.32", "80.82.77", "89.248.167", "209.141.36",
    )
)

_ALL_ALERTS = "all_alerts AS (" + "\nUNION ALL\n".join(_RULES.values()) + ")"


def _topic_stats(topic: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS window_start,
       time_bucket(INTERVAL 1 MINUTE, "timestamp") + INTERVAL 1 MINUTE AS window_end,
       '{topic}' AS topic, source_ip, country, count(*) AS event_count,
       count(*) FILTER (action = 'login_fail') AS fail_count,
       CAST(sum(bytes_sent) AS BIGINT) AS bytes_total
FROM {topic} GROUP BY 1, 2, 3, 4, 5"""


_STATS = "stats AS (" + "\nUNION ALL\n".join(map(_topic_stats, ("auth", "firewall", "web"))) + ")"


def _from_alerts(body: str) -> str:
    return _with(body, _ALL_ALERTS)


def _from_stats(body: str) -> str:
    return _with(body, _STATS)


_SINCE = """WHERE window_start >= TIMESTAMP '2024-01-01 00:01:00'
  AND window_start <= TIMESTAMP '2030-01-01 00:00:00'"""


def _topic_sum(measure: str, topic: str) -> str:
    total = f"coalesce(sum({measure}) FILTER (topic = '{topic}'), 0)"
    return f'CAST({total} AS BIGINT) AS "{topic.capitalize()}"'


def _newest(columns: str, n: int) -> str:
    return _from_alerts(
        f"""SELECT {columns} FROM all_alerts
        ORDER BY "timestamp" DESC, rule_triggered, source_ip, country LIMIT {n}"""
    )


def _parsed(topic: str, port: str, web: str = "") -> str:
    """Damage by slot k: 0, 1, 2, 6, 8 and 9 lose the record, the others lose one field."""
    source_port = "CAST(NULL AS INTEGER)" if web else "0"
    return _with(
        f"""SELECT raw, "timestamp", source_ip, destination_ip,
        CASE WHEN k = 3 THEN {source_port} ELSE source_port END AS source_port,
        CASE WHEN k = 7 THEN {port} ELSE destination_port END AS destination_port,
        username, action, protocol,
        CASE WHEN k = 4 THEN CAST(0 AS BIGINT) ELSE bytes_sent END AS bytes_sent,
        CASE WHEN k = 5 THEN 'UNKNOWN' ELSE country END AS country, topic {web}
        FROM {topic} WHERE k NOT IN (0, 1, 2, 6, 8, 9)"""
    )


def _json_text(topic: str) -> str:
    """The wire text of a rejected record, field by field; nulls are left out."""
    iso = """CASE WHEN k = 2 THEN 'not a time' ELSE
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN event_id % 10 = 0 THEN '' ELSE '.' || (event_id % 10) END END"""

    def text(name: str, value: str) -> str:
        return f"""coalesce(',"{name}":"' || {value} || '"', '')"""

    def number(name: str) -> str:
        return f"""',"{name}":' || {name}"""

    parts = [
        """'{"raw":"' || raw || '"'""",
        text("timestamp", f"({iso})"),
        text("source_ip", "CASE WHEN k <> 1 THEN source_ip END"),
        text("destination_ip", "destination_ip"),
        number("source_port"),
        number("destination_port"),
        text("username", "username"),
        text("action", "CASE WHEN k <> 6 THEN action END"),
        text("protocol", "protocol"),
        number("bytes_sent"),
        text("country", "country"),
        text("topic", "topic"),
    ]
    if topic == "web":
        parts += [text("url", "url"), text("http_method", "http_method"), number("http_status")]
    return " || ".join(parts) + " || '}'"


def _rejects(topic: str) -> str:
    return f"""
SELECT topic,
       CASE k WHEN 1 THEN 'no_source_ip' WHEN 2 THEN 'no_timestamp' WHEN 6 THEN 'no_action'
              ELSE 'unreadable' END AS reason,
       CASE k WHEN 0 THEN left(json, 20) WHEN 8 THEN 'oops' WHEN 9 THEN NULL ELSE json END AS value
FROM (SELECT topic, k, {_json_text(topic)} AS json FROM {topic} WHERE k IN (0, 1, 2, 6, 8, 9))"""


def _each_topic(template: str) -> str:
    return "\nUNION ALL\n".join(template.format(topic=t) for t in ("auth", "firewall", "web"))


_CANDIDATES = """candidates AS (
  SELECT CASE WHEN k = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
         CASE WHEN k = 1 THEN repeat('1', 46) ELSE source_ip END AS source_ip,
         destination_ip, source_port, destination_port,
         CASE WHEN k = 3 THEN repeat('u', 101) ELSE username END AS username,
         topic, action, protocol, bytes_sent, country,
         CASE action WHEN 'login_fail' THEN 'CRIT' WHEN 'invalid_user' THEN 'SEVERE'
              ELSE 'LOW' END AS severity,
         CASE WHEN k = 2 THEN NULL ELSE 'brute_force' END AS rule_triggered, raw, k
  FROM auth)"""

_ADDRESSES = f"""addresses AS (
  SELECT event_id, source_ip, {_ip_value("source_ip")} AS n, destination_port
  FROM (SELECT event_id,
          (['13.33.0.', '13.32.0.', '1.1.1.', '1.1.2.', '8.8.4.', '45.33.32.', '209.141.36.',
            '209.141.37.', '80.82.77.', '192.168.1.', '192.168.2.', '172.15.0.', '172.16.0.',
            '172.31.0.', '172.32.0.', '10.0.0.', '100.0.0.', '256.1.1.', '1.2.', '01.2.3.'
           ])[k % 20 + 1] || (u % 300) AS source_ip,
          ([23, 445, 1433, 3389, 4444, 5900, 6666, 31337, 22, NULL])[k % 10 + 1]
            AS destination_port
        FROM base))"""


def _from_addresses(column: str) -> str:
    body = f"SELECT event_id, source_ip, destination_port, {column} FROM addresses"
    return _with(body, _ADDRESSES)


_SECOND = "date_trunc('second', \"timestamp\")"
_SYSLOG = "strftime(\"timestamp\", '%b %d %H:%M:%S')"
_RAW_LINE = {
    "auth": f"""{_SYSLOG} || ' host' || (k % 8) || ' sshd[' || (10000 + k) || ']: ' ||
        CASE action WHEN 'login_fail' THEN 'Failed password for '
                    WHEN 'login_success' THEN 'Accepted password for '
                    ELSE 'Invalid user ' END
        || username || ' from ' || source_ip || ' port ' || source_port ||
        CASE WHEN action = 'invalid_user' THEN '' ELSE ' ssh2' END""",
    "firewall": f"""{_SYSLOG} || ' firewall01 kernel: [UFW ' || upper(action)
        || '] IN=eth0 OUT= ' ||
        CASE WHEN k % 10 = 0 THEN '' ELSE 'MAC=00:11:22:33:44:55 ' END
        || 'SRC=' || source_ip || ' DST=' || destination_ip ||
        CASE WHEN k % 10 = 0 THEN '' ELSE ' LEN=' || bytes_sent END
        || ' PROTO=TCP SPT=' || (49152 + k * 7 % 100) || ' DPT=' || destination_port""",
    "web": """source_ip || ' - - [' || strftime("timestamp", '%d/%b/%Y:%H:%M:%S')
        || ' +0000] "GET ' || url || ' HTTP/1.1" ' || http_status || ' ' || bytes_sent
        || ' "-" "Mozilla/5.0"'""",
}


def _mismatches(topic: str, counts: dict[str, str]) -> str:
    """Per field, how many matched lines differ from the record."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{topic}' AS topic, '{name}' AS field,
        count(*) FILTER (k <> 13 AND {differs}) AS mismatches,
        count(*) FILTER (k <> 13) AS lines_read, count(*) FILTER (k = 13) AS lines_rejected
        FROM {topic}"""
        for name, differs in counts.items()
    )


_CONSISTENT = "false"
_CONSISTENCY = "\nUNION ALL\n".join(
    (
        _mismatches(
            "auth",
            dict.fromkeys(
                ("timestamp", "source_ip", "source_port", "username", "action"), _CONSISTENT
            ),
        ),
        _mismatches(
            "firewall",
            {
                **dict.fromkeys(
                    ("timestamp", "source_ip", "destination_ip", "destination_port", "action",
                     "country"), _CONSISTENT
                ),
                "source_port": "k * 7 % 100 <> k",
                "bytes_sent": "k % 10 = 0 AND bytes_sent <> 0",
            },
        ),
        _mismatches(
            "web",
            dict.fromkeys(
                ("timestamp", "source_ip", "url", "http_method", "http_status", "bytes_sent"),
                _CONSISTENT,
            ),
        ),
    )
)

_BLACKLIST_ALERTS = "\nUNION ALL\n".join(
    _alerts(
        "blacklist", topic, f"({_BLOCKED})", 60, 60, "count(*) > 0", "'HIGH'", "blacklist_hit",
        username="max(username)",
        source=f"(SELECT *, {_ip_value('source_ip')} AS n FROM {topic})",
    )
    for topic in ("auth", "firewall", "web")
)

ORACLE: dict[str, str] = {
    **{name: _with(body) for name, body in {**_RULES, **_VARIANTS}.items()},
    "detect_bruteforce_success": _with(f"SELECT * FROM ({_SUCCESS_AFTER})"),
    # The sketches hold counts of this size exactly, so approximate rules raise the same alerts.
    **{f"{name}_approx": _with(_RULES[name]) for name in (
        "detect_port_scan", "detect_web_scan", "detect_lateral_movement")},
    "stream_alerts_approx": _from_alerts("SELECT * FROM all_alerts"),
    "detect_blacklist": _with(_BLACKLIST_ALERTS),
    "alerts_all": _from_alerts("SELECT * FROM all_alerts"),
    "alerts_all_one_pass": _from_alerts("SELECT * FROM all_alerts"),
    "stream_alerts": _from_alerts("SELECT * FROM all_alerts"),
    "traffic_stats": _from_stats("SELECT * FROM stats"),
    "stream_traffic_stats": _from_stats("SELECT * FROM stats"),
    "q_total_alerts": _from_alerts("SELECT count(*) AS value FROM all_alerts"),
    "q_critical_alerts": _from_alerts(
        "SELECT count(*) AS value FROM all_alerts WHERE severity = 'CRIT'"
    ),
    "q_events_processed": _from_stats(
        "SELECT CAST(sum(event_count) AS BIGINT) AS value FROM stats"
    ),
    "q_total_bytes": _from_stats("SELECT CAST(sum(bytes_total) AS BIGINT) AS value FROM stats"),
    "q_alerts_by_rule": _from_alerts(
        "SELECT rule_triggered, count(*) AS count FROM all_alerts GROUP BY 1 ORDER BY 2 DESC, 1"
    ),
    "q_alerts_by_severity": _from_alerts(
        """SELECT severity, count(*) AS count FROM all_alerts GROUP BY severity
        ORDER BY CASE severity WHEN 'LOW' THEN 1 WHEN 'MED' THEN 2
                               WHEN 'HIGH' THEN 3 WHEN 'CRIT' THEN 4 END"""
    ),
    "q_events_over_time": _from_stats(
        f"""SELECT window_start AS "time", {_topic_sum("event_count", "auth")},
        {_topic_sum("event_count", "firewall")}, {_topic_sum("event_count", "web")}
        FROM stats {_SINCE} GROUP BY window_start ORDER BY window_start"""
    ),
    "q_bytes_over_time": _from_stats(
        f"""SELECT window_start AS "time", {_topic_sum("bytes_total", "firewall")},
        {_topic_sum("bytes_total", "web")}
        FROM stats {_SINCE} GROUP BY window_start ORDER BY window_start"""
    ),
    "q_recent_alerts": _newest(
        '"timestamp", source_ip, country, destination_ip, rule_triggered, severity', 50
    ),
    "q_latest_alerts": _newest('"timestamp", source_ip, country, rule_triggered, severity', 20),
    "q_alerts_by_rule_severity": _from_alerts(
        """SELECT rule_triggered, severity, count(*) AS count FROM all_alerts
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2"""
    ),
    "q_traffic_by_topic": _from_stats(
        """SELECT topic, CAST(sum(event_count) AS BIGINT) AS events,
        CAST(sum(bytes_total) AS BIGINT) AS bytes FROM stats GROUP BY topic"""
    ),
    "q_top_sources": _from_alerts(
        """SELECT source_ip, count(*) AS alerts FROM all_alerts GROUP BY source_ip
        ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
    "parse_auth": _parsed("auth", "22"),
    "parse_firewall": _parsed("firewall", "0"),
    "parse_web": _parsed("web", "NULL", ", url, http_method, http_status"),
    "parse_rejects": _with("\nUNION ALL\n".join(map(_rejects, ("auth", "firewall", "web")))),
    # A message without a value arrives as an empty line.
    "stream_quarantine": _with(
        "SELECT topic, reason, coalesce(value, '') AS value FROM ("
        + "\nUNION ALL\n".join(map(_rejects, ("auth", "firewall", "web")))
        + ")"
    ),
    "archive_daily_counts": _with(
        _each_topic(
            """SELECT topic, strftime(original_ts, '%Y-%m-%d') AS date, count(*) AS events,
            CAST(sum(bytes_sent) AS BIGINT) AS bytes FROM {topic} GROUP BY 1, 2"""
        )
    ),
    "archive_scan": _with(
        _each_topic(
            """SELECT original_ts AS "timestamp", source_ip, action, topic,
            strftime(original_ts, '%Y-%m-%d') AS date FROM {topic}
            WHERE CAST(original_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""
        )
    ),
    "stream_archive": _with(
        _each_topic(
            """SELECT "timestamp", topic, source_ip,
            strftime("timestamp", '%Y-%m-%d') AS date FROM {topic}"""
        )
    ),
    "alert_contract_violations": _with(
        """SELECT violation, count(*) AS n FROM (
          SELECT 'timestamp_missing' AS violation FROM candidates WHERE "timestamp" IS NULL
          UNION ALL SELECT 'rule_triggered_missing' FROM candidates WHERE rule_triggered IS NULL
          UNION ALL SELECT 'source_ip_too_long' FROM candidates WHERE length(source_ip) > 45
          UNION ALL SELECT 'username_too_long' FROM candidates WHERE length(username) > 100
          UNION ALL SELECT 'severity_unknown' FROM candidates
            WHERE severity NOT IN ('LOW', 'MED', 'HIGH', 'CRIT')
        ) GROUP BY violation""",
        _CANDIDATES,
    ),
    "stats_contract_violations": _with(
        """SELECT violation, count(*) AS n FROM (
          SELECT 'window_start_missing' AS violation FROM firewall WHERE k = 0
          UNION ALL SELECT 'window_end_missing' FROM firewall WHERE k % 50 = 0
          UNION ALL SELECT 'topic_missing' FROM firewall WHERE k = 1
          UNION ALL SELECT 'topic_too_long' FROM firewall WHERE k = 2
          UNION ALL SELECT 'source_ip_too_long' FROM firewall WHERE k = 3
          UNION ALL SELECT 'country_too_long' FROM firewall WHERE k = 4
        ) GROUP BY violation"""
    ),
    "alert_contract_valid": _with(
        "SELECT * EXCLUDE (k) FROM candidates WHERE k > 3 AND severity <> 'SEVERE'", _CANDIDATES
    ),
    "enrich_country": _from_addresses(
        f"""CASE WHEN {_range("8.8.0.0", "8.8.255.255")} THEN 'US'
            WHEN {_range("1.1.1.0", "1.1.1.255")} OR source_ip LIKE '1.1.1.%' THEN 'AU'
            WHEN source_ip LIKE '8.8.%' OR source_ip LIKE '45.33.32.%' THEN 'US'
            WHEN source_ip LIKE '209.141.36.%' OR source_ip LIKE '13.32.%' THEN 'US'
            WHEN source_ip LIKE '80.82.77.%' THEN 'NL'
            WHEN source_ip LIKE '192.168.1.%' OR source_ip LIKE '10.0.0.%' THEN 'INT'
            ELSE 'UNKNOWN' END AS country"""
    ),
    "tag_blacklist": _from_addresses(f"({_BLOCKED}) AS blacklisted"),
    "enrich_country_table": _from_addresses(
        f"""CASE WHEN {_range("45.33.32.0", "45.33.32.255")} THEN coalesce((
              SELECT min('N' || c_nationkey) FROM customer
              WHERE c_custkey % 14 = (n - {_number("45.33.32.0")}) // 16), 'US')
            WHEN {_range("8.8.0.0", "8.8.255.255")} OR {_range("209.141.36.0", "209.141.36.255")}
              OR {_range("13.32.0.0", "13.32.255.255")} THEN 'US'
            WHEN {_range("1.1.1.0", "1.1.1.255")} THEN 'AU'
            WHEN {_range("80.82.77.0", "80.82.77.255")} THEN 'NL'
            WHEN {_range("192.168.1.0", "192.168.1.255")} OR {_range("10.0.0.0", "10.0.0.255")}
            THEN 'INT' ELSE 'UNKNOWN' END AS country"""
    ),
    "tag_blacklist_table": _from_addresses(
        f"""({_BLOCKED}) OR coalesce({_range("8.8.4.0", "8.8.4.255")} AND n % 256 IN (
              SELECT s_suppkey % 256 FROM supplier), false) AS blacklisted"""
    ),
    "distinct_sketch_error": _with(
        "\nUNION ALL\n".join(
            f"""SELECT '{topic}' AS topic, {seconds} AS seconds, count(*) AS groups,
            CAST(0 AS BIGINT) AS outside FROM (SELECT DISTINCT source_ip,
              time_bucket(INTERVAL {seconds} SECOND, "timestamp") FROM {topic})"""
            for topic in ("auth", "firewall", "web")
            for seconds in (60, 300)
        )
    ),
    "classify_network": _from_addresses(
        f"""CASE WHEN n IS NULL THEN 'invalid'
            WHEN {_range("10.0.0.0", "10.0.0.255")} THEN 'server'
            WHEN {_range("192.168.1.0", "192.168.1.255")} THEN 'employee'
            WHEN {_range("10.0.0.0", "10.255.255.255")}
              OR {_range("172.16.0.0", "172.31.255.255")}
              OR {_range("192.168.0.0", "192.168.255.255")} THEN 'private'
            ELSE 'external' END AS network_class"""
    ),
    "tag_suspicious_port": _from_addresses(
        """coalesce(destination_port IN (23, 445, 1433, 3389, 4444, 5900, 6666, 31337), false)
           AS suspicious_port"""
    ),
    "parse_raw_sshd": _with(
        f"""SELECT {_RAW_LINE["auth"]} AS raw, {_SECOND} AS "timestamp", source_ip,
        CAST(NULL AS VARCHAR) AS destination_ip, source_port, 22 AS destination_port, username,
        action, protocol, bytes_sent, country, topic FROM auth WHERE k <> 13"""
    ),
    "parse_raw_ufw": _with(
        f"""SELECT {_RAW_LINE["firewall"]} AS raw, {_SECOND} AS "timestamp", source_ip,
        destination_ip, 49152 + k * 7 % 100 AS source_port, destination_port, username,
        action, protocol, CASE WHEN k % 10 = 0 THEN 0 ELSE bytes_sent END AS bytes_sent,
        country, topic FROM firewall WHERE k <> 13"""
    ),
    "parse_raw_httpd": _with(
        f"""SELECT {_RAW_LINE["web"]} AS raw, {_SECOND} AS "timestamp", source_ip,
        CAST(NULL AS VARCHAR) AS destination_ip, CAST(NULL AS INTEGER) AS source_port,
        CAST(NULL AS INTEGER) AS destination_port, username, action, protocol, bytes_sent,
        country, topic, url, http_method, http_status FROM web WHERE k <> 13"""
    ),
    "raw_rejects": _with(
        _each_topic("SELECT topic, 'broken line' AS line FROM {topic} WHERE k = 13")
    ),
    "raw_vs_json_consistency": _with(_CONSISTENCY),
}
