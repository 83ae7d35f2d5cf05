"""Line shapes that sshd, the kernel and web servers write beside the plainest ones."""

import datetime as dt

import pytest

from logwarden.operators import rawlogs

AT = dt.datetime(2026, 6, 13, 3, 42, 11)
SSHD = "Jun 13 03:42:11 h sshd[1]: "
UFW = "[UFW BLOCK] IN=eth0 OUT= SRC=1.1.1.1 DST=10.0.0.1 LEN=60 PROTO=TCP SPT=5 DPT=22"
GET = '"GET /a HTTP/1.1" 200 7'
SHAPES = [
    ("auth", SSHD + "Failed password for invalid user admin from 1.1.1.1 port 5 ssh2", "login_fail", AT),
    ("auth", SSHD + "Accepted publickey for bob from 1.1.1.1 port 5 ssh2: RSA SHA256:x", "login_success", AT),
    ("auth", "2026-06-13T05:42:11+02:00 h sshd[1]: Invalid user a from 1.1.1.1 port 5", "invalid_user", AT),
    ("auth", "2026-06-13T03:42:11Z h sshd[1]: Invalid user a from 1.1.1.1 port 5", "invalid_user", AT),
    ("firewall", "Jun 13 03:42:11 fw kernel: [12345.678901] " + UFW, "block", AT),
    ("firewall", "2026-06-13T03:42:11.500000 fw kernel: " + UFW, "block", AT.replace(microsecond=500_000)),
    ("web", f'1.1.1.1 - - [13/Jun/2026:05:42:11 +0200] {GET} "-" "x"', "http_200", AT),
    ("web", f'1.1.1.1 - - [12/Jun/2026:22:12:11 -0530] {GET} "-" "x"', "http_200", AT),
    ("web", f"1.1.1.1 - - [13/Jun/2026:03:42:11 +0000] {GET}", "http_200", AT),
]


@pytest.mark.parametrize(("topic", "line", "action", "instant"), SHAPES)
def test_shape_is_read(spark, topic, line, action, instant):
    lines = spark.createDataFrame([(line,)], "line string")
    (row,) = rawlogs.parse_raw(lines, topic, 2026, zone_free=True).collect()
    assert (row.action, row.timestamp, row.source_ip) == (action, instant, "1.1.1.1")
    assert rawlogs.rejected_raw(lines, topic, 2026).count() == 0
    if topic == "web":
        (zoned,) = rawlogs.parse_raw(lines, topic, 2026).selectExpr("unix_seconds(timestamp) s").collect()
        assert zoned.s == int(instant.replace(tzinfo=dt.timezone.utc).timestamp())


def test_other_lines_are_still_rejected(spark):
    web = [f"1.1.1.1 - - [13/Jun/2026:03:42:11 +9900] {GET}", f'1.1.1.1 - - [13/Jun/2026:03:42:11 +0000] {GET} "cut']
    lines = spark.createDataFrame([(x,) for x in web], "line string")
    assert rawlogs.rejected_raw(lines, "web", 2026).count() == 2
    assert rawlogs.parse_raw(lines, "web", 2026).count() == 0
