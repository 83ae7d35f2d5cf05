"""Small in-line event tables."""

from __future__ import annotations

import datetime as dt

T0 = dt.datetime(2024, 3, 10, 2, 30)  # does not exist in New York: the clock skips it

_SCHEMA = (
    "raw string, timestamp timestamp_ntz, source_ip string, destination_ip string, "
    "source_port int, destination_port int, username string, action string, protocol string, "
    "bytes_sent bigint, country string, topic string, url string, http_method string, "
    "http_status int"
)


def event(second=0.0, **given):
    row = {
        "raw": "line",
        "timestamp": T0 + dt.timedelta(seconds=second),
        "source_ip": "1.2.3.4",
        "destination_ip": "10.0.0.1",
        "source_port": 50000,
        "destination_port": 22,
        "username": None,
        "action": "login_fail",
        "protocol": "TCP",
        "bytes_sent": 0,
        "country": "DE",
        "topic": "auth",
        "url": None,
        "http_method": None,
        "http_status": None,
    }
    return {**row, **given}


def frame(spark, events):
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in events], _SCHEMA)


def at(second):
    return T0 + dt.timedelta(seconds=second)
