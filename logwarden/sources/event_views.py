"""The three log topics as views over the `events` test table.

One event becomes one log record per topic.  Time is compressed to ten events a second and
users are folded into few addresses, so that one-minute rules have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions.ip import BLOCK_LIST, COUNTRY_BY_PREFIX
from logwarden.schemas import TOPICS, event_columns

_SOURCE_IP = {
    "auth": """CASE WHEN user_id % 40 < 10 THEN concat('10.0.0.', user_id % 40)
                    WHEN user_id % 40 < 15 THEN concat('172.', 14 + user_id % 40 - 10, '.0.9')
                    ELSE concat('185.220.101.', user_id % 40) END""",
    "firewall": """CASE WHEN user_id % 25 < 6 THEN concat('10.0.0.', user_id % 25)
                        WHEN user_id % 25 < 12
                        THEN concat('172.', 14 + (user_id % 25 - 6) * 4, '.0.9')
                        ELSE concat('185.220.101.', user_id % 25) END""",
    "web": """CASE WHEN user_id % 20 < 4 THEN '93.184.0.0'
                   ELSE concat('93.184.0.', user_id % 20) END""",
}
_ACTION = {
    "auth": """CASE event_type WHEN 'error' THEN 'login_fail'
                    WHEN 'signup' THEN 'invalid_user' ELSE 'login_success' END""",
    "firewall": "CASE WHEN event_type IN ('error', 'signup') THEN 'block' ELSE 'allow' END",
    "web": """CASE event_type WHEN 'error' THEN 'http_404' WHEN 'signup' THEN 'http_403'
                   WHEN 'view' THEN 'http_500' ELSE 'http_200' END""",
}
_BY_PREFIX = """CASE WHEN source_ip LIKE '10.0.0.%' THEN 'INT'
                     WHEN source_ip LIKE '185.220.101.%' THEN 'DE' ELSE 'UNKNOWN' END"""

_OTHERS = {
    "auth": {
        "destination_ip": "concat('10.0.2.', k % 8)",
        "destination_port": "22",
        "username": "concat('user_', user_id % 7)",
        "bytes_sent": "0",
        "country": _BY_PREFIX,
    },
    "firewall": {
        "destination_ip": """CASE WHEN k < 70 THEN concat('10.0.1.', k % 4)
                                  ELSE concat('10.0.1.', 4 + k % 7) END""",
        "destination_port": "1000 + k",
        "username": "null",
        "bytes_sent": "floor(value * 30000)",
        "country": _BY_PREFIX,
    },
    "web": {
        "destination_ip": "'10.0.0.10'",
        "destination_port": "80",
        "username": "null",
        "bytes_sent": "floor(value * 100)",
        "country": "'US'",
        "url": "concat('/p', k)",
        "http_method": "'GET'",
        "http_status": "right(action, 3)",
    },
}


#: Rows of the table in a partition where its records become messages.
SPREAD_ROWS = 50_000


def _events(spark: SparkSession, sf_dir: str, spread: bool) -> DataFrame:
    """The table; spread, its rows are dealt out, as a well compressed file is few splits however many rows it has."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.repartition(events.count() // SPREAD_ROWS + 1) if spread else events


_COMPRESSED = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + event_id * INTERVAL '0.1' SECOND"


def topic_view(
    spark: SparkSession, sf_dir: str, topic: str, time: str = _COMPRESSED, spread: bool = False
) -> DataFrame:
    """Typed events of one topic; the timestamp is TIMESTAMP_NTZ."""
    events = _events(spark, sf_dir, spread)
    base = events.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(_SOURCE_IP[topic]).alias("source_ip"),
        F.expr(_ACTION[topic]).alias("action"),
    )
    computed = {
        "raw": "concat(action, ' ', event_id)",
        "timestamp": time,
        "source_ip": "source_ip",
        "action": "action",
        "source_port": "49152 + k",
        "protocol": "'TCP'",
        "topic": f"'{topic}'",
        **_OTHERS[topic],
    }
    types = {"bytes_sent": "bigint", "timestamp": "timestamp_ntz"}
    for name in ("source_port", "destination_port", "http_status"):
        types[name] = "int"

    def column(name: str) -> Column:
        return F.expr(computed[name]).cast(types.get(name, "string")).alias(name)

    return base.select(*map(column, event_columns(topic)), "event_id")


def topic_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {topic: topic_view(spark, sf_dir, topic).drop("event_id") for topic in TOPICS}


def dated_topic_view(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The same records at their original times, which span a month instead of minutes."""
    return topic_view(spark, sf_dir, topic, time="ts").drop("event_id")


_ISO = "replace(cast(timestamp AS string), ' ', 'T')"
_SLOT = "source_port - 49152"


def wire_messages(spark: SparkSession, sf_dir: str, topic: str, spread: bool = False) -> DataFrame:
    """Records as JSON text in `value`, as a broker would deliver them."""
    view = topic_view(spark, sf_dir, topic, spread=spread).withColumn("timestamp", F.expr(_ISO))
    return view.select(F.to_json(F.struct(*event_columns(topic))).alias("value"))


def faulty_messages(spark: SparkSession, sf_dir: str, topic: str, spread: bool = False) -> DataFrame:
    """`wire_messages` with one kind of damage for each of ten port slots.

    Slot 0 truncated, 1 no source, 2 unreadable time, 3 quoted port, 4 byte overflow,
    5 no country, 6 no action, 7 no destination port, 8 no JSON, 9 null.
    """
    view = topic_view(spark, sf_dir, topic, spread=spread).withColumn("slot", F.expr(_SLOT))
    view = view.withColumn("timestamp", F.expr(f"if(slot = 2, 'not a time', {_ISO})"))
    for slot, name in ((1, "source_ip"), (5, "country"), (6, "action"), (7, "destination_port")):
        view = view.withColumn(name, F.when(F.col("slot") != slot, F.col(name)))
    text = view.select(
        "slot", F.to_json(F.struct(*event_columns(topic))).alias("json")
    ).withColumn(
        "value",
        F.expr(
            r"""CASE slot WHEN 0 THEN left(json, 20)
                WHEN 3 THEN regexp_replace(json, '"source_port":([0-9]+)', '"source_port":"$1"')
                WHEN 4 THEN regexp_replace(json, '"bytes_sent":[0-9]+',
                                           '"bytes_sent":99999999999999999999')
                WHEN 8 THEN 'oops' WHEN 9 THEN null ELSE json END"""
        ),
    )
    return text.select("value")


_SYSLOG_TIME = """concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                                int(substr(timestamp, 6, 2)) * 3 - 2, 3),
                         ' ', substr(timestamp, 9, 2), ' ', substr(timestamp, 12, 8))"""
_RAW_LINE = {
    "auth": f"""concat({_SYSLOG_TIME}, ' host', slot % 8, ' sshd[', 10000 + slot, ']: ',
        CASE action WHEN 'login_fail' THEN concat('Failed password for ', username)
                    WHEN 'login_success' THEN concat('Accepted password for ', username)
                    ELSE concat('Invalid user ', username) END,
        ' from ', source_ip, ' port ', source_port,
        if(action = 'invalid_user', '', ' ssh2'))""",
    "firewall": f"""concat({_SYSLOG_TIME}, ' firewall01 kernel: [UFW ', upper(action),
        '] IN=eth0 OUT= ', if(slot % 10 = 0, '', 'MAC=00:11:22:33:44:55 '),
        'SRC=', source_ip, ' DST=', destination_ip,
        if(slot % 10 = 0, '', concat(' LEN=', bytes_sent)),
        ' PROTO=TCP SPT=', 49152 + slot * 7 % 100, ' DPT=', destination_port)""",
    "web": """concat(source_ip, ' - - [', substr(timestamp, 9, 2), '/',
        substr('JanFebMarAprMayJunJulAugSepOctNovDec', int(substr(timestamp, 6, 2)) * 3 - 2, 3),
        '/', substr(timestamp, 1, 4), ':', substr(timestamp, 12, 8), ' +0000] "GET ', url,
        ' HTTP/1.1" ', http_status, ' ', bytes_sent, ' "-" "Mozilla/5.0"')""",
}


def raw_events(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Records whose `raw` is a line in the topic's log format; slot 13 has a broken line."""
    view = topic_view(spark, sf_dir, topic).drop("event_id")
    shaped = view.withColumn("slot", F.expr(_SLOT)).withColumn("text_time", F.expr(_ISO))
    line = _RAW_LINE[topic].replace("timestamp", "text_time")
    return shaped.withColumn(
        "raw", F.when(F.col("slot") == 13, "broken line").otherwise(F.expr(line))
    ).select(*event_columns(topic))


def alert_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert rows of which some break the output contract, derived from the auth view."""
    view = topic_view(spark, sf_dir, "auth").withColumn("slot", F.expr(_SLOT))
    return view.select(
        F.expr("if(slot = 0, null, timestamp)").alias("timestamp"),
        F.expr("if(slot = 1, repeat('1', 46), source_ip)").alias("source_ip"),
        "destination_ip",
        "source_port",
        "destination_port",
        F.expr("if(slot = 3, repeat('u', 101), username)").alias("username"),
        "topic",
        "action",
        "protocol",
        "bytes_sent",
        "country",
        F.expr(
            """CASE action WHEN 'login_fail' THEN 'CRIT' WHEN 'invalid_user' THEN 'SEVERE'
               ELSE 'LOW' END"""
        ).alias("severity"),
        F.expr("if(slot = 2, null, 'brute_force')").alias("rule_triggered"),
        "raw",
    )


def stats_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows of which some break the output contract, derived from the firewall view."""
    view = topic_view(spark, sf_dir, "firewall").withColumn("slot", F.expr(_SLOT))
    return view.select(
        F.expr("if(slot = 0, null, timestamp)").alias("window_start"),
        F.expr("if(slot % 50 = 0, null, timestamp + INTERVAL '1' MINUTE)").alias("window_end"),
        F.expr("CASE slot WHEN 1 THEN null WHEN 2 THEN repeat('t', 21) ELSE topic END").alias("topic"),
        F.expr("if(slot = 3, repeat('1', 46), source_ip)").alias("source_ip"),
        F.expr("if(slot = 4, repeat('c', 51), country)").alias("country"),
        F.lit(1).cast("bigint").alias("event_count"),
        F.lit(0).cast("bigint").alias("fail_count"),
        F.col("bytes_sent").alias("bytes_total"),
    )


def address_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address and port per event: listed, private, border and malformed ones."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    slot = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return slot.select(
        "event_id",
        F.expr(
            """concat(element_at(array(
                   '13.33.0.', '13.32.0.', '1.1.1.', '1.1.2.', '8.8.4.', '45.33.32.',
                   '209.141.36.', '209.141.37.', '80.82.77.', '192.168.1.', '192.168.2.',
                   '172.15.0.', '172.16.0.', '172.31.0.', '172.32.0.', '10.0.0.', '100.0.0.',
                   '256.1.1.', '1.2.', '01.2.3.'), k % 20 + 1), user_id % 300)"""
        ).alias("source_ip"),
        F.expr(
            "element_at(array(23, 445, 1433, 3389, 4444, 5900, 6666, 31337, 22, null), k % 10 + 1)"
        ).alias("destination_port"),
    )


def country_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`cidr` and `country`: the fixed prefixes, and a network of sixteen addresses per customer."""
    fixed = [
        (".".join((prefix + ".0.0").split(".")[:4]) + f"/{8 * len(prefix.split('.'))}", country)
        for prefix, country in COUNTRY_BY_PREFIX.items()
    ]
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.expr("concat('45.33.32.', c_custkey % 14 * 16 + 3, '/28')").alias("cidr"),
        F.expr("concat('N', c_nationkey)").alias("country"),
    )
    return spark.createDataFrame(fixed, "cidr string, country string").unionByName(customers)


def listed_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`cidr`: the fixed block list, one address per supplier, and text that is no network."""
    fixed = [(cidr,) for cidr in (*BLOCK_LIST, "1.2.3.0/33", "300.1.1.0/24", "junk", "1.1.1.1/8/8")]
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.expr("concat('8.8.4.', s_suppkey % 256)").alias("cidr")
    )
    return spark.createDataFrame(fixed, "cidr string").unionByName(suppliers)
