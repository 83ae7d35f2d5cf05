"""JSON log lines to typed events, and the lines that could not become one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.schemas import NULL_DEFAULTS, REQUIRED_FIELDS, WIRE_DDL, event_columns, wire_types


_ZONED = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)\s*$"


def _event_time(text: Column, zone_free: bool) -> Column:
    """The time of a text; null where it is none.

    A text with an offset is one instant wherever it is read: without zones it becomes that
    instant's UTC time, which is also what streams see, as their session runs in UTC.
    """
    # try_cast: under ANSI mode a plain conversion would fail the job on one bad line.
    instant = text.try_cast("timestamp")
    if not zone_free:
        return instant
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    in_utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    return F.when(text.rlike(_ZONED), in_utc).otherwise(text.try_cast("timestamp_ntz"))


def _decode(messages: DataFrame, topic: str, zone_free: bool) -> DataFrame:
    """`value` plus one column per wire field, timestamp converted, no rows removed."""
    text = F.col("value").cast("string")
    # Unpacked by a generator rather than by field access: filters on the fields then stay above
    # it, and each message is parsed once instead of once more per filtered field.
    event = F.inline(F.array(F.from_json(text, WIRE_DDL[topic])))
    fields = messages.select(text.alias("value"), event)
    return fields.withColumn("parsed_time", _event_time(F.col("timestamp"), zone_free))


def _fields(topic: str) -> list[Column]:
    """Event columns of decoded messages, with the defaults of fields that were left out."""
    defaults = NULL_DEFAULTS[topic]

    def field(name: str) -> Column:
        source = F.col("parsed_time") if name == "timestamp" else F.col(name)
        if name in defaults:
            source = F.coalesce(source, F.lit(defaults[name]).cast(wire_types(topic)[name]))
        return source.alias(name)

    return [field(name) for name in event_columns(topic)]


def _reason(topic: str) -> Column:
    """Why a decoded message is no event; null for an event."""
    nothing_read = F.lit(True)
    for name in event_columns(topic):
        nothing_read = nothing_read & F.col(name).isNull()
    return (
        F.when(nothing_read, "unreadable")
        .when(F.col("source_ip").isNull(), "no_source_ip")
        .when(F.col("action").isNull(), "no_action")
        .when(F.col("parsed_time").isNull(), "no_timestamp")
    )


def parse_events(messages: DataFrame, topic: str, zone_free: bool = False) -> DataFrame:
    """Typed events of one topic from a `value` column holding JSON text or bytes.

    Works on a table and on a stream.  `zone_free` yields TIMESTAMP_NTZ, which no session time
    zone can shift; streams need the default because a watermark accepts only TIMESTAMP.
    """
    decoded = _decode(messages, topic, zone_free)
    return decoded.select(*_fields(topic)).dropna(subset=list(REQUIRED_FIELDS))


def judged_messages(messages: DataFrame, topic: str) -> DataFrame:
    """Every message once: the event columns, `reason` (null for an event) and, of the others, `value`.

    One parse serves both halves, and one write can keep them apart.
    """
    decoded = _decode(messages, topic, zone_free=False)
    reason = _reason(topic)
    return decoded.select(
        *_fields(topic), reason.alias("reason"), F.when(reason.isNotNull(), F.col("value")).alias("value")
    )


def rejected_events(messages: DataFrame, topic: str) -> DataFrame:
    """The complement of `parse_events`: every dropped line with the first reason found."""
    decoded = _decode(messages, topic, zone_free=True)
    reason = _reason(topic)
    return decoded.select(F.lit(topic).alias("topic"), reason.alias("reason"), "value").where(
        "reason is not null"
    )
