r"""Raw sshd, UFW and httpd lines to the unified event columns.

Lines without a year take the `year` argument.  Everything is native pattern extraction, so a
line never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions.ip import country_of
from logwarden.schemas import NULL_DEFAULTS, event_columns, wire_types

# A syslog line begins with a date without a year, or with an ISO time.
_SYSLOG = (
    r"(?:([A-Z][a-z]{2}) +(\d{1,2}) (\d{2}:\d{2}:\d{2})"
    r"|(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?)(Z|[+-]\d{2}:?\d{2})?) \S+ "
)
_LINE = {
    "auth": _SYSLOG
    + r"sshd\[\d+\]: ((?:Failed|Accepted)(?= \S+ for )|Invalid(?= user )) "
    + r"(?:\S+ for (?:invalid user )?|user )(\S+) from (\S+) port (\d+)",
    "firewall": _SYSLOG
    + r"kernel: (?:\[ *\d+\.\d+\] )?\[UFW (BLOCK|ALLOW)\] .*?\bSRC=(\S+) DST=(\S+)"
    + r"(?: LEN=(\S+))?(?:.*? PROTO=(\S+))?(?:.*? SPT=(\S+))?(?:.*? DPT=(\S+))?",
    "web": r"(\S+) \S+ \S+ \[(\d{2})/([A-Z][a-z]{2})/(\d{4}):(\d{2}:\d{2}:\d{2}) ([+-]\d{4})\] "
    + r'"(\S+) (\S+) [^"]*" (\d{3}) (\d+|-)(?: "[^"]*" "[^"]*"|\s*$)',
}
_NAMES = {
    "auth": "month day clock iso offset verb username source_ip source_port",
    "firewall": "month day clock iso offset verb source_ip destination_ip bytes_sent protocol "
    "source_port destination_port",
    "web": "source_ip day month year clock offset http_method url http_status bytes_sent",
}
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _split_line(lines: DataFrame, topic: str) -> DataFrame:
    """All columns of `lines` plus `found`, the named parts of the line; null if it differs.

    One pattern pass: a matching line is replaced by its parts, joined by tabs, which no part
    can contain.  A line that stays as it was did not match.  The generator keeps the result
    from being computed again in every filter and field above it.
    """
    names = _NAMES[topic].split()
    groups = "\t".join(f"${i + 1}" for i in range(len(names)))
    joined = F.regexp_replace("line", f"(?s)^{_LINE[topic]}.*$", groups)
    replaced = lines.select("*", F.explode(F.array(joined)).alias("joined"))
    split = replaced.select(
        *lines.columns,
        F.when(F.col("joined") != F.col("line"), F.split("joined", "\t")).alias("parts"),
    )
    found = F.struct(
        *[F.nullif(F.get("parts", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )
    return split.select(*lines.columns, F.when(F.col("parts").isNotNull(), found).alias("found"))


def _instant(year: Column, month: Column, day: Column, clock: Column) -> Column:
    # A month number from its place in the name list; an unknown name gives a bad date: null.
    number = F.ceil(F.instr(F.lit(_MONTHS), month) / 3)
    date = F.concat_ws(
        "-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0")
    )
    return F.concat(date, F.lit("T"), clock)


def _zoned(local: Column, offset: Column, zone_free: bool) -> Column:
    """A local time as text with its offset, if it has one; without a zone, its time in UTC."""
    hours, minutes = F.substring(offset, 2, 2), F.right(offset, F.lit(2))
    shift = F.concat(F.left(offset, F.lit(1)), hours, F.lit(":"), minutes)
    numeric = offset.rlike("^[+-]")
    zoned = F.concat(local, F.when(numeric, shift).otherwise(F.coalesce(offset, F.lit(""))))
    if not zone_free:
        return zoned
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    east = F.make_dt_interval(mins=sign * (hours.try_cast("int") * 60 + minutes.try_cast("int")))
    plain = local.try_cast("timestamp_ntz")
    # An offset that no zone has makes the line as unusable as it is with a zone.
    return F.when(~F.coalesce(numeric, F.lit(False)), plain).when(
        F.concat(F.lit("2000-01-01T00:00:00"), shift).try_cast("timestamp").isNotNull(), plain - east
    )


def _fields(topic: str, year: int) -> dict[str, Column]:
    """Event columns the line itself determines; `timestamp` is the local time as text."""
    part = {name: F.col(f"found.{name}") for name in _NAMES[topic].split()}
    verb = part.get("verb")
    local = _instant(part.get("year", F.lit(str(year))), part["month"], part["day"], part["clock"])
    known = {
        "timestamp": F.coalesce(part["iso"], local) if "iso" in part else local,
        "protocol": F.lit("TCP"),
        **part,
    }
    if topic == "auth":
        known["action"] = (
            F.when(verb == "Failed", "login_fail")
            .when(verb == "Accepted", "login_success")
            .otherwise("invalid_user")
        )
    elif topic == "firewall":
        known["action"] = F.lower(verb)
    else:
        known["action"] = F.concat(F.lit("http_"), part["http_status"])
    return known


def _read(lines: DataFrame, topic: str, year: int, zone_free: bool) -> DataFrame:
    """All columns of `lines` plus `fields`, the event; null for a line of another format."""
    known = _fields(topic, year)
    known |= {
        "raw": F.col("line"),
        "topic": F.lit(topic),
        "country": country_of(known["source_ip"]),
    }
    known["timestamp"] = _zoned(known["timestamp"], known["offset"], zone_free)
    types = wire_types(topic) | {"timestamp": "timestamp_ntz" if zone_free else "timestamp"}
    defaults = NULL_DEFAULTS[topic]

    def field(name: str) -> Column:
        value = known.get(name, F.lit(None)).try_cast(types[name])
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]).cast(types[name]))
        return value.alias(name)

    record = F.when(F.col("found").isNotNull(), F.struct(*map(field, event_columns(topic))))
    return _split_line(lines, topic).select(
        *lines.columns, F.explode(F.array(record)).alias("fields")
    )


# A line whose date does not exist is as unusable as one that does not match.
_USABLE = "fields.timestamp is not null"


def parse_raw(lines: DataFrame, topic: str, year: int, zone_free: bool = False) -> DataFrame:
    """Events from a `line` column; lines of another format are left to `rejected_raw`."""
    events = _read(lines, topic, year, zone_free).where(_USABLE)
    return events.select("fields.*")


def rejected_raw(lines: DataFrame, topic: str, year: int) -> DataFrame:
    rejects = _read(lines, topic, year, zone_free=True).where(f"not ({_USABLE})")
    return rejects.select(F.lit(topic).alias("topic"), "line")


def raw_vs_json_consistency(
    events: DataFrame, topic: str, year: int, compared: tuple[str, ...]
) -> DataFrame:
    """How often the fields of an event differ from those in its own raw line.

    One pass over the events: all mismatch counts are conditional sums of one aggregate.  The
    event time is compared to the second, the precision of a raw line.
    """
    read = _read(events.withColumn("line", F.col("raw")), topic, year, zone_free=True)
    matched = F.expr(_USABLE)

    def differs(name: str) -> Column:
        own, read_value = F.col(name), F.col(f"fields.{name}")
        if name == "timestamp":
            own, read_value = (F.substring(c.cast("string"), 1, 19) for c in (own, read_value))
        return matched & ~own.eqNullSafe(read_value)

    counts = read.agg(
        F.count_if(matched).alias("lines_read"),
        F.count_if(~matched).alias("lines_rejected"),
        *[F.count_if(differs(name)).alias(name) for name in compared],
    )
    return counts.unpivot(
        ["lines_read", "lines_rejected"], list(compared), "field", "mismatches"
    ).select(F.lit(topic).alias("topic"), "field", "mismatches", "lines_read", "lines_rejected")
