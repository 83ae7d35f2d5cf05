"""IPv4 helpers built from native column expressions, so they stay in generated code.

The network lists here are short constants, so they are folded into the expression: no join,
no broadcast and no shuffle, on a table or on a stream.
"""

from __future__ import annotations

import ipaddress
from collections import defaultdict
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Networks treated as hostile.
BLOCK_LIST = (
    "185.220.101.0/24",
    "185.220.100.0/24",
    "45.33.32.0/24",
    "80.82.77.0/24",
    "89.248.167.0/24",
    "209.141.36.0/24",
)

# Country by the leading three or two octets.
COUNTRY_BY_PREFIX = {
    "185.220.101": "DE",
    "185.220.100": "NL",
    "45.33.32": "US",
    "80.82.77": "NL",
    "89.248.167": "NL",
    "209.141.36": "US",
    "8.8": "US",
    "1.1.1": "AU",
    "93.184": "US",
    "151.101": "US",
    "13.32": "US",
    "10.0.0": "INT",
    "192.168.1": "INT",
}

# Own address ranges and destination ports that are never legitimate.
SERVER_NETWORK = "10.0.0.0/24"
EMPLOYEE_NETWORK = "192.168.1.0/24"
PRIVATE_NETWORKS = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")
PRIVATE_PREFIXES = ("10.", "192.168.", *(f"172.{octet}." for octet in range(16, 32)))
WATCHED_PORTS = (23, 445, 1433, 3389, 4444, 5900, 6666, 31337)

UNKNOWN_COUNTRY = "UNKNOWN"

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED_QUAD = rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def ipv4_to_long(ip: Column) -> Column:
    """Numeric address; null for anything that is not a plain dotted quad."""
    octets = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(octets, F.lit(i)).try_cast("bigint")
    return F.when(ip.rlike(_DOTTED_QUAD), number)


def in_networks(number: Column, cidrs: Iterable[str]) -> Column:
    """True where the numeric address lies in one of the networks; null is false.

    Networks of one prefix length share a mask, so the test is one set lookup per distinct
    length, however many networks there are.
    """
    bases_by_mask: dict[int, set[int]] = defaultdict(set)
    for cidr in cidrs:
        net = ipaddress.IPv4Network(cidr, strict=False)
        bases_by_mask[int(net.netmask)].add(int(net.network_address))
    hit = F.lit(False)
    for mask in sorted(bases_by_mask):
        masked = number.bitwiseAND(F.lit(mask).cast("bigint"))
        hit = hit | masked.isin(*sorted(bases_by_mask[mask]))
    return F.coalesce(hit, F.lit(False))


def is_private_text(ip: Column) -> Column:
    """RFC 1918 test on the text form, as the rules apply it (no validity check)."""
    return reduce(or_, (ip.startswith(prefix) for prefix in PRIVATE_PREFIXES))


def country_of(ip: Column, prefixes: Mapping[str, str] = COUNTRY_BY_PREFIX) -> Column:
    """Country by three leading octets, else by two, else UNKNOWN."""
    entries = [F.lit(part) for pair in prefixes.items() for part in pair]
    table = F.create_map(*entries)
    return F.coalesce(
        F.try_element_at(table, F.substring_index(ip, ".", 3)),
        F.try_element_at(table, F.substring_index(ip, ".", 2)),
        F.lit(UNKNOWN_COUNTRY),
    )


def network_class(number: Column) -> Column:
    """server / employee / private / external, or invalid where there is no address."""
    return (
        F.when(number.isNull(), "invalid")
        .when(in_networks(number, [SERVER_NETWORK]), "server")
        .when(in_networks(number, [EMPLOYEE_NETWORK]), "employee")
        .when(in_networks(number, PRIVATE_NETWORKS), "private")
        .otherwise("external")
    )
