"""Addresses that outside links must not reach, as native predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Fixed values on dotted quads. Not public: 0/8, 10/8, 127/8, 169.254/16, 172.16/12,
# 192.0.0/24, 192.0.2/24, 192.168/16, 198.18/15, 198.51.100/24, 203.0.113/24, 224/4 and
# 240/4; 192.0.0.9 and 192.0.0.10 are public.
BLOCKED_IPV4 = (
    r"^(0|10|127|22[4-9]|2[345]\d)\.|^169\.254\.|^172\.(1[6-9]|2\d|3[01])\.|^192\.(168|0\.[02])\."
    r"|^198\.(1[89]|51\.100)\.|^203\.0\.113\."
)
PUBLIC_IPV4_HOLES = r"^192\.0\.0\.(9|10)$"

# Fixed values over the 32 hex digits of an IPv6 address: it is public only inside
# 2000::/3 and fec0::/10, less 2001::/23, 2001:db8::/32 and 2002::/16, of which
# 2001:1::1, 2001:1::2, 2001:3::/32, 2001:4:112::/48 and 2001:20::/27 are public.
PUBLIC_IPV6 = "^([23]|fe[c-f])"
BLOCKED_IPV6 = "^(20010[01]|20010db8|2002)"
PUBLIC_IPV6_HOLES = "^(200100010{23}[12]$|20010003|200100040112|2001002|2001003)"

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_QUAD = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ipv4_number(ip: Column) -> Column:
    """A dotted quad as a bigint, null for anything else (leading zeros included)."""
    octets = F.split(ip, r"\.")
    value = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, octet: acc * 256 + octet.try_cast("bigint"))
    return F.when(ip.rlike(_QUAD), value)


def blocked_ipv4(ip: Column) -> Column:
    return ip.rlike(_QUAD) & ip.rlike(BLOCKED_IPV4) & ~ip.rlike(PUBLIC_IPV4_HOLES)


def _hex_tail(text: Column) -> Column:
    """The text with a dotted-quad tail written as two hex groups."""
    tail = F.regexp_extract(text, r":(\d[\d.]*\.[\d.]*)$", 1)
    as_hex = let(ipv4_number(tail), lambda n: F.lower(F.concat(
        F.hex(F.shiftright(n, 16)), F.lit(":"), F.hex(n.bitwiseAND(F.lit(65535)))
    )))
    return F.when(tail == "", text).otherwise(F.concat(F.regexp_replace(text, r"[^:]*$", ""), as_hex))


def _fill(sides: Column) -> Column:
    """Groups left and right of '::' with the zeros between them put in."""
    part = lambda side: F.filter(F.split(side, ":", -1), lambda g: side != "")
    halves = F.transform(sides, part)
    gap = F.lit(8) - F.size(F.flatten(halves))
    zeros = F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0)))
    return F.when(F.size(sides) == 1, F.flatten(halves)).when(
        (F.size(sides) == 2) & (gap >= 1), F.concat(F.get(halves, F.lit(0)), zeros, F.get(halves, F.lit(1)))
    )


def ipv6_digits(ip: Column) -> Column:
    """The 32 hex digits of an IPv6 text, null for anything else."""
    text = F.lower(F.regexp_replace(ip, r"%[^%]+$", ""))
    groups = let(F.split(_hex_tail(text), "::", -1), _fill)
    return let(groups, lambda filled: F.when(
        (F.size(filled) == 8) & F.forall(filled, lambda g: g.rlike("^[0-9a-f]{1,4}$")),
        F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""),
    ))


def blocked_ipv6(ip: Column) -> Column:
    return let(ipv6_digits(ip), lambda d: F.coalesce(
        ~(d.rlike(PUBLIC_IPV6) & ~(d.rlike(BLOCKED_IPV6) & ~d.rlike(PUBLIC_IPV6_HOLES))), F.lit(False)
    ))


def blocked_ip(ip: Column | str) -> Column:
    """True for private, loopback, link-local, reserved, multicast and unspecified
    addresses; false for public ones and for text that is no address."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    verdict = let(ip, lambda a: F.when(a.contains(":"), blocked_ipv6(a)).otherwise(blocked_ipv4(a)))
    return F.coalesce(verdict, F.lit(False))
