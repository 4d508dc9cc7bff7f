"""IPv6 address expressions. All are native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.urls import ipv4_to_long, is_global_ip, is_global_number, is_public_ip, let

# Address ranges as prefixes of the 32 hex digits; those that are not reachable, and the reachable ones inside them.
_NOT_GLOBAL = r"^(?:0{31}1|0{32}|0064ff9b0001|01000{12}|20010[01]|20010db8|2002|f[cd]|fe[89ab])"
_GLOBAL_INSIDE = r"^(?:200100010{23}[12]|20010003|200100040112|2001002|2001003)"
_PRIVATE = r"^(?:20010[01]|20010db8|2002|3fff0)"
#: Global unicast space; all other first digits are reserved, link-local, private or multicast.
_UNICAST = r"^[23]"


def ipv6_hex(value: Column) -> Column:
    """The address as 32 hex digits; null unless it is a valid IPv6 address (brackets and a dotted end are allowed)."""
    def groups(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))

    def whole(halves: Column) -> Column:
        left, right = groups(F.get(halves, F.lit(0))), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        missing = 8 - F.size(left) - F.size(right)
        filled = F.concat(left, F.when(missing > 0, F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>")), right)
        fits = F.when(F.size(halves) == 2, missing >= 1).otherwise((F.size(halves) == 1) & (missing == 0))
        return F.when(fits & F.forall(filled, lambda g: g.rlike(r"^[0-9a-f]{1,4}$")), F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))

    def dotted_end(text: Column) -> Column:
        """::ffff:1.2.3.4 with its last four bytes as two groups."""
        number = ipv4_to_long(F.regexp_extract(text, r"([0-9.]+)$", 1))
        last = F.concat_ws(":", F.lower(F.hex((number / 65536).cast("long"))), F.lower(F.hex(number % 65536)))
        return F.when(text.rlike(r":[0-9]+\.[0-9.]+$"), F.when(number.isNotNull(), F.concat(F.regexp_extract(text, r"^(.*:)[0-9.]+$", 1), last))).otherwise(text)

    plain = F.regexp_replace(F.lower(F.trim(value)), r"^\[|\]$", "")
    return let(dotted_end(plain), lambda t: F.when(t.rlike(r"^[0-9a-f:]+$") & t.contains(":"), let(F.split(t, "::"), whole)))


def canonical_ipv6(digits: Column) -> Column:
    """The short form of 32 hex digits: no leading zeros, the first longest run of two or more zero groups as ``::``."""
    joined = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substr(digits, 4 * i + 1, F.lit(4)), r"^0{1,3}", "")), ":")

    def shorten(t: Column) -> Column:
        out = t
        for more in range(1, 8):  # the longest run is tried first, so it stands outermost
            run = rf"^(?:(.*?):)??0(?::0){{{more}}}(?::(.*))?$"
            out = F.when(t.rlike(run), F.regexp_replace(t, run, "$1::$2")).otherwise(out)
        return out

    return let(joined, shorten)


def canonical_ip(value: Column) -> Column:
    """IPv4 as it is, IPv6 in its short form; null for anything else."""
    return let(F.trim(value), lambda v: F.when(ipv4_to_long(v).isNotNull(), v).otherwise(let(ipv6_hex(v), lambda d: F.when(d.isNotNull(), canonical_ipv6(d)))))


def is_global_digits(digits: Column) -> Column:
    """Lookup's test for 32 hex digits; an IPv4 address inside (::ffff:0:0/96) has its own result. Null for null."""
    inner = F.when(digits.rlike("^0{20}ffff"), F.conv(F.substring(digits, 25, 8), 16, 10).cast("long"))
    return F.coalesce(let(inner, is_global_number), ~digits.rlike(_NOT_GLOBAL) | digits.rlike(_GLOBAL_INSIDE))


def is_global_address(value: Column) -> Column:
    """Lookup's test for both families; null for other values."""
    return F.coalesce(is_global_ip(value), let(ipv6_hex(value), is_global_digits))


def is_public_address(value: Column) -> Column:
    """Extraction's test for both families; null for other values."""
    return F.coalesce(is_public_ip(value), let(ipv6_hex(value), lambda d: d.rlike(_UNICAST) & (~d.rlike(_PRIVATE) | d.rlike(_GLOBAL_INSIDE))))
