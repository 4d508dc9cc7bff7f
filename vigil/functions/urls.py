"""URL, host and address expressions. All are native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tracking parameters dropped from article URLs.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid")
#: (first address, last address) as 32-bit numbers of ranges that the lookup side treats as not global.
_NOT_GLOBAL = ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
               "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4")
_GLOBAL_INSIDE = ("192.0.0.9/32", "192.0.0.10/32")
#: Ranges that extraction rejects: private, loopback, link-local, multicast, reserved, unspecified.
_NOT_PUBLIC = ("0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/29", "192.0.0.170/31", "192.0.2.0/24", "192.168.0.0/16",
               "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` names it; nested expressions stay linear in size."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _bounds(cidr: str) -> tuple[int, int]:
    address, bits = cidr.split("/")
    first = 0
    for part in address.split("."):
        first = first * 256 + int(part)
    return first, first + (1 << (32 - int(bits))) - 1


def _within(n: Column, ranges: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for a, b in map(_bounds, ranges):
        found = found | n.between(F.lit(a), F.lit(b))
    return found


def url_host(url: Column) -> Column:
    """Host in lower case, without userinfo and port; '' when there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r":[0-9]*$", ""), r"^\[([0-9A-Fa-f:.]+)\]$", "$1"))


def canonical_url(url: Column) -> Column:
    """Comparable article URL: lower scheme and host, port kept, no userinfo, fragment, tracking parameters or trailing slash."""
    full = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
    part = lambda k: F.regexp_extract(url, full, k)
    netloc = F.lower(F.regexp_replace(part(2), r"^.*@", ""))
    netloc = F.when(netloc.rlike(r":\d+$"), netloc).otherwise(F.regexp_replace(netloc, r":[^:\]]*$", ""))
    kept = F.filter(F.split(F.regexp_replace(part(4), r"^\?", ""), "&"), lambda p: (p != "") & ~_is_tracking(p))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    path = F.regexp_replace(part(3), r"/+$", "")
    return F.when(url.rlike(full) & (netloc != ""), F.concat(F.lower(part(1)), F.lit("://"), netloc, path, query)).otherwise(url)


def _is_tracking(pair: Column) -> Column:
    key = F.lower(F.substring_index(pair, "=", 1))
    return key.startswith("utm_") | key.isin(*TRACKING_KEYS)


def whole_url_key(url: Column) -> Column:
    """Trimmed, lower case, no trailing slash."""
    return F.regexp_replace(F.lower(F.trim(url)), r"/+$", "")


def hash_type(value: Column) -> Column:
    """md5, sha1 or sha256 by the number of hex digits, else null."""
    n = F.length(value)
    return F.when(~value.rlike(r"^[0-9A-Fa-f]+$"), None).when(n == 32, "md5").when(n == 40, "sha1").when(n == 64, "sha256")


def undefang(value: Column) -> Column:
    """Written-out dots, colons and schemes as they were, repeated until nothing changes (four passes); a value without any sign of them is left as it is."""
    def restored(v: Column) -> Column:
        out = v
        for _ in range(4):
            out = F.regexp_replace(out, r"(?i)\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\)", ".")
            out = F.regexp_replace(out, r"(?i)^hxxp(s?)(\[:\]|:)", "http$1:")
            out = F.regexp_replace(out, r"\[:\]", ":")
            out = F.regexp_replace(out, r"\[/\]", "/")
        return F.regexp_replace(out, r"\.$", "")

    return let(F.trim(value), lambda v: F.when(v.rlike(r"(?i)[\[({]|^hxxp|\.$"), restored(v)).otherwise(v))


def undefang_steps(value: Column) -> Column:
    """Names of the changes that ``undefang`` makes, in their order."""
    return let(F.trim(value), lambda v: F.array_compact(F.array(
        F.when(v.rlike(r"(?i)\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\)|\[:\]|\[/\]"), "defang"),
        F.when(v.rlike(r"(?i)^hxxps?"), "defang_scheme"), F.when(v.rlike(r"\.$"), "trailing_dot"))))


def defang(value: Column, kind: Column) -> Column:
    """For display: dots of domains and addresses in brackets, URLs with the scheme and host made harmless."""
    dots = F.replace(value, F.lit("."), F.lit("[.]"))
    scheme = F.regexp_replace(F.regexp_extract(value, r"^([A-Za-z]+)://", 1), r"(?i)^http", "hxxp")
    host = F.regexp_extract(value, r"^[A-Za-z]+://([^/?#]*)", 1)
    rest = F.regexp_extract(value, r"^[A-Za-z]+://[^/?#]*(.*)$", 1)
    return F.when(kind.isin("domain", "ip"), dots).when((kind == "url") & (host != ""), F.concat(scheme, F.lit("://"), F.replace(host, F.lit("."), F.lit("[.]")), rest)).otherwise(value)


def ipv4_to_long(value: Column) -> Column:
    """The address as a number; null unless it is four decimal parts of at most 255 without leading zeros."""
    def number(parts: Column) -> Column:
        n = [F.try_element_at(parts, F.lit(k)).try_cast("long") for k in range(1, 5)]
        return F.when(F.greatest(*n) <= 255, n[0] * 16777216 + n[1] * 65536 + n[2] * 256 + n[3])

    return let(value, lambda v: F.when(v.rlike(r"^(0|[1-9]\d{0,2})(\.(0|[1-9]\d{0,2})){3}$"), let(F.split(v, r"\."), number)))


def is_global_number(n: Column) -> Column:
    return ~_within(n, _NOT_GLOBAL) | _within(n, _GLOBAL_INSIDE)


def is_global_ip(value: Column) -> Column:
    """Lookup's test for IPv4: multicast counts as global, shared address space does not; null for other values."""
    return let(ipv4_to_long(value), is_global_number)


def is_public_ip(value: Column) -> Column:
    """Extraction's test for IPv4: shared address space counts as public, multicast does not; null for other values."""
    return let(ipv4_to_long(value), lambda n: ~_within(n, _NOT_PUBLIC))


def detect_type(value: Column) -> Column:
    """cve, md5, sha1, sha256, url, ip, domain, unknown or empty."""
    return let(F.trim(F.coalesce(value, F.lit(""))), lambda v: (
        F.when(v == "", "empty").when(v.rlike(r"(?i)^CVE-\d{4}-\d{4,7}$"), "cve").when(hash_type(v).isNotNull(), hash_type(v))
        .when(v.rlike(r"(?i)^https?://"), "url").when(ipv4_to_long(v).isNotNull() | v.rlike(r"(?i)^\[?[0-9a-f]{0,4}(:[0-9a-f]{0,4}){2,7}(:?[0-9.]{7,15})?\]?$"), "ip")
        .when(v.rlike(r"(?i)^([a-z0-9_]([a-z0-9_-]{0,61}[a-z0-9_])?\.)+([a-z]{2,63}|xn--[a-z0-9-]{2,59})$"), "domain").otherwise("unknown")))


def normalize_indicator(value: Column, kind: Column) -> Column:
    """Comparable form by type: wrappers and end punctuation gone, dots restored, CVE and technique ids upper, hashes and domains lower; addresses keep their case."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(value), r"^[\s`'\"<(\[{]+", ""), r"[\s`'\">)\]},.;:]+$", "")

    def by_kind(v: Column) -> Column:
        netloc = F.lower(F.regexp_replace(F.regexp_extract(v, r"://([^/?#]*)", 1), r"^.*@", ""))
        url = F.concat(F.lower(F.regexp_extract(v, r"^([^:]+)://", 1)), F.lit("://"), netloc, F.regexp_extract(v, r"://[^/?#]*(.*)$", 1))
        return (F.when(kind.isin("cve", "attack_technique"), F.upper(v)).when(kind.isin("md5", "sha1", "sha256", "domain"), F.lower(v))
                .when((kind == "url") & v.rlike("://"), url).otherwise(v))

    return let(undefang(bare), by_kind)


def normalize_observable(value: Column, kind: Column) -> Column:
    """Lookup key of a submitted value: a URL stands for its host, an IPv6 address for its short form, the rest is trimmed, restored and lower-cased."""
    from vigil.functions.addresses import canonical_ip

    v = F.lower(undefang(value))
    host = F.when(kind == "url", url_host(v)).otherwise(v)
    return F.when(host.contains(":"), F.coalesce(canonical_ip(host), host)).otherwise(host)


def host_suffixes(host: Column) -> Column:
    """The host and every parent of it, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def looked_up_host(plain: Column) -> Column:
    """The host that a restored value stands for: a URL's, else the value in lower case."""
    return F.when(plain.rlike(r"(?i)^https?://"), url_host(plain)).otherwise(F.lower(plain))


def judge_guard(value: Column, plain: Column, host: Column, v4: Column, v6: Column) -> Column:
    """``guard_reason`` from its parts: the trimmed value, the restored one, its host, and the host as IPv4 number and IPv6 digits."""
    from vigil.functions.addresses import is_global_digits

    quad = host.rlike(r"^\d+(\.\d+){3}$")
    return (
        F.when(value == "", "empty").when((F.length(value) > 512) | value.rlike(r"[\s\x00-\x1f\x7f]") | (F.size(F.split(host, r"\.")) > 16) | (quad & v4.isNull()), "invalid")
        .when(~F.coalesce(is_global_number(v4), is_global_digits(v6), F.lit(True)), "non_public_ip").when(host.rlike(r"(^|\.)(local|internal|lan|home|corp|localhost|intranet)$"), "internal_name")
        .when(plain.rlike(r"(?i)^https?://[^/?#]*@"), "credentials_in_url"))


def guard_reason(value: Column) -> Column:
    """Why a submitted value is not looked up; null when it is."""
    from vigil.functions.addresses import ipv6_hex

    # the address's two forms are named many times by the ranges, so each is made once
    def parts(v: Column, p: Column, h: Column) -> Column:
        return let(ipv4_to_long(h), lambda n: let(F.when(h.contains(":"), ipv6_hex(h)), lambda d: judge_guard(v, p, h, n, d)))

    return let(F.trim(F.coalesce(value, F.lit(""))), lambda v: let(undefang(v), lambda p: let(looked_up_host(p), lambda h: parts(v, p, h))))


def judge_skip(guard: Column, kind: Column) -> Column:
    """Offline skip reason from the guard's and the type used; safety outranks what the caller called the value."""
    return F.when(guard.isin("non_public_ip", "internal_name", "credentials_in_url", "empty"), guard).when(kind.isin("unknown", "empty"), "unsupported_type")


def skip_reason(value: Column, supplied: Column, detected: Column) -> Column:
    """Offline skip reason; a private address or internal name outranks what the caller called the value."""
    return let(guard_reason(value), lambda g: judge_skip(g, F.coalesce(supplied, detected)))


def clip(text: Column, most: int = 300) -> Column:
    """Squeezed text of at most ``most`` characters, cut between words."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    cut = F.regexp_replace(F.substring(flat, 1, most), r"\s+\S*$", "")
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(cut, F.lit("…")))
