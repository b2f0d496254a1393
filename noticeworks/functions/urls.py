"""Addresses brought to the form in which equal pages have equal text, with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that track or position a visit and select no content.
TRACKING = r"(?:utm_[a-z0-9_]*|spm|from|scm|gclid|fbclid|msclkid|yclid|_ga|isappinstalled|share_[a-z0-9_]*|hmsr|hmpl|hmcu|hmkw|hmci)"
# Escapes that stay escapes when a part is decoded, as their characters have a meaning in an address.
_RESERVED = r"%(2[0-9abcf]|3[abdf]|40|5[bd]|[01][0-9a-f])"


def _decoded(part: Column) -> Column:
    """Escapes of ordinary characters decoded, all others in upper case; malformed parts stay as they are."""
    kept = F.regexp_replace(part, r"(?i)" + _RESERVED, "%25$1")
    decoded = F.try_url_decode(F.regexp_replace(kept, r"\+", "%2B"))
    return F.coalesce(decoded, part)


def same_page_form(url: Column) -> Column:
    """One text per page: scheme and host folded, default port, fragment, closing slash and tracking gone, parameters sorted.

    Null, empty and texts that are no address give null.
    """
    u = F.trim(F.regexp_replace(url, r"[\u0000-  　]+", " "))
    pattern = r"^(?i)(?:https?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    host = F.lower(F.regexp_replace(F.regexp_extract(u, pattern, 1), r"\.$", ""))
    port = F.regexp_extract(u, pattern, 2)
    path = F.regexp_replace(_decoded(F.regexp_extract(u, pattern, 3)), r"/+$", "")
    pairs = F.filter(F.split(F.regexp_extract(u, pattern, 4), "&"), lambda p: (p != "") & ~F.lower(F.regexp_extract(p, r"^([^=]*)", 1)).rlike(rf"^{TRACKING}$"))
    query = F.array_join(F.array_sort(F.transform(pairs, _decoded)), "&")
    text = F.concat(host, F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(u.rlike(pattern), text)


def fingerprint_form(value: Column) -> Column:
    """The 64 hex digits of a fingerprint in lower case, null if it has none."""
    digits = F.lower(F.regexp_extract(value, r"(?<![0-9A-Fa-f])([0-9A-Fa-f]{64})(?![0-9A-Fa-f])", 1))
    return F.when(digits != "", digits)


def host(url: Column) -> Column:
    """The host of an address in lower case, without port; '' if it has none."""
    return F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^(?i)https?://([^/?#:]*)", 1))


# The parameters that a canonical address leaves out.
_DROPPED = ["utm_source", "utm_medium", "utm_campaign", "from", "spm"]


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, closing slashes, fragment and tracking parameters gone, parameters sorted; null gives ''."""
    u = F.trim(F.coalesce(url, F.lit("")))
    scheme, rest = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), r"^[A-Za-z][A-Za-z0-9+.-]*://"
    netloc = F.lower(F.regexp_extract(u, rest + r"([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(u, rest + r"[^/?#]*([^?#]*)", 1), "/+$", "")
    key = lambda p: F.lower(F.regexp_extract(p, "^([^=]*)", 1))
    pairs = F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & ~key(p).isin(_DROPPED))
    coded = lambda p: F.coalesce(F.url_encode(F.try_url_decode(p)), p)
    query = F.array_join(F.array_sort(F.transform(pairs, lambda p: F.concat_ws("=", coded(F.regexp_extract(p, "^([^=]*)", 1)), F.when(p.contains("="), coded(F.regexp_extract(p, "=(.*)$", 1)))))), "&")
    return F.when(u == "", F.lit("")).otherwise(F.concat(scheme, F.lit("://"), netloc, F.when(path == "", F.lit("/")).otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))
