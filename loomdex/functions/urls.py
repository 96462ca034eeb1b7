"""URL predicates and normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import any_of, let
from loomdex.functions.text import trim_space

BAD_ESCAPE = r"%(?:[^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?\z)"
CONTROL = r"[\x00-\x1f\x7f]"
HOST_PORT = r"^(?:\[[^\[\]]*\]|[^:\[\] <>\"]*)(?::[0-9]*)?\z"
MEDIA = r"\.(" + "|".join(vocab.MEDIA_EXTENSIONS) + r")(\?|\z)"


def authority(u: Column) -> Column:
    raw = F.regexp_extract(u, r"(?i)^https?://([^/?#]*)", 1)
    return F.regexp_replace(raw, r"^.*@", "")


def parses(u: Column) -> Column:
    """No control characters, no broken escapes outside the query, numeric port."""
    without_query = F.regexp_replace(u, r"\?[^#]*", "")
    return ~u.rlike(CONTROL) & ~without_query.rlike(BAD_ESCAPE) & authority(u).rlike(HOST_PORT)


def is_http(u: Column) -> Column:
    return u.rlike(r"(?i)^https?:")


def is_valid(u: Column) -> Column:
    return F.coalesce(is_http(u) & parses(u), F.lit(False))


def is_media(u: Column) -> Column:
    return F.lower(u).rlike(MEDIA)


def is_service(u: Column) -> Column:
    decoded = F.coalesce(F.try_url_decode(u), u)
    return let(
        decoded, lambda d: any_of(F.contains(d, F.lit(m)) for m in vocab.SERVICE_MARKS)
    )


def host(u: Column) -> Column:
    """Lower-case host name without user, port and IPv6 brackets; empty when absent."""
    name = F.regexp_extract(authority(u), r"^(\[[^\[\]]*\]|[^:]*)", 1)
    return F.lower(F.regexp_replace(name, r"[\[\]]", ""))


def is_local_name(h: Column) -> Column:
    return (h == "localhost") | h.endswith(".localhost")


def host_allowed(h: Column, allowed: Column) -> Column:
    """Empty list allows all; entries match the host itself or any sub-domain."""
    entries = F.transform(allowed, lambda a: F.lower(trim_space(a)))
    return (F.size(allowed) == 0) | F.exists(
        entries, lambda a: (a != "") & ((h == a) | F.endswith(h, F.concat(F.lit("."), a)))
    )


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def _v4_is_public(octets: Column) -> Column:
    a, b = F.get(octets, F.lit(0)), F.get(octets, F.lit(1))
    closed = (
        a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 192) & (b == 168)) | ((a == 172) & b.between(16, 31))
    )
    return ~closed


def _v6_groups(text: Column) -> Column:
    """The eight 16-bit groups of an IPv6 address in any spelling, or null if it does not parse."""
    tail = F.transform(F.split(F.regexp_extract(text, rf"({_V4})\z", 1), r"\."), lambda o: F.lpad(F.hex(o.try_cast("int")), 2, "0"))
    as_hex = F.concat(F.get(tail, F.lit(0)), F.get(tail, F.lit(1)), F.lit(":"), F.get(tail, F.lit(2)), F.get(tail, F.lit(3)))
    plain = F.when(text.rlike(rf":{_V4}\z"), F.concat(F.regexp_replace(text, rf"{_V4}\z", ""), as_hex)).otherwise(text)

    def groups(part: Column) -> Column:
        return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":"))

    def expand(halves: Column) -> Column:
        left, right = groups(F.get(halves, F.lit(0))), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        missing = 8 - F.size(left) - F.size(right)
        fits = F.when(F.size(halves) == 1, missing == 0).otherwise((F.size(halves) == 2) & (missing > 0))
        full = F.concat(left, F.array_repeat(F.lit("0"), missing), right)
        return F.when(fits & F.forall(full, lambda g: g.rlike(r"^[0-9a-fA-F]{1,4}\z")), full)

    return F.transform(let(F.split(plain, "::"), expand), lambda g: F.conv(g, 16, 10).cast("int"))


def _v6_is_public(groups: Column) -> Column:
    def g(i: int) -> Column:
        return F.get(groups, F.lit(i))

    zeros = F.forall(F.slice(groups, 1, 5), lambda x: x == 0)
    mapped = F.array(*(part for i in (6, 7) for part in (F.shiftright(g(i), 8), g(i).bitwiseAND(F.lit(255)))))
    nowhere_or_here = zeros & (g(5) == 0) & (g(6) == 0) & (g(7) <= 1)
    closed = (
        nowhere_or_here | g(0).between(0xFC00, 0xFDFF) | g(0).between(0xFE80, 0xFEBF) | (g(0) >= 0xFF00)
    )
    return F.when(zeros & (g(5) == 0xFFFF), _v4_is_public(mapped)).otherwise(~closed)


def is_public_ip(ip: Column) -> Column:
    """False for loopback, private, link-local, multicast, unspecified and reserved ranges, and for what is no address."""
    v4 = F.transform(F.split(ip, r"\."), lambda o: o.try_cast("int"))
    v6 = let(_v6_groups(ip), lambda g: F.when(g.isNotNull(), _v6_is_public(g)))
    return F.coalesce(F.when(ip.rlike(rf"^{_V4}\z"), _v4_is_public(v4)).when(F.contains(ip, F.lit(":")), v6), F.lit(False))


def reject_reason(u: Column, allowed: Column, resolved: Column, all_public: Column) -> Column:
    """Why a crawl target is refused, or an empty string. `resolved`/`all_public` come from a join."""
    t = trim_space(u)
    h = host(t)
    return (
        F.when(~F.coalesce(parses(t), F.lit(False)), "invalid URL")
        .when(~is_http(t), "unsupported scheme")
        .when(h == "", "missing host")
        .when(is_local_name(h), "local host")
        .when(~host_allowed(h, allowed), "host not allowed")
        .when(~F.coalesce(resolved, F.lit(False)), "host not resolved")
        .when(~F.coalesce(all_public, F.lit(False)), "non-public address")
        .otherwise("")
    )


def normalize(u: Column) -> Column:
    """Trimmed URL without fragment, scheme in lower case."""
    plain = F.regexp_replace(trim_space(u), r"#.*\z", "")
    scheme = F.lower(F.regexp_extract(plain, r"^([A-Za-z]+):", 1))
    return F.when(is_http(plain), F.concat(scheme, F.substring(plain, F.length(scheme) + 1, F.length(plain)))).otherwise(plain)


def sitemap_of(u: Column) -> Column:
    """scheme://host[:port]/sitemap.xml of a seed."""
    n = normalize(u)
    return F.concat(F.regexp_extract(n, r"^(https?://[^/?#]*)", 1), F.lit("/sitemap.xml"))


def fold_dots(path: Column) -> Column:
    """Resolve `.` and `..` path segments."""
    empty = F.expr("cast(array() as array<string>)")

    def step(acc: Column, seg: Column) -> Column:
        return (
            F.when(seg == ".", acc)
            .when((seg == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
            .when(seg == "..", acc)
            .otherwise(F.concat(acc, F.array(seg)))
        )

    folded = F.array_join(F.aggregate(F.split(path, "/"), empty, step), "/")
    closing = path.rlike(r"/\.\.?\z")
    return F.when(closing, F.concat(folded, F.lit("/"))).otherwise(folded)


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link on page `base`, without fragment; empty for in-page links."""
    ref = F.regexp_replace(trim_space(href), r"#.*\z", "")
    origin = F.regexp_extract(base, r"(?i)^(https?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?i)^(https?:)", 1)
    base_path = F.regexp_extract(base, r"(?i)^https?://[^/?#]*([^?#]*)", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_extract(base_path, r"^(.*/)", 1))
    joined = (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(scheme, ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(origin, ref))
        .when(ref == "", F.regexp_replace(base, r"#.*\z", ""))
        .when(F.startswith(ref, F.lit("?")), F.concat(origin, base_path, ref))
        .otherwise(F.concat(origin, folder, ref))
    )

    def folded(u: Column) -> Column:
        site = F.regexp_extract(u, r"(?i)^(https?://[^/?#]*)", 1)
        path = F.regexp_extract(u, r"(?i)^https?://[^/?#]*([^?#]*)", 1)
        query = F.substring(u, F.length(site) + F.length(path) + 1, F.length(u))
        return F.when(path.rlike(r"/\.\.?(?:/|\z)"), F.concat(site, fold_dots(path), query)).otherwise(u)

    return F.when(F.startswith(trim_space(href), F.lit("#")), "").otherwise(let(joined, folded))
