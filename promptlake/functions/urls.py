"""URL canonicalisation (U1-U12) and discovery (M4-M6)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import DROP_PARAMS, KEEP_QUERY, SLASH_HOSTS, SOCIAL_HOSTS, WRAPPER_PARAMS

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?"
SCHEME, NETLOC, PATH, QUERY, FRAGMENT = range(1, 6)


def part(url: Column, which: int) -> Column:
    """A component of a URL, '' where it is missing."""
    return F.regexp_extract(url, _PARTS, which)


def host_of(url: Column) -> Column:
    """The network place in lower case."""
    return F.lower(part(url, NETLOC))


def is_social(host: Column, hosts: tuple[str, ...] = SOCIAL_HOSTS) -> Column:
    return host.isin(list(hosts))


def found_urls(text: Column, hosts: tuple[str, ...] = SOCIAL_HOSTS) -> Column:
    """Distinct social URLs of a text, sorted (M4-M7)."""
    every = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"""(?i)https?://[^\s<>()"']+"""), F.lit(0))
    cut = F.transform(every, lambda u: F.regexp_replace(u, r"""[.,);\]>"']+$""", ""))
    return F.array_sort(F.array_distinct(F.filter(cut, lambda u: is_social(host_of(u), hosts))))


def _let(value: Column, what: Callable[[Column], Column]) -> Column:
    """``what`` of a value that is computed once, and is once in the plan."""
    return F.get(F.transform(F.array(value), what), F.lit(0))


def unescaped(text: Column) -> Column:
    """A text with its HTML character references decoded once, as ``html.unescape`` does.

    The names are the standard library's.  A name that ends in ; is looked up whole; any
    other, or one that isn't known, counts as far as its longest beginning that is a name
    of old, which needs no ;.
    """
    whole = {k: v for k, v in html5.items() if k.endswith(";")}
    old = {k: v for k, v in html5.items() if not k.endswith(";")}
    table = lambda names: F.map_from_arrays(F.split(F.lit("\0".join(names)), "\0"), F.split(F.lit("\0".join(names.values())), "\0"))
    beginning = "^(" + "|".join(sorted(old, key=len, reverse=True)) + ")"

    def named(p: Column) -> Column:
        short = _let(F.regexp_extract(p, beginning, 1), lambda x: F.when(x != "", F.concat(F.try_element_at(table(old), x), F.substr(p, F.length(x) + 1))))
        long = _let(F.regexp_extract(p, r"^[^\t\n\f <&#;]{1,32};", 0), lambda x: F.when(x != "", F.concat(F.try_element_at(table(whole), x), F.substr(p, F.length(x) + 1))))
        return F.coalesce(long, short, F.concat(F.lit("&"), p))

    def decoded(p: Column) -> Column:
        """What follows an ampersand, with the reference that it begins with resolved."""
        return _let(F.regexp_extract(p, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", 0), lambda x: F.when(x != "", F.concat(_character(x), F.substr(p, F.length(x) + 1))).otherwise(named(p)))

    parts = lambda x: F.array_join(F.transform(F.split(x, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")
    return _let(text, lambda x: F.when(x.contains("&"), parts(x)).otherwise(x))


def _character(reference: Column) -> Column:
    """The character of a numeric reference without its ampersand."""
    too_large, replaced = F.lit(1 << 40), F.map_from_arrays(F.split(F.lit(" ".join(map(str, _REPLACED))), " ").cast("array<long>"), F.split(F.lit("\0".join(_REPLACED.values())), "\0"))

    def number(digits: Column) -> Column:
        return F.when(digits == "", F.lit(0)).when(F.length(digits) > 7, too_large).otherwise(F.when(reference.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long"))

    def character(n: Column) -> Column:
        none = n.between(0x1, 0x8) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n == 0xB) | ((n >= 0xFFFE) & (F.pmod(n, F.lit(0x10000)) >= 0xFFFE))
        as_text = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(replaced, n), F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd")).when(none, F.lit("")).otherwise(as_text))

    digits = F.regexp_replace(F.regexp_extract(reference, "^#[xX]?([0-9a-fA-F]+)", 1), "^0+", "")
    return _let(_let(digits, number), character)


#: Numbers of references that stand for other characters (the code page they were written in).
_REPLACED = {0x00: "\ufffd", 0x0D: "\r"} | {0x80 + i: bytes([0x80 + i]).decode("cp1252", "replace") if i not in (1, 13, 15, 16, 29) else chr(0x80 + i) for i in range(32)}


def unquoted(text: Column) -> Column:
    """Percent escapes decoded as UTF-8; what is no escape stays, plus signs too."""
    sound = lambda x: F.regexp_replace(F.replace(x, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return _let(text, lambda x: F.when(x.contains("%"), F.coalesce(F.try_url_decode(sound(x)), x)).otherwise(x))


def _held(url: Column, params: tuple[str, ...], hosts: tuple[str, ...]) -> Column:
    """The social URL that a parameter of ``url`` holds, by priority of the parameters, else null."""
    plain = lambda x: unquoted(F.replace(x, F.lit("+"), F.lit(" ")))
    pair = lambda p: F.struct(plain(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"), F.regexp_extract(p, r"^[^=]*=?([\s\S]*)$", 1).alias("v"))
    of = lambda pairs: F.flatten(F.transform(F.array(*[F.lit(k) for k in params]), lambda k: F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"])))
    host = lambda v: F.lower(part(F.regexp_replace(v, r"[\t\r\n]", ""), NETLOC))
    social = lambda v: (v.startswith("http://") | v.startswith("https://")) & is_social(host(v), hosts)

    def inside(u: Column) -> Column:
        values = F.transform(_let(F.transform(F.filter(F.split(part(u, QUERY), "&"), lambda p: p != ""), pair), of), lambda v: unquoted(unescaped(plain(v))))
        sound = _let(part(u, NETLOC), lambda n: n.contains("[") == n.contains("]"))
        return F.when(sound, F.get(F.filter(values, social), F.lit(0)))

    return _let(F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", ""), inside)


def unwrap(urls: DataFrame, column: str, params: tuple[str, ...] = WRAPPER_PARAMS, hosts: tuple[str, ...] = SOCIAL_HOSTS) -> DataFrame:
    """``urls`` with columns target and target_notes: entities decoded once, wrappers taken off up to three times."""
    # each step is computed once, and only on rows that may have something to take off
    once = lambda d, c, name: d.select("*", F.explode(F.array(c)).alias(name))
    may = lambda c: c.rlike("[?&](?:" + "|".join(params) + ")=|%")
    state = lambda url, n: F.struct(url.alias("url"), n.alias("n"))
    step = lambda was, _: _let(F.coalesce(F.when(may(was["url"]), _held(was["url"], params, hosts)), was["url"]), lambda now: state(now, was["n"] + (now != was["url"]).cast("int")))
    found = once(urls, F.when(F.col(column).contains("&"), unescaped(F.col(column))).otherwise(F.col(column)), "_plain")
    found = once(found, F.aggregate(F.sequence(F.lit(1), F.lit(3)), state(F.col("_plain"), F.lit(0)), step), "_bare")
    notes = F.concat(F.when(F.col("_plain") != F.col(column), F.array(F.lit("html_entity_decoded"))).otherwise(F.array().cast("array<string>")), F.array_repeat(F.lit("wrapped_target_extracted"), F.col("_bare.n")))
    return found.withColumns({"target": F.col("_bare.url"), "target_notes": notes}).drop("_plain", "_bare")


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))


def _encoded(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normal_query(host: Column, query: Column, keep: Mapping[str, tuple[str, ...]] = KEEP_QUERY, drop: tuple[str, ...] = DROP_PARAMS) -> Column:
    """struct<query, notes>: parameters that are kept, grouped by first place, and what was dropped."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(_decoded(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"), _decoded(F.regexp_extract(p, r"^[^=]*=?([\s\S]*)$", 1)).alias("v")),
    )
    allowed = F.lit(None).cast("array<string>")
    for h, names in keep.items():
        allowed = F.when(host == h, F.array(*[F.lit(n) for n in names])).otherwise(allowed)
    allowed = F.coalesce(allowed, F.array().cast("array<string>"))
    stays = lambda k: F.array_contains(allowed, k) & ~F.lower(k).isin(list(drop))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    gone = F.transform(F.filter(names, lambda k: ~stays(k)), lambda k: F.concat(F.lit("drop_param:"), k))
    kept = F.flatten(F.transform(F.filter(names, stays), lambda k: F.filter(pairs, lambda p: p["k"] == k)))
    text = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    changed = F.when((text != "") & (text != query), F.array(F.lit("query_normalized"))).otherwise(F.array().cast("array<string>"))
    return F.struct(text.alias("query"), F.concat(gone, changed).alias("notes"))


def canonical(url: Column, social: tuple[str, ...] = SOCIAL_HOSTS, slash: tuple[str, ...] = SLASH_HOSTS, keep: Mapping[str, tuple[str, ...]] = KEEP_QUERY, drop: tuple[str, ...] = DROP_PARAMS) -> Column:
    """struct<normalized_url, notes> of an unwrapped URL, null if it has brackets that don't match."""
    u = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme = F.lower(part(u, SCHEME))
    scheme = F.when(scheme == "", "https").otherwise(scheme)
    raw_host = host_of(u)
    port = ((scheme == "https") & raw_host.endswith(":443")) | ((scheme == "http") & raw_host.endswith(":80"))
    host = F.when(port, F.regexp_replace(raw_host, r":\d+$", "")).otherwise(raw_host)
    path = F.regexp_replace(F.regexp_replace(part(u, PATH), r";[^/]*$", ""), "/+", "/")
    path = F.when(path.isin("", "/"), "/").when(host.isin(list(slash)), F.concat(F.regexp_replace(path, "/$", ""), F.lit("/"))).otherwise(F.regexp_replace(path, "/$", ""))
    query = normal_query(host, part(u, QUERY), keep, drop)
    secure = is_social(host, social) & (scheme != "https")
    note = lambda when, name: F.when(when, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    notes = F.concat(note(port, "drop_default_port"), query["notes"], note(part(u, FRAGMENT) != "", "drop_fragment"), note(secure, "force_https"))
    out = F.concat(
        F.when(secure, "https").otherwise(scheme),
        F.when((host == "") & ~path.startswith("/"), ":").otherwise("://"),
        host,
        path,
        F.when(query["query"] != "", F.concat(F.lit("?"), query["query"])).otherwise(""),
    )
    return F.when(raw_host.contains("[") == raw_host.contains("]"), F.struct(out.alias("normalized_url"), F.array_distinct(notes).alias("notes")))


def normalize(queue: DataFrame, column: str = "url", **how) -> DataFrame:
    """``queue`` with normalized_url and normalization_notes."""
    both = unwrap(queue.filter(F.trim(F.coalesce(F.col(column), F.lit(""))) != "").withColumn("_u", F.trim(column)), "_u", hosts=how.get("social", SOCIAL_HOSTS))
    # a generator is computed once; filters on what follows would else repeat the whole expression
    c = both.select("*", F.explode(F.array(canonical(F.col("target"), **how))).alias("_c"))
    return c.withColumn("normalized_url", F.col("_c.normalized_url")).withColumn("normalization_notes", F.array_distinct(F.concat("target_notes", F.coalesce("_c.notes", F.array(F.lit("unparsable")))))).drop("_u", "_c", "target", "target_notes")
