"""Entities and wrappers in column functions, against the standard library."""

import html
import random
from html.entities import html5
from urllib.parse import parse_qs, quote, quote_plus, unquote, urlsplit

from pyspark.sql import functions as F

from promptlake.functions import urls
from promptlake.plans.queries import QUERIES
from promptlake.rules import SOCIAL_HOSTS, WRAPPER_PARAMS


def test_every_name_and_number(spark):
    names = [f"&{n}{end}" for n in html5 for end in ("", ";", "x", "=1", ";;")] + [f"a&{n[:-1]}&{n}b" for n in html5 if n.endswith(";")]
    numbers = [f"&#{n}{end}" for n in [*range(0, 260), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFE, 0x10FFFF, 0x110000, 9999999, 10**9, 10**20] for end in ("", ";", "a")]
    numbers += [f"&#{x}{n:x};" for n in (0, 0x20, 0x80, 0x9F, 0x41, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 1 << 40) for x in "xX"] + ["&#x;", "&#;", "&#", "&#xg", "&#0000065;", "&#x0000000041;", "&#١;"]
    r = random.Random(3)
    bits = ["&", "&amp;", "&amp", "&lt", "&notit;", "&notin;", ";", " ", "#", "&#65", "&" + "x" * 40 + ";", "&" + "a" * 32 + ";", "é", "=", "copy", "&copy=", "\n", "&&", "&lt;&gt"]
    mixed = ["".join(r.choice(bits) for _ in range(r.randint(0, 8))) for _ in range(2000)]
    texts = [*names, *numbers, *mixed, ""]
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", urls.unescaped(F.col("t")).alias("u")).collect()
    assert len(html5) > 2000 and [(texts[x["i"]], x["u"]) for x in out if x["u"] != html.unescape(texts[x["i"]])] == []


def unwrapped(url):
    """Up to three unwraps, one value after the other."""
    plain = html.unescape(url)
    notes = ["html_entity_decoded"] if plain != url else []
    url = plain
    for _ in range(3):
        held = parse_qs(urlsplit(url).query, keep_blank_values=True)
        values = (unquote(html.unescape(v)) for k in WRAPPER_PARAMS for v in held.get(k, ()))
        inner = next((v for v in values if v.startswith(("http://", "https://")) and urlsplit(v).netloc.lower() in SOCIAL_HOSTS), None)
        if not inner or inner == url:
            break
        url = inner
        notes.append("wrapped_target_extracted")
    return url, notes


def test_wrappers(spark):
    r = random.Random(5)

    def link(depth):
        if not depth or r.random() < 0.2:
            return r.choice(["https://www.instagram.com/p/A+b/?igsh=x&v=1", "http://X.com/u/status/1", "https://example.com/a?b=c", "ftp://x.com/", "https://youtu.be/é%zz?t=1", "x.com/a", "", "https://www.facebook.com/l.php?u=", "https://x.com:443/a", "https://x.com/%41%"])
        inner = link(depth - 1)
        coded = r.choice([quote, quote_plus, lambda x: quote(quote(x)), lambda x: x, html.escape, lambda x: quote(html.escape(x))])(inner)
        pair = f"{r.choice([*WRAPPER_PARAMS, 'URL', 'q', 'u%72l', ''])}={coded}"
        more = [pair, *r.sample(["sa=t", "url=", "u=http://no.example/", "&", "to", "r=%68ttps://x.com/late", "link=https%3A%2F%2Fyoutu.be%2Fz%26amp%3Bx", "href=+https://x.com/", "dest=HTTPS://x.com/"], r.randint(0, 3))]
        r.shuffle(more)
        return f"{r.choice(['https://www.google.com/url', 'https://mail.example/x', 'https://www.facebook.com/l.php', 'HTTP://A.b/c#d'])}?{'&'.join(more)}{r.choice(['', '#x'])}"

    links = [link(r.randint(0, 5)) for _ in range(3000)]
    links = [x if r.random() < 0.7 else html.escape(x) for x in links] + [" \thttps://a.b/?u=https://x.com/q", "https://[bad/?u=https://x.com/q"]
    d = urls.unwrap(spark.createDataFrame([(i, x) for i, x in enumerate(links)], "i int, url string").repartition(4), "url")
    got = {x["i"]: (x["target"], x["target_notes"]) for x in d.collect()}
    wrong = [(x, got[i], unwrapped(x)) for i, x in enumerate(links[:-1]) if got[i] != unwrapped(x)]
    assert not wrong, wrong[:3]
    assert got[len(links) - 1] == (links[-1], [])  # brackets that hold no address: left to be rejected
    assert sum(len(n) > 1 for _, n in got.values()) > 200


def test_no_python_in_the_plan(spark):
    plan = QUERIES["u2_wrapped_urls"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
