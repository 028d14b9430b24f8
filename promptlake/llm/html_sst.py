"""Main text of web pages by a site style tree.

The DOMs of all pages of a host are merged into one tree: block elements with the same
labels (tag, classes, id) from the root down are one node.  For each node are counted
the presentations it takes (sequences of child labels) and the pages that have each
text below it.  From them come two entropies: of the presentations, and of each
text over the host's pages.  A node is as important as its texts are particular to
few pages and its presentations vary:

    importance = (1 - 0.9^l) * presentation + 0.9^l * content, l = number of presentations
    content    = mean over distinct texts of 1 - log(pages with it) / log(pages of the host)

The trees of all hosts merge into one as well.  A node's importance on its host is drawn
towards that of the same node in the merged tree, as if ``PRIOR`` pages of it had been
seen on the host (a node that no other host has counts as important there): a host with
few pages is judged mostly by what others do, and none is left out.

Branches of low importance on their host are removed from every page, inside articles
too.  Roles that are never the article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, reader comments), by tag, class, id or role, are removed
besides: where their texts are as particular as articles are, the tree can't tell them
apart.  A name alone is a weak sign: branches that a name marks are taken back if they hold most of the page in
article elements, its main element, or (names of layout) most of its text; names are
ignored where nothing else is left.  Of a page with article or main elements the text
is what is left of them, with what main has before the articles, if that is half of
the page's text at least.

Two scans of the pages: one for the counts (aggregated in the tasks, so that one row
a host, node and text is shuffled), one that parses again and removes branches.  The
hosts' lists of branches go to the tasks by broadcast while they are small.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

GAMMA = 0.9
THRESHOLD = 0.3
#: The merged tree counts as much as so many pages of a host.
PRIOR = 5
#: Up to so many removed branches (8 bytes each) are broadcast; beyond, pages are joined with them by a shuffle.
BROADCAST_BRANCHES = 1_000_000
#: Deeper elements have their roles, but are no nodes of the tree (texts times depth would be counted).
MAX_DEPTH = 256

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?>(?:[^<>\"']+|\"[^\"]*\"|'[^']*')*))>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul head template".split()
)
#: An opening tag ends open elements of these, up to a boundary.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
_BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
_NOISE_TAGS = frozenset("nav footer aside form script style noscript template head iframe button select textarea input svg canvas object dialog menu title label fieldset search noembed noframes xmp".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
#: Parts of class and id names, between anything but letters.
_NOISE_NAMES = frozenset(
    "nav navbar navigation menu menus masthead topbar footer sidebar side aside notice notices cookie cookies consent gdpr banner banners ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion form forms newsletter subscribe subscription signup login comment comments commentlist discussion disqus replies reply respond related recommended share sharing social breadcrumb breadcrumbs pagination pager popup modal overlay toolbar widget widgets skip paywall".split()
)
#: Those that layouts also have: they mark no article element.
_LAYOUT_NAMES = frozenset("sidebar side widget widgets form forms social promo promos skip paywall".split())
_MAIN = frozenset(("article", "main"))
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Frame:
    """An open element; ``named`` are those, itself included, that a name marks, ``holders`` the article and main ones."""

    __slots__ = ("tag", "path", "noise", "main", "kids", "counted", "block", "layout", "named", "holders")

    def __init__(self, tag: str, path: int, noise: bool, main: str, counted: bool, top: "_Frame | None" = None, mark: str = ""):
        self.tag, self.path, self.noise, self.main, self.counted = tag, path, noise, main, counted
        self.kids: list[str] = []
        self.block = tag in _BLOCK
        self.layout = mark == "layout"
        # one in so many others adds nothing but memory
        self.named: tuple[_Frame, ...] = top.named if top else ()
        self.holders: tuple[_Frame, ...] = top.holders if top else ()
        if mark and len(self.named) < MAX_DEPTH:
            self.named = (*self.named, self)
        if tag in _MAIN and len(self.holders) < MAX_DEPTH:
            self.holders = (*self.holders, self)


#: A block of text: its parts (text, elements that a name marks around it) and the article and main elements around it.
_Said = tuple[list[tuple[str, tuple[_Frame, ...]]], tuple[_Frame, ...]]


def _taken_back(blocks: list[_Said]) -> set[_Frame]:
    """The elements that names mark, but that hold the article."""
    plain, held, inside = 0, Counter(), Counter()
    for parts, holders in blocks:
        for text, named in parts:
            n = len(text)
            if not named:
                plain += n
                continue
            inside[named] += n
            outer = next((h for h in holders if len(h.named) == len(named)), None)
            if outer:
                held[named, outer.tag == "main"] += n
    taken: set[_Frame] = set()
    clear = any(holders and not named and text.strip() for parts, holders in blocks for text, named in parts)
    # a main element is the page's own; articles are if they are more than what is left (beside another article, only layouts hold them)
    for (named, main), n in held.items():
        if main or (n > plain and n == max(held.values()) and (not clear or all(f.layout for f in named))):
            taken.update(named)
    if not taken and inside and not clear:
        named, n = max(inside.items(), key=lambda x: x[1])
        if n > plain and all(f.layout for f in named):
            taken.update(named)
    return taken


def _chosen(blocks: list[_Said], names: bool) -> str:
    """The text of articles with what main has before them, of main, or of the body: the first with half of what is left."""
    taken = _taken_back(blocks) if names else None
    left: list[tuple[str, bool, bool]] = []
    for parts, holders in blocks:
        text = " ".join("".join(t for t, named in parts if taken is None or not named or taken.issuperset(named)).split())
        if text:
            left.append((text, any(h.tag == "article" for h in holders), any(h.tag == "main" for h in holders)))
    first = next((i for i, x in enumerate(left) if x[1]), -1)
    all_ = sum(len(x[0]) for x in left)
    for some in ([x[0] for i, x in enumerate(left) if x[1] or x[2] and i < first], [x[0] for x in left if x[1] or x[2]]):
        if some and 2 * sum(map(len, some)) >= all_:
            return "\n".join(some)
    return "\n".join(x[0] for x in left)


class Parser:
    """Parses pages; remembers the paths and labels it has met."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.labels: dict[tuple[str, str], tuple[str, bool, bool, str, bool]] = {}

    def _label(self, tag: str, attrs: str) -> tuple[str, bool, bool, str, bool]:
        """The label of an element, whether its role is never the article, whether it is a header, how its names mark it, and whether they call it a header."""
        got = self.labels.get((tag, attrs))
        if got is None:
            names, noise, header, marks, named_header = [], tag in _NOISE_TAGS, tag == "header", set(), False
            for m in _ATTR.finditer(attrs) if attrs else ():
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "role":
                    noise |= value.strip().lower() in _NOISE_ROLES
                elif key == "hidden" and not m[0].lower().startswith("hidden-"):
                    noise = True
                elif key == "aria-hidden":
                    noise |= value.strip().lower() == "true"
                elif key in ("class", "id"):
                    value = re.sub(r"\d+", "N", value)
                    names += sorted(f"{key}={v}" for v in value.split())
                    if tag not in ("html", "body", "main"):
                        parts = _WORD.findall(_CAMEL.sub(" ", value).lower())
                        marks |= _NOISE_NAMES.intersection(parts) - (_LAYOUT_NAMES if tag == "article" else set())
                        named_header |= "header" in parts
            got = " ".join([tag, *names]), noise, header, "layout" if marks and marks <= _LAYOUT_NAMES else "role" if marks else "", named_header
            if len(self.labels) > 50_000:
                self.labels.clear()
            self.labels[tag, attrs] = got
        return got

    def _path(self, parent: int, label: str) -> int:
        got = self.paths.get((parent, label))
        if got is None:
            if len(self.paths) > 200_000:
                self.paths.clear()
            got = self.paths[parent, label] = xxhash.xxh3_64_intdigest(f"{parent} {label}") >> 1
        return got

    def parse(self, page: str, low: frozenset[int] | set[int] = frozenset(), counts: dict | None = None, names: bool = True) -> str:
        """The main text of a page without the branches ``low`` and, with ``names``, those that names mark; ``counts`` gets (path, kind, feature)."""
        stack = [_Frame("#root", 0, False, "", False)]
        blocks: list[_Said] = []
        held: list[str] = []
        marked: list[tuple[_Frame, ...]] = []
        frames_seen: list[_Frame] = []

        def end_block() -> None:
            if held:
                text = " ".join("".join(held).split())
                parts = list(zip(held, marked, strict=True)) if any(marked) else [(text, ())]
                held.clear()
                marked.clear()
                if text:
                    top = stack[-1]
                    if counts is not None:
                        feature = xxhash.xxh3_64_intdigest(text) >> 1
                        for f in stack[:MAX_DEPTH]:
                            if f.counted:
                                counts[f.path, 1, feature] = 1
                    if not top.noise:
                        blocks.append((parts, top.holders))

        def pop_to(depth: int) -> None:
            if any(f.block for f in stack[depth:]):
                end_block()
            del stack[depth:]

        def say(text: str) -> None:
            if text and (counts is not None or not stack[-1].noise):
                held.append(html_lib.unescape(text) if "&" in text else text)
                marked.append(stack[-1].named)

        at, size = 0, len(page)
        while at < size:
            m = _TOKEN.search(page, at)
            if m is None:
                say(page[at:])
                break
            say(page[at : m.start()])
            at = m.end()
            if end := m[1]:
                end = end.lower()
                inline = end not in _BLOCK
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d].tag == end:
                        pop_to(d)
                        break
                    if inline and stack[d].block:
                        break
                continue
            tag = m[2] or m[4]
            if not tag:
                continue  # a comment or declaration
            tag, attrs = tag.lower(), (m[3] if m[2] else m[5]) or ""
            if tag == "br":
                say(" ")
                continue
            block = tag in _BLOCK
            if block:
                for d in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if stack[d].tag == "p":
                        pop_to(d)
                        break
                    if stack[d].block:
                        break
                if stack[-1].tag == "head" and tag != "head":
                    pop_to(len(stack) - 1)
            if tag in _ENDS:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d].tag in _BOUNDS[tag]:
                        break
                    if stack[d].tag in _ENDS[tag]:
                        pop_to(d)
            if block:
                end_block()
            if tag in _VOID:
                continue
            if tag in _RAW:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else size
                continue
            top = stack[-1]
            label, noise, header, mark, named_header = self._label(tag, attrs)
            path = self._path(top.path, label)
            noise |= header and not top.main  # an article's own header has its title
            if named_header and not top.main:
                mark = mark or "role"
            main = "article" if tag == "article" or top.main == "article" else "main" if tag == "main" or top.main == "main" else ""
            # inline elements are part of their block's text
            counted = block and len(stack) < MAX_DEPTH and tag not in ("html", "body", "main", "article")
            if counted and path in low:
                noise = True
            if top.counted:
                top.kids.append(label)
            frame = _Frame(tag, path, noise or top.noise, main if not noise else top.main, counted, top, mark)
            if counts is not None and counted:
                frames_seen.append(frame)
            stack.append(frame)
        end_block()
        if counts is not None:
            for f in frames_seen:
                counts[f.path, 0, xxhash.xxh3_64_intdigest("\n".join(f.kids)) >> 1] = 1
            return ""
        return _chosen(blocks, names)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, path, kind (0 presentation, 1 text, 2 page), feature, pages; summed in the task while it fits."""
    parser, sums = Parser(), Counter()

    def out() -> pa.RecordBatch:
        keys = list(sums)
        columns = [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (1, 2, 3)), pa.array([sums[k] for k in keys], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["host", "path", "kind", "feature", "pages"])

    for b in batches:
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            counts: dict[tuple[int, int, int], int] = {}
            parser.parse(page, counts=counts)
            sums[host, 0, 2, 0] += 1
            for (path, kind, feature) in counts:
                sums[host, path, kind, feature] += 1
            if len(sums) > 300_000:
                yield out()
                sums.clear()
    if sums:
        yield out()


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))


def _importance(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, seen (pages) and importance of each node from ``counts`` (keys, kind, feature, pages, m: the pages of all)."""
    log_m, k = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double")), F.col("pages").cast("double")
    nodes = counts.groupBy(*keys).agg(
        F.max("m").alias("m"),
        F.sum(F.when(F.col("kind") == 0, k)).alias("seen"),
        F.sum(F.when(F.col("kind") == 0, k * F.log(k))).alias("k_log_k"),
        F.count_if(F.col("kind") == 0).alias("l"),
        F.avg(F.when(F.col("kind") == 1, F.greatest(F.lit(0.0), 1 - F.log(k) / log_m))).alias("content"),
    )
    # -sum p log p = log(seen) - sum k log k / seen, in units of log m
    shown = F.least(F.lit(1.0), (F.log("seen") - F.col("k_log_k") / F.col("seen")) / log_m)
    weight = F.pow(F.lit(GAMMA), F.col("l"))
    return nodes.select(*keys, "seen", ((1 - weight) * shown + weight * F.coalesce("content", F.lit(0.0))).alias("importance"))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path and importance of each counted node of the hosts of ``pages`` (host, html)."""
    sums = pages.mapInArrow(_count, "host string, path long, kind long, feature long, pages long").groupBy("host", "path", "kind", "feature").agg(F.sum("pages").alias("pages"))
    sums = checkpointed(sums)
    hosts = sums.filter("kind = 2").select(F.col("host").alias("h"), F.col("pages").alias("m"))
    counts = sums.filter("kind < 2")
    own = _importance(counts.join(hosts, F.col("host") == F.col("h")), ["host", "path"])
    total = hosts.agg(F.sum("m").alias("m"))  # one row
    merged = _importance(counts.groupBy("path", "kind", "feature").agg(F.sum("pages").alias("pages")).join(F.broadcast(total)), ["path"])
    shared = own.groupBy("path").agg(F.count("*").alias("hosts")).filter("hosts > 1").select(F.col("path").alias("s_path"))
    merged = merged.join(shared, F.col("path") == F.col("s_path"), "left_semi").select(F.col("path").alias("m_path"), F.col("importance").alias("elsewhere"))
    both = own.join(merged, F.col("path") == F.col("m_path"), "left")
    drawn = (F.col("seen") * F.col("importance") + PRIOR * F.coalesce("elsewhere", F.lit(1.0))) / (F.col("seen") + PRIOR)
    return both.select("host", "path", drawn.alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser = Parser()
    for b in batches:
        texts = []
        for page, low in zip(b.column("html").to_pylist(), b.column("low").to_pylist(), strict=True):
            text = parser.parse(page, frozenset(low or ()))
            if not text and low:
                text = parser.parse(page)
            texts.append(text or parser.parse(page, names=False))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of ``pages``.

    Null html is an empty page; a null url counts to the host without a name; a page
    of which the tree would leave nothing is taken by its roles alone, and one of which
    names would leave nothing without them; repeated rows each get a row; an empty table
    gives an empty result; other columns don't matter, whatever their names.  Elements
    nested deeper than MAX_DEPTH have their roles, but are no nodes of the tree.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    tree = style_tree(own.select("host", "html"))
    low = checkpointed(tree.filter(F.col("importance") < threshold).groupBy(F.col("host").alias("low_host")).agg(F.array_sort(F.collect_list("path")).alias("low")))
    if low.agg(F.coalesce(F.sum(F.size("low") + 1), F.lit(0))).first()[0] <= BROADCAST_BRANCHES:
        low = F.broadcast(low)
    # else a table of its own: Spark can then split the pages of a large host over several tasks
    joined = own.join(low, F.col("host") == F.col("low_host"), "left").select("page_id", "url", "html", "low")
    return joined.mapInArrow(_extract, f"page_id {dict(own.dtypes)['page_id']}, url string, text string, n_chars long")
