"""Benchmark decontamination by winnowing.

A window is ten consecutive words of an item (a shorter item is one window).  Of the
hashes of five-word grams, the smallest of every six neighbours is kept; so any ten
shared words share a kept hash.  Fingerprints of documents are joined with those of
the items, and each hit is extended word by word against the item: what counts is
whether whole windows occur, never a hash alone.

Fingerprints and words of the items go to the tasks by broadcast only while the
items have at most ``max_words`` words (64 MB at most in a task).  Beyond that Spark joins
fingerprint rows of documents and items.  A row carries the few words around its gram: a
window with the gram in it reaches at most five words to the left and ten to the right, so
comparing these is exact and no item is needed whole.  Rows of documents are made only
where a bitmap of fixed size over the hashes of all items allows; texts are read once for
the rows and once for the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

WINDOW = 10
GRAM = 5
MAX_WORDS = 2_000_000
#: Binary logarithm of the bits over the hashes of items: 32 MB.
BITMAP = 28
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


class _Hashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def hashed(ws: list[bytes], cache: _Hashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, ws), dtype=np.uint64, count=len(ws))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n consecutive words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    g = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        g = g * _MIX[0] + (h[i : i + m] ^ _MIX[i % 5])
    g ^= g >> np.uint64(29)
    g *= _MIX[1]
    return g ^ (g >> np.uint64(32))


def winnowed(g: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest hash (the last of equal ones) of every ``width`` neighbours; all of fewer are one group."""
    if len(g) == 0:
        return np.empty(0, dtype=np.int64)
    width = min(width, len(g))
    w = np.lib.stride_tricks.sliding_window_view(g[::-1], width)
    return np.unique(len(g) - 1 - (np.argmin(w, axis=1) + np.arange(len(w))))


class Items:
    """A block of items: fingerprints, and for each the places to extend from."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        cache = _Hashes()
        self.short: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
        self.words: list[list[bytes]] = []
        self.names: list[str] = []
        prints: dict[int, list[tuple[int, int]]] = {}
        for name, text in rows:
            ws = words(text)
            if not ws:
                continue
            if len(ws) < WINDOW:
                self.short.setdefault(len(ws), {}).setdefault(tuple(ws), []).append(name)
                continue
            g = grams(hashed(ws, cache), GRAM)
            for p in winnowed(g, WINDOW - GRAM + 1).tolist():
                prints.setdefault(int(g[p]), []).append((len(self.words), p))
            self.words.append(ws)
            self.names.append(name)
        self.prints = prints
        self.sorted = np.array(sorted(prints), dtype=np.uint64)
        self.short_hash = {n: np.unique(np.concatenate([grams(hashed(list(k), cache), n) for k in m])) for n, m in self.short.items()}

    def hits(self, ws: list[bytes], h: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside occurrences of windows, and the items they are from."""
        ranges, found = [], set()
        if len(ws) >= WINDOW and len(self.sorted):
            g = grams(h, GRAM)
            at = winnowed(g, WINDOW - GRAM + 1)
            known = self.sorted[np.minimum(np.searchsorted(self.sorted, g[at]), len(self.sorted) - 1)] == g[at]
            done: dict[tuple[int, int], int] = {}
            for p in at[known].tolist():
                for item, q in self.prints[int(g[p])]:
                    if done.get((item, p - q), -1) > p:
                        continue  # inside a range of the same alignment
                    iw = self.words[item]
                    a, b = 0, 0
                    while a < min(p, q) and ws[p - a - 1] == iw[q - a - 1]:
                        a += 1
                    most = min(len(ws) - p, len(iw) - q)
                    while b < most and ws[p + b] == iw[q + b]:
                        b += 1
                    if a + b >= WINDOW:
                        ranges.append((p - a, p + b))
                        found.add(self.names[item])
                        done[item, p - q] = p + b
        for n, m in self.short.items():
            g = grams(h, n)
            for p in np.flatnonzero(np.isin(g, self.short_hash[n])).tolist():
                if got := m.get(tuple(ws[p : p + n])):
                    ranges.append((p, p + n))
                    found.update(got)
        return ranges, found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _around(ws: list[str], p: int, n: int) -> tuple[list[str], list[str]]:
    """The words before p, nearest first, and those from p on that a window with p's gram can reach; n words of a short item."""
    return ([], ws[p : p + n]) if n else (ws[max(0, p - WINDOW + GRAM) : p][::-1], ws[p : p + WINDOW])


_PRINT = pa.schema([("name", pa.string()), ("p", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])
_PRINT_DDL = "name string, p int, n int, h long, before array<string>, after array<string>"


def _print_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PRINT)], schema=_PRINT)


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each kept gram of each item; the whole of an item too short for a window is one gram (n words)."""
    cache = _Hashes()
    for b in batches:
        rows = []
        for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
            ws = words(text)
            if not ws:
                continue
            n = len(ws) if len(ws) < WINDOW else 0
            g, plain = grams(hashed(ws, cache), n or GRAM), [w.decode() for w in ws]
            rows += [(name, p, n, int(g[p].view(np.int64)), *_around(plain, p, n)) for p in ([0] if n else winnowed(g, WINDOW - GRAM + 1).tolist())]
        yield _print_rows(rows)


def _doc_prints(bitmap, lengths: list[int]):
    """Rows as those of items, where the bitmap has the hash: of kept grams, and of all grams of the lengths of short items."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, cache = bitmap.value, _Hashes()
        for b in batches:
            rows = []
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = words(text)
                h = hashed(ws, cache)
                for n in (0, *lengths):
                    g = grams(h, n or GRAM)
                    at = np.arange(len(g)) if n else winnowed(g, WINDOW - GRAM + 1)
                    k = g[at] >> np.uint64(64 - BITMAP)
                    known = at[(bits[k >> np.uint64(6)] >> (k & np.uint64(63))) & np.uint64(1) == 1]
                    for p in known.tolist():
                        reach = [w.decode() for w in ws[max(0, p - WINDOW) : p + WINDOW]]
                        rows.append((name, p, n, int(g[p].view(np.int64)), *_around(reach, min(p, WINDOW), n)))
                if len(rows) > 50_000:
                    yield _print_rows(rows)
                    rows = []
            yield _print_rows(rows)

    return prints


def _bitmap(prints: DataFrame) -> np.ndarray:
    """2**BITMAP bits, set where a hash of ``prints`` begins so; its size doesn't depend on them."""
    k = F.shiftrightunsigned("h", 64 - BITMAP)
    words_ = prints.select(F.shiftright(k, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITMAP}) & 63 AS int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP - 6), dtype=np.uint64)
    out[words_.column("w").to_numpy()] = words_.column("bits").to_numpy().view(np.uint64)
    return out


def _shared(x, y):
    """How many words two lists begin with in common."""
    first = F.array_position(F.zip_with(x, y, lambda u, v: F.coalesce(u == v, F.lit(False))), False)
    return F.when(first == 0, F.size(x)).otherwise(first - 1).cast("int")


def joined_hits(own: DataFrame, text_col: str, items: DataFrame) -> DataFrame:
    """name (SHA-256 of a text), b_items and b_spans of each text in which windows of ``items`` (name, text) occur."""
    spark = own.sparkSession
    prints = checkpointed(items.mapInArrow(_item_prints, _PRINT_DDL))
    lengths = sorted(r["n"] for r in prints.filter("n > 0").select("n").distinct().collect())  # nine at most
    texts = own.select(F.sha2(text_col, 256).alias("name"), F.col(text_col).alias("text"))
    mine = texts.mapInArrow(_doc_prints(spark.sparkContext.broadcast(_bitmap(prints)), lengths), _PRINT_DDL).dropDuplicates(["name", "p", "n"]).alias("d")
    theirs = prints.select("name", "n", "h", "before", "after").distinct().alias("i")
    both = mine.join(theirs, (F.col("d.h") == F.col("i.h")) & (F.col("d.n") == F.col("i.n")))
    both = both.select("d.name", "d.p", "d.n", F.col("i.name").alias("item"), _shared(F.col("d.before"), F.col("i.before")).alias("a"), _shared(F.col("d.after"), F.col("i.after")).alias("b"))
    hits = both.filter(F.when(F.col("n") > 0, F.col("b") >= F.col("n")).otherwise(F.col("a") + F.col("b") >= WINDOW))
    return hits.groupBy("name").agg(F.collect_set("item").alias("b_items"), F.collect_set(F.struct((F.col("p") - F.col("a")).alias("start"), (F.col("p") + F.col("b")).alias("end"))).alias("b_spans"))


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_SPANS = "array<struct<start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans for each row of ``docs``.

    ``spans`` are the merged ranges of hit words, [start, end).  Null texts have no
    words; items without words have no window; repeated items and documents count
    as rows of their own; an empty benchmark hits nothing.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return matched(own, "text", benchmark, item_col, item_text_col, max_words).drop("text")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with their own columns."""
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = matched(own, f"c{docs.columns.index(text_col)}", benchmark, item_col, item_text_col, max_words).filter(~F.col("contaminated"))
    return kept.select(*own.columns).toDF(*docs.columns)


def matched(own: DataFrame, text_col: str, benchmark: DataFrame, item_col: str, item_text_col: str, max_words: int) -> DataFrame:
    """``own`` with the columns of a result."""
    spark = own.sparkSession
    columns = ", ".join(f"`{k}` {v}" for k, v in own.dtypes)
    fields = f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans {_SPANS}"
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), F.col(item_text_col).alias("text"))
    n_words = items.agg(F.sum(F.floor(F.coalesce(F.length("text"), F.lit(0)) / 2) + 1)).first()[0] or 0  # at most so many
    if n_words <= max_words:
        block = Items([(r["name"], r["text"]) for r in items.toLocalIterator()])
        return own.mapInArrow(_matcher(spark.sparkContext.broadcast(block), text_col), f"{columns}, {fields}")
    hits = joined_hits(own, text_col, items)
    found = own.withColumn("b_name", F.sha2(text_col, 256)).join(hits, F.col("b_name") == hits["name"], "left").select(*own.columns, "b_items", "b_spans")
    return found.mapInArrow(_finish(text_col), f"{columns}, {fields}")


def _with_result(b: pa.RecordBatch, columns: list[str], n_words: list, ranges: list, items: list) -> pa.RecordBatch:
    spans = [merged(r) for r in ranges]
    more = {
        "n_words": pa.array(n_words, pa.int64()),
        "n_hit": pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()),
        "n_items": pa.array([len(i) for i in items], pa.int64()),
        "items_sha256": pa.array([_digest(i) for i in items], pa.string()),
        "contaminated": pa.array([bool(s) for s in spans], pa.bool_()),
        "spans": pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], _SPAN),
    }
    return pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *more.values()], [*columns, *more])


def _matcher(items, text_col: str):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cache = items.value, _Hashes()
        for b in batches:
            n_words, ranges, found = [], [], []
            for text in b.column(text_col).to_pylist():
                ws = words(text)
                r, f = block.hits(ws, hashed(ws, cache))
                n_words.append(len(ws))
                ranges.append(r)
                found.append(f)
            yield _with_result(b, b.schema.names, n_words, ranges, found)

    return match


def _finish(text_col: str):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [c for c in b.schema.names if c not in ("b_items", "b_spans")]
            ranges = [[(s["start"], s["end"]) for s in x or ()] for x in b.column("b_spans").to_pylist()]
            yield _with_result(b, columns, [len(words(t)) for t in b.column(text_col).to_pylist()], ranges, [set(x or ()) for x in b.column("b_items").to_pylist()])

    return finish
