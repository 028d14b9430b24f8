"""Exact Jaccard self-join of word-shingle sets, by prefix filters under several token orders.

1. Inverted index.  Tasks turn texts into sets of hashed shingles, named by a hash
   of the whole set (so copies are one set).  Packed (token, set) postings are
   shuffled once by token; a task finds how many sets have each token and returns
   to each set only the tokens that another set has too.  A set with fewer than
   80 % such tokens has no partner and goes.  (A token is 40 bits of its hash and its
   range, so ids grow with the number of ranges.)
2. Blocks.  The sets left are grouped into blocks of bounded tokens, near ones
   together: by their most frequent token, large groups split by a hash.
3. Candidates.  Under every order of tokens, two sets with a Jaccard similarity of at
   least t share a token among the first n - ceil(t n) + 1 of each.  The first order
   goes by frequency, the rarest first; the next two by hashes of their own, tokens of
   very many sets after all others; the last by a hash alone (after the tokens of one
   set only).  Two blocks meet if prefixes of theirs share a token under each of the
   first three orders (tokens of very many sets hardly get into those); in them, a pair is
   verified if it passes the filters of all orders, the size filter, and isn't in one
   component already.
4. Two rounds.  In the first, a block meets itself and the first block that has a prefix
   token, if they share FIRST_ROUND such tokens: that finds most links of large groups
   in linear work, and leaves chance meetings to the second.  The second takes
   components as blocks and compares what is still in different components.
   Blocks send back only links that join something.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, settled, shuffle_parts, text_of
from .components import components

SHINGLE = 5
PERCENT = 80
#: Orders of tokens, and those of them by which blocks meet.
ORDERS, BLOCK_ORDERS = 4, 3
FIRST_ROUND = 32
#: Tokens of a block, and of what a task packs at once.
BLOCK_TOKENS = 1 << 16
FLUSH_TOKENS = 1 << 20
#: Up to so many copies (some 40 bytes each) are broadcast to drop them; beyond, documents are joined with them by a shuffle.
BROADCAST_ROWS = 500_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def _mixed(g: np.ndarray) -> np.ndarray:
    g = (g ^ (g >> np.uint64(31))) * _ODD[1]
    g = (g ^ (g >> np.uint64(29))) * _ODD[2]
    return g ^ (g >> np.uint64(32))


def shingle_set(text: str | None, cache: _Hashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole text is one if it has fewer words."""
    ws = text.encode().lower().split() if text else []
    if not ws:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(cache.__getitem__, ws), dtype=np.uint64, count=len(ws))
    m = max(1, len(h) - SHINGLE + 1)
    g = np.full(m, len(ws) if len(ws) < SHINGLE else 0, dtype=np.uint64)
    for i in range(min(SHINGLE, len(h))):
        g = g * _ODD[0] + (h[i : i + m] ^ _ODD[i])
    return np.unique(_mixed(g))


def _name(s: np.ndarray) -> int:
    h = (int(np.bitwise_xor.reduce(_mixed(s + _ODD[3]))) ^ len(s)) if len(s) else 0
    return h - (1 << 64) if h >> 63 else h


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a, dtype=np.uint64).view(np.int64)


_PACKED = "part int, doc_id {}, n int, name long, packed binary"


_NAMES = ["part", "doc_id", "n", "name", "packed"]


def _packed_rows(rows: list[tuple[int, bytes]], ids: pa.DataType) -> pa.RecordBatch:
    k = len(rows)
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.nulls(k, ids), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.array([b for _, b in rows], pa.binary())], _NAMES)


def _index_map(n_parts: int):
    """Texts to document rows (part -1) and packed postings by token range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        held: list[np.ndarray] = []
        names: list[int] = []
        total = 0

        def flush(ids: pa.DataType) -> pa.RecordBatch:
            tok, doc = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint32), [len(s) for s in held])
            part = _part(tok, n_parts)
            order = np.argsort(part, kind="stable")
            tok, doc, part = tok[order], doc[order], part[order]
            keys = np.array(names, dtype=np.int64)
            rows, cuts = [], np.searchsorted(part, np.arange(n_parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                s = slice(int(cuts[p]), int(cuts[p + 1]))
                first = np.flatnonzero(np.r_[True, doc[s][1:] != doc[s][:-1]])
                low = tok[s].view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((p, _packed(keys[doc[s][first]], first, s.stop - s.start, low.tobytes())))
            return _packed_rows(rows, ids)

        for b in batches:
            for at in range(0, b.num_rows, 512):
                c = b.slice(at, 512)
                ids, own, sizes = b.schema.field("doc_id").type, [], []
                for text in c.column("text").to_pylist():
                    s = shingle_set(text, cache)
                    name = _name(s)
                    own.append(name)
                    sizes.append(len(s))
                    if len(s):
                        held.append(s)
                        names.append(name)
                        total += len(s)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.int32()), c.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(own, pa.int64()), pa.nulls(len(own), pa.binary())], _NAMES)
                if total >= FLUSH_TOKENS:
                    yield flush(ids)
                    held, names, total = [], [], 0
        if held:
            yield flush(ids)

    return run


def _part(tok: np.ndarray, n_parts: int) -> np.ndarray:
    """The token range of each token, by its 24 high bits."""
    return (((tok >> np.uint64(40)) * np.uint64(n_parts)) >> np.uint64(24)).astype(np.int32)


def _packed(names: np.ndarray, first: np.ndarray, m: int, rest: bytes) -> bytes:
    """Names with the numbers of their postings (which come name by name), then ``rest``."""
    counts = np.diff(np.r_[first, m]).astype(np.uint32)
    wide = counts.max() > 255
    head = np.array([len(names), m, wide], dtype=np.int64)
    return head.tobytes() + names.tobytes() + (counts if wide else counts.astype(np.uint8)).tobytes() + rest


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The names, the counts, the number of postings, and where the rest begins."""
    k, m, wide = (int(x) for x in np.frombuffer(blob, np.int64, 3))
    kind = np.dtype(np.uint32 if wide else np.uint8)
    return np.frombuffer(blob, np.int64, k, 24), np.frombuffer(blob, kind, k, 24 + 8 * k), m, 24 + (8 + kind.itemsize) * k


def frequency_class(df: np.ndarray) -> np.ndarray:
    """One byte that grows with the frequency: exact below 200."""
    return np.where(df < 200, df, 200 + np.minimum(55, np.log2(np.maximum(df, 200) / 200) * 4)).astype(np.uint8)


def _index_reduce(n_parts: int):
    """Postings of token ranges to the postings of tokens of two sets or more, by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[bytes]] = {}
        for b in batches:
            is_doc = pc.is_null(b.column("part"))
            if pc.any(is_doc).as_py():
                yield b.filter(is_doc)
            ids, is_packed = b.schema.field("doc_id").type, b.filter(pc.invert(is_doc))
            for p, blob in zip(is_packed.column("part").to_pylist(), is_packed.column("packed").to_pylist(), strict=True):
                by_part.setdefault(p, []).append(blob)
        while by_part:
            p, blobs = by_part.popitem()
            names, index, low, base = [], [], [], 0
            for blob in blobs:
                own, counts, m, at = _opened(blob)
                names.append(own)
                index.append(np.repeat(np.arange(base, base + len(own), dtype=np.uint32), counts))
                base += len(own)
                t = np.zeros((m, 8), dtype=np.uint8)
                t[:, :5] = np.frombuffer(blob, np.uint8, 5 * m, at).reshape(-1, 5)
                low.append(t.view(np.uint64).reshape(-1))
            names, index, tok = np.concatenate(names), np.concatenate(index), np.concatenate(low)
            del blobs, low
            order = np.argsort(tok)
            tok = tok[order]
            same = tok[1:] == tok[:-1]
            some = np.r_[False, same] | np.r_[same, False]
            tok, name = tok[some], names[index[order[some]]]
            order = np.lexsort((name, tok))
            tok, name = tok[order], name[order]
            if not len(tok):
                continue
            new = np.r_[True, (tok[1:] != tok[:-1]) | (name[1:] != name[:-1])]  # copies of a set have its name
            tok, name = tok[new], name[new]
            start = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
            times = np.diff(np.r_[start, len(tok)])
            df = np.repeat(times, times)
            keep = df >= 2
            tok, name, df = tok[keep] | (np.uint64(p) << np.uint64(40)), name[keep], frequency_class(df[keep])
            part = np.mod(name, n_parts)
            order = np.lexsort((name, part))
            tok, name, df, part = tok[order], name[order], df[order], part[order]
            cuts, rows = np.searchsorted(part, np.arange(n_parts + 1)), []
            for q in np.flatnonzero(np.diff(cuts)).tolist():
                s = slice(int(cuts[q]), int(cuts[q + 1]))
                first = np.flatnonzero(np.r_[True, name[s][1:] != name[s][:-1]])
                rows.append((q, _packed(name[s][first], first, s.stop - s.start, tok[s].tobytes() + df[s].tobytes())))
            yield _packed_rows(rows, ids)

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared tokens of each set together; sets with too few of them go."""
    parts, known, sizes = [], [], []
    for b in batches:
        is_doc = pc.is_null(b.column("packed"))
        docs = b.filter(is_doc)
        known.append(docs.column("name").to_numpy())
        sizes.append(docs.column("n").to_numpy())
        for blob in b.column("packed").drop_null().to_pylist():
            own, counts, m, at = _opened(blob)
            parts.append((np.repeat(own, counts), np.frombuffer(blob, np.uint64, m, at), np.frombuffer(blob, np.uint8, m, at + 8 * m)))
    if not parts:
        return
    name, tok, df = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    known, first = np.unique(np.concatenate(known), return_index=True)
    sizes = np.concatenate(sizes)[first]
    order = np.lexsort((tok, name))
    name, tok, df = name[order], tok[order], df[order]
    start = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    stop = np.r_[start[1:], len(name)]
    size = sizes[np.searchsorted(known, name[start])].astype(np.int64)
    good = np.flatnonzero(100 * (stop - start) >= PERCENT * size)
    for i in range(0, len(good), 1000):
        rows = []
        for g in good[i : i + 1000].tolist():
            a, b = int(start[g]), int(stop[g])
            top = tok[a:b][df[a:b] == df[a:b].max()]
            rows.append((int(name[a]), int(size[g]), b - a, int(top[np.argmin(_mixed(top))]), tok[a:b].tobytes(), df[a:b].tobytes()))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["name", "n", "m", "top", "tok", "df"])


class Block:
    """The sets of a block, unpacked."""

    def __init__(self, rows, orders: int = ORDERS):
        self.name = np.array([r["name"] for r in rows], dtype=np.int64)
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.comp = np.array([r["comp"] for r in rows], dtype=np.int64)
        self.tok = [np.frombuffer(r["tok"], np.uint64) for r in rows]
        self.df = [np.frombuffer(r["df"], np.uint8) for r in rows]
        self.prefix = [[_prefix(t, d, int(n), k) for t, d, n in zip(self.tok, self.df, self.n, strict=True)] for k in range(orders)]


#: Frequency from which a token goes to the second band of the middle orders.
_COMMON = 128


def _prefix(tok: np.ndarray, df: np.ndarray, n: int, k: int) -> np.ndarray:
    """The shared tokens among the first n - ceil(t n) + 1 under order k; tokens of one set alone come first of all."""
    length = n - -(-PERCENT * n // 100) + 1 - (n - len(tok))
    h = _mixed(tok ^ _ODD[k])
    if k == 0:
        order = np.lexsort((h, df))
    elif k < BLOCK_ORDERS:
        order = np.lexsort((h, df >= _COMMON))
    else:
        order = np.argsort(h)
    return tok[order[:length]]


def _counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices, some columns at a time."""
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    a, b = np.concatenate(x), np.concatenate(y)
    common = np.intersect1d(a, b)
    if not len(common):
        return out
    place = lambda t: np.minimum(np.searchsorted(common, t), len(common) - 1)
    ra, rb = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    ca, cb = place(a), place(b)
    ia, ib = common[ca] == a, common[cb] == b
    ra, ca, rb, cb = ra[ia], ca[ia], rb[ib], cb[ib]
    for lo in range(0, len(common), 1 << 13):
        w = min(1 << 13, len(common) - lo)
        ma, mb = np.zeros((len(x), w), dtype=np.float32), np.zeros((len(y), w), dtype=np.float32)
        ina, inb = (ca >= lo) & (ca < lo + w), (cb >= lo) & (cb < lo + w)
        ma[ra[ina], ca[ina] - lo] = 1
        mb[rb[inb], cb[inb] - lo] = 1
        out += ma @ mb.T
    return out


def joining_links(x: Block, y: Block | None) -> list[tuple[int, int]]:
    """Links between sets of different components, without those that close a ring. y None: within x."""
    other = x if y is None else y
    if not len(x.name) or not len(other.name):
        return []
    ok = (100 * x.n[:, None] >= PERCENT * other.n[None, :]) & (100 * other.n[None, :] >= PERCENT * x.n[:, None]) & (x.comp[:, None] != other.comp[None, :])
    if y is None:
        ok = np.triu(ok, 1)
    for k in range(ORDERS):
        if not ok.any():
            return []
        rows, cols = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
        hit = np.zeros_like(ok)
        hit[np.ix_(rows, cols)] = _counts([x.prefix[k][i] for i in rows], [other.prefix[k][j] for j in cols]) > 0
        ok &= hit
    if not ok.any():
        return []
    rows, cols = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
    both = _counts([x.tok[i] for i in rows], [other.tok[j] for j in cols]).astype(np.int64)
    near = ok[np.ix_(rows, cols)] & (100 * both >= PERCENT * (x.n[rows][:, None] + other.n[cols][None, :] - both))
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (p := parent.get(v, v)) != v:
            parent[v] = parent.get(p, p)
            v = p
        return v

    out = []
    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = int(rows[i]), int(cols[j])
        ra, rb = root(int(x.comp[a])), root(int(other.comp[b]))
        if ra != rb:
            parent[ra] = rb
            out.append((int(x.name[a]), int(other.name[b])))
    return out


_LINKS = "a long, b long"


def _within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([p for rows in b["sets"] for p in joining_links(Block(rows), None)], columns=["a", "b"], dtype=np.int64)


def _between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([p for x, y in zip(b["x"], b["y"], strict=True) for p in joining_links(Block(x), Block(y))], columns=["a", "b"], dtype=np.int64)


def _prefix_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct prefix tokens of a block under the first orders; pure: the component if it has only one."""
    for b in batches:
        for blk, rows in zip(b["blk"], b["sets"], strict=True):
            x = Block(rows, BLOCK_ORDERS)
            pure = int(x.comp[0]) if (x.comp == x.comp[0]).all() else None
            for k, sets in enumerate(x.prefix):
                t = np.unique(np.concatenate(sets))
                yield pd.DataFrame({"ord": k, "token": _signed(t), "blk": blk, "pure": pd.Series([pure] * len(t), dtype="Int64")})


def _blocked(sets: DataFrame) -> DataFrame:
    """``sets`` (with comp and group) in blocks: blk, sets."""
    sizes = sets.groupBy("group").agg(F.sum("m").alias("total"))
    split = F.pmod(F.xxhash64("name"), F.greatest(F.ceil(F.col("total") / BLOCK_TOKENS), F.lit(1)))
    b = sets.join(sizes, "group").withColumn("blk", F.xxhash64("group", split))
    return b.groupBy("blk").agg(F.collect_list(F.struct("name", "n", "comp", "tok", "df")).alias("sets"))


def _links(blocks: DataFrame, all_pairs: bool) -> DataFrame:
    """Joining links within ``blocks`` (a checkpoint, released here), and between each block and one other for each token or, at last, all that share one."""
    tokens = blocks.mapInPandas(_prefix_tokens, "ord int, token long, blk long, pure long")
    if all_pairs:
        tokens = settled(tokens)
        groups = tokens.groupBy("ord", "token").agg(F.min("blk").alias("lo"), F.max("blk").alias("hi"), F.max(F.col("pure").isNull()).alias("mixed"), F.min("pure").alias("p"), F.max("pure").alias("q"))
        groups = groups.filter("lo <> hi and (mixed or p <> q)").select("ord", "token")
        t = tokens.join(groups, ["ord", "token"])
        x, y = t.alias("x"), t.alias("y")
        same = F.coalesce(F.col("x.pure") == F.col("y.pure"), F.lit(False))
        pairs = x.join(y, (F.col("x.ord") == F.col("y.ord")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.blk") < F.col("y.blk")) & ~same)
        pairs = pairs.groupBy(F.col("x.blk").alias("bx"), F.col("y.blk").alias("by")).agg(F.count_distinct(F.col("x.ord")).alias("orders")).filter(F.col("orders") == BLOCK_ORDERS)
    else:
        first = tokens.filter("ord = 0")
        hub = first.groupBy("token").agg(F.min("blk").alias("bx"), F.max("blk").alias("hi")).filter("bx <> hi").select("token", "bx")
        pairs = first.join(hub, "token").filter("blk <> bx").groupBy("bx", F.col("blk").alias("by")).agg(F.count("*").alias("n")).filter(F.col("n") >= FIRST_ROUND)
    met = pairs.select("bx", "by").join(blocks.select(F.col("blk").alias("bx"), F.col("sets").alias("x")), "bx").join(blocks.select(F.col("blk").alias("by"), F.col("sets").alias("y")), "by")
    within = blocks.mapInPandas(_within, _LINKS)
    links = settled(within.union(met.select("x", "y").mapInPandas(_between, _LINKS)))
    released(blocks, *([tokens] if all_pairs else []))
    return links


def linked_sets(sets: DataFrame) -> DataFrame:
    """(node, root) of the components of ``sets`` (name, n, m, top, tok, df; a checkpoint, released here)."""
    first = _links(settled(_blocked(sets.withColumn("comp", F.col("name")).withColumn("group", F.col("top")))), all_pairs=False)
    near = components(first)
    root = F.coalesce(F.col("root"), F.col("name"))
    sizes = near.select("root").distinct().withColumn("many", F.lit(True)).withColumnRenamed("root", "r")
    second = sets.join(near, sets["name"] == near["node"], "left").withColumn("comp", root).join(sizes, F.col("comp") == F.col("r"), "left")
    second = second.withColumn("group", F.when(F.col("many"), F.col("comp")).otherwise(F.col("top"))).drop("node", "root", "r", "many")
    second = settled(_blocked(second))
    released(sets)
    more = _links(second, all_pairs=True)
    return components(near.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs``.

    Null and empty texts have no shingles and no links; equal texts are linked;
    rows may repeat; a null id never names a component that has another; an empty
    table gives an empty result.
    """
    parts = shuffle_parts(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = _PACKED.format(dict(own.dtypes)["doc_id"])
    index = own.mapInArrow(_index_map(parts), kind)
    by_name = F.pmod(F.col("name"), F.lit(parts)).cast("int")
    spread = F.pmod(F.xxhash64("name", "doc_id"), F.lit(parts)).cast("int")  # copies have one name
    index = index.repartition(parts, F.coalesce("part", spread))
    index = settled(index.mapInArrow(_index_reduce(parts), kind))
    found = settled(index.filter("packed is null").select("doc_id", "n", "name"))
    postings = index.filter("packed is not null").select("n", "name", "packed", F.col("part").alias("to"))
    sizes = found.groupBy("name").agg(F.max("n").alias("n")).select("n", "name", F.lit(None).cast("binary").alias("packed"), by_name.alias("to"))
    sets = settled(postings.unionByName(sizes).repartition(parts, "to").mapInArrow(_sets, "name long, n int, m int, top long, tok binary, df binary"))
    released(index)
    near = linked_sets(sets)
    placed = found.join(near, (found["name"] == near["node"]) & (found["n"] > 0), "left").select("doc_id", "n", F.coalesce("root", "name").alias("set"))
    placed = settled(placed)
    # a table of its own: Spark can then split the rows of a large component over several tasks
    least = placed.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).filter("rows > 1").select("set", "least")
    least = settled(least)
    out = placed.alias("p").join(least.alias("l"), (F.col("p.set") == F.col("l.set")) & (F.col("p.n") > 0), "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, and each row that has no words.

    Rows are named by id and text: of a component the row of the smallest id stays (null
    is the largest), of several texts of that id the one of the smallest hash, of rows that
    agree in both any one.  So a text is not lost with another of its id.  Columns may have
    any names; an empty table stays empty.
    """
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    # the order of structs is that of their fields
    name = F.struct(doc.isNull().alias("no_id"), doc.alias("id"), F.xxhash64(text_of(text)).alias("hash"))
    found = jaccard_components(own.select(name.alias("name"), text.alias("text")), "name", "text").filter("n_shingles > 0")
    state = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.first("component_id").alias("first")).filter("rows > 1 or doc_id <> first")
    state = settled(state.select(F.col("doc_id.id").alias("s_id"), F.col("doc_id.hash").alias("s_hash"), "rows", (F.col("doc_id") != F.col("first")).alias("gone")))
    sizes = state.agg(F.count("*"), F.count_if(~F.col("gone"))).first()
    if sizes[0] <= BROADCAST_ROWS:
        state = F.broadcast(state)
    same = doc.eqNullSafe(F.col("s_id")) & (F.xxhash64(text_of(text)) == F.col("s_hash"))
    if not sizes[1]:  # no row stays that has equals
        return own.join(state, same, "left_anti").toDF(*docs.columns)
    left = own.join(state, same, "left").filter("gone is null or not gone")
    # one of each group of equal rows, chosen by an aggregation
    equal = left.filter("gone is not null").dropDuplicates(["s_id", "s_hash"])
    return left.filter("gone is null").unionByName(equal).select(*own.columns).toDF(*docs.columns)
