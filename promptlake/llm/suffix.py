"""Removal of byte strings that occur twice, by a sparse suffix array over Spark's range partitions.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

1. Sampled suffixes.  Only suffixes that start at anchors are sorted: in every string
   of ``length`` bytes, the place of the smallest hash of 32 leading bytes.  Equal
   strings have it at the same offset, so a repeated string shows as two anchors with
   equal leading bytes.  Texts are named by 124 bits of two hashes, one of them SHA-256,
   so copies are one text; texts with copies lose everything anyway.
2. Anchors (hash of the leading bytes, hash of all that strings around the anchor
   reach, place) are packed and shuffled by the first hash.  Anchors alone with their
   leading bytes go.  Those with a twin in the whole reach (128 bits of hashes) are
   settled.  The others, and one of each kind of twins as a partner, take their bytes along.
3. Buckets.  Spark samples splitters and range-partitions these suffixes by their
   leading bytes.  A bucket sorts them by a multikey quicksort on eight-byte tokens, and
   so the bytes before them, from the anchor backwards.  The common prefixes of
   neighbours in both orders say which suffixes agree in so many bytes to the right and
   to the left; two strings are equal if their suffixes agree in both, byte by byte.
   Splitters fall between different leads (the range of one lead is one bucket), so
   neighbours across a boundary agree in less than a lead and have no string in common.
4. A group of more than ``hot`` suffixes isn't sorted in one task: its strings are
   counted by their SHA-256 in an aggregation with partial sums.
5. Ranges are merged by text and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, scratch, shuffle_parts, text_of

LENGTH = 200
LEAD = 32
HOT = 200_000
PIECE = 4 << 20
FLUSH_ANCHORS = 1 << 20
_BITS = 24
_TABLE = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def _lead_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each position on."""
    h = _TABLE[b]
    for step, mul in zip((1, 2, 4, 8, 16), _MUL, strict=True):
        h = h[:-step] * mul + h[step:]
    h ^= h >> np.uint64(29)
    h *= _MUL[1]
    return h ^ (h >> np.uint64(32))


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    return v if step == width else np.minimum(v[: len(v) - (width - step)], v[width - step :])


def anchors(data: bytes, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``data`` (texts end to end) of the anchors of all strings inside a text, and their hashes."""
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    if len(data) < length:
        return none
    h = _lead_hashes(np.frombuffer(data, np.uint8))
    mask = np.uint64((1 << _BITS) - 1)
    v = (h & ~mask) | (mask - np.arange(len(h), dtype=np.uint64))  # the last of equal ones is the smallest
    low = _window_min(v, length - LEAD + 1)
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    long = stops - starts >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, stops[long] - length + 1, -1)
    at = np.unique(mask - (low[np.cumsum(valid)[: len(low)] > 0] & mask)).astype(np.int64)
    return at, h[at]


def _pieces(text: bytes, length: int, piece: int) -> Iterator[tuple[int, bytes]]:
    """A text in parts that share length - 1 bytes, so that each string is in one."""
    if len(text) <= piece:
        yield 0, text
        return
    for at in range(0, len(text) - length + 1, piece - length + 1):
        yield at, text[at : at + piece]


_PACKED = ["part", "packed"]
_HELD = ["name", "check", "text", "places"]


def _find_anchors(n_parts: int, length: int, piece_size: int):
    """Packed anchors by range of their hash; texts of over ``piece_size`` bytes are searched in parts."""
    before, after = length - LEAD, length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple] = []
        names: list[int] = []
        checks: list[int] = []
        sizes: list[int] = []
        total = 0

        def flush() -> pa.RecordBatch:
            lead, reach, doc, pos = (np.concatenate(x) for x in zip(*got, strict=True))
            part = (((lead >> np.uint64(48)) * np.uint64(n_parts)) >> np.uint64(16)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            lead, reach, doc, pos, part = lead[order], reach[order], doc[order], pos[order], part[order]
            name, check, size = (np.array(x, dtype=np.int64) for x in (names, checks, sizes))
            cuts, rows = np.searchsorted(part, np.arange(n_parts + 1)), []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                s = slice(int(cuts[p]), int(cuts[p + 1]))
                own, index = np.unique(doc[s], return_inverse=True)
                head = np.array([len(own), s.stop - s.start], dtype=np.int64)
                rows.append((p, b"".join(x.tobytes() for x in (head, name[own], check[own], size[own], lead[s], reach[s], pos[s].astype(np.uint32), index.astype(np.uint32)))))
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], _PACKED)

        def add(held: list[tuple[int, int, bytes, bytes]]) -> int:
            """Anchors of parts (text, place in it, bytes, bytes of the whole text)."""
            data = b"".join(x for _, _, x, _ in held)
            lens = np.array([len(x) for _, _, x, _ in held], dtype=np.int64)
            stops = np.cumsum(lens)
            starts = stops - lens
            at, lead = anchors(data, starts, stops, length)
            if not len(at):
                return 0
            which = np.searchsorted(stops, at, side="right")
            doc, pos = np.array([d for d, *_ in held])[which], at - starts[which] + np.array([o for _, o, *_ in held])[which]
            # in the whole text: parts that share an anchor must say the same of it
            a, b = np.maximum(pos - before, 0), np.minimum(pos + after, np.array([len(t) for *_, t in held])[which])
            views = [memoryview(t) for *_, t in held]
            reach = np.fromiter((xxhash.xxh3_64_intdigest(views[w][x:y], seed) for w, x, y, seed in zip(which.tolist(), a.tolist(), b.tolist(), (pos - a).tolist(), strict=True)), dtype=np.uint64, count=len(at))
            got.append((lead, reach, doc, pos))
            return len(at)

        for batch in batches:
            held, size = [], 0
            for name, check, text in zip(*(batch.column(c).to_pylist() for c in ("name", "check", "text")), strict=True):
                text = text.encode()
                if len(text) < length:
                    continue
                for at, piece in _pieces(text, length, piece_size):
                    held.append((len(names), at, piece, text))
                    size += len(piece)
                    if size >= piece_size // 4:
                        # names are appended below, after the last part of a text
                        total += add(held)
                        held, size = [], 0
                names.append(name)
                checks.append(check)
                sizes.append(len(text))
                if total >= FLUSH_ANCHORS and not held:
                    yield flush()
                    got, names, checks, sizes, total = [], [], [], [], 0
            if held:
                total += add(held)
            if total >= FLUSH_ANCHORS:
                yield flush()
                got, names, checks, sizes, total = [], [], [], [], 0
        if got:
            yield flush()

    return run


def _twins(hot: int):
    """Of the anchors of a hash range, those not alone: name, check, n_bytes, pos, kind (0 settled, 1 to sort, 2 of a hot group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in batches:
            for blob in b.column("packed").to_pylist():
                k, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
                at = 16
                name, check, size = (np.frombuffer(blob, np.int64, k, at + 8 * k * i) for i in range(3))
                at += 24 * k
                lead, reach = np.frombuffer(blob, np.uint64, m, at), np.frombuffer(blob, np.uint64, m, at + 8 * m)
                at += 16 * m
                pos, index = np.frombuffer(blob, np.uint32, m, at), np.frombuffer(blob, np.uint32, m, at + 4 * m)
                parts.append((lead, reach, name[index], check[index], size[index], pos))
        if not parts:
            return
        lead, reach, name, check, size, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.lexsort((pos, check, name, reach, lead))
        lead, reach, name, check, size, pos = (x[order] for x in (lead, reach, name, check, size, pos))
        # copies of a text and parts of one that share an anchor have the same lead and reach
        new = np.r_[True, (lead[1:] != lead[:-1]) | (reach[1:] != reach[:-1]) | (name[1:] != name[:-1]) | (check[1:] != check[:-1]) | (pos[1:] != pos[:-1])]
        lead, reach, name, check, size, pos = (x[new] for x in (lead, reach, name, check, size, pos))
        new_lead = np.r_[True, lead[1:] != lead[:-1]]
        new_reach = new_lead | np.r_[True, reach[1:] != reach[:-1]]
        group, kin = np.cumsum(new_lead) - 1, np.cumsum(new_reach) - 1
        alone = np.bincount(kin)[kin] == 1
        has_alone = np.bincount(group, weights=alone)[group] > 0
        sent = has_alone & (alone | new_reach) & (np.bincount(group)[group] > 1)
        many = np.bincount(group, weights=sent)[group] > hot
        for kind, which in ((0, ~alone), (1, sent & ~many), (2, sent & many)):
            at = np.flatnonzero(which)
            for i in range(0, len(at), 100_000):
                j = at[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(name[j]), pa.array(check[j]), pa.array(size[j]), pa.array(pos[j].astype(np.int64)), pa.array(np.full(len(j), kind, dtype=np.int32))], ["name", "check", "n_bytes", "pos", "kind"])

    return run


def _suffixes(length: int):
    """Each anchor to sort with its bytes: lead, name, check, pos, left and right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lead", "name", "check", "pos", "left", "right"]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for b in batches:
            rows = []
            for name, check, text, places in zip(*(b.column(c).to_pylist() for c in _HELD), strict=True):
                text = text.encode()
                for p in places:
                    if p["kind"] == 1:
                        q = p["pos"]
                        rows.append((text[q : q + LEAD], name, check, q, text[max(0, q - length + LEAD) : q], text[q : q + length]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def _hot_strings(length: int):
    """Each string around the anchors of hot groups: its digest, and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, check, text, places in zip(*(b.column(c).to_pylist() for c in _HELD), strict=True):
                text = text.encode()
                at = sorted({s for p in places if p["kind"] == 2 for s in range(max(0, p["pos"] - length + LEAD), min(p["pos"], len(text) - length) + 1)})
                if k := len(at):
                    digests = [hashlib.sha256(text[s : s + length]).digest() for s in at]
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(np.full(k, name)), pa.array(np.full(k, check)), pa.array(at, pa.int64())], ["digest", "name", "check", "lo"])

    return run


def multikey_order(tokens: np.ndarray) -> np.ndarray:
    """The order of rows of tokens: a multikey quicksort in which all runs of a depth are split by their next token at once."""
    order, active, run = np.arange(len(tokens)), np.arange(len(tokens)), np.zeros(len(tokens), dtype=np.int64)
    for depth in range(tokens.shape[1]):
        if not len(active):
            break
        key = tokens[order[active], depth]
        by = np.lexsort((key, run[active]))
        order[active] = order[active][by]
        key, of = key[by], run[active]
        new = np.r_[True, (of[1:] != of[:-1]) | (key[1:] != key[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(active)])
        run[active] = np.repeat(active[first], size)
        active = active[np.repeat(size, size) > 1]
    return order


class _Agreement:
    """Strings of bytes in order: which of them agree in their first bytes."""

    def __init__(self, strings: np.ndarray):
        width = strings.shape[1]
        tokens = np.zeros((len(strings), width + -width % 8), dtype=np.uint8)
        tokens[:, :width] = strings
        self.order = multikey_order(tokens.view(">u8").astype(np.uint64))
        own = strings[self.order]
        differ = own[1:] != own[:-1]
        #: The bytes in which each agrees with the one before it in order.
        self.common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.most = np.empty(len(strings), dtype=np.int64)
        self.most[self.order] = np.maximum(np.r_[0, self.common], np.r_[self.common, 0])

    def classes(self, depth: int) -> np.ndarray:
        """A number for each string; equal ones agree in ``depth`` bytes."""
        out = np.empty(len(self.order), dtype=np.int64)
        out[self.order] = np.cumsum(np.r_[0, self.common < depth])
        return out


def _repeated(left: list[bytes], right: list[bytes], length: int) -> np.ndarray:
    """For suffixes, which strings around their anchor, by bytes before it, occur twice."""
    m, before = len(left), length - LEAD
    ll, rl = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    to_right = _Agreement(np.frombuffer(b"".join(x.ljust(length, b"\0") for x in right), np.uint8).reshape(m, length))
    to_left = _Agreement(np.frombuffer(b"".join(x[::-1].ljust(before, b"\0") for x in left), np.uint8).reshape(m, before))
    out = np.zeros((m, before + 1), dtype=bool)
    for a in range(before + 1):
        ok = np.flatnonzero((ll >= a) & (rl >= length - a) & (to_left.most >= a) & (to_right.most >= length - a))
        if len(ok) > 1:
            pair = to_left.classes(a)[ok] * m + to_right.classes(length - a)[ok]
            order = np.argsort(pair)
            twin = pair[order][1:] == pair[order][:-1]
            out[ok[order[1:][twin]], a] = out[ok[order[:-1][twin]], a] = True
    return out


def _bucket(length: int):
    """Ranges of starts of repeated strings: name, check, lo, hi (both included)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = []
        for part in _chunks([r[0] for r in rows], 10_000):
            out = _repeated([r[4] for r in rows[part]], [r[5] for r in rows[part]], length)
            edge = np.diff(np.pad(out.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            for (i, a), (_, b) in zip(np.argwhere(edge == 1).tolist(), np.argwhere(edge == -1).tolist(), strict=True):
                _, name, check, q, *_ = rows[part.start + i]
                found.append((name, check, q - b + 1, q - a))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["name", "check", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:  # in order of lead: whole groups can be solved as they are complete
            rows += list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            if len(rows) > 20_000 and rows[0][0] != rows[-1][0]:
                cut = next(i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != rows[-1][0]) + 1
                yield solve(rows[:cut])
                rows = rows[cut:]
        if rows:
            yield solve(rows)

    return run


def _chunks(leads: list[bytes], size: int) -> Iterator[slice]:
    """Slices of about ``size`` that don't cut a group of equal leads."""
    lo = 0
    while lo < len(leads):
        hi = min(lo + size, len(leads))
        while hi < len(leads) and leads[hi] == leads[hi - 1]:
            hi += 1
        yield slice(lo, hi)
        lo = hi


def _cut(length: int):
    """name, check, n_removed, n_spans, kept_sha256 and spans of each text with ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, check, text, ranges in zip(*(b.column(c).to_pylist() for c in ("name", "check", "text", "ranges")), strict=True):
                text, spans = text.encode(), []
                for lo, hi in sorted((r["lo"], r["hi"] + length) for r in ranges):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                kept = hashlib.sha256()
                at = 0
                for lo, hi in spans:
                    kept.update(text[at:lo])
                    at = hi
                kept.update(text[at:])
                out.append((name, check, sum(y - x for x, y in spans), len(spans), kept.hexdigest(), [{"start": x, "end": y} for x, y in spans]))
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], ["name", "check", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (byte ranges removed) for each row of ``docs``.

    Null texts are empty, shorter texts than ``length`` keep everything, equal texts are
    texts of their own (and so lose everything), very long ones are searched in parts of
    ``piece`` bytes and compared whole, and an empty table gives an empty result.  Other
    columns don't matter, whatever their names.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    sha = F.sha2("text", 256)
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    own = own.withColumns({"name": F.xxhash64("text"), "check": F.conv(F.substring(sha, 1, 15), 16, 10).cast("long"), "n_bytes": F.octet_length("text").cast("long")})
    base = checkpointed(own.select("doc_id", "name", "check", "n_bytes", sha.alias("sha")))
    named = lambda prefix: (F.col("name") == F.col(f"{prefix}_name")) & (F.col("check") == F.col(f"{prefix}_check"))
    called = lambda df, prefix: df.withColumnsRenamed({"name": f"{prefix}_name", "check": f"{prefix}_check"})
    # anchors that aren't alone
    packed = own.filter(F.col("n_bytes") >= length).select("name", "check", "text").mapInArrow(_find_anchors(4 * parts, length, piece), "part int, packed binary")
    shared = checkpointed(packed.repartition(parts, "part").mapInArrow(_twins(hot), "name long, check long, n_bytes long, pos long, kind int"))
    # the texts that have such anchors, one row of each, in the shared folder
    first = base.groupBy("name", "check").agg(F.min("doc_id").alias("rep"))
    wanted = shared.groupBy("name", "check").agg(F.collect_list(F.struct("pos", "kind")).alias("places")).join(first, ["name", "check"])
    texts = own.join(called(wanted, "w"), named("w") & F.col("doc_id").eqNullSafe(F.col("rep")))
    folder = scratch(spark, "repeats")
    texts.select("name", "check", "text", "places").write.parquet(folder)
    texts = spark.read.parquet(folder)
    # repeated strings
    some = lambda kind: texts.filter(F.exists("places", lambda p: p["kind"] == kind)).select(*_HELD)
    sorted_ = some(1).mapInArrow(_suffixes(length), "lead binary, name long, check long, pos long, left binary, right binary").repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    ranges = sorted_.mapInArrow(_bucket(length), "name long, check long, lo long, hi long")
    strings = some(2).mapInArrow(_hot_strings(length), "digest binary, name long, check long, lo long")
    place = F.struct("name", "check", "lo")
    twice = strings.groupBy("digest").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x <> y").select("digest")
    hot_ranges = strings.join(twice, "digest").select("name", "check", "lo", F.col("lo").alias("hi"))
    settled = shared.filter("kind = 0").select("name", "check", F.greatest(F.col("pos") - (length - LEAD), F.lit(0)).alias("lo"), F.least(F.col("pos"), F.col("n_bytes") - length).alias("hi"))
    found = ranges.unionByName(hot_ranges).unionByName(settled).groupBy("name", "check").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    cut = texts.select("name", "check", "text").dropDuplicates(["name", "check"]).join(found, ["name", "check"]).select("name", "check", "text", "ranges")
    cut = cut.mapInArrow(_cut(length), "name long, check long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")
    # copies lose everything; texts without ranges keep everything
    copies = base.filter(F.col("n_bytes") >= length).groupBy("name", "check").agg(F.count("*").alias("rows")).filter("rows > 1").select("name", "check")
    out = base.join(called(cut, "c"), named("c"), "left").join(called(copies, "d"), named("d"), "left")
    all_ = F.col("d_name").isNotNull()
    return out.select(
        "doc_id", "n_bytes",
        F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(all_, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))).alias("spans"),
    )
