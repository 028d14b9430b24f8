"""Each operator on documents against a brute-force version."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import xxhash

from promptlake.llm import jaccard, linededup, mixing, quality, queries, sharding, suffix, winnow
from promptlake.llm.common import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    return sorted(rows, key=repr)


def collected(df, *columns):
    return ordered(tuple(r) for r in df.select(*columns).collect())


# quality rules


def base_measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    times = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    punct = len(re.findall(r"[.,;:!?]", text or ""))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), len(lines), sum(len(x) <= 3 for x in w), punct, len(set(w))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_short", "n_punct", "n_distinct")


def bucket(v):
    by = v.bit_length() - 9
    return v if v < 512 else v >> by << by


def values(b):
    own = dict(zip(NAMES, b, strict=True)) | {"greatest": max}
    return {k: eval(f"({n}) // {d}", own) for k, (n, d, _) in quality.MEASURES.items()}


def quality_fences(rows):
    """Base measures, whether they fail, and low and high of each measure by group."""
    base = [base_measures(r[1]) for r in rows]
    failed = [b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base]
    groups = defaultdict(list)
    for r, b, f in zip(rows, base, failed, strict=True):
        if not f:
            for key in ((r[2], r[3]), (r[2],)):
                groups[key].append(values(b))

    def quartiles(of, k):
        vs = sorted(bucket(v[k]) for v in of)
        return [next(v for i, v in enumerate(vs, 1) if i * 4 >= len(vs) * q) for q in (1, 3)]

    limits = {}
    for key, own in groups.items():
        if len(key) == 2:
            for k in quality.MEASURES:
                n = len(own)
                q1, q3 = ((n * x + quality.PRIOR * y) / (n + quality.PRIOR) for x, y in zip(quartiles(own, k), quartiles(groups[key[:1]], k), strict=True))
                low = q1
                for _ in range(quality.BELOW):
                    low *= q1 / q3 if q3 else 0
                limits[(*key, k)] = (low, q3 + quality.ABOVE * (q3 - q1)) if q3 > q1 else (0, float("inf"))
    return base, failed, limits


def quality_brute(rows):
    base, failed, limits = quality_fences(rows)

    def inside(r, b):
        for k, v in values(b).items():
            low, high = limits[r[2], r[3], k]
            side = quality.MEASURES[k][2]
            if side != "lower" and v > high or side != "upper" and v < low:
                return False
        return True

    return ordered((r[0], *b[:5], f, not f and inside(r, b)) for r, b, f in zip(rows, base, failed, strict=True))


def test_quality(spark, docs, rows, empty):
    import random

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    junk = [(3000 + i, " ".join(word() + "###" for _ in range(80)), "en", "hot", 0, "", "", "") for i in range(3)]
    rows = rows + junk
    docs = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    out = quality.quality_rules(docs)
    want = quality_brute(rows)
    assert collected(out, *out.columns) == want
    assert {(True, False), (False, True), (False, False)} == {x[-2:] for x in want}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(x[0] for x in want if x[-1])
    assert quality.quality_rules(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_quality_by_shuffle_and_with_clashing_names(docs, rows, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    clash = docs.withColumnsRenamed({"size": "kept", "name": "fence", "t": "own_lang"}).selectExpr("*", "'x' AS base_failed", "'y' AS q", "'z' AS own_source", "'v' AS __v")
    kept = quality.keep_good(clash)
    assert kept.columns == clash.columns
    got = kept.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(x[0] for x in quality_brute(rows) if x[-1])
    assert got and all(r["kept"] == r["fence"] == "clash" and r["q"] == "y" for r in got)


def test_quality_thresholds_follow_the_source(spark):
    """The same text is fine for one source and not for another; no number but the sketches' says so."""
    import random

    r = random.Random(9)
    text = lambda share, n=120: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) + ("#" if r.random() < share else "") for _ in range(n))
    rows = [(i, text(0.0 if i % 2 else 0.3), "en", "prose" if i % 2 else "code") for i in range(800)]
    probe = text(0.3)
    rows += [(1000, probe, "en", "prose"), (1001, probe, "en", "code")]
    kept = {x["doc_id"]: x["kept"] for x in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[1000] and kept[1001] and sum(kept.values()) > 780


def test_quality_runs_no_python(docs):
    plan = quality.quality_rules(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# suffix


def repeats_brute(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    times = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((d, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return ordered(out)


@pytest.mark.parametrize("hot", [200_000, 2])
def test_suffix(docs, rows, empty, hot):
    out = suffix.remove_repeats(docs, hot=hot)
    want = repeats_brute(rows, 200)
    assert collected(out.drop("spans"), *out.columns[:-1]) == want
    assert sum(x[2] for x in want) > 3000
    assert suffix.remove_repeats(empty).count() == 0


def test_suffix_pieces(spark):
    import random

    r = random.Random(5)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p = noise(450)
    rows = [(i, noise(r.randint(0, 1500)) + p[r.randint(0, 100) : r.randint(250, 450)] + noise(r.randint(0, 1500))) for i in range(12)] + [(20, "z" * 3000), (21, p + "é" * 120 + p)]
    out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), piece=900)
    assert collected(out.drop("spans"), *out.columns[:-1]) == repeats_brute(rows, 200)


def test_suffix_over_the_size_of_a_part(spark):
    """The end of the first part of a long text is repeated elsewhere, and nothing else of it goes."""
    import numpy as np

    text = np.random.default_rng(4).integers(97, 123, 4_197_304).astype(np.uint8).tobytes().decode()
    some = text[suffix.PIECE - 700 : suffix.PIECE]
    out = suffix.remove_repeats(spark.createDataFrame([(1, text), (2, some), (3, "x" * 10)], "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in out.collect()} == {1: (700, 1), 2: (700, 1), 3: (0, 0)}


def test_suffix_agreement():
    import numpy as np

    r = np.random.default_rng(3)
    strings = r.integers(0, 2, (400, 13)).astype(np.uint8)
    a = suffix._Agreement(strings)
    for depth in (0, 1, 5, 9, 13):
        c = a.classes(depth)
        assert all((c[i] == c[j]) == (strings[i, :depth] == strings[j, :depth]).all() for i in range(0, 400, 7) for j in range(400))
    assert all(m == max(next((k for k in range(13) if strings[i, k] != strings[j, k]), 13) for j in range(400) if j != i) for i, m in enumerate(a.most))


def test_suffix_borders(spark):
    """Nothing goes at the borders of the parts of a long text but what is repeated."""
    import random

    r = random.Random(6)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p = noise(300)
    rows = [(1, noise(5000)), (2, noise(650) + p + noise(2000)), (3, noise(1700) + p + noise(777)), (4, "é" * 20 + noise(3000)), (5, noise(899)), (6, noise(901))]
    for piece in (900, 1234):
        out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), piece=piece)
        assert collected(out.drop("spans"), *out.columns[:-1]) == repeats_brute(rows, 200)
        assert {x["doc_id"]: x["n_removed"] for x in out.collect()} == {i: 300 if i in (2, 3) else 0 for i in range(1, 7)}
    find = suffix._find_anchors(4, 200, 900)  # the parts of one text, in this process
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([8]), pa.array([rows[0][1]])], ["name", "check", "text"])
    packed = pa.Table.from_batches(list(find(iter([batch])))).to_batches()
    assert not list(suffix._twins(10)(iter(packed)))


def test_multikey_order():
    import numpy as np

    t = np.random.default_rng(1).integers(0, 3, (500, 4)).astype(">u8")
    assert (t[suffix.multikey_order(t)] == t[np.lexsort(t.T[::-1])]).all()


# winnowing


BENCH = [(7, "the quick brown fox jumps over the lazy dog again and again today"), (8, "three short words"), (9, None), (10, ""), (11, "x"), (12, "Die Straße führt über den Fluß in die alte Stadt hinein und wieder hinaus")]
LEAKS = [
    "well THE quick, brown fox jumps over the lazy dog again! and so on",
    "quick brown fox jumps over the lazy dog again",
    "three short words",
    "no three   short\twords x",
    "die straße führt über den fluß in die alte stadt hinein",
    "",
    None,
    "the quick brown fox jumps over the lazy dog again and again today the quick brown fox jumps over the lazy dog again and again today",
]


def leaks_brute(docs, bench):
    words = lambda t: winnow.words(t)
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for i, b in bench:
            iw = words(b)
            n = min(10, len(iw))
            for g in {tuple(iw[j : j + n]) for j in range(len(iw) - n + 1)} if n else ():
                for j in range(len(w) - n + 1):
                    if tuple(w[j : j + n]) == g:
                        hit |= set(range(j, j + n))
                        items.add(str(i))
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return ordered(out)


@pytest.mark.parametrize("max_words", [2_000_000, 30])
def test_winnowing(spark, rows, max_words):
    data = [(i, t) for i, t in enumerate(LEAKS)] + [(r[0], r[1]) for r in rows if r[0] != 9]
    bench = [*BENCH, (7, "the quick brown fox jumps over the lazy dog again and again today"), (20, next(r[1] for r in rows if r[0] == 1001))]
    d, b = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    out = winnow.decontaminate(d, b, max_words=max_words)
    want = leaks_brute(data, bench)
    assert collected(out.drop("spans"), *out.columns[:-1]) == want
    assert sum(x[-1] for x in want) > 6
    clean = winnow.keep_clean(d, b, max_words=max_words)
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(x[0] for x in want if not x[-1])
    assert winnow.decontaminate(d, b.limit(0)).filter("contaminated").count() == 0
    assert winnow.decontaminate(d.limit(0), b).count() == 0


def test_winnowing_by_broadcast_and_by_join(spark):
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda n: sorted(map(tuple, winnow.decontaminate(d, b, max_words=n).drop("spans").collect()))
    assert rows(0) == rows(2_000_000)
    assert any(r[-1] for r in rows(0))


def test_winnowing_guarantee():
    import numpy as np

    g = np.random.default_rng(2).integers(0, 50, 300).astype(np.uint64)
    at = winnow.winnowed(g, 6)
    assert all(((at >= i) & (at < i + 6)).any() for i in range(len(g) - 5))


# Jaccard


def components_brute(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)]))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            k = root(i)
            least[k] = min(least.get(k, r[0]), r[0])
    return ordered((r[0], len(s), least.get(root(i), r[0]) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def edited(n=60, seed=11):
    """A chain of copies, each with a few more words changed than the last, and copies of a template."""
    import random

    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    rows, now = [], list(base)
    for i in range(n):
        now = list(now) if i % 3 else list(base)
        for _ in range(r.randint(1, 4)):
            now[r.randrange(len(now))] = word()
        rows.append((i, " ".join(now)))
    return rows


@pytest.mark.parametrize("block", [1 << 16, 400])
def test_jaccard(spark, docs, rows, empty, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", block)
    out = jaccard.jaccard_components(docs)
    assert collected(out, *out.columns) == components_brute(rows)
    near = edited()
    out = jaccard.jaccard_components(spark.createDataFrame(near, "doc_id long, text string").repartition(3))
    assert collected(out, *out.columns) == components_brute(near)
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_orders_prune():
    """Of unrelated sets over tokens of widely spread frequencies, far fewer share prefix tokens under all orders than under one."""
    import numpy as np

    r = np.random.default_rng(7)
    names = r.integers(1, 1 << 62, 3000, dtype=np.uint64)
    often = 1 / np.arange(1, 3001) ** 0.7
    sets = [np.unique(r.choice(names, 60, p=often / often.sum())) for _ in range(250)]
    held, count = np.unique(np.concatenate(sets), return_counts=True)
    df = dict(zip(held.tolist(), jaccard.frequency_class(count).tolist(), strict=True))
    prefixes = [[set(jaccard._prefix(s, np.array([df[int(t)] for t in s], dtype=np.uint8), len(s), k).tolist()) for k in range(jaccard.ORDERS)] for s in sets]
    pairs = [(x, y) for i, x in enumerate(prefixes) for y in prefixes[:i]]
    alone = [sum(bool(x[k] & y[k]) for x, y in pairs) for k in range(jaccard.ORDERS)]
    meeting = sum(all(x[k] & y[k] for k in range(jaccard.BLOCK_ORDERS)) for x, y in pairs)
    every = sum(all(x[k] & y[k] for k in range(jaccard.ORDERS)) for x, y in pairs)
    assert every <= meeting < 0.5 * min(alone[: jaccard.BLOCK_ORDERS]) and min(alone) > 100


def test_jaccard_orders():
    """Sets that are near share a prefix token under every order, and the orders' prefixes differ."""
    import numpy as np

    r = np.random.default_rng(6)
    overlap = []
    for _ in range(200):
        n = int(r.integers(5, 120))
        base = r.integers(1, 1 << 62, n, dtype=np.uint64)
        other = base.copy()
        other[: n // 10] = r.integers(1, 1 << 62, n // 10, dtype=np.uint64)
        df = {int(t): int(r.integers(2, 250)) for t in np.r_[base, other]}
        both = [(np.unique(s), np.array([df[int(t)] for t in np.unique(s)], dtype=np.uint8)) for s in (base, other)]
        for k in range(jaccard.ORDERS):
            x, y = (set(jaccard._prefix(t, d, n, k).tolist()) for t, d in both)
            assert x & y
        first = [set(jaccard._prefix(*both[0], n, k).tolist()) for k in range(jaccard.ORDERS)]
        overlap.append(len(first[0] & first[1]) / len(first[0]))
    assert np.mean(overlap) < 0.5


def one_brute(rows):
    """Rows by (id, text): the first row of each component, and all rows without words."""
    name = lambda r: (r[0] is None, r[0] or 0, (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    names = sorted({name(r) for r in rows})
    found = components_brute([(names.index(name(r)), r[1]) for r in rows])
    first = {i: c for i, n, c in found if n}
    out, seen = [], set()
    for r in rows:
        i = names.index(name(r))
        if i in first and (first[i] != i or i in seen):
            continue
        seen.add(i)
        out.append(r[:2])
    return ordered(out)


@pytest.mark.parametrize("most", [500_000, 0])
def test_keep_one(spark, docs, rows, empty, most, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", most)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and collected(kept, "doc_id", "text") == one_brute(rows)
    say = lambda x: " ".join(f"{x}{i}" for i in range(12))
    w, u, x = say("w"), say("u"), say("x")
    some = [(3, w), (5, w), (5, u), (7, w), (7, w), (None, w), (9, u + " z"), (8, x), (8, x), (None, say("n")), (None, None), (None, None), (4, " "), (4, " ")]
    clash = spark.createDataFrame([(*r, "a", "b", "c") for r in some], "doc_id long, text string, gone string, rows string, s_id string").repartition(3)
    kept = jaccard.keep_one(clash)
    assert kept.columns == clash.columns
    assert collected(kept, "doc_id", "text") == one_brute(some) == ordered([(3, w), (5, u), (8, x), (None, say("n")), (None, None), (None, None), (4, " "), (4, " ")])
    assert all(r["gone"] == "a" and r["rows"] == "b" for r in kept.collect())
    assert jaccard.keep_one(empty).count() == 0


def test_jaccard_disk(spark, docs, rows, tmp_path):
    """Shuffle files go with the step that wrote them, and checkpoints of postings, sets and blocks when the links are found."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for d in blocks.localDirsString() for f in Path(d).rglob("shuffle_*.data")}
    kept = lambda: {f for f in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("rdd-*/part-*")}
    size = lambda files: sum(f.stat().st_size for f in files if f.exists())
    shared_dir(spark)
    before, parts = shuffled(), kept()
    out = jaccard.keep_one(docs)
    left = shuffled() - before
    for _ in range(50):  # they go in the background
        if size(left) < 20_000:
            break
        time.sleep(0.2)
    assert size(left) < 20_000
    assert size(kept() - parts) < 30_000
    assert collected(out, "doc_id", "text") == one_brute(rows)


# lines


def lines_brute(rows):
    def chunks(text):
        lines, out, cur = (text or "").split("\n"), [], []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
        for i, x in enumerate(lines):
            cur.append(x)
            v = (h[i - 1] << 1) & ((1 << 64) - 1) ^ h[i] if i else 0
            if i == len(lines) - 1 or i and (v - (1 << 64) if v >> 63 else v) % 3 == 0:
                out.append(cur)
                cur = []
        return out

    name = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest((t or "").encode(), 42))
    places = defaultdict(list)
    for r in rows:
        for k, c in enumerate(chunks(r[1])):
            if len(c) > 1:
                places["\n".join(c)].append((r[0] is not None, r[0] or 0, name(r[1]), k))
    out = []
    for r in rows:
        cs = chunks(r[1])
        keep = [c for k, c in enumerate(cs) if len(c) < 2 or min(places["\n".join(c)]) == (r[0] is not None, r[0] or 0, name(r[1]), k)]
        out.append((r[0], sum(map(len, cs)), len(cs), len(cs) - len(keep), sum(map(len, cs)) - sum(map(len, keep)), "\n".join("\n".join(c) for c in keep)))
    return ordered(out)


@pytest.mark.parametrize("most", [500_000, 0])
def test_lines(docs, rows, empty, most, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", most)
    out = linededup.dedup_lines(docs)
    want = lines_brute(rows)
    assert collected(out, *out.columns) == want
    assert sum(x[4] for x in want) > 20
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert linededup.dedup_lines(empty).count() == 0


def passages_brute(rows):
    name = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest((t or "").encode(), 42))
    place = lambda r, k: (r[0] is not None, r[0] or 0, name(r[1]), k)
    first = {}
    for r in rows:
        lines = (r[1] or "").split("\n")
        for k, x in enumerate(zip(lines, lines[1:])):
            first[x] = min(first.get(x, place(r, k)), place(r, k))
    out = []
    for r in rows:
        lines, gone = (r[1] or "").split("\n"), set()
        for k, x in enumerate(zip(lines, lines[1:])):
            if first[x] != place(r, k):
                gone |= {k + 1} if first[x] == place(r, k - 1) else {k, k + 1}
        out.append((r[0], len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return ordered(out)


@pytest.mark.parametrize("most", [500_000, 0])
def test_passages(spark, docs, rows, empty, most, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", most)
    out = linededup.dedup_passages(docs)
    want = passages_brute(rows)
    assert collected(out, "doc_id", "n_lines", "n_removed_lines", "kept") == want
    assert collected(out, "doc_id", "n_lines", "n_chunks") == ordered((r[0], *cut_counts(r[1])) for r in rows)
    assert all((r["n_removed_chunks"] == r["n_chunks"]) == (r["n_removed_lines"] == r["n_lines"]) for r in out.collect())
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert linededup.dedup_passages(empty).count() == 0
    odd = [(1, "x\nx\nx\nx"), (2, "a\nb\na\nb\na"), (3, "q\na\nb\nr"), (4, "")]
    out = linededup.dedup_passages(spark.createDataFrame(odd, "doc_id long, text string"))
    assert collected(out, "doc_id", "n_lines", "n_removed_lines", "kept") == passages_brute(odd) == [(1, 4, 2, "x\nx"), (2, 5, 3, "a\nb"), (3, 4, 2, "q\nr"), (4, 1, 0, "")]


def cut_counts(text):
    lines = (text or "").split("\n")
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    v = [(a << 1) & ((1 << 64) - 1) ^ b for a, b in zip(h, h[1:-1])]
    return len(lines), 1 + sum((x - (1 << 64) if x >> 63 else x) % 3 == 0 for x in v)


def test_line_query_finds_passages(spark, tmp_path):
    """Passages of two to six lines between lines of their own: the second time all their lines go."""
    rows = [(2 * n + 40 * j + side, f"before {n} {j} {side}\n" + "\n".join(f"passage {n} {j} line {i}" for i in range(n)) + f"\nafter {n} {j} {side}") for n in range(2, 7) for j in range(20) for side in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = defaultdict(set)
    for r in queries.op9_line_dedup(spark, str(tmp_path)).collect():
        got[r["n_lines"], r["doc_id"] % 2].add(r["n_removed_lines"])
    assert got == {(n + 2, side): {n * side} for n in range(2, 7) for side in (0, 1)}


# mixing


def test_mixing(docs, rows, empty):
    out = mixing.mix(docs)
    got = out.collect()
    sizes = ordered((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    assert ordered((r["doc_id"], r["size"]) for r in got) == sizes
    by = defaultdict(int)
    for r in rows:
        by[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = 1.5 * sum(by.values()), {}, set(names)
    while True:  # reshare until no source is above its cap
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * by[s]}
        if not over:
            target |= share
            break
        target |= {s: 2 * by[s] for s in over}
        free -= over
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == by[r["source"]]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    assert ordered(tuple(r) for r in mixing.mix(docs.repartition(3)).collect()) == ordered(tuple(r) for r in got)
    mixed = mixing.apply_mix(docs)
    words = sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect())
    assert mixed.columns == docs.columns and words == sum(taken.values())
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0


def test_mixing_equal_keys(spark):
    """Rows that agree in id, source and size, nulls included, share their draws evenly and keep their texts."""
    rows = [(i, t, s, "mine") for i in (None, 1, 2) for s in (None, "a") for t in ("x y", "y x", "y x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    mixed, drawn = mixing.apply_mix(docs), mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(tuple(r) for r in mixed.collect())
    assert set(got) <= set(rows) and {r[3] for r in got} == {"mine"}
    taken = sum(r["taken"] for r in drawn.collect())
    assert taken and taken == sum(2 * n for r, n in got.items() if r[1])
    for i, s in {(r[0], r[2]) for r in rows}:  # one x y, two y x under one key
        n = [got[i, "x y", s, "mine"], got[i, "y x", s, "mine"]]
        assert n[0] <= 2 and n[1] <= 4 and abs(n[0] - n[1] / 2) <= 1


# sharding


def test_sharding(docs, rows, empty):
    out = sharding.shard(docs, n_shards=8).collect()
    text = lambda r: (r[1] or "").encode()
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == ordered((r[0], len(text(r)) + 16, zlib.crc32(text(r))) for r in rows)
    total, slots = Counter(), defaultdict(list)
    for r in out:
        assert 0 <= r["shard"] < 8 and r["law"] == "bytes" and r["grown_shard"] is None
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    even, largest = sum(total.values()) / 8, max(r["size"] for r in out)
    assert max(total.values()) <= even + largest
    both = sharding.with_shards(docs, 8)
    assert both.count() == len(rows) and both.columns == [*("doc_size" if c == "size" else c for c in docs.columns), "size", "shard", "slot"]
    got = both.collect()
    assert len({(r["shard"], r["slot"]) for r in got}) == len(rows) and all(r["doc_size"] == "clash" for r in got)
    assert ordered((r["doc_id"], r["size"], r["shard"]) for r in got) == ordered((r["doc_id"], r["size"], r["shard"]) for r in out)
    assert sharding.shard(empty, n_shards=8).count() == 0 and sharding.with_shards(empty, 8).count() == 0
    by_bytes = sharding.shard(docs, target_bytes=20_000)
    assert by_bytes.select("shard").distinct().count() <= -(-sum(total.values()) // 20_000)


def tree_brute(points, weights, shards):
    """Shard of each point (cells, digit) by the k-d tree, row by row."""
    out = {}

    def split(some, lo, hi):
        if hi - lo == 1:
            out.update({i: lo for i in some})
            return
        mid = lo + (hi - lo) // 2
        if not some:
            return
        wide = [(max(points[i][d] for i in some) - min(points[i][d] for i in some), -d) for d in range(3)]
        d = -max(wide)[1]
        by = defaultdict(int)
        for i in some:
            by[points[i][d]] += weights[i]
        goal, upto = sum(by.values()) * ((hi - lo) // 2) / (hi - lo), 0
        for c in sorted(by):
            if upto + by[c] >= goal:
                break
            upto += by[c]
        digits = defaultdict(int)
        for i in some:
            if points[i][d] == c:
                digits[points[i][3]] += weights[i]
        best, sums = (goal - upto, -1, -1), upto
        for g in sorted(digits):
            sums += digits[g]
            if (abs(sums - goal), g) < best[:2] or (abs(sums - goal) == best[0] and best[2] < 0):
                best = (abs(sums - goal), g, g)
        left = [i for i in some if points[i][d] < c or points[i][d] == c and points[i][3] <= best[2]]
        split(left, lo, mid)
        split([i for i in some if i not in set(left)], mid, hi)

    split(list(range(len(points))), 0, shards)
    return out


def test_sharding_tree(spark, docs, monkeypatch):
    """The distributed tree against one built row by row, on the points of documents."""
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", 0)  # all joins by shuffle
    import random

    r = random.Random(7)
    points = [(r.choice((0, 5, 5, 9)), r.randint(0, 3), r.randint(0, 40), r.randint(0, 99)) for _ in range(300)]
    weights = [r.randint(1, 60) for _ in points]
    d = spark.createDataFrame([(w, list(p[:3]), p[3]) for p, w in zip(points, weights, strict=True)], "__size long, at array<int>, digit int").repartition(3)
    tree = sharding.Tree(11)
    while sharding._split_level(d, tree):
        pass
    from pyspark.sql import functions as F

    got = Counter((tuple(x["at"]), x["digit"], x["__size"], x["s"]) for x in d.withColumn("s", F.get(tree.column(), tree.node())["lo"]).collect())
    want = tree_brute(points, weights, 11)
    assert got == Counter((p[:3], p[3], w, want[i]) for i, (p, w) in enumerate(zip(points, weights, strict=True)))
    out = sharding.shard(docs, n_shards=5)
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", 100_000)
    assert collected(out, "doc_id", "size", "shard") == collected(sharding.shard(docs, n_shards=5), "doc_id", "size", "shard")


def test_sharding_spreads_equal_rows(spark):
    d = spark.createDataFrame([(1, "the same text", "en", "a")] * 4000, "doc_id long, text string, lang string, source string").repartition(3)
    rows = Counter(r["shard"] for r in sharding.shard(d, n_shards=8).collect())
    assert len(rows) == 8 and max(rows.values()) - min(rows.values()) <= 4
    plain = sharding.shard(d, n_shards=8)
    assert collected(plain, "shard", "slot") == collected(sharding.shard(d.repartition(5), n_shards=8), "shard", "slot")


def test_sharding_balance(spark):
    import random

    r = random.Random(4)
    d = spark.createDataFrame([(i, "w" * r.randint(0, 60), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(4000)], "doc_id long, text string, lang string, source string")
    total = [x["b"] for x in sharding.shard(d, n_shards=40).groupBy("shard").sum("size").withColumnRenamed("sum(size)", "b").collect()]
    assert len(total) == 40 and max(total) - min(total) < 0.1 * sum(total) / 40


# pipeline


def test_pipeline(spark, tmp_path, docs, rows):
    import corpus_pipeline

    bench = spark.createDataFrame([(1, next(r[1] for r in rows if r[0] == 1001)), (2, None)], "item_id long, text string")
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    own.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = list(rows)
    good = {x[:6] for x in quality_brute(left) if x[-1]}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages)[0] == "quality rules" and len(stages) == 5
    q = stages["quality rules"](spark, d, str(tmp_path))
    left = [r for r in left if (r[0], *base_measures(r[1])[:5]) in good]
    assert collected(q, "doc_id", "text") == ordered(r[:2] for r in left) and q.columns == own.columns
    j = stages["n-gram Jaccard join"](spark, q, str(tmp_path))
    assert collected(j, "doc_id", "text") == one_brute(left) and j.columns == own.columns
    left = [(*r, None, None) for r in one_brute(left)]
    c = stages["benchmark decontamination"](spark, j, str(tmp_path))
    bad = {x[0] for x in leaks_brute([(i, r[1]) for i, r in enumerate(left)], [tuple(b) for b in bench.collect()]) if x[-1]}
    left = [r for i, r in enumerate(left) if i not in bad]
    assert bad and c.columns == own.columns
    assert collected(c, "doc_id", "text") == ordered(r[:2] for r in left)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*own.columns, "size", "shard", "slot"]
    got = out.collect()
    assert {r["doc_id"] for r in got} <= {r[0] for r in left} and max(Counter((r["doc_id"], r["text"]) for r in got).values()) <= 6
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
