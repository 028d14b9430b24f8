"""Sharding by a k-d tree over document metadata, with equal bytes in every leaf.

Each document is a point (source, language, size) with its bytes as weight.  An axis is
ordered by value, and a value's coordinate is the share of all bytes before it: so axes
of names and of numbers have one scale, neighbours stay neighbours, and the width of a
node is the share of the data that its range spans.  A node that must become k shards is
split along its widest dimension at the weighted quantile (k // 2) / k, until every leaf
is one shard; all nodes of a level are split together.  A split point is found by two
aggregations: weights by coordinate, then, inside the coordinate where the quantile
falls, weights by a hash of the row.  So values that very many documents share are split
too.  What reaches the driver is one split a node; rows find their leaf by walking a
table of nodes, so that the plan doesn't grow with the tree.

Equal rows are told apart by a number, so that they spread as other rows do.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, scratch, shuffle_parts, text_of

#: Coordinates are whole numbers under this.
CELLS = 4096
DIGITS = 1 << 16
#: Rows of a shard are numbered in buckets of about so many, 64 buckets a shard at least.
SLOT_ROWS, SLOTS = 20_000, 64
OVERHEAD = 16
#: Up to so many rows (a few numbers each) small tables are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 100_000
_DIMS = ("source", "lang", "size")
_POINT = ["__id", "__size", "__crc", "__v0", "__v1", "__v2", "__pid", "__mid"]


def _small(df: DataFrame) -> DataFrame:
    """``df``, computed once, to be broadcast if it is small."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_points(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """``docs`` with the columns of a point: names and size as texts that sort as they should, partition and number of the row."""
    text = text_of(text_col)
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    return docs.withColumns({
        "__id": F.col(id_col),
        "__size": size,
        "__crc": F.crc32(text),
        "__v0": text_of(F.col(source_col).cast("string")),
        "__v1": text_of(F.col(lang_col).cast("string")),
        "__v2": F.lpad(F.floor(F.log2(size.cast("double")) * 100).cast("string"), 5, "0"),
        "__pid": F.spark_partition_id(),
        "__mid": F.monotonically_increasing_id(),
    })


def _axes(rows: DataFrame) -> DataFrame:
    """dim, value and cell: the share of all bytes before a value, in order of values.

    Prefix sums in two levels, over ranges that Spark samples: names may be many.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"__v{i}").alias("value")) for i in range(3)])).alias("a")
    sums = rows.select("__size", each).groupBy("a.dim", "a.value").agg(F.sum("__size").alias("w"))
    sums = checkpointed(sums.repartitionByRange(shuffle_parts(rows.sparkSession), "dim", "value").withColumn("p", F.spark_partition_id()))
    before = lambda by, order: F.coalesce(F.sum("w").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sums.groupBy("dim", "p").agg(F.sum("w").alias("w"))
    ranges = ranges.select(F.col("dim").alias("r_dim"), F.col("p").alias("r_p"), before(["dim"], "p").alias("first"), F.sum("w").over(Window.partitionBy("dim")).alias("total"))
    at = sums.withColumn("inner", before(["dim", "p"], "value")).join(F.broadcast(ranges), (F.col("dim") == F.col("r_dim")) & (F.col("p") == F.col("r_p")))
    return at.select("dim", "value", F.floor((F.col("first") + F.col("inner")) * CELLS / F.col("total")).cast("int").alias("cell"))


def _numbered(rows: DataFrame) -> DataFrame | None:
    """__mid and __k of the rows that equal another in id, size and checksum: their number among those (None: there are no such rows).

    Numbers in two levels (rows of an input partition, then partitions), so that no group is numbered in one task.
    """
    key = ["__id", "__size", "__crc"]
    same = lambda a, b: F.col(f"{a}.__id").eqNullSafe(F.col(f"{b}.__id")) & (F.col(f"{a}.__size") == F.col(f"{b}.__size")) & (F.col(f"{a}.__crc") == F.col(f"{b}.__crc"))
    counts = rows.groupBy(*key, "__pid").agg(F.count("*").alias("n"))
    many = counts.groupBy(*key).agg(F.sum("n").alias("rows")).filter("rows > 1").select(*key)
    counts = counts.alias("c").join(many.alias("m"), same("c", "m"), "left_semi")
    upto = Window.partitionBy(*key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    firsts = checkpointed(counts.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n"))
    n = firsts.count()
    if n == 0:
        return None
    if n <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    own = rows.select(*key, "__pid", "__mid").alias("o").join(firsts.alias("f"), same("o", "f") & (F.col("o.__pid") == F.col("f.__pid")))
    inner = F.row_number().over(Window.partitionBy("f.__id", "f.__size", "f.__crc", "f.__pid").orderBy("o.__mid"))
    return _small(own.select(F.col("o.__mid").alias("k_mid"), (F.col("f.first") + inner).alias("__k")))


class Tree:
    """Nodes as a list of lo, hi (shards lo to hi - 1), d, c, g (what goes left: up to digit g of cell c of dimension d), l, r (sons, -1 at leaves)."""

    def __init__(self, n_shards: int):
        self.nodes = [{"lo": 0, "hi": n_shards, "d": -1, "c": 0, "g": 0, "goal": 0.0, "l": -1, "r": -1}]
        self.depth = 0

    def open(self) -> list[int]:
        return [i for i, n in enumerate(self.nodes) if n["l"] < 0 and n["hi"] - n["lo"] > 1]

    def column(self) -> Column:
        """The table of nodes: text to the plan, an array to the rows."""
        return F.from_json(F.lit(json.dumps(self.nodes)), "array<struct<lo:int,hi:int,d:int,c:int,g:int,goal:double,l:int,r:int>>")

    def node(self) -> Column:
        """The number of the leaf of a row, from ``at`` (its coordinates) and ``digit``."""
        table = self.column()

        def step(i: Column, _: Column) -> Column:
            n = F.get(table, i)
            v = F.get(F.col("at"), n["d"])
            return F.when(n["l"] < 0, i).when((v < n["c"]) | ((v == n["c"]) & (F.col("digit") <= n["g"])), n["l"]).otherwise(n["r"])

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth + 1)), F.lit(0), step)

    def split(self, i: int, d: int, c: int, g: int) -> None:
        n, k = self.nodes[i], len(self.nodes)
        mid = n["lo"] + (n["hi"] - n["lo"]) // 2
        n |= {"d": d, "c": c, "g": g, "l": k, "r": k + 1}
        self.nodes += [{"lo": lo, "hi": hi, "d": -1, "c": 0, "g": 0, "goal": 0.0, "l": -1, "r": -1} for lo, hi in ((n["lo"], mid), (mid, n["hi"]))]


def _split_level(points: DataFrame, tree: Tree) -> bool:
    """Split every leaf that must become more than one shard; False if there is none."""
    open_ = tree.open()
    if not open_:
        return False
    info = lambda: F.get(tree.column(), F.col("node"))
    at = points.withColumn("node", tree.node()).withColumn("k", info()["hi"] - info()["lo"]).filter("k > 1")
    dims = F.posexplode("at").alias("dim", "cell")
    cells = at.select("node", "k", "__size", dims).groupBy("node", "k", "dim", "cell").agg(F.sum("__size").alias("w"))
    one = Window.partitionBy("node", "dim")
    cells = (
        cells.withColumn("wide", F.max("cell").over(one) - F.min("cell").over(one))
        .withColumn("goal", F.sum("w").over(one) * F.floor(F.col("k") / 2) / F.col("k"))
        .withColumn("upto", F.sum("w").over(one.orderBy("cell")))
        .filter((F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("w") < F.col("goal")))
        .groupBy("node").agg(F.max_by(F.struct("dim", "cell", (F.col("goal") - F.col("upto") + F.col("w")).alias("goal")), F.struct("wide", -F.col("dim"))).alias("s"))
    )
    for r in cells.collect():  # one row a node
        tree.nodes[r["node"]] |= {"d": r["s"]["dim"], "c": r["s"]["cell"], "goal": float(r["s"]["goal"])}
    inside = at.filter(F.get(F.col("at"), info()["d"]) == info()["c"])
    digits = inside.groupBy("node", "digit").agg(F.sum("__size").alias("w")).withColumn("goal", info()["goal"])
    upto = F.sum("w").over(Window.partitionBy("node").orderBy("digit"))
    digits = digits.withColumn("off", F.abs(upto - F.col("goal"))).groupBy("node").agg(F.min_by("digit", F.struct("off", "digit")).alias("digit"), F.min("off").alias("off"))
    nearest = {r["node"]: r for r in digits.collect()}  # one row a node
    for i in open_:
        n = tree.nodes[i]
        if i in nearest:
            # nothing of the cell may be nearer than its first digit
            tree.split(i, n["d"], n["c"], nearest[i]["digit"] if nearest[i]["off"] <= n["goal"] else -1)
        else:  # a node without rows
            tree.split(i, 0, 0, 0)
    tree.depth += 1
    return True


def _placed(rows: DataFrame, n_shards: int | None, target_bytes: int | None) -> DataFrame:
    """``rows`` (the columns of a point, kept in the shared folder) with shard and slot."""
    total, n_rows = rows.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count("*")).first()
    if n_shards is None:
        n_shards = max(1, math.ceil(total / target_bytes))
    axes, cell = checkpointed(_axes(rows)), []
    values = {r["dim"]: r["count"] for r in axes.groupBy("dim").count().collect()}  # three rows
    for i in range(3):
        axis = axes.filter(F.col("dim") == i).select(F.col("value").alias(f"a{i}"), F.col("cell").alias(f"c{i}"))
        cell.append((F.broadcast(axis) if values.get(i, 0) <= BROADCAST_ROWS else axis, F.col(f"__v{i}") == F.col(f"a{i}")))
    numbers = _numbered(rows)
    hashed = lambda what, n: F.pmod(F.xxhash64(F.lit(what), F.col("__id"), F.col("__crc"), F.col("__size"), F.coalesce("__k", F.lit(0).cast("long"))), F.lit(n)).cast("int")

    def coordinates(some: DataFrame) -> DataFrame:
        for axis, on in cell:
            some = some.join(axis, on)
        some = some.withColumn("__k", F.lit(0).cast("long")) if numbers is None else some.join(numbers, F.col("__mid") == F.col("k_mid"), "left")
        return some.withColumn("at", F.array("c0", "c1", "c2")).withColumn("digit", hashed("shard", DIGITS))

    points = checkpointed(coordinates(rows).select("__size", "at", "digit"))
    tree = Tree(n_shards)
    while _split_level(points, tree):
        pass
    # slots: numbers inside each bucket of a shard, after the rows of the buckets before it
    buckets = max(SLOTS, math.ceil(n_rows / n_shards / SLOT_ROWS))
    shard_of = lambda some: coordinates(some).withColumn("shard", F.get(tree.column(), tree.node())["lo"]).withColumn("bucket", hashed("slot", buckets))
    counts = shard_of(rows).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("shard").alias("o_shard"), F.col("bucket").alias("o_bucket"), before.alias("first"))
    if n_shards * buckets <= BROADCAST_ROWS:  # one row a bucket
        offsets = F.broadcast(offsets)
    inner = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("__id", "__crc", "__size", "__k"))
    out = shard_of(rows).withColumn("rn", inner).join(offsets, (F.col("shard") == F.col("o_shard")) & (F.col("bucket") == F.col("o_bucket")))
    return out.withColumn("slot", (F.col("first") + F.col("rn") - 1).cast("long"))


def shard(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row, by the law ``bytes``.

    Either the number of shards or the bytes a shard should have.  Null texts have
    only the overhead, null names are like empty ones, equal rows (and rows without an
    id) are rows of their own that spread over shards, an empty table gives an empty
    result, and other columns don't matter, whatever their names.  Slots count from 0
    in each shard.
    """
    own = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(source_col).alias("s"), F.col(lang_col).alias("l"))
    points = checkpointed(_with_points(own, "i", "t", "s", "l").select(*_POINT))
    out = _placed(points, n_shards, target_bytes)
    return out.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` with size, shard and slot, placed as by ``shard``.

    Rows are written to the shared folder with their points; places are found from those
    alone, and texts are shuffled once, to meet their place by the number of the row.  Nulls, equal rows and
    empty tables are as in ``shard``; a column of docs that is named as an added one
    (in any case) keeps its place and gets the prefix ``doc_``.
    """
    own = docs.toDF(*[f"x{i}" for i in range(len(docs.columns))])
    at = {c: f"x{i}" for i, c in enumerate(docs.columns)}
    folder = scratch(docs.sparkSession, "points")
    _with_points(own, at[id_col], at[text_col], at[source_col], at[lang_col]).write.option("compression", "zstd").parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    places = _placed(rows.select(*_POINT), n_shards, None).select(F.col("__mid").alias("p_mid"), "shard", "slot")
    out = rows.join(places, F.col("__mid") == F.col("p_mid"))
    names = [f"doc_{c}" if c.lower() in ("size", "shard", "slot") else c for c in docs.columns]
    return out.select(*own.columns, F.col("__size").alias("size"), "shard", "slot").toDF(*names, "size", "shard", "slot")
