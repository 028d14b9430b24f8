r"""Conversations repaired to an order of roles by a generalised LR parser with edits.

The order is ``(s?(ua)+)?`` over role initials, by the grammar C -> . | P | s P and
P -> P u a | u a.  The parser's stacks share nodes in a graph: a node is a state and the
node below it, and equal tops are one top.  For each row every top is tried with all
actions: delete it, keep it (a shift of its initial), give it the role user or assistant,
and, between rows, insert either.  Tops that become equal are merged by the smaller cost,
then the smaller audit (the initials of the edits: D, I, K, R).  That is exact: a cost
follows from the audit and the rows, so of two audits of equal cost neither begins the
other, and what comes after changes no comparison.

A conversation may be of any length.  What is parsed are rows without texts (a digest
stands for the text, equal rows are one row with a number), range-partitioned in order,
so that a long one spreads over tasks.  Pieces of it are parsed from each of the eight
stacks there are, and say what they cost from stack to stack; composed in order they are
the parse of the whole.  Then texts stream by, sorted, beside the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, shuffle_parts

#: Costs of edits, and what keeping or reroling a truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a piece.
PIECE_ROWS = 4096
ROLES = {"u": "user", "a": "assistant"}
NONE, BLANK, DUPLICATE, CUT = range(4)

# The LR(0) automaton: shifts, reductions (length, and what it becomes), states in which the input may end.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
_REDUCE = {5: 2, 7: 3}
_GOTO = {0: 3, 1: 4}
_ENDS = (0, 3, 4)

Top = tuple[int, "Top | None"]
Best = tuple[int, str]


def _shifted(top: Top, symbol: str) -> Top | None:
    """The stack after a symbol and the reductions it allows; None where it can't come."""
    state = _SHIFT.get((top[0], symbol))
    if state is None:
        return None
    node: Top = (state, top)
    while node[0] in _REDUCE:
        for _ in range(_REDUCE[node[0]]):
            node = node[1]
        node = (_GOTO[node[0]], node)
    return node


def _graph() -> tuple[list[Top], list[dict[str, int]]]:
    """All stacks between two rows, and where each goes by each symbol."""
    tops: list[Top] = [(0, None)]
    for top in tops:  # grows meanwhile
        tops += [n for n in dict.fromkeys(_shifted(top, x) for x in "sua") if n is not None and n not in tops]
    return tops, [{x: tops.index(n) for x in "sua" if (n := _shifted(t, x)) is not None} for t in tops]


TOPS, MOVES = _graph()


def _merge(tops: dict[int, Best], top: int, found: Best) -> bool:
    if top not in tops or found < tops[top]:
        tops[top] = found
        return True
    return False


def inserted(tops: dict[int, Best]) -> dict[int, Best]:
    """``tops`` and what insertions make of them."""
    todo = list(tops)
    while todo:
        top = todo.pop()
        cost, audit = tops[top]
        todo += [n for r in ROLES if (n := MOVES[top].get(r)) is not None and _merge(tops, n, (cost + INSERT, audit + "I"))]
    return tops


def read(tops: dict[int, Best], initial: str, fault: int, copies: int = 1) -> dict[int, Best]:
    """``tops`` after a row and its further copies, which are deleted as duplicates."""
    new: dict[int, Best] = {}
    more = TRUNCATED if fault == CUT else 0
    again = (copies - 1) * DELETE, (copies - 1) * "D"
    for top, (cost, audit) in tops.items():
        _merge(new, top, (cost + DELETE + again[0], audit + "D" + again[1]))
        if fault in (NONE, CUT):
            moves = MOVES[top]
            if initial in moves:
                _merge(new, moves[initial], (cost + more + again[0], audit + "K" + again[1]))
            for r in ROLES:
                if r in moves:
                    _merge(new, moves[r], (cost + more + REROLE + again[0], audit + "R" + again[1]))
    return inserted(new)


def begun() -> dict[int, Best]:
    return inserted({0: (0, "")})


def ended(tops: dict[int, Best]) -> Best:
    return min(b for t, b in tops.items() if TOPS[t][0] in _ENDS)


def composed(tops: dict[int, Best], piece: list[tuple[int, int, int, str]]) -> dict[int, Best]:
    """``tops`` after a piece that says (from, to, cost, audit)."""
    new: dict[int, Best] = {}
    for a, b, cost, audit in piece:
        if a in tops:
            _merge(new, b, (tops[a][0] + cost, tops[a][1] + audit))
    return new


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


_PIECE = "first boolean, moves array<struct<a:int,b:int,cost:long,audit:string>>, blank long, duplicate long, truncated long, illegal long, left string, right string"


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema, piece_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows in order to pieces.  The first conversation of a partition may have begun in the one before, so it is parsed from each stack."""
    inside = False
    for conv, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
        start = inside
        at_hand: list[dict] = []
        for r in rows:
            at_hand.append(r)
            if len(at_hand) == piece_rows:
                yield pa.RecordBatch.from_pylist([_piece(conv, at_hand, start)], schema)
                at_hand, start = [], False
        if at_hand:
            yield pa.RecordBatch.from_pylist([_piece(conv, at_hand, start)], schema)
        inside = True


def _piece(conv: object, rows: list[dict], start: bool) -> dict:
    ways = {0: begun()} if start else {a: {a: (0, "")} for a in range(len(TOPS))}
    n, illegal, last = {BLANK: 0, DUPLICATE: 0, CUT: 0, NONE: 0}, 0, None
    for r in rows:
        n[r["fault"]] += 1
        n[BLANK if r["fault"] == BLANK else DUPLICATE] += r["n"] - 1
        illegal += (r["n"] - 1) + (last is not None and last + r["initial"] not in ("su", "ua", "au"))
        last = r["initial"]
        ways = {a: read(tops, r["initial"], r["fault"], r["n"]) for a, tops in ways.items()}
    moves = [{"a": a, "b": b, "cost": cost, "audit": audit} for a, tops in ways.items() for b, (cost, audit) in tops.items()]
    return {"conv_id": conv, "turn": rows[0]["turn"], "role": rows[0]["role"], "h": rows[0]["h"], "first": start, "moves": moves,
            "blank": n[BLANK], "duplicate": n[DUPLICATE], "truncated": n[CUT], "illegal": illegal, "left": rows[0]["initial"], "right": last}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped) of every row, damaged by crc32(conv_id:turn) modulo 20; nulls are a space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _faulted(turns: DataFrame) -> DataFrame:
    """Distinct rows without texts, with the first fault of the first copy."""
    letter = r"[^\x20\x09-\x0D]"
    rows = turns.filter("copies > 0").select("conv_id", "turn", "role", F.sha2("text", 256).alias("h"), (~F.col("text").rlike(letter)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"), "copies")
    rows = rows.groupBy("conv_id", "turn", "role", "h", "blank", "cut").agg(F.sum("copies").alias("n"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "h").orderBy("turn")) > 1
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    return rows.select("conv_id", "turn", "role", "h", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"), "n")


def _counted(turns: DataFrame) -> DataFrame:
    """Gaps of every conversation, of those without rows too."""
    there = F.when(F.col("copies") > 0, F.col("turn"))
    return turns.groupBy("conv_id").agg(F.coalesce(F.max(there) - F.min(there) + 1 - F.count_distinct(there), F.lit(0)).cast("long").alias("gaps"))


def _parsed(turns: DataFrame, piece_rows: int) -> DataFrame:
    parts = shuffle_parts(turns.sparkSession)
    rows = _faulted(turns).repartitionByRange(parts, "conv_id", "turn", "role", "h").sortWithinPartitions("conv_id", "turn", "role", "h")
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in ("conv_id", "turn", "role", "h")) + ", " + _PIECE
    to = _arrow(turns, schema)
    return rows.mapInArrow(lambda b: _pieces(b, to, piece_rows), schema)


def _arrow(turns: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(turns.sparkSession.createDataFrame([], schema).schema)


class _Conversation:
    """What the pieces of a conversation say together."""

    def __init__(self) -> None:
        self.tops, self.last, self.gaps = begun(), None, 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, piece: dict) -> None:
        moves = [(m["a"], m["b"], m["cost"], m["audit"]) for m in piece["moves"]]
        self.tops = composed({0: (0, "")} if piece["first"] else self.tops, moves)
        for k in self.counts:
            self.counts[k] += piece[k]
        self.counts["illegal"] += self.last is not None and self.last + piece["left"] not in ("su", "ua", "au")
        self.last = piece["right"]

    def turns(self, audit: str, rows: Iterator[dict]) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of each row that stays or comes, in order; rows are read as the edits go."""
        size, place, copies, row = len(audit) - audit.count("D"), 0, 0, None
        for edit in audit:
            if edit != "I":
                if not copies:
                    row = next(rows)
                    copies = row["n"]
                copies -= 1
            if edit == "D":
                continue
            # a size that is odd begins with a system turn, which is kept
            yield edit, row["role"] if edit == "K" else ROLES["ua"[(place + size) % 2]], "" if edit == "I" else row["text"]
            place += 1


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Conversation, Iterator[dict]]]:
    """Conversations of a sorted partition, each with its rows still to be read."""
    for conv, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
        c, first = _Conversation(), []
        for r in rows:
            if r["tag"] == 0:
                c.gaps = r["gaps"]
            elif r["tag"] == 1:
                c.add(r)
            else:
                first.append(r)
                break
        yield conv, c, chain(first, rows)


def _beside(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    """For each conversation its counts, then its pieces, then its rows, in order, in one partition."""
    kept = turns.filter("copies > 0").withColumn("h", F.sha2("text", 256)).withColumnRenamed("copies", "n")
    both = _counted(turns).withColumn("tag", F.lit(0)).unionByName(pieces.withColumn("tag", F.lit(1)), allowMissingColumns=True).unionByName(kept.withColumn("tag", F.lit(2)), allowMissingColumns=True)
    return both.repartition(shuffle_parts(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "h")


def _prepared(turns: DataFrame) -> DataFrame:
    named = turns if "copies" in turns.columns else turns.withColumn("copies", F.lit(1))
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return named.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), F.col("copies").cast("long").alias("copies"))


def repaired_turns(turns: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role and text of the repaired conversations; rules as in ``repairs``."""
    t = _prepared(turns)
    schema = f"conv_id {dict(t.dtypes)['conv_id']}, place long, edit string, role string, text string"
    to = _arrow(turns, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for conv, c, rows in _stream(batches):
            for i, (edit, role, text) in enumerate(c.turns(ended(c.tops)[1], rows)):
                held.append({"conv_id": conv, "place": i, "edit": edit, "role": role, "text": text})
                if len(held) == 1000:
                    yield pa.RecordBatch.from_pylist(held, to)
                    held = []
        yield pa.RecordBatch.from_pylist(held, to)

    return _beside(t, checkpointed(_parsed(t, piece_rows))).mapInArrow(run, schema)


def repairs(turns: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    ``turns`` has conv_id, turn, role, text and may have copies (0: the row is gone, but
    its conversation is answered; more: it repeats).  Rows go by turn, null ones first;
    equal turns by role, then by the digest of the text.  Null roles and texts are a
    space, so such a text is blank and such a role has to be changed.  Rows without a
    conversation form one.  Repeated rows are duplicates of the first.  Very long texts
    are hashed as they are, very long conversations in pieces; their edits, as the result
    holds them, and one batch of their rows are what a task has in memory.  An empty
    table gives an empty result; other columns don't matter, whatever their names.
    """
    t = _prepared(turns)
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    schema = f"conv_id {dict(t.dtypes)['conv_id']}, {counts}, audit string, repaired_sha256 string"
    to = _arrow(turns, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for conv, c, rows in _stream(batches):
            cost, audit = ended(c.tops)
            digest, between = hashlib.sha256(), b""
            for _, role, text in c.turns(audit, rows):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            held.append({"conv_id": conv, "gaps": c.gaps, **c.counts, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()})
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, to)
                held = []
        yield pa.RecordBatch.from_pylist(held, to)

    return _beside(t, checkpointed(_parsed(t, piece_rows))).mapInArrow(run, schema)

