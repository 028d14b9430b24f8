"""Conversation repair against searches of its own."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from promptlake.llm import repair

SPACE = " \t\n\x0b\x0c\r"
INF = (10**9, "")


def damage(rows):
    """Rows (conv_id, turn, role, text) after damage, each conversation's in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(conv, [])
        out[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    return {c: sorted(r, key=order) for c, r in out.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """From the end: the least (cost, audit) of what follows row i when ``need`` comes next and ``odd`` says that a system turn may still come."""
    best = {}
    n = len(rows)

    def at(i, state, inserts=0):
        if (i, state, inserts) in best:
            return best[i, state, inserts]
        ways = [(0, "")] if i == n and state in ("start", "end") else []
        step = {"start": {"s": "s", "u": "a"}, "s": {"u": "a"}, "a": {"a": "end"}, "end": {"u": "a"}}[state]
        add = lambda cost, edit, rest: ways.append((cost + rest[0], edit + rest[1])) if rest != INF else None
        if inserts < 3:
            for r in "ua":
                if r in step:
                    add(3, "I", at(i, step[r], inserts + 1))
        if i < n:
            add(4, "D", at(i + 1, state))
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] else 0
                if rows[i][1][:1] in step:
                    add(more, "K", at(i + 1, step[rows[i][1][:1]]))
                for r in "ua":
                    if r in step:
                        add(3 + more, "R", at(i + 1, step[r]))
        best[i, state, inserts] = min(ways, default=INF)
        return best[i, state, inserts]

    for i in range(n, -1, -1):
        for state in ("a", "s", "end", "start"):
            at(i, state)
    return best[0, "start", 0]


def applied(rows, audit):
    size, rest, out = len(audit.replace("D", "")), iter(rows), []
    want = ("s" if size % 2 else "") + "ua" * (size // 2)
    for e in audit:
        row = next(rest) if e != "I" else None
        if e != "D":
            x = want[len(out)]
            out.append((row[1], row[2]) if e == "K" else ({"u": "user", "a": "assistant"}[x], row[2] if e == "R" else ""))
            assert e != "K" or row[1][:1] == x
    assert next(rest, None) is None
    return out


def expected(rows):
    found = faults(rows)
    cost, audit = cheapest(rows, found)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(rows))
    lines = "\n".join(f"{r}:{t}" for r, t in applied(rows, audit))
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, gaps string, n string, tag string, h string, audit string"


@pytest.fixture(scope="module")
def turns():
    r = random.Random(5)
    rows = []
    for conv in range(150):
        n, at = r.choice([1, 2, 3, 5, 8, 20]), 0
        for i in range(n):
            at += r.choice([1, 1, 1, 2])
            role = r.choice(["system", "user", "assistant", None, "tool", ""]) if r.random() < 0.25 else "user" if i % 2 == 0 else "assistant"
            text = r.choice(["Yes.", "No!", "cut off", " ", "", None, "é. ", "Why?\n\t"]) if r.random() < 0.6 else f"Text {r.random()}."
            rows.append((conv, None if r.random() < 0.05 else at, role, text))
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b.")] + [(7, 3, "user", "same.")] * 5
    rows += [(900, i, "user" if i % 2 == 0 else "assistant", f"{i}." if i % 7 else "open") for i in range(3000)]  # a long one
    rows += [(901, 0, "system", "x" * 300_000 + "."), (901, 1, "user", "y " * 200_000)]
    rows += [(902, i, "assistant", "one and the same") for i in range(40)]
    return [(*x, *["clash"] * 5) for x in rows]


@pytest.mark.parametrize("piece", [repair.PIECE_ROWS, 7])
def test_repairs_against_search(spark, turns, piece):
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repairs(repair.damaged(spark.createDataFrame(turns, SCHEMA).repartition(6)), piece).collect()}
    want = {c: expected(rows) for c, rows in damage([t[:4] for t in turns]).items()}
    assert out.keys() == want.keys()
    for c in want:
        assert out[c] == want[c], c
    assert any(not r for r in damage([t[:4] for t in turns]).values())  # some conversation has lost all its rows


def test_pieces_add_up():
    """Parsed in pieces from every stack, conversations cost what they cost at once, and as the least of all edits."""
    r = random.Random(8)
    for _ in range(300):
        rows = [(i, r.choice(["system", "user", "assistant", "x"]), r.choice(["a.", "b.", "c", "", f"{i}."])) for i in range(r.randint(0, 12))]
        found = faults(rows)
        kinds = [{"blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.CUT, "": repair.NONE}[f] for f in found]
        at_once = repair.begun()
        for (_, role, _), k in zip(rows, kinds, strict=True):
            at_once = repair.read(at_once, role[:1], k)
        assert repair.ended(at_once) == cheapest(rows, found)
        tops, cut = repair.begun(), r.randint(1, 4)
        for i in range(0, len(rows), cut):
            part = [{"turn": t, "role": x, "h": "", "initial": x[:1], "fault": k, "n": 1} for (t, x, _), k in zip(rows[i : i + cut], kinds[i : i + cut], strict=True)]
            tops = repair.composed(tops, [(m["a"], m["b"], m["cost"], m["audit"]) for m in repair._piece(1, part, False)["moves"]])
        assert repair.ended(tops) == repair.ended(at_once)


def test_every_edit_tried():
    """The least of all edits of short conversations, tried one by one."""
    def tried(rows, found):
        best = INF
        per_row = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in found]
        gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
        for edits in itertools.product(*per_row):
            for ins in itertools.product(gaps, repeat=len(rows) + 1):
                cost, audit, roles = 0, "", ""
                for i in range(len(rows) + 1):
                    cost, audit, roles = cost + 3 * len(ins[i]), audit + "I" * len(ins[i]), roles + "".join(ins[i])
                    if i < len(rows):
                        e = edits[i]
                        cost += {"D": 4, "K": 0}.get(e, 3) + (3 if found[i] == "truncated" and e != "D" else 0)
                        audit += e[0]
                        roles += "" if e == "D" else rows[i][1][:1] if e == "K" else e[1]
                if re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best, (cost, audit))
        return best

    for names in itertools.product(["system", "user", "assistant"], repeat=2):
        for texts in (["a.", "b."], ["a", "b."], ["a.", ""]):
            rows = [(i, x, t) for i, (x, t) in enumerate(zip(names, texts, strict=True))]
            assert cheapest(rows, faults(rows)) == tried(rows, faults(rows))


def test_repaired_turns(spark, turns):
    t = repair.damaged(spark.createDataFrame(turns, SCHEMA))
    got = {}
    for r in repair.repaired_turns(t).orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c, rows in damage([x[:4] for x in turns]).items():
        assert got.get(c, []) == applied(rows, cheapest(rows, faults(rows))[1])


def test_empty(spark):
    assert repair.repairs(repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []
    assert repair.repairs(spark.createDataFrame([], "conv_id string, turn int, role string, text string")).collect() == []
