import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, name string, t string"


def make_rows(seed: int = 3, n: int = 90):
    """Documents with copies, near copies, shared passages, nulls, empty, long and odd texts, repeated rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghiéü") for _ in range(r.randint(2, 7))) for _ in range(400)]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage = "\n".join(say(25) for _ in range(4))
    rows = []
    for i in range(n):
        kind = i % 9
        text = "\n".join(say(r.randint(5, 30)) for _ in range(r.randint(1, 6)))
        if kind == 1:
            text = text + "\n" + passage + "\n" + say(10)
        elif kind == 2 and rows:
            text = rows[r.randrange(len(rows))][1]
        elif kind == 3:
            base = next((x[1] for x in reversed(rows) if x[1] and len(x[1].split()) > 40), text).split(" ")
            base[len(base) // 2] = "changed"
            text = " ".join(base)
        rows.append((1000 + i, text, r.choice(["en", "de", None]), r.choice(["a", "b", "c", None, "hot", "hot", "hot"])))
    rows += [(1, None, "en", "a"), (2, "", None, None), (3, "one", "en", "b"), (4, "one two", "en", "b"), (5, "\n\n \n", "en", "b"), (6, "ab " * 400, "de", "c"), (7, "x" * 700, "de", "c"), (8, "# | # $ " * 90, "en", "a"), (9, say(6000), "en", "a")]
    rows += [rows[0], rows[0], (None, say(60), "en", "a"), (None, None, None, None), (10, "THE Same\tText " * 30, "en", "d"), (11, "the same text " * 30, "en", "d")]
    return [(*x, len(x[1] or ""), "clash", "clash", "clash") for x in rows]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
