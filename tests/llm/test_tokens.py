"""Token counts against the library over whole texts."""

import random

import pytest

from promptlake.llm import tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.mark.parametrize("cache", [0, 3, 10_000])
def test_parts_add_up(library, model, cache):
    r = random.Random(1)
    table = tokens.Table(model, "the a é", bytes(len(library.encode(w)) for w in ("the", "a", "é")), False)
    lengths = tokens.Lengths(table, cache)
    some = [" ", "  ", "     ", "\n", "\n\n", "\t", "\r", "\r\n", "▁", "▁▁", "a", "the", "é", "é", "1", "23", "x", " a", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "😀", "한", " ", "　", ");\r", "//", "==", "word" * 40]
    for _ in range(5000):
        t = "".join(r.choice(some) for _ in range(r.randint(0, 25)))
        assert lengths.of(t) == len(library.encode(t)), t
        assert len(lengths) <= 3 + max(cache, 1)


def test_counts_of_documents(spark, docs, rows, library):
    got = sorted(map(tuple, tokens.count_tokens(docs, PATH, max_tokens=1000).collect()), key=repr)
    want = [(r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 1000) for r in rows]
    assert got == sorted(want, key=repr) and any(w[3] for w in want)
    small = tokens.count_tokens(docs, PATH, max_tokens=1000, sample_rows=10, table_words=20)  # a table of a sample changes nothing
    assert sorted(map(tuple, small.collect()), key=repr) == got


def test_very_long_texts(spark, library):
    long = ["x" * 300_000, "ab " * 200_000, " " * 100_000, "\n" * 50_000, "한글" * 50_000]
    d = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(d, PATH).collect()} == {i: len(library.encode(t)) for i, t in enumerate(long)}


def test_table(docs, model):
    t = tokens.frequent(docs, model, table_words=50)
    assert 10 < len(t.words.split(" ")) == len(t.lengths) <= 50 and not t.whole


def test_models_that_reach_across(model):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    assert not tokens.reaches_across(model)
    m.pieces[5000].piece = "of▁the"
    assert tokens.reaches_across(m.SerializeToString())
    m.ParseFromString(model)
    m.normalizer_spec.remove_extra_whitespaces = True
    assert tokens.reaches_across(m.SerializeToString())
    assert tokens.Lengths(tokens.Table(m.SerializeToString(), "", b"", True)).of("a  b") == 2  # whole texts are asked for


def test_empty(empty):
    assert tokens.count_tokens(empty, PATH).collect() == []
