r"""Token counts by look-ups on the map side: a broadcast table of frequent pre-tokens, worker caches for the rest.

A text is cut where no piece of the vocabulary can reach across: before a run of spaces
and before a line feed.  Each part (spaces and the word after them, or a line feed and
the word after it) has a number of tokens of its own, and those add up to the text's.

The first tier is a compact table, the most frequent words of a sample of rows and a
byte for the length of each, broadcast with the model.  The second is a cache in each
worker: a part that the table lacks is encoded by the library once and remembered until
the cache is full, then it begins anew.  Neither tier changes a count.  Texts never
leave their task; what is shuffled are the counted words of the sample.

A model whose pieces reach across those places, or which rewrites texts, is asked for
whole texts instead.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

#: Rows (about) whose words fill the table, words in it and characters of each: the bounds of what is broadcast.
SAMPLE_ROWS, TABLE_WORDS, WORD_CHARS = 20_000, 65_536, 48
#: Parts that a worker's cache holds, and the characters of the longest it holds.
CACHE_PARTS, CACHE_CHARS = 600_000, 64
#: Tokens beyond which a document is over the limit.
MAX_TOKENS = 4096

_PARTS = re.compile(r"\n[^ \n]*| +[^ \n]*")
_SPACE = "▁"


@dataclass(frozen=True)
class Table:
    """What is broadcast: the model, the frequent words joined by spaces, a byte for the length of each."""

    model: bytes
    words: str
    lengths: bytes
    whole: bool


def reaches_across(model: bytes) -> bool:
    """Whether the counts of parts may differ from those of their text."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    rules, pieces = m.normalizer_spec, [p.piece for p in m.pieces]
    same = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap and not m.trainer_spec.treat_whitespace_as_suffix
    plain = {pb.ModelProto.SentencePiece.NORMAL, pb.ModelProto.SentencePiece.BYTE, pb.ModelProto.SentencePiece.CONTROL, pb.ModelProto.SentencePiece.UNKNOWN}
    bpe = m.trainer_spec.model_type == pb.TrainerSpec.BPE and all(p.type in plain for p in m.pieces)
    return not (same and bpe and _SPACE in pieces and not any(_SPACE in p.lstrip(_SPACE) or "\n" in p[1:] for p in pieces))


class Lengths(dict):
    """Tokens of parts: the table's, and those asked for since."""

    def __init__(self, table: Table, cache_parts: int = CACHE_PARTS):
        import sentencepiece

        self._encode = sentencepiece.SentencePieceProcessor(model_proto=table.model).encode
        self._frequent = dict(zip((f" {w}" for w in table.words.split(" ")), table.lengths, strict=True)) if table.lengths else {}
        self._full = len(self._frequent) + cache_parts
        self._whole = table.whole
        super().__init__(self._frequent)

    def __missing__(self, part: str) -> int:
        # the library puts a space before every text: a part's own first space, or one too many before a line feed
        n = len(self._encode(part[1:])) if part[1:] and part[0] == " " else len(self._encode(part)) - 1 if part[0] == "\n" else 1
        if len(part) <= CACHE_CHARS:
            if len(self) >= self._full:
                self.clear()
                self.update(self._frequent)
            self[part] = n
        return n

    def of(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if self._whole:
            return len(self._encode(text))
        return sum(map(self.__getitem__, _PARTS.findall(" " + text.replace(_SPACE, " "))))


_WORKER: dict[int, Lengths] = {}


def _lengths(shared: Broadcast) -> Lengths:
    """The tables of this worker, kept while it counts by the same broadcast."""
    if shared._jbroadcast is not None:  # on the driver
        return Lengths(shared.value)
    if id(shared) not in _WORKER:
        _WORKER.clear()
        _WORKER[id(shared)] = Lengths(shared.value)
    return _WORKER[id(shared)]


def _counted(batches: Iterator[pd.DataFrame], shared: Broadcast, words: int) -> Iterator[pd.DataFrame]:
    """The most frequent words of a task, with the tokens of each."""
    seen: Counter[str] = Counter()
    for b in batches:
        for t in b["text"]:
            seen.update(w for w in re.split(r"[ \n▁]+", t) if 0 < len(w) <= WORD_CHARS)
            if len(seen) > 16 * words:
                seen = Counter(dict(seen.most_common(4 * words)))
    of = Lengths(shared.value, 0)
    top = seen.most_common(words)
    if top:
        yield pd.DataFrame({"word": [w for w, _ in top], "tokens": [of[f" {w}"] for w, _ in top], "n": [n for _, n in top]})


def frequent(docs: DataFrame, model: bytes, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, table_words: int = TABLE_WORDS) -> Table:
    """The table for a model, from the words of a sample of about ``sample_rows`` rows."""
    if reaches_across(model):
        return Table(model, "", b"", True)
    spark = docs.sparkSession
    bare = spark.sparkContext.broadcast(Table(model, "", b"", False))
    n = docs.count()
    rows = docs.select(text_of(text_col).alias("text"))
    rows = rows.sample(sample_rows / n, seed=1) if n > sample_rows else rows
    words = rows.mapInPandas(lambda b: _counted(b, bare, table_words), "word string, tokens long, n long")
    counted = checkpointed(words.groupBy("word", "tokens").agg(F.sum("n").alias("n")).filter("n > 1 and tokens < 256"))
    # the least number of occurrences with which all words fit in the table, so that the driver gets no more
    least, room = 2, table_words
    for n, k in sorted(counted.groupBy("n").agg(F.count("*").alias("k")).collect(), reverse=True):
        room -= k
        if room < 0:
            least = n + 1
            break
    top = counted.filter(F.col("n") >= least).select("word", "tokens").collect()
    return Table(model, " ".join(w for w, _ in top), bytes(k for _, k in top), False)


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, **how: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, as a SentencePiece model gives them.

    No begin, end or special tokens are added, strings of special tokens are text, nothing
    is cut or padded.  Null texts are empty, empty ones have no tokens; very long texts are
    counted whole (a run without spaces is one part, encoded whole and not cached);
    repeated rows and equal ids are rows of their own; an empty table gives an empty
    result; other columns don't matter, whatever their names.  The model is read by the
    driver and broadcast, so executors need no file of it.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, model, text_col, **how))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _lengths(shared)
        for texts in batches:
            yield pd.Series([lengths.of(t) for t in texts], dtype="int64")

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens("text").alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > max_tokens)
