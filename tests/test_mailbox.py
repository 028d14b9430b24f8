"""Stored mail: ranges of boxes against the standard library, order, streams."""

import mailbox as standard
import random

import pytest
from pyspark.sql import functions as F

from promptlake.operators import dedup
from promptlake.sources import mailbox, media


def box_of(n, seed=1):
    """The bytes of a box and the messages in it."""
    r = random.Random(seed)
    messages = []
    for i in range(n):
        lines = [f"line {j} " + "x" * r.choice([0, 3, 70, 900 if r.random() < 0.05 else 1]) for j in range(r.randint(0, 6))]
        if i % 4 == 0:
            lines.insert(r.randint(0, len(lines)), r.choice(["From here on", ">From there", " From a space", "", "From:x"]))
        messages.append(f"Subject: m{i}\n\n" + "\n".join(lines) + "\n")
    quoted = ["\n".join(f">{x}" if x.lstrip(">").startswith("From ") else x for x in m.split("\n")) for m in messages]
    return "".join(f"From a@b Mon Jan  2 03:04:05 2023\n{m}\n" for m in quoted).encode(), [m.encode() for m in messages]


@pytest.mark.parametrize("split", [1, 17, 100, 1000, 10**9])
def test_every_message_in_one_range(tmp_path, split, monkeypatch):
    monkeypatch.setattr(mailbox, "CHUNK", 64)
    data, want = box_of(60)
    (tmp_path / "box").write_bytes(data)
    name = str(tmp_path / "box")
    parts = mailbox.planned([(name, 0, len(data), 500)], split)
    assert len(parts) == -(-len(data) // split)
    got = [x for p in parts for x in mailbox.read_range(name, p)]
    assert [c for *_, c in got] == want
    places = [o - 500 for _, o, _ in got]
    assert places == sorted(places) and all(data[p : p + 5] == b"From " for p in places) and got[3][0] == f"{name}#{places[3]}"


def test_as_the_standard_library(tmp_path):
    data, _ = box_of(80, 7)
    (tmp_path / "box").write_bytes(data)
    got = [c for p in mailbox.planned([(str(tmp_path / "box"), 0, len(data), 0)], 333) for *_, c in mailbox.read_range(str(tmp_path), p)]
    theirs = [m.get_payload() for m in standard.mbox(str(tmp_path / "box"))]
    ours = [c.decode().partition("\n\n")[2] for c in got]
    assert len(ours) == 80 and [x.rstrip("\n") for x in ours] == ["\n".join(y[1:] if y.lstrip(">").startswith("From ") else y for y in x.rstrip("\n").split("\n")) for x in theirs]


@pytest.mark.parametrize("odd", [b"", b"no message at all\n", b"preface\n\nFrom a\nSubject: x\n\nb", b"From a\r\nSubject: x\r\n\r\nb\r\n\r\nFrom b\r\n\r\n"])
def test_odd_boxes(tmp_path, odd):
    (tmp_path / "box").write_bytes(odd)
    for split in (1, 5, 1000):
        got = [c for p in mailbox.planned([(str(tmp_path / "box"), 0, len(odd), 0)] if odd else [], split) for *_, c in mailbox.read_range(str(tmp_path), p)]
        assert len(got) == odd.count(b"\nFrom ") + odd.startswith(b"From ")


@pytest.fixture
def mail(tmp_path):
    """Files whose names as texts are in another order than as numbers, and a box between them."""
    top = tmp_path / "mail"
    (top / "sub").mkdir(parents=True)
    for i in (1, 2, 10, 30):
        (top / f"{i}.eml").write_bytes(f"Subject: e{i}\n\nsee https://youtu.be/{i % 2} and https://youtu.be/all".encode())
    (top / "20.box").write_bytes(box_of(30)[0])
    (top / "sub/3.eml").write_bytes(b"Subject: s\n\nhttps://youtu.be/1")
    (top / "_hidden").write_bytes(b"From x\n\nno")
    (top / "empty.eml").write_bytes(b"")
    return top


def test_order_of_a_folder(spark, mail):
    m = media.stored_mail(spark, str(mail), split_bytes=200)
    assert m.rdd.getNumPartitions() > 10
    subjects = [r["subject"] for r in media.mail_parts(m).orderBy("message_ord").collect()]
    assert subjects == ["e1", "e2", "e10", *[f"m{i}" for i in range(30)], "e30", "s"]
    assert m.select("message_ord").distinct().count() == m.count() == 35
    first = {r["url"]: r["source_subject"] for r in dedup.url_queue(dedup.message_urls(media.mail_parts(m))).collect()}
    assert first == {"https://youtu.be/1": "e1", "https://youtu.be/0": "e2", "https://youtu.be/all": "e1"}


def test_stream_of_what_comes(spark, mail, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        rows = media.mail_parts(media.stored_mail(spark, str(mail), stream=True, split_bytes=300)).select("message_id", "message_ord", "subject")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out)

    one = run()
    assert one.count() == one.select("message_ord").distinct().count() == 35
    assert run().count() == 35  # nothing has come
    more = b"From a@b\nSubject: grown\n\nx\n\n"
    with open(mail / "20.box", "ab") as f:
        f.write(more)
    (mail / "4.eml").write_bytes(b"Subject: late\n\ny")
    two = run()
    new = two.filter(F.col("subject").isin("grown", "late"))
    assert two.count() == 37 and {r["subject"] for r in new.collect()} == {"grown", "late"}
    assert new.agg(F.min("message_ord")).first()[0] > two.filter(~F.col("subject").isin("grown", "late")).agg(F.max("message_ord")).first()[0]


def test_missing_folder(spark, tmp_path):
    with pytest.raises(Exception, match="none"):
        media.stored_mail(spark, str(tmp_path / "none")).collect()
