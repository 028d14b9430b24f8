"""What Python holds of stored mail at a time, however large a range or a batch of messages is."""

import pyarrow as pa
import pytest

from promptlake.sources import mailbox, media

MB = 1 << 20


def message(i):
    return f"Subject: m{i}\nFrom: a@b\n\n{i} ".encode() + b"x" * MB + b"\n"


def test_a_range_is_handed_over_in_small_batches(tmp_path):
    (tmp_path / "box").write_bytes(b"".join(b"From a\n" + message(i) + b"\n" for i in range(20)))
    reader = mailbox._Reader(str(tmp_path), mailbox.SPLIT_BYTES)
    (part,) = reader.partitions()
    batches = list(reader.read(part))
    assert len(batches) == 5 and max(b.nbytes for b in batches) < 5.1 * MB
    assert [c for b in batches for c in b["content"].to_pylist()] == [message(i) for i in range(20)]
    assert [p for b in batches for p in b["message_ord"].to_pylist()] == [x[1] for x in mailbox.read_range(str(tmp_path), part)]


class Messages:
    """Takes what would run on executors."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        self.run = run
        raise StopIteration


def test_parts_are_handed_over_in_small_batches(spark):
    m = Messages()
    with pytest.raises(StopIteration):
        media.mail_parts(m, "q")
    whole = pa.RecordBatch.from_pydict({"message_id": [f"b#{i}" for i in range(20)], "message_ord": list(range(20)), "content": [message(i) for i in range(20)]})
    batches = list(m.run(iter([whole])))
    assert len(batches) == 5 and max(b.nbytes for b in batches) < 5.1 * MB
    rows = [r for b in batches for r in b.to_pylist()]
    assert [(r["message_id"], r["subject"], r["from"], r["gmail_query"], r["part_ord"], len(r["text"])) for r in rows] == [(f"b#{i}", f"m{i}", "a@b", "q", 0, len(f"{i} ") + MB + 1) for i in range(20)]
    assert list(m.run(iter([]))) == []
