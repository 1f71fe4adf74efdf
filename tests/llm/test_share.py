"""What workers hold of a batch, and what they give back."""

import weakref

import pyarrow as pa

from likertlake.llm import share
from likertlake.llm.share import portions


def test_batches_are_worked_on_in_portions():
    """However many rows a batch has; no row is lost, and one that is larger is a portion of its own."""
    texts = ["x" * (i % 50) if i % 7 else None for i in range(900)] + ["y" * 5000, "", None]
    for values in (texts, [None if t is None else [len(t)] * len(t) for t in texts], [{"a": t, "b": None} for t in texts]):
        batch = pa.array(values).slice(1)
        parts = list(portions([batch, batch[:0]], 2000))
        assert [x.as_py() for p in parts for x in p] == batch.to_pylist() and parts[-1].type == batch.type
        assert len(parts) > 10 and max(map(len, parts)) < 300
    assert [len(p) for p in portions([pa.array(["z" * 9000] * 4)], 2000)] == [1] * 4


def test_what_a_task_held_is_gone_when_memory_is_given_back(monkeypatch):
    held, seen = [], []

    class Table:
        pass

    def fn(batches):
        table = Table()
        held.append(weakref.ref(table))
        yield from batches

    monkeypatch.setattr(share, "give_back", lambda: seen.append(held[0]() is None))
    assert list(share.tidy(fn)(iter([1, 2]))) == [1, 2] and seen == [True]
