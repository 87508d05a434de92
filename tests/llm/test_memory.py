"""Python workers are reused: a task leaves none of its memory behind."""

import pyarrow as pa

from urbanlake.llm import common, packing


def test_batches_begin_and_end_with_a_trim(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "trim_memory", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"])], names=["text"])
    assert [b.num_rows for b in common.per_batch(lambda b: b)(iter([batch, batch]))] == [2, 2] and len(calls) == 2
    assert list(common.per_batch(lambda b: b)(iter([]))) == [] and len(calls) == 4
    common.trim_memory()


def test_remembered_words_are_bounded():
    assert packing.MAX_WORDS <= 200_000
