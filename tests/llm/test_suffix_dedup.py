import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm.edges import documents, edge_texts, prose
from urbanlake.llm import suffix_dedup

SIZE = 200


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + SIZE] for t in data for i in range(len(t) - SIZE + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - SIZE + 1):
            if count[t[i : i + SIZE]] > 1:
                gone[i : i + SIZE] = b"\1" * SIZE
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def measured(rows):
    return [(r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]


PASSAGE, FOOTER = prose(99, 70), prose(98, 45)
TEXTS = (
    edge_texts()
    + [prose(s, 40) + " " + PASSAGE + " " + prose(s + 50, 30) for s in range(12)]
    + [prose(s, 20) + FOOTER for s in range(60, 72)]
    + [PASSAGE[:199], PASSAGE[:200], PASSAGE[3:203], "ab" * 150, "ab" * 99 + "c", "Er " * 400, "é" * 150 + prose(5, 60), "é" * 120]
    + ["x" + prose(200, 80), "y" + prose(200, 80)[:-1] + "!"]
)


@pytest.mark.parametrize(("batches", "group_runs"), [(4, suffix_dedup.GROUP_RUNS), (3, 1)])
def test_equals_brute_force(spark, batches, group_runs):
    rows = suffix_dedup.cut_repeats(documents(spark, TEXTS), size=SIZE, batches=batches, group_runs=group_runs).collect()
    assert measured(sorted(rows, key=lambda r: r.doc_id)) == brute(TEXTS)


def test_repeated_rows_null_ids_and_empty_table(spark):
    texts, ids = [prose(1, 80), prose(1, 80), None, prose(2, 80)], [4, 4, None, None]
    rows = suffix_dedup.cut_repeats(documents(spark, texts, ids)).collect()
    assert sorted((r.doc_id or 0, len(r.kept), r.kept_text) for r in rows) == sorted(
        [(4, 0, ""), (4, 0, ""), (0, 0, ""), (0, len(texts[3]), texts[3])]
    )
    assert suffix_dedup.cut_repeats(documents(spark, [])).collect() == []


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    texts = [prose(1, 900), prose(2, 300) + prose(1, 900)[1000:2500] + prose(3, 300), prose(4, 500)]
    found = [list(g) for g in suffix_dedup._pieces([t.encode() for t in texts], SIZE)]
    assert len(found) > 5
    rows = suffix_dedup.cut_repeats(documents(spark, texts)).collect()
    assert measured(sorted(rows, key=lambda r: r.doc_id)) == brute(texts)


def test_cut_characters_are_dropped_from_the_text(spark):
    # the repeated stretch starts in the middle of a character
    text = prose(11, 60)
    rows = suffix_dedup.cut_repeats(documents(spark, ["é" + text, "©" + text, "è" + text])).collect()
    for r in rows:
        bytes(r.kept)
        assert r.kept_text.encode() == bytes(r.kept).decode("utf-8", "ignore").encode()


def test_levels_merge_geometrically(spark):
    texts = documents(spark, [prose(s, 60) for s in range(8)]).select(*suffix_dedup.text_id(suffix_dedup.F.col("text")), "text")
    levels, ranks = suffix_dedup.SuffixLevels(SIZE), []
    for b in range(5):
        levels.add(texts.where(suffix_dedup.F.pmod("tid", suffix_dedup.F.lit(5)) == b))
        ranks.append(sorted(levels.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2]]


def test_size_is_checked(spark):
    with pytest.raises(ValueError):
        suffix_dedup.cut_repeats(documents(spark, []), size=100)


def test_a_batch_and_its_levels_are_written_once(spark, monkeypatch):
    writes, sort = [], suffix_dedup.SuffixLevels._sorted
    monkeypatch.setattr(suffix_dedup.SuffixLevels, "_sorted", lambda self, entries: writes.append(1) or sort(self, entries))
    texts = documents(spark, [prose(s, 60) for s in (1, 2, 1, 3)])
    assert suffix_dedup.cut_repeats(texts, batches=4).where("size(spans) > 0").count() == 2
    assert len(writes) == 4  # a write for each batch, none for a merge


def test_runs_hold_every_string_once_with_its_anchor():
    rng = np.random.default_rng(1)
    for _ in range(100):
        texts = [rng.integers(97, 100, n, dtype=np.uint8).tobytes() for n in rng.choice([0, 5, 199, 200, 201, 700, 3000], rng.integers(1, 8))]
        texts.append(b"ab" * 150)
        lengths = np.array([len(t) for t in texts])
        starts = np.cumsum(lengths) - lengths
        data, strings = b"".join(texts), []
        for text, s, a, w, p, *_ in zip(*suffix_dedup.runs(np.frombuffer(data, np.uint8), starts, lengths, SIZE)):
            assert w <= a <= SIZE - suffix_dedup.KEY + w and int(p) == int.from_bytes(data[s + a : s + a + 8])
            strings += [(text, k - starts[text]) for k in range(s, s + w + 1)]
        assert sorted(strings) == [(i, k) for i, n in enumerate(lengths) for k in range(n - SIZE + 1)]


def test_strings_are_compared_by_both_digests(monkeypatch):
    # one digest alike in all three, the other in the first and the last
    again = np.array([0, 1, 2]), np.zeros(3, np.int64), np.full(3, 5, np.uint64), np.array([7, 8, 7], np.uint64)
    monkeypatch.setattr(suffix_dedup, "_strings", lambda runs, size: again)
    rows = pa.table({"h": [1] * 3, "n": [1] * 3, "tid": [10, 11, 12], "tid2": pa.array([0] * 3, pa.int32()), "s": pa.array([0] * 3, pa.int32()), "run": [b""] * 3})
    assert suffix_dedup._compare(rows, SIZE)["tid"].to_pylist() == [10, 12]
