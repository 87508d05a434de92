import hashlib
import math
import random
import zlib
from collections import Counter

import pytest

from llm.edges import documents, edge_texts, prose
from urbanlake.llm import resampling


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if c.isascii() else c
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def grams(text, longest):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=10, longest=1, buckets=10_000, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in grams(t, longest))
    t = Counter(bucket(f) for x in target for f in grams(x, longest))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, text in rows:
        found = grams(text, longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(found), weight, score, None, len(words_of(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[: len(fit) * percent // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def found(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(map(tuple, df.collect()))


TARGET = [prose(70, 60), None, "", prose(71, 200), "BENCH mark Élan"]


@pytest.mark.parametrize(("longest", "block", "percent"), [(1, resampling.BLOCK_ROWS, 10), (1, 7, 30), (3, 16, 50), (1, 5, 100), (1, 5, 0)])
def test_equals_brute_force(spark, longest, block, percent):
    rng = random.Random(4)
    texts = edge_texts() + [prose(rng.randrange(9999), rng.randrange(1, 80)) for _ in range(300)] + ["MiXed Çase É É a-b_c 9"] * 5
    ids = list(range(1, len(texts) + 1))
    ids[20:24] = [None, None, 3, 3]
    docs = documents(spark, texts, ids).repartition(5)
    target = documents(spark, TARGET)
    got = resampling.resample(docs, target, percent=percent, longest=longest, block_rows=block)
    assert found(got) == brute(list(zip(ids, texts)), TARGET, percent, longest)


def test_ties_among_copies(spark):
    """A third of the rows has one text and no id: equal keys but for their place."""
    rows = [(None, prose(5, 30))] * 40 + [(i, prose(i, 40)) for i in range(80)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(4)
    for percent in (5, 50, 100):
        got = resampling.resample(docs, documents(spark, TARGET), percent=percent, block_rows=4)
        assert found(got) == brute(rows, TARGET, percent)


def test_empty_tables(spark):
    nothing, some = documents(spark, []), documents(spark, [prose(1, 50), None])
    assert resampling.resample(nothing, some).collect() == []
    assert found(resampling.resample(some, nothing, percent=100)) == brute([(1, prose(1, 50)), (2, None)], [], 100)


def test_long_texts_are_read_in_stretches(monkeypatch):
    text = ("Ab-cd É9 " * 50 + "x" * 300).encode()
    whole = list(resampling.features(text, 3))
    monkeypatch.setattr(resampling, "STRETCH", 16)
    parts = list(resampling.features(text, 3))
    assert len(parts) > len(whole)
    assert Counter(f for p in parts for f in p) == Counter(f for p in whole for f in p)
    assert [f.decode() for p in whole for f in p] == grams(text.decode(), 3)


@pytest.mark.parametrize("block", [2, 9, 1000])
def test_cutoff_is_the_exact_key(spark, block):
    rng = random.Random(block)
    keys = [(rng.randrange(-20, 20), 0, rng.randrange(30), rng.randrange(4), n) for n in range(500)]
    table = spark.createDataFrame(keys, ", ".join(f"{k} long" for k in resampling.KEY)).repartition(6)
    for rank in (1, 2, 17, 250, 499, 500):
        assert resampling.cutoff_key(table, rank, block) == sorted(keys)[rank - 1]
    assert resampling.cutoff_key(table, 0, block) is None and resampling.cutoff_key(table, 501, block) is None


def test_pivot_discards_a_guaranteed_share(spark):
    keys = [(n * n % 997, 0, n, 0, n) for n in range(997)]
    table = spark.createDataFrame(keys, ", ".join(f"{k} long" for k in resampling.KEY)).repartition(8)
    _, medians, _ = resampling._sides(table, None, 16)
    pivot = resampling.weighted_median(medians)
    below = sum(k < pivot for k in keys)
    assert len(keys) / 8 <= below <= len(keys) * 7 / 8
    before, after, at = resampling._sides(table, pivot, 16)
    assert (sum(n for _, n in before), at, sum(n for _, n in after)) == (below, 1, len(keys) - below - 1)
