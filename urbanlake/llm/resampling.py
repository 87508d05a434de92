"""Target-distribution importance resampling.

Word n-grams are hashed into buckets and counted over the whole corpus and the
whole target.  The buckets' log-likelihood gains are an array that scores every
document; Gumbel noise from a digest of the id turns the scores into a draw
without replacement, so that the draw is the highest scores.

They are found by weighted median-of-medians selection: every block of rows
gives its median key, a task the median of its blocks weighted by their sizes,
the driver the median of the tasks' weighted by theirs.  At least an eighth of
the remaining keys lies on each side of that pivot; one pass counts both sides
and prepares the medians of each, and the side without the cutoff is discarded,
until the pivot is the exact cutoff key.  Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import drop_table, slices, utf8, written

BUCKETS = 10_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A byte that is part of no word: long texts are read in stretches that end there.
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
STRETCH = 1 << 20
#: Features whose gain a task remembers.
REMEMBERED = 500_000
#: Rows of a block, which gives one median.
BLOCK_ROWS = 1 << 16
#: A key: (score descending, no id, id, part, number), the smallest is the best.
KEY = ("down", "no_id", "id", "part", "number")


def words(text: bytes) -> Iterator[list[bytes]]:
    """Words of the lower-cased text, stretch by stretch."""
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + STRETCH) if len(text) > at + STRETCH else None
        end = cut.start() if cut else len(text)
        yield WORD.findall(text[at:end].lower())
        at = end


def features(text: bytes, longest: int) -> Iterator[list[bytes]]:
    """All runs of 1 to ``longest`` words, joined by one space, stretch by stretch."""
    last: list[bytes] = []
    for found in words(text):
        yield found
        run = last + found
        for n in range(2, longest + 1):
            first = max(0, len(last) - n + 1)
            yield [b" ".join(run[i : i + n]) for i in range(first, len(run) - n + 1)]
        last = run[-(longest - 1) :] if longest > 1 else []


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int) -> list[int]:
    """Features per bucket over all rows: a list of ``buckets`` numbers."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        totals = np.zeros(buckets, np.int64)
        for batch in (s for b in batches for s in slices(b)):
            counts: Counter = Counter()
            for text in utf8(batch.column(0)):
                for found in features(text, longest):
                    counts.update(found)
            np.add.at(totals, [zlib.crc32(f) % buckets for f in counts], list(counts.values()))
        there = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(totals[there])], names=["bucket", "n"])

    parts = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of each bucket's share in the target over that in the source."""
    k, s_all, t_all = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k)))) for s, t in zip(source, target)]


def noise(seed: int, doc_id) -> int:
    """floor(1000 x) of a standard Gumbel number drawn by a digest of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], id_col: str, text_col: str, longest: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row, and its place
    (part, number), which tells repeated rows apart."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, gain_of = TaskContext.get().partitionId(), 0, {}
        for batch in (s for b in batches for s in slices(b)):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                n_words = n = total = 0
                for k, found in enumerate(features(text, longest)):
                    if k % longest == 0:
                        n_words += len(found)
                    n += len(found)
                    if len(gain_of) > REMEMBERED:
                        gain_of.clear()
                    gain_of.update((f, gain[zlib.crc32(f) % len(gain)]) for f in set(found).difference(gain_of))
                    total += sum(map(gain_of.__getitem__, found))
                weight = total // n if n else 0
                rows.append((n_words, n, weight, weight + noise(seed, doc_id), part, number))
                number += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = ["doc_id", "n_words", "n_features", "weight", "score", "part", "number"]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The least median at which half of the weight is reached."""
    medians = sorted(medians)
    half, below = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        below += n
        if below >= half:
            return key
    raise ValueError("no keys are left")


def _past(key: tuple) -> Column:
    """Rows whose key comes after ``key``; the first column reaches the scan as a filter."""
    out = F.lit(False)
    for name, value in reversed(list(zip(KEY, key))):
        out = (F.col(name) > value) | ((F.col(name) == value) & out)
    return (F.col(KEY[0]) >= key[0]) & out


def _before(key: tuple) -> Column:
    out = F.lit(False)
    for name, value in reversed(list(zip(KEY, key))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return (F.col(KEY[0]) <= key[0]) & out


def _sides(keys: DataFrame, pivot: tuple | None, block_rows: int) -> tuple[list, list, int]:
    """[(median, rows)] of each task's keys before the pivot and after it, and
    the number of keys at it (without a pivot all come after): one row a task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        medians: tuple[list, list] = ([], [])
        held: tuple[list, list] = ([], [])
        at = 0

        def median(side: int, rows) -> None:
            order = np.lexsort(rows.T[::-1])
            medians[side].append((tuple(rows[order[(len(rows) - 1) // 2]].tolist()), len(rows)))

        def full(side: int, rest: bool = False) -> None:
            """Medians of the full blocks held, and at the end of what remains."""
            if sum(map(len, held[side])) < (1 if rest else block_rows):
                return
            rows = np.concatenate(held[side])
            whole = len(rows) if rest else len(rows) // block_rows * block_rows
            for a in range(0, whole, block_rows):
                median(side, rows[a : min(a + block_rows, whole)])
            held[side][:] = [rows[whole:]] if whole < len(rows) else []

        for batch in batches:
            rows = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), np.int64) for c in batch.columns], axis=1)
            if pivot is None:
                held[1].append(rows)
            else:
                differs = rows != np.array(pivot, np.int64)
                first = differs.argmax(axis=1)
                there = differs.any(axis=1)
                less = there & (rows[np.arange(len(rows)), first] < np.array(pivot, np.int64)[first])
                held[0].append(rows[less])
                held[1].append(rows[there & ~less])
                at += int((~there).sum())
            full(0)
            full(1)
        out = []
        for side in (0, 1):
            full(side, rest=True)
            n = sum(n for _, n in medians[side])
            out.append((n, list(weighted_median(medians[side])) if n else None))
        columns = [pa.array([out[0][0]]), pa.array([out[0][1]], pa.list_(pa.int64())), pa.array([out[1][0]]), pa.array([out[1][1]], pa.list_(pa.int64())), pa.array([at])]
        yield pa.RecordBatch.from_arrays(columns, names=["n_before", "before", "n_after", "after", "n_at"])

    rows = keys.select(*KEY).mapInArrow(run, "n_before long, before array<long>, n_after long, after array<long>, n_at long").collect()
    before = [(tuple(r.before), r.n_before) for r in rows if r.n_before]
    after = [(tuple(r.after), r.n_after) for r in rows if r.n_after]
    return before, after, sum(r.n_at for r in rows)


def cutoff_key(keys: DataFrame, rank: int, block_rows: int = BLOCK_ROWS) -> tuple | None:
    """The ``rank``-th smallest key (from 1) of distinct keys, None beyond them.

    A pass over the remaining keys is a scan with a filter; whenever a
    sixteenth of a table is left, that is written as the next one."""
    table, base = keys, None
    _, medians, _ = _sides(table, None, block_rows)
    size = sum(n for _, n in medians)
    if not 1 <= rank <= size:
        return None
    low, high, left = None, None, size
    while True:
        pivot = weighted_median(medians)
        rest = table
        if low is not None:
            rest = rest.where(_past(low))
        if high is not None:
            rest = rest.where(_before(high))
        if left <= size // 16:
            tasks = max(1, rest.rdd.getNumPartitions() // 8)
            rest, size = written(rest.select(*KEY).coalesce(tasks), "resampling-keys"), left
            if base is not None:
                drop_table(base)
            table = base = rest
        before, after, at = _sides(rest, pivot, block_rows)
        n = sum(k for _, k in before)
        if rank <= n:
            high, medians, left = pivot, before, n
        elif rank <= n + at:
            break
        else:
            rank, low, medians, left = rank - n - at, pivot, after, sum(k for _, k in after)
    if base is not None:
        drop_table(base)
    return pivot


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    least_words: int = 20,
    seed: int = 2024,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank.

    ``percent`` percent (rounded down) of the documents with at least
    ``least_words`` words are drawn: the highest scores, ties to the smaller
    id, no id last, then the place of the row in the table.  rank numbers them
    from 1 in that order and is null for all others.

    A null text has no words, weight 0 and is not drawn; a null id is the empty
    text in the noise; repeated rows are drawn each on its own; an empty
    target has no counts, and an empty table gives an empty result.  Ids are
    integers; other columns are not read.  Counts cover all rows of both
    tables.  The driver receives one number per bucket and, in each pass of
    the selection, two keys per task; a task holds one slice of texts or two
    blocks of keys.
    """
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets))
    rows = written(scored(docs, gain, id_col, text_col, longest, seed), "resampling-scores")
    keys = {"down": -F.col("score"), "no_id": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0))}
    rows = rows.withColumns(keys)
    fit = F.col("n_words") >= least_words
    drawn = rows.where(fit).count() * percent // 100
    cutoff = cutoff_key(rows.where(fit), drawn, block_rows)
    out = ["doc_id", "n_features", "weight", "score"]
    if cutoff is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    wins = fit & ~_past(cutoff)
    # sorted ranges, numbered by the rows of the ranges before
    winners = rows.where(wins).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    place = F.monotonically_increasing_id()
    winners = written(winners.select(*out, F.shiftright(place, 33).alias("range"), (place.bitwiseAND((1 << 33) - 1)).alias("nth")), "resampling-winners")
    counts = winners.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("range", F.coalesce(before, F.lit(0)).alias("first"))
    ranked = winners.join(first, "range").select(*out, (F.col("first") + F.col("nth") + 1).alias("rank"))
    return ranked.unionByName(rows.where(~wins).select(*out, F.lit(None).cast("long").alias("rank")))
