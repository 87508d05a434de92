"""Best-fit packing by minimum bin slack.

The plan needs only how many pieces there are of each length, a table of at
most ``capacity`` rows.  Bins are filled one after the other: the longest
piece left goes in, then subset-sum dynamic programming over a bitset finds
the fullest feasible combination of the lengths still available, which is
removed.  The same combination comes out again until one of its lengths runs
short, so it is applied that many times at once and the plan's size does not
follow the corpus.

Pieces are then numbered within their length (a count per partition and a
running sum over those counts) and looked up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import slices, trim_memory, utf8, written
from urbanlake.llm.tokens import CachedEncoder

CAPACITY = 2048
#: Words that a task remembers the ids of.
MAX_WORDS = 200_000


def fill(room: int, available: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Fullest combination of at most ``room``: [(length, copies)] out of
    [(length, copies)], lengths descending, longer ones preferred."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, copies in available:
        if length > room:
            continue
        copies, k = min(copies, room // length), 1
        while copies > 0 and not reach >> room:
            take = min(k, copies)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            copies, k = copies - take, 2 * k
        if reach >> room:
            break
    at, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= length * take
    return sorted(out.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, copies per bin)])] that use up ``counts`` (length: pieces)."""
    left = {n: k for n, k in sorted(counts.items(), reverse=True) if k > 0}
    bins = []
    while left:
        longest = next(iter(left))
        rest = [(n, k - (n == longest)) for n, k in left.items() if k - (n == longest)]
        chosen = dict(fill(capacity - longest, rest)) if longest < capacity else {}
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        bins.append((times, sorted(chosen.items(), reverse=True)))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return bins


def slots(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length: (first piece number, copies per bin, first bin, offset) in order."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    first = 0
    for times, chosen in bins:
        offset = 0
        for length, copies in chosen:
            out.setdefault(length, []).append((used.get(length, 0), copies, first, offset))
            used[length] = used.get(length, 0) + times * copies
            offset += length * copies
        first += times
    return out


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int, ids: bool) -> DataFrame:
    """Pieces of the token streams of all texts, with their partition and
    their number among its pieces of the same length; ``ids`` adds the tokens."""

    def body(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        trim_memory()
        encoder = CachedEncoder(tokenizer, spaced=False, limit=MAX_WORDS)
        part, seen = TaskContext.get().partitionId(), {}
        end = np.array([end_id], "<u4").tobytes()
        for batch in (s for b in batches for s in slices(b)):
            doc, piece, start, length, crc, number, tokens = [], [], [], [], [], [], []
            for i, stream in enumerate(encoder.encode([t.decode() for t in utf8(batch.column(1))])):
                stream += end
                for k, at in enumerate(range(0, len(stream), 4 * capacity)):
                    cut = stream[at : at + 4 * capacity]
                    n = len(cut) // 4
                    doc.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(cut))
                    number.append(seen.get(n, 0))
                    seen[n] = number[-1] + 1
                    if ids:
                        tokens.append(np.frombuffer(cut, "<u4").astype(np.int32))
            if not doc:
                continue
            long, small = pa.int64(), pa.int32()
            columns = [
                batch.column(0).take(pa.array(doc)),
                pa.array(piece, small),
                pa.array(start, long),
                pa.array(length, long),
                pa.array(crc, long),
                pa.array([part] * len(doc), small),
                pa.array(number, long),
            ]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(tokens, pa.list_(small))] if ids else []), names=names)
        del encoder
        trim_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, number long" + ", ids array<int>" * ids
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(body, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id
    and offset, and the piece's ``ids`` if ``with_ids``.

    A document is its ids and then ``end_id``; only longer ones than
    ``capacity`` are cut.  Null and empty texts are one piece of one token,
    repeated rows are packed each on its own, a null id stays null, and an
    empty table gives no piece.  ``tokenizer`` is the tokenizer's JSON.
    Other columns are not read.
    """
    rows = written(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "packing-pieces")
    counts = written(rows.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-counts")
    # at most `capacity` rows, whatever the input
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(totals, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    numbered = rows.join(first, ["length", "part"]).withColumn("number", F.col("number") + F.col("first"))

    def place(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        look = {n: np.array(s, np.int64) for n, s in table.items()}
        for lengths, numbers in frames:
            length, number = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
            out = np.empty((len(length), 2), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                slot = look[n][np.searchsorted(look[n][:, 0], number[rows], side="right") - 1]
                nth = number[rows] - slot[:, 0]
                out[rows, 0] = slot[:, 2] + nth // slot[:, 1]
                out[rows, 1] = slot[:, 3] + nth % slot[:, 1] * n
            yield pd.DataFrame(out, columns=["sequence_id", "offset"])

    place = F.pandas_udf(place, "sequence_id long, offset long", F.PandasUDFType.SCALAR_ITER)
    placed = numbered.withColumn("at", place("length", "number"))
    more = ["ids"] if with_ids else []
    return placed.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", *more)
