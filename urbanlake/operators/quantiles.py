"""Exact quantiles by selection.

``F.percentile`` merges a map from value to count in one task, whose size is
the number of distinct values.  Here each wanted order statistic is selected by
narrowing the range of values that holds it: a bounded sketch
(``percentile_approx``) proposes a range around the wanted rank, one pass counts
the rows below and inside it, and the part that holds the rank goes on.  The
sketch only steers; the counts decide, so the result is exact whatever the
sketch returns.  A range of one value is the answer, and a range of few rows is
collected (``COLLECT`` at most).

Each pass leaves about four in ``ACCURACY`` of the rows, so a billion take
three; a task holds sketches of ``ACCURACY`` entries.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
COLLECT = 10_000


@dataclass
class Rank:
    """The row of rank ``k`` (from 0) of a column lies in [low, high]; ``below``
    rows are smaller than low, ``inside`` lie in the range."""

    column: str
    k: int
    low: float
    high: float
    below: int
    inside: int
    value: float | None = None

    def settled(self) -> bool:
        if self.value is None and self.low == self.high:
            self.value = self.low
        return self.value is not None

    def here(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], accuracy: int = ACCURACY, collect: int = COLLECT
) -> dict[str, list[float | None]]:
    """``PERCENTILE_CONT`` of each column at each fraction, as ``F.percentile``
    gives it: NULLs are ignored, None without any value.  ``df`` is read a few
    times, so it should be a written table."""
    df = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    first = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(wanted) for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    size = {c: first[f"n_{i}"] for i, c in enumerate(wanted)}
    ranks: dict[tuple[str, int], Rank] = {}
    for i, (c, fractions) in enumerate(wanted.items()):
        for p in fractions if size[c] else ():
            at = (size[c] - 1) * p
            for k in (math.floor(at), math.ceil(at)):
                ranks[c, k] = Rank(c, k, first[f"low_{i}"], first[f"high_{i}"], 0, size[c])
    while open_ := [r for r in ranks.values() if not r.settled()]:
        few = [r for r in open_ if r.inside <= collect]
        if few:
            _collect(df, few)
        open_ = [r for r in open_ if r.inside > collect]
        if open_:
            _narrow(df, open_, accuracy)
    out = {}
    for c, fractions in wanted.items():
        out[c] = [_between(ranks, c, (size[c] - 1) * p) if size[c] else None for p in fractions]
    return out


def _between(ranks: Mapping[tuple[str, int], Rank], c: str, at: float) -> float:
    low, high = math.floor(at), math.ceil(at)
    a, b = ranks[c, low].value, ranks[c, high].value
    return a if low == high or a == b else (high - at) * a + (at - low) * b


def _collect(df: DataFrame, ranks: list[Rank]) -> None:
    for r in ranks:
        rows = df.where(r.here()).groupBy(F.col(r.column).alias("v")).count().collect()
        below = r.below
        for v, n in sorted((row["v"], row["count"]) for row in rows):
            below += n
            if r.k < below:
                r.value = v
                break


def _narrow(df: DataFrame, ranks: list[Rank], accuracy: int) -> None:
    """One proposal by the sketch and one pass that counts it."""
    slack = 2 / accuracy
    asked = []
    for i, r in enumerate(ranks):
        f = (r.k - r.below + 0.5) / r.inside
        around = F.array(*[F.lit(min(1.0, max(0.0, f + s))) for s in (-slack, 0.0, slack)])
        asked.append(F.percentile_approx(F.when(r.here(), F.col(r.column)), around, accuracy).alias(f"q{i}"))
    found = df.agg(*asked).first()
    counts, proposed = [], []
    for i, r in enumerate(ranks):
        a, middle, b = (min(max(v, r.low), r.high) for v in found[f"q{i}"])
        if a == r.low and b == r.high:  # no narrower: one value, which is the answer or drops out
            a = b = middle
        proposed.append((a, b))
        x = F.col(r.column)
        counts += [
            F.count(F.when(x < a, x)).alias(f"below{i}"), F.count(F.when(x.between(a, b), x)).alias(f"inside{i}"),
            F.max(F.when(r.here() & (x < a), x)).alias(f"before{i}"), F.min(F.when(r.here() & (x > b), x)).alias(f"after{i}"),
        ]
    found = df.agg(*counts).first()
    for i, r in enumerate(ranks):
        (a, b), below, inside = proposed[i], found[f"below{i}"], found[f"inside{i}"]
        if r.k < below:
            r.high, r.inside = found[f"before{i}"], below - r.below
        elif r.k >= below + inside:
            r.low, r.below, r.inside = found[f"after{i}"], below + inside, r.below + r.inside - below - inside
        else:
            r.low, r.high, r.below, r.inside = a, b, below, inside


def exact_quartiles(df: DataFrame, cols: Sequence[str], **sizes: int) -> Column:
    """Like ``aggregates.quartiles``, by selection: a struct of literals
    (``q1_<col>``, ``q3_<col>``).  Its jobs run when this is called."""
    found = exact_quantiles(df, {c: (0.25, 0.75) for c in cols}, **sizes)
    return F.struct(*[F.lit(v).cast("double").alias(f"{q}_{c}") for c in cols for q, v in zip(("q1", "q3"), found[c])])
