"""Exact quantiles by selection against ``F.percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from urbanlake.operators import quantiles
from urbanlake.operators.aggregates import quartiles

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def both(df, column, **sizes):
    got = quantiles.exact_quantiles(df, {column: FRACTIONS}, **sizes)[column]
    return got, df.select(F.percentile(column, F.array(*map(F.lit, FRACTIONS)))).first()[0]


@pytest.mark.parametrize("kind", ["uniform", "ties", "powers", "one", "two", "negative"])
def test_equals_percentile(spark, kind):
    rnd = random.Random(kind)
    make = {
        "uniform": lambda: rnd.uniform(-5, 5), "ties": lambda: float(rnd.choice([0, 0, 0, 0, 1, 7])), "powers": lambda: 10.0 ** rnd.uniform(-300, 300),
        "one": lambda: 4.5, "two": lambda: float(rnd.randrange(2)), "negative": lambda: -float(rnd.randrange(1000)),
    }[kind]
    rows = [(make(),) for _ in range(3000)] + [(None,)] * 50
    got, want = both(spark.createDataFrame(rows, "v double").repartition(5), "v", accuracy=20, collect=5)
    assert got == want


def test_small_and_empty_tables(spark):
    for values in ([], [None], [3.0], [3.0, 5.0], [1.0, 2.0, None, 4.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got, want = both(df, "v", collect=1)
        assert got == (want if want is not None else [None] * len(FRACTIONS))


def test_a_wrong_sketch_does_not_matter(spark, monkeypatch):
    """The proposals only steer: with useless ones the result is the same."""
    rows = [(float(k * k % 1009),) for k in range(1009)]
    df = spark.createDataFrame(rows, "v double")
    monkeypatch.setattr(F, "percentile_approx", lambda c, around, accuracy: F.array(F.min(c), F.min(c) - 5, F.min(c)))
    got = quantiles.exact_quantiles(df.where("v < 60"), {"v": [0.25, 0.5]}, collect=3)["v"]
    assert got == df.where("v < 60").select(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]


def test_ten_million_distinct_values(spark):
    """A permutation of 0 .. 10,000,002: the quantiles are known, and no task holds a map of the values."""
    n = 10_000_003
    df = spark.range(0, n, 1, 8).select(((F.col("id") * 7_368_787) % n).cast("double").alias("v"))
    got = quantiles.exact_quantiles(df, {"v": [0.25, 0.5, 0.75]})["v"]
    assert got == [(n - 1) * p for p in (0.25, 0.5, 0.75)]
    calls = []
    real = quantiles._narrow
    quantiles._narrow = lambda *a: calls.append(1) or real(*a)
    try:
        assert quantiles.exact_quantiles(df, {"v": [0.5]})["v"] == [(n - 1) / 2]
    finally:
        quantiles._narrow = real
    assert len(calls) <= 3


def test_quartile_struct_equals_the_lazy_one(spark):
    df = spark.createDataFrame([(k % 17, k * k % 101) for k in range(400)], "a long, b long")
    one, two = (df.limit(1).select(q.alias("q")).first().q for q in (quartiles(df, ["a", "b"]), quantiles.exact_quartiles(df, ["a", "b"], collect=7)))
    assert one.asDict() == two.asDict()
