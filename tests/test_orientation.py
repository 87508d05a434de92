"""Orientation and boundary tests against exact rationals."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from urbanlake.functions import geo


def exact(x1, y1, x2, y2, x, y):
    x1, y1, x2, y2, x, y = map(Fraction, (x1, y1, x2, y2, x, y))
    d = (x1 - x) * (y2 - y) - (x2 - x) * (y1 - y)
    return (d > 0) - (d < 0)


def near_collinear(n):
    """Points a few units in the last place from a line, in coordinates of a city and far from it."""
    rnd = random.Random(17)
    rows = []
    for _ in range(n):
        size = rnd.choice([1.0, 90.0, 1e-3, 1e6])
        a, b = ((rnd.uniform(-size, size), rnd.uniform(-size, size)) for _ in range(2))
        t = rnd.random()
        p = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
        for _ in range(rnd.randrange(3)):
            k = rnd.randrange(2)
            p[k] = math.nextafter(p[k], rnd.choice([-math.inf, math.inf]))
        rows.append((*a, *b, *p))
    rows += [(0.1, 0.1, 0.7, 0.7, 0.3, 0.3), (0.0, 0.0, 0.3, 0.1, 0.6, 0.2), (1e6, 1e6, 1e6 + 1, 1e6 + 1, 1e6 + 0.5, 1e6 + 0.5), (1.0, 2.0, 1.0, 2.0, 1.0, 2.0)]
    rows += [(0.5, 0.5, 12.0, 12.0, 0.5 + i * 2.0**-53, 0.5 + j * 2.0**-53) for i in range(12) for j in range(12)]
    return rows


def test_orientation_is_exact(spark):
    rows = near_collinear(1500)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x1 double, y1 double, x2 double, y2 double, x double, y double")
    got = {r.i: r.s for r in df.select("i", geo.orientation(*map(F.col, ("x1", "y1", "x2", "y2", "x", "y"))).alias("s")).collect()}
    want = {i: exact(*r) for i, r in enumerate(rows)}
    assert got == want
    plain = sum((((x1 - x) * (y2 - y) - (x2 - x) * (y1 - y)) > 0) - (((x1 - x) * (y2 - y) - (x2 - x) * (y1 - y)) < 0) != want[i] for i, (x1, y1, x2, y2, x, y) in enumerate(rows))
    assert plain > 20  # where a plain comparison with zero is wrong


def inside_exactly(p, ring):
    crossed = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        o = exact(x1, y1, x2, y2, *p)
        if o == 0 and min(x1, x2) <= p[0] <= max(x1, x2) and min(y1, y2) <= p[1] <= max(y1, y2):
            return False
        if (y1 > p[1]) != (y2 > p[1]) and o == (1 if y2 > y1 else -1):
            crossed += 1
    return crossed % 2 == 1


def test_within_near_the_edges(spark):
    rnd = random.Random(5)
    ring = [(-87.94, 41.64), (-87.52, 41.6441), (-87.5239, 42.0231), (-87.7, 41.95), (-87.93, 42.0191)]
    pts = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        for _ in range(120):
            t = rnd.random()
            p = [x1 + t * (x2 - x1), y1 + t * (y2 - y1)]
            k = rnd.randrange(2)
            p[k] = math.nextafter(p[k], rnd.choice([-math.inf, math.inf])) if rnd.random() < 0.7 else p[k]
            pts.append(tuple(p))
    pts += ring
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring + ring[:1]) + "))"
    df = spark.createDataFrame([(i, x, y, wkt) for i, (x, y) in enumerate(pts)], "i int, x double, y double, g string")
    edges = geo.ring_edges(geo.parse_multipolygon("g"))
    got = {r.i: r.w for r in df.select("i", geo.within("x", "y", edges, exact=True).alias("w")).collect()}
    assert got == {i: inside_exactly(p, ring) for i, p in enumerate(pts)}
    assert any(got.values()) and not all(got.values())
