"""Geometry as plain nested columns.

Spark 4.1 ships no ``ST_Within``; a point is ``struct<x double, y double>``
and a (multi)polygon is ``array<array<struct<x,y>>>`` (every ring of every
part).  Everything below is built from higher-order SQL functions
(``transform``, ``filter``, ``exists``) so it is evaluated by the JVM without
any Python UDF.

Point-in-polygon follows PostGIS ``ST_Within`` semantics: even-odd ray
casting over *all* rings (so holes and multi-part polygons work), and a point
lying exactly on an edge is **not** within (S13).  A NULL point matches
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_TYPE = "struct<x:double,y:double>"
RINGS_TYPE = "array<array<struct<x:double,y:double>>>"
EDGES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"

# WKT: every innermost parenthesised group (one ring) of a POLYGON / MULTIPOLYGON.
_RING_RE = r"\(([^()]+)\)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_point(wkt) -> Column:
    """``'POINT (x y)'`` → ``struct(x, y)``; NULL stays NULL.

    Plain string slicing (no regex): the text between the parentheses,
    split at its first and last space.  Anything malformed reaches the ANSI
    cast as a non-number and fails the job, as a bad geometry literal fails
    ``COPY``.
    """
    w = _col(wkt)
    inner = F.trim(F.substring_index(F.substring_index(w, "(", -1), ")", 1))
    x = F.substring_index(inner, " ", 1).cast("double")
    y = F.trim(F.substring_index(inner, " ", -1)).cast("double")
    return F.when(w.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def point(x, y) -> Column:
    """Point struct from two numeric columns; NULL if either is NULL."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def parse_multipolygon(wkt) -> Column:
    """``POLYGON``/``MULTIPOLYGON`` WKT → array of rings of points."""
    w = _col(wkt)
    rings = F.regexp_extract_all(w, F.lit(_RING_RE), 1)

    def to_point(p):
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    return F.when(
        w.isNotNull(),
        F.transform(rings, lambda r: F.transform(F.split(F.trim(r), r"\s*,\s*"), to_point)),
    )


def ring_edges(rings) -> Column:
    """Consecutive vertex pairs of each ring, never across rings.

    The closing edge is ``last → first``; for a closed WKT ring it has zero
    length, which neither crosses a ray nor changes the boundary test.
    """
    rs = _col(rings)

    def edges_of(r):
        n = F.size(r)
        return F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: F.struct(
                r[i]["x"].alias("x1"),
                r[i]["y"].alias("y1"),
                r[(i + 1) % n]["x"].alias("x2"),
                r[(i + 1) % n]["y"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(F.filter(rs, lambda r: F.size(r) > 0), edges_of))


def ring_coords(rings, axis: str) -> Column:
    return F.flatten(F.transform(_col(rings), lambda r: F.transform(r, lambda p: p[axis])))


#: Relative error of a double operation, and of the plain orientation below
#: against the sum of its two products' sizes (three roundings of differences
#: and products, and their higher terms).
EPS = 2.0**-53
ORIENTATION_ERROR = (3 + 16 * EPS) * EPS
#: Splits a double into two halves whose products are exact.
SPLITTER = 2.0**27 + 1


def _two_products(a: Column, b: Column, sign: int) -> list[Column]:
    """sign * a * b as two doubles without any error."""
    halves = []
    for v in (a, b):
        c = v * SPLITTER
        high = c - (c - v)
        halves.append((high, v - high))
    (ah, al), (bh, bl) = halves
    p = a * b
    rest = ((ah * bh - p) + ah * bl + al * bh) + al * bl
    return [p, rest] if sign > 0 else [-p, -rest]


def _sign_of_sum(terms: list[Column]) -> Column:
    """Sign of an exact sum: each term is added to an expansion, doubles of
    rising size that do not overlap, with the error of every addition kept."""

    def add(expansion: Column, term: Column) -> Column:
        def step(acc: Column, e: Column) -> Column:
            total = acc["q"] + e
            back = total - acc["q"]
            error = (acc["q"] - (total - back)) + (e - back)
            return F.struct(total.alias("q"), F.concat(acc["out"], F.array(error)).alias("out"))

        start = F.struct(term.alias("q"), F.array().cast("array<double>").alias("out"))
        return F.aggregate(expansion, start, step, lambda acc: F.concat(acc["out"], F.array(acc["q"])))

    expansion = F.aggregate(F.array(*terms), F.array().cast("array<double>"), add)
    largest = F.aggregate(expansion, F.lit(0.0), lambda last, e: F.when(e != 0, e).otherwise(last))
    return F.signum(largest)


def orientation(x1, y1, x2, y2, x, y) -> Column:
    """1.0 if (x, y) lies left of the line from (x1, y1) to (x2, y2), -1.0 if
    right, 0.0 if on it: exact for the doubles given.  The plain expression
    decides where its error bound allows, else exact sums of products do."""
    left, right = (x1 - x) * (y2 - y), (x2 - x) * (y1 - y)
    plain = left - right
    terms = [t for a, b, s in ((x1, y2, 1), (x1, y, -1), (x, y2, -1), (x2, y1, -1), (x2, y, 1), (x, y1, 1)) for t in _two_products(a, b, s)]
    return F.when(F.abs(plain) > (F.abs(left) + F.abs(right)) * ORIENTATION_ERROR, F.signum(plain)).otherwise(_sign_of_sum(terms))


def crossings(x, y, edges, exact: bool = False) -> Column:
    """Number of edges crossed by the ray from (x, y) towards +x.

    ``nullif`` keeps ANSI division from raising on horizontal edges whatever
    order the conjuncts are evaluated in.  ``exact`` decides by ``orientation``
    on which side of an edge the point is.
    """
    x, y = _col(x), _col(y)

    def left_of(e: Column) -> Column:
        if exact:
            return orientation(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == F.when(e["y2"] > e["y1"], 1.0).otherwise(-1.0)
        return x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]

    return F.size(F.filter(_col(edges), lambda e: ((e["y1"] > y) != (e["y2"] > y)) & left_of(e)))


def on_boundary(x, y, edges, exact: bool = False) -> Column:
    """True when (x, y) lies on one of the edges (collinear and inside the segment box)."""
    x, y = _col(x), _col(y)

    def collinear(e: Column) -> Column:
        if exact:
            return orientation(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == 0
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]) == 0

    return F.exists(
        _col(edges),
        lambda e: x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        & collinear(e),
    )


def within(x, y, edges, exact: bool = False) -> Column:
    """Strictly inside: odd number of crossings and not on the boundary.
    ``exact`` is right up to the last place of the doubles given; its
    expression is long and costs some seconds of planning."""
    return ((crossings(x, y, edges, exact) % 2) == 1) & ~on_boundary(x, y, edges, exact)


def point_within(pt, edges, exact: bool = False) -> Column:
    """``ST_Within(point, polygon)`` on a point struct column."""
    p = _col(pt)
    return within(p["x"], p["y"], edges, exact)
