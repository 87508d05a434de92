"""Left spatial join ``point ST_Within polygon``.

A theta join on a geometric predicate plans as a nested loop.  Instead:

1. every polygon is exploded into the grid cells its bounding box touches
   (one row per polygon × cell, carrying the edges that matter there; a cell
   that no edge crosses is marked as inside, or left out if it is outside);
2. every point computes its own cell ``(floor(x/g), floor(y/g))``;
3. the two sides equi-join on the cell, and the exact test (bounding box,
   even-odd ray casting, boundary exclusion) runs as the join's residual
   condition, only in cells that an edge crosses.

``floor`` is monotone, so a point inside a polygon always lands in one of
that polygon's cells and nothing is lost at cell borders; each point has one
cell and each (polygon, cell) pair one row, so a match is emitted once per
containing polygon.  The join is LEFT and not de-duplicated: a point in two
overlapping polygons yields two rows, a point in none keeps NULLs (S12).

Scale: a small index (``LOCAL_BYTES``) is a table of known size, which Spark
broadcasts if the session lets it: the points stay where they are.  Otherwise
AQE broadcasts an index that it has measured to be small or joins by cell,
splitting a hot cell on the (preserved) point side.  Rows without a point match nothing; they get keys of
their own, spread over all partitions, instead of meeting under NULL.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

# Sizing parameter: polygon × cell rows aimed at when the cell size is chosen
# automatically; the cell grows until the index fits.  Results do not depend on it.
DEFAULT_MAX_CELLS = 100_000
# Bytes up to which an index is held as a local table.  Spark knows the size of
# one before the join runs, and plans a broadcast join without dealing out the points.
LOCAL_BYTES = 32 << 20
# How often the automatic cell size may be halved for a local index: the finer
# the grid, the more points lie in cells that no edge crosses.
FINER = 4
# Keys over which rows without a point are spread.
NULL_KEYS = 1 << 16
# Cell row of those keys; no polygon reaches it.
NO_CELL = -(1 << 62)


def prepare_polygons(polygons: DataFrame, geom: str = "geom") -> DataFrame:
    """Add ``_edges`` and the bounding box to a frame with a rings column."""
    xs = geo.ring_coords(F.col(geom), "x")
    ys = geo.ring_coords(F.col(geom), "y")
    return (
        polygons.withColumn("_edges", geo.ring_edges(F.col(geom)))
        .withColumn("_xmin", F.array_min(xs))
        .withColumn("_xmax", F.array_max(xs))
        .withColumn("_ymin", F.array_min(ys))
        .withColumn("_ymax", F.array_max(ys))
    )


def _spare_key(df: DataFrame) -> Column:
    """Key from 1 to ``NULL_KEYS`` for a row without a point: a digest of its plain columns."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*plain), F.lit(NULL_KEYS)) + 1


class PolygonIndex:
    """Grid-cell index of one polygon layer, built once and reused.

    One aggregate over the polygon layer yields the median extent and the
    extent sums, which give the cell size and an upper bound on the index
    size: a polygon whose box spans ``w × h`` touches at most
    ``(w/g + 2)(h/g + 2)`` cells.  Its edges rise over ``v`` in all, so they
    are kept in at most ``(v/g + 2e)(w/g + 2)`` copies.  An index of
    ``LOCAL_BYTES`` at most by these bounds gets finer cells and is computed
    here, once.
    """

    def __init__(
        self,
        polygons: DataFrame,
        take: list[str],
        geom: str = "geom",
        cell_size: float | None = None,
        max_cells: int = DEFAULT_MAX_CELLS,
    ):
        prepared = prepare_polygons(polygons.select(*take, geom), geom)
        w = F.col("_xmax") - F.col("_xmin")
        h = F.col("_ymax") - F.col("_ymin")
        rise = F.aggregate("_edges", F.lit(0.0), lambda acc, e: acc + F.abs(e["y2"] - e["y1"]))
        count = F.size("_edges").cast("double")
        row = (
            prepared.where(F.col("_xmin").isNotNull())
            .agg(
                F.percentile_approx(F.greatest(w, h), 0.5).alias("med"),
                F.sum(w).alias("sw"),
                F.sum(h).alias("sh"),
                F.sum(w * h).alias("swh"),
                F.count(F.lit(1)).alias("n"),
                F.sum(rise).alias("sv"),
                F.sum(rise * w).alias("svw"),
                F.sum(count).alias("se"),
                F.sum(count * w).alias("sew"),
            )
            .first()
        )
        n = row["n"] if row is not None else 0
        stats = {k: float(row[k] or 0.0) for k in ("med", "sw", "sh", "swh", "sv", "svw", "se", "sew")} if n else {}

        def cells(size: float) -> float:
            return stats["swh"] / size**2 + 2 * (stats["sw"] + stats["sh"]) / size + 4 * n

        def local(size: float) -> bool:
            edges = stats["svw"] / size**2 + 2 * (stats["sv"] + stats["sew"]) / size + 4 * stats["se"]
            return bool(n) and 128 * cells(size) + 64 * edges <= LOCAL_BYTES

        if cell_size:
            g = float(cell_size)
        elif not n:
            g = 1.0
        else:
            # every polygon touches at least one cell (the bound counts 4), so
            # a layer with many polygons cannot go below a few rows each
            target = max(max_cells, 8 * n)
            g = stats["med"] or 1.0
            if cells(g) > target:
                g *= math.sqrt(cells(g) / target)
                for _ in range(64):
                    if cells(g) <= target:
                        break
                    g *= 1.5
            for _ in range(FINER):
                if not stats["med"] or cells(g / 2) > max_cells or not local(g / 2):
                    break
                g /= 2
        self.cell = g
        self.n_polygons = n
        self.max_rows = int(cells(g)) if n else 0
        self.take = list(take)
        self.cells = polygon_cells(prepared, g)
        if local(g):
            self.cells = polygons.sparkSession.createDataFrame(self.cells.toArrow(), self.cells.schema)
        self._polygons, self._version = polygons.select(*take, geom), None

    def version(self) -> str:
        """Digest of the layer's keys and geometries, whatever the order of its rows."""
        if self._version is None:
            row = self._polygons.select(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)").alias("h"))
            n, total = row.agg(F.count("*"), F.sum("h")).first()
            self._version = f"{','.join(self.take)}:{n}:{total}"
        return self._version

    def join(self, points: DataFrame, point_col: str, take: dict[str, str], how: str = "left", cover=None) -> DataFrame:
        """``points LEFT JOIN layer ON ST_Within(point, polygon)``; ``take`` maps
        output names to carried polygon columns (``how='inner'`` keeps matches only).
        ``cover``: a ``DensityCover`` of this layer for these points."""
        tag = uuid.uuid4().hex[:8]
        n = lambda s: f"_{s}_{tag}"  # noqa: E731 - unique temp names per join
        cells = cover.shared() if cover else keyed_cells(self.cells)
        index = cells.select(
            *[F.col(src).alias(dst) for dst, src in take.items()],
            *[F.col(f"_{c}").alias(n(c)) for c in ("edges", "inside", "xmin", "xmax", "ymin", "ymax", "cl", "cx", "cy", "cs")],
        )
        px, py = F.col(point_col)["x"], F.col(point_col)["y"]
        none, spare = px.isNull() | py.isNull(), _spare_key(points)
        left = points.withColumns({n("px"): px, n("py"): py, n("spare"): spare})
        px, py = F.col(n("px")), F.col(n("py"))
        place = plain_place(px, py, self.cell)
        left = cover.place(left, px, py, n("at"), F.col(n("spare"))) if cover else left.withColumn(n("at"), place)
        at = F.col(n("at"))
        left = left.withColumns(
            {
                n("pcl"): at["l"],
                n("pcx"): F.when(none, F.col(n("spare"))).otherwise(at["x"]),
                n("pcy"): F.when(none, F.lit(NO_CELL)).otherwise(at["y"]),
                n("pcs"): at["s"],
            }
        )
        cond = _inside(px, py, *[F.col(n(c)) for c in ("inside", "xmin", "xmax", "ymin", "ymax", "edges")])
        for c in ("cl", "cx", "cy", "cs"):
            cond = (F.col(n(f"p{c}")) == F.col(n(c))) & cond
        joined = left.join(index, cond, how)
        helpers = ("px", "py", "spare", "at", "pcl", "pcx", "pcy", "pcs", "edges", "inside", "xmin", "xmax", "ymin", "ymax", "cl", "cx", "cy", "cs")
        return joined.drop(*[n(s) for s in helpers])


def plain_place(px: Column, py: Column, cell: float) -> Column:
    """A point's grid cell as a node of level 0: struct (l, x, y, s)."""
    g = F.lit(cell)
    return F.struct(F.lit(0).alias("l"), F.floor(px / g).alias("x"), F.floor(py / g).alias("y"), F.lit(0).alias("s"))


def keyed_cells(cells: DataFrame) -> DataFrame:
    """Grid cells with the rest of a node's key: level 0, one copy."""
    return cells.withColumns({"_cl": F.lit(0), "_cs": F.lit(0)})


def _inside(px: Column, py: Column, inside: Column, xmin: Column, xmax: Column, ymin: Column, ymax: Column, edges: Column) -> Column:
    """The exact test; ``inside`` marks cells where every point passes."""
    return inside | (px.between(xmin, xmax) & py.between(ymin, ymax) & geo.within(px, py, edges))


def polygon_cells(prepared: DataFrame, cell: float) -> DataFrame:
    """One row per (polygon, grid cell touched by its bounding box).

    Each row keeps only the edges whose cell-row range contains the cell's
    row.  An edge crossed by the ray from a point — or containing it — spans
    the point's ``y``; ``floor(y/g)`` is monotone, so such an edge's row
    range contains the point's row.  The clipping is therefore exact.

    A cell that no edge's box reaches has no boundary in it, so all its points
    are on one side: outside cells are left out, inside cells need no test.
    """
    g = F.lit(float(cell))
    cells = (
        prepared.where(F.col("_xmin").isNotNull())
        .withColumn("_cx", F.explode(F.sequence(F.floor(F.col("_xmin") / g), F.floor(F.col("_xmax") / g))))
        .withColumn("_cy", F.explode(F.sequence(F.floor(F.col("_ymin") / g), F.floor(F.col("_ymax") / g))))
    )
    return clipped(cells, g)


def clipped(cells: DataFrame, size: Column, whole: str | None = None) -> DataFrame:
    """Rows (polygon, cell ``_cx``, ``_cy`` of ``size``) with the edges that
    matter in the cell and ``_inside``; cells outside the polygon are left
    out.  ``whole`` names a column that is true where the cell is known to be
    inside."""
    low = lambda a, b: F.floor(F.least(a, b) / size)
    high = lambda a, b: F.floor(F.greatest(a, b) / size)
    row, column = F.col("_cy"), F.col("_cx")
    cells = cells.withColumn(
        "_edges", F.filter("_edges", lambda e: (low(e["y1"], e["y2"]) <= row) & (high(e["y1"], e["y2"]) >= row))
    )
    crossed = F.exists("_edges", lambda e: (low(e["x1"], e["x2"]) <= column) & (high(e["x1"], e["x2"]) >= column))
    centre = geo.within((column + 0.5) * size, (row + 0.5) * size, F.col("_edges"))
    if whole is not None:  # such cells carry no edges
        crossed, centre = F.when(F.col(whole), F.lit(False)).otherwise(crossed), F.when(F.col(whole), F.lit(True)).otherwise(centre)
    cells = cells.withColumn("_inside", ~crossed & centre).where(crossed | centre)
    return cells.withColumn("_edges", F.when(~F.col("_inside"), F.col("_edges")))


def within_left_join(
    points: DataFrame,
    point_col: str,
    polygons: DataFrame | PolygonIndex,
    take: dict[str, str],
    geom: str = "geom",
    cell_size: float | None = None,
    cover: Callable | None = None,
) -> DataFrame:
    """``points LEFT JOIN polygons ON ST_Within(points.point_col, polygons.geom)``.

    ``take`` maps output column names to polygon columns to carry over
    (e.g. ``{"pickup_zip": "zip"}``); they are NULL when nothing contains
    the point.  ``point_col`` is a ``struct<x,y>`` column.  Pass a
    ``PolygonIndex`` to reuse one layer's index across several joins.
    ``cover=DensityCover`` (``operators.cover``) measures where the points are
    first, one job that runs when this is called, and splits crowded cells.
    """
    index = polygons if isinstance(polygons, PolygonIndex) else PolygonIndex(
        polygons, sorted(set(take.values())), geom, cell_size
    )
    return index.join(points, point_col, take, cover=cover(index, points, point_col) if cover else None)


def point_matches(points: DataFrame, layers: list[PolygonIndex], covers: list | None = None, unmatched: bool = False) -> DataFrame:
    """(x, y, m0, m1, …) for the points (``struct<x,y>`` column ``_pt``) that
    any layer contains (with ``unmatched`` for all of them): ``m<i>`` lists the
    carried columns of layer ``i``'s containing polygons, NULL if none.

    One cell join for all layers: each point carries its cell in every layer
    (layers keep their own cell size, and may have a ``DensityCover`` each),
    matched against the union of the layers' indexes on (layer, cell).
    """
    cells, covers = None, covers or [None] * len(layers)
    for i, (index, cover) in enumerate(zip(layers, covers)):
        c = (cover.cells if cover else keyed_cells(index.cells)).select(
            F.lit(i).alias("_layer"),
            F.struct(*index.take).alias(f"_k{i}"),
            "_edges", "_inside", "_xmin", "_xmax", "_ymin", "_ymax", "_cl", "_cx", "_cy", "_cs",
        )
        cells = c if cells is None else cells.unionByName(c, allowMissingColumns=True)
    px, py = F.col("_pt")["x"], F.col("_pt")["y"]
    spread = F.xxhash64(px, py)
    for i, (index, cover) in enumerate(zip(layers, covers)):
        place = plain_place(px, py, index.cell)
        points = cover.place(points, px, py, f"_at{i}", spread) if cover else points.withColumn(f"_at{i}", place)
    tagged = points.select(
        "_pt",
        F.inline(F.array(*[F.struct(F.lit(i).alias("_p_layer"), F.col(f"_at{i}").alias("_at")) for i in range(len(layers))])),
    ).select("_pt", "_p_layer", *[F.col("_at")[c].alias(f"_pc{c}") for c in ("l", "x", "y", "s")])
    cond = (
        (F.col("_p_layer") == F.col("_layer"))
        & (F.col("_pcl") == F.col("_cl"))
        & (F.col("_pcs") == F.col("_cs"))
        & (F.col("_pcx") == F.col("_cx"))
        & (F.col("_pcy") == F.col("_cy"))
        & _inside(px, py, *[F.col(f"_{c}") for c in ("inside", "xmin", "xmax", "ymin", "ymax", "edges")])
    )
    found = tagged.join(cells, cond, "left" if unmatched else "inner")
    # a point lies in as many polygons as overlap there: lists stay short
    lists = [F.collect_list(F.when(F.col("_layer") == i, F.col(f"_k{i}"))).alias(f"m{i}") for i in range(len(layers))]
    grouped = found.groupBy(px.alias("x"), py.alias("y")).agg(*lists)
    return grouped.select("x", "y", *[F.nullif(F.col(f"m{i}"), F.array().cast(grouped.schema[f"m{i}"].dataType)).alias(f"m{i}") for i in range(len(layers))])


def _written_lookup(df: DataFrame, point_cols: list[str], layers: list[PolygonIndex], path: str, cover: Callable | None) -> DataFrame:
    pts = df.select(F.explode(F.array(*[F.col(c) for c in point_cols])).alias("_pt"))
    pts = pts.where(F.col("_pt.x").isNotNull() & F.col("_pt.y").isNotNull()).distinct()
    covers = [cover(index, pts, "_pt") if cover else None for index in layers]
    point_matches(pts, layers, covers).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def spatial_enrich(
    df: DataFrame,
    joins: list[tuple[str, PolygonIndex, dict[str, str]]],
    lookup_path: str | None = None,
    cover: Callable | None = None,
    dictionary=None,
) -> DataFrame:
    """Apply several left spatial joins ``(point column, index, take)`` to ``df``.

    ``cover=DensityCover`` (``operators.cover``) measures first where the points
    are and splits each layer's crowded cells: for points that crowd in few
    cells and do not repeat.

    Without ``lookup_path`` every join runs directly, per row, and the result
    is a lazy plan: right for points that do not repeat (raw GPS).

    With ``lookup_path`` the exact test runs on the *distinct* points only
    (R2a), for locations that are centroids and repeat heavily.  One job,
    which runs while this function is called, takes the distinct points of
    all point columns (map-side partial aggregation, so a hot location costs
    one row per task), matches them against all layers in a single cell join
    (``point_matches``) and writes the lookup to ``lookup_path``, overwriting
    it; the caller owns that table and keeps it as long as the result is
    read.  Each point column is then joined once, by its exact coordinates,
    for all layers.

    With ``dictionary`` (``operators.points.PointDictionary``, updated with
    these points) the matches come from there and nothing is matched here.

    All give the rows of the direct spatial join: one per containing
    polygon, or one with NULLs.
    """
    layers = list({id(index): index for _, index, _ in joins}.values())
    if dictionary is None and lookup_path is None:
        cols = {id(index): list(dict.fromkeys(pc for pc, ix, _ in joins if ix is index)) for index in layers}
        covers = {id(index): cover(index, df, cols[id(index)]) if cover else None for index in layers}
        for pc, index, take in joins:
            df = index.join(df, pc, take, cover=covers[id(index)])
        return df
    point_cols = list(dict.fromkeys(pc for pc, _, _ in joins))
    if dictionary is not None:
        layers, lookup = dictionary.layers, dictionary.lookup()
    else:
        lookup = _written_lookup(df, point_cols, layers, lookup_path, cover)
    for pc in point_cols:
        tag = uuid.uuid4().hex[:8]
        n = lambda s: f"_{s}_{tag}"
        x, y = F.col(pc)["x"], F.col(pc)["y"]
        none = x.isNull() | y.isNull()
        lk = lookup.select(
            F.col("x").alias(n("x")),
            F.col("y").alias(n("y")),
            *[F.col(f"m{i}").alias(n(f"m{i}")) for i in range(len(layers))],
        )
        # no point of the lookup is NaN, as no polygon contains one
        key_x, key_y = F.when(none, _spare_key(df).cast("double")).otherwise(x), F.when(none, F.lit(float("nan"))).otherwise(y)
        left = df.withColumns({n("px"): key_x, n("py"): key_y})
        df = left.join(lk, (F.col(n("px")) == F.col(n("x"))) & (F.col(n("py")) == F.col(n("y"))), "left")
        for col, index, take in joins:
            if col == pc:
                i = layers.index(index)
                df = df.withColumn(n("hit"), F.explode_outer(n(f"m{i}")))
                df = df.withColumns({dst: F.col(n("hit"))[src] for dst, src in take.items()}).drop(n("hit"))
        df = df.drop(*[n(s) for s in ("px", "py", "x", "y", *[f"m{i}" for i in range(len(layers))])])
    return df
