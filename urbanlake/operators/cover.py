"""Density-adaptive cover of a polygon layer.

A uniform grid puts all points of a crowded cell under one join key.  A
``DensityCover`` measures where the points are and splits crowded cells like a
quadtree, down to ``DEPTH`` levels, until a leaf holds at most ``leaf_rows``
points; a leaf that is still over it at the last level (one location repeated)
is dealt into salted copies.  A point's key is its leaf: (level, column, row,
salt).  The polygon rows of a crowded cell are cut again to its leaves with the
same exact clipping as a grid cell.

The join's result does not depend on the cover, only the sizes of its tasks do.

Size: a node is split only if more than ``leaf_rows`` points lie in it, so each
level has at most points / leaf_rows split nodes; ``MAX_SPLITS`` bounds their
number by raising ``leaf_rows``.  That is what the driver collects and what the
point side gets as a broadcast table.  A point finds its leaf by halving the
levels: a split node's ancestors are all split, so a probe of the table at one
level tells whether the leaf lies above or below it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spatial

DEPTH = 9
MAX_SPLITS = 1 << 17
# Leaves that a shuffle partition gets on average, if all points lie in crowded cells.
LEAVES_PER_PARTITION = 32
# Bytes up to which the layer's leaves are broadcast to the points, unless the session forbids broadcast joins.
BROADCAST_BYTES = 64 << 20


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A bounded table of whole numbers from the driver, all columns long."""
    import numpy as np
    import pyarrow as pa

    columns = np.array(rows, np.int64).reshape(len(rows), -1).T
    return spark.createDataFrame(pa.table({c: pa.array(v) for c, v in zip(schema.split(), columns)}))


def node_code(level: int, column, row):
    """A node below its grid cell as one number: level, and column and row
    inside the cell (numbers or Columns)."""
    return column * (1 << 20) + row + (level << 40)


def node_counts(points: DataFrame, px: Column, py: Column, cell: float, depth: int) -> DataFrame:
    """(level, x, y, n): points per node of every level, 0 being the grid cells.
    Points are counted once per finest node, with partial aggregation."""
    size = F.lit(cell / (1 << depth))  # halving is exact: a finer floor shifted right is the coarser floor
    finest = points.where(px.isNotNull() & py.isNotNull()).groupBy(F.floor(px / size).alias("fx"), F.floor(py / size).alias("fy")).agg(F.count("*").alias("k"))
    levels = [F.struct(F.lit(i).alias("level"), F.shiftright("fx", depth - i).alias("x"), F.shiftright("fy", depth - i).alias("y")) for i in range(depth + 1)]
    nodes = finest.select("k", F.inline(F.array(*levels)))
    return nodes.groupBy("level", "x", "y").agg(F.sum("k").alias("n"))


class DensityCover:
    """Cover of one polygon layer for the points of ``point_col``; one job,
    which runs here, measures them.

    ``leaf_rows`` defaults to what gives every shuffle partition about
    ``LEAVES_PER_PARTITION`` leaves.
    """

    def __init__(self, index: spatial.PolygonIndex, points: DataFrame, point_cols: str | list[str], leaf_rows: int | None = None, depth: int = DEPTH):
        spark = points.sparkSession
        cols = [point_cols] if isinstance(point_cols, str) else list(point_cols)
        at = points.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("_pt"))
        counts = node_counts(at, F.col("_pt")["x"], F.col("_pt")["y"], index.cell, depth)
        total = counts.where("level = 0").select(F.sum("n")).scalar()
        if leaf_rows is None:
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            limit = F.greatest(F.lit(1), F.floor(total / F.lit(min(parts * LEAVES_PER_PARTITION, MAX_SPLITS // (depth + 1)))))
        else:
            limit = F.greatest(F.lit(leaf_rows), F.floor(total / F.lit(MAX_SPLITS // (depth + 1))))
        over = counts.withColumn("limit", limit).where(F.col("n") > F.col("limit")).collect()
        self.index, self.depth = index, depth
        self.leaf_rows = over[0]["limit"] if over else None
        # of each crowded grid cell: {code of a split node: 0, code of a salted node: its copies}
        self.trees: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)
        self.nodes: list[tuple[int, int, int, int]] = []  # the same as (level, column, row, copies)
        for r in over:
            up = r["level"]
            mask = (1 << up) - 1
            copies = -(-r["n"] // r["limit"]) if up == depth else 0
            self.trees[r["x"] >> up, r["y"] >> up][node_code(up, r["x"] & mask, r["y"] & mask)] = copies
            self.nodes.append((up, r["x"], r["y"], copies))
        self.cells = self._cells()
        self.bytes = self._bytes()

    def _leaves(self, tree: dict[int, int]) -> Iterator[tuple[int, int, int, int]]:
        """(level, column, row, copies) of the leaves below a crowded cell."""
        todo = [(0, 0, 0)]
        while todo:
            level, x, y = todo.pop()
            copies = tree.get(node_code(level, x, y))
            if copies is None or level == self.depth:
                yield level, x, y, copies or 1
            else:
                todo += [(level + 1, 2 * x + i, 2 * y + j) for i in (0, 1) for j in (0, 1)]

    def _cells(self) -> DataFrame:
        """The layer's grid cells, crowded ones cut to their leaves and copies."""
        spark, plain = self.index.cells.sparkSession, spatial.keyed_cells(self.index.cells)
        if not self.trees:
            return plain
        rows = [
            (cx, cy, level, (cx << level) + x, (cy << level) + y, s)
            for (cx, cy), tree in self.trees.items()
            for level, x, y, copies in self._leaves(tree)
            for s in range(copies)
        ]
        leaves = _local(spark, rows, "_bx _by _cl _lx _ly _cs").withColumns({c: F.col(c).cast("int") for c in ("_cl", "_cs")})
        cut = self.index.cells.join(leaves, (F.col("_cx") == F.col("_bx")) & (F.col("_cy") == F.col("_by")))
        cut = cut.withColumns({"_cx": F.col("_lx"), "_cy": F.col("_ly")}).drop("_bx", "_by", "_lx", "_ly")
        size = F.lit(self.index.cell) / F.call_function("shiftleft", F.lit(1), F.col("_cl"))
        cut = spatial.clipped(cut.withColumn("_whole", F.col("_inside")).drop("_inside"), size, "_whole")
        crowded = _local(spark, list(self.trees), "_bx _by")
        rest = plain.join(crowded, (F.col("_cx") == F.col("_bx")) & (F.col("_cy") == F.col("_by")), "left_anti")
        return rest.unionByName(cut.select(*plain.columns))

    def _bytes(self) -> int:
        """Size of ``cells`` in memory, about: one small job."""
        n, edges = self.cells.agg(F.count("*"), F.sum(F.coalesce(F.size("_edges"), F.lit(0)))).first()
        return 128 * n + 64 * max(0, edges or 0)

    def shared(self) -> DataFrame:
        """``cells`` to join points with: a broadcast table while it is small."""
        allowed = not self.cells.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
        return F.broadcast(self.cells) if allowed and self.bytes <= BROADCAST_BYTES else self.cells

    def place(self, points: DataFrame, px: Column, py: Column, name: str, spread: Column) -> DataFrame:
        """``points`` with the struct column ``name`` (l, x, y, s): the leaf of
        each point; ``spread`` chooses its copy."""
        plain = spatial.plain_place(px, py, self.index.cell)
        if not self.trees:
            return points.withColumn(name, plain)
        d = self.depth
        n = lambda s: f"{name}_{s}"
        # at most MAX_SPLITS nodes, whatever the points
        nodes = F.broadcast(_local(points.sparkSession, self.nodes, " ".join(map(n, ("l", "x", "y", "k")))))
        size = F.lit(self.index.cell / (1 << d))
        shift = lambda c, by: F.call_function("shiftright", c, by)
        fx, fy, low, high, copies, mid = (F.col(n(c)) for c in ("fx", "fy", "low", "high", "copies", "mid"))
        # ``low`` to ``high`` levels from the top are split
        found = points.withColumns(
            {n("fx"): F.floor(px / size), n("fy"): F.floor(py / size), n("low"): F.lit(0), n("high"): F.lit(d + 1), n("copies"): F.lit(None).cast("long")}
        )
        for _ in range((d + 1).bit_length()):
            found = found.withColumn(n("mid"), shift(low + high, F.lit(1)))
            at = (F.col(n("l")) == mid) & (F.col(n("x")) == shift(fx, F.lit(d) - mid)) & (F.col(n("y")) == shift(fy, F.lit(d) - mid))
            hit = F.col(n("l")).isNotNull()
            found = found.join(nodes, at, "left").withColumns(
                {
                    n("low"): F.when(hit, mid + 1).otherwise(low),
                    n("high"): F.when(hit, high).otherwise(mid),
                    n("copies"): F.coalesce(copies, F.nullif(F.col(n("k")), F.lit(0))),
                }
            ).drop(n("l"), n("x"), n("y"), n("k"))
        level = F.least(low, F.lit(d))
        salt = F.pmod(spread, F.coalesce(copies, F.lit(1))).cast("int")
        leaf = F.struct(level.alias("l"), shift(fx, F.lit(d) - level).alias("x"), shift(fy, F.lit(d) - level).alias("y"), salt.alias("s"))
        return found.withColumn(name, leaf).drop(*[n(c) for c in ("fx", "fy", "low", "high", "copies", "mid")])
