"""Kept point dictionary (E1-E3): which polygons contain each known point.

Trips and permits repeat the same locations from run to run, so what a spatial
join has found out about a point is kept: one row per point with the matches in
every layer, also for points that lie in none.  A run matches only points that
the dictionary does not hold yet.

The rows belong to one version of the layers, a digest of their keys and
geometries.  When a layer changes, its dictionary starts anew and older
versions are dropped.  New points are appended as Parquet files; a run that is
killed and repeated finds those that were committed, and points that two runs
appended at once count once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import delete, subfolders
from . import spatial


class PointDictionary:
    """Matches of points in ``layers`` under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str, layers: Sequence[spatial.PolygonIndex], cover: Callable | None = None):
        self.spark, self.layers, self.cover = spark, list(layers), cover
        self.root = path.rstrip("/")
        version = spark.range(1).select(F.sha2(F.lit("|".join(index.version() for index in self.layers)), 256)).first()[0][:24]
        self.path = f"{self.root}/layers-{version}"
        matches = [f"m{i} array<{index.cells.select(F.struct(*index.take)).dtypes[0][1]}>" for i, index in enumerate(self.layers)]
        self.schema = ", ".join(["x double", "y double", *matches])

    def _stored(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def lookup(self) -> DataFrame:
        """(x, y, m0, m1, …), one row per known point."""
        return self._stored().dropDuplicates(["x", "y"])

    def update(self, sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> int:
        """Match the points in the point columns of ``sources`` ([(frame,
        columns)]) that are not known yet, in one job for all layers, and
        append them.  Returns how many there were."""
        points = None
        for df, columns in sources:
            part = df.select(F.explode(F.array(*[F.col(c) for c in dict.fromkeys(columns)])).alias("_pt"))
            points = part if points is None else points.unionByName(part)
        # no polygon contains NaN; a point of another sign of zero is the same point
        known = self._stored().select(F.col("x").alias("_x"), F.col("y").alias("_y"))
        x, y = F.col("_pt")["x"], F.col("_pt")["y"]
        points = points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)).distinct()
        new = points.join(known, (x == F.col("_x")) & (y == F.col("_y")), "left_anti")
        covers = [self.cover(index, new, "_pt") if self.cover else None for index in self.layers]
        before = self._files()
        spatial.point_matches(new, self.layers, covers, unmatched=True).write.mode("append").parquet(self.path)
        for other in subfolders(self.spark, self.root):
            if other != self.path.rsplit("/", 1)[1]:
                delete(self.spark, f"{self.root}/{other}")
        added = sorted(self._files() - before)
        return self.spark.read.schema(self.schema).parquet(*added).count() if added else 0

    def _files(self) -> set[str]:
        return set(self._stored().inputFiles())
