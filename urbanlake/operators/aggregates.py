"""Aggregates used by the reports.

Every grouped aggregate here is decomposable, so Spark runs it as a
map-side partial aggregate plus a final aggregate: a hot key (one ZIP or
week holding a third of all trips) collapses to one row per task before the
shuffle instead of landing in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def endpoint_counts(
    trips: DataFrame,
    period_cols: Sequence[str],
    pickup: str = "pickup_zip",
    dropoff: str = "dropoff_zip",
    trip_id: str = "trip_id",
    key: str = "zip",
) -> DataFrame:
    """Per (period…, key): ``n_pickup`` and ``n_dropoff`` in one scan.

    Each trip becomes two rows (pickup key, dropoff key) with ``inline``;
    one aggregate counts non-NULL trip ids per role (S16).  Rows whose key
    is NULL are kept as their own group so a caller can take the distinct
    periods of *all* trips from the same (small) aggregate instead of
    scanning the trips again.
    """
    roles = F.inline(
        F.array(
            F.struct(F.lit(True).alias("_is_pickup"), F.col(pickup).alias(key)),
            F.struct(F.lit(False).alias("_is_pickup"), F.col(dropoff).alias(key)),
        )
    )
    ex = trips.select(*period_cols, trip_id, roles)
    tid = F.col(trip_id)
    return ex.groupBy(*period_cols, key).agg(
        F.count(F.when(F.col("_is_pickup"), tid)).alias("n_pickup"),
        F.count(F.when(~F.col("_is_pickup"), tid)).alias("n_dropoff"),
        F.max(F.col("_is_pickup")).alias("has_pickup"),
        F.max(~F.col("_is_pickup")).alias("has_dropoff"),
    )


def rollup_endpoint_counts(counts: DataFrame, periods: dict[str, Column], key: str = "zip") -> DataFrame:
    """Roll ``endpoint_counts`` up to coarser periods (e.g. day → week, month).

    Counts add up and the presence flags OR together, so rolling up a
    (day, key) table gives exactly what ``endpoint_counts`` gives on the
    trips for the coarser period; the ``UNION``-distinct rule is applied
    afterwards, on the rolled-up counts.  ``periods`` maps output names to
    expressions over the finer table's columns.
    """
    return counts.groupBy(*[e.alias(n) for n, e in periods.items()], key).agg(
        F.sum("n_pickup").alias("n_pickup"),
        F.sum("n_dropoff").alias("n_dropoff"),
        F.max("has_pickup").alias("has_pickup"),
        F.max("has_dropoff").alias("has_dropoff"),
    )


def union_distinct_total(n_pickup="n_pickup", n_dropoff="n_dropoff") -> Column:
    """``SUM`` over ``UNION`` (distinct) of the two per-role counts.

    A (period, key) cell has at most one pickup row and one dropoff row; the
    distinct union drops one of them when the counts are equal.  A role with
    no group counts 0 here, and then ``0 == n`` only when ``n`` is 0 too, so
    the result matches in every case.
    """
    p, d = F.col(n_pickup), F.col(n_dropoff)
    return F.when(p == d, p).otherwise(p + d)


def union_distinct_rows(counts: DataFrame, period_cols: Sequence[str], key: str = "zip") -> DataFrame:
    """The rows of ``pickup counts UNION dropoff counts`` (I1), from
    ``endpoint_counts``: one row per role that has a group, equal counts
    of one cell collapsed to one row."""
    both = F.array_distinct(
        F.filter(
            F.array(
                F.when(F.col("has_pickup"), F.col("n_pickup")),
                F.when(F.col("has_dropoff"), F.col("n_dropoff")),
            ),
            lambda v: v.isNotNull(),
        )
    )
    return counts.where(F.col(key).isNotNull()).select(*period_cols, key, F.explode(both).alias("trip_count"))


def endpoint_totals(trips: DataFrame, period_cols: Sequence[str], **kw) -> DataFrame:
    """Per (period…, zip) total trip count of both endpoints, ZIP not NULL."""
    key = kw.get("key", "zip")
    g = endpoint_counts(trips, period_cols, **kw)
    return g.where(F.col(key).isNotNull()).select(
        *period_cols, key, union_distinct_total().cast("long").alias("total_trip_count")
    )


def quartiles(df: DataFrame, cols: Sequence[str], approx: bool = False, accuracy: int = 10_000) -> Column:
    """Scalar-subquery struct of ``PERCENTILE_CONT`` 0.25 / 0.75 per column.

    Fields are ``q1_<col>`` and ``q3_<col>``.  It is a one-row subquery,
    broadcast into the expression: no join and no driver collect.  Exact
    percentiles keep a value → count map per task, so memory follows the
    number of distinct values; ``approx=True`` switches to
    ``percentile_approx`` (bounded memory, returns observed values instead
    of interpolating) for very high cardinality.
    """
    fields = []
    for c in cols:
        if approx:
            fields.append(F.percentile_approx(F.col(c), 0.25, accuracy).cast("double").alias(f"q1_{c}"))
            fields.append(F.percentile_approx(F.col(c), 0.75, accuracy).cast("double").alias(f"q3_{c}"))
        else:
            fields.append(F.percentile(F.col(c), 0.25).alias(f"q1_{c}"))
            fields.append(F.percentile(F.col(c), 0.75).alias(f"q3_{c}"))
    return df.select(F.struct(*fields)).scalar()


def keep_min(df: DataFrame, value: str) -> DataFrame:
    """Rows whose ``value`` equals the global minimum, ties kept.

    The minimum is a scalar subquery; a NULL minimum keeps nothing, like the
    reference's equality join with the one-row ``MIN``.
    """
    m = df.select(F.min(F.col(value))).scalar()
    return df.where(F.col(value) == m)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (H7): planned as ``TakeOrderedAndProject``,
    a per-partition bounded heap — no global sort of the input."""
    return df.orderBy(*order).limit(k)


def trailing_avg(value: str, partition: Sequence[str], order: Sequence[Column], start: int, end: int) -> Column:
    """``AVG(value) OVER (PARTITION BY … ORDER BY … ROWS BETWEEN start AND end)``."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(start, end)
    return F.avg(F.col(value)).over(w)


def forecast_int(avg: Column) -> Column:
    """Average assigned to an integer column: empty frame → 0, then round half
    away from zero (S8, S9)."""
    return F.round(F.coalesce(avg, F.lit(0.0))).cast("int")


def trailing_avgs_by_range(
    df: DataFrame, values: dict[str, str], partition: Sequence[str], order: Sequence[Column], chunk: Column, start: int, end: int
) -> DataFrame:
    """``df`` with ``trailing_avg`` of several columns (output name: column),
    for long histories (G1-G5): a key's rows are split by ``chunk`` and each
    (key, chunk) is a window of its own, so that no task holds a whole history.

    ``chunk`` is an integer that never rises along ``order`` (say the year of
    a newest-first order; NULL, if NULLs come first).  A frame that ends
    ``end`` rows further on may reach into later chunks: the first ``end``
    rows of each chunk are handed to all chunks before it, which need no more
    of it.  The chunks, some calendar units, are listed on the driver.
    """
    rows = df.withColumn("_chunk", chunk.cast("int"))
    found = [r[0] for r in rows.select("_chunk").distinct().collect()]
    top = max([c for c in found if c is not None], default=0) + 1  # NULLs come first
    chunks = sorted({top if c is None else c for c in found})
    rows = rows.withColumn("_chunk", F.coalesce("_chunk", F.lit(top)))
    keys = [*partition, "_chunk"]
    heads = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_nth") <= end).drop("_nth")
    before = F.filter(F.array(*[F.lit(c) for c in chunks]).cast("array<int>"), lambda c: c > F.col("_chunk"))
    halo = heads.withColumn("_to", F.explode(before)).drop("_chunk").withColumnRenamed("_to", "_chunk")
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)))
    frame = Window.partitionBy(*keys).orderBy(F.col("_halo"), *order).rowsBetween(start, end)
    # own rows come first, then the chunks after them, in order
    out = both.withColumns({name: F.avg(F.col(c)).over(frame) for name, c in values.items()})
    return out.where(~F.col("_halo")).drop("_halo", "_chunk")
