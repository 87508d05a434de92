"""Dense (period × key) spines and zero-filled joins.

The reference writes ``SELECT DISTINCT period, zip FROM facts, zips`` — a
cross join of the whole fact table with the ZIP table, de-duplicated
afterwards.  ``DISTINCT (A × B) = DISTINCT A × DISTINCT B`` (R1), so the
product here is taken only after both sides are reduced to their distinct
values: its size is exactly the report's row count (periods × ZIPs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dense_spine(periods: DataFrame, *key_sets: DataFrame) -> DataFrame:
    """Every combination of the distinct rows of ``periods`` and each key set.

    NULL periods are kept (one spine row per key, S23).  No broadcast hint
    is given: both sides are distinct aggregates, so AQE sees their measured
    sizes and broadcasts the side under ``autoBroadcastJoinThreshold`` (a
    ZIP or airport list); if neither is, the product is planned as a
    cartesian product, whose output is the spine itself.
    """
    spine = periods.distinct()
    for keys in key_sets:
        spine = spine.crossJoin(keys.distinct())
    return spine


def zero_filled_left_join(
    spine: DataFrame,
    facts: DataFrame,
    on: Sequence[tuple[str, str]],
    fill: dict[str, str],
) -> DataFrame:
    """``spine LEFT JOIN facts`` on plain equality, facts columns zero-filled.

    ``on`` pairs (spine column, facts column); equality is not NULL-safe, so a
    NULL period never matches and its cell totals 0 (S23).  ``fill`` maps an
    output name to a facts column.
    """
    f = facts.select(
        *[F.col(fc).alias(f"_k{i}") for i, (_, fc) in enumerate(on)],
        *[F.col(src).alias(f"_v_{dst}") for dst, src in fill.items()],
    )
    cond = None
    for i, (sc, _) in enumerate(on):
        c = spine[sc] == f[f"_k{i}"]
        cond = c if cond is None else cond & c
    out = spine.join(f, cond, "left")
    for dst in fill:
        out = out.withColumn(dst, F.coalesce(F.col(f"_v_{dst}"), F.lit(0)).cast("long"))
    return out.drop(*[f"_k{i}" for i in range(len(on))], *[f"_v_{d}" for d in fill])
