"""Small derived-column helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_fill(c) -> Column:
    """``COALESCE(x, 0)``."""
    return F.coalesce(_col(c), F.lit(0))


def impute_area(own, matched) -> Column:
    """Own community area unless NULL or 0, else the spatial match."""
    return F.coalesce(F.nullif(_col(own), F.lit(0)), _col(matched))


def airport_from_zip(zip_col, airports: Mapping[str, Sequence[int]]) -> Column:
    """Airport name for a pickup ZIP, NULL for any other ZIP (C14)."""
    z = _col(zip_col)
    expr = None
    for name, zips in airports.items():
        cond = z.isin(list(zips))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def score_sum(a, b) -> Column:
    """``a + b``, NULL-propagating."""
    return _col(a) + _col(b)


def iqr_rank(v, q1, q3) -> Column:
    """1 below Q1, 2 within [Q1, Q3] (inclusive), 3 above Q3, NULL for NULL."""
    v, q1, q3 = _col(v), _col(q1), _col(q3)
    return F.when(v < q1, 1).when(v.between(q1, q3), 2).when(v > q3, 3)


def severity(trips, cases, q1_trips, q3_trips, q1_cases, q3_cases) -> Column:
    """Severity class from the two quartile ranks.

    The reference spells the classes out as a seven-branch ``CASE``; they are
    exactly the rank sums: 5 or 6 → High, 4 → Medium, otherwise (including any
    NULL input) → Low.
    """
    s = iqr_rank(trips, q1_trips, q3_trips) + iqr_rank(cases, q1_cases, q3_cases)
    return F.when(s >= 5, "High").when(s == 4, "Medium").otherwise("Low")
