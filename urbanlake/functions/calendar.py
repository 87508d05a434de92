"""Calendar columns.

All functions take and return ``Column`` expressions, so they stay inside
whole-stage codegen and never leave the JVM.

Week rules of the reference (SURVEY S1-S4):

* a week starts on **Sunday**: ``date - dayofweek`` (Sunday = 0);
* its "ISO" start is that Sunday **plus one day**, so a Sunday belongs to the
  week of the following Monday;
* the week label is ``<ISO week of the Monday>-<calendar year of the Monday>``,
  unpadded (not injective: 30 Dec 1996 and 1 Jan 1996 both give ``1-1996``);
* the month label is ``<month>-<year>``, unpadded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(d) -> Column:
    """Sunday on or before ``d`` (``dayofweek`` is 1 for Sunday)."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_start_iso(d) -> Column:
    """Monday after the Sunday week start of ``d``."""
    return F.date_add(week_start(d), 1)


def iso_from_week_start(ws) -> Column:
    """Monday of a week given its Sunday start (COVID rows carry the Sunday)."""
    return F.date_add(_col(ws), 1)


def week_label(monday) -> Column:
    """``'<iso week>-<year>'`` of a Monday; NULL in, NULL out."""
    m = _col(monday)
    return F.concat(F.weekofyear(m).cast("string"), F.lit("-"), F.year(m).cast("string"))


def month_label(d) -> Column:
    """``'<month>-<year>'``, unpadded."""
    d = _col(d)
    return F.concat(F.month(d).cast("string"), F.lit("-"), F.year(d).cast("string"))


def label_part(label, n: int) -> Column:
    """Integer part ``n`` (1-based) of a ``'a-b'`` label, as ``SPLIT_PART`` does."""
    return F.split_part(_col(label), F.lit("-"), F.lit(n)).cast("int")


def prefix_label(label, prefix: str = "WEEK-") -> Column:
    """``prefix || label``; NULL label stays NULL."""
    return F.concat(F.lit(prefix), _col(label))
