"""Gap arithmetic for neighbour values.

Two gap forms exist and must not be mixed up:

* step form (impressions and count lags): the k-th gap is between the
  (k-1)-th and the k-th neighbour;
* total form (view log, time and price): the k-th gap is between the row and
  its k-th neighbour.

The "difference" of a row is its backward gap minus its forward gap; it is
NULL when either side is missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def step_gap(nearer: str | Column, farther: str | Column, backward: bool = True) -> Column:
    """Gap between two neighbours on the same side of the row.

    Backward: ``nearer - farther`` (previous values); forward:
    ``farther - nearer`` (next values).  With k = 1 ``nearer`` is the value of
    the row itself.
    """
    return _col(nearer) - _col(farther) if backward else _col(farther) - _col(nearer)


def total_gap(value: str | Column, neighbour: str | Column, backward: bool = True) -> Column:
    """Gap between the row and its k-th neighbour."""
    return _col(value) - _col(neighbour) if backward else _col(neighbour) - _col(value)


def second_difference(backward_gap: str | Column, forward_gap: str | Column) -> Column:
    """Backward gap minus forward gap."""
    return _col(backward_gap) - _col(forward_gap)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``DOUBLE`` ratio; NULL instead of an error when the denominator is 0
    or missing (ANSI mode raises on division by zero)."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
