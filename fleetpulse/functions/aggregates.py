"""Exact rounded averages and percentages.

Group means of one-decimal values often land exactly on a half cent, where
``round(avg(double), 2)`` depends on float noise.  These helpers compute the
rounded mean from integer sums instead: half away from zero on the true
mean, the same in every engine that has integer division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["idiv", "round_mean_tenths_2dp", "round_mean_int_2dp",
           "round_pct_1dp"]


def idiv(a: Column, b: Column) -> Column:
    """Integral division (SQL ``div``), exact on longs."""
    return F.call_function("div", a, b)


def round_mean_tenths_2dp(s: Column, n: Column) -> Column:
    """Mean of values held in tenths (sum ``s``, count ``n``), 2 places.

    ``sign(s) * ((|s|*20 + n) div 2n) / 100``; NULL when ``n`` is 0.
    """
    n_ = F.nullif(n.cast("long"), F.lit(0))
    s_ = s.cast("long")
    # an integer sign: a small negative mean rounds to 0.0, never to -0.0
    sign = F.when(s_ < 0, F.lit(-1)).otherwise(F.lit(1))
    return sign * idiv(F.abs(s_) * 20 + n_, n_ * 2) / F.lit(100.0)


def round_mean_int_2dp(s: Column, n: Column) -> Column:
    """Mean of non-negative integers, 2 places: ``((200 s + n) div 2n) / 100``."""
    n_ = F.nullif(n.cast("long"), F.lit(0))
    return idiv(s.cast("long") * 200 + n_, n_ * 2) / F.lit(100.0)


def round_pct_1dp(t: Column, n: Column) -> Column:
    """Share of true values in percent, 1 place: ``((2000 t + n) div 2n) / 10``."""
    n_ = F.nullif(n.cast("long"), F.lit(0))
    return idiv(t.cast("long") * 2000 + n_, n_ * 2) / F.lit(10.0)
