"""Calendar and time-of-day features.

Missing timestamps fall into the *else* branch of every rule (night,
nocturnal, low), as in the source library.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def hour_cycle(hour, period: int = 24) -> tuple[Column, Column]:
    """(sin, cos) of theta = 2*pi*hour/period."""
    theta = _c(hour).cast("double") * F.lit(2 * math.pi / period)
    return F.sin(theta), F.cos(theta)


def month_cycle(month, period: int = 12, peak_month: int = 1) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*(m-1)/period - 2*pi*(peak-1)/period.

    The cosine peaks at ``peak_month``.
    """
    phase = 2 * math.pi * (peak_month - 1) / period
    theta = (_c(month).cast("double") - F.lit(1.0)) * F.lit(2 * math.pi / period) - F.lit(phase)
    return F.sin(theta), F.cos(theta)


def period_of_day(ts) -> Column:
    h = F.hour(_c(ts))
    return (F.when((h >= 3) & (h < 12), "morning")
             .when((h >= 12) & (h < 18), "afternoon")
             .otherwise("night"))


def diurnal_nocturnal(ts) -> Column:
    h = F.hour(_c(ts))
    return F.when((h >= 3) & (h < 18), "diurnal").otherwise("nocturnal")


def high_season(ts, start=(12, 15), end=(3, 15)) -> Column:
    """'high' from ``start`` (month, day) through ``end`` inclusive, across new year."""
    t = _c(ts)
    md = F.month(t) * 100 + F.dayofmonth(t)
    s, e = start[0] * 100 + start[1], end[0] * 100 + end[1]
    inside = (md >= s) | (md <= e) if s > e else (md >= s) & (md <= e)
    return F.when(inside, "high").otherwise("low")
