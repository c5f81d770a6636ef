"""Recursive indicators over an array of closes, oldest first.

These are the array forms, for callers that hold a history array. Over a table,
use ``operators.indicators``, which needs no arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _values(prices: Column) -> Column:
    return F.filter(prices, lambda p: p.isNotNull())


def ema(prices: Column, span: int) -> Column:
    """Exponential mean seeded with the oldest value; null on no values."""
    if span is None or span <= 0:
        return F.lit(None).cast("double")
    vals = _values(prices)
    alpha = 2.0 / (span + 1.0)
    return F.when(
        F.size(vals) > 0,
        F.aggregate(
            F.slice(vals, 2, F.greatest(F.size(vals) - 1, F.lit(0))),
            F.element_at(vals, 1),
            lambda acc, p: p * alpha + acc * (1.0 - alpha),
        ),
    )


def macd(prices: Column, fast: int = 12, slow: int = 26) -> Column:
    return ema(prices, fast) - ema(prices, slow)


def wilder(values: Column, period: int) -> Column:
    """Wilder mean of a non-null array: the simple mean of the first ``period``
    values, then ``(mean * (period - 1) + x) / period``; null while shorter."""
    seed = F.aggregate(
        F.slice(values, 1, period), F.lit(0.0), lambda acc, x: acc + x
    ) / float(period)
    rest = F.slice(values, period + 1, F.greatest(F.size(values) - period, F.lit(0)))
    return F.when(
        F.size(values) >= period,
        F.aggregate(rest, seed, lambda acc, x: (acc * float(period - 1) + x) / float(period)),
    )


def rsi(prices: Column, period: int = 14) -> Column:
    """Wilder RSI; null below ``period + 1`` values, 100 without losses."""
    if period is None or period <= 0:
        return F.lit(None).cast("double")
    vals = _values(prices)
    n = F.greatest(F.size(vals) - 1, F.lit(0))
    changes = F.zip_with(F.slice(vals, 2, n), F.slice(vals, 1, n), lambda b, a: b - a)
    gain = wilder(F.transform(changes, lambda c: F.greatest(c, F.lit(0.0))), period)
    loss = wilder(F.transform(changes, lambda c: F.greatest(-c, F.lit(0.0))), period)
    return F.when(loss == 0, 100.0).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain / loss)
    )
