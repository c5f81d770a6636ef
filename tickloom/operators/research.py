"""Daily research features: capitalisation, volatility, true range, rankings.

Windows per symbol run over daily bars only, whose number is bounded by the
calendar.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions import folds
from tickloom.functions.scalars import ratio
from tickloom.functions.times import DAY_US, MINUTE_US, bin_start, from_micros
from tickloom.operators.candles import daily, recency_order
from tickloom.session import stored

TRADING_DAYS = 252


def _by_day(rows: int | None = None):
    w = Window.partitionBy("symbol").orderBy("time")
    return w if rows is None else w.rowsBetween(1 - rows, 0)


def market_cap(records: DataFrame, shares: DataFrame, seq: str | None = None) -> DataFrame:
    """Market cap per (symbol, time): first open x shares / 1000.

    Records are reduced to one row per (symbol, time) before the lookup.
    """
    first = F.min_by("open", seq) if seq else F.first("open")
    return (
        records.groupBy("symbol", "time")
        .agg(first.alias("first_open"))
        .join(shares.select("symbol", "shares"), "symbol")
        .withColumn("market_cap", F.col("first_open") * F.col("shares") / 1000.0)
    )


def last_market_cap(records: DataFrame, shares: DataFrame, seq: str) -> DataFrame:
    """Market cap per symbol at its last time.

    Two hash aggregations, per minute and per symbol, both combined map-side: no
    raw record is shuffled.
    """
    minute = bin_start("time", MINUTE_US)
    per_minute = (
        records.withColumn("_minute", minute)
        .withColumn("_order", recency_order("time", seq))
        .groupBy("symbol", "_minute")
        .agg(F.min_by("open", "_order").alias("open"))
    )
    last = per_minute.groupBy("symbol").agg(F.max_by("open", "_minute").alias("last_open"))
    return last.join(shares.select("symbol", "shares"), "symbol").select(
        "symbol", (F.col("last_open") * F.col("shares") / 1000.0).alias("market_cap")
    )


def top_symbols(df: DataFrame, metric: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.col(metric).desc(), "symbol").limit(n)


def nominal_volume(days: DataFrame) -> DataFrame:
    """Median volume (cut to an integer) times mean close, per symbol."""
    return days.groupBy("symbol").agg(
        F.median("volume").cast("long").alias("median_volume"),
        F.avg("close").alias("average_price"),
    ).withColumn("nominal_volume", F.col("median_volume") * F.col("average_price"))


def log_returns(days: DataFrame) -> DataFrame:
    before = F.lag("close").over(_by_day())
    return days.withColumn("log_return", F.log(ratio(F.col("close"), before)))


def backfill(days: DataFrame, *columns: str) -> DataFrame:
    """Nulls take the next value of the same symbol."""
    ahead = _by_day().rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return days.withColumns({c: F.first(c, ignorenulls=True).over(ahead) for c in columns})


def historical_volatility(days: DataFrame, rows: int = 30) -> DataFrame:
    """Rolling sample deviation of daily log returns, annualised and back-filled."""
    out = log_returns(days).withColumn("rolling_std", F.stddev_samp("log_return").over(_by_day(rows)))
    out = out.withColumn("annual_vol", F.col("rolling_std") * math.sqrt(TRADING_DAYS))
    return backfill(out.withColumn("hist_vol", F.col("annual_vol")), "hist_vol")


def true_range(days: DataFrame) -> DataFrame:
    """Largest of high-low, high-previous close, previous close-low; null on the
    first day of a symbol."""
    out = days.withColumn("_prev", F.lag("close").over(_by_day()))
    span = F.greatest(
        F.col("high") - F.col("low"), F.col("high") - F.col("_prev"), F.col("_prev") - F.col("low")
    )
    return out.withColumn("tr", F.when(F.col("_prev").isNotNull(), span)).drop("_prev")


def average_true_range(days: DataFrame, rows: int = 14, method: str = "simple") -> DataFrame:
    """``tr`` and ``atr``, the moving average of the true range.

    ``simple`` is the mean of the last ``rows`` days and null before there are
    that many; ``wilder`` smooths recursively over the last 300 days.
    """
    out = true_range(days)
    if method == "simple":
        w = _by_day(rows)
        full = F.count("tr").over(w) >= rows
        return out.withColumn("atr", F.when(full, F.avg("tr").over(w)))
    if method != "wilder":
        raise ValueError(f"method must be simple or wilder, not {method!r}")
    past = F.collect_list("tr").over(_by_day(300))
    return out.withColumn("_past", past).withColumn("atr", folds.wilder(F.col("_past"), rows)).drop("_past")


def _daily_features(records: DataFrame, seq: str | None) -> DataFrame:
    days = daily(records, seq=seq)
    return backfill(average_true_range(historical_volatility(days)), "tr", "atr").select(
        "symbol", F.col("time").alias("day"), "hist_vol", "tr", "atr"
    )


def volatility_features(records: DataFrame, seq: str | None = None) -> DataFrame:
    """Daily hist_vol, TR and ATR joined back onto the minute rows.

    Back-filling happens on the daily rows: all rows of one day share a value,
    so the next value of a row is the value of the next day that has one.
    """
    return join_daily(records, _daily_features(records, seq)).withColumns(
        {c: ratio(F.col(c), F.col("close")) for c in ("tr", "atr")}
    )


def join_daily(records: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of daily values (symbol, day, ...) onto finer rows.

    The daily values are stored first, so their size is known when the join is
    planned: below the broadcast threshold no finer row is shuffled.
    """
    return (
        records.withColumn("day", from_micros(bin_start("time", DAY_US)))
        .join(stored(features, "daily-values"), ["symbol", "day"], "left")
        .drop("day")
    )


def volatility_summary(records: DataFrame, seq: str | None = None) -> DataFrame:
    """Means per symbol of the hist_vol and atr that ``volatility_features`` gives
    the records; symbols lacking either are left out.

    The rows of a day share its values, so they are counted per day and no record is
    joined: the mean of ATR over close is ATR times the sum of 1 / close.
    """
    inverse = ratio(F.lit(1.0), F.col("close"))
    counted = (
        records.groupBy("symbol", from_micros(bin_start("time", DAY_US)).alias("day"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(inverse).alias("_inverse"), F.count(inverse).alias("_n_inverse"))
    )
    met = counted.join(_daily_features(records, seq), ["symbol", "day"])

    def mean(total, n, of):
        return ratio(F.sum(total), F.sum(F.when(F.col(of).isNotNull(), F.col(n))))

    return (
        met.groupBy("symbol")
        .agg(
            mean(F.col("hist_vol") * F.col("_n"), "_n", "hist_vol").alias("hist_vol"),
            mean(F.col("atr") * F.col("_inverse"), "_n_inverse", "atr").alias("atr"),
        )
        .dropna()
    )
