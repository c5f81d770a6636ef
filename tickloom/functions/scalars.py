"""Small column expressions shared by operators and views."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den``, null unless the denominator is positive."""
    return F.when(den > 0, num / den)


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, null for a zero denominator."""
    return F.try_divide(num, den)


def percent_change(before: Column, after: Column) -> Column:
    """Change in percent, null unless ``before`` is positive."""
    return guarded_ratio(after - before, before) * 100


def number_or_null(c: str) -> Column:
    """Text to double; null stays null and bad text becomes null."""
    return F.col(c).try_cast("double")


def candle_colour(open_: str = "open", close: str = "close") -> Column:
    return F.when(F.col(close) < F.col(open_), "red").otherwise("green")


# Display labels of the three signal sides.
SIDE_LABELS = {"BUY": "🟢 MUA", "SELL": "🔴 BÁN", "WATCH": "🟡 THEO DÕI"}


def side_label(side: str = "side", labels: dict[str, str] | None = None) -> Column:
    """Display label of a side; an unknown side passes through."""
    out = F.col(side)
    for key, label in (labels or SIDE_LABELS).items():
        out = F.when(F.col(side) == key, label).otherwise(out)
    return out


def rsi_zone(rsi: str = "rsi14", low: float = 30.0, high: float = 70.0) -> Column:
    c = F.col(rsi)
    return F.when(c >= high, "overbought").when(c <= low, "oversold").when(
        c.isNotNull(), "neutral"
    )


def net_foreign_flow() -> Column:
    return F.col("foreign_buy_volume") - F.col("foreign_sell_volume")


def quote_ticker(symbol: str, market: str = "VN") -> Column:
    """Ticker used by quote services, for example ``ACB.VN``."""
    return F.format_string(f"%s.{market}", F.col(symbol))
