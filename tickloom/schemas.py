"""Record schemas of the input topics, and columns and keys of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# Event time is zoneless text on the wire; it is parsed after decoding.
OHLC_RECORD = _struct(
    screener=_S, symbol=_S, open=_D, high=_D, low=_D, close=_D, volume=_D, time=_S
)

NEWS_RECORD = _struct(
    symbol=_S,
    id=_S,
    news_title=_S,
    news_source_link=_S,
    public_date=_S,
    news_short_content=_S,
    close_price=_D,
    price_change_pct=_D,
)


def _depth(side: str) -> T.StructType:
    prices = [T.StructField(f"{side}_{i}", _D) for i in (1, 2, 3)]
    volumes = [T.StructField(f"{side}_{i}_volume", _L) for i in (1, 2, 3)]
    return T.StructType(prices + volumes)


ORDER_BOOK_RECORD = T.StructType(
    [T.StructField("handle_time", _S), T.StructField("symbol", _S)]
    + [
        T.StructField(n, _D)
        for n in (
            "ceiling",
            "floor",
            "reference",
            "Room_foreign",
            "foreign_buy_volume",
            "foreign_sell_volume",
        )
    ]
    + [T.StructField("Buy", _depth("Buy")), T.StructField("Sell", _depth("Sell"))]
    + [T.StructField(n, _D) for n in ("highest", "lowest", "average")]
)

PREDICTION_RECORD = _struct(
    symbol=_S,
    base_time=_S,
    predictions=T.ArrayType(_D),
    model=_S,
    created_at=_S,
    interval=_I,
)

FUNDAMENTALS = T.MapType(
    _S,
    _struct(Loai_cty=T.ArrayType(_S), Tong_co_phieu=_L, Von_dieu_le=_L),
)


@dataclass(frozen=True)
class Table:
    """A keyed table: primary key, columns, and how its files are laid out."""

    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    partitions: tuple[str, ...]
    clustering: tuple[str, ...]


_BOOK_DEPTH = tuple(
    f"{side}_{i}{suffix}"
    for side in ("buy", "sell")
    for i in (1, 2, 3)
    for suffix in ("", "_volume")
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "ohlvc",
            ("screener", "symbol", "time"),
            ("open", "high", "low", "close", "volume"),
            ("screener",),
            ("symbol", "time"),
        ),
        Table(
            "indicators",
            ("screener", "symbol", "time"),
            ("close", "sma20", "ema12", "ema26", "macd", "rsi14", "bb_mid",
             "bb_upper", "bb_lower", "vwap", "ret"),
            ("screener",),
            ("symbol", "time"),
        ),
        Table(
            "signals",
            ("symbol", "signal_time", "signal_type"),
            ("side", "price", "detail"),
            (),
            ("symbol", "signal_time"),
        ),
        Table(
            "news",
            ("symbol", "id"),
            ("title", "link", "public_date", "s_content", "close",
             "price_change_pct", "label", "sentiment_score"),
            (),
            ("symbol", "id"),
        ),
        Table(
            "news_impact",
            ("symbol", "news_time", "id"),
            ("title", "link", "price_before", "price_after", "max_price",
             "min_price", "n_candles", "impact_pct"),
            (),
            ("symbol", "news_time"),
        ),
        # The rung is part of the key: rungs that share (time, time_step) must
        # not overwrite each other.
        Table(
            "prediction",
            ("symbol", "screener", "time", "time_step"),
            ("close_predict", "model", "created_at"),
            ("screener",),
            ("symbol", "time"),
        ),
        Table(
            "trading_data",
            ("symbol", "handle_time"),
            ("ceiling", "floor", "reference", "room_foreign",
             "foreign_buy_volume", "foreign_sell_volume", *_BOOK_DEPTH,
             "highest", "lowest", "average"),
            (),
            ("symbol", "handle_time"),
        ),
    )
}
