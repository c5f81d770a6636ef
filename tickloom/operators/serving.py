"""Latest-N and overview queries over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SALTS = 32


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Rows are ranked twice: within a salt of the key, then per key over at most
    ``salts * n`` survivors. The group limit is also applied map-side, so even a
    key with most of the rows never meets in one task.
    """
    keys = list(keys)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]), F.lit(salts))
    near = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(near))
        .filter(F.col("_rank") <= n)
        .drop("_salt", "_rank")
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def latest_n(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    time: str = "time",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The newest ``n`` rows per key."""
    return first_n(df, keys, [F.col(time).desc(), *[F.col(c) for c in ties]], n)


def latest_of(df: DataFrame, where: Column, n: int, time: str = "time") -> DataFrame:
    """The newest ``n`` rows of one key: a pushed filter and a top-n."""
    return df.filter(where).orderBy(F.col(time).desc()).limit(n)


def edge_times(df: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    """First and last stored time per key."""
    return df.groupBy(*keys).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def last_row(df: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    return latest_n(df, keys, 1, time)


def predictions_of(predictions: DataFrame, symbol: str) -> DataFrame:
    """All forecasts of a symbol, newest base time first."""
    return (
        predictions.filter(F.col("symbol") == symbol)
        .select("time", "time_step", "close_predict", "screener")
        .orderBy(F.col("time").desc(), "time_step", "screener")
    )


def sample_symbols(df: DataFrame, n: int = 18, seed: int = 0) -> DataFrame:
    """A random sample of ``n`` symbols, the same on every run with one seed.

    Symbols are drawn in the order of a digest and not of a random stream, so a
    task that is run again draws the same ones.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("symbol")))
    return df.select("symbol").distinct().orderBy(draw).limit(n)


def overlay(candles: DataFrame, indicators: DataFrame) -> DataFrame:
    """Candles with their indicators, where there are any."""
    keys = ["screener", "symbol", "time"]
    return candles.join(indicators.drop("close"), keys, "left")


def flatten_book(book: DataFrame) -> DataFrame:
    """Nested order book to one column per depth level."""
    levels = [
        F.col(f"{side}.{side}_{i}{suffix}").alias(f"{side.lower()}_{i}{suffix}")
        for side in ("Buy", "Sell")
        for i in (1, 2, 3)
        for suffix in ("", "_volume")
    ]
    plain = [c for c in book.columns if c not in ("Buy", "Sell", "Room_foreign")]
    head = [c for c in plain if c not in ("highest", "lowest", "average")]
    return book.select(
        *head, F.col("Room_foreign").alias("room_foreign"), *levels, "highest", "lowest", "average"
    )
