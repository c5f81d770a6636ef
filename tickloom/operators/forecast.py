"""Forecast frames, inference per series, and forecast scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.scalars import ratio
from tickloom.functions.times import HOUR_US, plus_minutes
from tickloom.operators import segments as sg
from tickloom.operators.serving import latest_n
from tickloom.session import ship_package, stored

# Encoder and decoder lengths, and minutes of the forecast rungs.
ENCODER_ROWS = 120
DECODER_ROWS = 10
FORECAST_MINUTES = {"1m": 1, "5m": 5, "15m": 15, "30m": 30}
QUANTILES = (0.3, 0.5, 0.7)

SERIES = ("screener", "symbol")
BAR = ("open", "high", "low", "close", "volume")


def with_time_idx(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    tie_breakers: Sequence[str] = (),
    chunk_us: int = HOUR_US,
) -> DataFrame:
    """``time_idx``: 0-based running row count per key in time order.

    A chunk of one key is one task's work; raw records at a high rate want
    chunks of a minute.
    """
    return sg.number_rows(df, keys, "time", tie_breakers, chunk_us, "time_idx")


def split_by_time(df: DataFrame, train_end: str, validation_end: str) -> DataFrame:
    """``split``: train, validation or test by two cut times."""
    t = F.col("time")
    return df.withColumn(
        "split",
        F.when(t < F.lit(train_end).cast("timestamp_ntz"), "train")
        .when(t < F.lit(validation_end).cast("timestamp_ntz"), "validation")
        .otherwise("test"),
    )


def minutes_of(screener: str | Column, rungs: dict[str, int] | None = None) -> Column:
    c = F.col(screener) if isinstance(screener, str) else screener
    unknown = F.raise_error(F.concat(F.lit("unknown screener: "), c)).cast("long")
    out = F.when(c.isNull(), F.lit(None).cast("long")).otherwise(unknown)
    for name, minutes in (rungs or FORECAST_MINUTES).items():
        out = F.when(c == name, F.lit(minutes).cast("long")).otherwise(out)
    return out


def forecast_frame(
    bars: DataFrame,
    encoder: int = ENCODER_ROWS,
    decoder: int = DECODER_ROWS,
    rungs: dict[str, int] | None = None,
) -> DataFrame:
    """Last ``encoder`` bars per series, then ``decoder`` rows that repeat the
    last bar at the following times. ``is_decoder`` tells them apart.

    After the latest-N step a series holds at most ``encoder`` rows, so the
    windows below are bounded.
    """
    recent = latest_n(bars.select(*SERIES, "time", *BAR), SERIES, encoder)
    w = Window.partitionBy(*SERIES).orderBy("time")
    whole = Window.partitionBy(*SERIES)
    indexed = recent.withColumn("time_idx", (F.row_number().over(w) - 1).cast("long")).withColumn(
        "_last", F.max("time_idx").over(whole)
    )
    steps = F.when(
        F.col("time_idx") == F.col("_last"), F.sequence(F.lit(0), F.lit(decoder))
    ).otherwise(F.array(F.lit(0)))
    step = F.col("_step")
    return (
        indexed.withColumn("_step", F.explode(steps))
        .withColumn("time", plus_minutes("time", step * minutes_of("screener", rungs)))
        .withColumn("time_idx", F.col("time_idx") + step)
        .withColumn("is_decoder", step > 0)
        .select(*SERIES, "time", "time_idx", "is_decoder", *BAR)
    )


def drift(seen: DataFrame, steps: int = DECODER_ROWS) -> DataFrame:
    """Baseline model: the last close carried on along the mean change."""
    ends = seen.groupBy(*SERIES).agg(
        F.max("time").alias("base_time"),
        F.max_by("close", "time_idx").alias("_last"),
        F.min_by("close", "time_idx").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
    )
    slope = (F.col("_last") - F.col("_first")) / F.greatest(F.col("_n") - 1, F.lit(1))
    path = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.col("_last") + slope * i)
    return ends.select(*SERIES, "base_time", path.alias("predictions"), F.lit("drift").alias("model"))


PREDICTION_SCHEMA = (
    "screener string, symbol string, base_time timestamp_ntz, "
    "predictions array<double>, model string"
)


def predict(
    frame: DataFrame,
    model: Callable[[pd.DataFrame, int], Sequence[float]] | None = None,
    name: str = "model",
    steps: int = DECODER_ROWS,
    rungs: dict[str, int] | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """One row per series of a forecast frame, as the prediction topic has it:
    ``predictions``, ``interval`` in minutes and ``created_at``, by default now.

    Without a model it is ``drift``. A model of one's own is called as
    ``model(encoder rows, steps)`` once per series: a group is one frame, at most the
    encoder rows. The base time is the last observed bar.
    """
    seen = frame.filter(~F.col("is_decoder"))
    made = drift(seen, steps) if model is None else _by_model(seen, model, name, steps)
    now = F.current_timestamp() if created_at is None else created_at
    return made.withColumns(
        {
            "interval": minutes_of("screener", rungs).cast("int"),
            "created_at": now.cast("timestamp_ntz"),
        }
    )


def _by_model(seen: DataFrame, model, name: str, steps: int) -> DataFrame:

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("time_idx")
        values = [float(v) for v in model(rows, steps)]
        return pd.DataFrame(
            {
                "screener": [rows["screener"].iloc[-1]],
                "symbol": [rows["symbol"].iloc[-1]],
                "base_time": [rows["time"].iloc[-1]],
                "predictions": [values],
                "model": [name],
            }
        )

    ship_package()
    return seen.groupBy(*SERIES).applyInPandas(run, PREDICTION_SCHEMA)


def explode_predictions(predictions: DataFrame) -> DataFrame:
    """One row per step; step ``k`` (from 1) lies ``k * interval`` minutes after
    the base time."""
    rest = [
        c for c in predictions.columns if c not in ("base_time", "predictions", "interval", "screener")
    ]
    return predictions.select(
        *rest,
        F.col("base_time").alias("time"),
        F.format_string("%dm", "interval").alias("screener"),
        "interval",
        F.posexplode("predictions").alias("_pos", "close_predict"),
    ).select(
        *rest,
        "screener",
        "time",
        plus_minutes("time", (F.col("_pos") + 1) * F.col("interval")).alias("time_step"),
        "close_predict",
    )


def against_actuals(steps: DataFrame, bars: DataFrame) -> DataFrame:
    """Forecast steps that have come true, with the ``close`` of their bar."""
    actual = bars.select(*SERIES, F.col("time").alias("time_step"), "close")
    return steps.join(actual, [*SERIES, "time_step"])


def anchor_to_open(predictions: Column, open_: Column) -> Column:
    """Shifts a forecast so that its first value equals the open."""
    shift = F.element_at(predictions, 1) - open_
    return F.transform(predictions, lambda p: p - shift)


# Small constant that keeps the percentage errors finite.
EPSILON = 1e-8


def error_columns(actual: str = "close", predicted: str = "close_predict") -> list[Column]:
    y, p = F.col(actual), F.col(predicted)
    off = F.abs(y - p)
    return [
        F.avg(off).alias("mae"),
        F.avg(2 * off / (F.abs(y) + F.abs(p) + EPSILON)).alias("smape"),
        F.avg(off / (F.abs(y) + EPSILON)).alias("mape"),
        F.count(off).alias("n"),
    ]


def forecast_errors(df: DataFrame, keys: Sequence[str] = (), **names) -> DataFrame:
    return df.groupBy(*keys).agg(*error_columns(**names))


def pinball_columns(
    actual: str = "close", predicted: str = "close_predict", quantiles: Sequence[float] = QUANTILES
) -> list[Column]:
    e = F.col(actual) - F.col(predicted)
    return [
        F.avg(F.greatest(e * q, e * (q - 1))).alias(f"pinball_{int(round(q * 100))}")
        for q in quantiles
    ]


def quantile_loss(df: DataFrame, keys: Sequence[str] = (), **names) -> DataFrame:
    return df.groupBy(*keys).agg(*pinball_columns(**names))


def directional_accuracy(
    df: DataFrame, predicted_change: str, actual_change: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Share of rows whose predicted and actual changes have one sign.

    A row without an actual change counts as a miss.
    """
    same = F.signum(predicted_change) == F.signum(actual_change)
    return df.groupBy(*keys).agg(
        F.avg(F.coalesce(same, F.lit(False)).cast("double")).alias("directional_accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def target_scale(df: DataFrame, target: str = "close", key: str = "symbol") -> DataFrame:
    """Centre (mean) and scale (sample deviation) of the target per symbol."""
    return df.groupBy(key).agg(
        F.avg(target).alias("center"), F.stddev_samp(target).alias("scale")
    )


def normalise(df: DataFrame, target: str = "close", key: str = "symbol") -> DataFrame:
    """``target`` less its centre, over its scale. The scales are stored first, so no
    row of ``df`` is shuffled while they are below the broadcast threshold."""
    scale = stored(target_scale(df, target, key), "target-scale")
    return df.join(scale, key).withColumn(
        f"{target}_scaled", ratio(F.col(target) - F.col("center"), F.col("scale"))
    )


def join_actuals(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Left join of predictions onto indexed rows."""
    return actuals.join(predictions, ["symbol", "time_idx"], "left")
