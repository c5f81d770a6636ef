"""Forecast frames and inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import candles, forecast, quantiles
from tickloom.plans import views as v
from tickloom.plans.registry import query
from tickloom.schemas import TABLES
from tickloom.session import fresh_path, stored
from tickloom.sources import tables

W = v.with_

RECENT = """recent AS (
  SELECT *, count(*) OVER (PARTITION BY screener, symbol) AS n,
         row_number() OVER (PARTITION BY screener, symbol ORDER BY time) - 1 AS time_idx
  FROM (SELECT * FROM ladder WHERE screener <> '1H'
        QUALIFY row_number() OVER (PARTITION BY screener, symbol ORDER BY time DESC) <= 120)),
frame AS (
  SELECT screener, symbol, time, time_idx, false AS is_decoder, open, high, low, close, volume
  FROM recent
  UNION ALL
  SELECT screener, symbol,
         time + CAST(step * CAST(replace(screener, 'm', '') AS BIGINT) AS INTEGER) * INTERVAL 1 MINUTE,
         time_idx + step, true, open, high, low, close, volume
  FROM (SELECT *, unnest(range(1, 11)) AS step FROM recent WHERE time_idx = n - 1))"""


def frame(spark, sf):
    bars = candles.candle_ladder(v.ticks(spark, sf), seq="seq").filter(F.col("screener") != "1H")
    return forecast.forecast_frame(bars)


@query("y5_forecast_frame", W(v.TICKS, v.LADDER, RECENT) + "SELECT * FROM frame")
def y5(spark, sf):
    return frame(spark, sf)


@query(
    "y4_inference",
    W(v.TICKS, v.LADDER, RECENT)
    + """SELECT screener, symbol, base_time, 'drift' AS model, step,
  round(last_close + (last_close - first_close) / greatest(n - 1, 1) * step, 6) + 0e0 AS close_predict
FROM (SELECT screener, symbol, max(time) AS base_time, arg_max(close, time) AS last_close,
             arg_min(close, time) AS first_close, count(*) AS n, unnest(range(1, 11)) AS step
      FROM recent GROUP BY screener, symbol)""",
)
def y4(spark, sf):
    out = forecast.predict(frame(spark, sf)).select(
        "screener", "symbol", "base_time", "model", F.posexplode("predictions").alias("pos", "close_predict")
    )
    out = out.withColumn("step", (F.col("pos") + 1).cast("long")).drop("pos")
    return v.rounded(out, "close_predict")


_STEPS = """steps AS (
  SELECT screener, symbol, base_time AS time,
    base_time + CAST(step * CAST(replace(screener, 'm', '') AS BIGINT) AS INTEGER) * INTERVAL 1 MINUTE AS time_step,
    last_close + (last_close - first_close) / greatest(n - 1, 1) * step AS close_predict
  FROM (SELECT screener, symbol, max(time) AS base_time, arg_max(close, time) AS last_close,
               arg_min(close, time) AS first_close, count(*) AS n, unnest(range(1, 11)) AS step
        FROM recent GROUP BY screener, symbol))"""


@query(
    "y4_prediction_table",
    W(v.TICKS, v.LADDER, RECENT, _STEPS)
    + """SELECT symbol, screener, time, time_step, round(close_predict, 6) + 0e0 AS close_predict,
  'drift' AS model, TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM steps""",
)
def y4_table(spark, sf):
    """Frame, forecast, steps, stored and read back."""
    made = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    steps = forecast.explode_predictions(forecast.predict(frame(spark, sf), created_at=made))
    root = fresh_path(spark, "predictions")
    tables.write_batch(steps, root, TABLES["prediction"], 0, writer="model")
    return v.rounded(tables.read_table(spark, root, TABLES["prediction"]), "close_predict")


_PAST = RECENT.replace(
    "FROM ladder WHERE", "FROM ladder WHERE time < (SELECT date_trunc('day', max(time)) FROM ticks) AND"
)


@query(
    "a14_past_forecasts",
    W(v.TICKS, v.LADDER, _PAST, _STEPS)
    + """SELECT screener, round(avg(abs(l.close - s.close_predict)), 6) + 0e0 AS mae,
  round(avg(2 * abs(l.close - s.close_predict) / (abs(l.close) + abs(s.close_predict) + 1e-8)), 6) + 0e0 AS smape,
  round(avg(abs(l.close - s.close_predict) / (abs(l.close) + 1e-8)), 6) + 0e0 AS mape, count(*) AS n
FROM steps s JOIN (SELECT screener, symbol, time AS time_step, close FROM ladder) l
  USING (screener, symbol, time_step) GROUP BY screener""",
)
def a14_past(spark, sf):
    """Forecasts made at the start of the last day, scored on the bars that followed."""
    ticks = v.ticks(spark, sf)
    last_day = ticks.agg(F.date_trunc("day", F.max("time")).cast("timestamp_ntz")).first()[0]
    bars = candles.candle_ladder(ticks, seq="seq").filter(F.col("screener") != "1H")
    past = forecast.forecast_frame(bars.filter(F.col("time") < F.lit(last_day)))
    steps = forecast.explode_predictions(forecast.predict(past))
    out = forecast.forecast_errors(forecast.against_actuals(steps, bars), ["screener"])
    return v.rounded(out, "mae", "smape", "mape")


@query(
    "y6_anchor_predictions",
    W(v.TICKS, v.BARS_1H)
    + """SELECT symbol, time, round(open, 6) + 0e0 AS first_step, round(open + 1, 6) + 0e0 AS second_step
FROM bars_1h""",
)
def y6(spark, sf):
    steps = F.array(F.col("close"), F.col("close") + 1.0)
    out = v.hour_bars(spark, sf).withColumn("_p", forecast.anchor_to_open(steps, F.col("open")))
    return out.select(
        "symbol",
        "time",
        v.r(F.element_at("_p", 1)).alias("first_step"),
        v.r(F.element_at("_p", 2)).alias("second_step"),
    )


# ---- quantile forecast -------------------------------------------------------


def sql_examples(name: str, source: str) -> str:
    """Features as changes of the close, not yet in units of ``scale``."""
    ahead = ", ".join(f"lead(close, {h}) OVER w" for h in range(1, 11))
    return f"""{name} AS (
  SELECT screener, symbol, time, close, stddev_pop(close) OVER f AS scale, avg(close) OVER f - close AS revert,
    (close - first_value(close) OVER f) / greatest(count(*) OVER f - 1, 1) AS slope,
    coalesce(close - lag(close) OVER w, 0) AS last, [{ahead}] AS ahead
  FROM {source} WINDOW w AS (PARTITION BY screener, symbol ORDER BY time),
    f AS (PARTITION BY screener, symbol ORDER BY time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
{name}_steps AS (
  SELECT * FROM (SELECT * EXCLUDE (ahead), unnest(ahead) AS actual, unnest(range(1, 11)) AS step FROM {name})
  WHERE actual IS NOT NULL AND scale > 0)"""


def short_rungs(spark, sf):
    bars = candles.candle_ladder(v.ticks(spark, sf), seq="seq").filter(F.col("screener") != "1H")
    return stored(bars, "short-rungs")


_RUNGS = "rungs AS MATERIALIZED (SELECT * FROM ladder WHERE screener <> '1H')"


def _scaled(column: str) -> str:
    return f"round(CASE WHEN scale > 0 THEN {column} / scale ELSE 0e0 END, 6) + 0e0 AS {column}"


@query(
    "y4_quantile_examples",
    W(v.TICKS, v.LADDER, _RUNGS, sql_examples("ex", "rungs"))
    + f"""SELECT screener, symbol, time, {_scaled('revert')}, {_scaled('slope')}, {_scaled('last')},
  round(scale, 6) + 0e0 AS scale, ahead[1] AS next, ahead[10] AS tenth FROM ex""",
)
def y4_examples(spark, sf):
    """What the quantile model learns from: every bar, its features and the bars ahead."""
    out = quantiles.examples(short_rungs(spark, sf)).select(
        "screener", "symbol", "time", "revert", "slope", "last", "scale",
        F.col("ahead")[0].alias("next"), F.col("ahead")[9].alias("tenth"),
    )
    return v.rounded(out, "revert", "slope", "last", "scale")


_FIT_ROUNDS = 6


def _sql_round(k: int) -> str:
    """One round of the fit: weighted sums per rung and step, a system of two unknowns each."""
    sums, solved = [], []
    for i, q in enumerate(forecast.QUANTILES):
        w = f"(1 / ({quantiles.NEAR} + abs(y - (p{i} + r{i} * x))))"
        sums += [f"sum({w}) + {quantiles.RIDGE} * count(*) AS a{i}", f"sum({w} * x) AS b{i}",
                 f"sum({w} * x * x) + {quantiles.RIDGE} * count(*) AS c{i}",
                 f"sum({w} * y) + (2 * {q}e0 - 1) * count(*) AS d{i}",
                 f"sum({w} * x * y) + (2 * {q}e0 - 1) * sum(x) AS e{i}"]
        det = f"(a{i} * c{i} - b{i} * b{i})"
        solved += [f"(d{i} * c{i} - e{i} * b{i}) / {det} AS p{i}", f"(a{i} * e{i} - b{i} * d{i}) / {det} AS r{i}"]
    return (f"m{k} AS MATERIALIZED (SELECT screener, step, {', '.join(solved)} FROM (SELECT screener, step, "
            f"{', '.join(sums)} FROM xy JOIN m{k - 1} USING (screener, step) GROUP BY screener, step))")


def _sql_loss(q: float, forecast_: str) -> str:
    return f"round(avg(greatest((actual - {forecast_}) * {q}e0, (actual - {forecast_}) * ({q}e0 - 1))), 4) + 0e0"


_LEVELS = ", ".join(f"close + scale * (p{i} + r{i} * revert / scale)" for i in range(3))
_LOSSES = ", ".join(
    f"{_sql_loss(q, f'levels[{i + 1}]')} AS pinball_{n}, {_sql_loss(q, 'drift')} AS drift_{n}"
    for i, (q, n) in enumerate(zip(forecast.QUANTILES, (30, 50, 70)))
)


@query(
    "a15_quantile_model",
    W(v.TICKS, v.LADDER, _RUNGS,
      "cut AS (SELECT date_trunc('day', max(time)) AS edge FROM ticks)",
      "early AS (SELECT r.* FROM rungs r, cut WHERE time < edge)",
      sql_examples("ex", "rungs"), sql_examples("fit", "early"),
      "xy AS MATERIALIZED (SELECT screener, step, revert / scale AS x, (actual - close) / scale AS y FROM fit_steps)",
      "m0 AS (SELECT DISTINCT screener, step, " + ", ".join(f"0e0 AS p{i}, 0e0 AS r{i}" for i in range(3)) + " FROM xy)",
      *[_sql_round(k) for k in range(1, _FIT_ROUNDS + 1)],
      f"""scored AS (SELECT screener, actual, close + slope * step AS drift, list_sort([{_LEVELS}]) AS levels
  FROM ex_steps JOIN m{_FIT_ROUNDS} USING (screener, step), cut WHERE time >= edge)""")
    + f"SELECT screener, count(*) AS n, {_LOSSES} FROM scored GROUP BY screener",
)
def a15_model(spark, sf):
    """Pinball loss on the last day of a model fitted on the days before, beside that of
    drift; two features and few rounds, so that SQL can follow."""
    bars = short_rungs(spark, sf)
    cut = F.lit(v.ticks(spark, sf).agg(F.date_trunc("day", F.max("time")).cast("timestamp_ntz")).first()[0])
    two = ("one", "revert")
    models = quantiles.fit(quantiles.examples(bars.filter(F.col("time") < cut)), features=two, rounds=_FIT_ROUNDS)
    later = quantiles.by_step(quantiles.examples(bars).filter(F.col("time") >= cut))
    scored = quantiles.predicted(later, models, two).withColumn(
        "drift", F.col("close") + F.col("slope") * F.col("scale") * F.col("step")
    )
    losses = []
    for i, (q, n) in enumerate(zip(forecast.QUANTILES, (30, 50, 70))):
        for name, made in (("pinball", F.col("forecasts")[i]), ("drift", F.col("drift"))):
            e = F.col("actual") - made
            losses.append(F.avg(F.greatest(e * q, e * (q - 1))).alias(f"{name}_{n}"))
    out = scored.groupBy("screener").agg(F.count(F.lit(1)).alias("n"), *losses)
    return v.rounded(out, *[c for c in out.columns if "_" in c], digits=4)
