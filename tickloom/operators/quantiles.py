"""A quantile forecast fitted by distributed sums.

Per rung, step ahead and quantile it is a linear model of a few features of the last
bars, with the close's change in units of their deviation as its target. The pinball
loss is minimised by majorisation: each round weighs every example by the inverse of its
last error, sums the weighted products in one aggregation with map-side combine, and
solves a small linear system. The driver holds rungs x steps x quantiles systems, whatever
the rows. Sums are of doubles, so reruns agree to rounding.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tickloom.operators import segments as sg
from tickloom.operators.forecast import DECODER_ROWS, QUANTILES, SERIES, minutes_of
from tickloom.operators.serving import latest_n
from tickloom.session import stored

PAST = 20
ROUNDS = 25
#: Errors below this, in units of the deviation, weigh alike.
NEAR = 1e-3
#: Pull of a coefficient towards 0, per example; it only decides where features are dependent.
RIDGE = 1e-9
#: one: constant; revert: way back to the mean; slope: mean change; last: newest change.
FEATURES = ("one", "revert", "slope", "last")
BLOCK = 2048


def _usable(bars: DataFrame) -> DataFrame:
    rows = bars.select(*SERIES, "time", F.col("close").cast("double").alias("close"))
    return rows.filter(F.abs("close") < float("inf"))  # neither null nor NaN nor infinite


def _featured(rows: DataFrame, window, past: int, *more: Column) -> DataFrame:
    frame = window.rowsBetween(1 - past, 0)
    first, n = F.first("close").over(frame), F.count("close").over(frame)
    close, scale = F.col("close"), F.stddev_pop("close").over(frame)
    values = {
        "one": F.lit(1.0),
        "revert": F.avg("close").over(frame) - close,
        "slope": (close - first) / F.greatest(n - 1, F.lit(1)),
        "last": F.coalesce(close - F.lag("close").over(window), F.lit(0.0)),
    }
    rows = rows.select("*", scale.alias("scale"), *[x.alias(name) for name, x in values.items()], *more)
    inside = [F.when(F.col("scale") > 0, F.col(x) / F.col("scale")).otherwise(0.0).alias(x) for x in FEATURES[1:]]
    rest = [c for c in rows.columns if c not in FEATURES[1:]]
    return rows.select(*rest, *inside)


def examples(bars: DataFrame, past: int = PAST, steps: int = DECODER_ROWS) -> DataFrame:
    """Each bar with its features over the last ``past`` bars and ``ahead``, the closes of
    the next ``steps`` (null beyond the end). Bars without a finite close are left out.
    Give it stored bars: their keys are read a second time to number the rows."""
    numbered = sg.number_rows(_usable(bars), SERIES, "time")
    window = sg.segment_window(SERIES, sg.ROW)
    ahead = F.array(*[F.lead("close", h).over(window) for h in range(1, steps + 1)])
    seg = sg.row_segments(numbered, before=past - 1, after=steps, block=max(BLOCK, past, steps))
    return sg.owned(_featured(seg, window, past, ahead.alias("ahead")))


def by_step(rows: DataFrame) -> DataFrame:
    """One row per example and step that has come true; ``target`` is the scaled change."""
    spread = rows.select("*", F.posexplode("ahead").alias("_pos", "actual")).withColumn("step", F.col("_pos") + 1)
    return spread.filter(F.col("actual").isNotNull() & (F.col("scale") > 0)).withColumn(
        "target", (F.col("actual") - F.col("close")) / F.col("scale")
    ).drop("_pos", "ahead")


def _dot(features: Sequence[str], coefficients: Column) -> Column:
    return sum((F.col(x) * coefficients[i] for i, x in enumerate(features)), F.lit(0.0))


def fit(
    rows: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    features: Sequence[str] = FEATURES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Coefficients per rung and step: ``models`` holds an array per quantile, and ``n``
    the examples. ``rows`` are examples; they are stored once and read in every round."""
    spark = rows.sparkSession
    kept = stored(rows.select("screener", "close", "scale", *FEATURES, "ahead"), "examples")
    long = by_step(kept)
    pairs = [(i, j) for i in range(len(features)) for j in range(i + 1)]
    x = [F.col(name) for name in features]
    groups = [(r.screener, r.step) for r in kept.select("screener", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("step")).distinct().collect()]
    models = {group: np.zeros((len(quantiles), len(features))) for group in groups}
    counts: dict[tuple, int] = dict.fromkeys(groups, 0)

    for _ in range(rounds):
        known = _table(spark, models, counts)
        joined = long.join(known.drop("n"), ["screener", "step"])
        sums = [F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(f"x{i}") for i, v in enumerate(x)]]
        for k in range(len(quantiles)):
            weight = 1 / (NEAR + F.abs(F.col("target") - _dot(features, F.col("models")[k])))
            joined = joined.withColumn(f"_w{k}", weight)
            w = F.col(f"_w{k}")
            sums += [F.sum(w * x[i] * x[j]).alias(f"a{k}_{i}_{j}") for i, j in pairs]
            sums += [F.sum(w * x[i] * F.col("target")).alias(f"b{k}_{i}") for i in range(len(x))]
        for row in joined.groupBy("screener", "step").agg(*sums).collect():
            group = (row.screener, row.step)
            counts[group] = row.n
            models[group] = np.array([_solved(row, k, q, len(x), pairs) for k, q in enumerate(quantiles)])
    return _table(spark, models, counts)


def _solved(row: Row, k: int, q: float, size: int, pairs: Iterable[tuple[int, int]]) -> np.ndarray:
    left = np.zeros((size, size))
    for i, j in pairs:
        left[i, j] = left[j, i] = row[f"a{k}_{i}_{j}"]
    right = [row[f"b{k}_{i}"] + (2 * q - 1) * row[f"x{i}"] for i in range(size)]
    return np.linalg.solve(left + RIDGE * row.n * np.eye(size), right)


def _table(spark, models: dict, counts: dict) -> DataFrame:
    rows = [(*group, m.tolist(), counts[group]) for group, m in sorted(models.items())]
    return spark.createDataFrame(rows, "screener string, step int, models array<array<double>>, n bigint")


def predicted(rows: DataFrame, models: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``forecasts``: a close per quantile, in order, for every row and step of the
    model. Without examples a coefficient is 0, so the last close is carried on."""
    levels = F.transform("models", lambda m: F.col("close") + F.col("scale") * _dot(features, m))
    return rows.join(models.drop("n"), [c for c in ("screener", "step") if c in rows.columns]).withColumn(
        "forecasts", F.array_sort(levels)
    ).drop("models")


def quantile_predictions(
    bars: DataFrame, models: DataFrame, features: Sequence[str] = FEATURES, past: int = PAST,
    rungs: dict[str, int] | None = None,
) -> DataFrame:
    """One row per series, as ``forecast.predict`` gives it: ``predictions`` is the path of
    the middle quantile, ``paths`` holds those of all. Only the last ``past`` bars of a
    series are read behind the latest-N step."""
    recent = latest_n(_usable(bars), SERIES, past)
    window = Window.partitionBy(*SERIES).orderBy("time")
    last = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("time").desc()))
    base = _featured(recent, window, past, last.alias("_last")).filter("_last = 1")
    steps = predicted(base, models, features).groupBy(*SERIES, F.col("time").alias("base_time")).agg(
        F.array_sort(F.collect_list(F.struct("step", "forecasts"))).alias("_steps")
    )
    count = F.size(F.col("_steps")[0]["forecasts"])
    paths = F.transform(
        F.sequence(F.lit(0), count - 1), lambda k: F.transform("_steps", lambda s: s["forecasts"][k])
    )
    return steps.withColumn("paths", paths).select(
        *SERIES, "base_time", F.col("paths")[F.floor(F.size("paths") / 2).cast("int")].alias("predictions"),
        "paths", F.lit("quantile").alias("model"), minutes_of("screener", rungs).cast("int").alias("interval"),
    )
