"""The quantile forecast against numpy, and against drift on bars it has not seen."""

import random
from datetime import datetime as T, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import forecast, quantiles as qm

SCHEMA = "screener string, symbol string, time timestamp_ntz, close double"


@pytest.fixture(scope="module")
def closes():
    rng, out = random.Random(4), {}
    for symbol, level in (("A", 50.0), ("B", 900.0)):
        price, path = level, []
        for _ in range(260):
            price += 0.25 * (level - price) + rng.choice([-1, -1, 3]) * rng.random() * level / 100
            path.append(price)
        out[symbol] = path
    return out


def frame(spark, closes):
    rows = [
        ("5m", s, T(2024, 1, 1) + timedelta(minutes=5 * i), c) for s, path in closes.items() for i, c in enumerate(path)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def brute_examples(path, past, steps):
    out = []
    for i, close in enumerate(path):
        seen = np.array(path[max(0, i - past + 1) : i + 1])
        scale = seen.std()
        values = [seen.mean() - close, (close - seen[0]) / max(len(seen) - 1, 1), close - path[i - 1] if i else 0.0]
        x = [1.0, *[v / scale if scale > 0 else 0.0 for v in values]]
        out.append((x, scale, [path[i + h] if i + h < len(path) else None for h in range(1, steps + 1)]))
    return out


def test_examples_equal_a_row_by_row_form(spark, closes, monkeypatch):
    monkeypatch.setattr(qm, "BLOCK", 32)  # so that frames cross blocks
    got = qm.examples(frame(spark, closes), past=7, steps=3).orderBy("symbol", "time").collect()
    want = [e for s in sorted(closes) for e in brute_examples(closes[s], 7, 3)]
    assert len(got) == len(want)
    for row, (x, scale, ahead) in zip(got, want):
        assert [row[f] for f in qm.FEATURES] == pytest.approx(x, abs=1e-9)
        assert row.scale == pytest.approx(scale, abs=1e-9) and row.ahead == ahead


def pinball(error, q):
    return np.mean(np.maximum(error * q, error * (q - 1)))


def test_fit_minimises_the_pinball_loss(spark, closes):
    models = qm.fit(qm.examples(frame(spark, closes), steps=2), rounds=40).collect()
    data = [(x, scale, c, ahead) for s in closes for (x, scale, ahead), c in zip(brute_examples(closes[s], 20, 2), closes[s])]
    assert [(m.screener, m.step) for m in models] == [("5m", 1), ("5m", 2)]
    rng = np.random.default_rng(0)
    for m in models:
        kept = [(x, (a[m.step - 1] - c) / s) for x, s, c, a in data if s > 0 and a[m.step - 1] is not None]
        x, y = np.array([k[0] for k in kept]), np.array([k[1] for k in kept])
        assert m.n == len(y)
        for q, beta in zip(forecast.QUANTILES, np.array(m.models)):
            weights = np.zeros(4)
            for _ in range(40):
                w = 1 / (qm.NEAR + np.abs(y - x @ weights))
                weights = np.linalg.solve((x.T * w) @ x + qm.RIDGE * len(y) * np.eye(4), x.T @ (w * y) + (2 * q - 1) * x.sum(0))
            assert beta == pytest.approx(weights, abs=1e-6)
            best = pinball(y - x @ beta, q)
            assert abs(np.mean(y <= x @ beta) - q) < 0.03
            for _ in range(50):  # no step to any side gains more than the smoothing
                assert best <= pinball(y - x @ (beta + rng.normal(0, 0.05, 4)), q) + 1e-3


def test_loss_on_unseen_bars_is_below_drift(spark, closes):
    bars = frame(spark, closes)
    cut = F.lit(T(2024, 1, 1) + timedelta(minutes=5 * 200))
    models = qm.fit(qm.examples(bars.filter(F.col("time") < cut)))
    rows = qm.by_step(qm.examples(bars).filter(F.col("time") >= cut))
    scored = qm.predicted(rows, models).withColumn("drift", F.col("close") + F.col("slope") * F.col("scale") * F.col("step"))
    got = scored.select("actual", "forecasts", "drift").toPandas()
    assert len(got) > 900
    for k, q in enumerate(forecast.QUANTILES):
        assert pinball(got["actual"] - got["forecasts"].str[k], q) < 0.9 * pinball(got["actual"] - got["drift"], q)


def test_predictions_follow_the_last_bar(spark, closes):
    bars = frame(spark, closes)
    models = qm.fit(qm.examples(bars), rounds=5)
    got = qm.quantile_predictions(bars, models).orderBy("symbol").collect()
    want = {r.symbol: r for r in qm.examples(bars).withColumn(
        "_n", F.row_number().over(qm.Window.partitionBy("symbol").orderBy(F.col("time").desc()))).filter("_n = 1").collect()}
    by = {r.step: r.models for r in models.collect()}
    for row in got:
        last = want[row.symbol]
        x = np.array([last[f] for f in qm.FEATURES])
        paths = [sorted(last.close + last.scale * (np.array(by[h]) @ x)) for h in range(1, 11)]
        assert row.base_time == last.time and row.interval == 5
        assert np.array(row.paths) == pytest.approx(np.array(paths).T) and row.predictions == row.paths[1]
    steps = forecast.explode_predictions(qm.quantile_predictions(bars, models).drop("paths"))
    assert steps.count() == 20


def test_odd_series(spark):
    at = T(2024, 1, 1)
    rows = [("5m", "flat", at + timedelta(minutes=5 * i), 3.0) for i in range(30)]
    rows += [("5m", "one", at, 7.0), ("5m", "gap", at, None), ("5m", "gap", at + timedelta(minutes=5), float("nan"))]
    bars = spark.createDataFrame(rows, SCHEMA)
    models = qm.fit(qm.examples(bars), rounds=2)
    assert {r.n for r in models.collect()} == {0}
    got = {r.symbol: r.predictions for r in qm.quantile_predictions(bars, models).collect()}
    assert got == {"flat": [3.0] * 10, "one": [7.0] * 10}
    empty = bars.filter("false")
    assert qm.quantile_predictions(empty, qm.fit(qm.examples(empty), rounds=1)).count() == 0
