"""Plans keep a busy symbol out of a single task, and results stay whole."""

import re
from datetime import datetime as T, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import forecast, indicators, serving, signals
from tickloom.operators import segments as sg


def windows(df):
    """(partition columns, order columns) of every window in the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    found = []
    for line in plan.splitlines():
        if re.search(r"[+:\- ]Window \[", line):
            lists = re.findall(r"\[([^\[\]]*)\]", line)
            part, order = lists[-2:]
            found.append(({c.split("#")[0].strip() for c in part.split(",")}, order))
    return found


@pytest.mark.parametrize(
    "build",
    [
        indicators.indicator_table,
        indicators.range_indicators,
        indicators.recursive_indicators,
        indicators.row_sma,
        indicators.price_change,
        indicators.look_ahead,
        forecast.with_time_idx,
        signals.signal_table,
    ],
)
def test_windows_run_inside_segments_or_over_chunk_summaries(bars, build):
    found = windows(build(bars({"A": [(0, 1.0)]})))
    assert found
    for part, order in found:
        assert part & {sg.SEGMENT, sg.CHUNK} or order.startswith(sg.CHUNK), (part, order)


def test_one_symbol_spreads_over_tasks(spark):
    start = T(2024, 1, 1)
    df = spark.createDataFrame(
        [("1m", "HOT", start + timedelta(minutes=i), float(i % 97)) for i in range(9000)],
        "screener string, symbol string, time timestamp_ntz, close double",
    )
    seg = sg.row_segments(sg.number_rows(df, ["symbol"], "time"), before=299)
    sizes = [r["count"] for r in seg.groupBy("symbol", sg.SEGMENT).count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2048 + 299
    assert seg.filter(sg.OWN).count() == 9000
    by_time = sg.time_segments(df, "time", 20 * 60 * 10**6)
    sizes = [r["count"] for r in by_time.groupBy("symbol", sg.SEGMENT).count().collect()]
    assert max(sizes) <= 340 and by_time.filter(sg.OWN).count() == 9000


def test_latest_n_of_one_big_key(spark):
    start = T(2024, 1, 1)
    df = spark.range(20000, numPartitions=8).select(
        F.lit("HOT").alias("symbol"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("time"),
        "id",
    )
    got = serving.latest_n(df, ["symbol"], 500).agg(F.count("id"), F.min("id")).first()
    assert tuple(got) == (500, 19500)


def test_equal_rows_are_not_merged(spark):
    at = T(2024, 1, 1)
    df = spark.createDataFrame([("A", at, 1.0)] * 6 + [("A", at, 2.0)], "symbol string, time timestamp_ntz, x double")
    assert serving.latest_n(df, ["symbol"], 5).count() == 5
    assert forecast.with_time_idx(df).count() == 7
