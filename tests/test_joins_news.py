import random
import re
from datetime import datetime as T, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import joins, news


def prices(spark, rows):
    return spark.createDataFrame(
        [(s, t, c, c, c, q) for q, (s, t, c) in enumerate(rows)],
        "symbol string, time timestamp_ntz, close double, high double, low double, seq bigint",
    )


def items(spark, rows):
    return spark.createDataFrame(
        [(s, i, t, f"t{i}", f"l{i}") for s, i, t in rows],
        "symbol string, id string, event_time timestamp_ntz, title string, link string",
    )


def test_horizon_is_inclusive_and_inner(spark):
    p = prices(
        spark,
        [
            ("A", T(2024, 1, 1, 9, 7), 10.0),
            ("A", T(2024, 1, 1, 9, 15), 12.0),
            ("A", T(2024, 1, 1, 9, 22), 13.0),
            ("A", T(2024, 1, 1, 9, 22, 0, 1), 99.0),
            ("A", T(2024, 1, 1, 9, 6, 59, 999999), 98.0),
            ("B", T(2024, 1, 1, 9, 10), 97.0),
        ],
    )
    n = items(spark, [("A", "1", T(2024, 1, 1, 9, 7)), ("C", "2", T(2024, 1, 1, 9, 7))])
    (row,) = news.news_impact(n, p, seq="seq").collect()
    assert (row.symbol, row.id, row.price_before, row.price_after) == ("A", "1", 10.0, 13.0)
    assert (row.max_price, row.min_price, row.n_candles) == (13.0, 10.0, 3)
    assert row.impact_pct == pytest.approx(30.0)


def test_every_pair_meets_once(spark):
    p = prices(spark, [("A", T(2024, 1, 1, 9, m, s), 1.0) for m in range(60) for s in (0, 30)])
    n = items(spark, [("A", str(m), T(2024, 1, 1, 9, m)) for m in range(45)])
    pairs = joins.within_after(n.select("symbol", "id", "event_time"), p.select("symbol", "time"))
    want = n.alias("n").join(
        p.alias("p"), F.expr("n.symbol = p.symbol AND p.time BETWEEN n.event_time AND n.event_time + INTERVAL 15 MINUTES")
    )
    assert pairs.count() == want.count() == pairs.distinct().count()


def test_impact_is_null_for_a_price_that_is_not_positive(spark):
    p = prices(spark, [("A", T(2024, 1, 1, 9, 0), 0.0), ("A", T(2024, 1, 1, 9, 1), 5.0)])
    (row,) = news.news_impact(items(spark, [("A", "1", T(2024, 1, 1, 9, 0))]), p, seq="seq").collect()
    assert row.impact_pct is None and row.price_after == 5.0


def test_impact_over_equal_times_follows_the_sequence(spark):
    at = T(2024, 1, 1, 9, 1)
    p = prices(spark, [("A", at, 4.0), ("A", at, 6.0)]).repartition(2)
    (row,) = news.news_impact(items(spark, [("A", "1", at)]), p, seq="seq").collect()
    assert (row.price_before, row.price_after) == (4.0, 6.0)


@pytest.mark.parametrize(
    "stored,kept",
    [
        ([], {1, 2, 3, 4}),
        # Stored inside the incoming range: rows between its ends are left out.
        ([T(2024, 1, 2, 9), T(2024, 1, 3, 9)], {1, 4}),
        # The last day is cut at its midnight, so a stored time later that day
        # gives no upper end.
        ([T(2024, 1, 5, 12)], {1, 2, 3, 4}),
        # Exactly the last midnight counts.
        ([T(2024, 1, 2, 9), T(2024, 1, 5)], {1, 4}),
        # Only older rows: no lower bound, nothing is filtered.
        ([T(2023, 1, 1)], {1, 2, 3, 4}),
    ],
)
def test_backfill_gap(spark, stored, kept):
    times = {1: T(2024, 1, 1, 10), 2: T(2024, 1, 2, 9), 3: T(2024, 1, 3, 9), 4: T(2024, 1, 5, 15)}
    incoming = spark.createDataFrame(
        [("A", i, t) for i, t in times.items()], "symbol string, i int, time timestamp_ntz"
    )
    have = spark.createDataFrame([("A", t) for t in stored], "symbol string, time timestamp_ntz")
    # An unrelated symbol must not lend its bounds.
    have = have.unionByName(spark.createDataFrame([("B", T(2024, 1, 1)), ("B", T(2024, 1, 5))], have.schema))
    assert {r.i for r in joins.outside_stored(incoming, have).collect()} == kept


def test_empty_backfill_stays_empty(spark):
    empty = spark.createDataFrame([], "symbol string, time timestamp_ntz")
    assert joins.outside_stored(empty, empty).count() == 0


def test_history_text_gives_one_row_per_entry(spark):
    text = "x - Ngày 02/01/2020: lập ra; - Năm 1999: đổi tên: mới;\n- Năm 20: không;"
    df = spark.createDataFrame([("A", text), ("B", "none")], "symbol string, text string")
    got = [tuple(r) for r in news.extract_entries(df, "text").collect()]
    assert got == [("A", "Ngày 02/01/2020", "lập ra"), ("A", "Năm 1999", "đổi tên: mới")]


@pytest.mark.parametrize("horizon_us", [1, 40_000_000, 60_000_000, 15 * 60_000_000, 90_500_001])
def test_impact_by_minutes_equals_all_pairs(spark, horizon_us):
    rng = random.Random(horizon_us)
    base = T(1969, 12, 31, 23, 50)

    def moment():
        # Whole minutes and the microseconds beside them come up often.
        us = rng.choice([0, 1, -1, 30_000_000, rng.randrange(60_000_000)])
        return base + timedelta(minutes=rng.randrange(30), microseconds=us)

    p = prices(spark, [(rng.choice("AB"), moment(), float(rng.randrange(-2, 50))) for _ in range(400)])
    n = items(spark, [(rng.choice("ABC"), str(i % 50), moment()) for i in range(60)])
    n = n.unionByName(n.limit(3))
    got = news.news_impact(n, p, horizon_us, seq="seq")
    order = F.struct("time", "seq")
    want = (
        joins.within_after(n, p, horizon_us)
        .groupBy("symbol", "id", "event_time", "title", "link")
        .agg(
            F.min_by("close", order), F.max_by("close", order), F.max("high"), F.min("low"), F.count(F.lit(1))
        )
    )
    rows = [tuple(r)[:10] for r in got.collect()]
    assert sorted(rows) == sorted(tuple(r) for r in want.collect())
    assert rows or horizon_us == 1


def test_bounds_and_daily_values_leave_records_where_they_are(spark):
    from tickloom.operators import forecast, research

    p = prices(spark, [("A", T(2024, 1, d, 9), float(d)) for d in range(1, 9)])
    days = p.select("symbol", F.date_trunc("day", "time").cast("timestamp_ntz").alias("day"), F.col("close").alias("v"))
    for df in (
        joins.outside_stored(p, p.filter("seq < 3")),
        research.join_daily(p, days),
        forecast.normalise(p),
    ):
        df.collect()
        assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "pattern",
    [r"(a+)-(b*)", r"(a+?)-(b*?);", r"(a+)(?=-)(.)", r"\b(a+)-(b*)\b", r"(?<=x)(a+)-(b*)", r"(a)?-(b+)?", r"(a+)-(b*)$", r"^(a+)-(b*)"],
)
def test_entries_are_those_of_the_pattern_over_the_whole_text(spark, pattern):
    texts = ["aa-bb;a-;xaa-b", "a-bbb a-", "aa-aab-b;", "", None, "-b--", "xa-b", "a-b\na-bb"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted(tuple(r) for r in news.extract_entries(df, "text", pattern).collect())
    want = [(i, m[1] or "", m[2] or "") for i, t in enumerate(texts) for m in re.finditer(pattern, t or "")]
    assert got == sorted(want) and got
