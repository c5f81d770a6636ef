"""Streams over several micro-batches equal the batch result on closed windows."""

import os
import random
import time
from datetime import datetime as T, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.times import MINUTE_US
from tickloom.operators import candles, indicators, signals
from tickloom.schemas import TABLES
from tickloom.session import streaming_session
from tickloom.sources import records, tables
from tickloom.streaming import flows, handover, idle, impact, state

SCHEMA = (
    "symbol string, time timestamp_ntz, open double, high double, low double, close double, "
    "volume double, seq bigint"
)


def rows_of(n=900, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        p = round(rng.uniform(10, 90), 2)
        at = T(2024, 1, 1) + timedelta(seconds=11 * i)
        rows.append((f"S{i % 2}", at, p, p, p, p, float(rng.randint(1, 300) if i % 50 else 9000), i))
    return rows


@pytest.fixture
def feed(spark, tmp_path):
    """Writes batches as files in order and opens them one per micro-batch."""
    folder = tmp_path / "in"

    def open_(batches):
        for batch in batches:
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        s = streaming_session(spark)
        schema = spark.createDataFrame([], SCHEMA).schema

        def source():
            raw = records.table_stream(s, str(folder), schema, files_per_batch=1)
            return flows.timed(raw, "time", flows.PRICE_DELAY)

        return source

    return open_


def drain(spark, tmp_path, df, name):
    out = str(tmp_path / name)
    tables.append_query(df, out, f"{out}-cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def chunks(rows, n=4):
    size = -(-len(rows) // n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def closed(bars, rows):
    mark = max(r[1] for r in rows) - timedelta(seconds=10)
    return bars.filter(F.col("time") + F.expr("INTERVAL '0.001' SECOND") <= F.lit(mark))


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def minute(spark, rows):
    df = candles.rollup(spark.createDataFrame(rows, SCHEMA), MINUTE_US, seq="seq")
    return closed(df, rows).withColumn("screener", F.lit("1m"))


def test_minute_bars_over_batches(spark, tmp_path, feed):
    rows = rows_of()
    source = feed(chunks(rows))
    got = drain(spark, tmp_path, flows.settle(flows.minute_bars(source(), "seq")), "bars")
    same(got, minute(spark, rows))


def test_late_records_do_not_reopen_a_window(spark, tmp_path, feed):
    rows = rows_of(200)
    late = ("S0", T(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1e6, 10_000)
    source = feed([rows[:100], rows[100:150], [late], rows[150:]])
    got = drain(spark, tmp_path, flows.settle(flows.minute_bars(source(), "seq")), "bars")
    same(got, minute(spark, rows))


def test_all_rungs_cascade_in_one_scan(spark, tmp_path, feed):
    """Over several batches; S2 trades for four minutes only, so timers close its bars."""
    rows = rows_of(900)
    rows += [("S2", r[1], *r[2:]) for r in rows[:20]]
    rows.sort(key=lambda r: r[1])
    source = feed(chunks(rows, 3))
    ladder = flows.candle_ladder(source(), seq="seq")
    assert ladder._jdf.queryExecution().logical().toString().count("StreamingRelation") == 1
    got = drain(spark, tmp_path, ladder, "ladder")
    want = closed(candles.candle_ladder(spark.createDataFrame(rows, SCHEMA), "seq"), rows)
    same(got, want)
    assert got.filter("symbol = 'S2'").select("screener").distinct().count() == 5


def test_bars_leave_state_with_their_ttl(spark, tmp_path, feed):
    """A job by the clock: what comes after the ttl starts anew. (With a ttl the job runs a
    batch per trigger even without data, so it does not end by itself.)"""
    rows = rows_of(400)
    out = str(tmp_path / "out")
    states = flows.settle(state.bar_states(flows.minute_bars(feed([rows[:200]])(), "seq"), ttl_ms=3000))
    query = tables.append_query(states, out, f"{out}-cp").trigger(processingTime="1 second").start()

    def wait_for(least: int) -> pd.DataFrame:
        end = time.monotonic() + 60
        while time.monotonic() < end:
            time.sleep(2)
            found = spark.read.schema(states.schema).parquet(out).toPandas() if os.path.isdir(f"{out}/_spark_metadata") else ()
            if len(found) >= least:
                return found
        raise AssertionError("no output")

    try:
        wait_for(50)
        time.sleep(6)
        feed([rows[200:]])
        got = wait_for(110).sort_values("time")
    finally:
        query.stop()
    # Each symbol starts anew twice: at first, and when its bars had left state.
    assert (got.groupby("symbol")["ret"].apply(lambda x: int(x.isna().sum())) == 2).all()


class Kept:
    """A list or value of state, in memory."""

    def __init__(self):
        self.value, self.written = None, 0

    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def put(self, value):
        self.value, self.written = value, self.written + len(value)

    def update(self, value):
        self.value = value

    def appendList(self, value):
        self.value, self.written = (self.value or []) + value, self.written + len(value)


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_state_stays_bounded_and_exact(batch):
    """The processor over a list in memory: at most twice the bars it needs, one entry
    written per bar on average or less than three, results as in one go."""
    rng = np.random.default_rng(3)
    n = 1000
    close = np.where(rng.random(n) < 0.05, np.nan, np.round(rng.uniform(10, 90, n), 2))
    at = np.datetime64("2024-01-01T00:01") + np.arange(n) * np.timedelta64(60, "s") - np.timedelta64(1, "us")
    frame = pd.DataFrame({"symbol": "A", "rt": at, **{c: close for c in candles.OHLCV[:4]}, "volume": 5.0})

    def run(size):
        processor = state.BarState(history=60)
        processor.bars, processor.runs = Kept(), Kept()
        parts = []
        for begin in range(0, n, size):
            parts += processor.handleInputRows(("A",), iter([frame[begin : begin + size]]), None)
            assert size > 100 or len(processor.bars.value) <= 2 * 80 + size
        return pd.concat(parts), processor.bars.written

    got, written = run(batch)
    want, _ = run(n)
    assert written < 3 * n
    for c in ("sma20", "ema12", "rsi14", "vwap", "ret", "up", "down"):
        assert np.allclose(got[c].to_numpy(float), want[c].to_numpy(float), equal_nan=True)


def test_stateful_indicators_and_signals_equal_batch(spark, tmp_path, feed):
    rows = rows_of(900)
    source = feed(chunks(rows, 3))
    want = minute(spark, rows)

    got = drain(spark, tmp_path, flows.settle(state.indicators(flows.minute_bars(source(), "seq"))), "ind")
    table = indicators.indicator_table(want)
    names = [c for c in table.columns if c not in ("screener", "symbol", "time")]
    rounded = [F.round(c, 7).alias(c) for c in names]
    same(got.select("symbol", "time", *rounded), table.select("symbol", "time", *rounded))

    sig = drain(
        spark, tmp_path, flows.settle(state.signals(flows.minute_bars(source(), "seq")), time="signal_time"), "sig"
    )
    same(sig, signals.signal_table(want))
    assert {r.signal_type for r in sig.collect()} == {"TREND_3UP", "TREND_3DOWN", "VOLUME_SPIKE"}


def test_updates_merge_by_key(spark, tmp_path, feed):
    rows = rows_of(300)
    source = feed(chunks(rows, 3))
    bars = (
        source().groupBy("symbol", F.window("time", "30 minutes").alias("window"))
        .agg(*flows.bar_columns(F.col("time")))
        .select(F.lit("30m").alias("screener"), "symbol", F.window_time("window").alias("rt"), *candles.OHLCV)
    )
    root = str(tmp_path / "t")
    query = tables.upsert_query(flows.settle(bars), root, "ohlvc", f"{root}-cp", output_mode="update")
    query.trigger(availableNow=True).start().awaitTermination()
    want = candles.candle_ladder(spark.createDataFrame(rows, SCHEMA), "seq").filter("screener = '30m'")
    same(tables.read_table(spark, root, TABLES["ohlvc"]).select(*want.columns), want)


def test_news_impact_over_batches_equals_batch_and_drops_its_state(spark, tmp_path, feed):
    from tickloom.operators.news import news_impact

    rows = rows_of(1200)
    source = feed(chunks(rows, 4))
    is_news = F.col("seq") % 40 == 7

    def items(df, time):
        return df.filter(is_news).select(
            "symbol", F.col("seq").cast("string").alias("id"), F.col(time).alias("event_time"),
            F.lit("t").alias("title"), F.lit("l").alias("link"),
        )

    news = items(source(), "time")  # keeps the watermark of the record time
    out = str(tmp_path / "impact")
    query = (
        tables.append_query(flows.news_impact(news, source().filter(~is_news), seq="seq"), out, f"{out}-cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # No join; what state holds are open items and packed records ahead of the watermark.
    held = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert {op["operatorName"] for op in held} == {"transformWithStateInPandasExec", "stateStoreSave"}
    assert max(op["numRowsTotal"] for op in held) < len(rows) / 2

    batch = spark.createDataFrame(rows, SCHEMA)
    want = news_impact(items(batch, "time"), batch.filter(~is_news), seq="seq")
    got = spark.read.parquet(out)
    last = max(r[1] for r in rows if r[7] % 40 == 7) - timedelta(minutes=16)
    done = want.filter(F.col("news_time") <= F.lit(last))
    assert done.count() >= 20
    assert done.join(got, ["symbol", "id", "news_time", "price_before", "price_after", "n_candles"], "left_anti").count() == 0
    assert got.join(want, got.columns, "left_anti").count() == 0


def test_impact_parts_fold_in_any_cut():
    """Folding records piece by piece gives the same part as all at once; NaN is no value."""
    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 50, 40)) * 1000
    rows = {"us": us, "seq": np.arange(40)} | {c: rng.uniform(1, 9, 40) for c in ("close", "high", "low")}
    rows["high"][:25] = np.nan
    assert all((impact._unpack(impact._pack(rows))[c] == x)[~np.isnan(x.astype(float))].all() for c, x in rows.items())
    whole = impact.folded((1, *impact._EMPTY), rows)
    part = (1, *impact._EMPTY)
    for start, stop in ((0, 1), (1, 24), (24, 40)):
        part = impact.folded(part, {c: x[start:stop] for c, x in rows.items()})
    assert part == whole
    assert whole[3] == rows["close"][0] and whole[6] == rows["close"][-1] and whole[-1] == 40
    assert whole[7] == np.nanmax(rows["high"]) and whole[8] == rows["low"].min()


def test_longer_rungs_over_stored_bars(spark, tmp_path, feed):
    rows = rows_of(600)
    source = feed(chunks(rows, 2))
    bars = flows.settle(flows.minute_bars(source(), "seq"))
    stored = drain(spark, tmp_path, bars, "bars")
    s = streaming_session(spark)
    again = flows.timed(
        records.table_stream(s, str(tmp_path / "bars"), bars.schema), "time", flows.CANDLE_DELAY
    )
    got = drain(spark, tmp_path, flows.stored_ladder(again), "rungs")
    mark = stored.agg(F.max("time")).first()[0] - timedelta(seconds=5)
    want = candles.ladder(stored).filter("screener <> '1m'")
    same(got, want.filter(F.col("time") + F.expr("INTERVAL '0.001' SECOND") <= F.lit(mark)))


def test_bar_state_equals_a_row_by_row_fold_and_stays_small():
    """Null closes, several batches, a long and a short frame."""
    rng = random.Random(3)
    start = T(2024, 1, 1)
    bars_ = [
        (start + timedelta(minutes=i), None if rng.random() < 0.2 else rng.uniform(10, 20), rng.uniform(1, 5))
        for i in range(900)
    ]

    for frame in (20, 600):
        processor = state.BarState(frame * MINUTE_US)
        processor.bars, processor.runs = Kept(), Kept()
        out = []
        for i in (0, 1, 7, 400):
            j = {0: 1, 1: 7, 7: 400, 400: 900}[i]
            part = pd.DataFrame(bars_[i:j], columns=["rt", "close", "volume"]).assign(open=1.0, high=1.0, low=1.0)
            part["close"] = part["close"].astype(float)
            out.append(pd.concat(processor.handleInputRows(("A",), iter([part[::-1]]), None)))
        got = pd.concat(out).reset_index(drop=True)
        history, up, last = [], 0, None
        for i, (rt, close, _) in enumerate(bars_):
            inside = [b for b in bars_[: i + 1] if b[0] >= rt - timedelta(minutes=frame)]
            priced = [c for _, c, _ in inside if c is not None]
            if priced:
                assert got.sma20[i] == pytest.approx(np.mean(priced))
                assert got.bb_upper[i] == pytest.approx(np.mean(priced) + 2 * np.std(priced))
            assert got.avg_volume[i] == pytest.approx(np.mean([v for *_, v in inside]))
            up = up + 1 if close is not None and last is not None and close > last else 1
            assert got.up[i] == up
            last = close
            if close is None:
                assert np.isnan(got.ema12[i]) and np.isnan(got.rsi14[i])
                continue
            history = (history + [close])[-300:]
            mean = history[0]
            for c in history[1:]:
                mean = c * 2 / 13 + mean * 11 / 13
            assert got.ema12[i] == pytest.approx(mean)
            if len(history) > 14:
                steps = np.diff(history)
                means = []
                for side in (np.maximum(steps, 0), np.maximum(-steps, 0)):
                    m = side[:14].mean()
                    for x in side[14:]:
                        m = (m * 13 + x) / 14
                    means.append(m)
                assert got.rsi14[i] == pytest.approx(100 - 100 / (1 + means[0] / means[1]))
            else:
                assert np.isnan(got.rsi14[i])
        kept = processor.bars.value
        in_frame = [b for b in bars_ if b[0] >= bars_[-1][0] - timedelta(minutes=frame)]
        older = [b for b in bars_ if b[1] is not None][-300:]
        needed = len({b[0] for b in in_frame + older})
        assert len(in_frame) == frame + 1 and needed <= len(kept) <= 2 * needed
        assert [c for _, c, _ in kept if not np.isnan(c)][-300:] == [c for _, c, _ in older]

    # Without any close only the frame is kept.
    processor = state.BarState()
    processor.bars, processor.runs = Kept(), Kept()
    part = pd.DataFrame({"rt": [b[0] for b in bars_], "close": np.nan, "volume": 1.0}).assign(open=1.0, high=1.0, low=1.0)
    list(processor.handleInputRows(("A",), iter([part]), None))
    assert len(processor.bars.value) == 21


def test_beats_move_the_watermark_and_leave_no_row(spark, tmp_path, feed):
    rows = rows_of(300)
    feed(chunks(rows, 2))
    s, schema = streaming_session(spark), spark.createDataFrame([], SCHEMA).schema

    def raw():
        return records.table_stream(s, str(tmp_path / "in"), schema, files_per_batch=1)

    silent, beats = raw().filter("symbol = 'none'"), raw().select("time")
    both = flows.timed(raw(), "time", flows.PRICE_DELAY).unionByName(
        flows.timed_with_beats(silent, "time", flows.NEWS_DELAY, beats)
    )
    got = drain(spark, tmp_path, flows.settle(flows.minute_bars(both, "seq")), "bars")
    same(got, minute(spark, rows))


def test_a_source_that_sends_nothing_is_passed_by_the_clock(spark, tmp_path):
    rows = rows_of(300)
    s, schema = streaming_session(spark), spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "silent").mkdir()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "busy"))
    raw = {name: records.table_stream(s, str(tmp_path / name), schema) for name in ("busy", "silent")}
    delays = {"busy": flows.PRICE_DELAY, "silent": flows.NEWS_DELAY}
    timed = flows.timed_with_idle(raw, dict.fromkeys(raw, "time"), delays)
    bars = flows.settle(flows.minute_bars(timed["busy"].unionByName(timed["silent"]), "seq"))
    out, began = str(tmp_path / "out"), time.time()
    job = tables.append_query(bars, out, f"{out}-cp").trigger(processingTime="1 second").start()
    want = closed(minute(spark, rows), rows)

    def written():
        return spark.read.schema(bars.schema).parquet(out) if os.path.isdir(out) else None

    try:
        count = want.count()
        while time.time() - began < 90 and job.isActive and (written() is None or written().count() < count):
            time.sleep(1)
        assert job.isActive, job.exception()
        assert time.time() - began >= flows.IDLE_MS / 1000
    finally:
        job.stop()
    same(written(), minute(spark, rows))


@pytest.mark.parametrize(
    ("seen", "want"),
    [
        ({"a": (50, 9_000), "b": (None, 0)}, {"b": 50}),  # never seen
        ({"a": (50, 9_000), "b": (60, 0)}, {}),  # idle, but ahead
        ({"a": (50, 0), "b": (60, 0)}, {"a": 60}),  # all idle: the quickest
        ({"a": (None, 0), "b": (None, 0)}, {}),  # nothing known
        ({"a": (None, 9_000), "b": (60, 0)}, {}),  # a has yet time to come
        ({"a": (50, 9_000), "b": (60, 9_000)}, {}),  # none idle
    ],
)
def test_marks_of_idle_sources(seen, want):
    class Kept(dict):
        def updateValue(self, key, value):
            self[key[0]] = value

    processor = idle.IdleState(("a", "b"), 10_000)
    processor.seen = Kept(seen)
    got = [dict(zip(p[idle.SOURCE], p[idle.MARK])) for p in processor._passed(dict(seen), 10_000)]
    assert got == ([want] if want else [])
    assert {s: m for s, (m, _) in processor.seen.items()} == {s: want.get(s, m) for s, (m, _) in seen.items()}


def test_live_job_keeps_the_ladder_of_touched_hours(spark, tmp_path, feed):
    from tickloom.streaming import live

    rows = rows_of(900)
    source = feed(chunks(rows, 3))
    root = str(tmp_path / "live")
    query = live.price_tables_query(source(), root, f"{root}-cp", "seq")
    query.trigger(availableNow=True).start().awaitTermination()
    bars_ = minute(spark, rows)
    same(tables.read_table(spark, root, TABLES["ohlvc"]), candles.ladder(bars_))
    same(tables.read_table(spark, root, TABLES["signals"]), signals.signal_table(bars_))
    assert tables.read_table(spark, root, TABLES["indicators"]).count() == bars_.count()


def test_stateful_jobs_take_the_configured_partitions_up_to_two_per_local_core(spark):
    cores = spark.sparkContext.defaultParallelism
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = int(streaming_session(spark).conf.get("spark.sql.shuffle.partitions"))
    assert got == min(asked, 2 * cores)


def test_jobs_go_on_with_other_partition_counts(spark, tmp_path):
    """Three jobs of 4, 7 and 2 partitions share one input, cut inside windows, with a
    symbol that only the first sees trade; together they give what one job gives."""
    rows = rows_of(600)
    gone = [("GONE", T(2024, 1, 1, 0, m), 5.0, 5.0, 5.0, 5.0, 1.0, 9000 + m) for m in range(4)]
    late = ("S0", T(2024, 1, 1, 0, 0, 30), 1.0, 1.0, 1.0, 1.0, 1.0, 9999)  # its window is closed
    parts = [rows[:203] + gone, [*rows[203:411], late], rows[411:]]
    schema = spark.createDataFrame([], SCHEMA).schema
    got, old = {"ladder": [], "states": []}, {}
    for i, (part, partitions) in enumerate(zip(parts, (4, 7, 2))):
        folder = str(tmp_path / "in")
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        s = streaming_session(spark)
        s.conf.set("spark.sql.shuffle.partitions", str(partitions))
        for name in got:
            source, initial = records.table_stream(s, folder, schema), None
            if old.get(name):
                source = old[name].still_open(source)
                initial = (handover.open_bars if name == "ladder" else handover.bar_history)(s, old[name])
            prices = flows.timed(source, "time", flows.PRICE_DELAY)
            if name == "ladder":
                out = flows.candle_ladder(prices, seq="seq", initial=initial)
            else:
                out = flows.settle(state.bar_states(flows.minute_bars(prices, "seq"), initial=initial))
            got[name] += drain(s, tmp_path, out, f"{name}-{i}").collect()
            old[name] = handover.handover(s, str(tmp_path / f"{name}-{i}-cp"))
    whole = spark.createDataFrame(rows + gone, SCHEMA)
    whole.coalesce(1).write.parquet(str(tmp_path / "whole"))
    one = flows.timed(records.table_stream(streaming_session(spark), str(tmp_path / "whole"), schema), "time", flows.PRICE_DELAY)
    want = drain(spark, tmp_path, flows.candle_ladder(one, seq="seq"), "one-ladder").collect()
    key = lambda r: (r.screener, r.symbol, r.time)
    assert sorted(map(tuple, got["ladder"])) == sorted(map(tuple, want)) and len(set(map(key, want))) == len(want)
    want = drain(spark, tmp_path, flows.settle(state.bar_states(flows.minute_bars(one, "seq"))), "one-states").toPandas()
    states = pd.DataFrame(got["states"], columns=want.columns)
    order = ["symbol", "time"]
    pd.testing.assert_frame_equal(
        states.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True),
        check_dtype=False, rtol=1e-9,
    )
    assert "GONE" in set(want["symbol"])


def test_a_job_cut_off_inside_a_batch_is_not_handed_over(spark, tmp_path, feed):
    source = feed([rows_of(100)])
    drain(spark, tmp_path, flows.settle(state.bar_states(flows.minute_bars(source(), "seq"))), "out")
    checkpoint = str(tmp_path / "out-cp")
    at = handover.handover(spark, checkpoint)
    assert at.mark_ms == int((T(2024, 1, 1) + timedelta(seconds=11 * 99 - 10)).timestamp() * 1000) and at.batch_id > 0
    (tmp_path / "out-cp" / "commits" / str(at.batch_id)).unlink()
    with pytest.raises(ValueError, match="not committed"):
        handover.handover(spark, checkpoint)


def test_a_job_that_has_seen_nothing_hands_over_all_records(spark):
    rows = spark.createDataFrame(rows_of(5), SCHEMA)
    assert handover.Handover("none", 0, 0).still_open(rows).count() == 5
    mark = int(T(2024, 1, 1, 0, 0, 30).timestamp() * 1000)
    assert handover.Handover("none", 0, mark).still_open(rows).count() == 5
    assert handover.Handover("none", 0, mark + 60_000).still_open(rows).count() == 0
