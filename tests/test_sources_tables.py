from datetime import datetime as T
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars, times
from tickloom import schemas
from tickloom.operators import candles
from tickloom.schemas import TABLES
from tickloom.session import streaming_session
from tickloom.sources import records, tables


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_bad_records_and_tombstones_are_left_out(spark):
    good = '{"screener":"1m","symbol":"A","open":1,"high":1,"low":1,"close":1,"volume":5,"time":"2024-01-01 09:00:00"}'
    df = raw(spark, good, None, "{broken", '{"symbol":"A"}', good.replace("2024-01-01 09:00:00", "soon"))
    (row,) = records.ohlc_records(df).collect()
    assert (row.symbol, row.time, row.volume) == ("A", T(2024, 1, 1, 9), 5.0)


def test_news_without_a_readable_date_is_left_out(spark):
    one = '{"symbol":"A","id":"1","news_title":"t","public_date":"%s"}'
    df = raw(spark, one % "2024-01-01 09:00:00", one % "yesterday", '{"symbol":"A","id":"2"}')
    assert [r.event_time for r in records.news_records(df).collect()] == [T(2024, 1, 1, 9)]


@pytest.mark.parametrize(
    "text,want",
    [
        (None, None),
        ("2024-01-01T09:00:00", T(2024, 1, 1, 9)),
        ("2024-01-01T09:00:00+07:00", T(2024, 1, 1, 2)),
        ("1704067200", T(2024, 1, 1)),
        ("1704067200500", T(2024, 1, 1, 0, 0, 0, 500000)),
        ("never", None),
    ],
)
def test_flexible_time(spark, text, want):
    assert raw(spark, text).select(times.flexible_time("value").alias("t")).first().t == want


@pytest.mark.parametrize(
    "at,state",
    [
        (T(2024, 1, 1, 9), "open"),
        (T(2024, 1, 1, 8, 59, 59), "closed"),
        (T(2024, 1, 1, 11, 30), "open"),
        (T(2024, 1, 1, 11, 30, 0, 1), "closed"),
        (T(2024, 1, 1, 13), "open"),
        (T(2024, 1, 1, 14, 30, 1), "closed"),
        (T(2024, 1, 6, 10), "closed"),
    ],
)
def test_session_state(spark, at, state):
    df = spark.createDataFrame([(at,)], "time timestamp_ntz")
    assert df.select(times.session_state("time").alias("s")).first().s == state


def test_sides_and_zones(spark):
    df = spark.createDataFrame(
        [("BUY", 70.0), ("HOLD", 30.0), (None, 50.0), ("SELL", None)], "side string, rsi14 double"
    )
    got = df.select(scalars.side_label().alias("s"), scalars.rsi_zone().alias("z")).collect()
    assert [r.s for r in got] == ["🟢 MUA", "HOLD", None, "🔴 BÁN"]
    assert [r.z for r in got] == ["overbought", "oversold", "neutral", None]


def test_nested_messages(spark):
    book = (
        '{"handle_time":"2024-01-01 09:00:00","symbol":"A","Room_foreign":7,'
        '"Buy":{"Buy_1":1.5,"Buy_1_volume":10},"Sell":{"Sell_3":2.5}}'
    )
    from tickloom.operators.serving import flatten_book

    row = flatten_book(records.order_book_records(raw(spark, book))).first()
    assert (row.buy_1, row.buy_1_volume, row.sell_3, row.sell_1, row.room_foreign) == (1.5, 10, 2.5, None, 7.0)
    assert set(TABLES["trading_data"].columns) <= set(row.asDict())

    facts = '{"A":{"Loai_cty":["x","y"],"Tong_co_phieu":5,"Von_dieu_le":50},"B":{"Tong_co_phieu":6}}'
    got = {r.symbol: (r.shares, r.charter_capital) for r in records.fundamentals(raw(spark, facts)).collect()}
    assert got == {"A": (5, 50), "B": (6, None)}


def test_predictions_explode(spark):
    from tickloom.operators.forecast import explode_predictions

    message = (
        '{"symbol":"A","base_time":"2024-01-01T09:00:00","created_at":"2024-01-01T09:01:00",'
        '"model":"m","interval":5,"predictions":[1,2,3]}'
    )
    got = explode_predictions(records.prediction_records(raw(spark, message))).orderBy("time_step").collect()
    assert [(r.screener, r.time_step, r.close_predict) for r in got] == [
        ("5m", T(2024, 1, 1, 9, 5), 1.0), ("5m", T(2024, 1, 1, 9, 10), 2.0), ("5m", T(2024, 1, 1, 9, 15), 3.0),
    ]


def candle(spark, *rows):
    return spark.createDataFrame(
        [(s, y, t, c, c, c, c, 1.0) for s, y, t, c in rows],
        "screener string, symbol string, time timestamp_ntz, open double, high double, "
        "low double, close double, volume double",
    )


def test_last_write_wins_and_a_retried_batch_leaves_no_trace(spark, tmp_path):
    table, root, at = TABLES["ohlvc"], str(tmp_path), T(2024, 1, 1)
    tables.write_batch(candle(spark, ("1m", "A", at, 1.0), ("1m", "B", at, 2.0)), root, table, 0)
    tables.write_batch(candle(spark, ("1m", "A", at, 8.0), ("1m", "Z", at, 8.0)), root, table, 1)
    tables.write_batch(candle(spark, ("1m", "A", at, 9.0)), root, table, 1)
    got = sorted((r.symbol, r.close) for r in tables.read_table(spark, root, table).collect())
    assert got == [("A", 9.0), ("B", 2.0)]
    tables.compact(spark, root, table, f"{root}/packed")
    packed = tables.read_table(spark, f"{root}/packed", table)
    assert sorted((r.symbol, r.close) for r in packed.collect()) == got


def test_order_decides_inside_a_batch(spark, tmp_path):
    at = T(2024, 1, 1)
    df = candle(spark, ("1m", "A", at, 1.0), ("1m", "A", at, 2.0)).withColumn("seq", F.col("close"))
    tables.write_batch(df, str(tmp_path), TABLES["ohlvc"], 0, order=["seq"])
    assert [r.close for r in tables.read_table(spark, str(tmp_path), TABLES["ohlvc"]).collect()] == [2.0]


def test_key_scan_is_pushed_down(spark, tmp_path):
    table, root = TABLES["ohlvc"], str(tmp_path)
    rows = [("1m", "A", T(2024, 1, 1, 0, i), float(i)) for i in range(5)] + [("5m", "B", T(2024, 1, 1), 9.0)]
    tables.write_batch(candle(spark, *rows), root, table, 0)
    out = tables.read_key(spark, root, table, screener="5m", symbol="B")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(screener" in plan and "EqualTo(symbol,B)" in plan
    assert [r.close for r in out.collect()] == [9.0]


@pytest.mark.parametrize("symbols", [50, 900, 5000])
def test_files_read_for_a_symbol_do_not_grow_with_the_symbols(spark, tmp_path, symbols):
    table, root, packed = TABLES["ohlvc"], str(tmp_path / "a"), str(tmp_path / "b")
    names = spark.range(symbols).select(F.concat(F.lit("S"), F.col("id")).alias("symbol"))
    rows = names.crossJoin(candle(spark, *[("1m", "", T(2024, m, 1), 1.0) for m in (1, 2)]).drop("symbol"))
    tables.write_batch(rows, root, table, 0)
    tables.write_batch(rows.filter("symbol = 'S7'").withColumn("close", F.lit(2.0)), root, table, 1)
    tables.compact(spark, root, table, packed)
    groups = {p.parent.parent.name for p in Path(packed).rglob("*.parquet")}
    assert len(groups) == tables.group_count(symbols) or symbols > 1024 and len(groups) > 200
    held = {g: len(list(Path(packed).rglob(f"{g}/*/*.parquet"))) for g in groups}
    assert max(held.values()) <= 3  # two spans of time
    got = tables.read_key(spark, packed, table, symbol="S7")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "symbol_group" in plan.split("PartitionFilters")[1].split("]")[0]
    assert sorted((r.symbol, r.time.month, r.close) for r in got.collect()) == [("S7", 1, 2.0), ("S7", 2, 2.0)]
    assert tables.read_table(spark, packed, table).count() == 2 * symbols
    assert tables.read_table(spark, packed, table).columns == tables.read_table(spark, root, table).columns


def test_folders_of_different_group_counts_lie_side_by_side(spark, tmp_path):
    table, root, at = TABLES["ohlvc"], str(tmp_path), T(2024, 1, 1)
    for batch, symbols in enumerate((1, 100, 5000, 1)):
        rows = candle(spark, ("1m", "A", at, float(batch)), ("1m", f"B{batch}", at, 1.0), ("5m", None, at, 1.0))
        tables.write_batch(rows, root, table, batch, symbols=symbols)
    assert [r.close for r in tables.read_key(spark, root, table, symbol="A").collect()] == [3.0]
    assert tables.read_key(spark, root, table, symbol="B1", screener="1m").count() == 1
    assert tables.read_table(spark, root, table).count() == 6


@pytest.mark.parametrize(("symbols", "count"), [(0, 1), (64, 1), (65, 16), (1024, 16), (1025, 256), (1 << 30, 65536)])
def test_group_count(symbols, count):
    assert tables.group_count(symbols) == count


def test_history_is_normalised(spark, tmp_path):
    path = str(tmp_path / "h.csv")
    spark.createDataFrame(
        [("A", "2024-01-01 09:00:00", 1, 2, 3, 4, 5)],
        "symbol string, Datetime string, Open int, High int, Low int, Close int, Volume int",
    ).write.csv(path, header=True)
    row = records.read_history(spark, path, "csv", header=True).first()
    assert tuple(row) == ("A", T(2024, 1, 1, 9), 1.0, 2.0, 3.0, 4.0, 5.0)


def test_message_log_options():
    opts = records.kafka_options("host:1", records.TOPICS["ohlc"], maxOffsetsPerTrigger="10")
    assert opts["startingOffsets"] == "earliest" and opts["subscribe"] == "ohvcl_data"


@pytest.mark.parametrize("name", sorted(TABLES))
def test_every_table_is_written_and_read_by_key(spark, tmp_path, name):
    table = TABLES[name]
    times_ = {"time", "time_step", "signal_time", "news_time", "handle_time", "public_date", "created_at"}
    kinds = {c: "timestamp_ntz" for c in times_} | {
        c: "string" for c in ("screener", "symbol", "id", "signal_type", "side", "detail", "title", "link", "s_content", "label", "model")
    }
    columns = [*table.keys, *table.columns]

    def row(version):
        out = []
        for c in columns:
            kind = kinds.get(c, "double")
            fixed = {"timestamp_ntz": T(2024, 1, 1), "string": "x"}.get(kind, float(version))
            out.append(f"v{version}" if kind == "string" and c not in table.keys else fixed)
        return tuple(out)

    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in columns)
    for version in (1, 2):
        df = spark.createDataFrame([row(version)], schema)
        tables.write_batch(df, str(tmp_path), table, version)
    (got,) = tables.read_table(spark, str(tmp_path), table).select(*columns).collect()
    assert tuple(got) == row(2)


def test_two_writers_share_a_table(spark, tmp_path):
    from datetime import datetime

    table, root, at = TABLES["ohlvc"], str(tmp_path), datetime(2024, 1, 1)
    tables.write_batch(candle(spark, ("1m", "A", at, 1.0)), root, table, 0, writer="stream-a")
    tables.bulk_write(candle(spark, ("1m", "B", at, 2.0)), root, table)
    tables.write_batch(candle(spark, ("1m", "A", at, 3.0)), root, table, 0, writer="stream-b")
    assert {(r.symbol, r.close) for r in tables.read_table(spark, root, table).collect()} == {("A", 3.0), ("B", 2.0)}
    assert tables.read_key(spark, root, table, symbol="A", close=1.0).count() == 0
    assert tables.read_key(spark, root, table, close=3.0).count() == 1


def test_changes_of_rows(spark):
    """Insert, update, unchanged (NaN and null included), delete, delete of nothing."""
    nan = float("nan")
    schema = "k string, a double, b string"
    before = spark.createDataFrame(
        [("same", nan, None), ("moved", 1.0, "x"), ("gone", 2.0, "y"), ("dead", None, None), ("back", None, None)], schema
    )
    rows = spark.createDataFrame(
        [("same", nan, None), ("moved", None, "x"), ("gone", None, None), ("dead", None, None), ("back", 3.0, None),
         ("new", 4.0, "z"), ("never", None, None), (None, 5.0, "n")],
        schema,
    )
    got = sorted(map(tuple, tables.changes_of(rows, before, ["k"]).collect()), key=str)
    assert got == sorted(
        [("-U", "moved", 1.0, "x"), ("+U", "moved", None, "x"), ("-D", "gone", 2.0, "y"), ("+I", "back", 3.0, None),
         ("+I", "new", 4.0, "z"), ("+I", None, 5.0, "n")],
        key=str,
    )
    assert tables.changes_of(rows.limit(0), before, ["k"]).count() == 0
    assert tables.changes_of(rows, before.limit(0), ["k"]).filter("op <> '+I'").count() == 0


def folders(root, name="ohlvc"):
    return sorted(str(p.parent.relative_to(f"{root}/{name}")) for p in Path(root, name).glob("*/*/_SUCCESS"))


def test_packed_batches_hold_the_newest_rows_and_stay_few(spark, tmp_path):
    table, root = TABLES["ohlvc"], str(tmp_path)
    want, most = {}, 0
    for batch in range(40):
        at = T(2024, 1, 1, 0, batch % 7)
        rows = [("1m", "A", at, float(batch)), ("1m", f"S{batch}", at, -1.0)]
        want |= {(s, t): c for _, s, t, c in rows}
        tables.write_batch(candle(spark, *rows), root, table, batch, writer="job")
        tables.pack_batches(spark, root, table, batch, "job", fan=3)
        if batch % 9 == 0 or batch == 39:
            got = tables.read_table(spark, root, table).collect()
            assert {(r.symbol, r.time): r.close for r in got} == want and len(got) == len(want)
        most = max(most, len(folders(root)))
    # At most two packs' worth of parts on each of the levels 0 to 3.
    assert most <= 2 * 3 * 4 and "writer=job~3/batch_id=26" in folders(root)
    assert "writer=job/batch_id=0" not in folders(root)


def test_a_pack_that_was_cut_off_is_written_again(spark, tmp_path):
    table, root = TABLES["ohlvc"], str(tmp_path)
    for batch in range(3):
        tables.write_batch(candle(spark, ("1m", "A", T(2024, 1, 1), float(batch))), root, table, batch, writer="job")
    tables.pack_batches(spark, root, table, 3, "job", fan=3)
    pack = Path(root, "ohlvc/writer=job~1/batch_id=2")
    (pack / "_SUCCESS").unlink()
    for _ in range(2):  # and a complete one is left as it is
        tables.pack_batches(spark, root, table, 3, "job", fan=3)
        assert (pack / "_SUCCESS").exists()
    assert [r.close for r in spark.read.parquet(str(pack)).collect()] == [2.0]
    assert [r.close for r in tables.read_table(spark, root, table).collect()] == [2.0]
    assert len(folders(root)) == 4  # parts stay until the next pack


def test_packs_of_one_writer_leave_others_alone(spark, tmp_path):
    table, root, at = TABLES["ohlvc"], str(tmp_path), T(2024, 1, 1)
    tables.write_batch(candle(spark, ("1m", "A", at, 1.0)), root, table, 0, writer="job")
    tables.write_batch(candle(spark, ("1m", "A", at, 2.0), ("1m", "B", at, 2.0)), root, table, 0, writer="other")
    tables.write_batch(candle(spark, ("1m", "C", at, 3.0)), root, table, 1, writer="job")
    for batch in (2, 4):  # nothing to pack for 3: parts may be missing
        tables.pack_batches(spark, root, table, batch, "job", fan=2)
    got = sorted((r.symbol, r.close) for r in tables.read_table(spark, root, table).collect())
    assert got == [("A", 2.0), ("B", 2.0), ("C", 3.0)]
    assert "writer=other/batch_id=0" in folders(root)


@pytest.mark.parametrize("sink", [tables.upsert_query, tables.changelog_query])
def test_a_stream_into_a_packed_table(spark, tmp_path, sink):
    table, root, source = TABLES["ohlvc"], str(tmp_path / "t"), str(tmp_path / "in")
    rows = [("1m", f"S{i % 3}", T(2024, 1, 1, 0, i % 2), float(i)) for i in range(9)]
    for i, row in enumerate(rows):
        candle(spark, row).coalesce(1).write.mode("append").parquet(source)
    schema = candle(spark, *rows).schema
    stream = records.table_stream(streaming_session(spark), source, schema, files_per_batch=1)
    query = sink(stream, root, "ohlvc", str(tmp_path / "cp"), pack=2)
    query.trigger(availableNow=True).start().awaitTermination()
    want = {(s, t): c for _, s, t, c in rows}
    got = tables.read_table(spark, root, table).collect()
    assert {(r.symbol, r.time): r.close for r in got} == want and len(got) == len(want)
    assert len(folders(root)) < 14
    if sink is tables.changelog_query:
        changes = tables.read_changes(spark, root, table)
        ops = {r.op: r["count"] for r in changes.groupBy("op").count().collect()}
        assert ops == {"+I": 6, "-U": 3, "+U": 3}
        folded = tables.fold_changes(changes, table.keys).collect()
        assert {(r.symbol, r.time): r.close for r in folded} == want


LOG = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
KEYS = ("screener", "symbol", "time")


def logged(spark, *messages):
    """(partition, offset, symbol, minute, close); without a close, a tombstone."""
    rows = []
    for partition, offset, symbol, minute, close in messages:
        key = f'{{"screener":"1m","symbol":"{symbol}","time":"2024-01-01 00:{minute:02}:00"}}'
        value = None if close is None else f'{key[:-1]},"open":{close},"high":{close},"low":{close},"close":{close},"volume":1}}'
        rows.append((key.encode(), value and value.encode(), "t", partition, offset, None, 0))
    return spark.createDataFrame(rows, LOG)


def test_log_positions_and_tombstone_keys_survive(spark):
    raw = logged(spark, (0, 1, "A", 0, 1.0), (0, 2, "A", 0, None), (0, 3, "A", 0, 2.0), (1, 1, "B", 0, 5.0), (1, 9, "B", 0, None))
    bad = spark.createDataFrame(
        [(b"{", b"{", "t", 0, 4, None, 0), (b"{", None, "t", 0, 5, None, 0), (None, None, "t", 0, 6, None, 0)], LOG
    )
    log = records.keyed_log(raw.union(bad), schemas.OHLC_RECORD, KEYS)
    got = sorted((r.topic_partition, r.offset, r.symbol, r.deleted, r.close) for r in log.collect())
    assert got == [
        (0, 1, "A", False, 1.0), (0, 2, "A", True, None), (0, 3, "A", False, 2.0),
        (1, 1, "B", False, 5.0), (1, 9, "B", True, None),
    ]
    left = tables.current_of_log(log, KEYS)
    assert [(r.symbol, r.close, r.seq) for r in left.collect()] == [("A", 2.0, 3 << 16)]


def test_offsets_order_the_records_of_a_bar(spark):
    raw = logged(spark, (2, 7, "A", 0, 3.0), (2, 5, "A", 0, 9.0), (1, 5, "A", 0, 4.0), (0, 6, "A", 0, 5.0))
    log = records.keyed_log(raw, schemas.OHLC_RECORD, KEYS).withColumn("time", times.event_time("time"))
    bar = candles.rollup(log, times.MINUTE_US, seq="seq").first()
    assert (bar.open, bar.close, bar.high, bar.volume) == (4.0, 3.0, 9.0, 4.0)


@pytest.mark.parametrize(("partition", "offset"), [(1 << 16, 0), (0, 1 << 47), (-1, 0), (0, -1)])
def test_a_position_out_of_range_is_refused(spark, partition, offset):
    log = records.keyed_log(logged(spark, (partition, offset, "A", 0, 1.0)), schemas.OHLC_RECORD, KEYS)
    with pytest.raises(Exception, match="out of range"):
        log.collect()


def test_only_wanted_fields_are_parsed(spark):
    message = '{"symbol":"A","handle_time":"2024-01-01T00:00:00","ceiling":1.5,"Buy":{"Buy_1":2.5,"Buy_2":9.0}}'
    rows = records.order_book_records(raw(spark, message), ["Buy.Buy_1", "ceiling"])
    assert rows.columns == ["handle_time", "symbol", "ceiling", "Buy"] and rows.schema["Buy"].dataType.names == ["Buy_1"]
    assert [(r.symbol, r.ceiling, r.Buy.Buy_1) for r in rows.collect()] == [("A", 1.5, 2.5)]
    with pytest.raises(ValueError, match="unknown fields"):
        records.order_book_records(raw(spark, message), ["none"])
