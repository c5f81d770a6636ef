"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scalars as sc, times
from tickloom.operators import indicators, news, signals
from tickloom.plans import views as v
from tickloom.plans.ranking import PREDICTIONS, predictions
from tickloom.plans.registry import query
from tickloom.sources import records

W = v.with_


@query(
    "f1_spike_detail",
    W(v.TICKS, v.BARS_1H, v.sql_range("bars_1h"))
    + f"SELECT symbol, time, {v.SPIKE_DETAIL} AS detail FROM ind",
)
def f1(spark, sf):
    bars = indicators.range_indicators(v.hour_bars(spark, sf), v.FRAME_US)
    return bars.select(
        "symbol", "time", signals.spike_detail(F.col("volume"), F.col("avg_volume")).alias("detail")
    )


MIXED = "CASE WHEN event_type = 'error' THEN 'soon: ' || CAST(ts AS VARCHAR) ELSE CAST(ts AS VARCHAR) END"


def mixed_text(spark, sf):
    e = v.table(spark, sf, "events")
    text = F.col("ts").cast("string")
    bad = F.concat(F.lit("soon: "), text)
    return e.select("event_id", "ts", F.when(F.col("event_type") == "error", bad).otherwise(text).alias("text"))


@query(
    "f2_try_cast",
    f"SELECT event_id, TRY_CAST({MIXED} AS TIMESTAMP) AS event_time FROM events",
)
def f2(spark, sf):
    return mixed_text(spark, sf).select("event_id", times.event_time("text").alias("event_time"))


@query("f3_milliseconds", "SELECT event_id, date_trunc('millisecond', ts) AS time FROM events")
def f3(spark, sf):
    return v.table(spark, sf, "events").select("event_id", times.to_ms("ts").alias("time"))


@query(
    "f4_interval_between",
    """SELECT event_id, ts + INTERVAL 15 MINUTE AS until,
  ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-05 00:00:00' + INTERVAL 10 DAY AS inside
FROM events""",
)
def f4(spark, sf):
    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return v.table(spark, sf, "events").select(
        "event_id",
        (F.col("ts") + F.expr("INTERVAL 15 MINUTES")).alias("until"),
        F.col("ts").between(start, start + F.expr("INTERVAL 10 DAYS")).alias("inside"),
    )


@query(
    "f5_iso_time",
    "SELECT event_id, date_trunc('second', ts) - INTERVAL 7 HOUR AS utc_time FROM events",
)
def f5(spark, sf):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    return v.table(spark, sf, "events").select("event_id", times.iso_time(iso).alias("utc_time"))


@query(
    "f6_flexible_time",
    """SELECT event_id, CASE event_type WHEN 'view' THEN NULL
  WHEN 'click' THEN date_trunc('millisecond', ts) WHEN 'signup' THEN date_trunc('second', ts)
  ELSE ts END AS time FROM events""",
)
def f6(spark, sf):
    us = times.micros("ts")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", None)
        .when(kind == "click", F.floor(us / 1000).cast("long").cast("string"))
        .when(kind == "signup", F.floor(us / 1_000_000).cast("long").cast("string"))
        .otherwise(F.col("ts").cast("string"))
    )
    return v.table(spark, sf, "events").select("event_id", times.flexible_time(text).alias("time"))


@query("f7_day", "SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events")
def f7(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    )


@query("f8_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events")
def f8(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text")
    )


@query(
    "f9_round",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    f"{v.sql_half_up('l_extendedprice / 7')} AS price FROM lineitem",
)
def f9(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") / 7, 2).alias("price")
    )


@query(
    "f10_math",
    """SELECT event_id, round(ln(value), 6) + 0e0 AS log_value, round(sqrt(value), 6) + 0e0 AS root,
  CAST(sign(value - 50) AS DOUBLE) AS side, greatest(value, 50e0) AS upper, least(value, 50e0) AS lower
FROM events""",
)
def f10(spark, sf):
    x = F.col("value")
    return v.table(spark, sf, "events").select(
        "event_id",
        v.r(F.log(x)).alias("log_value"),
        v.r(F.sqrt(x)).alias("root"),
        F.signum(x - 50).alias("side"),
        F.greatest(x, F.lit(50.0)).alias("upper"),
        F.least(x, F.lit(50.0)).alias("lower"),
    )


@query(
    "f11_arrays",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(len(embedding) AS BIGINT) AS n,
  round(list_reduce(list_concat([0e0], list_transform(list_filter(embedding[2:6], lambda x: x > 0),
        lambda x: CAST(x AS DOUBLE))), lambda acc, x: acc + x), 6) + 0e0 AS positive_sum
FROM embeddings""",
)
def f11(spark, sf):
    e = F.transform("embedding", lambda x: x.cast("double"))
    positive = F.filter(F.slice(e, 2, 5), lambda x: x > 0)
    total = F.aggregate(positive, F.lit(0.0), lambda acc, x: acc + x)
    return v.table(spark, sf, "embeddings").select(
        "vec_id",
        F.element_at(e, 1).alias("first_value"),
        F.size(e).cast("long").alias("n"),
        v.r(total).alias("positive_sum"),
    )


# A two-group pattern that occurs in the given texts: a capitalised word and the
# rest of its sentence.
SENTENCE = r"([A-Z][a-z]+) ([a-z ]+)\."
LINK = r'<a href="([^"]*)">([^<]*)</a>'


def _entries(table: str, key: str, text: str, pattern: str) -> str:
    return f"""SELECT {key}, CAST(r.date AS VARCHAR) AS date, CAST(r.detail AS VARCHAR) AS detail FROM (
  SELECT {key}, unnest(list_transform(regexp_extract_all({text}, '{pattern}'),
    lambda m: regexp_extract(m, '{pattern}', ['date', 'detail']))) AS r FROM {table})"""


@query("f12_extract_entries", _entries("documents", "doc_id", "text", SENTENCE))
def f12(spark, sf):
    docs = v.table(spark, sf, "documents").select("doc_id", "text")
    return news.extract_entries(docs, "text", SENTENCE)


@query("f12_extract_links", _entries("pages", "page_id", "html", LINK))
def f12_links(spark, sf):
    pages = v.table(spark, sf, "pages").select("page_id", "html")
    return news.extract_entries(pages, "html", LINK)


@query(
    "f12_history_text",
    """SELECT event_id, 'Ngày ' || strftime(ts, '%d/%m/%Y') AS date,
  event_type || ' ' || CAST(user_id AS VARCHAR) AS detail FROM events
UNION ALL SELECT event_id, 'Năm ' || strftime(ts, '%Y') AS date, 'x' AS detail FROM events""",
)
def f12_history(spark, sf):
    text = F.format_string(
        "- Ngày %s: %s %d; note - Năm %s: x; - Năm: none;",
        F.date_format("ts", "dd/MM/yyyy"), "event_type", "user_id", F.date_format("ts", "yyyy"),
    )
    rows = v.table(spark, sf, "events").select("event_id", text.alias("text"))
    return news.extract_entries(rows, "text")


@query("f13_prediction_explode", W(v.TICKS, v.BARS_1H, PREDICTIONS) + "SELECT * FROM predictions")
def f13(spark, sf):
    return predictions(spark, sf)


@query("f14_json", W(v.TICKS) + "SELECT symbol, time, close, volume, seq FROM ticks")
def f14(spark, sf):
    t = v.ticks(spark, sf).select("symbol", F.col("time").cast("string").alias("time"), "close", "volume", "seq")
    back = records.decode(
        records.encode(t),
        records.T.StructType.fromDDL("symbol string, time string, close double, volume double, seq bigint"),
        ["symbol"],
    )
    return back.withColumn("time", times.event_time("time"))


@query(
    "f15_safe_number",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'error' THEN NULL
  ELSE value END AS number FROM events""",
)
def f15(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "view", None).when(kind == "error", "n/a").otherwise(F.col("value").cast("string"))
    return v.table(spark, sf, "events").select("event_id", text.alias("text")).select(
        "event_id", sc.number_or_null("text").alias("number")
    )


@query(
    "f16_text",
    W(v.TICKS) + "SELECT seq, '/news/' || lower(symbol) AS link, symbol || '.VN' AS ticker FROM ticks",
)
def f16(spark, sf):
    return v.ticks(spark, sf).select(
        "seq",
        F.concat(F.lit("/news/"), F.lower("symbol")).alias("link"),
        sc.quote_ticker("symbol").alias("ticker"),
    )


@query(
    "f17_weekday",
    """SELECT event_id, CAST(isodow(ts) - 1 AS BIGINT) AS weekday, isodow(ts) <= 5 AS trading_day
FROM events""",
)
def f17(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", times.weekday("ts").alias("weekday"), times.is_trading_day("ts").alias("trading_day")
    )
