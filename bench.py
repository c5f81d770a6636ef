"""Times the headline queries; prints one JSON line.

``queries`` holds the warm seconds (second run) and ``cold`` the first run; a stream
runs once, and its seconds hold its start.
Results go to the no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import time

from tickloom.plans import registry
from tickloom.session import build_session

HEADLINE = (
    "a1_ohlcv_bar", "a2_ladder", "a4_right_closed_bar", "a5_daily_bar", "a6_news_impact",
    "a8_nominal_volume", "a10_volatility_summary", "a14_forecast_error",
    "w1_w4_minute_frame", "w5_sma20_rows", "w7_w10_indicator_table", "w11_price_change",
    "w17_atr", "w18_time_idx", "m1_trend_up_minutes", "m3_volume_spike", "u2_union_signals",
    "j1_interval_join", "j2_daily_join", "j6_backfill_gap", "k1_latest_candles", "k6_top_market_cap",
    "y4_inference", "y5_forecast_frame", "s1_ohlc_source", "s6_order_book_source",
    "f12_extract_entries",
)
STREAMS = ("x1_watermark", "x3_ladder_over_stored_bars", "x5_rolling_range", "x8_news_impact")

# The table a query reads, where it is not events.
READS = {"s6_order_book_source": "lineitem", "f12_extract_entries": "documents"}


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tickloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in {"events", *READS.values()}}
    events = sizes["events"]

    cold, warm = {}, {}
    for name in only or HEADLINE + STREAMS:
        query = registry.QUERIES[name]
        cold[name] = seconds(query, spark, sf_dir)
        warm[name] = cold[name] if name in STREAMS else seconds(query, spark, sf_dir)
    rates = {n: round(sizes[READS.get(n, "events")] / warm[n]) for n in warm if warm[n] > 0}
    print(
        json.dumps(
            {
                "metric": "headline queries, total warm seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "events": events,
                "rows_per_sec": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
