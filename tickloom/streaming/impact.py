"""Price impact after news on a stream, without pairs of records and items.

A record meets the open items of its symbol in state and leaves three kinds of value
there: the first and last price, the extremes and the count. Records themselves are kept
only while the watermark has not passed them, because until then an item before them may
still come; they lie in state as packed arrays, one entry per micro-batch.

The state's key is (symbol, time bucket, salt): a busy symbol is dealt to several tasks
by the salt, a catch-up over long time by the buckets. An item goes to every key it may
meet and leaves a part from each when an event-time timer says that the watermark has
passed; the parts of an item are then joined by a native aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.times import DAY_US, MINUTE_US, chunk_of, micros
from tickloom.operators.candles import arrival_order
from tickloom.session import ship_package

#: Width of a time bucket and number of salts per symbol and bucket.
BUCKET_US = DAY_US
SPREAD = 2
#: Sequence number of a record that has none: it comes first at its time.
NO_SEQ = -(2**63)

ITEM = "id string, event_us bigint, title string, link string"
PART = (
    "copies bigint, first_us bigint, first_seq bigint, first double, last_us bigint, "
    "last_seq bigint, last double, high double, low double, n bigint"
)
_EMPTY = (None, None, None, None, None, None, None, None, 0)
PART_SCHEMA = f"symbol string, closes timestamp, {ITEM}, {PART}"


def _pack(rows: dict[str, np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(v).tobytes() for v in rows.values())


def _unpack(chunk: bytes) -> dict[str, np.ndarray]:
    n = len(chunk) // 40
    whole = np.frombuffer(chunk, "int64", 2 * n), np.frombuffer(chunk, "float64", 3 * n, 16 * n)
    return dict(zip(("us", "seq"), np.split(whole[0], 2))) | dict(
        zip(("close", "high", "low"), np.split(whole[1], 3))
    )


def folded(part: tuple, rows: dict[str, np.ndarray]) -> tuple:
    """A part with further records, which are in (time, sequence) order. NaN is no value."""
    copies, first_us, first_seq, first, last_us, last_seq, last, high, low, n = part
    us, seq, close = rows["us"], rows["seq"], rows["close"]
    head, tail = (int(us[0]), int(seq[0])), (int(us[-1]), int(seq[-1]))
    if n == 0 or head < (first_us, first_seq):
        (first_us, first_seq), first = head, _value(close[0])
    if n == 0 or tail >= (last_us, last_seq):
        (last_us, last_seq), last = tail, _value(close[-1])
    high = _value(np.fmax.reduce(rows["high"], initial=np.nan if high is None else high))
    low = _value(np.fmin.reduce(rows["low"], initial=np.nan if low is None else low))
    return copies, first_us, first_seq, first, last_us, last_seq, last, high, low, n + len(us)


def _value(x: float) -> float | None:
    return None if np.isnan(x) else float(x)


class ImpactState(StatefulProcessor):
    """Open items of one (symbol, bucket, salt) and the records ahead of the watermark."""

    def __init__(self, horizon_us: int, bucket_us: int):
        self.horizon_us, self.bucket_us = horizon_us, bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # All open items change with the records that settle, so they are written together.
        self.items = handle.getListState("items", f"{ITEM}, {PART}")
        self.ahead = handle.getListState("ahead", "chunk binary")

    def close(self) -> None:
        pass

    def _due_ms(self, key, event_us: int) -> int:
        """When no further record of this key can belong to the item."""
        return -(-min(event_us + self.horizon_us, (key[1] + 1) * self.bucket_us) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        mark = timerValues.getCurrentWatermarkInMs()
        rows_of_items = new.loc[new["is_news"], ["id", "us", "title", "link"]]
        arrived = [tuple(x) for x in rows_of_items.itertuples(index=False)]
        prices = new[~new["is_news"]]
        fresh = {c: prices[c].to_numpy("int64") for c in ("us", "seq")}
        fresh |= {c: prices[c].to_numpy("float64") for c in ("close", "high", "low")}
        yield from self._settle(key, mark, arrived, fresh if len(prices) else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, timerValues.getCurrentWatermarkInMs(), [], None)

    def _settle(self, key, mark: int, arrived: list[tuple], fresh: dict | None) -> Iterator[pd.DataFrame]:
        """Folds the records that the watermark has passed into the items, and gives the
        parts of the items that are due. One timer, for what is due next, is enough."""
        chunks = [_unpack(bytes(c[0])) for c in self.ahead.get()] if self.ahead.exists() else []
        settles = any(c["us"].min() <= mark * 1000 for c in chunks)
        parts = ([*chunks, fresh] if settles else [fresh]) if fresh else (chunks if settles else [])
        settled, wake = None, []
        if not settles and chunks:
            wake.append((key[1] + 1) * self.bucket_us // 1000)
        if parts:
            rows = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
            passed = rows["us"] <= mark * 1000
            rest = {c: x[~passed] for c, x in rows.items()}
            if passed.any():
                order = np.lexsort((rows["seq"][passed], rows["us"][passed]))
                settled = {c: x[passed][order] for c, x in rows.items()}
            if settles:
                self.ahead.clear()
            if len(rest["us"]):
                self.ahead.appendValue((_pack(rest),))
                # Further records, items or the end of the bucket settle them.
                wake.append((key[1] + 1) * self.bucket_us // 1000)

        rows_known = [tuple(r) for r in self.items.get()] if self.items.exists() else []
        known = {r[:4]: r[4:] for r in rows_known}
        items = dict(known)
        for place in arrived:
            part = items.get(place, (0, *_EMPTY))
            items[place] = (part[0] + 1, *part[1:])
        done, kept = [], {}
        for place, part in items.items():
            if settled is not None:
                start = np.searchsorted(settled["us"], place[1], "left")
                stop = np.searchsorted(settled["us"], place[1] + self.horizon_us, "right")
                if start < stop:
                    part = folded(part, {c: x[start:stop] for c, x in settled.items()})
            due = self._due_ms(key, place[1])
            if due <= mark:
                if part[-1]:
                    done.append((*place, *part))
                continue
            wake.append(due)
            kept[place] = part
        if kept and kept != known:
            self.items.put([(*place, *part) for place, part in kept.items()])
        elif known and not kept:
            self.items.clear()
        if wake:
            self.handle.registerTimer(max(min(wake), mark + 1))
        if done:
            names = [c.split()[0] for c in f"{ITEM}, {PART}".split(", ")]
            out = pd.DataFrame(done, columns=names)
            closes = (out["event_us"] + self.horizon_us).to_numpy("int64").astype("datetime64[us]")
            yield out.assign(symbol=key[0], closes=closes)[["symbol", "closes", *names]]


def impact_parts(
    news: DataFrame, prices: DataFrame, horizon_us: int = 15 * MINUTE_US, seq: str | None = None,
    bucket_us: int = BUCKET_US, spread: int = SPREAD,
) -> DataFrame:
    """Parts of the items' impact, a row for each state key that has records for an item.
    Both inputs are timed streams; ``closes`` is the row time."""
    ship_package()
    bucket_us = max(bucket_us, horizon_us)
    none = F.lit(None)
    number = F.coalesce(F.col(seq), F.lit(NO_SEQ)) if seq else F.lit(NO_SEQ)
    us = micros("event_time")
    buckets = F.sequence(chunk_of("event_time", bucket_us), chunk_of(F.timestamp_micros(us + horizon_us), bucket_us))
    items = news.select(
        "symbol", F.col("event_time").alias("at"), us.alias("us"), F.lit(NO_SEQ).alias("seq"),
        *[none.cast("double").alias(c) for c in ("close", "high", "low")],
        "id", "title", "link", F.lit(True).alias("is_news"), F.explode(buckets).alias("bucket"),
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    # Records of one instant may lie in any key: a part holds the place of its edges.
    salt = F.pmod(F.xxhash64("symbol", "time", number, "close"), F.lit(spread)).cast("int")
    records = prices.select(
        "symbol", F.col("time").alias("at"), micros("time").alias("us"), number.cast("bigint").alias("seq"),
        *[F.col(c).cast("double").alias(c) for c in ("close", "high", "low")],
        *[none.cast("string").alias(c) for c in ("id", "title", "link")],
        F.lit(False).alias("is_news"), chunk_of("time", bucket_us).alias("bucket"), salt.alias("salt"),
    )
    return (
        items.select(*records.columns)
        .unionByName(records)
        .filter(F.col("symbol").isNotNull())
        .groupBy("symbol", "bucket", "salt")
        .transformWithStateInPandas(
            statefulProcessor=ImpactState(horizon_us, bucket_us),
            outputStructType=PART_SCHEMA,
            outputMode="append",
            timeMode="EventTime",
            eventTimeColumnName="closes",
        )
    )


def joined_parts(parts: DataFrame) -> DataFrame:
    """One row per item, emitted when its parts are complete."""
    spans = parts.withColumns({"_first_at": F.timestamp_micros("first_us"), "_last_at": F.timestamp_micros("last_us")})
    first, last = arrival_order("_first_at", "first_seq"), arrival_order("_last_at", "last_seq")
    spans = spans.withColumns({"_first_at": first, "_last_at": last})
    return spans.groupBy("symbol", "id", "event_us", "title", "link", "closes").agg(
        F.min_by("first", "_first_at").alias("price_before"),
        F.max_by("last", "_last_at").alias("price_after"),
        F.max("high").alias("max_price"),
        F.min("low").alias("min_price"),
        # Every part of an item holds its copies, and each copy meets all records.
        F.sum(F.col("n") * F.col("copies")).alias("n_candles"),
    )
