"""Per-symbol state for what streams have no window for: rolling frames,
recursive indicators and run patterns.

State is small and bounded: the bars of one frame or the last ``HISTORY`` of them, at
most twice that, per symbol. Bars are appended to it, so a bar costs one entry however
long the history. It is checkpointed, so a restart goes on where it stopped. Input is the
minute-bar stream, at most one row per symbol and minute whatever the record rate; a
first run over a year of minutes gives a task some 30 MB per symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.times import MINUTE_US
from tickloom.operators.candles import OHLCV
from tickloom.operators.signals import triggered
from tickloom.session import ship_package

HISTORY = 300
FAST, SLOW, PERIOD = 12, 26, 14
#: Values gathered at a time while frames are summed.
_AT_ONCE = 1 << 20

BAR_SCHEMA = "time bigint, close double, volume double"
INDICATORS = (
    "sma20", "ema12", "ema26", "macd", "rsi14", "bb_mid", "bb_upper", "bb_lower", "vwap", "ret",
)
COLUMNS = ("symbol", "rt", *OHLCV, "up", "down", "avg_volume", *INDICATORS)
OUTPUT_SCHEMA = (
    "symbol string, rt timestamp, "
    + "".join(f"{c} double, " for c in OHLCV)
    + "up bigint, down bigint, avg_volume double, "
    + ", ".join(f"{c} double" for c in INDICATORS)
)


def _ema_weights(n: int, span: int) -> np.ndarray:
    """Weight of each of ``n`` values, oldest first, in their exponential mean."""
    alpha = 2.0 / (span + 1.0)
    weights = (1.0 - alpha) ** np.arange(n - 1, -1, -1.0)
    weights[1:] *= alpha
    return weights


def _wilder_weights(n: int, period: int) -> np.ndarray:
    """Weight of each of ``n`` changes, oldest first, in their Wilder mean."""
    keep = 1.0 - 1.0 / period
    ages = np.minimum(np.arange(n - 1, -1, -1.0), n - period)
    return keep**ages / period


def _sliding(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sum of every run of ``len(weights)`` values."""
    if len(values) < len(weights):
        return np.empty(0)
    return np.convolve(values, weights[::-1], "valid")


def moving_ema(history: np.ndarray, known: int, span: int, reach: int) -> np.ndarray:
    """Exponential mean at each value from ``known`` on, over at most ``reach``
    values. A series of one value has that value as its mean, so a young series is
    filled up in front with its oldest."""
    if len(history) == known:
        return np.empty(0)
    young = max(0, reach - 1 - known)
    seen = history[max(0, known - reach + 1) :]
    return _sliding(np.concatenate([np.full(young, history[0]), seen]), _ema_weights(reach, span))


def _rsi(up: np.ndarray, down: np.ndarray) -> np.ndarray:
    return np.where(down == 0, 100.0, 100.0 - 100.0 / (1.0 + up / np.where(down == 0, 1.0, down)))


def moving_rsi(history: np.ndarray, known: int, period: int, reach: int) -> np.ndarray:
    """Wilder RSI at each value from ``known`` on; NaN while too few are known."""
    steps = np.diff(history)
    up, down = np.maximum(steps, 0.0), np.maximum(-steps, 0.0)
    out = np.full(len(history) - known, np.nan)
    # The seed of a young series moves with its length: one weighting per length.
    for i in range(max(known, period), min(len(history), reach - 1)):
        weights = _wilder_weights(i, period)
        out[i - known] = _rsi(up[:i] @ weights, down[:i] @ weights)
    first = max(known, reach - 1)
    if first < len(history):
        weights = _wilder_weights(reach - 1, period)
        begin = first - reach + 1
        out[first - known :] = _rsi(_sliding(up[begin:], weights), _sliding(down[begin:], weights))
    return out


def framed(closes: np.ndarray, volumes: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """Mean and deviation of the closes, VWAP and mean volume of every frame
    ``[start, stop)``. NaN is no value."""
    lengths = stops - starts
    ends = np.cumsum(lengths)
    cuts = np.searchsorted(ends, np.arange(_AT_ONCE, ends[-1] + _AT_ONCE, _AT_ONCE), "left") + 1
    parts, begin = [], 0
    for end in np.unique(np.minimum(cuts, len(lengths))):
        size = lengths[begin:end]
        edges = np.cumsum(size) - size
        at = np.repeat(starts[begin:end] - edges, size) + np.arange(size.sum())
        close, volume = closes[at], volumes[at]
        priced, sized = ~np.isnan(close), ~np.isnan(volume)

        def total(values, where):
            return np.add.reduceat(np.where(where, values, 0.0), edges)

        n = total(1.0, priced)
        mean = total(close, priced) / n
        dev = np.sqrt(total((close - np.repeat(mean, size)) ** 2, priced) / n)
        traded = total(volume, sized)
        value = total(close * volume, priced & sized)
        vwap = np.where(traded > 0, value / traded, np.nan)
        parts.append((mean, dev, vwap, traded / total(1.0, sized)))
        begin = end
    return [np.concatenate(p) for p in zip(*parts)]


def run_places(goes_on: np.ndarray, before: int) -> np.ndarray:
    """1-based place of each bar in its run; ``before`` bars of it came earlier."""
    at = np.arange(len(goes_on))
    start = np.maximum.accumulate(np.where(goes_on, -1, at))
    return np.where(start >= 0, at - start + 1, before + at + 1)


class BarState(StatefulProcessor):
    """All columns a minute bar gets from the bars before it: rolling frame,
    recursive indicators, places in the rising and the falling run."""

    def __init__(self, frame_us: int = 20 * MINUTE_US, history: int = HISTORY, ttl_ms: int | None = None):
        self.frame_us, self.reach, self.ttl_ms = frame_us, history, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars = handle.getListState("bars", BAR_SCHEMA, self.ttl_ms)
        self.runs = handle.getValueState("runs", "up bigint, down bigint", self.ttl_ms)

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for row in initialState.itertuples():
            times = np.asarray(row.times, "int64").tolist()
            values = [np.asarray(x, float).tolist() for x in (row.closes, row.volumes)]
            self.bars.put(list(zip(times, *values, strict=True)))
            self.runs.update((int(row.up), int(row.down)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("rt")
        old = np.array([tuple(r) for r in self.bars.get()] if self.bars.exists() else [], object).reshape(-1, 3)
        up, down = self.runs.get() if self.runs.exists() else (0, 0)
        n = len(old)
        times = np.concatenate([old[:, 0].astype("int64"), new["rt"].to_numpy("datetime64[us]").astype("int64")])
        closes = np.concatenate([old[:, 1].astype(float), new["close"].to_numpy(float)])
        volumes = np.concatenate([old[:, 2].astype(float), new["volume"].to_numpy(float)])
        close = closes[n:]
        priced = ~np.isnan(closes)
        history = closes[priced]

        starts = np.searchsorted(times, times[n:] - self.frame_us, "left")
        with np.errstate(divide="ignore", invalid="ignore"):
            columns = self._columns(closes, volumes, starts, history, n)
        previous = np.concatenate([closes[n - 1 : n] if n else [np.nan], close[:-1]])
        columns["up"] = run_places(close > previous, up)
        columns["down"] = run_places(close < previous, down)
        yield new.assign(symbol=key[0], **columns)[list(COLUMNS)]

        # Needed are the frame and as many closes as the indicators see. Bars are appended;
        # the list is written anew only when more than half of it is of no more use.
        needed = times >= times[-1] - self.frame_us
        needed[np.flatnonzero(~np.isnan(closes))[-self.reach :]] = True
        anew = 2 * needed.sum() < len(times)
        chosen = np.flatnonzero(needed) if anew else slice(n, None)
        kept = list(zip(*[x[chosen].tolist() for x in (times, closes, volumes)], strict=True))
        if anew:
            self.bars.put(kept)
        else:
            self.bars.appendList(kept)
        self.runs.update((int(columns["up"][-1]), int(columns["down"][-1])))

    def _columns(self, closes, volumes, starts, history, n) -> dict[str, np.ndarray]:
        stops = np.arange(n, len(closes)) + 1
        mean, dev, vwap, avg_volume = framed(closes, volumes, starts, stops)
        priced = ~np.isnan(closes[n:])
        known = len(history) - int(priced.sum())

        def placed(values: np.ndarray) -> np.ndarray:
            out = np.full(len(priced), np.nan)
            out[priced] = values
            return out

        fast = placed(moving_ema(history, known, FAST, self.reach))
        slow = placed(moving_ema(history, known, SLOW, self.reach))
        before = np.concatenate([[np.nan], history])[known : len(history)]
        return {
            "sma20": mean, "bb_mid": mean, "bb_upper": mean + 2 * dev, "bb_lower": mean - 2 * dev,
            "vwap": vwap, "avg_volume": avg_volume, "ema12": fast, "ema26": slow, "macd": fast - slow,
            "rsi14": placed(moving_rsi(history, known, PERIOD, self.reach)),
            "ret": placed(history[known:] - before),
        }


class LadderState(StatefulProcessor):
    """All rungs of one symbol from its minute bars. State holds the bars that the
    watermark has not passed, one entry each, so what is written does not grow with the
    history; an event-time timer closes a bar that gets no further minute."""

    def __init__(self, minutes: tuple[int, ...]):
        self.minutes = minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        bar = ", ".join(f"{c} double" for c in OHLCV)
        self.open = handle.getMapState("open", "minutes bigint, start bigint", bar)

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for row in initialState.itertuples():
            self._keep((int(row.minutes), int(row.start)), [getattr(row, c) for c in OHLCV])
            self.handle.registerTimer((int(row.start) + int(row.minutes) * MINUTE_US) // 1000)

    def _keep(self, place: tuple[int, int], bar) -> None:
        self.open.updateValue(place, tuple(None if pd.isna(x) else float(x) for x in bar))

    def _rows(self, key, bars: list[tuple]) -> pd.DataFrame:
        """``bars``: minutes, start and values. A row time is the end less 1 us."""
        out = pd.DataFrame(bars, columns=["minutes", "start", *OHLCV])
        ends = (out["start"] + out["minutes"] * MINUTE_US - 1).to_numpy("int64").astype("datetime64[us]")
        return out.assign(symbol=key[0], rt=ends)[["minutes", "symbol", "rt", *OHLCV]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("rt")
        mark = timerValues.getCurrentWatermarkInMs()
        at = new["rt"].to_numpy("datetime64[us]").astype("int64")
        kept = dict(self.open.iterator())
        for minutes in self.minutes:
            width = minutes * MINUTE_US
            bars = new.groupby(at // width * width).agg(
                open=("open", lambda x: x.iloc[0]),
                high=("high", "max"),
                low=("low", "min"),
                close=("close", lambda x: x.iloc[-1]),
                volume=("volume", lambda x: x.sum(min_count=1)),
            )
            closed = []
            for start, *bar in bars.itertuples():
                place = (minutes, start)
                if place in kept:
                    bar = _joined(kept[place], bar)
                if start + width <= mark * 1000:
                    closed.append((minutes, start, *bar))
                    if place in kept:
                        self.open.removeKey(place)
                else:
                    self._keep(place, bar)
                    if place not in kept:
                        self.handle.registerTimer((start + width) // 1000)
            if closed:
                yield self._rows(key, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = expiredTimerInfo.getExpiryTimeInMs() * 1000
        closed = [
            (*place, *[np.nan if x is None else x for x in bar])
            for place, bar in self.open.iterator()
            if place[1] + place[0] * MINUTE_US <= upto
        ]
        for minutes, start, *_ in closed:
            self.open.removeKey((minutes, start))
        if closed:
            yield self._rows(key, closed)


def _joined(before: tuple, after: list) -> list[float]:
    """One bar of its earlier and its later part; NaN is no value."""
    before = [np.nan if x is None else x for x in before]
    volumes = [x for x in (before[4], after[4]) if not np.isnan(x)]
    return [
        before[0], np.fmax(before[1], after[1]), np.fmin(before[2], after[2]), after[3],
        sum(volumes) if volumes else np.nan,
    ]


def _by_symbol(initial: DataFrame | None):
    return None if initial is None else initial.groupBy("symbol")


def ladder_states(bars: DataFrame, minutes: tuple[int, ...], initial: DataFrame | None = None) -> DataFrame:
    """Bars of every width, each once when the watermark has passed its end: minutes,
    symbol, rt and values. ``bars`` is a timed stream of minute bars; ``initial`` holds the
    open bars of a job that this one goes on with (``handover.open_bars``)."""
    ship_package()
    return (
        bars.select("symbol", "rt", *OHLCV)
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=LadderState(minutes),
            outputStructType="minutes bigint, symbol string, rt timestamp, " + ", ".join(f"{c} double" for c in OHLCV),
            outputMode="append",
            timeMode="EventTime",
            initialState=_by_symbol(initial),
        )
    )


def bar_states(
    bars: DataFrame, frame_minutes: int = 20, ttl_ms: int | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """Minute bars with every column of ``BarState``, in one stateful pass. ``initial`` holds
    the state of a job that this one goes on with (``handover.bar_history``).

    With ``ttl_ms`` a symbol's bars leave state that long (by the clock) after they were
    written, so one that trades no more leaves nothing behind. It must be longer than
    the time in which the history's bars come, or the indicators see fewer of them.
    Such a job runs by the clock: with ``availableNow`` it would not end.
    """
    ship_package()
    return (
        bars.select("symbol", "rt", *OHLCV)
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=BarState(frame_minutes * MINUTE_US, ttl_ms=ttl_ms),
            outputStructType=OUTPUT_SCHEMA,
            outputMode="append",
            timeMode="ProcessingTime" if ttl_ms else "None",
            initialState=_by_symbol(initial),
        )
    )


def indicators(bars: DataFrame, frame_minutes: int = 20, initial: DataFrame | None = None) -> DataFrame:
    """All indicator columns over a stream of minute bars."""
    return bar_states(bars, frame_minutes, initial=initial).select("symbol", "rt", "close", *INDICATORS)


def signals_of(states: DataFrame, length: int = 3) -> DataFrame:
    """Rising and falling runs and volume spikes; each bar gives those it triggers."""
    hits = triggered(*[F.col(c) for c in ("up", "down", "volume", "avg_volume")], length)
    rows = states.select("symbol", "rt", F.col("close").alias("price"), F.explode(hits).alias("_hit"))
    return rows.select("symbol", "rt", "_hit.signal_type", "_hit.side", "price", "_hit.detail")


def signals(bars: DataFrame, frame_minutes: int = 20, length: int = 3) -> DataFrame:
    """The signals over a stream of minute bars."""
    return signals_of(bar_states(bars, frame_minutes), length)
