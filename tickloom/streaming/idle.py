"""Sources that fall silent: the clock lets the watermark pass them.

Spark's watermark is that of the slowest source, so one that sends nothing holds all
windows open. Here one small stateful operator keeps, per source, how far it has come
and when (by the clock) it last sent anything; a processing-time timer then sends marks
on behalf of the silent ones. Input is one row per task, source and batch, so it grows
with the tasks and not with the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.session import ship_package

SOURCE = "_source"
MARK = "_mark_us"


class IdleState(StatefulProcessor):
    """How far each source has come (event time less its delay) and when it last sent.

    A source is idle when it has sent nothing for ``idle_ms``. Idle sources take the
    mark of the slowest one that is not, or of the quickest of all while all are idle.
    """

    def __init__(self, sources: tuple[str, ...], idle_ms: int):
        self.sources, self.idle_ms = sources, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "source string", "mark bigint, at bigint")

    def close(self) -> None:
        pass

    def _passed(self, seen: dict[str, tuple[int | None, int]], now: int) -> Iterator[pd.DataFrame]:
        """A mark for every idle source that lies behind, kept as its own."""
        idle = [s for s in self.sources if now - seen[s][1] >= self.idle_ms]
        marks = [seen[s][0] for s in self.sources if s not in idle]
        known = [mark for mark, _ in seen.values() if mark is not None]
        if not idle or not known or None in marks:
            return
        mark = min(marks) if marks else max(known)
        behind = [s for s in idle if seen[s][0] is None or seen[s][0] < mark]
        for s in behind:
            self.seen.updateValue((s,), (mark, seen[s][1]))
        if behind:
            yield pd.DataFrame({SOURCE: behind, MARK: [mark] * len(behind)})

    def _known(self, now: int) -> dict[str, tuple[int | None, int]]:
        """State of all sources; the time of one never seen runs from the first batch."""
        seen = {key[0]: tuple(value) for key, value in self.seen.iterator()}
        for s in self.sources:
            if s not in seen:
                seen[s] = (None, now)
                self.seen.updateValue((s,), seen[s])
        return seen

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        seen = self._known(now)
        # Columns by place: behind mapInPandas their names do not arrive here.
        new = pd.concat([part.set_axis(["_all", SOURCE, MARK], axis=1) for part in rows])
        for s, mark in new.groupby(SOURCE)[MARK].max().items():
            before = seen[s][0]
            seen[s] = (int(mark) if before is None else max(before, int(mark)), now)
            self.seen.updateValue((s,), seen[s])
        yield from self._passed(seen, now)
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        yield from self._passed(self._known(now), now)


def _newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per source of a task's rows."""
    newest: dict[str, int] = {}
    for batch in batches:
        for s, mark in batch.groupby(SOURCE)[MARK].max().items():
            newest[s] = max(int(mark), newest.get(s, int(mark)))
    if newest:
        yield pd.DataFrame({"_all": 0, SOURCE: list(newest), MARK: list(newest.values())})


def idle_marks(
    sources: Mapping[str, DataFrame], time: Mapping[str, str], delays: Mapping[str, str], idle_ms: int
) -> DataFrame:
    """Marks (source, event time in microseconds less the delay) for silent sources."""
    ship_package()
    schema = f"{SOURCE} string, {MARK} bigint"

    def reached(name: str) -> DataFrame:
        at = F.col(time[name]).cast("timestamp") - F.expr(f"INTERVAL {delays[name]}")
        return sources[name].select(F.lit(name).alias(SOURCE), F.unix_micros(at).alias(MARK)).dropna()

    rows = reduce(DataFrame.unionByName, [reached(name) for name in sources])
    return (
        rows.mapInPandas(_newest, f"_all int, {schema}")
        .groupBy("_all")
        .transformWithStateInPandas(
            statefulProcessor=IdleState(tuple(sources), idle_ms),
            outputStructType=schema,
            outputMode="append",
            timeMode="ProcessingTime",
        )
    )
