"""A stateful job handed over to one with another number of partitions.

A checkpoint fixes its partition count for life, so the new job starts on a checkpoint of
its own. Per-symbol state is read from the old one through Spark's state reader and given
to the new job as initial state, which Spark places anew. Native windows take no initial
state; the records of the windows still open are read again instead. Each window closes
in one of the two jobs: up to the old job's last watermark in the old one, later in the new.

    old = handover(spark, old_checkpoint)            # the old job has stopped
    records = timed(old.still_open(source), "time", PRICE_DELAY)
    bar_states(minute_bars(records), initial=bar_history(spark, old))

State is copied to the shared folder, so the old checkpoint may go once the new job has
started. Nothing passes through the driver but two small files of the checkpoint.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.times import MINUTE_US
from tickloom.operators.candles import OHLCV
from tickloom.session import stored


@dataclass(frozen=True)
class Handover:
    """Where a stopped job stands: its last batch, and the watermark that this used, in
    milliseconds; 0 if it has seen no record."""

    checkpoint: str
    batch_id: int
    mark_ms: int

    def still_open(self, records: DataFrame, time: str = "time", width_us: int = MINUTE_US) -> DataFrame:
        """The records that the new job reads: those from the start of the oldest native
        window that the old job left open. Earlier ones are in closed windows or, if they
        come only now, late for the old job too."""
        if not self.mark_ms:
            return records
        start = self.mark_ms * 1000 // width_us * width_us
        return records.filter(F.col(time) >= F.timestamp_micros(F.lit(start)).cast(records.schema[time].dataType))


def _log_file(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number and lines of the newest file of a checkpoint's log."""
    files = spark.read.text(path, wholetext=True).select("value", "_metadata.file_name")
    number = F.col("file_name").cast("bigint")
    newest = files.filter(number.isNotNull()).orderBy(number.desc()).select("value", number.alias("n")).first()
    if newest is None:
        raise ValueError(f"no batch in {path}")
    return newest.n, newest.value.splitlines()


def handover(spark: SparkSession, checkpoint: str) -> Handover:
    """State of a job that has stopped with its last batch committed. One that was cut off
    inside a batch must run once more first, or that batch's rows might come twice."""
    planned, lines = _log_file(spark, f"{checkpoint}/offsets")
    committed, _ = _log_file(spark, f"{checkpoint}/commits")
    if planned != committed:
        raise ValueError(f"batch {planned} of {checkpoint} is not committed: let the old job finish it")
    return Handover(checkpoint, committed, json.loads(lines[1])["batchWatermarkMs"])


def _variable(spark: SparkSession, old: Handover, name: str) -> DataFrame:
    """One state variable of the job's per-symbol operator, a row per key or map entry."""
    operators = spark.read.format("state-metadata").load(old.checkpoint)
    stateful = F.lower("operatorName").startswith("transformwithstate")
    found = [r.operatorId for r in operators.filter(stateful).select("operatorId").distinct().collect()]
    if len(found) != 1:
        raise ValueError(f"{old.checkpoint} holds {len(found)} operators with per-symbol state, not one")
    return (
        spark.read.format("statestore")
        .option("operatorId", found[0])
        .option("batchId", old.batch_id)
        .option("stateVarName", name)
        .option("flattenCollectionTypes", name == "open")
        .load(old.checkpoint)
    )


def bar_history(spark: SparkSession, old: Handover) -> DataFrame:
    """Initial state for ``state.bar_states``: a row per symbol with its bars, oldest first,
    and its runs. Both jobs must have the same frame, and no ``ttl_ms``."""
    bars = _variable(spark, old, "bars").select("key.symbol", F.col("list_value").alias("_bars"))
    runs = _variable(spark, old, "runs").select(F.col("key.symbol").alias("_key"), "value.up", "value.down")
    both = bars.join(runs, F.col("symbol").eqNullSafe(F.col("_key")))
    fields = [F.col(f"_bars.{c}").alias(f"{c}s") for c in ("time", "close", "volume")]
    return stored(both.select("symbol", *fields, "up", "down"), "bar-history")


def open_bars(spark: SparkSession, old: Handover) -> DataFrame:
    """Initial state for ``state.ladder_states``: a row per open bar."""
    bars = _variable(spark, old, "open")
    values = [F.col(f"user_map_value.{c}") for c in OHLCV]
    return stored(bars.select("key.symbol", "user_map_key.minutes", "user_map_key.start", *values), "open-bars")
