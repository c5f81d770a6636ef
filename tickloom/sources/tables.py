"""Keyed tables as Parquet: writing, last write wins, reading by key.

A micro-batch is written below a folder of its writer and ``batch_id``. Writing the
same batch again replaces that folder and nothing else, so a retried batch leaves no
trace, no stored file is rewritten, and a lost task is simply run again. Several
writers share a table without touching each other's batches. Reading keeps the row
of every key that was committed last, whoever wrote it.

Sinks pack their batches: ``PACK`` batches become one folder, as many of these a larger
one, and so on, so that a row is rewritten once per level and the folders of a writer
grow with the logarithm of its batches. A pack holds rows that its parts hold too; a
reader that sees both finds each key once, so nothing has to be switched at one moment.
Parts go when the next pack of their level is complete, which leaves readers time.

Files are placed by symbol group, a hash of the symbol: one group for a micro-batch, more
for packs and backfills, by their number of symbols (``group_count``). A scan for one
symbol reads one group of each folder, so its files do not grow with the symbols. The
folder's name holds the count too, so that folders of different counts lie side by side.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tickloom.functions.times import DAY_US, chunk_of
from tickloom.schemas import TABLES, Table
from tickloom.sources.records import encode

BATCH = "batch_id"
WRITER = "writer"
#: Microseconds at which a batch was written, on each of its rows.
COMMITTED = "_committed"
_NEWEST = (COMMITTED, BATCH, WRITER)
#: Folders of a level that make one of the next; 0 packs nothing.
PACK = 10
GROUP = "symbol_group"
#: Possible counts of symbol groups, and the symbols a group is meant to hold at most.
GROUP_COUNTS = (1, 16, 256, 4096, 65536)
SYMBOLS_PER_GROUP = 64
#: Span of time that a busy group's rows are spread by.
_GROUP_SPAN_US = 32 * DAY_US
_ADDED = (COMMITTED, BATCH, WRITER, GROUP)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key; ``order`` lists columns, most significant first.

    Every map task keeps one row per key before the shuffle (group limit).
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def current_of_log(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a keyed topic leaves: the newest record per key, unless it is a tombstone."""
    return latest_by_key(log, keys, ["seq"]).filter(~F.col("deleted")).drop("deleted")


def conform(df: DataFrame, table: Table) -> DataFrame:
    return df.select(*table.keys, *[c for c in table.columns if c in df.columns])


def _day_column(table: Table) -> str | None:
    return next((k for k in table.keys if k in ("time", "signal_time", "news_time", "handle_time")), None)


def group_count(symbols: int) -> int:
    """Symbol groups for a folder of that many symbols."""
    return next((n for n in GROUP_COUNTS if symbols <= n * SYMBOLS_PER_GROUP), GROUP_COUNTS[-1])


def symbol_group(symbol: Column, groups: int) -> Column:
    """Name of a symbol's group among ``groups``, for example ``16x3``."""
    place = F.pmod(F.xxhash64(symbol), F.lit(groups)).cast("string")
    return F.concat(F.lit(f"{groups}x"), place)


def _in_groups_of(symbol: str) -> Column:
    """Constant groups in which a symbol's rows may lie, whatever the folder's count."""
    return reduce(lambda x, y: x | y, [F.col(GROUP) == symbol_group(F.lit(symbol), n) for n in GROUP_COUNTS])


def _laid_out(df: DataFrame, table: Table, groups: int) -> DataFrame:
    """Clustered for reading: a file holds few symbols, in time order. In one group, a busy
    symbol is spread over its days. Several groups are spread over longer spans, so that
    a group has one file per rung and span; what is too large is split as its size asks."""
    time = _day_column(table)
    place = [*table.partitions, GROUP if groups > 1 else "symbol"]
    df = df.withColumn(GROUP, symbol_group(F.col("symbol"), groups))
    if time:
        span = chunk_of(time, _GROUP_SPAN_US if groups > 1 else DAY_US)
        df = df.withColumn("_span", span).hint("rebalance", *place, "_span").drop("_span")
    elif groups > 1:
        df = df.hint("rebalance", *place)
    else:
        df = df.hint("rebalance", *place, *[k for k in table.keys if k not in place])
    return df.sortWithinPartitions(GROUP, *table.partitions, *table.clustering)


def write_batch(
    df: DataFrame, root: str, table: Table, batch_id: int, order: Sequence[str] = (),
    writer: str = "default", symbols: int = 1,
) -> None:
    """Writes one batch of a keyed table; ``order`` decides between rows of the
    batch that share a key. ``writer`` names the job: batch ids count within it.
    ``symbols`` says about how many it holds, if it is large; a wrong number changes the
    layout only."""
    if order:
        df = latest_by_key(df, table.keys, order)
    rows = conform(df, table).withColumn(COMMITTED, F.lit(time.time_ns() // 1000))
    _write(rows, table, _folder(root, table, writer, batch_id), symbols)


def _folder(root: str, table: Table, writer: str, batch_id: int) -> str:
    return f"{root}/{table.name}/{WRITER}={writer}/{BATCH}={batch_id}"


def _write(rows: DataFrame, table: Table, path: str, symbols: int) -> None:
    laid_out = _laid_out(rows, table, group_count(symbols))
    laid_out.write.mode("overwrite").partitionBy(GROUP, *table.partitions).parquet(path)


def _symbols(rows: DataFrame) -> int:
    return rows.agg(F.approx_count_distinct("symbol")).first()[0]


def _level(writer: str, level: int) -> str:
    """Writer name of the packs of a level; level 0 are the batches themselves."""
    return f"{writer}~{level}" if level else writer


def pack_batches(
    spark: SparkSession, root: str, table: Table, batch_id: int, writer: str, fan: int = PACK
) -> None:
    """Packs a writer's batches before ``batch_id``, which may still be retried; those
    before it never are. Called with every batch, it does nothing for most.

    A pack is named by its last batch and complete once it has its ``_SUCCESS`` file. One
    that was cut off is written again: its parts are still there.
    """
    if fan < 2:
        return
    level, width = 1, fan
    while batch_id and batch_id % width == 0:
        last = batch_id - 1
        parts = _parts(spark, root, table, writer, level, last, fan)
        target = _folder(root, table, _level(writer, level), last)
        if parts and not _exists(spark, f"{target}/_SUCCESS"):
            stored = spark.read.option("mergeSchema", "true").option("basePath", f"{root}/{table.name}")
            held = stored.parquet(*parts)
            rows = latest_by_key(held, table.keys, _NEWEST).drop(BATCH, WRITER, GROUP)
            _write(rows, table, target, _symbols(held))
        before = last - width
        if before >= 0 and _exists(spark, f"{_folder(root, table, _level(writer, level), before)}/_SUCCESS"):
            for part in _parts(spark, root, table, writer, level, before, fan):
                _delete(spark, part)
        level, width = level + 1, width * fan


def _parts(spark, root: str, table: Table, writer: str, level: int, last: int, fan: int) -> list[str]:
    """Folders below ``level`` that the pack ending with ``last`` is made of."""
    step = fan ** (level - 1)
    paths = [_folder(root, table, _level(writer, level - 1), last - i * step) for i in range(fan)]
    return [path for path in paths if _exists(spark, f"{path}/_SUCCESS")]


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def _delete(spark: SparkSession, path: str) -> None:
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def _stored(spark: SparkSession, root: str, table: Table) -> DataFrame:
    # Batches may hold different columns; a missing one is null.
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/{table.name}")


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Current rows of a keyed table: the newest write of each key."""
    return latest_by_key(_stored(spark, root, table), table.keys, _NEWEST).drop(*_ADDED)


def read_key(spark: SparkSession, root: str, table: Table, **equal: str) -> DataFrame:
    """Scan by equality. On key columns it is pushed to partitions and files, a symbol
    to its groups; on others it tests the newest row of a key, so a replaced value is
    not found."""
    stored = _stored(spark, root, table)
    if "symbol" in equal:
        stored = stored.filter(_in_groups_of(equal["symbol"]))
    for column in table.keys:
        if column in equal:
            stored = stored.filter(F.col(column) == equal[column])
    rows = latest_by_key(stored, table.keys, _NEWEST).drop(*_ADDED)
    for column, value in equal.items():
        if column not in table.keys:
            rows = rows.filter(F.col(column) == value)
    return rows


def bulk_write(
    df: DataFrame, root: str, table: Table, batch_id: int = 0, writer: str = "backfill", symbols: int = 1000
) -> None:
    """One write of a whole backfill, all symbols and rungs together."""
    write_batch(df, root, table, batch_id, writer=writer, symbols=symbols)


def compact(spark: SparkSession, root: str, table: Table, new_root: str) -> None:
    """Current rows as a single batch below another root."""
    symbols = _symbols(_stored(spark, root, table))
    write_batch(read_table(spark, root, table), new_root, table, 0, symbols=symbols)


def append_query(df: DataFrame, path: str, checkpoint: str, **options):
    """Append sink as Parquet, each row once."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )


def kafka_append_query(df: DataFrame, servers: str, topic: str, checkpoint: str, keys=()):
    """Append or upsert topic; needs the connector."""
    return (
        encode(df, keys)
        .writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def writer_of(checkpoint: str) -> str:
    """Name of the job that keeps its state at ``checkpoint``."""
    return "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def upsert_query(
    df: DataFrame, root: str, table_name: str, checkpoint: str,
    order: Sequence[str] = (), output_mode: str = "append", pack: int = PACK,
):
    """Keyed sink: one idempotent batch folder per micro-batch, packed as they grow in
    number. The checkpoint names the writer, so a job on a new checkpoint starts batches
    of its own."""
    table = TABLES[table_name]
    writer = writer_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, table, batch_id, order, writer)
        pack_batches(batch.sparkSession, root, table, batch_id, writer, pack)

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


#: Kind of a change: new key, old and new values of a replaced row, deleted row.
CHANGE = "op"
INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def changes_of(rows: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What ``rows``, one per key, change in ``before``, one per key: a row per insert and
    delete, two per update, none where nothing differs. A row without any value deletes
    its key; one for a key that is absent, or deleted already, changes nothing."""
    values = [c for c in rows.columns if c not in keys]
    new = F.struct(*[F.col(f"r.{c}").alias(c) for c in values])
    old = F.struct(*[F.col(f"b.{c}").alias(c) for c in values])

    def empty(side: str) -> Column:
        return reduce(lambda x, y: x & y, [F.col(f"{side}.{c}").isNull() for c in values])

    absent = F.col("b._stored").isNull() | empty("b")

    def change(op: str, row: Column) -> Column:
        return F.struct(F.lit(op).alias(CHANGE), row.alias("row"))

    none = F.slice(F.array(change(INSERT, new)), 1, 0)
    ops = (
        F.when(empty("r"), F.when(absent, none).otherwise(F.array(change(DELETE, old))))
        .when(absent, F.array(change(INSERT, new)))
        .when(new.eqNullSafe(old), none)
        .otherwise(F.array(change(BEFORE, old), change(AFTER, new)))
    )
    matched = reduce(lambda x, y: x & y, [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    stored = before.select(*keys, *values, F.lit(True).alias("_stored"))
    joined = rows.alias("r").join(stored.alias("b"), matched, "left")
    spread = joined.select(*[F.col(f"r.{k}").alias(k) for k in keys], F.explode(ops).alias("_c"))
    return spread.select(f"_c.{CHANGE}", *keys, *[F.col(f"_c.row.{c}").alias(c) for c in values])


def changelog_query(
    df: DataFrame, root: str, table_name: str, checkpoint: str,
    order: Sequence[str] = (), output_mode: str = "update", pack: int = PACK,
):
    """Keyed sink that also keeps the changes it makes, with retractions. The version a
    row replaces is the newest that this job stored in an earlier batch, so a retried
    batch finds the same one and gives the same changes. Of stored batches only the time
    range of the new rows is read."""
    table = TABLES[table_name]
    writer = writer_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if order:
            batch = latest_by_key(batch, table.keys, order)
        rows = conform(batch, table).persist()
        try:
            write_batch(rows, root, table, batch_id, writer=writer)
            changes = changes_of(rows, _before(rows, root, table, batch_id, writer), table.keys)
            changes.write.mode("overwrite").parquet(_changes(root, table, writer, batch_id))
            pack_batches(batch.sparkSession, root, table, batch_id, writer, pack)
        finally:
            rows.unpersist()

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def _changes(root: str, table: Table, writer: str, batch_id: int) -> str:
    return f"{root}/{table.name}_changes/{WRITER}={writer}/{BATCH}={batch_id}"


def _before(rows: DataFrame, root: str, table: Table, batch_id: int, writer: str) -> DataFrame:
    """Rows as this writer left them before the batch, in the time range of ``rows``."""
    kept = [T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField(GROUP, T.StringType())]
    schema = T.StructType([*rows.schema.fields, *kept])
    stored = rows.sparkSession.read.schema(schema).parquet(f"{root}/{table.name}")
    own = (F.col(WRITER) == writer) | F.col(WRITER).startswith(_level(writer, 1)[:-1])
    stored = stored.filter(own & (F.col(BATCH) < batch_id)).drop(WRITER, GROUP)
    time = _day_column(table)
    if time:
        low, high = rows.agg(F.min(time), F.max(time)).first()
        stored = stored.filter(F.col(time).between(F.lit(low), F.lit(high)))
    return latest_by_key(stored, table.keys, [BATCH]).drop(BATCH)


def read_changes(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """All changes of a keyed table, with writer and batch."""
    return spark.read.parquet(f"{root}/{table.name}_changes")


def fold_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that a changelog of one writer leaves."""
    lasting = changes.filter(F.col(CHANGE) != BEFORE)
    newest = latest_by_key(lasting, keys, [BATCH])
    return newest.filter(F.col(CHANGE) != DELETE).drop(CHANGE, BATCH, WRITER)


def fan_out_query(
    df: DataFrame, writers: Sequence[Callable[[DataFrame, int], None]], checkpoint: str
):
    """Several sinks fed by one scan: each micro-batch is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
