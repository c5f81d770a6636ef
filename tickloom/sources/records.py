"""Raw records in, typed rows out.

Decoders take a frame with a text or binary ``value`` column, as the message
log gives it, and work for batch and streaming alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickloom import schemas
from tickloom.functions.times import event_time, flexible_time, iso_time

# Topics of the input records.
TOPICS = {
    "ohlc": "ohvcl_data",
    "news": "ticks_symbol",
    "order_book": "trading_data",
    "prediction": "kafka_prediction",
    "candles": "flink_computed_ohlc",
}


def kafka_options(servers: str, topic: str, **extra) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **extra,
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, **extra) -> DataFrame:
    """Topic as a stream of key, value, partition, offset; needs the connector."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **extra)).load()


def text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Folder of JSON lines as a stream with the topic's ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def table_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Folder of Parquet files as a stream, for example stored candles."""
    reader = spark.readStream.schema(schema).format("parquet")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def with_origin(df: DataFrame) -> DataFrame:
    """``topic_partition``: the log's partition, or the file for file sources."""
    if "partition" in df.columns:
        return df.withColumn("topic_partition", F.col("partition").cast("int"))
    return df.withColumn("topic_partition", F.col("_metadata.file_path"))


def pruned(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """The named fields of a schema; a dotted name takes one field of an inner struct."""
    unknown = {n.split(".")[0] for n in names} - set(schema.names)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    kept = []
    for f in schema:
        inner = [n.split(".", 1)[1] for n in names if n.startswith(f"{f.name}.")]
        if f.name in names:
            kept.append(f)
        elif inner:
            kept.append(T.StructField(f.name, pruned(f.dataType, inner), f.nullable))
    return T.StructType(kept)


def decode(
    raw: DataFrame, schema: T.StructType, required: Sequence[str], value: str = "value",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """JSON values to columns, without tombstones and without bad records.

    A tombstone or a malformed value decodes to a row of nulls, so it is known
    by its missing key fields. The value is unpacked with ``inline`` and not with a star: a
    filter on a plain projection is pushed below it and would parse every value
    again for each key field. For the same reason columns that are not used are parsed all the
    same; ``fields`` names those wanted beside the required ones (``Buy.Buy_1`` for one
    inside another), by default all.
    """
    if fields is not None:
        schema = pruned(schema, [*fields, *required])
    rest = [c for c in raw.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return raw.select(*rest, F.inline(F.array(parsed))).dropna(subset=list(required))


#: Bits of a partition's number in a log position.
PARTITION_BITS = 16


def log_position() -> Column:
    """(offset, partition) of a record as one number, for use as ``seq``. Offsets order the
    records of a partition, where all records of a key lie; between partitions, records of
    one time go by offset and then by partition."""
    offset, partition = F.col("offset"), F.col("partition").cast("long")
    fits = (
        offset.between(0, (1 << (63 - PARTITION_BITS)) - 1) & partition.between(0, (1 << PARTITION_BITS) - 1)
    )
    place = F.shiftleft(offset, PARTITION_BITS).bitwiseOR(partition)
    beyond = F.raise_error(F.lit("partition or offset out of range")).cast("long")
    return F.when(fits, place).when(fits.isNotNull(), beyond)


def keyed_log(raw: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Records of a keyed topic, tombstones among them.

    ``raw`` has the log's columns: key, value, partition, offset. A record takes its
    fields from the value; a tombstone has no value, takes ``keys`` from its key and is
    ``deleted``. ``topic_partition``, ``offset`` and ``seq`` (``log_position``) stay with
    the row. A malformed value, or a tombstone without a readable key, is left out.
    """
    key_schema = T.StructType([schema[k] for k in keys])
    places = with_origin(raw).select("topic_partition", "offset", log_position().alias("seq"), "key", "value")
    deleted = F.col("value").isNull()
    # One inline for both, as in ``decode``: nothing is parsed again for a filter.
    value = F.from_json(F.col("value").cast("string"), schema)
    key = F.from_json(F.col("key").cast("string"), key_schema)
    both = F.array(F.struct(F.when(~deleted, value).alias("_value"), F.when(deleted, key).alias("_key"), deleted.alias("deleted")))
    rows = places.select("topic_partition", "offset", "seq", F.inline(both))
    fields = [
        F.coalesce(f"_value.{f.name}", f"_key.{f.name}").alias(f.name) if f.name in keys else F.col(f"_value.{f.name}").alias(f.name)
        for f in schema
    ]
    return rows.select("topic_partition", "offset", "seq", "deleted", *fields).dropna(subset=list(keys))


def encode(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows to JSON ``value`` (and ``key``) columns for the message log."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    if not keys:
        return df.select(value)
    return df.select(F.to_json(F.struct(*keys)).alias("key"), value)


def ohlc_records(raw: DataFrame) -> DataFrame:
    rows = decode(raw, schemas.OHLC_RECORD, ("symbol", "time"))
    return rows.withColumn("time", event_time("time")).filter(F.col("time").isNotNull())


def news_records(raw: DataFrame) -> DataFrame:
    """News with ``event_time``; rows without a readable date are left out."""
    rows = decode(raw, schemas.NEWS_RECORD, ("symbol", "id"))
    return rows.withColumn("event_time", event_time("public_date")).filter(
        F.col("event_time").isNotNull()
    )


def news_table(raw: DataFrame) -> DataFrame:
    """News rows as stored; the date may be text, epoch seconds or epoch ms."""
    return decode(raw, schemas.NEWS_RECORD, ("symbol", "id")).select(
        "symbol",
        "id",
        F.col("news_title").alias("title"),
        F.col("news_source_link").alias("link"),
        flexible_time("public_date").alias("public_date"),
        F.col("news_short_content").alias("s_content"),
        F.col("close_price").alias("close"),
        "price_change_pct",
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("double").alias("sentiment_score"),
    )


def order_book_records(raw: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Snapshots; of the message only ``fields`` are parsed, by default all."""
    rows = decode(raw, schemas.ORDER_BOOK_RECORD, ("symbol", "handle_time"), fields=fields)
    return rows.withColumn("handle_time", iso_time("handle_time")).filter(
        F.col("handle_time").isNotNull()
    )


def prediction_records(raw: DataFrame) -> DataFrame:
    rows = decode(raw, schemas.PREDICTION_RECORD, ("symbol", "base_time", "interval"))
    return rows.withColumn("base_time", iso_time("base_time")).withColumn(
        "created_at", iso_time("created_at")
    ).filter(F.col("base_time").isNotNull())


def candle_records(raw: DataFrame) -> DataFrame:
    """Computed candles, read back; tombstones and rows without a time are skipped."""
    rows = decode(raw, schemas.OHLC_RECORD, ("screener", "symbol", "time"))
    return rows.withColumn("time", event_time("time")).filter(F.col("time").isNotNull())


def fundamentals(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON map symbol -> facts to one row per symbol."""
    entries = raw.select(
        F.explode(F.from_json(F.col(value).cast("string"), schemas.FUNDAMENTALS)).alias(
            "symbol", "facts"
        )
    )
    return entries.select(
        "symbol",
        F.col("facts.Loai_cty").alias("sectors"),
        F.col("facts.Tong_co_phieu").alias("shares"),
        F.col("facts.Von_dieu_le").alias("charter_capital"),
    )


# Column names of the history files.
HISTORY_NAMES = {
    "Datetime": "time",
    "Date": "time",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
}


def normalise_history(df: DataFrame, names: Mapping[str, str] = HISTORY_NAMES) -> DataFrame:
    """Historical bars with canonical names, wall-clock time and double values."""
    present = {old: new for old, new in names.items() if old in df.columns}
    df = df.withColumnsRenamed(present)
    return df.select(
        "symbol",
        F.col("time").cast("timestamp_ntz").alias("time"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Historical 1-minute bars from Parquet, CSV or JSON files."""
    return normalise_history(spark.read.format(fmt).options(**options).load(path))


def coerce(
    df: DataFrame, time_cols: Sequence[str] = (), float_cols: Sequence[str] = (),
    text_cols: Sequence[str] = (),
) -> DataFrame:
    """Casts the named columns to time, double and string."""
    casts = {c: event_time(F.col(c).cast("string")) for c in time_cols}
    casts |= {c: F.col(c).cast("double") for c in float_cols}
    casts |= {c: F.col(c).cast("string") for c in text_cols}
    return df.withColumns(casts)
