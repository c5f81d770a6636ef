"""Exact deduplication against a persistent digest index.

The index is a table of (digest, keep_id) bucketed by digest, each bucket file
sorted by it. A batch is reduced to its own first rows, an anti-join against the
index finds the digests not seen before, and these are appended. The index side
of that sort-merge join is read by bucket, so only the batch's digests move.

Only DataFrame functions are used.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, first_rows, quoted, settle, text_of
from tickloom.session import fresh_path


def normalised(text: Column) -> Column:
    """Null is empty; each run of white space becomes one blank."""
    return F.regexp_replace(text_of(text), SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """A digest index at ``path``; made there if it does not exist.

    The path may be used again by later sessions; ``buckets`` must then be the
    number it was made with (default: the session's shuffle partitions).
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or fresh_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        # A task holds whole buckets, so a bucket gets one sorted file per batch.
        fresh.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Adds a batch; one row per document of the batch:
        doc_id, keep_id, group_size, kept, digest.

        ``keep_id`` is the document that stays: the one the index already has for
        these words, else the smallest id of the batch (null only if all ids of
        equal texts are null). ``group_size`` counts equal texts in the batch. Of
        rows that repeat an id and its text, one is kept. Adding a batch again
        changes nothing.
        """
        rows = settle(
            docs.select(
                F.col(quoted(id_col)).cast("bigint").alias("doc_id"),
                digest(F.col(quoted(text_col))).alias("digest"),
                F.monotonically_increasing_id().alias("row_id"),
            ),
            "digests",
        )
        firsts = settle(
            rows.groupBy("digest").agg(
                F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
            ),
            "first-digests",
        )
        self.append(firsts.join(self.read().hint("merge"), "digest", "left_anti"))
        held = firsts.select("digest", "group_size").join(self.read(), "digest")
        same = Window.partitionBy("digest", "doc_id").orderBy("row_id")
        return (
            rows.withColumn("turn", F.row_number().over(same))
            .join(held, "digest")
            .select(
                "doc_id",
                "keep_id",
                "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
                "digest",
            )
        )


def keep_first(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that ``index.add`` keeps, with all their columns.

    The key holds id and digest, so a large group of copies spreads over many
    partitions. Rows that repeat both leave one row, that of smallest ``row_hash``.
    Further columns may have any names.
    """

    def key(doc_id: Column, found: Column) -> Column:
        return F.concat_ws(":", F.hex(found), F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")))

    stays = index.add(docs, id_col, text_col).filter("kept")
    stays = stays.select(key(F.col("doc_id"), F.col("digest")).alias("key"))
    return first_rows(docs, key(F.col(quoted(id_col)), digest(F.col(quoted(text_col)))), stays)
