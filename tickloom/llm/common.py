"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import fresh_path

#: White space as the contracts count it: blank and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them again.

    This cuts the lineage: a lost executor costs no more than the tasks it ran,
    and values such as row ids stay as they were written.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(quoted(column)) if isinstance(column, str) else column, F.lit("")).cast("string")


def words_of(text: Column) -> Column:
    """The maximal runs of other characters than white space."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def quoted(name: str) -> str:
    """A column's name as ``F.col`` takes it, dots included."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can meet one of theirs.
    ``select("row.*")`` gives them back under an alias of ``row``."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns])


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row (columns that hold maps have no part in it): an order
    between rows that a key does not tell apart, the same in every run."""
    hashed = [F.col(quoted(f.name)) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashed) if hashed else F.lit(0).cast("bigint")


def first_rows(docs: DataFrame, key: Column, stays: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each value of ``key`` that is in
    ``stays.key``: the row of smallest ``row_hash``."""
    turn = F.row_number().over(Window.partitionBy("key").orderBy("hash"))
    return (
        docs.select(whole_row(docs).alias("row"), key.alias("key"), row_hash(docs).alias("hash"))
        .join(stays.select("key"), "key", "left_semi")
        .withColumn("turn", turn)
        .filter("turn = 1")
        .select("row.*")
    )


def ship() -> None:
    """Sends this package's functions to Python workers by value."""
    cloudpickle.register_pickle_by_value(sys.modules["tickloom"])


def worker_store(name: str, make: Callable[[], Any]) -> Any:
    """An object kept for the life of a Python worker, made on first use.

    Functions sent by value bring their own module globals to each task, so what
    several tasks share hangs on a module of its own.
    """
    store = sys.modules.setdefault("tickloom_worker_store", types.ModuleType("tickloom_worker_store"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)
