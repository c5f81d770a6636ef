"""Vectors as product codes, compared over per-dimension value dictionaries.

Components are integers, so a dimension takes few distinct values. For every
dimension of a batch its distinct values are tabulated once against all entries of
the codebook: squared differences by value and entry. The distance of a vector's
part to every entry is then a gather per dimension and their sum; nothing is
subtracted or squared per vector.

Codebooks start at the vectors of smallest id and are refined in rounds of
assignment and integer means. A task sums its rows per entry before anything is
shuffled; what reaches the driver is the codebooks, whose size does not depend on
the rows. All sums are integers, so every run gives the same bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, settle, ship

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Steps a unit is cut into.
SCALE = 256
#: Largest component in size: squared distances over 4096 dimensions fit a long.
LARGEST = 1 << 24
#: Vectors whose distances are summed at a time.
_CHUNK = 2048


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label, ints of the rows whose vector has only finite components."""
    vector = F.col(quoted(vector_col)).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(
        vector,
        lambda x: F.when(F.abs(x) * scale < LARGEST, F.floor(x * scale).cast("int")).otherwise(
            F.raise_error(F.lit(f"a component is not below {LARGEST // scale} in size")).cast("int")
        ),
    )
    # An array that is null or holds a null fails the test for it.
    return vectors.filter(F.coalesce(finite, F.lit(False))).select(
        F.col(quoted(id_col)).alias("vec_id"), F.col(quoted(label_col)).alias("label"), whole.alias("ints")
    )


def assigned(ints: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (the lower index of equals) and its squared distance.
    ``ints`` has a row per vector, ``books`` is parts x entries x width."""
    parts, entries, width = books.shape
    span = max(int(np.abs(ints).max(initial=0)), int(np.abs(books).max(initial=0)))
    kind = np.int32 if (2 * span + 1) ** 2 * width < 1 << 31 else np.int64
    codes = np.empty((len(ints), parts), np.int64)
    errors = np.empty((len(ints), parts), np.int64)
    for part in range(parts):
        tables, places = [], []
        for at in range(width):
            column = pa.array(np.ascontiguousarray(ints[:, part * width + at])).dictionary_encode()
            values = column.dictionary.to_numpy().astype(np.int64)
            tables.append(((values[:, None] - books[part, :, at]) ** 2).astype(kind))
            places.append(column.indices.to_numpy())
        for begin in range(0, len(ints), _CHUNK):
            end = min(len(ints), begin + _CHUNK)
            total = np.zeros((end - begin, entries), kind)
            for table, place in zip(tables, places, strict=True):
                total += table[place[begin:end]]
            best = total.argmin(axis=1)
            codes[begin:end, part] = best
            errors[begin:end, part] = total[np.arange(end - begin), best]
    return codes, errors


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry is the floored mean of its parts; an
    entry without parts stays."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            ints = _matrix(batch, parts * width)
            codes, _ = assigned(ints, books)
            for part in range(parts):
                counts[part] += np.bincount(codes[:, part], minlength=entries)
                np.add.at(sums[part], codes[:, part], ints[:, part * width : (part + 1) * width])
        flat = np.concatenate((counts.ravel(), sums.ravel()))
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], ["slot", "total"])

    found = rows.select("ints").mapInArrow(run, "slot bigint, total bigint").groupBy("slot").agg(F.sum("total").alias("total"))
    flat = np.zeros(parts * entries * (width + 1), np.int64)
    for slot, total in found.collect():  # at most one row per number in the codebooks
        flat[slot] = total
    counts = flat[: parts * entries].reshape(parts, entries, 1)
    sums = flat[parts * entries :].reshape(parts, entries, width)
    return np.where(counts > 0, sums // np.maximum(counts, 1), books)


def compressed(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector, and the codebooks (parts x entries x width).

    Columns: vec_id, label, code (two hex digits a part), error, label_error,
    codebooks_sha256. Rows whose vector is null or has a null, NaN or infinite component
    are dropped. The first codebooks are the vectors of smallest id (null last, equal
    ids by their integers); fewer vectors than entries make fewer entries. Repeated
    rows and ids stay; null labels are one label. Vectors must be of one length that
    ``parts`` divides, and components below 65536 in size: anything else raises. An
    empty table gives no rows.
    """
    ship()
    rows = settle(integer_vectors(vectors, id_col, vector_col, label_col), "integer-vectors")
    low, high = rows.agg(F.min(F.size("ints")), F.max(F.size("ints"))).first()
    if low is not None and (low != high or low % parts or not low):
        raise ValueError(f"vectors must have one length that {parts} divides, not {low} to {high}")
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    width = (low or 0) // parts
    books = np.array([r.ints for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    for _ in range(rounds if seeds else 0):
        books = refined(rows, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = assigned(_matrix(batch, parts * width), books)
            text = codes.astype(np.uint8).tobytes().hex()
            hexes = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(hexes, pa.string()), pa.array(errors.sum(axis=1))],
                ["vec_id", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    coded = settle(rows.mapInArrow(run, schema), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = settle(sums, "label-errors")  # its size is known, so it is broadcast only if small
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    ), books


def decoded(coded: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector that a row's ``code`` stands for: its entries' components
    over ``scale``, each in the middle of its step."""
    table = F.array(*[F.array(*[F.array(*[F.lit((int(x) + 0.5) / scale) for x in e]) for e in p]) for p in books])
    parts = F.sequence(F.lit(0), F.lit(len(books) - 1))
    place = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return coded.select("vec_id", F.flatten(F.transform(parts, lambda p: F.get(F.get(table, p), place(p)))).alias("vector"))
