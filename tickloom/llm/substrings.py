"""Removal of repeated byte strings by prefix doubling over sampled positions.

A byte goes if it lies in a string of SPAN bytes that also starts somewhere else,
in any document. A suffix array over all byte positions would move some twenty
bytes a position and round, many times the input. So the positions are sampled
first, without losing any: of the GRAM-byte strings in a SPAN-byte string, the one
of smallest hash is its anchor. Equal strings have equal anchors at equal offsets,
so only strings of one anchor class need comparing.

1. Every anchor position gets its rank by the first GRAM bytes (a 64-bit name).
   Positions whose rank is unique are done.
2. The rest are ranked by the pair of that rank and the name of their whole context,
   all bytes of all strings that the anchor stands for. Classes of one context only
   are settled: each of its strings occurs at every member.
3. Where a class holds several contexts, one of each is taken, and the positions in
   them are ranked by prefix doubling: ranks of 50 bytes, then pairs of ranks at
   offset 50 and 100, give ranks of 200 bytes. Spark deals and sorts the contexts by
   class. A class of very many contexts is no task's group: its strings become rows
   that Spark counts by (class, distance from the anchor, name).

Names of 64 bits are always used in pairs (rank and context, or rank and string).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import settle, ship, text_of

SPAN = 200
GRAM = 40
#: Contexts of one class that one task ranks together; a larger class is counted as rows.
CLASS_LIMIT = 4096
#: Bytes of contexts that are ranked at a time; classes are not cut.
_RANKED_BYTES = 1 << 21
_PIECE = 1 << 20
_PLACE_BITS = 21


def _byte_values() -> np.ndarray:
    """A fixed random 64-bit number for each byte value."""
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), "<u8")


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` bytes: polynomial sums modulo 2**64, then mixed."""
    factor = 0x9E3779B97F4A7C15
    powers = np.full(len(data), factor, np.uint64)
    back = np.full(len(data), pow(factor, -1, 1 << 64), np.uint64)
    powers[:1] = back[:1] = 1
    powers, back = np.cumprod(powers), np.cumprod(back)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_byte_values()[data] * back)))
    count = len(data) - size + 1
    found = (sums[size : size + count] - sums[:count]) * powers[:count]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(29))


def anchors(data: bytes, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """Rows (anchor, first, past): the strings of ``span`` bytes that start at first
    to past - 1 have this anchor, the leftmost of the smallest hash."""
    n = len(data) - span + 1
    if n <= 0:
        return np.zeros((0, 3), np.int64)
    width = span - gram + 1
    low = np.uint64((1 << _PLACE_BITS) - 1)
    found = []
    for begin in range(0, n, _PIECE):
        count = min(_PIECE, n - begin)
        grams = count + width - 1
        hashes = _rolling(np.frombuffer(data, np.uint8, count + span - 1, begin), gram)
        # The place breaks ties, so the smallest number is the leftmost of the smallest hash.
        packed = (hashes & ~low) | np.arange(grams, dtype=np.uint64)
        blocks = -(-grams // width)
        padded = np.full(blocks * width, ~np.uint64(0))
        padded[:grams] = packed
        grid = padded.reshape(blocks, width)
        down = np.minimum.accumulate(grid, axis=1).ravel()
        up = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(up[:count], down[width - 1 : width - 1 + count]) & low).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        first, past = np.concatenate(([0], cut)), np.concatenate((cut, [count]))
        found.append(np.stack((at[first], first, past), axis=1) + begin)
    return np.concatenate(found)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text: half of a SHA-256. Copies of a text have
    different keys, so no key is frequent; rows that repeat both share one, and
    their results."""
    whole = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def _anchor_rows(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """key, first, past, shift (anchor less first), rank, context per anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "first", "past", "shift", "rank", "context"]
        for batch in batches:
            for key, item in zip(batch.column("key"), batch.column("text"), strict=True):
                data = item.as_py().encode("utf-8", "surrogatepass")
                found = anchors(data, span, gram)
                if not len(found):
                    continue
                rows = found.tolist()
                rank = [xxhash.xxh3_64_intdigest(data[at : at + gram]) for at, _, _ in rows]
                own = [xxhash.xxh3_64_intdigest(data[a : b + span - 1], at - a) for at, a, b in rows]
                places = [found[:, 1], found[:, 2], found[:, 0] - found[:, 1]]
                columns = [pa.array([key.as_py()] * len(rows), pa.binary()), *map(pa.array, places)]
                yield pa.RecordBatch.from_arrays([*columns, _signed(rank), _signed(own)], names)

    return docs.mapInArrow(run, "key binary, first bigint, past bigint, shift bigint, rank bigint, context bigint")


def _double(parts: list[bytes], shifts: list[int], classes: list[int], span: int) -> tuple[np.ndarray, ...]:
    """Runs of starts whose ``span`` bytes also start in another context of their
    class at the same distance from the anchor: context, first, past.

    Ranks begin with names of a quarter of the length and double by pairs of ranks;
    the last pair may overlap.
    """
    sizes = np.array([len(x) for x in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    ends = np.repeat(begins + sizes, sizes)
    place = np.arange(len(data))
    size = max(1, span // 4)
    usable = np.flatnonzero(place + size <= ends)
    rank = np.zeros(len(data), np.int64)
    rank[usable] = np.unique(_rolling(data, size)[usable], return_inverse=True)[1]
    while size < span:
        step = min(size, span - size)
        usable = np.flatnonzero(place + size + step <= ends)
        pairs = rank[usable] * np.int64(len(data) + 1) + rank[usable + step]
        rank = np.zeros(len(data), np.int64)
        rank[usable] = np.unique(pairs, return_inverse=True)[1]
        size += step
    # A context holds each distance once, so a count above one means two contexts.
    owner = np.searchsorted(begins, usable, side="right") - 1
    distance = usable - begins[owner] - np.array(shifts)[owner] + span
    kind = np.array(classes)[owner]
    keys = (rank[usable] * np.int64(kind.max() + 1) + kind) * np.int64(2 * span) + distance
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    hit = count[which] > 1
    start, owner = usable[hit], owner[hit]
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    cut = np.flatnonzero((np.diff(start) > 1) | (np.diff(owner) > 0)) + 1
    head, tail = np.concatenate(([0], cut)), np.concatenate((cut - 1, [len(start) - 1]))
    own = owner[head]
    return own, start[head] - begins[own], start[tail] + 1 - begins[own]


_RUNS = "key binary, first bigint, past bigint"


def _ranked(contexts: DataFrame, span: int) -> DataFrame:
    """Runs of repeated starts, from contexts that lie sorted by class."""

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        number: dict[int, int] = {}
        kinds = [number.setdefault(r[0], len(number)) for r in rows]
        if len(number) == len(rows):
            return None
        own, first, past = _double([r[4] for r in rows], [r[3] for r in rows], kinds, span)
        if not len(own):
            return None
        begin = np.array([r[2] for r in rows])[own]
        keys = pa.array([rows[i][1] for i in own], pa.binary())
        return pa.RecordBatch.from_arrays([keys, pa.array(begin + first), pa.array(begin + past)], ["key", "first", "past"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("rank", "key", "first", "shift", "data")]
            for row in zip(*columns, strict=True):
                if size >= _RANKED_BYTES and row[0] != held[-1][0]:
                    out = solve(held)
                    held, size = [], 0
                    if out is not None:
                        yield out
                held.append(row)
                size += len(row[4])
        out = solve(held) if held else None
        if out is not None:
            yield out

    return contexts.mapInArrow(run, _RUNS)


def _counted(contexts: DataFrame, span: int) -> DataFrame:
    """The same for crowded classes: a row for each string, counted by class,
    distance and name."""
    start = F.explode(F.sequence(F.lit(0), F.length("data") - span)).alias("at")
    strings = contexts.select("rank", "key", "first", "shift", "data", start).select(
        "rank",
        "key",
        (F.col("first") + F.col("at")).alias("first"),
        (F.col("at") - F.col("shift")).alias("distance"),
        F.unhex(F.md5(F.substring("data", F.col("at") + 1, span))).alias("name"),
    )
    same = ["rank", "distance", "name"]
    shared = strings.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return strings.join(shared, same).select("key", "first", (F.col("first") + 1).alias("past"))


def _cut_contexts(marked: DataFrame, span: int) -> DataFrame:
    """rank, key, first, shift, data, crowded for each of ``spots``, cut from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rank", "key", "first", "shift", "data", "crowded"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        for batch in batches:
            for key, item, spots in zip(*[batch.column(n) for n in ("key", "text", "spots")], strict=True):
                data, key = item.as_py().encode("utf-8", "surrogatepass"), key.as_py()
                rows = [
                    (s["rank"], key, s["first"], s["shift"], data[s["first"] : s["past"] + span - 1], s["crowded"])
                    for s in spots.as_py()
                ]
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "rank bigint, key binary, first bigint, shift bigint, data binary, crowded boolean"
    return marked.select("key", "text", "spots").mapInArrow(run, schema)


def _removed(data: bytes, runs: list[dict], span: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes that are left."""
    kept, at, removed, spans = [], 0, 0, 0
    open_start = open_end = -1
    for r in [*sorted((r["first"], r["past"] + span - 1) for r in runs), (len(data) + span, 0)]:
        if r[0] <= open_end:
            open_end = max(open_end, r[1])
            continue
        if open_end > open_start:
            kept.append(data[at:open_start])
            at, removed, spans = open_end, removed + open_end - open_start, spans + 1
        open_start, open_end = r
    kept.append(data[at:])
    return removed, spans, b"".join(kept)


def _finish(rows: DataFrame, span: int, keep: str) -> DataFrame:
    """Takes the runs out of the texts: n_bytes, n_removed, n_spans, kept_sha256 beside
    ``keep`` (columns passed on, with their types). Rows with spots wait: their text
    and runs go on instead."""
    names = [x.split()[0] for x in keep.split(", ")]
    out = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for item, runs, waits in zip(*[batch.column(n) for n in ("text", "runs", "waits")], strict=True):
                data = item.as_py().encode("utf-8", "surrogatepass")
                removed, spans, left = (0, 0, b"") if waits.as_py() else _removed(data, runs.as_py() or [], span)
                digest = "" if waits.as_py() else hashlib.sha256(left).hexdigest()
                for column, value in zip(found, (len(data), removed, spans, digest), strict=True):
                    column.append(value)
            columns = [pa.array(x, k) for x, k in zip(found, [pa.int64()] * 3 + [pa.string()], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], [*names, *out])

    return rows.mapInArrow(run, f"{keep}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    limit: int = CLASS_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte covered by a string of ``span`` bytes that also starts
    elsewhere, in this document or another; strings are judged on the input. A null
    text is empty; texts shorter than ``span`` stay whole; rows that repeat a text
    repeat all its strings.
    """
    ship()
    text = text_of(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), row_key(F.col(id_col), text).alias("key"), text.alias("text")
    )
    found = settle(_anchor_rows(keyed.select("key", "text"), span, gram), "anchors")
    classes = settle(
        found.groupBy("rank")
        .agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("mixed"))
        .filter("n > 1")
        .select("rank", "mixed"),
        "anchor-classes",
    )
    known = settle(found.join(classes, "rank"), "repeated-anchors")
    mixed = known.filter("mixed")
    # Of equal contexts the one of smallest tag stands for all.
    tag = F.xxhash64("key", "first")
    contexts = settle(
        mixed.groupBy("rank", "context").agg(F.count(F.lit(1)).alias("n"), F.min(tag).alias("tag")), "contexts"
    )
    crowds = settle(
        contexts.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("rank"),
        "crowded-classes",
    ).withColumn("crowd", F.lit(True))
    members = mixed.join(contexts, ["rank", "context"]).join(crowds, "rank", "left")
    spot = F.struct("rank", "first", "past", "shift", F.col("crowd").isNotNull().alias("crowded"))
    run = F.struct("first", "past")
    # A text's own runs and spots, made distinct; both are bounded by the text.
    own = (
        known.filter("not mixed")
        .select("key", run.alias("run"), F.lit(None).cast(members.select(spot.alias("s")).schema["s"].dataType).alias("spot"))
        .unionByName(
            members.select(
                "key", F.when(F.col("n") > 1, run).alias("run"), F.when(tag == F.col("tag"), spot).alias("spot")
            ).filter("run is not null or spot is not null")
        )
        .groupBy("key")
        .agg(F.collect_set("run").alias("runs"), F.collect_set("spot").alias("spots"))
    )
    joined = keyed.join(own, "key", "left").withColumn("waits", F.coalesce(F.size("spots"), F.lit(0)) > 0)
    runs_type = "array<struct<first:bigint,past:bigint>>"
    spots_type = "array<struct<rank:bigint,first:bigint,past:bigint,shift:bigint,crowded:boolean>>"
    passed = f"doc_id {kind}, key binary, waits boolean, later string, runs {runs_type}, spots {spots_type}"
    first_pass = settle(
        _finish(
            joined.withColumn("later", F.when(F.col("waits"), F.col("text"))).select(
                "doc_id", "key", "waits", "later", "runs", "spots", "text"
            ),
            span,
            passed,
        ),
        "removed-first",
    )
    done = first_pass.filter("not waits").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    waiting = first_pass.filter("waits").select("doc_id", "key", F.col("later").alias("text"), "runs", "spots")
    cut = settle(_cut_contexts(waiting, span).distinct(), "cut-contexts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = _ranked(
        cut.filter("not crowded").repartition(parts, "rank").sortWithinPartitions("rank", "key", "first"), span
    )
    more = ranked.unionByName(_counted(cut.filter("crowded"), span)).groupBy("key").agg(
        F.collect_set(run).alias("more")
    )
    rest = (
        waiting.drop("spots")
        .join(more, "key", "left")
        .select(
            "doc_id",
            "text",
            F.concat("runs", F.coalesce("more", F.array().cast(runs_type))).alias("runs"),
            F.lit(False).alias("waits"),
        )
    )
    return done.unionByName(_finish(rest, span, f"doc_id {kind}").select(*done.columns))
