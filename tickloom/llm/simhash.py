"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most three bits differ in at most one bit of
one of their halves. The anchors of a half are the code words of the Hamming code
on its first 31 bits: every value is within covering radius 1 of exactly one, its
home. A fingerprint is replicated to every anchor within radius plus threshold,
1 + 1, which are 16 anchors a half (one for a code word), and at each anchor those
at home there are compared with all that came.

Equal fingerprints are one row before that. A crowded anchor is cut into tiles of
members at home against tiles of visitors, so no group grows with the data, and an
anchor yields a tree of links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import first_rows, quoted, settle, ship, text_of
from tickloom.llm.components import connected_components

SHINGLE = 3
SEED = 42
NEAR = 3
#: Members at home, and visitors, of a crowded anchor that meet in one tile.
TILE = 4096
_CHUNK = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, unsigned. A bit is set if it is set in
    over half of the shingles' hashes; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    spans = zip(starts[:count].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    for first in range(0, count, _CHUNK):
        part = min(_CHUNK, count - first)
        hashes = np.fromiter((digest(joined[a:b], SEED) for (a, b), _ in zip(spans, range(part))), np.uint64, part)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(part, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (64 bits) and fp, the fingerprint as a signed 64-bit
    integer; one row per row."""
    ship()
    text = text_of(text_col)
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column("text")]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), values], ["doc_id", "text_hash", "fp"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def _flips() -> list[list[int]]:
    """By syndrome: the patterns of weight two or less that lead to a code word."""
    out = [[0]]
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if i < i ^ s]
        out.append([1 << (s - 1)] + [(1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs])
    return out


def _syndrome(value: Column) -> Column:
    """Positions 1 to 31 of the set bits, added without carry."""
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        odd = F.bit_count(value.bitwiseAND(F.lit(mask))).cast("int").bitwiseAND(F.lit(1))
        out = out + odd * (1 << k)
    return out


def anchored(prints: DataFrame) -> DataFrame:
    """A row for each fingerprint and anchor: key (half and code word), fp, home."""
    flips = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in row]) for row in _flips()])
    parts = []
    for half in (0, 1):
        value = F.shiftrightunsigned("fp", 32 * half).bitwiseAND(F.lit((1 << 31) - 1))
        part = prints.select("fp", value.alias("value"))
        part = part.select("fp", "value", F.posexplode(F.get(flips, _syndrome(F.col("value")))).alias("at", "flip"))
        key = F.col("value").bitwiseXOR(F.col("flip")) + (half << 31)
        parts.append(part.select(key.alias("key"), "fp", (F.col("at") == 0).alias("home")))
    return parts[0].unionByName(parts[1])


def forest(items: np.ndarray, home: np.ndarray, close: Callable[..., np.ndarray]) -> list[tuple]:
    """Links that join what is close to an item at home: a forest, so fewer links than
    items. Each at home is in one tree and is compared with all that no tree holds and
    with every guest; a guest that several trees reach joins those trees.
    ``close(item, others)`` tells which others are."""
    out = []
    left, guests = items[home], items[~home]
    owner = np.full(len(guests), -1)  # the first tree that reached a guest
    roots, heads = [], []
    while len(left):
        root, left = left[0], left[1:]
        tree = len(roots)
        roots.append(root)
        heads.append(tree)
        wait = [root]
        reached = np.zeros(len(guests), bool)
        while wait:
            at = wait.pop()
            hit = close(at, left)
            if hit.any():
                out += [(root, x) for x in left[hit]]
                wait += list(left[hit])
                left = left[~hit]
            unmet = np.flatnonzero(~reached)
            reached[unmet] = close(at, guests[unmet])
        first = reached & (owner < 0)
        out += [(root, x) for x in guests[first]]
        for other in np.unique(owner[reached & ~first]).tolist():
            while heads[other] != other:
                heads[other] = other = heads[heads[other]]
            if other != tree:
                heads[other] = tree
                out.append((root, roots[other]))
        owner[first] = tree
    return out


def _compare(near: int):
    def pairs_of(key: np.ndarray, tile: np.ndarray, fp: np.ndarray, home: np.ndarray) -> list:
        cut = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
        at_home = np.add.reduceat(home.astype(np.int64), starts)
        size = ends - starts
        found = []
        two = starts[(size == 2) & (at_home > 0)]
        hit = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= near]
        found += list(zip(fp[hit], fp[hit + 1], strict=True))
        for at in np.flatnonzero((size > 2) & (at_home > 0)):
            part = slice(starts[at], ends[at])
            found += forest(fp[part], home[part], lambda x, others: np.bitwise_count(others ^ x) <= near)
        return found

    def emit(found: list) -> pa.RecordBatch:
        links = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(links.min(axis=1)), pa.array(links.max(axis=1))], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group of a batch may go on in the next one
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "tile", "fp", "home")]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            split = int(last[-1]) + 1 if len(last) else 0
            held = [x[split:] for x in now]
            if split:
                found = pairs_of(*[x[:split] for x in now])
                if found:
                    yield emit(found)
        if held is not None:
            found = pairs_of(*held)
            if found:
                yield emit(found)

    return run


def in_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """key, tile, fp, home of the rows key, fp, home: what has one key is in one tile,
    or where it is more than ``tile`` rows, each at home meets each other in one."""
    crowds = settle(
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("int")).alias("at_home"))
        .filter((F.col("n") > tile) & (F.col("at_home") > 0))
        .select(
            F.col("key").alias("_key"),
            F.ceil(F.col("n") / tile).cast("int").alias("guests"),
            F.ceil(F.col("at_home") / tile).cast("int").alias("hosts"),
        ),
        "crowded-anchors",
    )
    placed = rows.join(crowds, F.col("key") == F.col("_key"), "left")
    spot = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)).cast("int")
    guests, hosts = F.coalesce("guests", F.lit(1)), F.coalesce("hosts", F.lit(1))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # One at home meets every tile of guests in its own tile of hosts, a guest the reverse.
    host_tiles = F.transform(every(guests), lambda g: g * hosts + spot % hosts)
    guest_tiles = F.transform(every(hosts), lambda h: (spot % guests) * hosts + h)
    tiles = F.when(F.col("guests").isNull(), F.array(F.struct(F.lit(0).alias("tile"), F.col("home").alias("home"))))
    as_struct = lambda xs, home: F.transform(xs, lambda x: F.struct(x.alias("tile"), F.lit(home).alias("home")))
    tiles = tiles.when(F.col("home"), F.concat(as_struct(host_tiles, True), as_struct(guest_tiles, False))).otherwise(
        as_struct(guest_tiles, False)
    )
    return placed.select("key", "fp", F.explode(tiles).alias("t")).select("key", "t.tile", "fp", "t.home")


def near_links(prints: DataFrame, near: int = NEAR, tile: int = TILE) -> DataFrame:
    """Links a, b between the distinct fingerprints ``fp``: they join the same
    fingerprints as the pairs that differ in at most ``near`` (3 or less) bits. The
    ends of one link may differ more, if such pairs lead from one to the other."""
    if not 0 <= near <= NEAR:
        raise ValueError(f"near must lie between 0 and {NEAR}")
    ship()
    spark = prints.sparkSession
    rows = anchored(prints)
    dealt = in_tiles(rows, tile)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "key", "tile")
        .sortWithinPartitions("key", "tile", "fp")
        .mapInArrow(_compare(near), "a bigint, b bigint")
        .distinct()
    )


def _labelled(docs: DataFrame, id_col: str, text_col: str, near: int) -> DataFrame:
    """A row per document: doc_id, text_hash, fp, label, component_id, component_size."""
    prints = settle(fingerprints(docs, id_col, text_col), "fingerprints")
    groups = settle(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprint-groups"
    )
    labels = connected_components(near_links(groups.select("fp"), near))
    labelled = groups.join(labels, groups["fp"] == labels["node"], "left").select(
        "fp", "least", "n", F.coalesce("label", "fp").alias("label")
    )
    labelled = settle(labelled, "fingerprint-labels")
    heads = labelled.groupBy("label").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("component_size")
    )
    return prints.join(labelled.select("fp", "label").join(heads, "label"), "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: int = NEAR
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id,
    component_size.

    Documents are in one component if a chain of links joins them; a link is
    ``near`` or fewer differing bits. ``component_id`` is the smallest doc_id of
    the component, null if all are null. Null and wordless texts have fingerprint
    zero and link as any other. Repeated rows stay rows.
    """
    return _labelled(docs, id_col, text_col, near).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component_size",
    )


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: int = NEAR
) -> DataFrame:
    """One document of each component, with all columns: that of the smallest id,
    and of several texts with that id the one of smallest hash. Rows that repeat
    both leave one row, that of smallest ``row_hash``. Further columns may have any
    names."""

    def key(doc_id: Column, text_hash: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text_hash.cast("string"))

    stays = (
        _labelled(docs, id_col, text_col, near)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label", "doc_id")
        .agg(F.min("text_hash").alias("text_hash"))
        .select(key(F.col("doc_id"), F.col("text_hash")).alias("key"))
    )
    return first_rows(docs, key(F.col(quoted(id_col)), F.xxhash64(text_of(text_col))), stays)
