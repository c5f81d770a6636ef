"""Alignment of two tokenizers over the same bytes, in Arrow.

Tokenizer A is a byte-level BPE file and reads a space and the text; tokenizer B is a
piece model, which puts that space there itself. A batch of texts becomes two list
columns of ids. These are flattened, with the index of the text beside each token, and
segmented cumulative sums of token lengths give the bytes at which tokens end. A full
outer hash join on (text, end) lays both on one scale: every row is one link between
the token of A and the token of B that lie there, and a row that both sides have ends a
group. Links are counted by ``Table.group_by`` within a batch and summed by Spark.

What is worth broadcasting of the counts is bounded: the most frequent pairs, at most
``FREQUENT``, are looked up where the links lie; links of all other pairs are rows that
Spark joins with the counts. Such a pair is rare, so no key of that join is hot.

A long text is cut before a space behind another character. Both tokenizers always part
there, so the slices' tokens are those of the text and memory stays bounded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import bpe
from tickloom.llm.common import quoted, settle, ship, text_of, worker_store
from tickloom.llm.pieces import BYTE, MARK, USER_DEFINED, _fields, read_pieces

#: Pairs whose counts are broadcast, at most.
FREQUENT = 1 << 18
#: Characters that are aligned at a time, and of a slice of a long text.
BATCH_CHARS = 1 << 19
#: Rows whose links are looked up at a time.
ROWS_AT_ONCE = 1024

#: Segments of B that a worker remembers, and their longest length.
REMEMBERED = 250_000
LONGEST_REMEMBERED = 48

#: A segment of B: blanks and what follows up to the next blank.
_SEGMENT = re.compile(r" *[^ ]+| +")
#: A place where both tokenizers part whatever comes before and behind.
_CUT = re.compile(r"(?<=[^\W_])(?= )")

_ROW = (
    "part int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "links_a binary, links_b binary"
)


class PieceEncoder:
    """Ids of strings that begin with the space which the model puts before a text. No
    piece holds a marker behind another character, and nothing is normalised, so a slice
    that begins with a space has the ids it has within its text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = read_pieces(path)
        with open(path, "rb") as file:
            normal = next((dict(_fields(v)) for n, v in _fields(file.read()) if n == 3), {})
        if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1):
            raise ValueError("only models that add a space and change nothing else")
        if any(k == USER_DEFINED or MARK in p.lstrip(MARK) for p, _, k in pieces):
            raise ValueError("only models whose pieces hold markers in front alone")
        self.raw = [bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, _, k in pieces]
        self.blank = self.library.piece_to_id(MARK)
        self.known: dict[str, bytes] = {}

    def learn(self, segments: set[str]) -> list[str]:
        """Makes all segments known; returns those to forget after use."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = sorted(segments.difference(self.known))
        found = self.library.encode([s[1:] for s in new], num_threads=1)
        sizes = [len(x) for x in found]
        raw = np.fromiter((i for x in found for i in x), "<u4", sum(sizes)).tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        self.known.update((s, raw[a:b]) for s, a, b in zip(new, [0, *ends], ends))
        self.known[" "] = self.blank.to_bytes(4, "little")  # the library gives nothing for no text
        return [s for s in new if len(s) > LONGEST_REMEMBERED]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers: those of its segments,
        of which equal ones are remembered."""
        cut = [_SEGMENT.findall(t) for t in texts]
        used_once = self.learn(set().union(*cut))
        out = [b"".join(map(self.known.__getitem__, segments)) for segments in cut]
        for s in used_once:
            del self.known[s]
        return out


def _offsets(raw: list[bytes]) -> np.ndarray:
    """Where each text's ids begin among all ids, and their end."""
    return np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw]))).astype(np.int32)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _id_lists(raw: list[bytes]) -> pa.ListArray:
    return _lists(_offsets(raw), pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32)))


class Aligner:
    """Both encoders, their tokens' lengths, and ids as text."""

    def __init__(self, merges: bpe.MergeList, model: str):
        self.first, self.second = bpe.Encoder(merges), PieceEncoder(model)
        self.sizes = [pa.array([len(x) for x in raw], pa.int64()) for raw in (merges.raw, self.second.raw)]
        self.names = pa.array([str(i) for i in range(max(map(len, self.sizes)))], pa.string())
        self.kind = "<u2" if len(self.names) <= 1 << 16 else "<u4"
        self.bytes = pa.array(self.second.raw, pa.binary())

    def encode(self, texts: list[str]) -> list[list[bytes]]:
        """The ids of A and of B for each text; texts of which B's tokens hold other bytes
        get none. (A's bytes are always the text's.)"""
        first = self.first.encode_batch(texts)
        second = self.second.encode_batch(texts)
        lists = _id_lists(second)
        ends = np.append(0, np.cumsum(pc.take(self.sizes[1], lists.values).to_numpy()))[lists.offsets.to_numpy()]
        spelled = bytes(memoryview(pc.take(self.bytes, lists.values).buffers()[2] or b"")[: ends[-1]])
        raw = [t.encode() for t in texts]
        if spelled != b"".join(raw) or np.diff(ends).tolist() != list(map(len, raw)):
            for at, text in enumerate(raw):
                if spelled[ends[at] : ends[at + 1]] != text:
                    first[at] = second[at] = b""
        return [first, second]

    def ends(self, ids: pa.ListArray, side: int) -> tuple[pa.Array, pa.Array]:
        """All ids, and for each its text's place and the byte at which it ends, as one
        number: place << 32 | end."""
        flat, place = pc.list_flatten(ids), pc.list_parent_indices(ids)
        upto = pc.cumulative_sum(pc.take(self.sizes[side], flat))
        # Segmented: what the texts before a text's own sum up to is taken off again.
        before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), upto]), ids.offsets)
        end = pc.subtract(upto, pc.take(before, place))
        return flat, pc.add(pc.shift_left(pc.cast(place, pa.int64()), pa.scalar(32, pa.int64())), end)

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, bytes, bytes]]:
        """Per text: tokens of A and of B, groups, links, the groups as text, and the ids of
        A and of B of every link in order, as little-endian integers of ``kind``."""
        sides = [_id_lists(x) for x in self.encode(texts)]
        tables, flats = [], []
        for side, ids in enumerate(sides):
            flat, key = self.ends(ids, side)
            flats.append(flat)
            at = pa.array(np.arange(len(flat), dtype=np.int32))
            tables.append(pa.table({"key": key, f"at_{side}": at}))
        links = tables[0].join(tables[1], "key", join_type="full outer", use_threads=False)
        links = links.sort_by("key")
        ats = [links.column(f"at_{side}").combine_chunks() for side in (0, 1)]
        common = pc.and_(ats[0].is_valid(), ats[1].is_valid())
        home = pa.table({"home": pc.shift_right(links.column("key"), pa.scalar(32, pa.int64())), "common": common})
        found = home.group_by("home", use_threads=False).aggregate([("common", "sum"), ("common", "count")])
        counts = np.zeros((2, len(texts)), np.int64)
        for row, name in enumerate(("common_sum", "common_count")):
            counts[row, found.column("home").to_numpy()] = found.column(name).to_numpy()
        # The token that lies over a link is the next of its side to end.
        linked = [pc.take(flat, pc.fill_null_backward(at)) for flat, at in zip(flats, ats, strict=True)]
        grouped = []
        for flat, at in zip(flats, ats, strict=True):
            stops = np.append(0, at.filter(common).to_numpy() + 1)
            grouped.append(pc.binary_join(_lists(stops, pc.take(self.names, flat)), ","))
        groups = pc.binary_join_element_wise(*grouped, "|")
        groups = pc.binary_join(_lists(np.append(0, np.cumsum(counts[0])), groups), ";")
        raw = [x.to_numpy().astype(self.kind).tobytes() for x in linked]
        edges = (np.append(0, np.cumsum(counts[1])) * np.dtype(self.kind).itemsize).tolist()
        sizes = [np.diff(ids.offsets.to_numpy()).tolist() for ids in sides]
        for at, text in enumerate(groups.to_pylist()):
            of_a, of_b = (x[edges[at] : edges[at + 1]] for x in raw)
            yield sizes[0][at], sizes[1][at], int(counts[0, at]), int(counts[1, at]), text, of_a, of_b


def slices(text: str, size: int = BATCH_CHARS) -> list[str]:
    """The text, cut after every ``size`` characters or so where both tokenizers part."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]] if at else [text]


def _aligned(aligner: Aligner, texts: list[str]) -> Iterator[tuple]:
    """Place of the text, part, and the columns of ``_ROW``. Empty texts are left out of the
    work; of a long text every slice is tried before the first is aligned."""
    wait: list[tuple[int, str]] = []

    def settled() -> Iterator[tuple]:
        found = aligner.align([" " + text for _, text in wait])
        for (place, _), (*numbers, groups, a, b) in zip(wait, found, strict=True):
            yield place, 0, *numbers, hashlib.sha256(groups.encode()).hexdigest() if numbers[0] else "", a, b
        wait.clear()

    size = 0
    for place, text in enumerate(texts):
        if not text:
            yield place, 0, 0, 0, 0, 0, "", b"", b""
        elif len(text) <= BATCH_CHARS:
            wait.append((place, text))
            size += len(text)
            if size > BATCH_CHARS:
                yield from settled()
                size = 0
        else:
            parts = slices(" " + text)
            if not all(aligner.encode([part])[0][0] for part in parts):
                yield place, 0, 0, 0, 0, 0, "", b"", b""
                continue
            digest = hashlib.sha256()
            for number, part in enumerate(parts):
                *numbers, groups, a, b = next(aligner.align([part]))
                digest.update((";" if number else "").encode() + groups.encode())
                last = digest.hexdigest() if number == len(parts) - 1 else None
                yield place, number, *numbers, last, a, b
    if wait:
        yield from settled()


def links(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per text, or per slice of a long one: row_id (of the row of ``docs``), doc_id,
    part, n_a, n_b, n_groups, n_links, groups_sha256 (null but for the last slice), and the
    ids of A and of B of every link, links_a and links_b."""
    ship()
    spark = docs.sparkSession
    shared = bpe._shared(spark, tokenizer, special=False)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(quoted(id_col)).cast("bigint").alias("doc_id"),
        text_of(text_col).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_store(
            f"align:{tokenizer}:{model}", lambda: Aligner(bpe._encoder(shared).merges, model)
        )
        for batch in batches:
            out = []
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                ids = [part.column(c).to_pylist() for c in ("row_id", "doc_id")]
                for place, *row in _aligned(aligner, part.column("text").to_pylist()):
                    out.append((ids[0][place], ids[1][place], *row))
                    if len(out) == 256 or row[4] > 1 << 16:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    return rows.mapInArrow(run, f"row_id bigint, doc_id bigint, {_ROW}")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [*[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 4, pa.string(), *[pa.binary()] * 2]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    names = ["row_id", "doc_id", "part", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links_a", "links_b"]
    return pa.RecordBatch.from_arrays(arrays, names)


def _keys(batch: pa.RecordBatch, width: int, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows at a time: the rows, the pair of every link as one number, and where each
    row's links begin."""
    for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
        rows = batch.slice(begin, ROWS_AT_ONCE)
        a, b = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c in ("links_a", "links_b"))
        edges = np.append(0, np.cumsum(pc.binary_length(rows.column("links_a")).to_numpy())) // np.dtype(kind).itemsize
        yield rows, a.astype(np.int64) * width + b, edges


def pair_counts(linked: DataFrame, width: int, kind: str) -> DataFrame:
    """pair (A's id times ``width`` plus B's), n (links of that pair), best (whether no pair
    of that id of B has more). ``width`` is the size of B's vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, keys, _ in _keys(batch, width, kind):
                counted = pa.table({"pair": keys}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
                found.append(counted)
            found = pa.concat_tables(found).group_by("pair", use_threads=False).aggregate([("pair_count", "sum")])
            found = found.rename_columns(["pair", "pair_count"])
            yield from found.select(["pair", "pair_count"]).rename_columns(["pair", "n"]).combine_chunks().to_batches()

    partial = linked.select("links_a", "links_b").mapInArrow(run, "pair bigint, n bigint")
    counts = settle(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    counts = counts.withColumn("b", F.col("pair") % width)
    most = settle(counts.groupBy("b").agg(F.max("n").alias("most")), "most-linked")
    return settle(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def frequent_pairs(counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The pairs that have at least 2^k links, for the least k that leaves no more than
    ``most`` of them."""
    power = F.floor(F.log2("n")).cast("int")
    by_power = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    sizes = {r.power: r.pairs for r in by_power}  # at most 63 rows
    least, total = 63, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    return counts.filter(F.col("n") >= F.lit(1 << least) if least < 63 else F.lit(False))


def scored(linked: DataFrame, counts: DataFrame, width: int, kind: str, frequent: int = FREQUENT) -> DataFrame:
    """One row per row_id: doc_id, the sums over its slices, n_best, count_sum, groups_sha256."""
    top = frequent_pairs(counts, frequent).orderBy("pair").toArrow()
    shared = linked.sparkSession.sparkContext.broadcast(
        (top.column("pair").to_numpy(), top.column("n").to_numpy(), top.column("best").to_numpy(zero_copy_only=False))
    )
    kept = ["row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        known = pa.array(pairs)
        for rows, keys, edges in (x for batch in batches for x in _keys(batch, width, kind)):
            place = pc.index_in(pa.array(keys), value_set=known)
            rare = place.is_null().to_numpy(zero_copy_only=False)
            place = place.fill_null(len(pairs)).to_numpy()

            def summed(values: np.ndarray, place=place, edges=edges) -> pa.Array:
                upto = np.append(0, np.cumsum(np.append(values.astype(np.int64), 0)[place]))
                return pa.array(np.diff(upto[edges]))

            rest = _lists(np.append(0, np.cumsum(rare))[edges], pa.array(keys[rare]))
            columns = [*[rows.column(c) for c in kept], summed(best), summed(n), rest]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_best", "count_sum", "rare"])

    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    fields = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in [*kept, "n_best", "count_sum"])
    found = settle(linked.select(*kept, "links_a", "links_b").mapInArrow(run, f"{fields}, rare array<bigint>"), "scored")
    others = found.select("row_id", F.explode("rare").alias("pair")).groupBy("row_id", "pair").agg(F.count(F.lit(1)).alias("m"))
    others = others.join(counts, "pair").select(
        "row_id", F.when(F.col("best"), F.col("m")).otherwise(0).alias("n_best"), (F.col("m") * F.col("n")).alias("count_sum")
    )
    return (
        found.drop("rare")
        .unionByName(others, allowMissingColumns=True)
        .groupBy("row_id")
        .agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums], F.max("groups_sha256").alias("groups_sha256"))
    )


def aligned_documents(
    docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null, empty, or whose pieces hold other bytes have no tokens: all
    numbers 0 and groups_sha256 empty. Repeated rows stay, null ids too. Memory grows with
    the longest run without a space only (B's library takes it whole).
    """
    linked = settle(links(docs, tokenizer, model, id_col, text_col), "links")
    width = len(read_pieces(model))
    kind = "<u2" if max(width, len(bpe.MergeList(tokenizer, special=False).raw)) <= 1 << 16 else "<u4"
    return scored(linked, pair_counts(linked, width, kind), width, kind, frequent).drop("row_id")
