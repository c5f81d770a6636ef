"""Token files: ids of whole texts, each document compressed on its own against one
shared zstandard dictionary.

A file set is a folder with two tables, so any store that Spark reaches can hold it:

``blocks``  one row per block of some documents, in ascending doc_id order (null
            first) over (part, block). ``payload`` is the block itself: header
            (magic, SHA-256 of the dictionary, number of documents), offset index
            (n + 1 64-bit offsets of the frames), id counts (n 64-bit), then one
            zstandard frame per document: its ids as little-endian unsigned 32-bit
            integers. ``first_id`` and ``last_id`` let a reader skip blocks.
``parts``   one row per part: the number of ids before it, and the dictionary.

A short document is read by its block's index alone: one frame is decompressed.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import settle, ship, text_of, worker_store

MAGIC = b"TLTOKEN1"
HEADER = "<8s32sQ"  # magic, dictionary hash, number of documents
HEADER_BYTES = struct.calcsize(HEADER)
END_ID = 1
BLOCK_BYTES = 1 << 22
#: The dictionary is trained on this many whole documents at most, the first by hash
#: of those up to SAMPLE_CHARS characters.
SAMPLE_DOCUMENTS = 400
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: Texts whose new words are encoded together.
TEXTS_TOGETHER = 512
#: What a Python worker remembers of words and of their letters.
REMEMBERED_WORDS = 800_000
REMEMBERED_CORES = 1_000_000
_SEPARATOR = "<|endoftext|>"
_MARKS = ".,;:!?"


class WordEncoder:
    """Encodes whole texts with a ``tokenizers`` file whose pre-tokenizer drops white
    space and ends every word with a ``</w>`` token, so that a text's ids are those
    of its words, one after the other.

    Words not seen before are encoded together. A word of Latin letters and marks
    after them is remembered by its parts, since the pre-tokenizer separates these
    and lower-cases the letters; runs of letters are one pre-token each, so they go
    in joined by blanks and their ids are cut after each word end. All other words
    are joined by a special token, which is cut out before anything is normalised.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(known.values()) + 1, bool)
        for token, number in known.items():
            self.ends[number] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    @staticmethod
    def _pieces(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)]

    def encode_cores(self, cores: list[str]) -> list[bytes]:
        """Of lower-case runs of Latin letters."""
        out: list[bytes] = []
        groups = [cores[at : at + 1024] for at in range(0, len(cores), 1024)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups]), strict=True):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group):
                out += self._pieces(ids, np.concatenate(([0], ends[:-1])), ends)
            else:
                out += self.encode_words(group)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Of any words without white space."""
        plain = [w for w in words if "<|" not in w]
        found: list[bytes] = []
        for ids in self._ids([_SEPARATOR.join(plain[at : at + 1024]) for at in range(0, len(plain), 1024)]):
            cut = np.flatnonzero(ids == self.separator)
            found += self._pieces(ids, np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(ids)])))
        at = iter(found)
        return [self._ids([w])[0].tobytes() if "<|" in w else next(at) for w in words]

    def learn(self, words: list[str]) -> None:
        if len(self.cores) > REMEMBERED_CORES:
            self.cores.clear()
        split, other = [], []
        for w in words:
            core = w.rstrip(_MARKS)
            if core.isalpha() and max(core) < "\u0100":
                split.append((w, core.lower(), w[len(core) :]))
            else:
                other.append(w)
        cores = self.cores
        new = [c for c in dict.fromkeys(c for _, c, _ in split) if c not in cores]
        cores.update(zip(new, self.encode_cores(new), strict=True))
        marks = [m for m in {m for _, _, m in split} if m and m not in cores]
        cores.update(zip(marks, self.encode_words(marks), strict=True))
        self.words.update((w, cores[c] + cores[m] if m else cores[c]) for w, c, m in split)
        self.words.update(zip(other, self.encode_words(other), strict=True))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Per text its ids and END_ID, as little-endian 32-bit integers."""
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
        known = self.words
        known[""] = b""
        # Only characters that every tokenizer takes for white space cut words.
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        new: set[str] = set()
        for words in cut:
            new.update(set(words).difference(known))
        if new:
            self.learn(sorted(new))
        end = struct.pack("<I", END_ID)
        return [b"".join(map(known.__getitem__, words)) + end for words in cut]


def _encoder(path: str) -> WordEncoder:
    return worker_store(f"tokens:{path}", lambda: WordEncoder(path))


def train_dictionary(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A shared dictionary trained on id arrays of a bounded sample of documents.
    Empty if there are too few to train one; frames then stand alone."""
    ship()
    text = text_of(text_col)
    sample = (
        docs.select(text.alias("text"), F.xxhash64(F.col(id_col), text).alias("order"))
        .filter(F.length("text").between(1, SAMPLE_CHARS))
        .orderBy("order", "text")
        .limit(SAMPLE_DOCUMENTS)
        .coalesce(1)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: list[bytes] = []
        for batch in batches:
            samples += _encoder(tokenizer).encode_batch(batch.column("text").to_pylist())
        try:
            found = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            found = b""
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["dictionary"])

    row = sample.select("text").mapInArrow(run, "dictionary binary").first()
    return bytes(row["dictionary"]) if row else b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=shared)


def pack(frames: list[bytes], counts: list[int], dictionary_hash: bytes) -> bytes:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in frames]))).astype("<u8")
    head = struct.pack(HEADER, MAGIC, dictionary_hash, len(frames))
    return b"".join([head, offsets.tobytes(), np.array(counts, "<u8").tobytes(), *frames])


class Block:
    """A block's index; ``ids(i)`` decompresses document i only."""

    def __init__(self, payload: bytes, dictionary: bytes):
        magic, self.dictionary_hash, n = struct.unpack_from(HEADER, payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        if self.dictionary_hash != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        self.payload = memoryview(payload)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, HEADER_BYTES).tolist()
        self.counts = np.frombuffer(payload, "<u8", n, HEADER_BYTES + 8 * (n + 1)).tolist()
        self.data = HEADER_BYTES + 8 * (2 * n + 1)
        self.reader = _decompressor(dictionary)

    def __len__(self) -> int:
        return len(self.counts)

    def raw(self, i: int) -> bytes:
        frame = self.payload[self.data + self.offsets[i] : self.data + self.offsets[i + 1]]
        return self.reader.decompress(frame, max_output_size=4 * self.counts[i])

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), "<u4")


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Writes the file set of ``docs`` to the new folder ``path``. A null text is
    empty and holds END_ID alone; rows with equal ids are ordered by text hash."""
    ship()
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, id_col, text_col)
    mark = hashlib.sha256(dictionary).digest()
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    names = ["part", "block", "first_id", "last_id", "n_docs", "n_tokens", "doc_ids", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor = _encoder(tokenizer), _compressor(dictionary)
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        frames: list[bytes] = []
        counts: list[int] = []
        size = 0

        def close() -> pa.RecordBatch:
            known = [x for x in ids if x is not None]
            row = [part, number, min(known, default=None), max(known, default=None), len(ids), sum(counts), ids]
            kinds = [pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.list_(pa.int64())]
            columns = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            columns.append(pa.array([pack(frames, counts, mark)], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_TOGETHER):
                part_rows = batch.slice(at, TEXTS_TOGETHER)
                encoded = encoder.encode_batch(part_rows.column("text").to_pylist())
                for doc_id, raw in zip(part_rows.column("doc_id").to_pylist(), encoded, strict=True):
                    ids.append(doc_id)
                    counts.append(len(raw) // 4)
                    frames.append(compressor.compress(raw))
                    size += len(frames[-1])
                    if size >= BLOCK_BYTES:
                        yield close()
                        number, size, ids, frames, counts = number + 1, 0, [], [], []
        if ids:
            yield close()

    schema = (
        "part int, block bigint, first_id bigint, last_id bigint, n_docs bigint, n_tokens bigint, "
        "doc_ids array<bigint>, payload binary"
    )
    placed.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # One row per part, however many documents there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select(
        "part",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"),
        F.lit(dictionary).alias("dictionary"),
    ).write.parquet(f"{path}/parts")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/parts").select("dictionary").first()
    return bytes(row["dictionary"]) if row else b""


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens,
    ids_crc32 (unsigned, of its ids as stored)."""
    ship()
    dictionary = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    upto = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        blocks.select("part", "block", "n_tokens")
        .withColumn("inside", F.coalesce(F.sum("n_tokens").over(upto), F.lit(0)))
        .join(spark.read.parquet(f"{path}/parts").select("part", "before"), "part")
        .select("part", "block", (F.col("before") + F.col("inside")).alias("start")),
        "token-starts",
    )
    rows = blocks.select("part", "block", "doc_ids", "payload").join(starts, ["part", "block"])
    rows = rows.select("doc_ids", "payload", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, payload, start in zip(*batch.columns, strict=True):
                block = Block(payload.as_py(), dictionary)
                count = np.array(block.counts, np.int64)
                begin = start.as_py() + np.cumsum(count) - count
                crc = [zlib.crc32(block.raw(i)) for i in range(len(block))]
                columns = [doc_ids.values, pa.array(begin), pa.array(count), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id: blocks are skipped by their bounds, and
    one frame is decompressed for each hit."""
    dictionary = _dictionary(spark, path)
    found = (
        spark.read.parquet(f"{path}/blocks")
        .filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        .filter(F.array_contains("doc_ids", F.lit(doc_id)))
        .select("doc_ids", "payload")
        .toLocalIterator()
    )
    out = []
    for row in found:
        block = Block(bytes(row["payload"]), dictionary)
        out += [block.ids(i).tolist() for i, x in enumerate(row["doc_ids"]) if x == doc_id]
    return out
