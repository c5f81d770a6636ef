"""Byte-level BPE as a bounded-lookahead streaming transducer, and decoding.

Merging a pair at one place can depend on what follows only through merges of
earlier rank. ``sufficient_lookahead`` follows these chains through the merge list
and bounds how far right they reach: once that many bytes behind a token are known,
no continuation of the text can change the token. So a ``Transducer`` reads a
pre-token in blocks, emits all tokens that are stable and keeps the rest, which is
never longer than lookahead and longest token together.

Pre-tokens are streams of their own. Short ones are run through the merge list
together, in one array; equal ones are remembered. A long text is cut into its
pre-tokens lazily, so memory does not grow with it.

Decoding maps ids to bytes and feeds these to an incremental UTF-8 automaton; a
character may be spread over several tokens and blocks.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, ship, text_of, worker_store

# Fixed value: how the byte-level pre-tokenizer splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"
#: Bytes that a transducer reads before it emits again.
BLOCK = 4096
#: Texts up to this many characters are encoded in batches of about as many.
BATCH_CHARS = 1 << 22
#: Pre-tokens a worker remembers, and their longest length.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48
#: Longest pre-token, in characters, that is encoded together with others.
LONGEST_TOGETHER = 256
#: Ids that are decoded, or emitted for a long text, at a time.
IDS_AT_ONCE = 1 << 16


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable in Latin-1,
    else the next unused letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return [letters[b] for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int, int]], sizes: list[int]) -> int:
    """Bytes behind a token that settle it. ``merges`` lists (left, right, product) by
    rank, ``sizes`` the bytes of each id.

    Whether a merge happens depends on how its two parts came about and on earlier
    merges that take one of them away. ``made[t]``: how far behind its end the making
    of t looks; ``taken_left[t]``, ``taken_right[t]``: how far behind the end of t the
    merges look that have t as their left or right part. All earlier ranks are
    known when a merge is reached, so one pass does.
    """
    made = [0] * len(sizes)
    taken_left = [0] * len(sizes)
    taken_right = [0] * len(sizes)
    for left, right, product in merges:
        behind_right = max(made[right], taken_left[right], taken_right[right])
        behind_left = max(made[left], taken_left[left], taken_right[left]) - sizes[right]
        made[product] = max(0, behind_right, behind_left)
        taken_left[left] = max(taken_left[left], sizes[right] + made[product])
        taken_right[right] = max(taken_right[right], made[product])
    return max(map(max, zip(made, taken_left, taken_right, strict=True)), default=0)


def _unlike_library(tokenizer: str) -> dict[str, str]:
    """Characters that ``regex`` takes for letters or numbers and the library does
    not, since it knows fewer Unicode versions: class to ranges. Only such
    characters can differ as the interpreter's own, older version does not assign."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(tokenizer).pre_tokenizer
    out = {}
    for name, before in (("L", "a"), ("N", "1")):
        kind = regex.compile(rf"\p{{{name}}}")
        new = [
            chr(c)
            for c in range(0x110000)
            if unicodedata.category(chr(c)) == "Cn" and kind.match(chr(c))
        ]
        text = "!".join(before + c for c in new)
        starts = {start for _, (start, _) in split.pre_tokenize_str(text)} if new else set()
        out[name] = _ranges([ord(c) for k, c in enumerate(new) if 3 * k + 1 in starts])
    return out


def _ranges(points: list[int]) -> str:
    """Ascending code points as the ranges of a character class."""
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class MergeList:
    """A byte-level BPE file, ready to encode and decode. Plain data: the driver
    builds it once and broadcasts it; its size is that of the vocabulary.

    With ``special`` the strings of added tokens are cut out of the text first, as
    the library does; without, they are ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, split = said["model"], said["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or said["normalizer"]:
            raise ValueError("only byte-level files without normalizer and prefix space")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in said["added_tokens"]):
            raise ValueError("added tokens must match as they stand")
        self.path, self.special = path, special
        vocabulary = model["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}

        def raw(token: str) -> bytes:
            known = all(c in byte_of for c in token)
            return bytes(byte_of[c] for c in token) if known else token.encode()

        self.raw = [b""] * (max([*vocabulary.values(), *(a["id"] for a in said["added_tokens"])]) + 1)
        for token, number in vocabulary.items():
            self.raw[number] = raw(token)
        self.added = {a["content"]: a["id"] for a in said["added_tokens"]}
        for token, number in self.added.items():
            self.raw[number] = raw(token)
        self.byte_ids = np.array([vocabulary[c] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        rank_of = {product: rank for rank, (_, _, product) in enumerate(merges)}
        if len(rank_of) < len(merges) or any(
            max(rank_of.get(a, -1), rank_of.get(b, -1)) >= rank for rank, (a, b, _) in enumerate(merges)
        ):
            raise ValueError("every merge must make a token of its own out of earlier ones")
        sizes = [len(x) for x in self.raw]
        self.lookahead = sufficient_lookahead(merges, sizes)
        self.longest = max(sizes)
        # Pairs sorted for lookup; one entry past the end for pairs above all.
        left, right, product = (np.array(x, np.int64) for x in zip(*merges, strict=True)) if merges else [np.empty(0, np.int64)] * 3
        order = np.argsort(left << 32 | right)
        never = np.iinfo(np.int64).max
        self.pairs = np.append((left << 32 | right)[order], never)
        self.ranks = np.append(np.arange(len(merges))[order], len(merges)).astype(np.int32)
        self.products = np.append(product, 0).astype(np.int32)
        self.never = len(merges)
        self.byte_ranks = self.rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)
        # The exact classes are slow, so they are used where a text has such characters.
        unlike = _unlike_library(path)
        self.unlike = "".join(unlike.values())
        self.lowest = min((int(x[2:10], 16) for x in unlike.values() if x), default=0)
        self.split = SPLIT.format(L=r"\p{L}", N=r"\p{N}")
        self.exact_split = SPLIT.format(
            **{k: rf"[\p{{{k}}}--[{x}]]" if x else rf"\p{{{k}}}" for k, x in unlike.items()}
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``never`` where it is no merge."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.ranks[at], np.int32(self.never))

    def segment(self, streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all streams, one after the other, and where each stream's end. They
        are merged side by side: in each round every stream merges all places of its
        lowest rank."""
        sizes = np.array([len(s) for s in streams], np.int64)
        letters = np.frombuffer(b"".join(streams), np.uint8)
        ids = self.byte_ids[letters]
        home = np.repeat(np.arange(len(streams), dtype=np.int32), sizes)
        done_ids, done_home = [], []
        # The rank of each place with the next one.
        ranks = np.full(len(ids), self.never, np.int32)
        ranks[:-1] = self.byte_ranks[letters[:-1], letters[1:]]
        ranks[:-1][home[:-1] != home[1:]] = self.never
        while len(ids):
            starts = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1])))
            least = np.minimum.reduceat(ranks, starts)
            size = np.diff(np.append(starts, len(ids)))
            least = np.repeat(least, size)
            settled = least == self.never
            if settled.any():
                done_ids.append(ids[settled])
                done_home.append(home[settled])
                ids, home, ranks, least = (x[~settled] for x in (ids, home, ranks, least))
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == least)
            # In a run of one letter the places overlap: every second one merges.
            begins = np.concatenate(([True], np.diff(hit) != 1))
            run_start = hit[np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))]
            hit = hit[(hit - run_start) % 2 == 0]
            ids[hit] = self.products[ranks[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, home, ranks = ids[keep], home[keep], ranks[keep]
            # Only pairs that hold a merged token change.
            merged = hit - np.arange(len(hit))
            ranks[merged] = self.never
            near = np.concatenate((merged, merged - 1))
            near = near[(near >= 0) & (near < len(ids) - 1)]
            near = near[home[near] == home[near + 1]]
            ranks[near] = self.rank(ids[near], ids[near + 1])
        if not done_ids:
            return np.empty(0, np.int32), np.zeros(len(streams), np.int64)
        home = np.concatenate(done_home)
        flat = np.concatenate(done_ids)[np.argsort(home, kind="stable")]
        return flat, np.cumsum(np.bincount(home, minlength=len(streams)))


class Transducer:
    """Ids of one pre-token that comes in blocks. Between blocks it holds what is not
    stable yet: at most ``lookahead`` and one token's bytes."""

    def __init__(self, merges: MergeList):
        self.merges, self.wait = merges, b""

    def feed(self, data: bytes) -> np.ndarray:
        self.wait += data
        ids, _ = self.merges.segment([self.wait])
        ends = np.cumsum([len(self.merges.raw[i]) for i in ids.tolist()])
        stable = int(np.searchsorted(ends, len(self.wait) - self.merges.lookahead, "right"))
        if stable:
            self.wait = self.wait[int(ends[stable - 1]) :]
        return ids[:stable]

    def finish(self) -> np.ndarray:
        ids, _ = self.merges.segment([self.wait])
        self.wait = b""
        return ids


class TextDecoder:
    """Text of ids that come in blocks. Bytes that are no UTF-8 become U+FFFD, one for
    each longest part of a character; unknown ids leave nothing."""

    def __init__(self, merges: MergeList):
        self.raw = merges.raw
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.raw)):
            ids = ids[(ids >= 0) & (ids < len(self.raw))]
        return self.state.decode(b"".join(map(self.raw.__getitem__, ids.tolist())))

    def finish(self) -> str:
        return self.state.decode(b"", True)


class Encoder:
    """Encodes texts; remembers the ids of short pre-tokens between batches."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.plain_split = regex.compile(merges.split, regex.V1)
        self.exact_split = regex.compile(merges.exact_split, regex.V1)
        self.unlike = re.compile(f"[{merges.unlike}]") if merges.unlike else None
        self.lowest = merges.lowest
        names = sorted(merges.added, key=len, reverse=True) if merges.special else []
        self.added = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> regex.Pattern:
        if text.isascii() or not self.unlike:
            return self.plain_split
        units = np.frombuffer(text.encode("utf-16-le"), "<u2")
        return self.exact_split if units.max() >= self.lowest and self.unlike.search(text) else self.plain_split

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at added tokens: part, and whether it is one."""
        if self.added is None:
            yield text, False
            return
        at = 0
        for match in self.added.finditer(text):
            yield text[at : match.start()], False
            yield match.group(), True
            at = match.end()
        yield text[at:] if at else text, False

    def learn(self, words: set[str]) -> list[str]:
        """Makes all of ``words`` known; returns those to forget after use."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known.update((a, n.to_bytes(4, "little")) for a, n in self.merges.added.items() if self.added)
        new = words.difference(self.known)
        short = sorted(w for w in new if len(w) <= LONGEST_TOGETHER)
        for at in range(0, len(short), 1 << 14):
            some = short[at : at + (1 << 14)]
            flat, ends = self.merges.segment([w.encode() for w in some])
            raw, ends = flat.astype("<u4").tobytes(), (4 * ends).tolist()
            self.known.update((w, raw[a:b]) for w, a, b in zip(some, [0, *ends], ends))
        self.known.update((w, b"".join(self.long_word(w))) for w in new if len(w) > LONGEST_TOGETHER)
        return [w for w in new if len(w) > LONGEST_REMEMBERED]

    def forget(self, words: list[str]) -> None:
        for w in words:
            del self.known[w]

    def long_word(self, word: str) -> Iterator[bytes]:
        machine = Transducer(self.merges)
        for at in range(0, len(word), BLOCK):
            yield machine.feed(word[at : at + BLOCK].encode()).astype("<u4").tobytes()
        yield machine.finish().astype("<u4").tobytes()

    def joined(self, words: list[str]) -> bytes:
        """The ids of pre-tokens one after the other."""
        used_once = self.learn(set(words))
        out = b"".join(map(self.known.__getitem__, words))
        self.forget(used_once)
        return out

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text of any length in blocks, as little-endian 32-bit integers."""
        words: list[str] = []
        split = self.split(text)
        for part, is_added in self.parts(text):
            if is_added:
                yield self.joined(words) + self.merges.added[part].to_bytes(4, "little")
                words = []
                continue
            for match in split.finditer(part):
                start, end = match.span()
                if end - start > LONGEST_TOGETHER:
                    yield self.joined(words)
                    words = []
                    machine = Transducer(self.merges)
                    for at in range(start, end, BLOCK):
                        yield machine.feed(part[at : min(end, at + BLOCK)].encode()).astype("<u4").tobytes()
                    yield machine.finish().astype("<u4").tobytes()
                else:
                    words.append(part[start:end])
                    if len(words) == 1 << 14:
                        yield self.joined(words)
                        words = []
        yield self.joined(words)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        cut: list[list[str]] = []
        for text in texts:
            words: list[str] = []
            split = self.split(text)
            for part, is_added in self.parts(text):
                words += [part] if is_added else split.findall(part)
            cut.append(words)
        used_once = self.learn(set().union(*cut))
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        self.forget(used_once)
        return out


def _shared(spark: SparkSession, path: str, special: bool) -> Broadcast:
    return spark.sparkContext.broadcast(vars(MergeList(path, special)))


def _encoder(shared: Broadcast) -> Encoder:
    def make() -> Encoder:
        merges = MergeList.__new__(MergeList)
        merges.__dict__.update(shared.value)
        return Encoder(merges)

    return worker_store(f"bpe:{shared.value['path']}:{shared.value['special']}", make)


def _blocks(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[int, str, Iterator[bytes]]]:
    """Row, text and blocks of ids, in row order; short texts are encoded together."""
    column = batch.column("text")
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    first = 0
    while first < len(column):
        last, size = first, 0
        while last < len(column) and (last == first or size + sizes[last] <= BATCH_CHARS):
            size += int(sizes[last])
            last += 1
        texts = column.slice(first, last - first).to_pylist()
        if size > BATCH_CHARS:
            yield first, texts[0], encoder.stream(texts[0])
        else:
            for at, (text, ids) in enumerate(zip(texts, encoder.encode_batch(texts), strict=True), first):
                yield at, text, iter((ids,))
        first = last


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), text_of(text_col).alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", special: bool = True
) -> DataFrame:
    """doc_id and ids, an array of token ids; one row per row. A null text is empty
    and has no ids. Repeated rows and null ids of documents stay as they are."""
    ship()
    shared = _shared(docs.sparkSession, tokenizer, special)
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for row, _, blocks in _blocks(encoder, batch):
                ids = np.frombuffer(b"".join(blocks), "<u4").astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, 1), found], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text from doc_id and ids. Null ids of a row give an empty text, null
    and unknown ids in the array leave nothing."""
    ship()
    shared = _shared(encoded.sparkSession, tokenizer, True)
    rows = encoded.select("doc_id", F.expr("filter(coalesce(ids, array()), x -> x is not null)").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _encoder(shared).merges
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                machine, ids = TextDecoder(merges), ids.values.to_numpy(zero_copy_only=False)
                parts = [machine.feed(ids[at : at + IDS_AT_ONCE]) for at in range(0, len(ids), IDS_AT_ONCE)]
                texts.append("".join([*parts, machine.finish()]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (decoded text in UTF-8), same (whether that is the text).

    Ids are decoded block by block as they come, and neither is stored. A null text is
    empty; repeated rows stay."""
    ship()
    shared = _shared(docs.sparkSession, tokenizer, True)
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            counts, of_ids, of_text, same = [], [], [], []
            for _, text, blocks in _blocks(encoder, batch):
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                machine = TextDecoder(encoder.merges)
                for block in blocks:
                    ids_hash.update(block)
                    ids = np.frombuffer(block, "<u4")
                    n += len(ids)
                    for at in range(0, len(ids), IDS_AT_ONCE):
                        text_hash.update(machine.feed(ids[at : at + IDS_AT_ONCE]).encode())
                text_hash.update(machine.finish().encode())
                counts.append(n)
                of_ids.append(ids_hash.hexdigest())
                of_text.append(text_hash.hexdigest())
                same.append(text_hash.digest() == hashlib.sha256(text.encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, same boolean")
