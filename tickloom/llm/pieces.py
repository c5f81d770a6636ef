"""Unigram pieces: encoding by Viterbi over a double-array trie, decoding, and
counting by Viterbi over the matches of an Aho-Corasick automaton.

The text is escaped first: a blank becomes the marker U+2581, and one marker goes
before the text unless that is empty. No piece holds a marker after another
character, so a text falls into segments, each a run of markers and what follows
up to the next marker, and the best path of a text is made of the best paths of
its segments. That is what makes it cheap: equal segments are computed once.

Scores add up within a segment, in double precision. Of paths with equal scores
to one place, the one whose last piece starts first wins. A character that is no
piece costs ``UNKNOWN_PENALTY`` more than the worst piece and becomes its UTF-8
bytes; control pieces never match.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import ship, text_of, worker_store

# Fixed values of the model file.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Segments that a Python worker remembers the count of, and their longest length.
REMEMBERED = 800_000
LONGEST_REMEMBERED = 48
#: Longest segment, in bytes, that is encoded together with others, and how many.
LONGEST_TOGETHER = 40
TOGETHER = 1 << 14
#: Texts are encoded in batches of about this many characters.
BATCH_CHARS = 1 << 24


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, from a piece model file."""
    with open(path, "rb") as file:
        data = file.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            out.append((own[1].decode("utf-8"), score, own.get(3, NORMAL)))
    return out


class Trie:
    """Double-array trie over UTF-8 bytes. Node n has the child for byte b at
    base[n] + b if check there is n; ``ids`` holds a piece's id at its last node,
    else -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        size = 1 << 12
        base, check, ids = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        lowest_free = highest = 257  # so that a place less a label stays positive
        # Each entry: node, its keys, and how many bytes of them lead to the node.
        wait = [(0, sorted(keys), 0)]
        while wait:
            node, group, depth = wait.pop()
            children: dict[int, list] = {}
            for key, number in group:
                if len(key) == depth:
                    ids[node] = number
                else:
                    children.setdefault(key[depth], []).append((key, number))
            if not children:
                continue
            labels = list(children)
            while lowest_free < len(check) and check[lowest_free] != -1:
                lowest_free += 1
            # Single children fill the gaps; larger families look near the end, where
            # a fit is found at once.
            place = max(1, (lowest_free if len(labels) == 1 else max(lowest_free, highest - 40)) - labels[0])
            while True:
                if place + 256 >= len(check):
                    grow = len(check)
                    base += [0] * grow
                    check += [-1] * grow
                    ids += [-1] * grow
                if all(check[place + b] == -1 for b in labels):
                    break
                place += 1
            base[node] = place
            highest = max(highest, place + labels[-1])
            for b in labels:
                check[place + b] = node
            wait += [(place + b, part, depth + 1) for b, part in children.items()]
        self.base, self.check, self.ids = (np.array(x, np.int32) for x in (base, check, ids))


class Vocabulary:
    """The pieces of a model, ready to encode and decode. Plain data: the driver
    builds it once and broadcasts it; its size is that of the vocabulary."""

    def __init__(self, path: str):
        pieces = read_pieces(path)
        self.path = path
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        usable = [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER_DEFINED) and p]
        normal = [s for _, s, k in pieces if k == NORMAL]
        top = max(normal, default=0.0)
        self.scores = [s for _, s, _ in pieces]
        for p, _, i in usable:  # pieces given by the user always win
            if self.kinds[i] == USER_DEFINED:
                self.scores[i] = len(p.encode()) * top - 0.1
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = [-1] * 256
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        self.raw = [p.encode() for p in self.pieces]
        for i, k in enumerate(self.kinds):
            if k == BYTE:
                self.raw[i] = bytes([int(self.pieces[i][1:-1], 16)])
            elif k == UNKNOWN:
                self.raw[i] = " \u2047 ".encode()
            elif k == CONTROL:
                self.raw[i] = b""
        self.unknown_id = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.has_bytes = min(self.byte_ids) >= 0
        self.by_segment = not any(MARK in p.lstrip(MARK) for p, _, _ in usable)
        # A line break that no piece holds is a segment of its own.
        self.line_break_alone = not any("\n" in p for p, _, _ in usable)
        trie = Trie([(p.encode(), i) for p, _, i in usable])
        self.base, self.check, self.ids = trie.base, trie.check, trie.ids


def escaped(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def segments(vocabulary: Vocabulary, text: str) -> list[str]:
    """The parts of a text that no piece crosses."""
    whole = escaped(text)
    if not whole:
        return []
    if not vocabulary.by_segment:
        return [whole]
    out, run = [], ""
    for part in whole.split(MARK)[1:]:
        run += MARK
        if part:
            out.append(run + part)
            run = ""
    if run:
        out.append(run)
    if vocabulary.line_break_alone and "\n" in text:
        cut: list[str] = []
        for x in out:
            cut += [y for y in re.split("(\n)", x) if y] if "\n" in x else [x]
        return cut
    return out


class Encoder:
    """Encodes segments by Viterbi over the trie."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.lists = [x.tolist() for x in (v.base, v.check, v.ids)]
        self.score_of = np.array(v.scores)

    def viterbi(self, segment: str) -> list[int]:
        """One segment of any length, byte by byte."""
        base, check, ids = self.lists
        scores = self.v.scores
        data = segment.encode("utf-8", "surrogatepass")
        n, limit = len(data), len(check)
        best = [0.0] * (n + 1)
        came = [-1] * (n + 1)
        piece = [-1] * (n + 1)
        at = 0
        while at < n:
            lead = data[at]
            step = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            score, node, whole = best[at], 0, False
            for end in range(at, n):
                child = base[node] + data[end]
                if child >= limit or check[child] != node or not base[node]:
                    break
                node = child
                found = ids[node]
                if found >= 0:
                    to = end + 1
                    now = score + scores[found]
                    if came[to] < 0 or now > best[to]:
                        best[to], came[to], piece[to] = now, at, found
                    whole = whole or to - at == step
            if not whole:
                to, now = min(at + step, n), score + self.v.unknown_score
                if came[to] < 0 or now > best[to]:
                    best[to], came[to], piece[to] = now, at, -1
            at += step
        out: list[int] = []
        at = n
        while at > 0:
            start = came[at]
            if piece[at] >= 0:
                out.append(piece[at])
            elif self.v.has_bytes:
                out += [self.v.byte_ids[b] for b in reversed(data[start:at])]
            else:
                out.append(self.v.unknown_id)
            at = start
        return out[::-1]

    def viterbi_many(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Short segments all at once: their ids one after the other, and the number
        of ids of each.

        Rows advance together: place by place, the trie is walked for all rows that
        have a path to the place and still match.
        """
        base, check, ids = self.v.base, self.v.check, self.v.ids
        count, size = len(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        width = int(size.max())
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), np.uint8).reshape(count, width)
        best = np.full((width + 1, count), -np.inf)
        came = np.zeros((width + 1, count), np.int16)
        piece = np.full((width + 1, count), -1, np.int32)
        best[0] = 0.0
        step = np.zeros(count, np.int64)
        for at in range(width):
            every = rows = np.flatnonzero((size > at) & (best[at] > -np.inf))
            node = np.zeros(len(rows), np.int32)
            lead = data[rows, at]
            step[rows] = 1 + (lead >= 0xC0) + (lead >= 0xE0).astype(int) + (lead >= 0xF0)
            whole = np.zeros(count, bool)
            for end in range(at, width):
                live = size[rows] > end
                rows, node = rows[live], node[live]
                if not len(rows):
                    break
                child = base[node] + data[rows, end]
                fits = (child < len(check)) & (base[node] > 0)
                fits &= check[np.where(fits, child, 0)] == node
                rows, node = rows[fits], child[fits]
                found = ids[node]
                ends = found >= 0
                to = end + 1
                hit, found = rows[ends], found[ends]
                now = best[at, hit] + self.score_of[found]
                better = now > best[to, hit]
                won = hit[better]
                best[to, won], came[to, won], piece[to, won] = now[better], at, found[better]
                whole[hit[step[hit] == to - at]] = True
            odd = every[~whole[every]]
            to = np.minimum(at + step[odd], size[odd])
            now = best[at, odd] + self.v.unknown_score
            better = now > best[to, odd]
            to, odd = to[better], odd[better]
            best[to, odd], came[to, odd], piece[to, odd] = now[better], at, -1
        # Back from the end: the ids of a row are found last one first.
        out = np.zeros((count, width), np.int32)
        number = np.zeros(count, np.int64)
        at = size.copy()
        byte_ids = np.array(self.v.byte_ids, np.int32)
        rows = np.flatnonzero(at > 0)
        while len(rows):
            place = at[rows]
            start, found = came[place, rows].astype(np.int64), piece[place, rows]
            for back in range(1, 5 if self.v.has_bytes else 2):
                known = found >= 0
                take = (known & (back == 1)) | (~known & (place - back >= start))
                own = rows[take]
                if self.v.has_bytes:
                    other = byte_ids[data[own, place[take] - back]]
                else:
                    other = np.full(len(own), self.v.unknown_id, np.int32)
                out[own, number[own]] = np.where(known[take], found[take], other)
                number[own] += 1
            at[rows] = start
            rows = rows[start > 0]
        filled = np.arange(width)[::-1] < number[:, None]
        return out[:, ::-1][filled], number

    def table(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One array of ids, and where in it those of each segment start and how
        many they are."""
        raw = [x.encode("utf-8", "surrogatepass") for x in parts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(sizes, kind="stable")
        short = int((sizes <= LONGEST_TOGETHER).sum())
        flat: list[np.ndarray] = [np.zeros(0, np.int32)]
        numbers: list[np.ndarray] = [np.zeros(0, np.int64)]
        for first in range(0, short, TOGETHER):
            found, number = self.viterbi_many([raw[i] for i in order[first : min(first + TOGETHER, short)]])
            flat.append(found)
            numbers.append(number)
        for i in order[short:]:
            found = np.array(self.viterbi(parts[i]), np.int32)
            flat.append(found)
            numbers.append(np.array([len(found)]))
        number = np.concatenate(numbers)
        starts, count = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        starts[order], count[order] = np.cumsum(number) - number, number
        return np.concatenate(flat), starts, count

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text. A segment that occurs several times in the batch is
        computed once."""
        number: dict[str, int] = defaultdict(lambda: len(number))
        uses = []
        for text in texts:
            own = segments(self.v, text or "")
            uses.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
        ids, starts, sizes = self.table(list(number))
        out = []
        for use in uses:
            long = sizes[use]
            upto = np.cumsum(long)
            shift = np.repeat(starts[use] - (upto - long), long)
            out.append(ids[shift + np.arange(len(shift))])
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of the ids: byte pieces join to characters, markers become blanks,
    the first of them goes. Control pieces give nothing."""
    text = b"".join([vocabulary.raw[i] for i in ids]).decode("utf-8", "replace")
    return (text[1:] if text.startswith(MARK) else text).replace(MARK, " ")


class Counter:
    """Counts the pieces of the best path without keeping it. The automaton gives
    all pieces that end at a place; best score and count are carried along."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(vocabulary.pieces):
            if vocabulary.kinds[i] in (NORMAL, USER_DEFINED) and p:
                self.automaton.add_word(p, (len(p), vocabulary.scores[i]))
        self.automaton.make_automaton()
        self.memory: dict[str, int] = {}

    def viterbi(self, segment: str) -> int:
        n = len(segment)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        # Per place, the length of the last piece, for ties: the longer one starts first.
        last = [0] * (n + 1)
        done = 0
        single = False

        def close(to: int) -> None:
            """The unknown character before ``to`` competes last, if it is no piece."""
            if not single:
                now = best[to - 1] + self.v.unknown_score
                if best[to] is None or now > best[to]:
                    best[to] = now
                    own = segment[to - 1].encode("utf-8", "surrogatepass")
                    count[to] = count[to - 1] + (len(own) if self.v.has_bytes else 1)

        for end, (size, score) in self.automaton.iter(segment):
            to = end + 1
            while done < to - 1:
                done += 1
                close(done)
                single = False
            start = to - size
            now = best[start] + score
            if best[to] is None or now > best[to] or (now == best[to] and size > last[to]):
                best[to], count[to], last[to] = now, count[start] + 1, size
            single = single or size == 1
        while done < n:
            done += 1
            close(done)
            single = False
        return count[n]

    def count(self, text: str | None) -> int:
        total = 0
        memory = self.memory
        for segment in segments(self.v, text or ""):
            found = memory.get(segment)
            if found is None:
                found = self.viterbi(segment)
                if len(segment) <= LONGEST_REMEMBERED:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    memory[segment] = found
            total += found
        return total


def _shared(spark: SparkSession, model: str) -> Broadcast:
    """The vocabulary as plain values, so that workers need no class to load it."""
    return spark.sparkContext.broadcast(vars(Vocabulary(model)))


def _vocabulary(shared: Broadcast) -> Vocabulary:
    v = Vocabulary.__new__(Vocabulary)
    v.__dict__.update(shared.value)
    return v


def _encoder(shared: Broadcast) -> Encoder:
    return worker_store(f"encoder:{shared.value['path']}", lambda: Encoder(_vocabulary(shared)))


def _counter(shared: Broadcast) -> Counter:
    return worker_store(f"counter:{shared.value['path']}", lambda: Counter(_vocabulary(shared)))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts in parts of about BATCH_CHARS; a longer text is a part alone."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        first, size = 0, 0
        for at, text in enumerate(texts):
            size += len(text)
            if size >= BATCH_CHARS or at == len(texts) - 1:
                yield batch.column("doc_id").slice(first, at + 1 - first), texts[first : at + 1]
                first, size = at + 1, 0


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids, an array of piece ids; one row per row. A null text is empty
    and has no ids."""
    ship()
    shared = _shared(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for doc_ids, texts in _batches(batches):
            found = encoder.encode_batch(texts)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""
    ship()
    shared = _shared(encoded.sparkSession, model)
    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [decode(v, x.as_py() or []) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string")


def encoding_digest(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, n_byte_pieces, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), decoded_same (whether decoding gives
    the text back; false only for texts that hold the marker itself).

    Encoded and decoded in one pass, so the ids are not stored."""
    ship()
    shared = _shared(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        is_byte = np.array(encoder.v.kinds) == BYTE
        for doc_ids, texts in _batches(batches):
            found = encoder.encode_batch(texts)
            columns = [
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([int(is_byte[x].sum()) for x in found], pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
                pa.array([decode(encoder.v, x.tolist()) == t for x, t in zip(found, texts, strict=True)]),
            ]
            names = ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_same"]
            yield pa.RecordBatch.from_arrays([doc_ids, *columns], names)

    return rows.mapInArrow(
        run, f"doc_id {kind}, n_pieces bigint, n_byte_pieces bigint, ids_crc32 bigint, decoded_same boolean"
    )


def count_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens, the number of pieces; one row per row, null texts 0."""
    ship()
    shared = _shared(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "n_tokens"]
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
