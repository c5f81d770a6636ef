"""The BPE transducer against the library."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLE = "/root/testdata/sf0.001"
EDGE = [
    "", " ", "a", "  \n\n  a", "<|endoftext|>", "a  <|endoftext|>  b<|endoftext|><|endoftext|>'s", "don't 'll  'x",
    "é ü ☃ 🙂 ▁x\x00\x1f", "a" * 9000, " " * 9000 + "x", "\n" * 5001, "ab" * 5000, "\u088fa \u208fb 1\U00011de0",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    return bpe.MergeList(PATH)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def random_texts(seed):
    random.seed(seed)
    some = ["a", "b", "th", "e", " ", "the", "ing", "1", "2", "!", "=", "-", "_", "é", "日", "🙂", "\n", "\t", "'s"]
    texts = ["".join(random.choices(some, k=random.randrange(1, 400))) for _ in range(40)]
    texts.append("".join(random.choices(["a", "b", "th", "e", "ing", "z", "qu"], k=6000)))
    texts.append("".join(random.choices("=-_*#", k=12000)))
    texts.append("".join(map(chr, random.choices([*range(32, 0x3000), *range(0x10000, 0x20000)], k=3000))))
    return texts


def test_texts_encode_as_in_the_library(library, merges):
    encoder = bpe.Encoder(merges)
    texts = EDGE + random_texts(3)
    together = encoder.encode_batch(texts)
    for text, raw in zip(texts, together, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(raw) == want
        assert ids_of(b"".join(encoder.stream(text))) == want
        machine = bpe.TextDecoder(merges)
        assert machine.feed(np.array(want, int)) + machine.finish() == library.decode(want, skip_special_tokens=False)


def test_strings_of_added_tokens_may_be_text():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    encoder = bpe.Encoder(bpe.MergeList(PATH, special=False))
    for text in EDGE:
        assert ids_of(encoder.encode_batch([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_ids_in_any_order_decode_as_in_the_library(library, merges):
    random.seed(4)
    for top in [256, 50257] * 40:
        ids = random.choices(range(top), k=random.randrange(1, 60))
        machine = bpe.TextDecoder(merges)
        text = "".join(machine.feed(np.array([i])) for i in ids) + machine.finish()
        assert text == library.decode(ids, skip_special_tokens=False)


def brute_lookahead(merges, letters, longest):
    """Least number of letters behind a token that settles it, over all short words."""
    def segment(word):
        parts = list(word)
        for a, b in merges:
            at = 0
            while at < len(parts) - 1:
                if (parts[at], parts[at + 1]) == (a, b):
                    parts[at : at + 2] = [a + b]
                at += 1
        return parts

    words = [""]
    for _ in range(longest):
        words += [w + c for w in words if len(w) == len(words[-1]) for c in letters]
    ends = {w: set(np.cumsum([len(t) for t in segment(w)]).tolist()) for w in words}
    worst = 0
    for w in words:
        for n in range(len(w)):
            differing = [p for p in range(1, n + 1) if (p in ends[w]) != (p in ends[w[:n]])]
            worst = max([worst, *(n - p + 1 for p in differing)])
    return worst


def test_lookahead_suffices():
    """On random merge lists over two letters, all words of up to nine letters."""
    random.seed(5)
    for _ in range(12):
        tokens, merges = ["a", "b"], []
        while len(merges) < 5:
            a, b = random.choices(tokens, k=2)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append((a, b))
        number = {t: i for i, t in enumerate(tokens)}
        bound = bpe.sufficient_lookahead([(number[a], number[b], number[a + b]) for a, b in merges], list(map(len, tokens)))
        assert brute_lookahead(merges, "ab", 9) <= bound


def test_a_transducer_holds_little(merges):
    """8 MB without a blank: what waits stays below lookahead and longest token."""
    random.seed(6)
    machine, emitted, most = bpe.Transducer(merges), 0, 0
    block = "".join(random.choices(["th", "e", "ing", "q", "un"], k=2000)).encode()
    for _ in range(8_000_000 // len(block)):
        emitted += sum(len(merges.raw[i]) for i in machine.feed(block).tolist())
        most = max(most, len(machine.wait))
    emitted += sum(len(merges.raw[i]) for i in machine.finish().tolist())
    assert emitted == 8_000_000 // len(block) * len(block)
    assert most <= merges.lookahead + merges.longest < 300


def test_documents(spark, library):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(None, None), (2, "a"), (2, "a"), (90, "long words " * 500_000)]
    edge = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(1)).repartition(3)
    real = spark.read.parquet(f"{TABLE}/documents.parquet")
    for docs in (edge, real):
        want = Counter()
        for r in docs.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            hashes = (hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode()))
            want[(r.doc_id, len(ids), *hashes, text == (r.text or ""))] += 1
        assert Counter(map(tuple, bpe.round_trip(docs, PATH).collect())) == want
    encoded = bpe.encode_documents(edge, PATH)
    decoded = bpe.decode_documents(encoded, PATH).collect()
    assert Counter(map(tuple, decoded)) == Counter((i, t or "") for i, t in rows)
    odd = spark.createDataFrame([(1, None), (2, [64, None, 99999, 65])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode_documents(odd, PATH).collect()} == {1: "", 2: "ab"}
    assert bpe.round_trip(edge.limit(0), PATH).count() == 0
