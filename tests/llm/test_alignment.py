"""Token alignment against a plain computation with both libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import alignment, bpe

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TABLE = "/root/testdata/sf0.001"
EDGE = [
    None, "", " ", "a ", "  a  b", "one two three", "<|endoftext|> x<|endoftext|>", "<s> <0x41>", "▁x", "x ▁", "é ü ☃ 🙂",
    "a\xa0b\u3000c\n\n d\t", "\x00\x1c x", "x" * 5000, " " * 300, "日本語 text", "don't  stop'll", "\u088f 1\U00011de0",
]


def brute(rows):
    """Counter of result rows, of (doc_id, text)."""
    first = Tokenizer.from_file(BPE)
    first.encode_special_tokens = True
    raw = bpe.MergeList(BPE).raw
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            whole = (" " + text).encode()
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            pieces = [second.id_to_piece(i) for i in b]
            of_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
            of_a = [raw[i] for i in a]
            if b"".join(of_a) != whole or b"".join(of_b) != whole:
                a = b = []
        spans = []
        for ids, sizes in ((a, list(map(len, of_a)) if a else []), (b, list(map(len, of_b)) if b else [])):
            at, out = 0, []
            for i, n in zip(ids, sizes):
                out.append((at, at + n, i))
                at += n
            spans.append(out)
        cuts = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
        groups, links, x, y, i, j = [], [], [], [], 0, 0
        while i < len(a) and j < len(b):  # the tokens at i and j overlap
            (_, end_a, id_a), (_, end_b, id_b) = spans[0][i], spans[1][j]
            links.append((id_a, id_b))
            if end_a <= end_b:
                x.append(str(id_a))
                i += 1
            if end_b <= end_a:
                y.append(str(id_b))
                j += 1
            if min(end_a, end_b) in cuts:
                groups.append(",".join(x) + "|" + ",".join(y))
                x, y = [], []
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(cuts), links, ";".join(groups)))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter(
        (i, na, nb, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(text.encode()).hexdigest() if na else "")
        for i, na, nb, g, links, text in found
    )


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(None, "no id"), (5, EDGE[5]), (5, EDGE[5])]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row_id", F.lit(1)).repartition(3)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 40, 0])
def test_edge_texts(edge, frequent):
    """Also where most pairs, or all, are joined instead of looked up."""
    found = alignment.aligned_documents(edge, BPE, PIECES, frequent=frequent)
    assert Counter(map(tuple, found.collect())) == brute([(r.doc_id, r.text) for r in edge.collect()])


def test_given_texts(spark, edge):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    found = alignment.aligned_documents(docs, BPE, PIECES, frequent=2000)
    assert Counter(map(tuple, found.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert alignment.aligned_documents(edge.limit(0), BPE, PIECES).count() == 0


def test_long_texts_are_cut_into_slices(spark):
    """Two texts of 2.5 MB; the bytes of the second differ at its very end."""
    random.seed(2)
    words = ["lorem", "Ipsum,", "dolor_", "42", "é☃", "  ", "\n", "don't", "x" * 90]
    long = " ".join(random.choices(words, k=250_000))
    assert len(alignment.slices(" " + long)) > 1 and "".join(alignment.slices(long)) == long
    rows = [(1, long), (2, long + " ▁"), (3, "short text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = alignment.aligned_documents(docs, BPE, PIECES)
    assert Counter(map(tuple, found.collect())) == brute(rows)
