"""Vector codes against a plain computation."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickloom.llm import codes

TABLE = "/root/testdata/sf0.001"


def brute(rows, parts, entries, rounds):
    """vec_id, code, error, label_error, digest of each kept row."""
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return Counter()
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(v, p)[1]].append(cut(v, p))
            new.append(
                [[sum(c) // len(c) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(books[p])]
            )
        books = new
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    found = [(i, label, [nearest(v, p) for p in range(parts)]) for i, v, label in kept]
    by_label = Counter()
    for _, label, best in found:
        by_label[label] += sum(d for d, _ in best)
    return Counter(
        (i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), by_label[label], digest)
        for i, label, best in found
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


@pytest.mark.parametrize("entries, rounds", [(64, 2), (5, 0), (3, 4)])
def test_codes_are_those_of_brute_force(spark, entries, rounds):
    random.seed(entries)
    f32 = lambda x: float(np.float32(x))
    rows = [(i % 150, [f32(random.gauss(0, 2)) for _ in range(32)], random.choice([None, 1, 1, 1, 2])) for i in range(160)]
    rows += [(None, [0.0] * 32, 3), (200, None, 1), (-1, [None] + [0.5] * 31, 1), (-2, [float("nan")] * 32, 1)]
    rows += [(-3, [float("inf")] + [0.0] * 31, 2), (300, rows[5][1], 1), (300, rows[5][1], 1), (301, [3e3] * 32, 2)]
    docs = frame(spark, rows)
    found, _ = codes.compressed(docs, entries=entries, rounds=rounds)
    assert Counter(map(tuple, found.collect())) == brute(rows, 16, entries, rounds)


def test_given_vectors(spark):
    docs = spark.read.parquet(f"{TABLE}/embeddings.parquet")
    found, books = codes.compressed(docs)
    rows = [(r.vec_id, r.embedding, r.label) for r in docs.collect()]
    want = brute(rows, 16, 64, 2)
    assert Counter(map(tuple, found.collect())) == want
    near = {r.vec_id: r.vector for r in codes.decoded(found, books).collect()}
    error = {r[0]: r[3] for r in want}
    i, vector, _ = rows[0]
    back = [math.floor(256 * x) for x in near[i]]
    assert sum((math.floor(256 * a) - b) ** 2 for a, b in zip(vector, back, strict=True)) == error[i]


def test_odd_tables(spark):
    assert codes.compressed(frame(spark, []))[0].count() == 0
    assert codes.compressed(frame(spark, [(1, None, 1), (2, [None] * 16, 1)]))[0].count() == 0
    one = codes.compressed(frame(spark, [(7, [0.5] * 16, None)]))[0].first()
    assert one.code == "00" * 16 and one.error == 0 and one.label_error == 0
    for rows in ([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], [(1, [0.5] * 15, 1)], [(1, [], 1)]):
        with pytest.raises(ValueError):
            codes.compressed(frame(spark, rows))
    with pytest.raises(Exception, match="not below"):
        codes.compressed(frame(spark, [(1, [1e30] * 16, 1)]))


def test_columns_of_other_names(spark):
    docs = frame(spark, [(1, [0.5] * 16, 1), (2, [0.25] * 16, 1)]).selectExpr(
        "vec_id as `a.b`", "embedding as v", "label as code", "label as ints", "vec_id as of"
    )
    found = codes.compressed(docs, "a.b", "v", "code")[0]
    assert sorted(r.vec_id for r in found.collect()) == [1, 2]
