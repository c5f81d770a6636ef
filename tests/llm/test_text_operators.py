"""The text operators against brute force, over real rows and edge cases."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import exact, licences, mixing, pieces, quality, secrets, simhash, substrings, token_files
from tickloom.session import fresh_path

TABLE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [
    (1, None, "en", None), (2, "", "en", "b"), (3, " \t\n", "en", "b"), (4, "one", "en", "a"),
    (5, "one two", "en", "a"), (6, "A b\tC  d", "en", None), (7, "a b c d", "en", "a"), (8, "a  b c\nd", "en", "b"),
    (9, "é ü ☃ 🙂 ▁x", "de", "é"), (10, "w " * 3000, "en", "b"), (10, "w " * 3000, "en", "b"),
    (11, "x" * 5000, "en", "a"), (None, "no id", "en", "a"), (None, "no id", "en", "a"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(*r, i) for i, r in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, label int").repartition(3)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{TABLE}/documents.parquet")


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


def both(*frames):
    return [[(r.doc_id, r.text or "", r.source) for r in f.collect()] for f in frames]


def path(name):
    return public_tokenizers.path(name)


# Exact deduplication


def test_exact_copies(edge, real, spark):
    for docs in (edge, real):
        groups = defaultdict(list)
        for i, t, _ in both(docs)[0]:
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
        rows = exact.DigestIndex(spark).add(docs).collect()
        assert len(rows) == sum(map(len, groups.values()))
        by_digest = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
        for r in rows:
            ids = by_digest[bytes(r.digest)]
            known = [i for i in ids if i is not None]
            assert (r.keep_id, r.group_size) == (min(known, default=None), len(ids))
        assert sum(r.kept for r in rows) == len(groups)


def test_index_is_kept_between_batches(edge, spark):
    place = fresh_path(spark, "index")
    index = exact.DigestIndex(spark, place)
    index.add(edge.filter("doc_id >= 8"))
    held = index.read().count()
    again = exact.DigestIndex(spark, place)
    found = {r.doc_id: (r.keep_id, r.kept) for r in again.add(edge.filter("doc_id in (6, 7, 8)")).collect()}
    assert found[7] == (8, False) and found[8] == (8, True)
    assert again.read().count() == held + 1 - (found[6][0] == 8)
    plan = edge.select(exact.digest(F.col("text")).alias("digest")).join(
        again.read().hint("merge"), "digest", "left_anti"
    )._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_keep_first_keeps_columns(edge, empty, spark):
    kept = exact.keep_first(edge, exact.DigestIndex(spark))
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 7, 9, 10, 11, None])
    assert exact.keep_first(empty, exact.DigestIndex(spark)).count() == 0


CLASHING = ["_key", "_turn", "_copy", "_all", "_label_id", "label", "a.b", "row", "hash", "Turn"]


def test_columns_of_any_name_stay(edge, spark):
    """Helper columns replace none of the user's, and dots do no harm."""
    docs = edge.drop("label")
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat_ws("-", F.lit(k), "doc_id", F.length("text")))
    labels = spark.createDataFrame([(1, 0), (6, 1)], "doc_id bigint, quality int")
    given = Counter(docs.collect())
    for found in (
        exact.keep_first(docs, exact.DigestIndex(spark)),
        simhash.keep_representatives(docs),
        mixing.mixed_documents(docs),
        quality.kept_documents(docs, labels),
    ):
        assert found.columns == docs.columns
        assert set(found.collect()) <= set(given)


def test_the_row_that_stays_is_the_same_in_every_order(spark):
    rows = [(1, f"a b {k // 20}", "s", k) for k in range(40)]
    for step in (
        lambda d: exact.keep_first(d, exact.DigestIndex(spark)),
        simhash.keep_representatives,
        mixing.mixed_documents,
    ):
        results = []
        for order in (rows, rows[::-1]):
            docs = spark.createDataFrame(order, "doc_id bigint, text string, source string, k int").repartition(3)
            results.append(Counter(step(docs).collect()))
        assert results[0] == results[1]


# Mixing


def test_mix_meets_targets(edge, real, empty):
    for docs in (edge, real):
        rows = mixing.mix(docs, buckets=16).collect()
        again = mixing.mix(docs).collect()
        pick = lambda xs: Counter((r.doc_id, r.size, r.copies) for r in xs)
        assert pick(rows) == pick(again)
        taken, target, largest = defaultdict(int), {}, defaultdict(int)
        for r in rows:
            taken[r.source] += r.taken
            target[r.source] = r.target
            largest[r.source] = max(largest[r.source], r.size)
            assert 0 <= r.copies <= 3
        assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
        for s, t in target.items():
            assert abs(taken[s] - t) <= max(largest[s], 1)
    assert mixing.mix(empty).count() == 0


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 10), (None, 5)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    left, caps = 116.0, {"a": (1, 300), "b": (2, 3), "c": (3, 30), None: (1, 15)}
    want, open_ = {}, dict(caps)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {s: c for s, (w, c) in open_.items() if left * w / weight > c}
        if not full:
            want |= {s: left * w / weight for s, (w, _) in open_.items()}
            break
        want |= full
        left -= sum(full.values())
        open_ = {s: x for s, x in open_.items() if s not in full}
    assert found == pytest.approx(want)


def test_mixed_documents_repeat(edge):
    copies = Counter()
    for r in mixing.mix(edge).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mixed_documents(edge)
    assert out.columns == edge.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})


# Quality


def brute_statistics(t):
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed


def test_statistics(edge, real):
    for docs in (edge, real):
        want = Counter((i, *brute_statistics(t)) for i, t, _ in both(docs)[0])
        found = quality.statistics(docs).collect()
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert Counter(tuple(r[n] for n in names) for r in found) == want


def test_learned_list_finds_a_planted_rule(spark, empty):
    random.seed(5)
    rows = []
    for i in range(600):
        upper, mean = random.random(), random.uniform(3, 9)
        bad = upper > 0.8 and mean > 5
        rows.append((i, upper, mean, bad, i % 3 == 0))
    frame = spark.createDataFrame(rows, "doc_id int, upper_share double, mean_word double, bad boolean, fold boolean")
    rules = quality.learn(frame, features=("upper_share", "mean_word"), least_precision=0.9)
    hit = frame.filter(rules.rejects()).agg(F.sum(F.col("bad").cast("int")), F.count("*")).first()
    assert rules.rules and hit[0] / hit[1] > 0.9 and hit[0] > 0.6 * sum(r[3] for r in rows)
    assert quality.learn(frame.limit(0), features=("upper_share",)).rules == []
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.judged(empty, labels).count() == 0


def test_rules_keep_held_out_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    known = labels.filter("pmod(doc_id, 2) = 0")
    found = quality.judged(docs, known).join(labels.filter("pmod(doc_id, 2) = 1"), "doc_id").filter("not base_failed")
    by = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.02 * by[(1, True)]


# SimHash


def brute_simhash(t):
    words = t.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    ones = [0] * 64
    for x in shingles:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(prints, near=3):
    fps = sorted(set(prints))
    head = {f: f for f in fps}

    def root(f):
        while head[f] != f:
            f = head[f]
        return f

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= near:
                head[root(fps[a])] = root(fps[b])
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("tile", [4096, 3])
def test_near_links_join_what_brute_force_joins(spark, tile):
    random.seed(tile)
    seeds = [random.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    fps = set(seeds)
    for s in seeds:
        for _ in range(12):
            for b in random.sample(range(64), random.choice((1, 2, 3, 4, 5))):
                s ^= 1 << b
            fps.add(s)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), tile=tile).collect()
    root = brute_components(fps)
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert root[a] == root[b]
        parent[find(a)] = find(b)
    groups = lambda of: {frozenset(f for f in fps if of(f) == x) for x in {of(f) for f in fps}}
    assert groups(find) == groups(root.__getitem__)


def test_a_guest_joins_two_trees(spark):
    fps = [0x7084E52DB2221A58, 0x7204E52DB2221B58, 0x7200E5ADB2221A58, 0x7200E1A5B2221B58]
    assert len(set(brute_components(fps).values())) == 1
    parent = {f: f for f in fps}
    for a, b in simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp bigint")).collect():
        gone, stays = parent[a], parent[b]
        parent = {f: stays if x == gone else x for f, x in parent.items()}
    assert len(set(parent.values())) == 1


def test_near_duplicates(edge, real, empty):
    for docs in (edge, real):
        rows = both(docs)[0]
        prints = [brute_simhash(t) for _, t, _ in rows]
        root = brute_components(prints)
        least = {}
        for (i, _, _), f in zip(rows, prints, strict=True):
            if i is not None:
                least[root[f]] = min(least.get(root[f], i), i)
        want = Counter((i, f"{f:016x}", least.get(root[f])) for (i, _, _), f in zip(rows, prints, strict=True))
        found = simhash.near_duplicates(docs).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want
        kept = simhash.keep_representatives(docs)
        assert kept.columns == docs.columns and kept.count() == len(set(root.values()))
    assert simhash.near_duplicates(empty).count() == 0


# Repeated substrings


def brute_removed(rows, span):
    seen = Counter()
    for _, t in rows:
        b = t.encode()
        seen.update(b[i : i + span] for i in range(len(b) - span + 1))
    out = []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if seen[b[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limit", [4096, 2])
def test_repeated_bytes(spark, edge, limit):
    random.seed(3)
    text = lambda n: "".join(random.choice("ab é\n") for _ in range(n))
    shared = [text(n) for n in (60, 45, 30)]
    rows = [(i, text(random.randrange(80)) + random.choice(shared) + text(50) + random.choice(shared)) for i in range(60)]
    rows += [(100, "a" * 300), (101, "ab" * 200), (102, ""), (103, text(29)), (104, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = substrings.remove_repeats(docs, span=30, gram=8, limit=limit).collect()
    assert Counter(map(tuple, found)) == brute_removed(rows, 30)
    whole = [(i, t) for i, t, _ in both(edge)[0]]
    assert Counter(map(tuple, substrings.remove_repeats(edge, limit=limit).collect())) == brute_removed(whole, 200)


def test_repeated_bytes_of_nothing(empty):
    assert substrings.remove_repeats(empty).count() == 0


# Token files


def test_token_files_round_trip(edge, real, empty, spark):
    from tokenizers import Tokenizer

    file = path("word_bpe_49k.json")
    plain = Tokenizer.from_file(file)
    for docs in (edge, real):
        place = fresh_path(spark, "tokens")
        token_files.write_token_files(docs, place, file)
        rows = sorted(token_files.read_token_files(spark, place).collect(), key=lambda r: r.start)
        want = Counter()
        for i, t, _ in both(docs)[0]:
            ids = [*plain.encode(t, add_special_tokens=False).ids, 1]
            want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
        order = [-1 if r.doc_id is None else r.doc_id for r in rows]
        assert order == sorted(order)
        assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
        one = next((i, t) for i, t, _ in both(docs)[0] if i is not None and t)
        ids = [*plain.encode(one[1], add_special_tokens=False).ids, 1]
        assert ids in token_files.read_document(spark, place, one[0])
    place = fresh_path(spark, "tokens")
    token_files.write_token_files(empty, place, file)
    assert token_files.read_token_files(spark, place).count() == 0


def test_words_encode_as_texts_do():
    from tokenizers import Tokenizer

    file = path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(file), token_files.WordEncoder(file)
    texts = ["Don't stop, it's <|endoftext|>here; ÀÉ é́ ﬁ Straße!?", "a1b2 x<|y z\tq　r", "... ,,a,, B.", ""]
    for t, raw in zip(texts, own.encode_batch(texts), strict=True):
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == [*plain.encode(t, add_special_tokens=False).ids, 1]


def test_blocks_refuse_another_dictionary():
    payload = token_files.pack([b"x"], [1], hashlib.sha256(b"").digest())
    with pytest.raises(ValueError):
        token_files.Block(payload, b"other")


# Pieces


def unigram_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(path("piece_bpe_32k.model"))


def test_words_have_the_best_path(vocabulary, real):
    """Scores beside an unknown character (-1e9) lose single-precision digits in the
    library, so words with one are left to the round trip."""
    library = unigram_library()
    words = sorted({w for _, t, _ in both(real)[0] for w in t.split() if w.isalpha()})[:4000]
    encoder, counter = pieces.Encoder(vocabulary), pieces.Counter(vocabulary)
    for w, ids in zip(words, encoder.encode_batch(words), strict=True):
        assert ids.tolist() == library.nbest_encode_as_ids(w, 2)[0]
        assert counter.count(w) == len(ids) and encoder.viterbi(pieces.MARK + w) == ids.tolist()


def test_pieces_round_trip(edge, real, empty, vocabulary):
    model = path("piece_bpe_32k.model")
    for docs in (edge, real):
        encoded = pieces.encode_documents(docs, model)
        back = Counter((r.doc_id, r.text) for r in pieces.decode_documents(encoded, model).collect())
        assert back == Counter((i, t.replace(pieces.MARK, " ")) for i, t, _ in both(docs)[0])
        digests = {(r.doc_id, r.n_pieces) for r in pieces.encoding_digest(docs, model).collect()}
        counts = {(r.doc_id, r.n_tokens) for r in pieces.count_documents(docs, model).collect()}
        assert digests == counts == {(r.doc_id, len(r.ids)) for r in encoded.collect()}
    assert pieces.encode_documents(empty, model).count() == 0


# Licences


def test_licences(edge, real, empty):
    for docs in (edge, real):
        found = licences.scan(docs).collect()
        want = Counter()
        for i, t, _ in both(docs)[0]:
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
            places = [(k, label) for p, label in licences.PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
            starts = [k for k, _ in places]
            base = ",".join(sorted({label for _, label in places}))
            want[i, len(words), len(places), min(starts, default=None), max(starts, default=None), base] += 1
        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
        assert Counter(tuple(r[n] for n in names) for r in found) == want
        assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {"", *r.labels.split(",")} for r in found)
    assert licences.scan(empty).count() == 0


def test_matching_statistics():
    random.seed(1)
    sequences = [[random.randrange(4) for _ in range(30)] for _ in range(3)]
    automaton = licences.SuffixAutomaton(sequences)
    parts = {tuple(s[a:b]) for s in sequences for a in range(30) for b in range(a + 1, 31)}
    text = [random.randrange(5) for _ in range(300)]
    for end, (state, size) in enumerate(automaton.statistics(text), 1):
        assert size == max((k for k in range(31) if k <= end and tuple(text[end - k : end]) in parts), default=0)
        for template, at in automaton.where[state] if size else ():
            assert sequences[template][at - size : at] == text[end - size : end]


def test_a_changed_notice_is_one_span():
    text = "Intro. " + licences.TEMPLATES[1][1].replace("free of charge", "free of any charge") + " outro"
    found = licences.Scanner().scan(text)
    assert found["labels"] == "mit" and found["base_labels"] == "" and 0.9 < found["score"] <= 1
    assert any(s["label"] == "mit" and s["start"] == 1 for s in found["spans"])


def test_licences_that_differ_in_a_word_are_told_apart():
    scanner = licences.Scanner()
    for label, notice in licences.TEMPLATES:
        for text in (notice, f"// {notice}\n// Some code follows, version 7 of it.", f"Notes.\n{notice}"):
            assert scanner.scan(text)["labels"] == label, (label, text)
    both = " Then, beside it, other parts. ".join(t for label, t in licences.TEMPLATES if label in ("gpl-2", "lgpl-3", "cc-by-sa"))
    assert scanner.scan(both)["labels"] == "cc-by-sa,gpl-2,lgpl-3"
    inserted = "This work is licensed under a Creative Commons Attribution (Unlike Others) 4.0 International License."
    assert scanner.scan(inserted)["score"] < 1.0 == scanner.scan(licences.TEMPLATES[6][1])["score"]


# Secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_of_a_text_with_very_many(spark):
    """Places are linear in the matches: 150,000 of them in one text of 8 MB."""
    line = f"token=aB3{'x9Y' * 6} AKIA{'Q7' * 8} {'0f' * 17}zz Zz9{'kQ4' * 7}\U0001f600 password: short\n"
    text = line * 50_000
    docs = spark.createDataFrame([(1, text, "x"), (2, line, "y")], "doc_id long, text string, source string")
    got = {r.doc_id: r.base for r in secrets.scan(docs).select(
        "doc_id", secrets.span_text(F.filter("spans", lambda s: s["kind"] < 3)).alias("base")).collect()}
    assert got == {1: brute_secrets(text), 2: brute_secrets(line)}
    spans = {r.doc_id: r.n for r in secrets.scan(docs).select("doc_id", F.size("spans").alias("n")).collect()}
    # Per line: assign, access, hex and one token; the hex run is all small letters.
    assert spans == {1: 200_000, 2: 4}


def test_tokens_that_meet_a_base_span_are_left_out(spark):
    token = "Ab1" * 8
    texts = [
        token, f"secret={token}", f"{token} secret={token}", f"secret={token} {token}", f"x{token}{'0f' * 20}",
        f"{token}=secret=abcdefgh", f"AKIA{'A1' * 6}b{token}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    for r in secrets.scan(docs).collect():
        text = texts[r.doc_id]
        base = [(s.start, s.end) for s in r.spans if s.kind < 3]
        runs = [m.span() for m in re.finditer(secrets.TOKEN, text)]
        mixed = [(a, e) for a, e in runs if all(re.search(p, text[a:e]) for p in ("[0-9]", "[A-Z]", "[a-z]"))]
        want = [(a, e) for a, e in mixed if not any(b < e and a < f for b, f in base)]
        assert [(s.start, s.end) for s in r.spans if s.kind == 3] == want, text


def test_secret_spans(spark, edge, real, empty):
    key = "AKIA" + "Z9" * 8
    odd = spark.createDataFrame(
        [
            (1, f"🙂 password=abcdefgh {key}{key}", "x"), (2, "token: token:abcdefgh", "x"),
            (3, f'API_KEY = "{"0f" * 20}" AKIA12', "y"), (4, "secret=short", None), (5, None, "x"),
            (6, f"passwd:{'a' * 9}{key}x", "z"), (7, "k Zq8kLm2Pv9Xw4Rt7Yb1Nc6 end", "x"),
        ],
        "doc_id int, text string, source string",
    )
    for docs in (odd, edge, real):
        rows = secrets.scan(docs).withColumn(
            "base", secrets.span_text(F.filter("spans", lambda s: s["kind"] < 3))
        ).collect()
        assert Counter((r.doc_id, r.base) for r in rows) == Counter((i, brute_secrets(t)) for i, t, _ in both(docs)[0])
    added = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(odd).collect()}
    assert added[7] == [3]
    assert secrets.scan(empty).count() == 0


def test_widely_copied_values_are_examples(spark):
    value = "Zq8kLm2Pv9Xw4Rt7Yb1Nc6"
    rows = [(i, f"use {value} or token={'b7' * 6}", f"owner{i % 5}") for i in range(20)]
    rows += [(100, "token=onlymine123", "owner1")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    assert [(s.kind, s.verdict, s.n_owners, s.n_repos) for s in found[0]] == [(0, "example", 5, 20)]
    assert [(s.verdict, s.n_owners) for s in found[100]] == [("live", 1)]


# Components


def test_long_chains_settle(spark):
    from tickloom.llm.components import connected_components

    links = [(i, i + 1) for i in range(100)] + [(200, 201), (201, 201), (300 + 5, 300)]
    found = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(found[i] == 0 for i in range(101)) and found[201] == 200 and found[305] == 300 and 202 not in found


# Pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    columns = docs.columns
    folder = fresh_path(spark, "pipeline")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TABLE).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        if name != "encode":
            assert docs.columns == columns
        if name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in before.collect()]
            assert docs.count() == len(set(texts))
        if name == "near_dedup":
            prints = [brute_simhash(r.text) for r in before.collect()]
            assert docs.count() == len(set(brute_components(prints).values()))
        kept.append(docs.count())
    assert kept[1] <= kept[0] and docs.columns == ["doc_id", "ids"]
    assert corpus_pipeline.run(spark, TABLE).count() == kept[-1]
