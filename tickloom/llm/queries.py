"""The registered queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import alignment, bpe, codes, exact, licences, mixing, pieces, quality, secrets, simhash, substrings, token_files
from tickloom.llm.common import documents
from tickloom.session import fresh_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file: in the folder that TICKLOOM_TOKENIZERS names, else
    where the installed ``public_tokenizers`` package keeps it."""
    folder = os.environ.get("TICKLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op2_repeated_substrings")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, tokenizer_path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, path)


@query(
    "op4_pareto_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM documents),
    s0 AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank
      FROM d GROUP BY source),
    s1 AS (SELECT *, (rank - 1) % 3 + 1 AS weight FROM s0),
    s2 AS (
      SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))
                / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
      FROM s1 WINDOW w AS (ORDER BY source_size / CAST(weight AS DOUBLE), rank
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    s AS (SELECT source, rank, source_size,
                 least(3.0::DOUBLE * source_size, max(level) OVER () * weight) AS target FROM s2),
    u AS (
      SELECT d.doc_id, d.size, s.rank, s.source_size, s.target,
             CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 0 END AS wish,
             (('0x' || substr(md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE)
               / 4503599627370496.0::DOUBLE AS r
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
    c AS (SELECT *, CAST(floor(wish) AS BIGINT) AS certain, wish - floor(wish) AS p FROM u),
    k AS (SELECT *, target - sum(size * certain) OVER (PARTITION BY rank) AS room,
                 CASE WHEN p > 0 AND size > 0 THEN (r / (1 - r)) / (p / (1 - p)) END AS ord FROM c),
    t AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY rank, ord IS NULL ORDER BY ord, doc_id, size
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
    SELECT doc_id, size, source_size, target,
           CAST(size * (certain + CASE WHEN ord IS NOT NULL AND before + size / 2.0::DOUBLE <= room THEN 1 ELSE 0 END)
                AS BIGINT) AS taken
    FROM t
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept"
    )


@query("op6_pieces")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digest(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


@query(
    "op7_digest_index",
    r"""
    WITH d AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
    FROM d
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.DigestIndex(spark).add(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.count_documents(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


@query("op9_licences")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("spans")


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    of_verdict = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("bigint")
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        of_verdict("live").alias("n_live"),
        of_verdict("example").alias("n_example"),
    )


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(
        documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


@query("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _sql_round(k: int) -> str:
    """Assignment to codebooks b{k} as a{k}, then the refined codebooks b{k + 1}."""
    return f"""
    a{k} AS (
      SELECT r, part, min(CAST(list_sum(list_transform(range(1, len(sub) + 1),
               lambda i: (sub[i] - entry[i]) * (sub[i] - entry[i]))) AS BIGINT) * 64 + k) AS best
      FROM p JOIN b{k} USING (part) GROUP BY r, part),
    m{k} AS (
      SELECT part, best % 64 AS k, i, CAST(sum(sub[i]) AS BIGINT) AS s, count(*) AS n
      FROM a{k} JOIN p USING (r, part), unnest(range(1, len(sub) + 1)) AS t(i) GROUP BY ALL),
    n{k} AS (SELECT part, k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS mean FROM m{k} GROUP BY part, k),
    b{k + 1} AS (SELECT part, k, coalesce(mean, entry) AS entry FROM b{k} LEFT JOIN n{k} USING (part, k))"""


@query(
    "op13_vector_codes",
    f"""
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id, label,
             list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS ints
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (
      SELECT r, part, ints[part * (len(ints) // 16) + 1 : (part + 1) * (len(ints) // 16)] AS sub
      FROM v, range(16) AS t(part)),
    seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS k FROM v),
    b0 AS (SELECT part, k, sub AS entry FROM p JOIN seeds USING (r) WHERE k < 64),
    {_sql_round(0)}, {_sql_round(1)}, {_sql_round(2)},
    coded AS (
      SELECT r, vec_id, label, string_agg(format('{{:02x}}', best % 64), '' ORDER BY part) AS code,
             CAST(sum(best // 64) AS BIGINT) AS error
      FROM a2 JOIN v USING (r) GROUP BY ALL)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY part, k)) FROM b2) AS codebooks_sha256
    FROM coded
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
