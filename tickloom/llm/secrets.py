"""Secret scans with corpus-wide ownership frequency.

Candidate values are found by pattern, with their place in the text. A value's
hash is then counted over the corpus by distinct repositories and distinct owners:
an example key of a manual turns up with many owners, a live one with its own.
Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import settle, text_of

# Patterns of the candidate kinds, in the order that breaks ties of place.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
#: The greedy runs of at least this length are those of any length that pass the length test.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"

EXAMPLE_OWNERS = 3
MATCHES = "array<struct<kind:int,pos:int,gap:int,long:int,hash:binary,good:boolean>>"



def matches(text: Column, kind: int, pattern: str, group: int, good: Callable[[Column], Column]) -> Column:
    """Array of the leftmost matches of ``pattern`` that do not overlap, in order: kind,
    pos, ``gap`` (code points since the match before), ``long``, ``hash`` of the group,
    and ``good``, whether the group counts.

    The text between matches gives their places: both sides come from the same
    matcher. Places are summed later, over rows, so the cost is linear in the matches.
    Texts without a match are not split.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), whole.alias("whole"), values.alias("value")
    )
    found = F.transform(
        steps,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["gap"]).alias("gap"),
            F.length(x["whole"]).alias("long"), F.unhex(F.sha2(x["value"], 256)).alias("hash"),
            good(x["value"]).alias("good"),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(MATCHES))


def candidates(docs: DataFrame, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """``keep`` and the matches of each text: base (assign, access, hex) and tokens (long
    runs that mix digits, capitals and small letters)."""
    text = F.col("_text")
    every = lambda v: F.lit(True)
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]")
    found = F.concat(
        matches(text, 0, ASSIGN, 2, lambda v: F.length(v) >= ASSIGN_LEAST),
        matches(text, 1, ACCESS, 0, every),
        matches(text, 2, HEX, 0, every),
        matches(text, 3, TOKEN, 0, mixed),
    )
    return docs.select(*[c.alias(n) for n, c in keep.items()], text_of(text_col).alias("_text")).select(
        *keep, found.alias("found")
    )


def placed(rows: DataFrame) -> DataFrame:
    """One row per candidate span: base spans, and tokens that meet none of them.

    Running sums of gaps and lengths give the places. A token meets a base span if one that
    begins no later ends behind its start, or the next one begins before its end: a running
    maximum and, from the other side, a running minimum.
    """
    spread = rows.repartition("row_id").select("doc_id", "row_id", "repo", "owner", F.explode("found").alias("m"))
    along = Window.partitionBy("row_id", "m.kind").orderBy("m.pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.long")).over(along).cast("int")
    spans = (
        spread.withColumn("end", end)
        .filter("m.good")
        .select(
            "doc_id", "row_id", "repo", "owner", (F.col("end") - F.col("m.long")).alias("start"), "end",
            "m.kind", "m.hash",
        )
    )
    base = F.col("kind") < 3
    in_row = Window.partitionBy("row_id")
    upto = in_row.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = in_row.orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.when(base, F.col("end"))).over(upto), F.lit(-1))
    following = F.min(F.when(base, F.col("start"))).over(behind)
    meets = (reached > F.col("start")) | F.coalesce(following < F.col("end"), F.lit(False))
    return spans.withColumn("_meets", meets).filter(base | ~F.col("_meets")).drop("_meets")


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: n_repos and n_owners, distinct and without nulls. ``found``
    has hash, repo, owner; pairs are made distinct before they are counted, so a
    value seen everywhere is no large group."""
    return found.groupBy("hash").agg(
        F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners")
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, end, kind,
    verdict, n_repos, n_owners) by start and kind.

    A value held by ``example_owners`` owners or more is an ``example``, else
    ``live``. Base spans stay whatever the verdict; a token span is added only if
    it is live. A null text has no spans; null owners and repositories are not
    counted. By default a document stands for a repository and its source for the
    owner. No secret leaves this operator: it returns places only.
    """
    rows = settle(
        candidates(
            docs,
            text_col,
            {
                "doc_id": F.col(id_col),
                "repo": F.col(repo_col).cast("string"),
                "owner": F.col(owner_col).cast("string"),
                "row_id": F.monotonically_increasing_id(),
            },
        ),
        "secret-candidates",
    )
    none = F.size("found") == 0
    spread = settle(placed(rows.filter(~none)), "secret-spans")
    verdict = F.when(F.col("n_owners") >= example_owners, "example").otherwise("live")
    judged = (
        spread.join(settle(ownership(spread), "secret-owners"), "hash")
        .withColumn("verdict", verdict)
        .filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
    )
    span = F.struct("start", "end", "kind", "verdict", "n_repos", "n_owners")
    spans = judged.groupBy("row_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    with_spans = rows.filter(~none).select("doc_id", "row_id").join(spans, "row_id", "left")
    return (
        with_spans.select("doc_id", F.coalesce("spans", empty).alias("spans"))
        .unionByName(rows.filter(none).select("doc_id", empty.alias("spans")))
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    by_place = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(
        F.transform(
            by_place,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
