"""Mixing sources to target weights by Pareto order sampling.

Every source has a target of words. A document's wished number of copies is its
source's target over its source's size; the whole part are certain copies. One
more copy is drawn by Pareto sampling: documents are ranked by the odds of a
random number over the odds of the fraction, and the first ranks that fill what
the certain copies leave of the target are taken. So the sample has a fixed size,
counted in words, and differs by less than half a document from the target.

No source is sorted whole: ranks are cut into buckets, bucket sums show in which
one the target falls, and only that bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, row_hash, settle, text_of, whole_row, words_of

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BUCKETS = 1 << 16


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Per source: source, rank (1 first by code point, null last), weight,
    source_size, target.

    Targets share the sum of all sizes by weight. None is above ``most`` times its
    source; the excess goes to the others by weight. With sources in order of the
    level at which they are full, the level that results if the first k are full
    rises up to the right k and falls after it, so the largest one is the answer.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    share = F.array(*[F.lit(w) for w in weights])
    left = F.sum("source_size").over(everywhere) - F.coalesce(
        F.sum(most * F.col("source_size")).over(before), F.lit(0)
    )
    open_weight = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (
        sources.withColumn("rank", F.row_number().over(every))
        .withColumn("weight", F.get(share, (F.col("rank") - 1) % len(weights)))
        .withColumn("level", left / open_weight)
        .withColumn("level", F.max("level").over(everywhere))
        .withColumn(
            "target",
            F.least((most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")),
        )
        .select("source", "rank", "weight", "source_size", "target")
    )


def random_unit(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the document's id and the seed alone."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))
    whole = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (whole + 0.5) / float(1 << 52)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 7,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    copies, taken.

    ``size`` counts words; ``taken`` is size times copies. A null text has size 0;
    null sources are one source of their own, the last. Empty documents get the
    certain copies only. Equal rows rank by id and size, so a rerun gives the same
    rows. The table of sources, one row each, is ordered in one task.
    """
    rows = settle(
        docs.select(
            F.col(quoted(id_col)).alias("doc_id"),
            F.col(quoted(source_col)).alias("source"),
            F.size(words_of(text_of(text_col))).cast("bigint").alias("size"),
        ),
        "sizes",
    )
    targets = settle(source_targets(rows, weights, most), "targets")
    wish = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    odds = lambda p: p / (1 - p)
    fraction = F.col("wish") - F.col("certain")
    order = odds(random_unit(F.col("doc_id"), seed)) / odds(fraction)
    wished = (
        rows.join(targets.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("wish", wish)
        .withColumn("certain", F.floor("wish"))
        .withColumn("order", F.when((fraction > 0) & (F.col("size") > 0), order))
        .withColumn(
            "bucket",
            F.when(
                F.col("order").isNotNull(),
                F.least(F.floor(F.col("order") / (1 + F.col("order")) * buckets), F.lit(buckets - 1)),
            ),
        )
        .drop("_of", "wish")
    )
    whole = wished.groupBy("rank").agg(F.sum(F.col("size") * F.col("certain")).alias("sure"))
    sums = wished.filter("bucket is not null").groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("rank").orderBy("bucket")
    # Up to here the words below a bucket are sums of at most ``buckets`` rows a source.
    edges = (
        sums.withColumn("upto", F.sum("words").over(upto))
        .join(targets.select("rank", "target"), "rank")
        .join(whole, "rank")
        .select(
            "rank",
            "bucket",
            (F.col("upto") - F.col("words")).alias("below"),
            (F.col("target") - F.col("sure")).alias("room"),
            (F.col("upto") <= F.col("target") - F.col("sure")).alias("inside"),
        )
    )
    placed = settle(wished.join(edges, ["rank", "bucket"], "left"), "mix-ranks")
    cut = (~F.col("inside")) & (F.col("below") <= F.col("room"))
    ranked = Window.partitionBy("rank").orderBy("order", "doc_id", "size")
    before = F.coalesce(
        F.sum("size").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    sorted_part = placed.filter(cut).withColumn(
        "extra", (F.col("below") + before + F.col("size") / 2 <= F.col("room")).cast("bigint")
    )
    rest = placed.filter(~F.coalesce(cut, F.lit(False))).withColumn(
        "extra", F.coalesce(F.col("inside"), F.lit(False)).cast("bigint")
    )
    copies = F.col("certain") + F.col("extra")
    return sorted_part.unionByName(rest).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The mix itself: each document as often as ``mix`` takes it, all columns kept,
    whatever their names.

    Rows with one id, source and size are told apart by their turn: in the order of
    ``row_hash``, those first that are taken more often.
    """

    def key(doc_id: Column, source: Column, size: Column) -> Column:
        return F.to_json(F.struct(doc_id.alias("i"), source.alias("s"), size.alias("n")))

    found = mix(docs, id_col, text_col, source_col, **options)
    found = found.select(key(F.col("doc_id"), F.col("source"), F.col("size")).alias("key"), "copies")
    found = found.withColumn(
        "turn", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("copies")))
    ).filter("copies > 0")
    size = F.size(words_of(text_of(text_col))).cast("bigint")
    turn = F.row_number().over(Window.partitionBy("key").orderBy("hash"))
    return (
        docs.select(
            whole_row(docs).alias("row"),
            key(F.col(quoted(id_col)), F.col(quoted(source_col)), size).alias("key"),
            row_hash(docs).alias("hash"),
        )
        .withColumn("turn", turn)
        .join(found, ["key", "turn"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint"))))
        .select("row.*")
    )
