"""Quality rules: base statistics and a learned decision list.

The list is learned by sequential covering. A rule is a conjunction of threshold
conditions for one class of bad documents; it grows by the condition of largest
information gain on two thirds of the labelled rows, is cut back to the prefix
that does best on the other third, and is accepted if it is precise there. Rows
that it covers are set aside and the next rule is grown. The result is an ordered
list, emitted as one Spark conditional expression.

All labelled rows take part. What reaches the driver is one histogram a step: a
count for each feature and bin, whatever the number of rows. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, let, quoted, settle, text_of, whole_row, words_of

LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: Places of the candidate thresholds among the sorted labelled values.
CUTS = (0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.94, 0.97, 0.99)
FEATURES = (
    "symbol_share", "repeat_share", "dup_line_share", "mean_word", "distinct_share", "upper_share",
    "mark_share", "line_words",
)


def repeated_words(words: Column) -> Column:
    """Words in windows of five that occur at least twice in the text.

    Windows are compared by a 64-bit hash chained over their words' hashes. Texts
    without a repeated window, the usual case, cost one hash set; in others the
    windows are sorted by hash, and the places of equal neighbours are joined to
    runs.
    """

    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, F.lit(1), F.size(h) - (WINDOW - 1)),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def places(s: Column) -> Column:
        same = F.transform(
            s,
            lambda e, j: F.when(
                (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["i"]
            ),
        )
        return F.sort_array(F.filter(same, lambda x: x.isNotNull()))

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(
            let(let(pairs, places), covered)
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("bigint")).otherwise(
        let(let(hashes, windows), count)
    )


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per document: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and the FEATURES. A null text counts as empty;
    shares of nothing are 0.
    """
    text = F.col("_text")

    def chars(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    share = lambda a, b: F.when(b > 0, F.round(a / b, 3)).otherwise(F.lit(0.0))
    counted = (
        docs.select(*keep, text_of(text_col).alias("_text"))
        .withColumn("_words", words_of(text))
        .withColumn("_lines", lines)
        .select(
            *keep,
            F.size("_words").cast("bigint").alias("n_words"),
            chars(SPACE).cast("bigint").alias("word_chars"),
            chars(r"[^#*$%&|<>]+").cast("bigint").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
            repeated_words(F.col("_words")).alias("n_repeat_words"),
            F.size("_lines").alias("_n_lines"),
            F.size(F.array_distinct("_words")).alias("_distinct"),
            chars("[^A-Z]+").alias("_upper"),
            chars("[^!?]+").alias("_marks"),
        )
    )
    n, c = F.col("n_words"), F.col("word_chars")
    return counted.withColumns(
        {
            "base_failed": (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n),
            "symbol_share": share(F.col("n_symbols"), c),
            "repeat_share": share(F.col("n_repeat_words"), n),
            "dup_line_share": share(F.col("n_dup_lines"), F.col("_n_lines")),
            "mean_word": share(c, n),
            "distinct_share": share(F.col("_distinct"), n),
            "upper_share": share(F.col("_upper"), c),
            "mark_share": share(F.col("_marks"), c),
            "line_words": F.least(share(n, F.col("_n_lines")), F.lit(1000.0)),
        }
    ).drop("_n_lines", "_distinct", "_upper", "_marks")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold!r}D"


@dataclass
class Rule:
    conditions: list[Condition]
    precision: float
    covered: int

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def rule_number(self) -> Column:
        """The first rule that holds, from 1; 0 where none does."""
        found = None
        for at, rule in enumerate(self.rules, 1):
            test = F.expr(rule.sql())
            found = F.when(test, F.lit(at)) if found is None else found.when(test, F.lit(at))
        return F.lit(0) if found is None else found.otherwise(F.lit(0))

    def rejects(self) -> Column:
        return self.rule_number() > 0


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(
    labelled: DataFrame,
    features: tuple[str, ...] = FEATURES,
    bad: str = "bad",
    fold: str = "fold",
    most_rules: int = 8,
    most_conditions: int = 3,
    least_precision: float = 0.97,
    least_covered: int = 10,
) -> DecisionList:
    """The decision list of ``labelled``: FEATURES, ``bad`` (boolean) and ``fold``
    (boolean: true for the third that prunes). Rows with a null label or feature
    are left out. With no rows, or one class only, the list is empty and rejects
    nothing. Ties go to the feature and threshold named first.
    """
    used = labelled.dropna(subset=[*features, bad, fold])
    cuts = used.agg(*[F.percentile(f, F.array(*[F.lit(q) for q in CUTS])).alias(f) for f in features]).first()
    if cuts is None or cuts[0] is None:
        return DecisionList()
    thresholds = {f: sorted({round(float(x), 4) for x in cuts[f]}) for f in features}

    def bin_of(f: str) -> Column:
        steps = [(F.col(f) >= F.lit(t)).cast("int") for t in thresholds[f]]
        return sum(steps[1:], steps[0])

    # Rows that agree in all bins are one row with a count.
    cells = settle(
        used.select(F.col(bad).alias("bad"), F.col(fold).alias("prune"), *[bin_of(f).alias(f) for f in features])
        .groupBy("bad", "prune", *features)
        .agg(F.count(F.lit(1)).alias("n")),
        "quality-cells",
    )

    def test(c: Condition) -> Column:
        at = thresholds[c.feature].index(c.threshold)
        return F.col(c.feature) > at if c.above else F.col(c.feature) <= at

    def histogram(rows: DataFrame) -> dict:
        pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features])
        counts: dict = {}
        for r in (
            rows.select("bad", "prune", "n", F.explode(pairs).alias("x"))
            .groupBy("x.f", "x.b", "bad", "prune")
            .agg(F.sum("n").alias("n"))
            .collect()
        ):
            counts[r.f, r.b, r.bad, r.prune] = r.n
        return counts

    def choices(counts: dict):
        """Each condition with its counts: grow bad, grow good, prune bad, prune good."""
        for f in features:
            bins = range(len(thresholds[f]) + 1)
            table = {k: [counts.get((f, b, *k), 0) for b in bins] for k in ((True, False), (False, False), (True, True), (False, True))}
            for at, t in enumerate(thresholds[f]):
                for above in (True, False):
                    part = slice(at + 1, None) if above else slice(None, at + 1)
                    yield Condition(f, above, t), [sum(v[part]) for v in table.values()]

    found = DecisionList()
    left = cells
    while len(found.rules) < most_rules:
        rows, conditions, scores, so_far = left, [], [], None
        while len(conditions) < most_conditions:
            counts = histogram(rows)
            if so_far is None:
                first = features[0]
                so_far = [
                    sum(v for (f, _, *k), v in counts.items() if f == first and k == [b, False])
                    for b in (True, False)
                ]
            p0, n0 = so_far
            if 2 * p0 < least_covered or n0 == 0:
                break
            best, best_gain = None, 0.0
            for c, (p, n, pp, pn) in choices(counts):
                gain = _gain(p, n, p0, n0)
                if 2 * p >= least_covered and gain > best_gain + 1e-9:
                    best, best_gain = (c, p, n, pp, pn), gain
            if best is None:
                break
            c, p, n, pp, pn = best
            conditions.append(c)
            scores.append((p, n, pp, pn))
            so_far = [p, n]
            rows = rows.filter(test(c))
        if not scores:
            break
        # The prefix of largest worth on the pruning rows, the shorter one on a tie.
        worth = [(pp - pn) / (pp + pn) if pp + pn else -1.0 for _, _, pp, pn in scores]
        keep = worth.index(max(worth)) + 1
        p, n, pp, pn = scores[keep - 1]
        precision = pp / (pp + pn) if pp + pn else 0.0
        if p + pp < least_covered or min(precision, p / (p + n)) < least_precision:
            break
        conditions = conditions[:keep]
        found.rules.append(Rule(conditions, precision, p + pp))
        hit = test(conditions[0])
        for c in conditions[1:]:
            hit = hit & test(c)
        left = left.filter(~hit)
    return found


def labelled_statistics(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality"
) -> DataFrame:
    """Statistics of the labelled documents with ``bad`` and ``fold``. Label 0 is
    bad, any other value good; the fold follows from the id. Ids that are labelled
    twice count by their smallest label."""
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
        .dropna()
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    return (
        stats.join(known, F.col(id_col) == F.col("_id"))
        .withColumn("bad", F.col("_label") == 0)
        .withColumn("fold", F.pmod(F.xxhash64("_id"), F.lit(3)) == 0)
        .drop("_id", "_label")
    )


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id as doc_id, the statistics, base_failed, rule (number of the
    rule that rejects it, else 0) and kept."""
    renamed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    stats = settle(statistics(renamed), "quality-statistics")
    known = labels.withColumnRenamed(id_col, "doc_id")
    rules = learn(labelled_statistics(stats, known))
    return stats.withColumn("rule", rules.rule_number()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def kept_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that the rules keep, all columns. The list is learned from the
    labelled documents alone and then tested on every row where it lies. Further
    columns may have any names."""
    ids = F.col(quoted(id_col))
    known = labels.select(ids.alias("labelled")).dropna().distinct()
    texts = docs.select(ids.alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    sample = texts.join(known, F.col("doc_id") == F.col("labelled"), "left_semi")
    stats = settle(statistics(sample), "quality-labelled")
    rules = learn(labelled_statistics(stats, labels.withColumnRenamed(id_col, "doc_id")))
    rows = docs.select(whole_row(docs).alias("row"), F.col(quoted(text_col)).alias("text"))
    return statistics(rows, "text", ("row",)).filter(~F.col("base_failed") & ~rules.rejects()).select("row.*")
