"""Quality rules: a decision list learned by sequential covering.

Statistics of every text are column expressions. Labelled rows are cut into the
buckets of each statistic's quantiles; sequential covering grows a conjunction of
thresholds that separates bad rows, one aggregate of bucket counts for each
condition, prunes it on rows held back from growing, takes it into the list if it
is precise enough, and goes on with the rows it leaves. The list is an ordered
chain of conditional expressions over the statistics.

What reaches the driver is counts: statistics x buckets x classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import NOT_SPACE, query, table

WINDOW = 8
#: Base rule: fewer words, or a larger share of words in repeated windows, fail.
MIN_WORDS = 20
MAX_REPEATED = 30

#: Statistics that rules may use.
MEASURES = ("mean_chars", "symbols", "upper", "marks", "distinct", "dup_lines", "repeated", "line_words")
#: Quantiles that give the thresholds of each statistic.
QUANTILES = tuple(i / 20 for i in range(1, 20)) + (0.005, 0.01, 0.02, 0.98, 0.99, 0.995)
MAX_RULES = 8
MAX_CONDITIONS = 3
#: A rule needs this share of bad rows among those it covers, and so many of them.
PRECISION = 0.95
SUPPORT = 5


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, measures...)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(NOT_SPACE), F.lit(0)))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NOT_SPACE))
    rows = rows.withColumn("lines", lines).withColumn("n_words", F.size("words").cast("long"))
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    windows = F.when(
        F.col("n_words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("words"), i, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        "doc_id", "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count("text", F.lit("[!?]")).alias("n_marks"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        windows.alias("windows"),
    )
    # Only a text with equal windows needs them in order.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("ordered", F.when(twice, F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    ordered = F.col("ordered")
    starts = F.array_sort(F.transform(
        F.filter("ordered", lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1))), lambda x: x["i"]))
    rows = rows.withColumn("starts", starts)
    covered = F.aggregate(
        "starts", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    n = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / n).alias("mean_chars"), (F.col("n_symbols") / n).alias("symbols"),
        (F.col("n_upper") / chars).alias("upper"), (F.col("n_marks") / n).alias("marks"),
        (F.col("n_distinct") / n).alias("distinct"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_lines"),
        (F.col("n_repeat_words") / n).alias("repeated"),
        (F.col("n_words") / F.greatest("n_lines", F.lit(1))).alias("line_words"))


@dataclass(frozen=True)
class Condition:
    """A statistic above (or not above) a threshold; ``bucket`` is the threshold's number."""

    measure: str
    above: bool
    threshold: float
    bucket: int

    def column(self) -> Column:
        c = F.col(self.measure)
        return c > self.threshold if self.above else c <= self.threshold

    def on_buckets(self) -> Column:
        c = F.col(f"b_{self.measure}")
        return c > self.bucket if self.above else c <= self.bucket

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, on) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & on(c)
    return out


def _bucketed(labelled: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Counts of labelled rows by fold, class and bucket of each statistic, and the thresholds."""
    cuts = labelled.agg(*[F.percentile_approx(m, list(QUANTILES), 10_000).alias(m) for m in MEASURES]).first()
    thresholds = {m: sorted(set(cuts[m] or [])) for m in MEASURES}

    def bucket(m: str) -> Column:
        """How many thresholds lie below the value: value > threshold k says bucket > k."""
        return sum((F.col(m) > t).cast("int") for t in thresholds[m]) if thresholds[m] else F.lit(0)

    grow = F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0
    rows = labelled.select(grow.alias("grow"), "bad", *[bucket(m).alias(f"b_{m}") for m in MEASURES])
    return checkpointed(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "quality_buckets"), thresholds


def _best_condition(rows: DataFrame, thresholds, base: tuple[int, int]) -> tuple[float, Condition, tuple[int, int]] | None:
    """The condition of the highest information gain over the given rows."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"b_{m}").alias("b")) for m in MEASURES]))
    counts = rows.select("bad", "n", cells.alias("c")).groupBy("c.m", "c.b").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(~F.col("bad"), F.col("n")).otherwise(0)).alias("q")).collect()
    p0, q0 = base
    best = None
    for m in MEASURES:
        own = sorted((r["b"], r["p"], r["q"]) for r in counts if r["m"] == m)
        for k, t in enumerate(thresholds[m]):
            low = (sum(p for b, p, _ in own if b <= k), sum(q for b, _, q in own if b <= k))
            for above, (p, q) in ((False, low), (True, (p0 - low[0], q0 - low[1]))):
                if p < SUPPORT or (p, q) == (p0, q0):
                    continue
                gain = p * (math.log2(p / (p + q)) - math.log2(p0 / (p0 + q0)))
                if best is None or gain > best[0]:
                    best = (gain, Condition(m, above, t, k), (p, q))
    return best


def _class_counts(rows: DataFrame) -> tuple[int, int]:
    r = rows.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(k) for k, c in (("p", F.col("bad")), ("q", ~F.col("bad")))]).first()
    return r["p"], r["q"]


def learn_rules(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """A decision list for bad rows from ``labels`` (doc_id, quality), 0 being bad.

    Labels without a document or without a value are left out; repeated labels
    count each. Without bad rows the list is empty.
    """
    labels = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_labelled"), (F.col("quality") == 0).alias("bad"))
    labelled = checkpointed(
        stats.join(labels, stats["doc_id"] == labels["_labelled"]).select("doc_id", "bad", *MEASURES), "quality_labelled")
    rows, thresholds = _bucketed(labelled)
    rules: list[Rule] = []
    for _ in range(MAX_RULES):
        grow, prune = rows.filter("grow"), rows.filter("NOT grow")
        rule: Rule = ()
        now = _class_counts(grow)
        while now[0] >= SUPPORT and now[1] and len(rule) < MAX_CONDITIONS:
            found = _best_condition(grow, thresholds, now)
            if found is None or found[0] <= 0:
                break
            rule, now = (*rule, found[1]), found[2]
            grow = grow.filter(found[1].on_buckets())
        if not rule:
            break
        # Pruning: the prefix with the best (bad - good) / (bad + good) on the held-back rows.
        scored = []
        for k in range(1, len(rule) + 1):
            p, q = _class_counts(prune.filter(_all(rule[:k], Condition.on_buckets)))
            scored.append(((p - q) / (p + q) if p + q else -1.0, -k, p, q))
        worth, k, p, q = max(scored)
        rule = rule[:-k]
        if p < SUPPORT or p < PRECISION * (p + q):
            break
        rules.append(rule)
        rows = rows.filter(~_all(rule, Condition.on_buckets))
    return rules


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule (from 1) that covers a row, else 0."""
    out = None
    for i, rule in enumerate(rules, 1):
        when = _all(rule, Condition.column)
        out = F.when(when, i) if out is None else out.when(when, i)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of every row of ``docs`` (doc_id, text), base_failed, rule and kept.

    ``rule`` is the number of the learned rule that covers the row (0: none).

    Defined cases: null text has no words and fails the base rule, as does any text
    of fewer than twenty words; without labels no rule is learned; repeated rows get
    equal results; a row without a doc_id is judged but not learned from; empty
    tables give no rows. Other columns are not read.
    """
    stats = checkpointed(statistics(docs.select("doc_id", "text")), "quality_statistics")
    rules = learn_rules(stats, labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = stats.withColumn("base_failed", failed).withColumn("rule", decision(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@query("op8_quality")
def op8_quality(spark, sf_dir):
    """Quality statistics and verdict of all documents, learned from all labels."""
    rows = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
