"""Model panel: precedence merge, ordered candidates, budgets and run plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import clamp

# Cadences, packs and the assumed characters per token.
RUNS_PER_YEAR = {"daily": 365, "weekly": 52, "biweekly": 26, "monthly": 12}
TASK_PACKS = {
    "qa": ["A"],
    "summarize": ["B"],
    "code": ["C"],
    "long": ["D"],
    "chat": ["E"],
    "suite": ["A", "B", "C"],
    "suiteLong": ["A", "B", "C", "D", "E"],
}
METER_TASKS = ("A", "B", "C", "D")
CHARS_PER_TOKEN = 4


def precedence_merge(history: DataFrame, live: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of two keyed tables; a live row replaces the whole history row."""
    rest = [c for c in live.columns if c not in keys]
    old = history.select(*keys, F.struct(*[F.col(c) for c in rest]).alias("__old"))
    new = live.select(*keys, F.struct(*[F.col(c) for c in rest]).alias("__new"))
    return (
        old.join(new, list(keys), "full_outer")
        .select(*keys, F.coalesce("__new", "__old").alias("__row"), F.col("__new").isNotNull().alias("is_live"))
        .select(*keys, "__row.*", "is_live")
    )


def candidate_rows(df: DataFrame, ids: str = "candidates") -> DataFrame:
    """Preference lists to (provider, tier, pos, model_id)."""
    return df.select("provider_id", "tier", F.posexplode(ids).alias("pos", "model_id"))


def first_match(candidates: DataFrame, models: DataFrame) -> DataFrame:
    """First active candidate of each (provider, tier) with both prices."""
    usable = (
        F.col("input_price").isNotNull()
        & F.col("output_price").isNotNull()
        & F.coalesce("is_active", F.lit(True))
    )
    found = candidates.join(models.filter(usable), ["provider_id", "model_id"])
    return (
        found.groupBy("provider_id", "tier")
        .agg(F.min_by(F.struct("model_id", "display_name", "input_price", "output_price", "pos"), "pos").alias("m"))
        .select("provider_id", "tier", "m.*")
    )


def fallbacks(candidates: DataFrame, models: DataFrame, chosen: DataFrame) -> DataFrame:
    """The other known candidates of each chosen row, with their place in the list.

    One row per fallback, so a long preference list is never gathered.
    """
    pick = chosen.select("provider_id", "tier", F.col("model_id").alias("chosen_id"))
    return (
        candidates.join(models.select("provider_id", "model_id", "input_price", "output_price"), ["provider_id", "model_id"])
        .join(pick, ["provider_id", "tier"])
        .filter(F.col("model_id") != F.col("chosen_id"))
        .select("provider_id", "tier", "pos", "model_id", "input_price", "output_price")
    )


def pack_budget(
    models: DataFrame,
    tasks: DataFrame,
    packs: Mapping[str, Sequence[str]] = TASK_PACKS,
    cadences: Mapping[str, int] = RUNS_PER_YEAR,
) -> DataFrame:
    """Worst-case cost of one run of each pack, and per year by cadence.

    Cost is a sum over models and tasks of ``a*b + c*d`` with one factor from
    each side, so two small sums replace the product of the tables.
    """
    priced = models.filter(F.col("input_price").isNotNull() & F.col("output_price").isNotNull())
    in_sum = priced.agg(F.coalesce(F.sum("input_price"), F.lit(0.0)))
    out_sum = priced.agg(F.coalesce(F.sum("output_price"), F.lit(0.0)))
    members = F.create_map(*[x for p, ids in packs.items() for x in (F.lit(p), F.array(*map(F.lit, ids)))])
    empty = tasks.sparkSession.range(1).select(F.explode(members).alias("pack_id", "ids")).select(
        "pack_id", F.lit(0.0).alias("t_in"), F.lit(0.0).alias("t_out")
    )
    spent = tasks.select("*", F.explode(members).alias("pack_id", "ids")).filter(
        F.array_contains("ids", F.col("task_id"))
    ).select(
        "pack_id",
        (F.col("input_chars") / F.lit(float(CHARS_PER_TOKEN)) / F.lit(1e6)).alias("t_in"),
        (F.col("output_cap") / F.lit(1e6)).alias("t_out"),
    )
    per_pack = empty.unionByName(spent).groupBy("pack_id").agg(
        F.sum("t_in").alias("t_in"), F.sum("t_out").alias("t_out")
    )
    per_run = F.col("t_in") * in_sum.scalar() + F.col("t_out") * out_sum.scalar()
    yearly = F.create_map(*[x for n, k in cadences.items() for x in (F.lit(n), F.col("per_run_usd") * k)])
    return per_pack.select("pack_id", per_run.alias("per_run_usd")).withColumn("annual_usd_by_cadence", yearly)


def plan_grid(
    panel: DataFrame,
    tasks: Sequence[str] = METER_TASKS,
    workhorse_replicates: int = 1,
) -> DataFrame:
    """Run plan: every panel row × replicate × task, workhorses repeated."""
    reps = F.when(F.col("tier") == "workhorse", F.lit(max(1, workhorse_replicates))).otherwise(F.lit(1))
    return panel.select("*", F.explode(F.sequence(F.lit(1), reps)).alias("replicate")).select(
        "*", F.explode(F.array(*[F.lit(t) for t in tasks])).alias("task_id")
    )


def turn_grid(panel: DataFrame, max_turn: Column) -> DataFrame:
    """Every panel row × turn, with the number of turns held to 1..10."""
    return panel.select("*", F.explode(F.sequence(F.lit(1), clamp(max_turn, 1, 10))).alias("turn"))


def rule_rank_topk(
    rows: DataFrame, group: Sequence[str], rules: Sequence[Column], order: Sequence[str], k: int = 8
) -> DataFrame:
    """Top ``k`` per group by the first rule a row meets, then by ``order``.

    Spark cuts each map task to ``k`` rows per group before the shuffle.
    """
    rank = F.lit(len(rules))
    for place, rule in reversed(list(enumerate(rules))):
        rank = F.when(rule, F.lit(place)).otherwise(rank)
    by = Window.partitionBy(*group).orderBy("rule_rank", *order)
    return (
        rows.withColumn("rule_rank", rank)
        .withColumn("place", F.row_number().over(by))
        .filter(F.col("place") <= k)
    )


def prefix_matches(wanted: DataFrame, ids: DataFrame) -> DataFrame:
    """For each wanted id: an exact match, else the newest dated one.

    An id matches the dash-separated prefixes it starts with, so each id is
    spread over its few prefixes and the join is an equality.
    """
    bits = F.split(F.col("id"), "-")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(bits)), lambda n: F.array_join(F.slice(bits, F.lit(1), n), "-")
    )
    spread = (
        ids.select("id", F.explode(heads).alias("wanted"))
        .groupBy("wanted")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.max(F.when(F.col("id") == F.col("wanted"), F.col("id"))).alias("exact"),
            F.max(F.when(F.col("id") != F.col("wanted"), F.col("id"))).alias("newest"),
        )
    )
    dashed = wanted.select(F.translate("wanted", ".", "-").alias("wanted")).distinct()
    return dashed.join(spread, "wanted", "left").select(
        "wanted",
        F.coalesce("exact", "newest", "wanted").alias("resolved"),
        F.coalesce("matches", F.lit(0)).alias("matches"),
    )


def dict_lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped value, or the key itself."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), key)


def ordered_distinct(*lists: Column) -> Column:
    """Concatenate lists and keep the first of equal entries."""
    return F.array_distinct(F.concat(*lists))


def include_exclude(
    column: Column, solo: str | None = None, hidden: Sequence[str] = (), only: Sequence[str] | None = None
) -> Column:
    """Visibility test: one solo value, else not hidden and, if given, listed."""
    if solo is not None:
        return column == solo
    test = ~column.isin(*hidden) if hidden else F.lit(True)
    return test & column.isin(*only) if only is not None else test
