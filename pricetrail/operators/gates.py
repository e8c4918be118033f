"""Row-count gates, carry-forward of last-good rows, and collection health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CURRENT_SCHEMA
from .ordered import global_value

# Floors, ratios and limits of the gates.
TOTAL_FLOOR = 100
TIER_FLOORS = {
    "anthropic": 10,
    "openai": 25,
    "google": 50,
    "xai": 10,
    "aws": 5,
    "deepseek": 2,
    "qwen": 3,
}
COMPONENT_FLOORS = {
    "anthropic": 30,
    "openai": 90,
    "google": 120,
    "xai": 30,
    "aws": 18,
    "deepseek": 6,
    "qwen": 6,
}
PROVIDER_RATIO = 0.45
TOTAL_RATIO = 0.5
MAX_AGE_HOURS = 30
SOURCES = ("meter", "ledger", "wrapper")


def counts_by_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _floor_map(floors: Mapping[str, int]) -> Column:
    return F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(v))])


def provider_counts(new: DataFrame, old: DataFrame, floors: Mapping[str, int]) -> DataFrame:
    """Rows per provider now and before, one row for every provider with a floor.

    Both snapshots are counted in one aggregation; the zero rows come from the
    floor table itself.
    """
    spark = new.sparkSession
    floor_rows = spark.range(1).select(
        F.explode(_floor_map(floors)).alias("provider_id", "__f")
    )
    side = [
        new.select("provider_id", F.lit(1).alias("now"), F.lit(0).alias("before")),
        old.select("provider_id", F.lit(0).alias("now"), F.lit(1).alias("before")),
        floor_rows.select("provider_id", F.lit(0).alias("now"), F.lit(0).alias("before")),
    ]
    both = side[0].unionByName(side[1]).unionByName(side[2])
    return (
        both.groupBy("provider_id")
        .agg(F.sum("now").alias("current"), F.sum("before").alias("previous"))
        .withColumn("floor", F.try_element_at(_floor_map(floors), F.col("provider_id")))
    )


def sanity_issues(
    new: DataFrame,
    old: DataFrame,
    old_schema: str | None,
    floors: Mapping[str, int] = TIER_FLOORS,
    total_floor: int = TOTAL_FLOOR,
) -> DataFrame:
    """Rule violations of a new snapshot: (scope, rule, current, bound, detail)."""
    return issues_of(provider_counts(new, old, floors), old_schema, total_floor)


def issues_of(counts: DataFrame, old_schema: str | None, total_floor: int = TOTAL_FLOOR) -> DataFrame:
    """Rule violations of provider counts; the total is a rollup of the same rows."""
    rolled = counts.rollup("provider_id").agg(
        F.grouping("provider_id").alias("is_total"),
        F.sum("current").alias("current"),
        F.sum("previous").alias("previous"),
        F.max("floor").alias("floor"),
    )
    total = F.col("is_total") == 1
    listed = ~total & F.col("floor").isNotNull()
    known = F.lit(old_schema == CURRENT_SCHEMA) & (F.col("previous") > 0)
    share = F.greatest(F.lit(1), F.floor(F.col("previous") * PROVIDER_RATIO))
    percent = int(PROVIDER_RATIO * 100)
    current = F.col("current")
    found = F.array_compact(F.array(
        F.when(total & (current < total_floor), _issue("total_floor", F.lit(total_floor), F.format_string(
            f"total rows %d below minimum floor {total_floor}", current))),
        F.when(total & known & (current < F.col("previous") * TOTAL_RATIO), _issue("total_ratio", F.col("previous"), F.format_string(
            "total rows %d dropped below 50%% of previous snapshot (%d)", current, "previous"))),
        F.when(listed & (current < F.col("floor")), _issue("provider_floor", F.col("floor"), F.format_string(
            "%s rows %d below provider floor %d", "provider_id", current, "floor"))),
        F.when(listed & known & (current < share), _issue("provider_ratio", share, F.format_string(
            f"%s rows %d below {percent}%% of previous snapshot (%d)", "provider_id", current, "previous"))),
    ))
    scope = F.when(total, "total").otherwise(F.col("provider_id"))
    return rolled.select(scope.alias("scope"), F.inline(found))


def _issue(rule: str, bound: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.col("current").cast("long").alias("current"),
        bound.cast("long").alias("bound"),
        detail.alias("detail"),
    )


def _collapsed(old_schema: str | None) -> tuple[Column, Column]:
    """(whether a provider's rows collapsed, the rows expected of it)."""
    expected = F.greatest(F.col("floor"), F.floor(F.col("previous") * PROVIDER_RATIO))
    weak = (
        F.lit(old_schema == CURRENT_SCHEMA)
        & F.col("floor").isNotNull()
        & (F.col("previous") > 0)
        & (F.col("current") < expected)
    )
    return weak, expected


def fallback_providers(
    new: DataFrame, old: DataFrame, old_schema: str | None, floors: Mapping[str, int] = TIER_FLOORS
) -> DataFrame:
    """Providers whose rows collapsed: at most one row per entry of ``floors``."""
    weak, expected = _collapsed(old_schema)
    return provider_counts(new, old, floors).filter(weak).select(
        "provider_id", "current", "previous", expected.cast("long").alias("expected")
    )


def carry_forward(
    new: DataFrame, old: DataFrame, old_schema: str | None, floors: Mapping[str, int] = TIER_FLOORS
) -> DataFrame:
    """Current rows of healthy providers plus previous rows of collapsed ones.

    The fallback list is no longer than ``floors``, so both filters broadcast it.
    """
    weak = F.broadcast(fallback_providers(new, old, old_schema, floors).select("provider_id"))
    kept = new.join(weak, "provider_id", "left_anti").withColumn("carried", F.lit(False))
    carried = old.join(weak, "provider_id", "left_semi").withColumn("carried", F.lit(True))
    return kept.unionByName(carried)


def run_outcome(
    new: DataFrame,
    old: DataFrame,
    old_schema: str | None,
    floors: Mapping[str, int] = TIER_FLOORS,
    total_floor: int = TOTAL_FLOOR,
) -> DataFrame:
    """One row: status after remediation, carried providers, issues left.

    Failed with any issue left, degraded after a fallback, else success. The
    counts after remediation follow from the counts before it, so the rows are
    read once and never merged.
    """
    counts = provider_counts(new, old, floors)
    weak, _ = _collapsed(old_schema)
    after = counts.withColumn("weak", F.coalesce(weak, F.lit(False))).withColumn(
        "current", F.when(F.col("weak"), F.col("previous")).otherwise(F.col("current"))
    )
    carried = after.filter("weak").select(
        F.lit(1).alias("is_carried"), F.lit(0).alias("is_issue"), F.col("provider_id").alias("what")
    )
    issues = issues_of(after, old_schema, total_floor).select(
        F.lit(0).alias("is_carried"), F.lit(1).alias("is_issue"), F.lit(None).cast("string").alias("what")
    )
    # Both sides are no longer than the list of floors.
    return carried.unionByName(issues).agg(
        F.when(F.sum("is_issue") > 0, "failed").when(F.sum("is_carried") > 0, "degraded").otherwise("success").alias("status"),
        F.array_join(F.sort_array(F.collect_list("what")), ",").alias("carried_providers"),
        F.coalesce(F.sum("is_issue"), F.lit(0)).alias("issues_left"),
    )


def gate_checks(
    rows: DataFrame,
    schema_version: Column,
    age_hours: Column,
    latest_history: Column,
    report_status: Column,
    floors: Mapping[str, int] = TIER_FLOORS,
    total_floor: int = TOTAL_FLOOR,
) -> DataFrame:
    """Named checks of one snapshot with ``passed`` for each and for all.

    The four inputs that are not row counts come as constants or scalar
    subqueries; the counts are one aggregation.
    """
    counts = [F.count_if(F.col("provider_id") == p).alias(f"n_{p}") for p in floors]
    one = rows.agg(F.count(F.lit(1)).alias("n"), *counts).withColumns({
        "__schema": schema_version,
        "__age": age_hours,
        "__history": latest_history,
        "__report": report_status,
    })

    def check(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail")
        )

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    checks = [
        check("schema_version", F.col("__schema") == CURRENT_SCHEMA,
              F.concat(F.lit("schema_version="), shown("__schema"))),
        check("pricing_json_recency", F.col("__age") <= MAX_AGE_HOURS,
              F.coalesce(F.format_string("age_hours=%.1f", F.col("__age")), F.lit("last_run_datetime missing"))),
        check("total_row_floor", F.col("n") >= total_floor,
              F.format_string(f"rows=%d floor={total_floor}", "n")),
        *[
            check(f"provider_floor_{p}", F.col(f"n_{p}") >= floor,
                  F.format_string(f"{p}=%d floor={floor}", f"n_{p}"))
            for p, floor in floors.items()
        ],
        check("history_freshness", F.col("__history").isNotNull(),
              F.concat(F.lit("latest="), shown("__history"))),
        check("run_report_status", F.col("__report").isin("success", "degraded"),
              F.concat(F.lit("status="), shown("__report"))),
    ]
    listed = one.select(F.array(*checks).alias("checks"))
    return listed.select(
        F.forall("checks", lambda c: c["passed"]).alias("all_passed"), F.inline("checks")
    )


def collection_health(panel: DataFrame, attempts: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Health of each (panel row, source) on that source's latest attempt date.

    ``attempts`` has source, provider_id, tier, date, run_status, error,
    api_model, run_at and ``ord``. It is reduced to one row per (source,
    provider, tier, date) before anything else happens.
    """
    tried = attempts.filter(
        F.col("run_status").isNotNull() & (F.col("run_status") != "dry_run") & F.col("source").isin(*sources)
    )
    ok = F.col("run_status") == "ok"
    newest = F.struct(F.coalesce("run_at", F.lit("")).alias("at"), (-F.col("ord")).alias("o"))
    daily = tried.groupBy("source", "provider_id", "tier", "date").agg(
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("bad"),
        F.max_by(F.struct("error", "api_model"), F.when(~ok, newest)).alias("err"),
    )
    latest = daily.groupBy("source").agg(F.max("date").alias("latest_observed"))
    # At most one row per source, and the sources are a short fixed list.
    dated = daily.join(F.broadcast(latest), "source")
    now = F.col("date") == F.col("latest_observed")
    per_source = dated.groupBy("source", "provider_id", "tier").agg(
        F.sum(F.when(now, F.col("ok")).otherwise(0)).alias("ok_count"),
        F.sum(F.when(now, F.col("bad")).otherwise(0)).alias("error_count"),
        F.max(F.when(F.col("ok") > 0, F.col("date"))).alias("last_ok"),
        F.max(F.when(now, F.col("err.error"))).alias("last_error"),
        F.max(F.when(now, F.col("err.api_model"))).alias("last_error_model"),
    )
    grid = panel.select(
        "provider_id", "tier", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    )
    return (
        grid.join(per_source, ["source", "provider_id", "tier"], "left")
        .join(F.broadcast(latest), "source", "left")
        .select(
            "provider_id",
            "tier",
            "source",
            "latest_observed",
            F.coalesce("ok_count", F.lit(0)).alias("ok_count"),
            F.coalesce("error_count", F.lit(0)).alias("error_count"),
            "last_ok",
            "last_error",
            "last_error_model",
        )
    )


def panel_status(health: DataFrame) -> DataFrame:
    """Per panel row: reporting anywhere, and the sources that only failed."""
    dark = (F.col("error_count") > 0) & (F.col("ok_count") == 0)
    return health.groupBy("provider_id", "tier").agg(
        F.bool_or(F.col("ok_count") > 0).alias("reporting"),
        F.array_join(F.sort_array(F.collect_set(F.when(dark, F.col("source")))), ",").alias("dark_sources"),
    )


def health_summary(status: DataFrame) -> DataFrame:
    label = F.concat_ws("·", "provider_id", "tier")
    return status.agg(
        F.count_if("reporting").alias("reporting_count"),
        F.count(F.lit(1)).alias("panel_count"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(~F.col("reporting"), label))), ","
        ).alias("dark"),
    )


def failing_rows(health: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """The panel rows that keep a source from passing, one row each.

    ``kind`` is dark (only failures) or silent (never tried). The gate's details put
    the same rows into one text per source; this is the form for large panels.
    """
    kind = F.when(F.col("ok_count") > 0, None).when(F.col("error_count") > 0, "dark").otherwise("silent")
    rows = health.filter(F.col("source").isin(*sources)).withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("source", "provider_id", "tier", "kind", "error_count", "last_error_model", "last_error")


def gate_collection(health: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Per source: no row that only failed, and no row that was never tried.

    An empty health table fails instead of passing unseen.
    """
    label = F.concat_ws("·", "provider_id", "tier")
    dark = (F.col("ok_count") == 0) & (F.col("error_count") > 0)
    silent = (F.col("ok_count") == 0) & (F.col("error_count") == 0)
    failed = F.concat(
        label, F.lit(" ("), F.coalesce("last_error_model", F.lit("None")), F.lit("): "),
        F.coalesce("last_error", F.lit("None")),
    )
    wanted = health.filter(F.col("source").isin(*sources))
    per_source = wanted.groupBy("source").agg(
        F.sort_array(F.collect_list(F.when(dark, failed))).alias("dark"),
        F.sort_array(F.collect_list(F.when(silent, label))).alias("silent"),
    )

    def check(kind: str, clear: str, sep: str) -> Column:
        return F.struct(
            F.concat_ws("_", F.col("source"), F.lit(f"no_{kind}_providers")).alias("name"),
            (F.size(kind) == 0).alias("passed"),
            F.coalesce(F.nullif(F.array_join(kind, sep), F.lit("")), F.lit(clear)).alias("detail"),
        )

    rows = per_source.select(F.inline(F.array(
        check("dark", "every panel row reported at least once", "; "),
        check("silent", "every panel row was attempted", ", "),
    )))
    present = health.select("provider_id", "tier").distinct().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("provider_health_present").alias("name"),
        (F.col("n") > 0).alias("passed"),
        F.format_string("%d panel rows", "n").alias("detail"),
    )
    return present.unionByName(rows)


def best_attempt(rows: DataFrame, floors: Mapping[str, int] = COMPONENT_FLOORS) -> DataFrame:
    """Per source keep the attempt with most rows, the later one on ties.

    ``rows`` has provider_id and attempt. ``low_yield`` flags a result below
    the source's floor.
    """
    sized = rows.groupBy("provider_id", "attempt").agg(F.count(F.lit(1)).alias("n"))
    floor = F.coalesce(F.try_element_at(_floor_map(floors), F.col("provider_id")), F.lit(0))
    return (
        sized.groupBy("provider_id")
        .agg(
            F.max(F.struct("n", "attempt")).alias("best"),
            F.count(F.lit(1)).alias("attempts"),
        )
        .select(
            "provider_id",
            F.col("best.attempt").alias("attempt"),
            F.col("best.n").alias("rows"),
            "attempts",
            (F.col("best.n") < floor).alias("low_yield"),
        )
    )


def source_summary(rows: DataFrame) -> DataFrame:
    """Per source: status, row counts and the last date with a good row."""
    ok = F.col("run_status") == "ok"
    return rows.groupBy("source").agg(
        F.when(F.count_if(ok) > 0, "active").otherwise("pending_first_run").alias("status"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(ok).alias("ok_row_count"),
        F.max(F.when(ok, F.col("date"))).alias("last_observed_date"),
    )


def status_histogram(rows: DataFrame) -> DataFrame:
    """One row: counts per status, and as text."""
    counts = rows.groupBy("run_status").agg(F.count(F.lit(1)).alias("n"))
    entry = F.concat(F.coalesce("run_status", F.lit("None")), F.lit(": "), F.col("n").cast("string"))
    return counts.agg(
        F.sum("n").alias("total"),
        F.array_join(F.sort_array(F.collect_list(entry)), ", ").alias("summary"),
    )


def latest_slice(rows: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the newest date, found by a scalar subquery."""
    return rows.filter(F.col(date) == global_value(rows, F.max(date)))


def latest_runs(rows: DataFrame, date: str = "date") -> DataFrame:
    """One row: newest date, its rows, all rows, and its workhorse replicates.

    Counts per date come first, so the newest date is picked from one row per day.
    """
    replicate = F.when(F.col("tier") == "workhorse", F.coalesce("replicate", F.lit(1)))
    per_day = rows.groupBy(date).agg(F.count(F.lit(1)).alias("n"), F.max(replicate).alias("reps"))
    return per_day.agg(
        F.max(date).alias("latest_date"),
        F.max_by("n", date).alias("latest_row_count"),
        F.sum("n").alias("total_row_count"),
        F.coalesce(F.max_by(F.struct("reps"), date)["reps"], F.lit(1)).alias("workhorse_replicates"),
    )


def alternation_checks(turns: DataFrame, user_words: tuple[int, int], assistant_words: tuple[int, int]) -> DataFrame:
    """Per conversation: even turns are the user's, odd ones the assistant's, and
    each message keeps its word budget. Needs no window: a turn knows its place."""
    user = F.col("turn") % 2 == 0
    role_ok = F.col("role") == F.when(user, "user").otherwise("assistant")
    low = F.when(F.col("role") == "user", user_words[0]).otherwise(assistant_words[0])
    high = F.when(F.col("role") == "user", user_words[1]).otherwise(assistant_words[1])
    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col("role") == "user").alias("user_turns"),
        F.count_if(F.col("role") == "assistant").alias("assistant_turns"),
        F.bool_and(F.coalesce(role_ok, F.lit(False))).alias("alternates"),
        F.bool_and(F.col("words").between(low, high)).alias("word_budget"),
        (F.max("turn") - F.min("turn") + 1 == F.count(F.lit(1))).alias("complete"),
    )


