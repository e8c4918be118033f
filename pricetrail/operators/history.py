"""Questions over the snapshot history: series, changes, lifecycle, as-of, diff."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import text as tx
from ..schemas import PRICE_COLUMNS, SERIES_PRICES, TRACKED_FIELDS
from ..session import checkpointed
from .ordered import ROWS_PER_CHUNK, carry_last, global_value, last_wins, positions
from .tiers import any_column_equals

# Units that make a row token-priced.
TOKEN_UNIT_COLUMNS = ("input_unit", "output_unit", "cached_input_unit", "cache_read_unit")


def normalize_versions(rows: DataFrame) -> DataFrame:
    """Exploded document rows (``date``, ``schema_version``, fields) to series rows."""
    old = F.coalesce(F.col("schema_version"), F.lit("")).startswith("1.")
    token_priced = any_column_equals(ms.PER_MILLION, TOKEN_UNIT_COLUMNS)
    standard = F.col("service_tier").isNull() | (F.col("service_tier") == "standard")
    keep = F.when(old, (F.col("type") == "chat") & (F.col("unit") == ms.PER_MILLION)).otherwise(
        token_priced & standard
    )
    kind = F.coalesce(F.col("type"), F.lit("chat"))
    tier = F.coalesce(F.nullif(F.col("service_tier"), F.lit("")), F.lit("standard"))
    return rows.filter(
        tx.owned_rows(F.col("provider_id"), F.col("model_id"), F.col("display_name"))
    ).filter(keep).select(
        "date",
        F.when(old, F.concat_ws("-", "provider_id", "model_id", kind))
        .otherwise(F.col("pricing_id"))
        .alias("pricing_id"),
        "provider_id",
        "model_id",
        F.coalesce(F.nullif(F.col("display_name"), F.lit("")), F.col("model_id")).alias("display_name"),
        F.when(old, "standard").otherwise(tier).alias("service_tier"),
        F.when(old, "standard_api").otherwise(F.col("category")).alias("category"),
        "modality",
        "context_window",
        "input_price",
        "output_price",
        F.when(~old, F.col("cache_read_price")).alias("cached_input_price"),
        F.coalesce(F.col("currency"), F.lit("USD")).alias("currency"),
        F.coalesce(F.col("is_active"), F.lit(True)).alias("is_active"),
    )


def from_epoch(df: DataFrame, start: str, column: str = "date") -> DataFrame:
    """Rows on or after the start date; a date partition filter when partitioned."""
    return df.filter(F.col(column) >= F.lit(start).cast(df.schema[column].dataType))


def change_events(
    series: DataFrame,
    fields: Sequence[str] = SERIES_PRICES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Price moves per id and field against the last known value.

    ``series`` holds one row per id and day, so a window partition is at most
    one id's days; rows without a value are gone before the window runs.
    """
    values = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("to_value")) for f in fields
    ])
    long = series.select(
        "pricing_id", "date", *keep, F.inline(F.filter(values, lambda v: v["to_value"].isNotNull()))
    )
    by = Window.partitionBy("pricing_id", "field").orderBy("date")
    moved = long.withColumns({
        "from_value": F.lag("to_value").over(by),
        "prev_date": F.lag("date").over(by),
    }).filter(F.col("from_value") != F.col("to_value"))
    delta = F.col("to_value") - F.col("from_value")
    return moved.select(
        "pricing_id",
        *keep,
        "field",
        "prev_date",
        "date",
        "from_value",
        "to_value",
        delta.alias("delta"),
        ms.percent(delta, F.col("from_value")).alias("pct"),
    )


def newest_first(events: DataFrame) -> DataFrame:
    """Change events by date, newest first, then provider, model, name, id and field, with
    their ``position``."""
    blank = F.lit("")
    names = [F.coalesce(c, blank) for c in ("provider_id", "model_id", "display_name")]
    return positions(events, [F.col("date").desc(), *names, F.col("pricing_id"), F.col("field")])


def changed_ids(series: DataFrame, field: str) -> DataFrame:
    """Ids with more than one distinct non-null value of ``field``."""
    return (
        series.groupBy("pricing_id")
        .agg(F.min(field).alias("__lo"), F.max(field).alias("__hi"))
        .filter(F.col("__lo") < F.col("__hi"))
        .select("pricing_id")
    )


def changed_only(series: DataFrame, field: str) -> DataFrame:
    return series.join(changed_ids(series, field), "pricing_id", "left_semi")


def needs_context(rows: DataFrame) -> DataFrame:
    """(provider, model) pairs listed under more than one context window."""
    context = F.nullif(F.col("context_window"), F.lit(""))
    return (
        rows.groupBy("provider_id", "model_id")
        .agg(F.min(context).alias("__lo"), F.max(context).alias("__hi"))
        .filter(F.col("__lo") < F.col("__hi"))
        .select("provider_id", "model_id")
    )


def lifecycle(series: DataFrame, schemas: DataFrame, order: Sequence[str] = ("date",)) -> DataFrame:
    """One row per id: first and last sight, deprecation, and latest prices.

    ``schemas`` holds the document version of each date, one row per date; ids last seen under a
    1.x version are renames, not retirements, and are left out. ``record_start``
    is the first date of the whole record. The series is read once: the facts of
    each id are written, and the record's bounds are theirs.
    """
    at = F.struct(*order)
    flagged = ~F.col("is_active") | tx.marks_deprecation(F.col("display_name"))
    last_fields = [
        "provider_id", "model_id", "display_name", "category", "is_active",
        "input_price", "output_price", "cached_input_price", "currency",
    ]
    per_id = checkpointed(series.groupBy("pricing_id").agg(
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
        F.max(F.when(F.col("is_active"), F.col("date"))).alias("last_active"),
        F.min(F.when(flagged, F.col("date"))).alias("deprecated_on"),
        F.max_by(F.struct(*last_fields), at).alias("__last"),
    ), "lifecycle")
    old = F.coalesce(F.col("schema_version"), F.lit("")).startswith("1.")
    # One row per date of the record, whatever the number of ids.
    by_date = F.broadcast(schemas.select(F.col("date").alias("last_seen"), "schema_version"))
    dated = per_id.join(by_date, "last_seen", "left").filter(~old)
    latest = global_value(per_id, F.max("last_seen"))
    start = global_value(per_id, F.min("first_seen"))
    present = F.col("last_seen") == F.col("__latest")
    return dated.withColumns({"__latest": latest, "__start": start}).select(
        "pricing_id",
        F.col("__last.provider_id").alias("provider_id"),
        F.col("__last.model_id").alias("model_id"),
        F.col("__last.display_name").alias("display_name"),
        F.col("__last.category").alias("category"),
        "first_seen",
        "last_seen",
        "last_active",
        "deprecated_on",
        F.when(~present, F.col("last_seen")).alias("disappeared_after"),
        present.alias("currently_present"),
        (present & F.col("__last.is_active")).alias("currently_active"),
        tx.marks_deprecation(F.col("__last.display_name")).alias("name_marks_deprecation"),
        F.col("__last.input_price").alias("latest_input"),
        F.col("__last.output_price").alias("latest_output"),
        F.col("__last.cached_input_price").alias("latest_cached_input"),
        F.coalesce(F.col("__last.currency"), F.lit("USD")).alias("currency"),
        F.col("__start").alias("record_start"),
    )


def by_model(models: DataFrame) -> DataFrame:
    """Models with their ``position`` by provider, model and id; empty names first."""
    blank = F.lit("")
    return positions(models, [F.coalesce("provider_id", blank), F.coalesce("model_id", blank), F.col("pricing_id")])


def index_summary(series: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row: dates, bounds, counts and the version of each date."""
    days = series.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(schemas, "date", "left").agg(
        F.sort_array(F.collect_list("date")).alias("dates"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("snapshot_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("date", F.coalesce("schema_version", F.lit("")))))
        ).alias("schema_versions"),
    )


def active_only(series: DataFrame, models: DataFrame) -> DataFrame:
    """Series of models that are listed, active and not named as retired."""
    live = models.filter(F.col("currently_active") & ~F.col("name_marks_deprecation"))
    return series.join(live.select("pricing_id"), "pricing_id", "left_semi")


def archive_view(models: DataFrame, first_date: Column, flagged: bool = False) -> DataFrame:
    """Models that left or are leaving, newest end first.

    ``first_date`` is the first date of the record (a constant or a scalar
    subquery); ``days_floor`` marks a run that may have begun before it.
    """
    ended = F.col("deprecated_on").isNotNull() | F.col("name_marks_deprecation")
    if flagged:
        keep = ended | (F.col("currently_present") & ~F.col("currently_active"))
    else:
        keep = ended | ~F.col("currently_present")
    retired = F.coalesce(
        F.col("deprecated_on"), F.when(~F.col("currently_present"), F.col("last_seen"))
    )
    return (
        models.withColumn("__start", first_date)
        .filter(keep)
        .select(
            "pricing_id",
            "provider_id",
            "display_name",
            "first_seen",
            "deprecated_on",
            F.when(~F.col("currently_present"), F.col("last_seen")).alias("last_listed"),
            retired.alias("retired_on"),
            ms.days_between(F.col("first_seen"), retired).alias("days_active"),
            (F.col("first_seen") == F.col("__start")).alias("days_floor"),
            F.coalesce("deprecated_on", "disappeared_after").alias("sort_date"),
            "latest_input",
            "latest_output",
        )
        .orderBy(F.col("sort_date").desc_nulls_last(), "pricing_id")
    )


def asof_value(points: DataFrame, date: str, keys: Sequence[str] = ("pricing_id",)) -> DataFrame:
    """Last value of each line on or before a day; null for lines not yet begun."""
    day = F.lit(date).cast("date")
    seen = F.when(F.col("date") <= day, F.struct("date", *[c for c in ("ord",) if c in points.columns]))
    return points.groupBy(*keys).agg(F.max_by("value", seen).alias("value"))


def asof_rank(points: DataFrame, date: str) -> DataFrame:
    """Lines ordered by their value on a day, highest first, missing last."""
    return asof_value(points, date).orderBy(F.col("value").desc_nulls_last(), "pricing_id")


def asof_join(
    facts: DataFrame,
    prices: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    out: str,
    order: str,
    strict: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Price each fact with the last earlier price of its key.

    Facts and prices form one timeline and the price is carried along it: one
    shuffle, no range join. At equal times a price counts unless ``strict``.
    """
    side = F.lit(1 if strict else 0)
    fact_side = F.lit(0 if strict else 1)
    blank = F.lit(None).cast(prices.schema[value].dataType)
    rest = [c for c in facts.columns if c not in (*keys, time)]
    left = facts.select(
        *keys, time, fact_side.alias("__side"), F.col(order).alias("__ord"), blank.alias("__price"),
        F.struct(*rest).alias("__fact"),
    )
    right = prices.select(
        *keys, time, side.alias("__side"), F.col(order).alias("__ord"), F.col(value).alias("__price"),
        F.lit(None).cast(left.schema["__fact"].dataType).alias("__fact"),
    )
    line = carry_last(
        left.unionByName(right), keys, [time, "__side", "__ord"], "__price", out, rows_per_chunk
    )
    return line.filter(F.col("__fact").isNotNull()).select(*keys, time, "__fact.*", out)


def latest_per_line(points: DataFrame) -> DataFrame:
    """Newest point of each line, with the newest date over all lines."""
    newest = global_value(points, F.max("date"))
    return (
        points.groupBy("pricing_id")
        .agg(F.max("date").alias("date"), F.max_by("value", "date").alias("value"))
        .withColumn("default_date", newest)
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, order: Sequence[str], tracked: Sequence[str] = TRACKED_FIELDS
) -> DataFrame:
    """NEW, CHANGED and REMOVED ids between two snapshots.

    Both sides are reduced to one row per id before the join, so the join key
    is unique on each side.
    """
    before = last_wins(old, ["pricing_id"], order).select(
        "pricing_id", F.struct(*[c for c in old.columns if c != "pricing_id"]).alias("old")
    )
    after = last_wins(new, ["pricing_id"], order).select(
        "pricing_id", F.struct(*[c for c in new.columns if c != "pricing_id"]).alias("new")
    )
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"old.{f}").eqNullSafe(F.col(f"new.{f}")), f) for f in tracked
    ]))
    joined = before.join(after, "pricing_id", "full_outer").withColumn("changed_fields", changed)
    kind = (
        F.when(F.col("old").isNull(), "NEW_TIER")
        .when(F.col("new").isNull(), "REMOVED_TIER")
        .when(F.size("changed_fields") > 0, "PRICE_CHANGED")
    )
    return joined.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(
        "kind",
        "pricing_id",
        F.when(F.col("kind") == "PRICE_CHANGED", F.col("changed_fields"))
        .otherwise(F.array().cast("array<string>"))
        .alias("changed_fields"),
        "old",
        "new",
    )


def format_changes(
    diff: DataFrame,
    prices: Sequence[str] = PRICE_COLUMNS,
    units: Mapping[str, str] | None = None,
    describe: Sequence[str] = ("service_tier", "context_window", "modality", "billing_variant"),
    show=lambda c: c.cast("string"),
) -> DataFrame:
    """One line of text per change."""
    units = units or {p: p.replace("_price", "_unit") for p in prices}
    side = F.when(F.col("kind") == "REMOVED_TIER", F.col("old")).otherwise(F.col("new"))

    def text(c: Column) -> Column:
        return F.coalesce(show(c), F.lit("None"))

    def money(c: Column) -> Column:
        return F.concat(F.lit("$"), text(c))

    listed = F.array_join(F.array_compact(F.array(*[
        F.when(
            F.col(f"new.{p}").isNotNull(),
            F.concat(F.lit(f"{p}: "), money(F.col(f"new.{p}")), F.lit(" "),
                     F.coalesce(F.col(f"new.{units[p]}"), F.lit("None"))),
        )
        for p in prices
    ])), "; ")
    moved = F.array_join(F.array_compact(F.array(*[
        F.when(
            ~F.col(f"new.{p}").eqNullSafe(F.col(f"old.{p}")),
            F.concat(F.lit(f"{p}: "), money(F.col(f"old.{p}")), F.lit(" -> "), money(F.col(f"new.{p}")),
                     F.lit(" ("), F.coalesce(F.col(f"new.{units[p]}"), F.lit("None")), F.lit(")")),
        )
        for p in prices
    ])), "; ")
    detail = (
        F.when(F.col("kind") == "NEW_TIER", listed)
        .when(F.col("kind") == "PRICE_CHANGED", F.coalesce(F.nullif(moved, F.lit("")), F.lit("metadata changed")))
        .otherwise("")
    )
    named = diff.withColumn("__row", side)
    title = tx.describe_row(F.col("__row.display_name"), *[F.col(f"__row.{d}") for d in describe])
    return named.select("kind", "pricing_id", title.alias("title"), detail.alias("detail"))


