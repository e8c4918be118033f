"""Component rows, tier rows and price (SKU) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import text as tx
from ..schemas import PRICE_DECIMAL, PRICE_FIELDS
from .ordered import first_wins, last_wins, positions

# Sort keys of component and tier rows, and staging names.
COMPONENT_SORT = (
    "provider_id",
    "display_name",
    "component",
    "service_tier",
    "context_window",
    "modality",
    "billing_variant",
    "unit",
)
TIER_SORT = (
    "provider_id",
    "display_name",
    "service_tier",
    "context_window",
    "modality",
    "billing_variant",
)
SKU_TYPES = {
    "input": "input_tokens",
    "cached_input": "cached_input_tokens",
    "output": "output_tokens",
    "cache_read": "cache_read_tokens",
    "cache_write_5m": "cache_write_5m_tokens",
    "cache_write_1h": "cache_write_1h_tokens",
    "training": "training_hours",
    "generation": "generation",
}


def sort_keys(names: Sequence[str]) -> list[Column]:
    """Sort expressions: nulls as empty text, display names without case."""
    return [
        F.coalesce(F.lower(n) if n == "display_name" else F.col(n), F.lit("")).asc() for n in names
    ]


def sort_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.orderBy(*sort_keys(names))


def sorted_positions(df: DataFrame, names: Sequence[str], ties: Sequence[str] = ("pricing_id",), out: str = "position") -> DataFrame:
    """Rows with their place in the sort by ``names``; equal ones by ``ties``."""
    return positions(df, [*sort_keys(names), *[F.col(t) for t in ties]], out)


def component_rows(df: DataFrame, strict_ids: bool = False) -> DataFrame:
    """Fill the defaults of a component row and give it its id."""
    defaults = {
        "unit": F.lit(None).cast("string"),
        "currency": F.lit("USD"),
        "service_tier": F.lit(None).cast("string"),
        "context_window": F.lit(None).cast("string"),
        "modality": F.lit(None).cast("string"),
        "category": F.lit(None).cast("string"),
        "billing_variant": F.lit(None).cast("string"),
        "is_active": F.lit(True),
    }
    missing = {n: c for n, c in defaults.items() if n not in df.columns}
    return df.withColumns(missing).withColumn("pricing_id", tx.pricing_id(strict_ids))


def dedupe_last_wins(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = ("pricing_id",)) -> DataFrame:
    return last_wins(rows, list(keys), list(order))


def component_pivot(
    rows: DataFrame, order: Sequence[str], strict_ids: bool = False, keep_other: bool = False
) -> DataFrame:
    """Component rows to tier rows.

    Prices and units are the last per field, descriptive fields the first, and
    a tier is active only if all its rows are. Cache-write components share one
    tier whatever their variant. Fields outside the fixed list (a cache write of
    another variant) are dropped, or kept in a map with ``keep_other``.
    """
    cache_write = F.col("component") == "cache_write"
    variant = tx.slugify(F.col("billing_variant"))
    field = F.when(
        cache_write, F.concat_ws("_", F.lit("cache_write"), F.nullif(variant, F.lit("")))
    ).otherwise(F.col("component"))
    at = F.struct(*order)
    key = ["provider_id", "model_id", "service_tier", "context_window", "modality", "category", "billing_variant"]
    shaped = rows.withColumn("__field", field).withColumn(
        "billing_variant", F.when(~cache_write, F.col("billing_variant"))
    )
    aggs = [
        F.min_by("display_name", at).alias("display_name"),
        F.min_by("currency", at).alias("currency"),
        F.bool_and(F.coalesce("is_active", F.lit(True))).alias("is_active"),
    ]
    for f in PRICE_FIELDS:
        mine = F.when(F.col("__field") == f, at)
        aggs += [
            F.max_by(F.struct("price", "unit"), mine).alias(f"__{f}"),
        ]
    tiers = shaped.groupBy(*key).agg(*aggs).select(
        tx.tier_id(strict_ids).alias("pricing_id"),
        *key,
        "display_name",
        "currency",
        "is_active",
        *[F.col(f"__{f}.price").alias(f"{f}_price") for f in PRICE_FIELDS],
        *[F.col(f"__{f}.unit").alias(f"{f}_unit") for f in PRICE_FIELDS],
    )
    if not keep_other:
        return tiers
    other = shaped.filter(~F.col("__field").isin(*PRICE_FIELDS))
    # One entry per field name of a tier, so the list stays short.
    extra = (
        last_wins(other.select(*key, "__field", "price", *order), [*key, "__field"], order)
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("__field", "price"))).alias("other_prices"))
    )
    condition = None
    for k in key:
        term = tiers[k].eqNullSafe(extra[k])
        condition = term if condition is None else condition & term
    return tiers.join(extra, condition, "left").select(tiers["*"], extra["other_prices"])


def unpivot_prices(
    df: DataFrame, fields: dict[str, str], keep: Sequence[str], units: bool = True
) -> DataFrame:
    """One row per non-null price, in one pass over the input.

    ``fields`` maps a price field to its ``sku_type``.
    """
    entries = F.array(*[
        F.struct(
            F.lit(sku).alias("sku_type"),
            F.col(f"{f}_price").alias("price_usd"),
            *([F.col(f"{f}_unit").alias("unit")] if units else []),
        )
        for f, sku in fields.items()
    ])
    present = F.filter(entries, lambda e: e["price_usd"].isNotNull())
    return df.select(*keep, F.inline(present))


def stage_prices(documents: DataFrame) -> DataFrame:
    """Documents with a parsed ``doc`` column to staged price rows."""
    row = (
        documents.select(
            "content_sha256",
            "ingested_at",
            F.col("doc.meta.schema_version").alias("schema_version"),
            F.col("doc.meta.last_run_datetime").alias("pricing_version"),
            F.inline("doc.pricing"),
        )
        .withColumnsRenamed({"provider_id": "provider", "model_id": "model"})
        .withColumns({f"{f}_price": F.col(f"{f}_price").cast(PRICE_DECIMAL) for f in PRICE_FIELDS})
    )
    keep = [
        "content_sha256", "ingested_at", "schema_version", "pricing_version", "pricing_id",
        "provider", "model", "display_name", "service_tier", "context_window", "modality",
        "category", "billing_variant", "currency", "is_active",
    ]
    return with_token_prices(unpivot_prices(row, SKU_TYPES, keep))


def with_token_prices(skus: DataFrame) -> DataFrame:
    price, unit = F.col("price_usd"), F.col("unit")
    return skus.withColumns({
        "price_per_1m_tokens_usd": ms.per_million(price, unit),
        "price_per_1k_tokens_usd": ms.per_thousand(price, unit),
    })


def unpivot_typed(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The older staging shape: which price counts depends on the row type."""
    entries = F.array(
        F.struct(
            F.lit("base_input_tokens").alias("sku_type"),
            F.when(F.col("row_type") == "chat", F.col("input_price")).alias("price"),
        ),
        F.struct(
            F.lit("output_tokens").alias("sku_type"),
            F.when(F.col("row_type") == "chat", F.col("output_price")).alias("price"),
        ),
        F.struct(
            F.lit("cache_hit_refresh").alias("sku_type"),
            F.when(F.col("row_type") == "cache", F.col("input_price")).alias("price"),
        ),
    )
    return df.select(
        *keep, F.inline(F.filter(entries, lambda e: e["price"].isNotNull()))
    ).select(
        *keep,
        "sku_type",
        F.col("price").alias("price_per_1m_tokens_usd"),
        F.round(F.col("price") / 1000, ms.PRICE_DIGITS).alias("price_per_1k_tokens_usd"),
    )


def any_column_equals(value: str, columns: Sequence[str]) -> Column:
    """Whether any of the columns equals ``value``; nulls never do."""
    return F.coalesce(F.array_contains(F.array(*columns), value), F.lit(False))


def best_by_score(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: most of (active, input price, output price); first on ties."""
    score = (
        F.coalesce(F.col("is_active"), F.lit(False)).cast("int")
        + F.col("input_price").isNotNull().cast("int")
        + F.col("output_price").isNotNull().cast("int")
    )
    return first_wins(rows.withColumn("__rank", -score), list(keys), ["__rank", order]).drop("__rank")
