"""Dedupe, pivot, unpivot and price conversion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as ms
from ..operators import ordered, tiers
from .base import FIELDS, OBS, TIER, flag, load, observations, query, r4, tiers as tier_rows


@query("dedupe_last_wins", """
  SELECT user_id::VARCHAR || '-' || event_type AS pricing_id, event_id, value
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_last_wins(spark, d):
    rows = load(spark, d, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("pricing_id"),
        "ts", "event_id", "value",
    )
    return tiers.dedupe_last_wins(rows, ["ts", "event_id"]).select("pricing_id", "event_id", "value")


@query("dedupe_first_wins", """
  SELECT value, event_id, user_id FROM events
  QUALIFY row_number() OVER (PARTITION BY value ORDER BY ts, event_id) = 1""")
def dedupe_first_wins(spark, d):
    rows = load(spark, d, "events").select("value", "ts", "event_id", "user_id")
    return ordered.first_wins(rows, ["value"], ["ts", "event_id"]).select("value", "event_id", "user_id")


COMPONENTS = """comp AS (
  SELECT 'p' || (user_id % 7) AS provider_id, 'user-' || user_id AS model_id,
    CASE WHEN event_id % 2 = 0 THEN 'User ' || user_id ELSE 'USER ' || user_id END AS display_name,
    CASE event_type WHEN 'click' THEN 'input' WHEN 'view' THEN 'output' WHEN 'purchase' THEN 'cache_write'
      WHEN 'signup' THEN 'training' ELSE 'generation' END AS component,
    value AS price,
    CASE WHEN user_id % 2 = 0 THEN 'standard' END AS service_tier,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '5m' ELSE '1h' END END AS billing_variant,
    value < 150 AS is_active, ts, event_id
  FROM events)"""


def component_input(spark, d):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    names = {"click": "input", "view": "output", "purchase": "cache_write", "signup": "training"}
    component = F.lit("generation")
    for k, v in names.items():
        component = F.when(kind == k, v).otherwise(component)
    even = F.col("event_id") % 2 == 0
    rows = load(spark, d, "events").select(
        F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("provider_id"),
        F.concat(F.lit("user-"), user).alias("model_id"),
        F.concat(F.when(even, "User ").otherwise("USER "), user).alias("display_name"),
        component.alias("component"),
        F.col("value").alias("price"),
        F.lit(ms.PER_MILLION).alias("unit"),
        F.when(F.col("user_id") % 2 == 0, "standard").alias("service_tier"),
        F.when(kind == "purchase", F.when(even, "5m").otherwise("1h")).alias("billing_variant"),
        (F.col("value") < 150).alias("is_active"),
        "ts",
        "event_id",
    )
    return tiers.component_rows(rows)


@query("component_pivot", f"""
  WITH {COMPONENTS}, f AS (
    SELECT *, CASE WHEN component = 'cache_write' THEN 'cache_write_' || billing_variant ELSE component END AS field,
      provider_id || '-' || model_id || coalesce('-' || service_tier, '') AS pricing_id FROM comp)
  SELECT pricing_id, arg_min(display_name, (ts, event_id)) AS display_name,
    bool_and(is_active)::BIGINT AS is_active,
    arg_max(price, (ts, event_id)) FILTER (field = 'input') AS input_price,
    arg_max(price, (ts, event_id)) FILTER (field = 'output') AS output_price,
    arg_max(price, (ts, event_id)) FILTER (field = 'cache_write_5m') AS cache_write_5m_price,
    arg_max(price, (ts, event_id)) FILTER (field = 'cache_write_1h') AS cache_write_1h_price,
    arg_max(price, (ts, event_id)) FILTER (field = 'training') AS training_price,
    arg_max(price, (ts, event_id)) FILTER (field = 'generation') AS generation_price,
    max(CASE WHEN field = 'input' THEN 'per_1M_tokens' END) AS input_unit
  FROM f GROUP BY pricing_id""")
def component_pivot(spark, d):
    out = tiers.component_pivot(component_input(spark, d), ["ts", "event_id"])
    return out.select(
        "pricing_id", "display_name", flag(F.col("is_active")).alias("is_active"),
        "input_price", "output_price", "cache_write_5m_price", "cache_write_1h_price",
        "training_price", "generation_price", "input_unit",
    )


@query("unpivot_prices", f"""
  WITH {TIER}
  SELECT user_id, date, 'click_tokens' AS sku_type, click_price AS price_usd FROM tier WHERE click_price IS NOT NULL
  UNION ALL SELECT user_id, date, 'view_tokens', view_price FROM tier WHERE view_price IS NOT NULL
  UNION ALL SELECT user_id, date, 'purchase_tokens', purchase_price FROM tier WHERE purchase_price IS NOT NULL
  UNION ALL SELECT user_id, date, 'signup_tokens', signup_price FROM tier WHERE signup_price IS NOT NULL
  UNION ALL SELECT user_id, date, 'error_tokens', error_price FROM tier WHERE error_price IS NOT NULL""")
def unpivot_prices(spark, d):
    names = {f: f"{f}_tokens" for f in FIELDS}
    return tiers.unpivot_prices(tier_rows(spark, d), names, ["user_id", "date"], units=False)


TYPED = """typed AS (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'chat' WHEN 'SMALL' THEN 'cache' ELSE 'image' END AS row_type,
    p_retailprice AS input_price, CASE WHEN p_size > 10 THEN p_retailprice * 2 END AS output_price FROM part)"""


@query("unpivot_typed", f"""
  WITH {TYPED}, u AS (
    SELECT p_partkey, 'base_input_tokens' AS sku_type, input_price AS p FROM typed
      WHERE row_type = 'chat' AND input_price IS NOT NULL
    UNION ALL SELECT p_partkey, 'output_tokens', output_price FROM typed
      WHERE row_type = 'chat' AND output_price IS NOT NULL
    UNION ALL SELECT p_partkey, 'cache_hit_refresh', input_price FROM typed
      WHERE row_type = 'cache' AND input_price IS NOT NULL)
  SELECT p_partkey, sku_type, p AS price_per_1m_tokens_usd, round(p / 1000, 6) AS price_per_1k_tokens_usd FROM u""")
def unpivot_typed(spark, d):
    kind = F.when(F.col("p_type") == "ECONOMY", "chat").when(F.col("p_type") == "SMALL", "cache").otherwise("image")
    rows = load(spark, d, "part").select(
        "p_partkey", kind.alias("row_type"), F.col("p_retailprice").alias("input_price"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice") * 2).alias("output_price"),
    )
    return tiers.unpivot_typed(rows, ["p_partkey"])


UNITS = """CASE p_size % 4 WHEN 0 THEN 'per_1M_tokens' WHEN 1 THEN 'per_1K_tokens' WHEN 2 THEN 'per_second' END"""


def part_unit():
    return (
        F.when(F.col("p_size") % 4 == 0, ms.PER_MILLION)
        .when(F.col("p_size") % 4 == 1, ms.PER_THOUSAND)
        .when(F.col("p_size") % 4 == 2, "per_second")
    )


@query("unit_convert", f"""
  WITH u AS (SELECT p_partkey, p_retailprice AS p, {UNITS} AS unit FROM part)
  SELECT p_partkey,
    CASE unit WHEN 'per_1M_tokens' THEN p WHEN 'per_1K_tokens' THEN p * 1000 END AS price_per_1m_tokens_usd,
    CASE unit WHEN 'per_1M_tokens' THEN round(p / 1000, 6) WHEN 'per_1K_tokens' THEN p END AS price_per_1k_tokens_usd,
    round(p * 1000, 6) AS scaled
  FROM u""")
def unit_convert(spark, d):
    rows = load(spark, d, "part").select(
        "p_partkey", F.col("p_retailprice").alias("price_usd"), part_unit().alias("unit")
    )
    return tiers.with_token_prices(rows).select(
        "p_partkey", "price_per_1m_tokens_usd", "price_per_1k_tokens_usd",
        ms.thousand_to_million(F.col("price_usd")).alias("scaled"),
    )


@query("any_column_equals", f"""
  WITH u AS (SELECT p_partkey, {UNITS} AS a,
      CASE WHEN p_type = 'ECONOMY' THEN 'per_1M_tokens' END AS b,
      CASE WHEN p_brand = 'Brand#2' THEN 'per_1M_tokens' ELSE 'per_hour' END AS c FROM part)
  SELECT p_partkey, (coalesce(a = 'per_1M_tokens', false) OR coalesce(b = 'per_1M_tokens', false)
     OR coalesce(c = 'per_1M_tokens', false))::BIGINT AS token_priced FROM u""")
def any_column_equals(spark, d):
    rows = load(spark, d, "part").select(
        "p_partkey",
        part_unit().alias("a"),
        F.when(F.col("p_type") == "ECONOMY", ms.PER_MILLION).alias("b"),
        F.when(F.col("p_brand") == "Brand#2", ms.PER_MILLION).otherwise("per_hour").alias("c"),
    )
    return rows.select(
        "p_partkey", flag(tiers.any_column_equals(ms.PER_MILLION, ["a", "b", "c"])).alias("token_priced")
    )


@query("best_by_score", """
  WITH s AS (SELECT p_brand AS provider_id, p_type AS model_id, p_partkey,
      p_size > 20 AS is_active, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS input_price,
      CASE WHEN p_size % 5 <> 0 THEN p_retailprice * 2 END AS output_price FROM part)
  SELECT provider_id, model_id, p_partkey, is_active::BIGINT AS is_active, input_price, output_price FROM s
  QUALIFY row_number() OVER (PARTITION BY provider_id, model_id ORDER BY
    is_active::INT + (input_price IS NOT NULL)::INT + (output_price IS NOT NULL)::INT DESC, p_partkey) = 1""")
def best_by_score(spark, d):
    rows = load(spark, d, "part").select(
        F.col("p_brand").alias("provider_id"), F.col("p_type").alias("model_id"), "p_partkey",
        (F.col("p_size") > 20).alias("is_active"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).alias("input_price"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") * 2).alias("output_price"),
    )
    best = tiers.best_by_score(rows, ["provider_id", "model_id"], "p_partkey")
    return best.withColumn("is_active", flag(F.col("is_active")))


@query("avg_by_key", f"""
  WITH {OBS}
  SELECT event_type AS provider, round(avg(value), 4) AS price_per_1m_tokens_usd,
    round(avg(CASE WHEN user_id % 2 = 0 THEN value / 1000 END), 6) AS price_per_1k_tokens_usd
  FROM obs GROUP BY 1""")
def avg_by_key(spark, d):
    return observations(spark, d).groupBy(F.col("event_type").alias("provider")).agg(
        r4(F.avg("value")).alias("price_per_1m_tokens_usd"),
        F.round(F.avg(F.when(F.col("user_id") % 2 == 0, F.col("value") / 1000)), 6).alias("price_per_1k_tokens_usd"),
    )


# A part as a price row: some attributes are missing, some names differ by case only.
SORTED = """rows AS (SELECT p_partkey, p_brand AS provider_id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_type) ELSE p_type END AS display_name,
    nullif(p_type, 'SMALL') AS service_tier, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '<=200k' ELSE '>200k' END AS context_window,
    CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 'text' ELSE 'audio' END AS modality,
    CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '5m' ELSE '1h' END AS billing_variant,
    CASE p_size % 7 WHEN 0 THEN 'output' WHEN 1 THEN NULL ELSE 'input' END AS component,
    CASE p_size % 2 WHEN 0 THEN 'per_1M_tokens' ELSE 'per_image' END AS unit FROM part)"""


def sortable(spark, d):
    size = F.col("p_size")
    return load(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("provider_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.upper("p_type")).otherwise(F.col("p_type")).alias("display_name"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("service_tier"),
        F.when(size % 4 == 1, "<=200k").when(size % 4 > 1, ">200k").alias("context_window"),
        F.when(size % 3 == 1, "text").when(size % 3 == 2, "audio").alias("modality"),
        F.when(size % 5 == 1, "5m").when(size % 5 > 1, "1h").alias("billing_variant"),
        F.when(size % 7 == 0, "output").when(size % 7 > 1, "input").alias("component"),
        F.when(size % 2 == 0, "per_1M_tokens").otherwise("per_image").alias("unit"),
    )


def sql_order(names):
    return ", ".join(f"coalesce({'lower(display_name)' if n == 'display_name' else n}, '')" for n in names)


@query("sort_nulls_first", f"""
  WITH {SORTED} SELECT *, row_number() OVER (ORDER BY {sql_order(tiers.TIER_SORT)}, p_partkey) - 1 AS position FROM rows""")
def sort_nulls_first(spark, d):
    """Tier rows by all six keys; their places show the order."""
    return tiers.sorted_positions(sortable(spark, d), tiers.TIER_SORT, ["p_partkey"])


@query("sort_components", f"""
  WITH {SORTED} SELECT *, row_number() OVER (ORDER BY {sql_order(tiers.COMPONENT_SORT)}, p_partkey) - 1 AS position FROM rows""")
def sort_components(spark, d):
    """Component rows by all eight keys."""
    return tiers.sorted_positions(sortable(spark, d), tiers.COMPONENT_SORT, ["p_partkey"])
