"""Relations the queries share, and the registry they enter.

Each registered query is an operator applied to the benchmark tables; the SQL
beside it states the same result for the checker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import last_wins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FIELDS = ("click", "view", "purchase", "signup", "error")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flag(c: Column) -> Column:
    """Booleans leave as 0/1."""
    return c.cast("long")


def r4(c: Column) -> Column:
    return F.round(c.cast("double"), 4)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per (user, event type, day): the last one."""
    events = load(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("date"), "ts", "event_id", "value"
    )
    daily = last_wins(events, ["user_id", "event_type", "date"], ["ts", "event_id"])
    return daily.select(
        "user_id",
        "event_type",
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("pricing_id"),
        "date",
        "value",
        "event_id",
    )


OBS = """obs AS (
  SELECT user_id, event_type, user_id::VARCHAR || '-' || event_type AS pricing_id,
         ts::DATE AS date, value, event_id
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts::DATE ORDER BY ts DESC, event_id DESC) = 1)"""


def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as one row per (user, day) with a column per event type."""
    events = load(spark, sf_dir, "events")
    at = F.struct("ts", "event_id")
    return events.groupBy("user_id", F.to_date("ts").alias("date")).agg(*[
        F.max_by("value", F.when(F.col("event_type") == f, at)).alias(f"{f}_price") for f in FIELDS
    ])


TIER = OBS + """, tier AS (
  SELECT user_id, date,
    max(CASE WHEN event_type = 'click' THEN value END) AS click_price,
    max(CASE WHEN event_type = 'view' THEN value END) AS view_price,
    max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_price,
    max(CASE WHEN event_type = 'signup' THEN value END) AS signup_price,
    max(CASE WHEN event_type = 'error' THEN value END) AS error_price
  FROM obs GROUP BY ALL)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in the shape of price series rows."""
    obs = observations(spark, sf_dir)
    kind, value = F.col("event_type"), F.col("value")
    retired = (kind == "signup") & (F.col("date") >= F.lit("2024-01-20").cast("date"))
    return obs.select(
        "date",
        "pricing_id",
        kind.alias("provider_id"),
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("model_id"),
        F.concat(
            F.lit("Model "), F.col("user_id").cast("string"), F.when(retired, " ( retired )").otherwise("")
        ).alias("display_name"),
        F.lit("standard").alias("service_tier"),
        F.lit("standard_api").alias("category"),
        F.when(kind == "view", "audio").when(kind == "click", "text").alias("modality"),
        F.lit(None).cast("string").alias("context_window"),
        value.alias("input_price"),
        F.when(kind != "error", value * 2).alias("output_price"),
        F.when(kind.isin("click", "view"), value / 2).alias("cached_input_price"),
        F.lit("USD").alias("currency"),
        (~((kind == "error") & (value > 60))).alias("is_active"),
    )


SERIES = OBS + """, series AS (
  SELECT date, pricing_id, event_type AS provider_id, 'm' || user_id AS model_id,
    'Model ' || user_id || CASE WHEN event_type = 'signup' AND date >= DATE '2024-01-20'
      THEN ' ( retired )' ELSE '' END AS display_name,
    CASE WHEN event_type = 'view' THEN 'audio' WHEN event_type = 'click' THEN 'text' END AS modality,
    value AS input_price,
    CASE WHEN event_type <> 'error' THEN value * 2 END AS output_price,
    CASE WHEN event_type IN ('click', 'view') THEN value / 2 END AS cached_input_price,
    NOT (event_type = 'error' AND value > 60) AS is_active
  FROM obs)"""


def schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document version of each date: the first days are of the old kind."""
    old = F.col("date") < F.lit("2024-01-04").cast("date")
    return load(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct().withColumn(
        "schema_version", F.when(old, "1.2.0").otherwise("2.1.0")
    )


def day_of(rows: DataFrame, day: str) -> DataFrame:
    return rows.filter(F.col("date") == F.lit(day).cast("date"))
