"""Schemas of the documents and tables, and the field lists results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, L, I = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Price fields in display order, and the current document version.
PRICE_FIELDS = (
    "input",
    "cached_input",
    "output",
    "cache_read",
    "cache_write_5m",
    "cache_write_1h",
    "training",
    "generation",
)
PRICE_COLUMNS = tuple(f"{f}_price" for f in PRICE_FIELDS)
SERIES_PRICES = ("input_price", "output_price", "cached_input_price")
TRACKED_FIELDS = ("is_active", "currency", *[f"{f}_{p}" for f in PRICE_FIELDS for p in ("price", "unit")])
CURRENT_SCHEMA = "2.1.0"

COMPONENT = _struct(
    pricing_id=S, model_id=S, display_name=S, provider_id=S, component=S, price=D, unit=S,
    currency=S, service_tier=S, context_window=S, modality=S, category=S, billing_variant=S,
    is_active=B,
)
TIER = _struct(
    pricing_id=S, model_id=S, display_name=S, provider_id=S, service_tier=S, context_window=S,
    modality=S, category=S, billing_variant=S, currency=S, is_active=B,
    **{f"{f}_{p}": (D if p == "price" else S) for f in PRICE_FIELDS for p in ("price", "unit")},
)
# 1.x rows add two fields; both versions are read with the union of their fields.
PRICING_ROW = T.StructType([*TIER.fields, T.StructField("type", S), T.StructField("unit", S)])
PROVIDER = _struct(provider_id=S, name=S, pricing_source=S)
DOCUMENT = _struct(
    meta=_struct(last_run_datetime=S, schema_version=S, description=S),
    providers=T.ArrayType(PROVIDER),
    pricing=T.ArrayType(PRICING_ROW),
)
SERIES = _struct(
    date=T.DateType(), pricing_id=S, provider_id=S, model_id=S, display_name=S, service_tier=S,
    category=S, modality=S, context_window=S, input_price=D, output_price=D,
    cached_input_price=D, currency=S, is_active=B,
)
METER_RUN = _struct(
    run_date=S, run_week=S, mode=S, task_id=S, provider_id=S, tier=S, replicate=I, model_id=S,
    api_model=S, tokens_in=L, tokens_out=L, output_cap=L, output_censored=B, input_chars=L,
    corpus_version=S, output_policy_version=S, run_status=S, error=S, input_price=D,
    output_price=D, usd_value_same_day=D, implied_cost_per_1m=D, run_at=S,
)
LEDGER = _struct(
    date=S, provider_id=S, tier=S, task_id=S, model_id=S, api_model=S, tokens_in=L,
    input_chars=L, tokens_in_per_1k_chars=D, label=S, run_status=S, error=S, corpus_version=S,
    source=S, run_at=S,
)
WRAPPER = _struct(
    run_date=S, provider_id=S, tier=S, turn=I, model_id=S, api_model=S, api_prompt_tokens=L,
    prefix_chars=L, tokens_per_1k_chars=D, run_status=S, error=S, chat_corpus_version=S, run_at=S,
)
# The staging path keeps prices exact: decimal text casts, strict by default.
PRICE_DECIMAL = T.DecimalType(20, 10)
DONOR_CASTS = {
    "donor_id": "string",
    "org_type": "string",
    "platform": "string",
    "monthly_budget": "decimal(20,10)",
    "volatility": "decimal(20,10)",
    "weekend_factor": "decimal(20,10)",
    "subscription_start_date": "date",
    "billing_cycle": "string",
    "billing_cycle_days": "int",
    "current_cycle_start": "date",
    "current_cycle_end": "date",
    "days_remaining_in_cycle": "int",
}
INCIDENT = _struct(
    schema_version=S, incident_id=S, run_id=S, pipeline=S, repo=S, workflow=S, status=S,
    started_at=S, finished_at=S, commit_sha=S, workflow_run_id=S, workflow_run_url=S,
    artifact_links=T.ArrayType(S),
    remediation=_struct(attempted=B, actions=T.ArrayType(S), result=S, autonomy_tier=I),
    verification=_struct(
        passed=B, checks=T.ArrayType(_struct(name=S, passed=B, detail=S))
    ),
    context=_struct(row_count=L),
    error_message=S, error_signature=S, error_category=S, failed_step=S,
)
