"""Queries over the observation history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import history as h
from ..operators import ordered, panel
from ..operators.gates import counts_by_key as count_rows
from ..sources import store
from ..sources.readers import limited
from ..session import checkpointed
from .base import OBS, SERIES, TIER, flag, load, observations, query, r4, schemas, series, tiers


@query("change_events", f"""
  WITH {OBS}, l AS (SELECT *, lag(value) OVER w AS from_value, lag(date) OVER w AS prev_date FROM obs
      WINDOW w AS (PARTITION BY pricing_id ORDER BY date))
  SELECT pricing_id, 'value' AS field, prev_date, date, from_value, value AS to_value,
    round(value - from_value, 4) AS delta,
    round(((value - from_value) / nullif(from_value, 0) * 100)::DECIMAL(38, 15), 1)::DOUBLE AS pct
  FROM l WHERE from_value <> value""")
def change_events(spark, d):
    events = h.change_events(observations(spark, d), ["value"])
    return events.withColumn("delta", r4(F.col("delta")))


@query("events_newest_first", f"""
  WITH {SERIES}, l AS (SELECT *, lag(input_price) OVER w AS from_value FROM series WINDOW w AS (PARTITION BY pricing_id ORDER BY date)),
  e AS (SELECT * FROM l WHERE from_value <> input_price)
  SELECT pricing_id, provider_id, model_id, date, from_value, input_price AS to_value,
    dense_rank() OVER (ORDER BY date DESC)::BIGINT AS day_place,
    row_number() OVER (PARTITION BY date ORDER BY provider_id, model_id, display_name, pricing_id)::BIGINT AS place FROM e""")
def events_newest_first(spark, d):
    """Places come from the order of the sorted rows, so a wrong order shows."""
    keep = ["provider_id", "model_id", "display_name"]
    rows = checkpointed(h.newest_first(h.change_events(series(spark, d), ["input_price"], keep)), "sorted_events")
    # One row per day.
    days = ordered.positions(rows.groupBy("date").agg(F.min("position").alias("first")), [F.col("first")], "day_place")
    return rows.join(days, "date").select(
        "pricing_id", "provider_id", "model_id", "date", "from_value", "to_value",
        (F.col("day_place") + 1).alias("day_place"), (F.col("position") - F.col("first") + 1).alias("place"))


@query("change_events_wide", f"""
  WITH {TIER}, u AS (UNPIVOT tier ON click_price, view_price, purchase_price INTO NAME field VALUE v),
  l AS (SELECT *, lag(v) OVER w AS from_value, lag(date) OVER w AS prev_date FROM u
      WINDOW w AS (PARTITION BY user_id, field ORDER BY date))
  SELECT user_id::VARCHAR AS pricing_id, field, prev_date, date, from_value, v AS to_value FROM l
  WHERE from_value <> v""")
def change_events_wide(spark, d):
    wide = tiers(spark, d).withColumn("pricing_id", F.col("user_id").cast("string"))
    fields = ["click_price", "view_price", "purchase_price"]
    return h.change_events(wide, fields).select(
        "pricing_id", "field", "prev_date", "date", "from_value", "to_value"
    )


@query("changed_only", f"""
  WITH {SERIES}
  SELECT pricing_id, date, output_price FROM series WHERE pricing_id IN
    (SELECT pricing_id FROM series GROUP BY 1 HAVING count(DISTINCT output_price) > 1)""")
def changed_only(spark, d):
    return h.changed_only(series(spark, d), "output_price").select("pricing_id", "date", "output_price")


MODELS = SERIES + """, latest AS (SELECT max(date) AS d FROM series), flagged AS (
  SELECT *, NOT is_active OR regexp_matches(lower(display_name), 'deprecated|retired|legacy') AS flagged FROM series),
models AS (
  SELECT pricing_id, arg_max(provider_id, date) AS provider_id, arg_max(model_id, date) AS model_id,
    arg_max(display_name, date) AS display_name, min(date) AS first_seen, max(date) AS last_seen,
    max(date) FILTER (is_active) AS last_active, min(date) FILTER (flagged) AS deprecated_on,
    max(date) = (SELECT d FROM latest) AS currently_present,
    max(date) = (SELECT d FROM latest) AND bool_or(is_active) FILTER (date = last) AS currently_active,
    regexp_matches(lower(arg_max(display_name, date)), 'deprecated|retired|legacy') AS name_marks_deprecation,
    arg_max(input_price, date) AS latest_input,
    max(CASE WHEN date = last THEN output_price END) AS latest_output,
    max(CASE WHEN date = last THEN cached_input_price END) AS latest_cached_input
  FROM (SELECT *, max(date) OVER (PARTITION BY pricing_id) AS last FROM flagged)
  GROUP BY pricing_id HAVING max(date) >= DATE '2024-01-04')"""


def models(spark, d):
    return h.lifecycle(series(spark, d), schemas(spark, d))


@query("lifecycle", f"""
  WITH {MODELS}
  SELECT pricing_id, provider_id, model_id, display_name, first_seen, last_seen, last_active, deprecated_on,
    CASE WHEN NOT currently_present THEN last_seen END AS disappeared_after,
    currently_present::BIGINT AS currently_present, currently_active::BIGINT AS currently_active,
    name_marks_deprecation::BIGINT AS name_marks_deprecation, latest_input, latest_output,
    latest_cached_input, 'USD' AS currency, 'standard_api' AS category,
    row_number() OVER (ORDER BY provider_id, model_id, pricing_id) - 1 AS position FROM models""")
def lifecycle(spark, d):
    out = h.by_model(models(spark, d)).drop("record_start")
    flags = ("currently_present", "currently_active", "name_marks_deprecation")
    return out.withColumns({c: flag(F.col(c)) for c in flags})


ARCHIVE = """
  SELECT pricing_id, provider_id, first_seen, deprecated_on,
    CASE WHEN NOT currently_present THEN last_seen END AS last_listed,
    coalesce(deprecated_on, CASE WHEN NOT currently_present THEN last_seen END) AS retired_on,
    greatest(0, date_diff('day', first_seen,
      coalesce(deprecated_on, CASE WHEN NOT currently_present THEN last_seen END)))::BIGINT AS days_active,
    (first_seen = (SELECT min(date) FROM series))::BIGINT AS days_floor,
    latest_input, latest_output
  FROM models WHERE """


def archive(spark, d, flagged):
    out = h.archive_view(models(spark, d), F.col("record_start"), flagged)
    return out.select(
        "pricing_id", "provider_id", "first_seen", "deprecated_on", "last_listed", "retired_on",
        F.col("days_active").cast("long").alias("days_active"), flag(F.col("days_floor")).alias("days_floor"),
        "latest_input", "latest_output",
    )


# days_active is null without an end; greatest() in the checker skips nulls.
_NULL_DAYS = """SELECT * REPLACE (CASE WHEN retired_on IS NULL THEN NULL ELSE days_active END AS days_active) FROM ("""


@query("archive_view", f"WITH {MODELS} {_NULL_DAYS} {ARCHIVE} deprecated_on IS NOT NULL OR NOT currently_present OR name_marks_deprecation)")
def archive_view(spark, d):
    return archive(spark, d, False)


@query("archive_flagged", f"WITH {MODELS} {_NULL_DAYS} {ARCHIVE} deprecated_on IS NOT NULL OR name_marks_deprecation OR (currently_present AND NOT currently_active))")
def archive_flagged(spark, d):
    return archive(spark, d, True)


@query("index_summary", f"""
  WITH {SERIES}, days AS (SELECT date, count(*) AS n,
      CASE WHEN date < DATE '2024-01-04' THEN '1.2.0' ELSE '2.1.0' END AS v FROM series GROUP BY 1)
  SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS snapshot_count, sum(n)::BIGINT AS row_count,
    string_agg(date::VARCHAR, ',' ORDER BY date) AS dates,
    string_agg(date::VARCHAR || '=' || v, ',' ORDER BY date) AS schema_versions FROM days""")
def index_summary(spark, d):
    out = h.index_summary(series(spark, d), schemas(spark, d))
    pairs = F.transform(F.map_entries("schema_versions"), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))
    return out.select(
        "first_date", "last_date", "snapshot_count", "row_count",
        F.array_join(F.transform("dates", lambda x: x.cast("string")), ",").alias("dates"),
        F.array_join(pairs, ",").alias("schema_versions"),
    )


@query("semi_active", f"""
  WITH {MODELS}
  SELECT pricing_id, date, input_price FROM series WHERE pricing_id IN
    (SELECT pricing_id FROM models WHERE currently_active AND NOT name_marks_deprecation)""")
def semi_active(spark, d):
    return h.active_only(series(spark, d), models(spark, d)).select("pricing_id", "date", "input_price")


@query("latest_per_line", f"""
  WITH {OBS}
  SELECT pricing_id, max(date) AS date, arg_max(value, date) AS value, (SELECT max(date) FROM obs) AS default_date
  FROM obs GROUP BY 1""")
def latest_per_line(spark, d):
    return h.latest_per_line(observations(spark, d))


@query("prune_by_date", f"""
  WITH {SERIES} SELECT pricing_id, date, input_price FROM series WHERE date >= DATE '2024-01-15'""")
def prune_by_date(spark, d):
    """The record from its epoch on, from a history in day folders."""
    history = store.read_history(spark, *store.stored(series(spark, d)))
    return h.from_epoch(history, "2024-01-15").select("pricing_id", "date", "input_price")


@query("prune_by_days", f"""
  WITH {SERIES} SELECT pricing_id, date, input_price FROM series WHERE date IN
    (SELECT ts::DATE FROM events WHERE event_type = 'error' AND value > (SELECT 0.9 * max(value) FROM events))""")
def prune_by_days(spark, d):
    """The record on the days of the dearest failures: the days come from a query."""
    events = load(spark, d, "events")
    dear = events.withColumn("__top", ordered.global_value(events, F.max("value")))
    days = dear.filter((F.col("event_type") == "error") & (F.col("value") > 0.9 * F.col("__top"))).select(F.to_date("ts").alias("date"))
    history = store.read_history(spark, *store.stored(series(spark, d)))
    return store.rows_on_days(history, days).select("pricing_id", "date", "input_price")


@query("asof_price", f"""
  WITH {OBS}, lines AS (SELECT DISTINCT pricing_id, DATE '2024-01-15' AS day FROM obs)
  SELECT l.pricing_id, o.value FROM lines l ASOF LEFT JOIN obs o
    ON l.pricing_id = o.pricing_id AND l.day >= o.date""")
def asof_price(spark, d):
    return h.asof_value(observations(spark, d), "2024-01-15")


@query("asof_rank", f"""
  WITH {OBS}, lines AS (SELECT DISTINCT pricing_id, DATE '2024-01-10' AS day FROM obs)
  SELECT l.pricing_id, o.value FROM lines l ASOF LEFT JOIN obs o
    ON l.pricing_id = o.pricing_id AND l.day >= o.date
  ORDER BY o.value DESC NULLS LAST, l.pricing_id""")
def asof_rank(spark, d):
    return h.asof_rank(observations(spark, d), "2024-01-10")


@query("asof_usage_cost", """
  WITH p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase'),
  v AS (SELECT user_id, ts, max(value) AS price FROM (
      SELECT * FROM events WHERE event_type = 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) GROUP BY ALL)
  SELECT p.user_id, p.event_id, v.price, round(p.value * 1000 / 1e6 * v.price, 8) AS usd
  FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def asof_usage_cost(spark, d):
    events = load(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    buys = events.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "value")
    views = events.filter(F.col("event_type") == "view").select(
        "user_id", "ts", "event_id", F.col("value").alias("list_price")
    )
    priced = h.asof_join(buys, views, ["user_id"], "ts", "list_price", "price", "event_id")
    usd = F.round(F.col("value") * 1000 / F.lit(1e6) * F.col("price"), 8)
    return priced.select("user_id", "event_id", "price", usd.alias("usd"))


# Snapshot pair: the newest two days as two documents, ids by user.
SNAPSHOTS = TIER + """, days AS (SELECT DISTINCT date FROM tier ORDER BY date DESC LIMIT 2),
  old AS (SELECT user_id, click_price, view_price FROM tier WHERE date = (SELECT min(date) FROM days)),
  new AS (SELECT user_id, click_price, view_price FROM tier WHERE date = (SELECT max(date) FROM days)),
  diff AS (SELECT CASE WHEN o.user_id IS NULL THEN 'NEW_TIER' WHEN n.user_id IS NULL THEN 'REMOVED_TIER'
      ELSE 'PRICE_CHANGED' END AS kind, coalesce(n.user_id, o.user_id)::VARCHAR AS pricing_id,
      o.user_id IS NOT NULL AND n.user_id IS NOT NULL AS in_both,
      o.click_price AS oc, n.click_price AS nc, o.view_price AS ov, n.view_price AS nv
    FROM old o FULL JOIN new n ON o.user_id = n.user_id
    WHERE o.user_id IS NULL OR n.user_id IS NULL
      OR o.click_price IS DISTINCT FROM n.click_price OR o.view_price IS DISTINCT FROM n.view_price)"""


def snapshot_pair(spark, d):
    rows = tiers(spark, d).select(
        F.col("user_id").cast("string").alias("pricing_id"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("display_name"),
        F.lit("per_1M_tokens").alias("click_unit"), F.lit("per_1M_tokens").alias("view_unit"),
        "date", "click_price", "view_price", F.lit(0).alias("ord"),
    )
    return [day.drop("date") for day in store.last_days(spark, *store.stored(rows))]


@query("snapshot_diff", f"""
  WITH {SNAPSHOTS}
  SELECT kind, pricing_id, CASE WHEN in_both THEN concat_ws(',',
      CASE WHEN oc IS DISTINCT FROM nc THEN 'click_price' END,
      CASE WHEN ov IS DISTINCT FROM nv THEN 'view_price' END) ELSE '' END AS changed_fields,
    oc AS old_click, nc AS new_click FROM diff""")
def snapshot_diff(spark, d):
    old, new = snapshot_pair(spark, d)
    out = h.snapshot_diff(old, new, ["ord"], ["click_price", "view_price"])
    return out.select(
        "kind", "pricing_id", F.array_join("changed_fields", ",").alias("changed_fields"),
        F.col("old.click_price").alias("old_click"), F.col("new.click_price").alias("new_click"),
    )


@query("snapshot_diff_counts", f"WITH {SNAPSHOTS} SELECT kind, count(*) AS n FROM diff GROUP BY 1")
def snapshot_diff_counts(spark, d):
    old, new = snapshot_pair(spark, d)
    return h.snapshot_diff(old, new, ["ord"], ["click_price", "view_price"]).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n")
    )


_CENTS = "coalesce((round({0} * 100))::BIGINT::VARCHAR, 'None')"


def _sql_line(name, old, new):
    o, n = _CENTS.format(old), _CENTS.format(new)
    return (
        f"CASE WHEN kind = 'NEW_TIER' AND {new} IS NOT NULL THEN '{name}: $' || {n} || ' per_1M_tokens' "
        f"WHEN kind = 'PRICE_CHANGED' AND {old} IS DISTINCT FROM {new} "
        f"THEN '{name}: $' || {o} || ' -> $' || {n} || ' (per_1M_tokens)' END"
    )


@query("format_changes", f"""
  WITH {SNAPSHOTS}
  SELECT kind, pricing_id, 'User ' || pricing_id AS title,
    concat_ws('; ', {_sql_line('click_price', 'oc', 'nc')}, {_sql_line('view_price', 'ov', 'nv')}) AS detail
  FROM diff""")
def format_changes(spark, d):
    old, new = snapshot_pair(spark, d)
    diff = h.snapshot_diff(old, new, ["ord"], ["click_price", "view_price"])
    cents = lambda c: F.round(c * 100).cast("long").cast("string")
    return h.format_changes(diff, ["click_price", "view_price"], describe=(), show=cents)


@query("needs_context", """
  SELECT p_brand AS provider_id, p_type AS model_id FROM part
  GROUP BY ALL HAVING count(DISTINCT CASE WHEN p_size > 48 THEN 'long_context' WHEN p_size > 2 THEN 'short_context' END) > 1""")
def needs_context(spark, d):
    window = F.when(F.col("p_size") > 48, "long_context").when(F.col("p_size") > 2, "short_context")
    rows = load(spark, d, "part").select(
        F.col("p_brand").alias("provider_id"), F.col("p_type").alias("model_id"), window.alias("context_window")
    )
    return h.needs_context(rows)


@query("include_exclude_filter", f"""
  WITH {SERIES}
  SELECT pricing_id, date, coalesce(modality, 'text') AS modality FROM series
  WHERE provider_id NOT IN ('error', 'signup') AND coalesce(modality, 'text') IN ('text')
    AND contains(model_id, '1')""")
def include_exclude_filter(spark, d):
    rows = series(spark, d).withColumn("modality", F.coalesce("modality", F.lit("text")))
    seen = panel.include_exclude(F.col("provider_id"), hidden=["error", "signup"])
    shown = panel.include_exclude(F.col("modality"), only=["text"])
    return rows.filter(seen & shown & F.col("model_id").contains("1")).select("pricing_id", "date", "modality")


@query("solo_filter", f"""
  WITH {SERIES} SELECT pricing_id, date, input_price FROM series WHERE provider_id = 'purchase'""")
def solo_filter(spark, d):
    rows = series(spark, d)
    return rows.filter(panel.include_exclude(F.col("provider_id"), solo="purchase")).select(
        "pricing_id", "date", "input_price"
    )


@query("ownership_filter", f"""
  WITH s AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'aws' WHEN p_size % 3 = 1 THEN 'deepseek' ELSE 'other' END AS provider_id,
      CASE WHEN p_type = 'ECONOMY' THEN 'nova-' ELSE 'm-' END || p_partkey AS model_id,
      CASE WHEN p_type = 'SMALL' THEN 'deepseek-' || p_name ELSE p_name END AS display_name FROM part)
  SELECT p_partkey, provider_id FROM s WHERE CASE provider_id
    WHEN 'aws' THEN contains(lower(model_id || ' ' || display_name), 'nova') OR contains(lower(model_id || ' ' || display_name), 'titan')
    WHEN 'deepseek' THEN starts_with(lower(model_id), 'deepseek-') OR contains(' ' || lower(model_id || ' ' || display_name), ' deepseek-')
    ELSE true END""")
def ownership_filter(spark, d):
    size = F.col("p_size") % 3
    rows = load(spark, d, "part").select(
        "p_partkey",
        F.when(size == 0, "aws").when(size == 1, "deepseek").otherwise("other").alias("provider_id"),
        F.concat(F.when(F.col("p_type") == "ECONOMY", "nova-").otherwise("m-"), F.col("p_partkey").cast("string")).alias("model_id"),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("deepseek-"), "p_name")).otherwise(F.col("p_name")).alias("display_name"),
    )
    keep = tx.owned_rows(F.col("provider_id"), F.col("model_id"), F.col("display_name"))
    return rows.filter(keep).select("p_partkey", "provider_id")


@query("limit_rows", "SELECT event_id, user_id, value FROM events ORDER BY ts, event_id LIMIT 50")
def limit_rows(spark, d):
    return limited(load(spark, d, "events"), 50, "ts", "event_id").select("event_id", "user_id", "value")


@query("counts_by_key", f"WITH {OBS} SELECT event_type AS provider_id, count(*) AS n FROM obs GROUP BY 1")
def counts_by_key(spark, d):
    return count_rows(observations(spark, d).withColumnRenamed("event_type", "provider_id"), "provider_id")
