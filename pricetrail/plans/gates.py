"""Gate, carry-forward and collection-health queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import text as tx
from ..operators import gates, ordered
from ..sources import store, writers
from .base import OBS, flag, load, observations, query

# Floors for the benchmark's providers (its event types); one has no rows.
FLOORS = {"click": 10, "view": 10, "purchase": 500, "signup": 5, "absent": 3}
FLOOR_ROWS = "floors AS (SELECT * FROM (VALUES ('click', 10), ('view', 10), ('purchase', 500), ('signup', 5), ('absent', 3)) t(provider_id, floor))"

TWO_DAYS = OBS + f""", {FLOOR_ROWS}, days AS (SELECT DISTINCT date FROM obs ORDER BY date DESC LIMIT 2),
  old AS (SELECT *, event_type AS provider_id FROM obs WHERE date = (SELECT min(date) FROM days)),
  new AS (SELECT *, event_type AS provider_id FROM obs WHERE date = (SELECT max(date) FROM days)),
  c AS (SELECT f.provider_id, f.floor, (SELECT count(*) FROM new n WHERE n.provider_id = f.provider_id) AS cur,
      (SELECT count(*) FROM old o WHERE o.provider_id = f.provider_id) AS prev FROM floors f)"""


def two_days(spark, d):
    """The newest two snapshots of the stored history, each read from its own folder."""
    obs = observations(spark, d).withColumnRenamed("event_type", "provider_id")
    return store.last_days(spark, *store.stored(obs))


ISSUES = """
  SELECT 'total' AS scope, 'total_floor' AS rule, n AS current, 300::BIGINT AS bound FROM (SELECT count(*) AS n FROM new) WHERE n < 300
  UNION ALL SELECT 'total', 'total_ratio', n, p FROM (SELECT (SELECT count(*) FROM new) AS n, (SELECT count(*) FROM old) AS p)
    WHERE p > 0 AND n < p * 0.5
  UNION ALL SELECT provider_id, 'provider_floor', cur, floor::BIGINT FROM c WHERE cur < floor
  UNION ALL SELECT provider_id, 'provider_ratio', cur, greatest(1, floor(prev * 0.45))::BIGINT FROM c
    WHERE prev > 0 AND cur < greatest(1, floor(prev * 0.45))"""


@query("sanity_issues", f"WITH {TWO_DAYS} {ISSUES}")
def sanity_issues(spark, d):
    old, new = two_days(spark, d)
    return gates.sanity_issues(new, old, "2.1.0", FLOORS, 300).select("scope", "rule", "current", "bound")


CARRIED = f"""{TWO_DAYS}, weak AS (SELECT provider_id FROM c WHERE prev > 0 AND cur < greatest(floor, floor(prev * 0.45)))"""


@query("carry_forward", f"""
  WITH {CARRIED}
  SELECT pricing_id, provider_id, value, 0::BIGINT AS carried FROM new WHERE provider_id NOT IN (SELECT * FROM weak)
  UNION ALL SELECT pricing_id, provider_id, value, 1 FROM old WHERE provider_id IN (SELECT * FROM weak)""")
def carry_forward(spark, d):
    old, new = two_days(spark, d)
    merged = gates.carry_forward(new, old, "2.1.0", FLOORS)
    return merged.select("pricing_id", "provider_id", "value", flag(F.col("carried")).alias("carried"))


OUTCOME_FLOORS = {"click": 10, "view": 10, "purchase": 60, "signup": 5}


@query("run_status", f"""
  WITH {OBS}, f AS (SELECT * FROM (VALUES ('click', 10), ('view', 10), ('purchase', 60), ('signup', 5)) t(p, floor)),
  days AS (SELECT DISTINCT date FROM obs ORDER BY date DESC LIMIT 2),
  c AS (SELECT event_type AS p, count(*) FILTER (date = (SELECT max(date) FROM days)) AS cur, count(*) FILTER (date = (SELECT min(date) FROM days)) AS prev
    FROM obs WHERE date IN (SELECT date FROM days) GROUP BY 1),
  a AS (SELECT coalesce(c.p, f.p) AS p, f.floor, coalesce(prev, 0) AS prev,
      coalesce(prev > 0 AND cur < greatest(floor, floor(prev * 0.45)), false) AS weak,
      CASE WHEN coalesce(prev > 0 AND cur < greatest(floor, floor(prev * 0.45)), false) THEN prev ELSE coalesce(cur, 0) END AS cur
    FROM c FULL JOIN f ON c.p = f.p),
  i AS (SELECT p FROM a WHERE cur < floor UNION ALL SELECT p FROM a WHERE floor IS NOT NULL AND prev > 0 AND cur < greatest(1, floor(prev * 0.45))
    UNION ALL SELECT 'total' FROM (SELECT sum(cur) AS n, sum(prev) AS m FROM a) WHERE n < 100
    UNION ALL SELECT 'total' FROM (SELECT sum(cur) AS n, sum(prev) AS m FROM a) WHERE m > 0 AND n < m * 0.5)
  SELECT CASE WHEN (SELECT count(*) FROM i) > 0 THEN 'failed' WHEN (SELECT bool_or(weak) FROM a) THEN 'degraded' ELSE 'success' END AS status,
    coalesce((SELECT string_agg(p, ',' ORDER BY p) FROM a WHERE weak), '') AS carried_providers, (SELECT count(*) FROM i) AS issues_left""")
def run_status(spark, d):
    old, new = two_days(spark, d)
    return gates.run_outcome(new, old, "2.1.0", OUTCOME_FLOORS, 100)


@query("gate_checks", f"""
  WITH {OBS}, {FLOOR_ROWS}, last AS (SELECT max(date) AS d FROM obs),
  cur AS (SELECT event_type AS p FROM obs WHERE date = (SELECT d FROM last)),
  age AS (SELECT (epoch_us(TIMESTAMP '2024-01-31 06:00:00') - epoch_us(max(ts))) / 3.6e9 AS h FROM events),
  k AS (
    SELECT 'schema_version' AS name, true AS passed, 'schema_version=2.1.0' AS detail
    UNION ALL SELECT 'pricing_json_recency', h <= 30, 'age_hours=' || format('{{:.1f}}', h) FROM age
    UNION ALL SELECT 'total_row_floor', count(*) >= 100, 'rows=' || count(*) || ' floor=100' FROM cur
    UNION ALL SELECT 'provider_floor_' || provider_id, (SELECT count(*) FROM cur WHERE p = provider_id) >= floor,
      provider_id || '=' || (SELECT count(*) FROM cur WHERE p = provider_id) || ' floor=' || floor FROM floors
    UNION ALL SELECT 'history_freshness', true, 'latest=' || d FROM last
    UNION ALL SELECT 'run_report_status', true, 'status=degraded')
  SELECT name, passed::BIGINT AS passed, detail, (SELECT bool_and(passed) FROM k)::BIGINT AS all_passed FROM k""")
def gate_checks(spark, d):
    obs = observations(spark, d).withColumnRenamed("event_type", "provider_id")
    path, schema = store.stored(obs)
    (current,) = store.last_days(spark, path, schema, 1)
    latest = F.lit(max(store.history_days(spark, path, schema), default=None)).cast("date")
    events = load(spark, d, "events")
    now = F.lit("2024-01-31 06:00:00").cast("timestamp")
    age = ordered.global_value(events, ms.age_hours(F.max("ts").cast("timestamp"), now))
    out = gates.gate_checks(
        current, F.lit("2.1.0"), age, latest, F.lit("degraded"), FLOORS, 100
    )
    return out.select("name", flag(F.col("passed")).alias("passed"), "detail", flag(F.col("all_passed")).alias("all_passed"))


LISTED = OBS + """, days AS (SELECT min(date) AS d0, max(date) AS d1 FROM obs),
  spans AS (SELECT *, lead(date) OVER (PARTITION BY pricing_id ORDER BY date) AS until FROM obs),
  doc AS (SELECT unnest(generate_series(s.date, coalesce(s.until - 1, d.d1)::DATE, INTERVAL 1 DAY))::DATE AS date,
    'u' || user_id AS provider_id, pricing_id, value AS input_price, user_id FROM spans s, days d),
  packed AS (SELECT date, provider_id, sha256('{"pricing_id":"' || pricing_id || '","input_price":' || input_price || '}') AS h FROM doc
    UNION ALL SELECT DISTINCT date, provider_id, sha256('{"provider_id":"' || provider_id || '","name":"User ' || user_id
      || CASE WHEN user_id % 5 = 0 AND date >= DATE '2024-01-20' THEN ' Inc' ELSE '' END || '"}') FROM doc),
  prints AS (SELECT date, provider_id, count(*) AS n_rows, sum(('0x' || substr(h, 1, 15))::BIGINT) AS h1,
      sum(('0x' || substr(h, 16, 15))::BIGINT) AS h2 FROM packed GROUP BY ALL),
  after AS (SELECT date, lead(date) OVER (ORDER BY date) AS next FROM (SELECT DISTINCT date FROM prints)),
  old AS (SELECT a.next AS date, p.provider_id, p.n_rows, p.h1, p.h2 FROM prints p JOIN after a USING (date) WHERE a.next IS NOT NULL),
  pairs AS (SELECT date, provider_id, n.n_rows, n.h1, CASE WHEN o.n_rows IS NULL THEN 'added' WHEN n.n_rows IS NULL THEN 'removed'
      WHEN n.n_rows = o.n_rows AND n.h1 = o.h1 AND n.h2 = o.h2 THEN 'same' ELSE 'changed' END AS change
    FROM prints n FULL JOIN old o USING (date, provider_id))"""


def listed_prints(spark, d):
    """Prints of daily documents: every line at its last known price, by provider."""
    obs = observations(spark, d)
    last = ordered.global_value(obs, F.max("date"))
    until = F.lead("date").over(Window.partitionBy("pricing_id").orderBy("date"))
    days = F.sequence("date", F.coalesce(F.date_sub("until", 1), "__last"))
    user = F.col("user_id").cast("string")
    doc = obs.withColumns({"until": until, "__last": last}).select(
        F.explode(days).alias("date"), F.concat(F.lit("u"), user).alias("provider_id"), "pricing_id",
        F.col("value").alias("input_price"), "user_id")
    renamed = (F.col("user_id") % 5 == 0) & (F.col("date") >= F.lit("2024-01-20").cast("date"))
    name = F.concat(F.lit("User "), user, F.when(renamed, " Inc").otherwise(""))
    providers = doc.select("date", "provider_id", name.alias("name")).distinct()
    return writers.document_prints(doc, ["pricing_id", "input_price"], providers, ["provider_id", "name"])


@query("snapshot_if_changed", f"""
  WITH {LISTED} SELECT date, sum(n_rows)::BIGINT AS n_rows, sum(h1)::VARCHAR AS h1, bool_or(change <> 'same')::BIGINT AS changed
  FROM pairs GROUP BY 1""")
def snapshot_if_changed(spark, d):
    return writers.snapshots_to_write(listed_prints(spark, d)).select(
        "date", "n_rows", F.col("h1").cast("string").alias("h1"), flag(F.col("changed")).alias("changed")
    )


@query("snapshot_providers_changed", f"WITH {LISTED} SELECT date, provider_id, change FROM pairs WHERE change <> 'same'")
def snapshot_providers_changed(spark, d):
    return writers.provider_changes(listed_prints(spark, d)).filter("change <> 'same'")


ATTEMPTS = """att AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'meter' WHEN 1 THEN 'ledger' ELSE 'wrapper' END AS source,
    'p' || (user_id % 7) AS provider_id, CASE WHEN user_id % 2 = 0 THEN 'flagship' ELSE 'workhorse' END AS tier,
    ts::DATE AS date,
    CASE WHEN event_type = 'error' OR (user_id % 7 = 3 AND ts >= TIMESTAMP '2024-01-28') THEN 'error'
      WHEN event_type = 'signup' THEN 'dry_run' WHEN event_type = 'view' AND value < 5 THEN NULL ELSE 'ok' END AS run_status,
    'code ' || (event_id % 5) AS error, 'm' || user_id AS api_model, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS run_at,
    event_id AS ord FROM events)"""


def attempts(spark, d):
    user = F.col("user_id")
    late = (user % 7 == 3) & (F.col("ts") >= F.lit("2024-01-28").cast("timestamp_ntz"))
    status = (
        F.when((F.col("event_type") == "error") | late, "error")
        .when(F.col("event_type") == "signup", "dry_run")
        .when((F.col("event_type") == "view") & (F.col("value") < 5), F.lit(None))
        .otherwise("ok")
    )
    return load(spark, d, "events").select(
        F.when(user % 3 == 0, "meter").when(user % 3 == 1, "ledger").otherwise("wrapper").alias("source"),
        F.concat(F.lit("p"), (user % 7).cast("string")).alias("provider_id"),
        F.when(user % 2 == 0, "flagship").otherwise("workhorse").alias("tier"),
        F.to_date("ts").alias("date"),
        status.alias("run_status"),
        F.concat(F.lit("code "), (F.col("event_id") % 5).cast("string")).alias("error"),
        F.concat(F.lit("m"), user.cast("string")).alias("api_model"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("run_at"),
        F.col("event_id").alias("ord"),
    )


HEALTH = ATTEMPTS + """, tried AS (SELECT * FROM att WHERE run_status IS NOT NULL AND run_status <> 'dry_run'),
  lat AS (SELECT source, max(date) AS latest_observed FROM tried GROUP BY 1),
  grid AS (SELECT DISTINCT provider_id, tier, s AS source FROM att, (SELECT unnest(['meter', 'ledger', 'wrapper']) AS s)),
  health AS (SELECT g.provider_id, g.tier, g.source, l.latest_observed,
    count(*) FILTER (t.date = l.latest_observed AND t.run_status = 'ok') AS ok_count,
    count(*) FILTER (t.date = l.latest_observed AND t.run_status <> 'ok') AS error_count,
    max(t.date) FILTER (t.run_status = 'ok') AS last_ok,
    arg_max(t.error, (t.run_at, -t.ord)) FILTER (t.date = l.latest_observed AND t.run_status <> 'ok') AS last_error,
    arg_max(t.api_model, (t.run_at, -t.ord)) FILTER (t.date = l.latest_observed AND t.run_status <> 'ok') AS last_error_model
  FROM grid g LEFT JOIN lat l ON g.source = l.source
    LEFT JOIN tried t ON t.source = g.source AND t.provider_id = g.provider_id AND t.tier = g.tier
  GROUP BY ALL)"""


def health(spark, d):
    rows = attempts(spark, d)
    panel = rows.select("provider_id", "tier").distinct()
    return gates.collection_health(panel, rows)


@query("collection_health", f"WITH {HEALTH} SELECT * FROM health")
def collection_health(spark, d):
    return health(spark, d)


STATUS = HEALTH + """, status AS (SELECT provider_id, tier, bool_or(ok_count > 0) AS reporting,
    coalesce(string_agg(source, ',' ORDER BY source) FILTER (error_count > 0 AND ok_count = 0), '') AS dark_sources
  FROM health GROUP BY ALL)"""


@query("panel_status", f"WITH {STATUS} SELECT provider_id, tier, reporting::BIGINT AS reporting, dark_sources FROM status")
def panel_status(spark, d):
    out = gates.panel_status(health(spark, d))
    return out.withColumn("reporting", flag(F.col("reporting")))


@query("health_summary", f"""
  WITH {STATUS} SELECT count(*) FILTER (reporting) AS reporting_count, count(*) AS panel_count,
    coalesce(string_agg(provider_id || '·' || tier, ',' ORDER BY provider_id || '·' || tier) FILTER (NOT reporting), '') AS dark
  FROM status""")
def health_summary(spark, d):
    return gates.health_summary(gates.panel_status(health(spark, d)))


@query("gate_failing_rows", f"""
  WITH {HEALTH}
  SELECT source, provider_id, tier, CASE WHEN error_count > 0 THEN 'dark' ELSE 'silent' END AS kind,
    error_count::BIGINT AS error_count, last_error_model, last_error FROM health WHERE ok_count = 0""")
def gate_failing_rows(spark, d):
    return gates.failing_rows(health(spark, d))


@query("gate_collection", f"""
  WITH {HEALTH}, s AS (SELECT source,
    string_agg(provider_id || '·' || tier || ' (' || coalesce(last_error_model, 'None') || '): ' || coalesce(last_error, 'None'), '; '
      ORDER BY provider_id || '·' || tier || ' (' || coalesce(last_error_model, 'None') || '): ' || coalesce(last_error, 'None'))
      FILTER (ok_count = 0 AND error_count > 0) AS dark,
    string_agg(provider_id || '·' || tier, ', ' ORDER BY provider_id || '·' || tier) FILTER (ok_count = 0 AND error_count = 0) AS silent
    FROM health GROUP BY 1)
  SELECT 'provider_health_present' AS name, 1::BIGINT AS passed,
    (SELECT count(*) FROM (SELECT DISTINCT provider_id, tier FROM health)) || ' panel rows' AS detail
  UNION ALL SELECT source || '_no_dark_providers', (dark IS NULL)::BIGINT, coalesce(dark, 'every panel row reported at least once') FROM s
  UNION ALL SELECT source || '_no_silent_providers', (silent IS NULL)::BIGINT, coalesce(silent, 'every panel row was attempted') FROM s""")
def gate_collection(spark, d):
    out = gates.gate_collection(health(spark, d))
    return out.withColumn("passed", flag(F.col("passed")))


@query("source_summary", f"""
  WITH {ATTEMPTS}
  SELECT source, CASE WHEN count(*) FILTER (run_status = 'ok') > 0 THEN 'active' ELSE 'pending_first_run' END AS status,
    count(*) AS row_count, count(*) FILTER (run_status = 'ok') AS ok_row_count,
    max(date) FILTER (run_status = 'ok') AS last_observed_date FROM att GROUP BY 1""")
def source_summary(spark, d):
    return gates.source_summary(attempts(spark, d))


@query("status_histogram", f"""
  WITH {ATTEMPTS}, c AS (SELECT coalesce(run_status, 'None') || ': ' || count(*) AS e, count(*) AS n FROM att GROUP BY run_status)
  SELECT sum(n)::BIGINT AS total, string_agg(e, ', ' ORDER BY e) AS summary FROM c""")
def status_histogram(spark, d):
    return gates.status_histogram(attempts(spark, d))


@query("best_attempt", f"""
  WITH {ATTEMPTS}, n AS (SELECT source, date, count(*) AS n FROM att GROUP BY ALL)
  SELECT source AS provider_id, arg_max(date, (n, date)) AS attempt, max(n) AS rows, count(*) AS attempts,
    (max(n) < CASE source WHEN 'meter' THEN 100000000 ELSE 10 END)::BIGINT AS low_yield FROM n GROUP BY 1""")
def best_attempt(spark, d):
    rows = attempts(spark, d).select(F.col("source").alias("provider_id"), F.col("date").alias("attempt"))
    out = gates.best_attempt(rows, {"meter": 100000000, "ledger": 10, "wrapper": 10})
    return out.withColumn("low_yield", flag(F.col("low_yield")))


@query("latest_slice", f"""
  WITH {ATTEMPTS} SELECT ord, source, provider_id, tier FROM att WHERE date = (SELECT max(date) FROM att)""")
def latest_slice(spark, d):
    return gates.latest_slice(attempts(spark, d)).select("ord", "source", "provider_id", "tier")


@query("latest_runs", """
  WITH r AS (SELECT l_shipdate::DATE AS date, CASE l_linestatus WHEN 'F' THEN 'flagship' ELSE 'workhorse' END AS tier,
    CASE WHEN l_linenumber > 2 THEN l_linenumber::BIGINT END AS replicate FROM lineitem)
  SELECT max(date) AS latest_date, count(*) FILTER (date = (SELECT max(date) FROM r)) AS latest_row_count, count(*) AS total_row_count,
    coalesce(max(coalesce(replicate, 1)) FILTER (tier = 'workhorse' AND date = (SELECT max(date) FROM r)), 1) AS workhorse_replicates FROM r""")
def latest_runs(spark, d):
    rows = load(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linestatus") == "F", "flagship").otherwise("workhorse").alias("tier"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber").cast("long")).alias("replicate"),
    )
    return gates.latest_runs(rows)


@query("conversation_checks", f"""
  WITH t AS (SELECT *, len([x for x in regexp_split_to_array(text, '{tx.SPACE}') if x <> '']) AS words FROM conversations)
  SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS user_turns,
    count(*) FILTER (role = 'assistant') AS assistant_turns,
    bool_and(coalesce(role = CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END, false))::BIGINT AS alternates,
    bool_and(words BETWEEN CASE role WHEN 'user' THEN 12 ELSE 20 END AND CASE role WHEN 'user' THEN 60 ELSE 200 END)::BIGINT AS word_budget,
    (max(turn) - min(turn) + 1 = count(*))::BIGINT AS complete
  FROM t GROUP BY 1""")
def conversation_checks(spark, d):
    turns = load(spark, d, "conversations").withColumn("words", tx.words(F.col("text")))
    out = gates.alternation_checks(turns, (12, 60), (20, 200))
    return out.withColumns({c: flag(F.col(c)) for c in ("alternates", "word_budget", "complete")})
