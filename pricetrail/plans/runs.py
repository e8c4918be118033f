"""Metering queries over line items, documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import nested
from ..operators import runs
from .base import flag, load, query, r4

RUNS = """runs AS (
  SELECT strftime(l_shipdate, '%Y-%m-01') AS date, l_returnflag AS provider_id,
    CASE l_linestatus WHEN 'F' THEN 'flagship' ELSE 'workhorse' END AS tier,
    chr(65 + (l_linenumber % 4)::INT) AS task_id, l_quantity::BIGINT AS tokens_in, l_partkey AS tokens_out,
    1500::BIGINT AS output_cap, CASE WHEN l_tax >= 0.08 THEN true WHEN l_tax >= 0.02 THEN false END AS output_censored,
    nullif(l_suppkey, 0) AS input_chars, CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS usd,
    CASE WHEN l_discount >= 0.095 THEN 'error' ELSE 'ok' END AS run_status,
    'm' || l_partkey AS model_id, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord FROM lineitem),
  corpus AS (SELECT chr(65 + (item_id % 4)::INT) AS task_id, sum(length(text))::BIGINT AS chars FROM benchmark GROUP BY 1),
  ok AS (SELECT r.* REPLACE (coalesce(r.input_chars, c.chars) AS input_chars) FROM runs r LEFT JOIN corpus c USING (task_id)
    WHERE run_status = 'ok')"""
ORDER = ["o1", "o2", "o3", "o4", "o5"]


def meter_runs(spark, d):
    items = load(spark, d, "lineitem")
    tax, off = F.col("l_tax"), F.col("l_discount")
    return items.select(
        F.to_date(F.date_trunc("month", "l_shipdate")).cast("string").alias("run_date"),
        F.lit(None).cast("string").alias("run_week"),
        F.col("l_returnflag").alias("provider_id"),
        F.when(F.col("l_linestatus") == "F", "flagship").otherwise("workhorse").alias("tier"),
        task_letter(F.col("l_linenumber")).alias("task_id"),
        F.col("l_quantity").cast("long").alias("tokens_in"),
        F.col("l_partkey").alias("tokens_out"),
        F.lit(1500).cast("long").alias("output_cap"),
        F.when(tax >= 0.08, True).when(tax >= 0.02, False).alias("output_censored"),
        F.col("l_suppkey").alias("input_chars"),
        F.when(off > 0.02, F.col("l_extendedprice")).alias("usd_value_same_day"),
        F.when(off >= 0.095, "error").otherwise("ok").alias("run_status"),
        F.concat(F.lit("m"), F.col("l_partkey").cast("string")).alias("model_id"),
        F.lit("api").alias("api_model"),
        F.lit("1.0").alias("corpus_version"),
        F.lit(None).cast("string").alias("output_policy_version"),
        *[F.col(c).alias(o) for o, c in zip(ORDER, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))],
    )


def task_letter(c):
    return F.char((F.lit(65) + c % 4).cast("long"))


def corpus(spark, d):
    return load(spark, d, "benchmark").groupBy(task_letter(F.col("item_id")).alias("task_id")).agg(
        F.sum(F.char_length("text")).alias("input_chars")
    )


@query("replicate_median", f"""
  WITH {RUNS}
  SELECT date, provider_id, tier, task_id, arg_min(model_id, ord) AS model_id, median(tokens_in)::DOUBLE AS tokens_in,
    median(tokens_out)::DOUBLE AS tokens_out, median(tokens_in)::DOUBLE + median(tokens_out)::DOUBLE AS tokens_total,
    arg_min(input_chars, ord) AS input_chars,
    round(median(tokens_in) / (arg_min(input_chars, ord) / 1000), 3) AS tokens_in_per_1k_chars, round(median(usd), 4) AS usd,
    bool_or(coalesce(output_censored, tokens_out >= 1500))::BIGINT AS output_censored, count(*) AS replicate_count,
    '1.0.0' AS output_policy_version
  FROM ok GROUP BY ALL""")
def replicate_median(spark, d):
    good = runs.usable_runs(meter_runs(spark, d), corpus(spark, d))
    out = runs.replicate_median(good, ORDER)
    return out.select(
        "date", "provider_id", "tier", "task_id", "model_id", "tokens_in", "tokens_out", "tokens_total", "input_chars",
        "tokens_in_per_1k_chars", r4(F.col("usd")).alias("usd"),
        flag(F.col("output_censored")).alias("output_censored"), "replicate_count", "output_policy_version",
    )


TOKEN_ROWS = """tok AS (
  SELECT l_shipdate::DATE AS date, l_returnflag AS provider_id, CASE l_linestatus WHEN 'F' THEN 'flagship' ELSE 'workhorse' END AS tier,
    chr(65 + (l_linenumber % 4)::INT) AS task_id, l_quantity::BIGINT AS tokens_in, l_partkey AS tokens_out,
    l_suppkey + 1 AS input_chars, CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS usd, l_tax >= 0.08 AS output_censored,
    CASE WHEN l_tax > 0.01 THEN l_linenumber::BIGINT END AS replicate_count,
    CASE WHEN l_tax <> 0.05 THEN l_quantity / (l_suppkey + 1) END AS density FROM lineitem)"""


def token_rows(spark, d):
    return load(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("provider_id"),
        F.when(F.col("l_linestatus") == "F", "flagship").otherwise("workhorse").alias("tier"),
        task_letter(F.col("l_linenumber")).alias("task_id"),
        F.col("l_quantity").cast("long").alias("tokens_in"),
        F.col("l_partkey").alias("tokens_out"),
        (F.col("l_quantity").cast("long") + F.col("l_partkey")).alias("tokens_total"),
        (F.col("l_suppkey") + 1).alias("input_chars"),
        F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("usd"),
        (F.col("l_tax") >= 0.08).alias("output_censored"),
        F.when(F.col("l_tax") > 0.01, F.col("l_linenumber").cast("long")).alias("replicate_count"),
        F.when(F.col("l_tax") != 0.05, F.col("l_quantity") / (F.col("l_suppkey") + 1)).alias("tokens_in_per_1k_chars"),
    )


@query("complete_group_sum", f"""
  WITH {TOKEN_ROWS}, g AS (SELECT date, provider_id, tier, count(DISTINCT task_id) = 4 AS complete,
    sum(tokens_in)::BIGINT AS tokens_in, sum(tokens_out)::BIGINT AS tokens_out, sum(tokens_in + tokens_out)::BIGINT AS tokens_total,
    sum(input_chars)::BIGINT AS input_chars, round(sum(coalesce(usd, 0)), 2) AS usd, bool_or(output_censored)::BIGINT AS censored,
    max(coalesce(replicate_count, 1)) AS replicate_count, round(sum(tokens_in) / (sum(input_chars) / 1000), 4) AS tokens_in_per_1k_chars
    FROM tok GROUP BY ALL)
  SELECT * EXCLUDE (complete), (SELECT count(*) FROM g WHERE NOT complete) AS incomplete FROM g WHERE complete""")
def complete_group_sum(spark, d):
    groups = runs.complete_group_sum(token_rows(spark, d), ["A", "B", "C", "D"])
    points, missing = runs.complete_points(groups)
    return points.withColumns({
        "usd": F.round("usd", 2),
        "censored": flag(F.col("censored")),
        "tokens_in_per_1k_chars": r4(F.col("tokens_in_per_1k_chars")),
        "incomplete": missing.scalar(),
    })


@query("complete_group_mean", f"""
  WITH {TOKEN_ROWS}, g AS (SELECT date, provider_id, tier, count(DISTINCT task_id) = 3 AS complete,
    round(avg(density), 6) AS ledger_density, count(*) AS n FROM tok WHERE task_id <> 'D' AND density IS NOT NULL GROUP BY ALL)
  SELECT * EXCLUDE (complete), (SELECT count(*) FROM g WHERE NOT complete) AS incomplete FROM g WHERE complete""")
def complete_group_mean(spark, d):
    groups = runs.complete_group_mean(token_rows(spark, d), ["A", "B", "C", "D"])
    points, missing = runs.complete_points(groups)
    return points.withColumns({
        "ledger_density": F.round("ledger_density", 6), "incomplete": missing.scalar()
    })


@query("usage_cost", """
  WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 1000 AS ti, CASE WHEN l_tax > 0.01 THEN l_suppkey * 100 END AS tout,
      l_discount * 100 AS pin, l_tax * 100 AS pout FROM lineitem),
  v AS (SELECT *, ti / 1e6 * pin + tout / 1e6 * pout AS usd FROM u)
  SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, round(usd, 7) AS usd,
    round(CASE WHEN ti + tout > 0 THEN usd * (1e6 / (ti + tout)) END, 6) AS implied_per_1m,
    coalesce(tout >= 5000, false)::BIGINT AS censored FROM v""")
def usage_cost(spark, d):
    tokens_in = F.col("l_quantity") * 1000
    tokens_out = F.when(F.col("l_tax") > 0.01, F.col("l_suppkey") * 100)
    usd = ms.usd_value(tokens_in, tokens_out, F.col("l_discount") * 100, F.col("l_tax") * 100)
    return load(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey",
        F.round(usd, 7).alias("usd"),
        F.round(ms.implied_per_million(tokens_in, tokens_out, usd), 6).alias("implied_per_1m"),
        flag(ms.hit_cap(tokens_out, F.lit(5000))).alias("censored"),
    )


WRAPPER = """wrap AS (SELECT DATE '2024-01-01' + (conv_id % 30)::INT AS run_date, role AS provider_id,
    CASE WHEN conv_id % 2 = 0 THEN 'flagship' ELSE 'workhorse' END AS tier, turn, conv_id AS ord,
    CASE WHEN conv_id % 5 = 0 THEN '' ELSE 'api-' || conv_id END AS api_model, 'm-' || conv_id AS model_id,
    nullif(length(text), 0) AS api_prompt_tokens, round(length(text) / 7, 3) AS density,
    CASE WHEN conv_id % 11 = 0 THEN 'error' ELSE 'ok' END AS run_status FROM conversations)"""


def wrapper_rows(spark, d):
    conv, size = F.col("conv_id"), F.char_length("text").cast("long")
    return load(spark, d, "conversations").select(
        F.date_add(F.lit("2024-01-01").cast("date"), (conv % 30).cast("int")).alias("run_date"),
        F.col("role").alias("provider_id"),
        F.when(conv % 2 == 0, "flagship").otherwise("workhorse").alias("tier"),
        "turn",
        conv.alias("ord"),
        F.when(conv % 5 == 0, "").otherwise(F.concat(F.lit("api-"), conv.cast("string"))).alias("api_model"),
        F.concat(F.lit("m-"), conv.cast("string")).alias("model_id"),
        F.nullif(size, F.lit(0)).alias("api_prompt_tokens"),
        F.round(size / 7, 3).alias("tokens_per_1k_chars"),
        F.when(conv % 11 == 0, "error").otherwise("ok").alias("run_status"),
    )


@query("last_turn_points", f"""
  WITH {WRAPPER} SELECT run_date, provider_id, tier, model_id, api_model, api_prompt_tokens FROM wrap
  WHERE turn = 3 AND api_prompt_tokens IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_date, provider_id, tier ORDER BY ord DESC) = 1""")
def last_turn_points(spark, d):
    return runs.last_turn_points(wrapper_rows(spark, d), ["ord"], turn=3)


LEDGER = WRAPPER + """, led AS (SELECT DATE '2024-01-01' + (doc_id % 30)::INT AS date, lang AS provider_id, source AS tier,
    CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'doc-' || doc_id END AS api_model, 'd-' || doc_id AS model_id,
    chr(65 + (doc_id % 4)::INT) AS task_id, n_chars AS tokens_in, CASE WHEN n_chars > 500 THEN round(n_chars / 7, 3) END AS density,
    CASE WHEN doc_id % 9 = 0 THEN 'error' ELSE 'ok' END AS run_status FROM documents),
  both_rows AS (SELECT date, provider_id, tier, coalesce(nullif(api_model, ''), model_id) AS model, task_id, tokens_in, density FROM led WHERE run_status = 'ok'
    UNION ALL SELECT run_date, provider_id, tier, coalesce(nullif(api_model, ''), model_id), 'E', api_prompt_tokens, density FROM wrap
      WHERE run_status = 'ok' AND turn = 3 AND api_prompt_tokens IS NOT NULL)"""


def ledger(spark, d):
    doc = F.col("doc_id")
    rows = load(spark, d, "documents").select(
        F.date_add(F.lit("2024-01-01").cast("date"), (doc % 30).cast("int")).alias("date"),
        F.col("lang").alias("provider_id"),
        F.col("source").alias("tier"),
        F.when(doc % 4 != 0, F.concat(F.lit("doc-"), doc.cast("string"))).alias("api_model"),
        F.concat(F.lit("d-"), doc.cast("string")).alias("model_id"),
        task_letter(doc).alias("task_id"),
        F.col("n_chars").alias("tokens_in"),
        F.when(F.col("n_chars") > 500, F.round(F.col("n_chars") / 7, 3)).alias("tokens_in_per_1k_chars"),
        F.when(doc % 9 == 0, "error").otherwise("ok").alias("run_status"),
    )
    return runs.ledger_union(rows, wrapper_rows(spark, d), turn=3)


@query("ledger_union", f"WITH {LEDGER} SELECT * FROM both_rows")
def ledger_union(spark, d):
    return ledger(spark, d)


@query("ledger_filter", f"""
  WITH {LEDGER} SELECT date, provider_id, model, tokens_in FROM both_rows
  WHERE task_id = 'B' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def ledger_filter(spark, d):
    return runs.ledger_filter(ledger(spark, d), "2024-01-05", "2024-01-20", "B").select(
        "date", "provider_id", "model", "tokens_in"
    )


UPSERT = """rows_ AS (SELECT ts::DATE AS run_date, event_type AS provider_id, CASE WHEN user_id % 2 = 0 THEN 'flagship' END AS tier,
    chr(65 + (user_id % 4)::INT) AS task_id, count(*) AS tokens_in FROM events GROUP BY ALL)"""


def upsert_rows(spark, d):
    return load(spark, d, "events").groupBy(
        F.to_date("ts").alias("run_date"),
        F.col("event_type").alias("provider_id"),
        F.when(F.col("user_id") % 2 == 0, "flagship").alias("tier"),
        task_letter(F.col("user_id")).alias("task_id"),
    ).agg(F.count(F.lit(1)).alias("tokens_in"))


@query("upsert_by_key", f"""
  WITH {UPSERT}
  SELECT * FROM rows_ WHERE run_date < DATE '2024-01-18'
  UNION ALL SELECT * REPLACE (tokens_in + 1000 AS tokens_in) FROM rows_ WHERE run_date >= DATE '2024-01-18'""")
def upsert_by_key(spark, d):
    rows = upsert_rows(spark, d)
    existing = rows.filter(F.col("run_date") < F.lit("2024-01-20").cast("date"))
    new = rows.filter(F.col("run_date") >= F.lit("2024-01-18").cast("date")).withColumn(
        "tokens_in", F.col("tokens_in") + 1000
    )
    return runs.upsert(existing, new, ["run_date", "provider_id", "tier", "task_id"])


@query("coalesce_fallback", """
  WITH e AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '' WHEN 2 THEN (ts::DATE)::VARCHAR END AS run_date,
      CASE WHEN event_id % 2 = 0 THEN (date_trunc('week', ts)::DATE)::VARCHAR END AS run_week FROM events)
  SELECT coalesce(nullif(run_date, ''), nullif(run_week, ''), '') AS date, count(*) AS n FROM e GROUP BY 1""")
def coalesce_fallback(spark, d):
    e = F.col("event_id")
    rows = load(spark, d, "events").select(
        F.when(e % 3 == 0, "").when(e % 3 == 2, F.to_date("ts").cast("string")).alias("run_date"),
        F.when(e % 2 == 0, F.to_date(F.date_trunc("week", "ts")).cast("string")).alias("run_week"),
    )
    return rows.groupBy(runs.run_date(rows).alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("transcript_prefix", """
  WITH t AS (SELECT conv_id, turn, sum(length(text)) OVER w AS prefix_chars,
      string_agg(upper(role) || ': ' || text, chr(10) || chr(10)) OVER w AS prefix_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
  SELECT conv_id, ((turn + 1) // 2)::BIGINT AS exchanges, prefix_chars::BIGINT AS prefix_chars, sha256(prefix_text) AS prefix_hash
  FROM t WHERE turn % 2 = 1""")
def transcript_prefix(spark, d):
    out = runs.transcript_prefixes(load(spark, d, "conversations"))
    return out.select(
        "conv_id", F.col("exchanges").cast("long").alias("exchanges"), "prefix_chars",
        F.sha2("prefix_text", 256).alias("prefix_hash"),
    )


@query("transcript_size", r"""
  WITH t AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS x FROM conversations GROUP BY 1)
  SELECT conv_id, length(x) AS chars, strlen(x) AS bytes, len([w for w in regexp_split_to_array(x, '\s+') if w <> '']) AS words FROM t""")
def transcript_size(spark, d):
    return runs.transcript_sizes(load(spark, d, "conversations"))


@query("normalize_messages", """
  WITH l AS (SELECT conv_id, max(turn) AS t, arg_max(role, turn) AS r FROM conversations GROUP BY 1)
  SELECT conv_id, turn, role, sha256(text) AS content_hash FROM conversations
  UNION ALL SELECT conv_id, t + 1, 'user', sha256('.') FROM l WHERE r = 'assistant'""")
def normalize_messages(spark, d):
    rows = nested.message_rows(load(spark, d, "conversations"), ["conv_id"], "turn")
    return nested.with_nudge(rows, ["conv_id"], "turn").select(
        "conv_id", "turn", "role", F.sha2("content", 256).alias("content_hash")
    )
