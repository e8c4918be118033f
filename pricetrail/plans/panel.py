"""Candidate, budget and plan queries over suppliers, customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import text as tx
from ..operators import panel
from .base import flag, load, query, r4

SUPPLIERS = """sup AS (
  SELECT 'n' || s_nationkey AS provider_id, CASE WHEN s_suppkey % 2 = 0 THEN 'flagship' ELSE 'workhorse' END AS tier,
    s_suppkey AS pos, 's' || s_suppkey AS model_id, s_name AS display_name,
    CASE WHEN s_acctbal > 1000 THEN s_acctbal END AS input_price,
    CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal * 2 END AS output_price, s_acctbal > 2000 AS is_active FROM supplier)"""


def suppliers(spark, d):
    key, money = F.col("s_suppkey"), F.col("s_acctbal")
    return load(spark, d, "supplier").select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("provider_id"),
        F.when(key % 2 == 0, "flagship").otherwise("workhorse").alias("tier"),
        key.alias("pos"),
        F.concat(F.lit("s"), key.cast("string")).alias("model_id"),
        F.col("s_name").alias("display_name"),
        F.when(money > 1000, money).alias("input_price"),
        F.when(key % 5 != 0, money * 2).alias("output_price"),
        (money > 2000).alias("is_active"),
    )


def candidates(rows):
    return rows.select("provider_id", "tier", "pos", "model_id")


def models(rows):
    return rows.select("provider_id", "model_id", "display_name", "input_price", "output_price", "is_active")


FIRST = SUPPLIERS + """, picked AS (SELECT * FROM sup
  WHERE input_price IS NOT NULL AND output_price IS NOT NULL AND is_active
  QUALIFY row_number() OVER (PARTITION BY provider_id, tier ORDER BY pos) = 1)"""


@query("first_match_candidate", f"""
  WITH {FIRST} SELECT provider_id, tier, model_id, display_name, input_price, output_price, pos FROM picked""")
def first_match_candidate(spark, d):
    rows = suppliers(spark, d)
    return panel.first_match(candidates(rows), models(rows))


@query("candidate_fallbacks", f"""
  WITH {FIRST} SELECT s.provider_id, s.tier, s.pos, s.model_id, s.input_price, s.output_price
  FROM sup s JOIN picked p ON s.provider_id = p.provider_id AND s.tier = p.tier WHERE s.model_id <> p.model_id""")
def candidate_fallbacks(spark, d):
    rows = suppliers(spark, d)
    chosen = panel.first_match(candidates(rows), models(rows))
    return panel.fallbacks(candidates(rows), models(rows), chosen)


@query("precedence_merge", """
  WITH h AS (SELECT s_suppkey AS model_id, s_name AS display_name, s_acctbal AS input_price FROM supplier),
  l AS (SELECT c_custkey AS model_id, c_name AS display_name, CASE WHEN c_acctbal > 500 THEN c_acctbal END AS input_price
    FROM customer WHERE c_acctbal > 0)
  SELECT coalesce(l.model_id, h.model_id) AS model_id,
    CASE WHEN l.model_id IS NOT NULL THEN l.display_name ELSE h.display_name END AS display_name,
    CASE WHEN l.model_id IS NOT NULL THEN l.input_price ELSE h.input_price END AS input_price,
    (l.model_id IS NOT NULL)::BIGINT AS is_live
  FROM h FULL JOIN l ON h.model_id = l.model_id""")
def precedence_merge(spark, d):
    history = load(spark, d, "supplier").select(
        F.col("s_suppkey").alias("model_id"), F.col("s_name").alias("display_name"), F.col("s_acctbal").alias("input_price")
    )
    live = load(spark, d, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("model_id"), F.col("c_name").alias("display_name"),
        F.when(F.col("c_acctbal") > 500, F.col("c_acctbal")).alias("input_price"),
    )
    out = panel.precedence_merge(history, live, ["model_id"])
    return out.withColumn("is_live", flag(F.col("is_live")))


TASK_OF_LANG = {"en": "A", "fr": "B", "de": "C", "es": "D"}


@query("pack_budget", f"""
  WITH {SUPPLIERS}, m AS (SELECT * FROM sup WHERE input_price IS NOT NULL AND output_price IS NOT NULL),
  t AS (SELECT CASE lang WHEN 'en' THEN 'A' WHEN 'fr' THEN 'B' WHEN 'de' THEN 'C' WHEN 'es' THEN 'D' END AS task_id,
      sum(n_chars) AS input_chars, count(*) * 4000 AS output_cap FROM documents GROUP BY 1),
  packs AS (SELECT * FROM (VALUES ('qa', ['A']), ('summarize', ['B']), ('code', ['C']), ('long', ['D']), ('chat', ['E']),
      ('suite', ['A', 'B', 'C']), ('suiteLong', ['A', 'B', 'C', 'D', 'E'])) v(pack_id, ids)),
  c AS (SELECT p.pack_id, coalesce(sum(t.input_chars / 4.0 / 1e6 * m.input_price + t.output_cap / 1e6 * m.output_price), 0) AS usd
    FROM packs p LEFT JOIN t ON list_contains(p.ids, t.task_id) LEFT JOIN m ON t.task_id IS NOT NULL GROUP BY 1)
  SELECT pack_id, round(usd, 4) AS per_run_usd, round(usd * 365, 2) AS annual_daily, round(usd * 52, 2) AS annual_weekly,
    round(usd * 26, 2) AS annual_biweekly, round(usd * 12, 2) AS annual_monthly FROM c""")
def pack_budget(spark, d):
    task = F.lit(None).cast("string")
    for lang, name in TASK_OF_LANG.items():
        task = F.when(F.col("lang") == lang, name).otherwise(task)
    tasks = load(spark, d, "documents").groupBy(task.alias("task_id")).agg(
        F.sum("n_chars").alias("input_chars"), (F.count(F.lit(1)) * 4000).alias("output_cap")
    )
    out = panel.pack_budget(models(suppliers(spark, d)), tasks)
    year = {f"annual_{c}": F.round(F.col("annual_usd_by_cadence")[c], 2) for c in panel.RUNS_PER_YEAR}
    return out.withColumns(year).select("pack_id", r4(F.col("per_run_usd")).alias("per_run_usd"), *year)


@query("plan_grid", f"""
  WITH {SUPPLIERS}
  SELECT provider_id, tier, model_id, r AS replicate, unnest(['A', 'B', 'C', 'D']) AS task_id
  FROM (SELECT *, unnest(range(1, CASE tier WHEN 'workhorse' THEN 4 ELSE 2 END)) AS r FROM sup)""")
def plan_grid(spark, d):
    rows = suppliers(spark, d).select("provider_id", "tier", "model_id")
    return panel.plan_grid(rows, workhorse_replicates=3).withColumn("replicate", F.col("replicate").cast("long"))


@query("turn_grid", f"""
  WITH {SUPPLIERS} SELECT provider_id, model_id, unnest(range(1, greatest(1, least(10, pos % 14)) + 1)) AS turn FROM sup""")
def turn_grid(spark, d):
    rows = suppliers(spark, d).select("provider_id", "model_id", "pos")
    return panel.turn_grid(rows, (F.col("pos") % 14).cast("int")).select(
        "provider_id", "model_id", F.col("turn").cast("long").alias("turn")
    )


@query("rule_rank_topk", """
  WITH r AS (SELECT p_brand, p_partkey, p_name, CASE WHEN contains(p_name, 'red') THEN 0 WHEN contains(p_name, 'blue') THEN 1 ELSE 2 END AS rule_rank
    FROM part WHERE NOT regexp_matches(p_name, 'bolt|nut'))
  SELECT p_brand, p_partkey, rule_rank::BIGINT AS rule_rank, place FROM (
    SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY rule_rank, p_name, p_partkey) AS place FROM r) WHERE place <= 8""")
def rule_rank_topk(spark, d):
    rows = load(spark, d, "part").filter(~F.col("p_name").rlike("bolt|nut"))
    rules = [F.col("p_name").contains("red"), F.col("p_name").contains("blue")]
    out = panel.rule_rank_topk(rows, ["p_brand"], rules, ["p_name", "p_partkey"])
    return out.select(
        "p_brand", "p_partkey", F.col("rule_rank").cast("long").alias("rule_rank"), F.col("place").cast("long").alias("place")
    )


@query("ordered_distinct", """
  WITH l AS (SELECT p_partkey, string_split(p_name, ' ') || [lower(p_type), 'widget'] AS xs FROM part),
  e AS (SELECT p_partkey, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM l),
  f AS (SELECT p_partkey, x, min(i) AS i FROM e GROUP BY ALL)
  SELECT p_partkey, string_agg(x, ',' ORDER BY i) AS candidates FROM f GROUP BY 1""")
def ordered_distinct(spark, d):
    lists = panel.ordered_distinct(F.split("p_name", " "), F.array(F.lower("p_type"), F.lit("widget")))
    return load(spark, d, "part").select("p_partkey", F.array_join(lists, ",").alias("candidates"))


@query("dict_lookup", """
  SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'machines' WHEN 'BUILDING' THEN 'houses' ELSE c_mktsegment END AS segment,
    coalesce(n_name, 'n' || c_nationkey) AS nation
  FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) ON c_nationkey = n_nationkey""")
def dict_lookup(spark, d):
    nations = load(spark, d, "nation").filter(F.col("n_regionkey") != 3).select("n_nationkey", "n_name")
    segment = panel.dict_lookup(F.col("c_mktsegment"), {"MACHINERY": "machines", "BUILDING": "houses"})
    rows = load(spark, d, "customer")
    return rows.join(nations, rows.c_nationkey == nations.n_nationkey, "left").select(
        "c_custkey", segment.alias("segment"),
        F.coalesce("n_name", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("nation"),
    )


@query("prefix_join", """
  WITH ids AS (SELECT replace(lower(p_brand), '#', '') || CASE WHEN p_size = 1 THEN '' ELSE '-' || replace(p_name, ' ', '-') || '-' || p_partkey END AS id FROM part),
  w AS (SELECT DISTINCT replace(lower(p_brand), '#', '') || CASE WHEN p_size < 20 THEN '' ELSE '-' || split_part(p_name, ' ', 1) END AS wanted FROM part)
  SELECT wanted, count(id) AS matches, coalesce(max(id) FILTER (id = wanted), max(id) FILTER (id <> wanted), wanted) AS resolved
  FROM w LEFT JOIN ids ON id = wanted OR starts_with(id, wanted || '-') GROUP BY 1""")
def prefix_join(spark, d):
    part = load(spark, d, "part")
    brand = F.translate(F.lower("p_brand"), "#", "")
    tail = F.concat(F.lit("-"), F.translate("p_name", " ", "-"), F.lit("-"), F.col("p_partkey").cast("string"))
    ids = part.select(F.concat(brand, F.when(F.col("p_size") == 1, "").otherwise(tail)).alias("id"))
    head = F.concat(F.lit("-"), F.substring_index("p_name", " ", 1))
    wanted = part.select(F.concat(brand, F.when(F.col("p_size") < 20, "").otherwise(head)).alias("wanted"))
    return panel.prefix_matches(wanted, ids)


@query("density", """
  SELECT doc_id, round(len([x for x in string_split(text, ' ') if x <> '']) / (nullif(n_chars, 0) / 1000), 3) AS density FROM documents""")
def density(spark, d):
    tokens = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    return load(spark, d, "documents").select("doc_id", ms.density(tokens, F.col("n_chars")).alias("density"))


@query("legend_label", """
  SELECT p_partkey, p_name || CASE WHEN e <> '' THEN ' (' || e || ')' ELSE '' END AS label FROM (
    SELECT p_partkey, p_name, concat_ws(', ', CASE WHEN p_type = 'ECONOMY' THEN 'audio' END,
      CASE WHEN p_size > 25 THEN CASE WHEN p_size % 3 = 0 THEN 'short context' WHEN p_size % 3 = 1 THEN '>200k' END END) AS e FROM part)""")
def legend_label(spark, d):
    size = F.col("p_size")
    context = F.when(size % 3 == 0, "short_context").when(size % 3 == 1, ">200k")
    label = tx.legend_label(F.col("p_name"), F.when(F.col("p_type") == "ECONOMY", "audio"), context, size > 25)
    return load(spark, d, "part").select("p_partkey", label.alias("label"))
