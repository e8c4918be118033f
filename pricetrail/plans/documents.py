"""Document, JSON, file and table-maintenance queries.

Queries that write do so under the shared work folder and read back what they
wrote; paths are new on each run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..functions import text as tx
from ..operators import extract, ordered
from ..operators import history as h
from ..operators import tiers as price_tiers
from ..schemas import DOCUMENT, PROVIDER, SERIES as SERIES_SCHEMA
from ..session import work_path
from ..sources import datasets, readers, writers
from .base import OBS, SERIES, TIER, load, observations, query, series, tiers


def snapshot_docs(spark, d):
    rows = series(spark, d)
    meta = writers.document_meta(F.lit("2024-02-01T00:00:00Z"))
    providers = F.array(F.struct(*[F.lit(v).alias(n) for n, v in zip(PROVIDER.names, ("click", "Click", "x"))]))
    return writers.build_documents(rows, meta, providers, "pricing_id", rows_per_part=100)


@query("scan_snapshots", f"""
  WITH {SERIES} SELECT date, '2.1.0' AS schema_version, count(*) AS n_rows, round(sum(input_price), 2) AS total FROM series GROUP BY 1""")
def scan_snapshots(spark, d):
    path = work_path(spark, "snapshots")
    writers.write_documents(snapshot_docs(spark, d), path)
    docs = readers.good_documents(readers.read_document_lines(spark, path))
    return readers.document_rows(docs).groupBy("date", "schema_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("input_price"), 2).alias("total")
    )


def document_files(spark, d):
    """Each day's document as one indented file named after the day."""
    rows = series(spark, d)
    meta = writers.document_meta(F.lit("2024-02-01T00:00:00Z"))
    providers = F.array(F.struct(*[F.lit(v).alias(n) for n, v in zip(PROVIDER.names, ("click", "Click", "x"))]))
    docs = writers.build_documents(rows, meta, providers, "pricing_id", rows_per_part=10_000_000)
    parts, folder = work_path(spark, "document-parts"), work_path(spark, "document-files")
    text = F.to_json(F.struct("meta", "providers", "pricing"), {"pretty": "true"})
    docs.select("date", text.alias("value")).repartition("date").write.partitionBy("date").text(parts)
    return writers.named_by_day(spark, parts, folder)


@query("scan_files", f"""
  WITH {SERIES} SELECT date, '2.1.0' AS schema_version, count(*) AS n_rows, round(sum(input_price), 2) AS total FROM series GROUP BY 1""")
def scan_files(spark, d):
    """The history as it is kept: one document of many lines a file, dated by its name."""
    docs = readers.good_documents(readers.read_documents(spark, document_files(spark, d)))
    return readers.document_rows(docs).groupBy("date", "schema_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("input_price"), 2).alias("total"))


@query("live_document", f"""
  WITH {SERIES} SELECT pricing_id, input_price, output_price FROM series WHERE date = (SELECT max(date) FROM series)""")
def live_document(spark, d):
    """Rows of the newest document alone, read by its own path."""
    folder = document_files(spark, d)
    newest = ordered.global_value(readers.read_documents(spark, folder), F.max("date"))
    day = spark.range(1).select(newest.cast("string")).first()[0]
    live = readers.read_live(spark, f"{folder}/{day}.json")
    return live.select(F.inline("pricing")).select("pricing_id", "input_price", "output_price")


@query("build_document", f"""
  WITH {SERIES} SELECT date, count(*) AS n_rows, count(DISTINCT pricing_id) AS n_ids, round(sum(output_price), 2) AS total FROM series GROUP BY 1""")
def build_document(spark, d):
    text = snapshot_docs(spark, d).select("date", F.to_json(F.struct("meta", "providers", "pricing")).alias("payload"))
    rows = text.select("date", F.inline(F.from_json("payload", DOCUMENT)["pricing"]))
    return rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("pricing_id").alias("n_ids"),
        F.round(F.sum("output_price"), 2).alias("total"),
    )


@query("scan_permissive", f"""
  WITH {TIER} SELECT date, count(*) FILTER (user_id % 10 <> 0) AS good, count(*) FILTER (user_id % 10 = 0) AS rejected,
    coalesce(sum((click_price IS NOT NULL)::INT + (view_price IS NOT NULL)::INT) FILTER (user_id % 10 <> 0), 0)::BIGINT AS prices FROM tier GROUP BY 1""")
def scan_permissive(spark, d):
    path = work_path(spark, "permissive")
    text = payloads(spark, d)
    broken = F.when(F.col("user_id") % 10 == 0, F.substring("payload", 1, 40)).otherwise(F.col("payload"))
    text.select("date", broken.alias("value")).write.partitionBy("date").text(path)
    docs = readers.read_document_lines(spark, path)
    bad = F.col(readers.CORRUPT).isNotNull()
    return docs.groupBy("date").agg(
        F.count_if(~bad).alias("good"),
        F.count_if(bad).alias("rejected"),
        F.sum(F.when(bad, 0).otherwise(F.size("pricing"))).alias("prices"),
    )


def payloads(spark, d):
    """One document per (user, day); its pricing list has at most two entries."""

    def entry(f):
        return F.when(
            F.col(f"{f}_price").isNotNull(),
            F.struct(
                F.lit(f).alias("pricing_id"), F.col(f"{f}_price").alias("input_price"), F.lit("per_1M_tokens").alias("input_unit"),
                F.lit("chat").alias("type"),
            ),
        )

    doc = F.struct(
        F.struct(F.lit("2.1.0").alias("schema_version"), F.lit("2024-02-01T00:00:00Z").alias("last_run_datetime")).alias("meta"),
        F.array_compact(F.array(entry("click"), entry("view"))).alias("pricing"),
    )
    return tiers(spark, d).select("user_id", "date", F.to_json(doc).alias("payload"))


@query("lateral_inline", f"""
  WITH {TIER} SELECT user_id, date, '2.1.0' AS schema_version, 'click' AS pricing_id, click_price AS price FROM tier WHERE click_price IS NOT NULL
  UNION ALL SELECT user_id, date, '2.1.0', 'view', view_price FROM tier WHERE view_price IS NOT NULL""")
def lateral_inline(spark, d):
    parsed = payloads(spark, d).select(
        "user_id", "date",
        F.from_json("payload", "meta struct<schema_version: string>, pricing array<struct<pricing_id: string, input_price: double>>").alias("doc"),
    )
    return parsed.select(
        "user_id", "date", F.col("doc.meta.schema_version").alias("schema_version"), F.inline("doc.pricing")
    ).withColumnRenamed("input_price", "price")


@query("stage_prices", f"""
  WITH {TIER}, p AS (SELECT user_id, date, 'click' AS pricing_id, click_price AS price FROM tier WHERE click_price IS NOT NULL
    UNION ALL SELECT user_id, date, 'view', view_price FROM tier WHERE view_price IS NOT NULL)
  SELECT pricing_id, 'input_tokens' AS sku_type, count(*) AS n, sum(price::DECIMAL(20, 10))::DOUBLE AS price_usd,
    sum(round(price::DECIMAL(20, 10) / 1000, 6))::DECIMAL(20, 6)::DOUBLE AS price_per_1k FROM p GROUP BY 1""")
def stage_prices(spark, d):
    docs = payloads(spark, d).select(
        writers.content_hash(F.col("payload")).alias("content_sha256"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
        F.from_json("payload", DOCUMENT).alias("doc"),
    )
    return price_tiers.stage_prices(docs).groupBy("pricing_id", "sku_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price_usd").cast("double").alias("price_usd"),
        F.sum("price_per_1k_tokens_usd").cast("double").alias("price_per_1k"),
    )


@query("json_inline_rows", """
  SELECT event_id, user_id, value FROM events UNION ALL SELECT event_id, -user_id, value * 2 FROM events WHERE event_type = 'click'""")
def json_inline_rows(spark, d):
    row = F.struct("event_id", "user_id", "value")
    extra = F.struct("event_id", (-F.col("user_id")).alias("user_id"), (F.col("value") * 2).alias("value"))
    rows = F.when(F.col("event_type") == "click", F.array(row, extra)).otherwise(F.array(row))
    text = F.when(F.col("event_id") % 2 == 0, F.to_json(rows)).otherwise(F.to_json(F.struct(rows.alias("rows"))))
    docs = load(spark, d, "events").select(text.alias("payload"))
    element = "struct<event_id: bigint, user_id: bigint, value: double>"
    return docs.select(F.inline(nested.rows_of_json(F.col("payload"), element)))


@query("json_try_parse", """
  SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN (props->>'$.k')::BIGINT END AS run_id FROM events""")
def json_try_parse(spark, d):
    text = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    return load(spark, d, "events").select("event_id", nested.try_field(text, "$.k", "bigint").alias("run_id"))


@query("stage_usage", """
  SELECT event_type AS dataset_id, 's' || event_id AS session_id, CASE WHEN user_id % 3 <> 0 THEN 'm' || user_id END AS model,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start_time, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS end_time,
    'p' || (user_id % 4) AS project, (1 + event_id % 2)::BIGINT AS n_messages, user_id * 10 AS input_tokens, event_id AS output_tokens
  FROM events WHERE event_type <> 'error'""")
def stage_usage(spark, d):
    user, event = F.col("user_id"), F.col("event_id")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    message = F.struct(F.lit("user").alias("role"), F.lit("hi").alias("text"))
    payload = F.struct(
        F.concat(F.lit("s"), event.cast("string")).alias("session_id"),
        F.when(user % 3 != 0, F.concat(F.lit("m"), user.cast("string"))).alias("model"),
        F.date_format("ts", stamp).alias("start_time"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), stamp).alias("end_time"),
        F.concat(F.lit("p"), (user % 4).cast("string")).alias("project"),
        F.when(event % 2 == 0, F.array(message)).otherwise(F.array(message, message)).alias("messages"),
        F.struct((user * 10).alias("input_tokens"), event.alias("output_tokens")).alias("stats"),
    )
    raw = load(spark, d, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("dataset_id"), F.to_json(payload).alias("payload")
    )
    shown = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return readers.stage_usage(raw).select(
        "dataset_id", "session_id", "model",
        F.date_format("start_time", shown).alias("start_time"), F.date_format("end_time", shown).alias("end_time"),
        "project",
        F.size(F.variant_get("messages", "$", "array<struct<role: string>>")).cast("long").alias("n_messages"),
        "input_tokens", "output_tokens",
    )


SKUS = """skus AS (SELECT p_partkey, 'SKU' || p_partkey AS sku, CASE p_size % 3 WHEN 0 THEN 'Nova ' || p_name WHEN 1 THEN NULL ELSE 'Claude ' || p_name END AS model,
    'USE1-' || CASE WHEN p_size % 3 = 1 THEN 'TitanText' ELSE 'Model' END || p_partkey || CASE p_size % 4 WHEN 0 THEN '-input-tokens' WHEN 1 THEN '-output-tokens'
      WHEN 2 THEN '-cache-read-input-token-count' ELSE '-input-tokens-batch' END AS usagetype,
    CASE WHEN p_size % 5 = 0 THEN 'Requests' ELSE '1K tokens' END AS unit, p_retailprice::DECIMAL(12, 2)::VARCHAR AS usd FROM part)"""


def catalog(spark, d):
    """Parts as catalog documents of at most a hundred products each."""
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    tail = (
        F.when(size % 4 == 0, "-input-tokens")
        .when(size % 4 == 1, "-output-tokens")
        .when(size % 4 == 2, "-cache-read-input-token-count")
        .otherwise("-input-tokens-batch")
    )
    rows = load(spark, d, "part").select(
        F.floor(F.col("p_partkey") / 100).alias("doc"),
        F.concat(F.lit("SKU"), key).alias("sku"),
        F.when(size % 3 == 0, F.concat(F.lit("Nova "), "p_name")).when(size % 3 == 2, F.concat(F.lit("Claude "), "p_name")).alias("model"),
        F.concat(F.lit("USE1-"), F.when(size % 3 == 1, "TitanText").otherwise("Model"), key, tail).alias("usagetype"),
        F.when(size % 5 == 0, "Requests").otherwise("1K tokens").alias("unit"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("usd"),
    )
    product = F.struct(F.struct("model", "usagetype").alias("attributes"))
    dimension = F.struct("unit", F.create_map(F.lit("USD"), F.col("usd")).alias("pricePerUnit"))
    offer = F.struct(F.create_map(F.lit("d1"), dimension).alias("priceDimensions"))
    term = F.create_map(F.lit("o1"), offer)
    products = rows.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("sku", product))).alias("m"))
    terms = rows.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("sku", term))).alias("m"))
    return (
        products.select(F.to_json("m").alias("payload")),
        terms.select(F.to_json(F.struct(F.col("m").alias("OnDemand"))).alias("payload")),
    )


@query("map_explode_join", f"""
  WITH {SKUS} SELECT sku, model, usagetype, 'o1' AS offer_id, 'd1' AS dimension_id, unit, usd FROM skus""")
def map_explode_join(spark, d):
    products, terms = catalog(spark, d)
    return nested.catalog_rows(products, terms).select(
        "sku", F.col("attributes.model").alias("model"), F.col("attributes.usagetype").alias("usagetype"),
        "offer_id", "dimension_id", "unit", "usd",
    )


@query("catalog_prices", rf"""
  WITH {SKUS}, k AS (SELECT *, CASE WHEN ends_with(usagetype, '-input-tokens') THEN 'input' WHEN ends_with(usagetype, '-output-tokens') THEN 'output'
      WHEN ends_with(usagetype, '-cache-read-input-token-count') THEN 'cached_input' END AS component,
    coalesce(model, trim(regexp_replace(regexp_replace(regexp_extract(usagetype, '^USE1-([A-Za-z0-9.]+(?:-[A-Za-z0-9.]+)?)-(?:input|output|cache)', 1),
      '([a-z])([A-Z0-9])', '\1 \2', 'g'), '-', ' ', 'g'))) AS display_name FROM skus)
  SELECT sku, display_name, component, round(usd::DOUBLE * 1000, 6) AS price FROM k
  WHERE component IS NOT NULL AND unit = '1K tokens' AND (contains(lower(model), 'nova') OR regexp_matches(lower(usagetype), 'use1-titan|use1-nova'))
    AND NOT contains(lower(usagetype), 'batch')""")
def catalog_prices(spark, d):
    return extract.catalog_prices(*catalog(spark, d)).select("sku", "display_name", "component", "price")


@query("normalize_versions", f"""
  WITH {SERIES}, raw AS (SELECT s.*, CASE WHEN date < DATE '2024-01-10' THEN '1.2.0' ELSE '2.1.0' END AS v,
      CASE WHEN provider_id = 'signup' THEN 'image' ELSE 'chat' END AS type, CASE WHEN provider_id = 'error' THEN 'per_image' ELSE 'per_1M_tokens' END AS unit,
      CASE WHEN provider_id = 'purchase' THEN 'batch' WHEN provider_id = 'click' THEN NULL ELSE 'standard' END AS tier FROM series s)
  SELECT date, CASE WHEN v = '1.2.0' THEN provider_id || '-' || model_id || '-' || type ELSE pricing_id END AS pricing_id, provider_id, model_id,
    'standard' AS service_tier, CASE WHEN v = '1.2.0' THEN 'standard_api' ELSE 'cat' END AS category, input_price, output_price,
    CASE WHEN v = '2.1.0' THEN cached_input_price END AS cached_input_price FROM raw
  WHERE CASE WHEN v = '1.2.0' THEN type = 'chat' AND unit = 'per_1M_tokens' ELSE unit = 'per_1M_tokens' AND (tier IS NULL OR tier = 'standard') END""")
def normalize_versions(spark, d):
    kind = F.col("provider_id")
    unit = F.when(kind == "error", "per_image").otherwise("per_1M_tokens")
    raw = series(spark, d).withColumns({
        "schema_version": F.when(F.col("date") < F.lit("2024-01-10").cast("date"), "1.2.0").otherwise("2.1.0"),
        "type": F.when(kind == "signup", "image").otherwise("chat"),
        "unit": unit,
        "input_unit": unit,
        "output_unit": F.lit(None).cast("string"),
        "cached_input_unit": F.lit("per_image"),
        "cache_read_unit": F.lit(None).cast("string"),
        "service_tier": F.when(kind == "purchase", "batch").when(kind != "click", "standard"),
        "category": F.lit("cat"),
        "cache_read_price": F.col("cached_input_price"),
    })
    return h.normalize_versions(raw).select(
        "date", "pricing_id", "provider_id", "model_id", "service_tier", "category",
        "input_price", "output_price", "cached_input_price",
    )


@query("csv_roundtrip_typed", """
  SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, DATE '2024-01-01' + c_nationkey AS started FROM customer""")
def csv_roundtrip_typed(spark, d):
    path = work_path(spark, "csv")
    started = F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey"))
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "started"]
    load(spark, d, "customer").withColumn("started", started).select(*cols).write.option("header", True).csv(path)
    text = readers.read_csv_strings(spark, path, cols)
    casts = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "decimal(20,10)", "started": "date"}
    return readers.cast_columns(text, casts).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


def loaded_datasets(spark, d):
    """Five datasets, one with a file that can't be read, and one that is not there."""
    root, target = work_path(spark, "datasets"), work_path(spark, "loaded")
    events = load(spark, d, "events").select("event_id", "user_id", "value", "event_type")
    events.write.partitionBy("event_type").parquet(root)
    load(spark, d, "region").select(F.col("r_name").alias("value")).write.mode("append").text(f"{root}/event_type=error")
    names = ("click", "view", "purchase", "signup", "error", "gone")
    schema = events.drop("event_type").schema
    report = datasets.load_datasets(spark, {n: f"{root}/event_type={n}" for n in names}, target, schema)
    return report, datasets.read_committed(spark, target, schema)


@query("multi_dataset_union", "SELECT event_type AS dataset_id, event_id, user_id, value FROM events WHERE event_type <> 'error'")
def multi_dataset_union(spark, d):
    return loaded_datasets(spark, d)[1]


@query("dataset_report", """
  SELECT event_type AS dataset_id, CASE WHEN event_type = 'error' THEN 'FAILED_READ_FILE' ELSE 'loaded' END AS status,
    count(*) FILTER (event_type <> 'error') AS n_rows FROM events GROUP BY 1
  UNION ALL SELECT 'gone', 'PATH_NOT_FOUND', 0""")
def dataset_report(spark, d):
    return loaded_datasets(spark, d)[0]


@query("append_log", """
  SELECT lang AS run_id, count(*) AS n, count(*) AS n_ids, count(DISTINCT sha256(text)) AS n_hashes, count(*) AS n_times,
    '2024-01-05 00:00:00' AS first_scrape, '2024-01-05 00:00:00' AS last_scrape FROM documents GROUP BY 1""")
def append_log(spark, d):
    path = work_path(spark, "log")
    docs = load(spark, d, "documents").select(
        "lang", F.col("text").alias("payload"),
        F.when(F.col("doc_id") % 2 == 0, "2024-01-05T00:00:00Z").otherwise("2024-01-05T02:00:00+02:00").alias("scraped_at"),
    )
    for (lang,) in docs.select("lang").distinct().collect():
        writers.append_log(docs.filter(F.col("lang").eqNullSafe(lang)), path, lang)
    log = spark.read.parquet(path)
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("snapshot_id").alias("n_ids"),
        F.count_distinct("content_sha256").alias("n_hashes"),
        F.count("ingested_at").alias("n_times"),
        *[F.date_format(f("scraped_at"), "yyyy-MM-dd HH:mm:ss").alias(n) for n, f in (("first_scrape", F.min), ("last_scrape", F.max))],
    )


@query("insert_if_absent", """
  WITH ranked AS (SELECT sha256(text) AS content_sha256, doc_id, lang, row_number() OVER (PARTITION BY sha256(text) ORDER BY (lang <> 'en'), doc_id) AS rn FROM documents)
  SELECT content_sha256, doc_id, lang FROM ranked WHERE rn = 1""")
def insert_if_absent(spark, d):
    path = work_path(spark, "absent")
    docs = load(spark, d, "documents").select(
        writers.content_hash(F.col("text")).alias("content_sha256"), "doc_id", "lang", F.col("text").alias("payload")
    )
    writers.insert_if_absent(docs.filter(F.col("lang") == "en"), path, "doc_id")
    writers.insert_if_absent(docs, path, "doc_id")
    writers.insert_if_absent(docs, path, "doc_id")
    return spark.read.parquet(path).select("content_sha256", "doc_id", "lang")


@query("replace_day", f"""
  WITH {OBS} SELECT pricing_id, date, CASE WHEN date = DATE '2024-01-15' THEN value * 2 ELSE value END AS value FROM obs""")
def replace_day(spark, d):
    path = work_path(spark, "series")
    rows = observations(spark, d).select("pricing_id", "date", "value")
    writers.replace_days(rows, path)
    day = rows.filter(F.col("date") == F.lit("2024-01-15").cast("date"))
    writers.replace_days(day.withColumn("value", F.col("value") * 2), path)
    return spark.read.parquet(path).select("pricing_id", "date", "value")


@query("rebuild_equals_append", f"""
  WITH {OBS} SELECT count(*) AS rebuilt_rows, count(*) AS appended_rows, 0::BIGINT AS differing_rows,
    min(date) AS first_date, max(date) AS last_date FROM obs""")
def rebuild_equals_append(spark, d):
    rows = series(spark, d)
    whole = writers.rebuild({"series": rows}, work_path(spark, "rebuild"))["series"]
    path = work_path(spark, "append")
    last = ordered.global_value(rows, F.max("date"))
    writers.replace_days(rows.filter(F.col("date") < last), path)
    writers.replace_days(rows.filter(F.col("date") == last), path)
    rebuilt = spark.read.schema(SERIES_SCHEMA).parquet(whole)
    appended = spark.read.schema(SERIES_SCHEMA).parquet(path)
    sides = rebuilt.withColumn("__side", F.lit(1)).unionByName(appended.withColumn("__side", F.lit(-1)))
    balance = sides.groupBy(*SERIES_SCHEMA.names).agg(
        F.sum("__side").alias("b"),
        F.count_if(F.col("__side") == 1).alias("r"),
        F.count_if(F.col("__side") == -1).alias("a"),
    )
    return balance.agg(
        F.sum("r").alias("rebuilt_rows"),
        F.sum("a").alias("appended_rows"),
        F.count_if(F.col("b") != 0).alias("differing_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


INCIDENTS = """i AS (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'degraded' ELSE 'success' END AS status FROM events),
  ended AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS stop,
    CASE WHEN event_id % 21 = 0 THEN 'success' ELSE status END AS status FROM i)"""


def incident_rows(spark, d):
    """Runs as they first ended, and as some of them ended again a day later."""
    kind = F.col("event_type")
    signature, category = tx.classify_error(F.concat(F.lit("timeout in "), kind))
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    rows = load(spark, d, "events").select(
        "event_id", "ts",
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("run_id"),
        F.when(kind == "error", "failed").when(kind == "signup", "degraded").otherwise("success").alias("status"),
        F.date_format("ts", stamp).alias("finished_at"),
        signature.alias("error_signature"), category.alias("error_category"),
    )
    again = rows.filter(F.col("event_id") % 7 == 0).withColumns({
        "finished_at": F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), stamp),
        "status": F.when(F.col("event_id") % 21 == 0, "success").otherwise(F.col("status")),
    })
    return rows.drop("event_id", "ts"), again.drop("event_id", "ts")


def incident_log(spark, d):
    path = work_path(spark, "incidents")
    first, again = incident_rows(spark, d)
    for rows in (first, again, again):
        writers.incidents_by_day(rows, path)
    return spark.read.schema("run_id string, status string, finished_at string, error_category string, day string").json(path)


@query("incidents_by_day", f"""
  WITH {INCIDENTS} SELECT stop::DATE::VARCHAR AS day, status, count(*) AS n, min('r' || event_id) AS first_run
  FROM ended WHERE status <> 'success' GROUP BY ALL""")
def incidents_by_day(spark, d):
    return incident_log(spark, d).groupBy("day", "status").agg(F.count(F.lit(1)).alias("n"), F.min("run_id").alias("first_run"))


@query("latest_incident", f"""
  WITH {INCIDENTS} SELECT 'r' || event_id AS run_id, status, strftime(stop, '%Y-%m-%dT%H:%M:%SZ') AS finished_at FROM ended
  ORDER BY strftime(stop, '%Y-%m-%dT%H:%M:%SZ') DESC, 'r' || event_id DESC LIMIT 1""")
def latest_incident(spark, d):
    """The run that finished last, a success or not, of all reports of runs."""
    first, again = incident_rows(spark, d)
    return writers.latest_incident(first.unionByName(again)).select("run_id", "status", "finished_at")


@query("latest_per_day", """
  SELECT ts::DATE AS date, event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY ts::DATE ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_day(spark, d):
    return writers.latest_per_day(load(spark, d, "events"), "ts", ["event_id"], ["event_id", "user_id"])

