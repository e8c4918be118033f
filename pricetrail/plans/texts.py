"""Text function queries over documents, parts, orders, events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from .base import flag, load, query

NORM = f"trim(regexp_replace(text, '{tx.SPACE}', ' ', 'g'))"
SLUG = r"""trim(regexp_replace(replace(regexp_replace(translate(lower({0}), '—–', '--'), '[^a-z0-9.\- ]+', '', 'g'), ' ', '-'), '-+', '-', 'g'), '-')"""


@query("text_norm", f"SELECT doc_id, sha256({NORM}) AS norm_hash, length({NORM}) AS norm_chars FROM documents")
def text_norm(spark, d):
    clean = tx.norm(F.col("text"))
    return load(spark, d, "documents").select(
        "doc_id", F.sha2(clean, 256).alias("norm_hash"), F.char_length(clean).cast("long").alias("norm_chars")
    )


@query("slugify", f"SELECT doc_id, sha256({SLUG.format(NORM)}) AS slug_hash, length({SLUG.format(NORM)}) AS slug_chars FROM documents")
def slugify(spark, d):
    slug = tx.slugify(F.col("text"))
    return load(spark, d, "documents").select(
        "doc_id", F.sha2(slug, 256).alias("slug_hash"), F.char_length(slug).cast("long").alias("slug_chars")
    )


_JOINED = "concat_ws('-', nullif(p_brand, ''), 'm ' || p_partkey, 'input', CASE WHEN p_size % 2 = 0 THEN 'Standard' END, CASE WHEN p_size > 25 THEN '>200k' ELSE '<=200k' END, lower(p_type), 'per_1M_tokens')"
_TIER = "concat_ws('-', nullif(p_brand, ''), 'm ' || p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Standard' END, CASE WHEN p_size > 25 THEN '>200k' ELSE '<=200k' END, lower(p_type))"


@query("build_id", f"SELECT p_partkey, {SLUG.format(_JOINED)} AS pricing_id, {SLUG.format(_TIER)} AS tier_id FROM part")
def build_id(spark, d):
    rows = load(spark, d, "part").select(
        "p_partkey",
        F.col("p_brand").alias("provider_id"),
        F.concat(F.lit("m "), F.col("p_partkey").cast("string")).alias("model_id"),
        F.lit("input").alias("component"),
        F.when(F.col("p_size") % 2 == 0, "Standard").alias("service_tier"),
        F.when(F.col("p_size") > 25, ">200k").otherwise("<=200k").alias("context_window"),
        F.lower("p_type").alias("modality"),
        F.lit("").alias("category"),
        F.lit(None).cast("string").alias("billing_variant"),
        F.lit("per_1M_tokens").alias("unit"),
    )
    return rows.select("p_partkey", tx.pricing_id().alias("pricing_id"), tx.tier_id().alias("tier_id"))


_V = "o_totalprice::DECIMAL(15, 2)::VARCHAR"
PRICE_TEXT = f"""px AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '$' || {_V} WHEN 1 THEN {_V}
    WHEN 2 THEN 'List price $' || left({_V}, length({_V}) - 6) || ',' || right({_V}, 6) || ' 50% off'
    WHEN 3 THEN '-' || {_V} ELSE 'free' END AS t FROM orders)"""
_MONEY = r"""CASE WHEN regexp_matches(replace({0}, ',', ''), '^-?[0-9]+(\.[0-9]+)?$') THEN replace({0}, ',', '')::DOUBLE
    WHEN regexp_extract(replace({0}, ',', ''), '\$([0-9]+(?:\.[0-9]+)?)', 1) <> '' THEN regexp_extract(replace({0}, ',', ''), '\$([0-9]+(?:\.[0-9]+)?)', 1)::DOUBLE END"""


def price_text():
    v = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    size = F.char_length(v)
    key = F.col("o_orderkey") % 5
    return (
        F.when(key == 0, F.concat(F.lit("$"), v))
        .when(key == 1, v)
        .when(key == 2, F.concat(F.lit("List price $"), F.left(v, size - 6), F.lit(","), F.right(v, F.lit(6)), F.lit(" 50% off")))
        .when(key == 3, F.concat(F.lit("-"), v))
        .otherwise("free")
    )


@query("parse_money", f"""
  WITH {PRICE_TEXT} SELECT o_orderkey, {_MONEY.format('t')} AS price,
    coalesce({_MONEY.format('t')}, 9.5) AS first_price, nullif(o_orderkey::DOUBLE, 0) AS number_price FROM px""")
def parse_money(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", price_text().alias("t"))
    return rows.select(
        "o_orderkey",
        tx.money(F.col("t")).alias("price"),
        tx.first_price(F.array(F.lit("n/a"), F.col("t"), F.lit("$9.5"))).alias("first_price"),
        tx.money_number(F.col("o_orderkey")).alias("number_price"),
    )


LABELS = """lab AS (SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'Text input' WHEN 1 THEN 'Cached input (audio)' WHEN 2 THEN 'Image, video output'
      WHEN 3 THEN 'Training' WHEN 4 THEN 'Video seconds' WHEN 5 THEN p_name WHEN 6 THEN '!!' ELSE 'Output text' END AS label,
    CASE p_size % 6 WHEN 0 THEN 'Price (/1M tokens) <= 200K input tokens' WHEN 1 THEN 'Price > 200K with Priority' WHEN 2 THEN 'Price with Flex/Batch'
      WHEN 3 THEN 'Price with Batch API' WHEN 4 THEN 'Region' ELSE 'Price =< 200k' END AS header,
    'USE1-' || replace(p_name, ' ', '') || CASE p_size % 5 WHEN 0 THEN '-input-tokens' WHEN 1 THEN '-output-tokens' WHEN 2 THEN '-cache-read-input-token-count'
      WHEN 3 THEN '-cache-write-input-token-count' ELSE '-input-tokens-batch' END AS usagetype FROM part)"""


@query("infer_category", f"""
  WITH {LABELS}, l AS (SELECT *, lower(label) AS low, lower(header) AS h,
    contains(lower(label), 'text')::INT + contains(lower(label), 'image')::INT + contains(lower(label), 'video')::INT + contains(lower(label), 'audio')::INT AS hits FROM lab)
  SELECT p_partkey, CASE WHEN hits > 1 THEN 'multimodal' WHEN contains(low, 'audio') THEN 'audio' WHEN contains(low, 'image') THEN 'image'
      WHEN contains(low, 'video') THEN 'video' WHEN contains(low, 'text') THEN 'text' END AS modality,
    CASE WHEN contains(low, 'cached input') THEN 'cached_input' WHEN contains(low, 'input') THEN 'input' WHEN contains(low, 'output') THEN 'output'
      WHEN contains(low, 'training') THEN 'training' ELSE coalesce(nullif({SLUG.format('low')}, ''), 'price') END AS component,
    CASE WHEN contains(h, 'flex/batch') OR contains(h, 'with flex') THEN 'flexbatch' WHEN contains(h, 'priority') THEN 'priority'
      WHEN regexp_matches(h, 'batch api|200k|1m|token') THEN 'standard' END AS service_tier,
    CASE WHEN regexp_matches(h, '<= 200k|<=200k|=< 200k') THEN '<=200k' WHEN regexp_matches(h, '> 200k|>200k') THEN '>200k' END AS context_window,
    CASE WHEN ends_with(usagetype, '-input-tokens') THEN 'input' WHEN ends_with(usagetype, '-output-tokens') THEN 'output'
      WHEN ends_with(usagetype, '-cache-read-input-token-count') THEN 'cached_input' WHEN ends_with(usagetype, '-cache-write-input-token-count') THEN 'cache_write' END AS usage_component
  FROM l""")
def infer_category(spark, d):
    size = F.col("p_size")

    def pick(mod, options, last):
        out = last if not isinstance(last, str) else F.lit(last)
        for k, v in reversed(options.items()):
            out = F.when(size % mod == k, v).otherwise(out)
        return out

    label = pick(8, {0: "Text input", 1: "Cached input (audio)", 2: "Image, video output", 3: "Training",
                     4: "Video seconds", 5: F.col("p_name"), 6: "!!"}, "Output text")
    header = pick(6, {0: "Price (/1M tokens) <= 200K input tokens", 1: "Price > 200K with Priority",
                      2: "Price with Flex/Batch", 3: "Price with Batch API", 4: "Region"}, "Price =< 200k")
    tail = pick(5, {0: "-input-tokens", 1: "-output-tokens", 2: "-cache-read-input-token-count",
                    3: "-cache-write-input-token-count"}, "-input-tokens-batch")
    usage = F.concat(F.lit("USE1-"), F.replace("p_name", F.lit(" "), F.lit("")), tail)
    return load(spark, d, "part").select(
        "p_partkey",
        tx.infer_modality(label).alias("modality"),
        tx.component_of_label(label).alias("component"),
        tx.tier_of_headers(F.array(header)).alias("service_tier"),
        tx.context_of_header(header).alias("context_window"),
        tx.component_of_suffix(usage).alias("usage_component"),
    )


@query("regex_split_label", r"""
  WITH l AS (SELECT p_partkey, p_name || CASE p_size % 3 WHEN 0 THEN ' (< 200k prompt tokens)' WHEN 1 THEN ' (≥128K Prompt Tokens)' ELSE '' END AS label,
    'Online requests: $' || p_partkey || '.5 Batch requests: $' || p_size AS cell,
    CASE WHEN p_size % 2 = 0 THEN p_name || ' Currently equivalent to x' ELSE p_name END AS phrase,
    'USE1-' || replace(p_name, ' ', '-') || '-input-tokens' AS usage FROM part)
  SELECT p_partkey, CASE WHEN regexp_extract(label, '(?i)\((<|≥)\s*([0-9]+k?)\s*prompt tokens\)', 1) <> '' THEN
      CASE WHEN regexp_extract(label, '(?i)\((<|≥)\s*([0-9]+k?)\s*prompt tokens\)', 1) = '<' THEN 'lt-' ELSE 'gte-' END
      || lower(regexp_extract(label, '(?i)\((<|≥)\s*([0-9]+k?)\s*prompt tokens\)', 2)) || '-prompt' END AS variant,
    trim(regexp_replace(label, '(?i)\s*\((<|≥)\s*[0-9]+k?\s*prompt tokens\)\s*', '', 'g')) AS base_name,
    regexp_extract(cell, 'Online requests:\s*\$([0-9]+(?:\.[0-9]+)?)', 1)::DOUBLE AS online_price,
    regexp_extract(cell, 'Batch requests:\s*\$([0-9]+(?:\.[0-9]+)?)', 1)::DOUBLE AS batch_price,
    split_part(phrase, ' Currently equivalent to ', 1) AS before_phrase,
    regexp_extract(usage, '^USE1-([A-Za-z0-9.]+(?:-[A-Za-z0-9.]+)?)-(?:input|output|cache)', 1) AS usage_name
  FROM l""")
def regex_split_label(spark, d):
    size, name, key = F.col("p_size"), F.col("p_name"), F.col("p_partkey").cast("string")
    tail = F.when(size % 3 == 0, " (< 200k prompt tokens)").when(size % 3 == 1, " (≥128K Prompt Tokens)").otherwise("")
    label = F.concat(name, tail)
    cell = F.concat(F.lit("Online requests: $"), key, F.lit(".5 Batch requests: $"), size.cast("string"))
    online, batch = tx.online_batch_prices(cell)
    phrase = F.when(size % 2 == 0, F.concat(name, F.lit(" Currently equivalent to x"))).otherwise(name)
    usage = F.concat(F.lit("USE1-"), F.translate(name, " ", "-"), F.lit("-input-tokens"))
    return load(spark, d, "part").select(
        "p_partkey",
        tx.threshold_variant(label).alias("variant"),
        tx.threshold_base(label).alias("base_name"),
        online.alias("online_price"),
        batch.alias("batch_price"),
        tx.before_phrase(phrase, " Currently equivalent to ").alias("before_phrase"),
        tx.usage_model_name(F.lit(None).cast("string"), usage).alias("usage_name"),
    )


@query("camel_split", r"""
  WITH r AS (SELECT p_partkey, upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) || upper(left(split_part(p_name, ' ', 2), 1))
    || substr(split_part(p_name, ' ', 2), 2) || 'G' || p_size || '-Lite' AS raw FROM part)
  SELECT p_partkey, trim(regexp_replace(replace(regexp_replace(raw, '([a-z])([A-Z0-9])', '\1 \2', 'g'), '-', ' '), ' +', ' ', 'g')) AS name FROM r""")
def camel_split(spark, d):
    raw = F.concat(
        F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("G"), F.col("p_size").cast("string"), F.lit("-Lite")
    )
    return load(spark, d, "part").select("p_partkey", tx.camel_split(raw).alias("name"))


@query("scrub_name", r"""
  WITH n AS (SELECT p_partkey, p_name || CASE p_size % 3 WHEN 0 THEN ' starting September 1, 2026' WHEN 1 THEN '  through August 31, 2026 (beta)' ELSE '' END AS name FROM part)
  SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(name, '\s+starting\s+[A-Za-z]+ \d{1,2}, \d{4}', '', 'g'),
    '\s+through\s+[A-Za-z]+ \d{1,2}, \d{4}', '', 'g'), '\s+', ' ', 'g')) AS name FROM n""")
def scrub_name(spark, d):
    tail = (
        F.when(F.col("p_size") % 3 == 0, " starting September 1, 2026")
        .when(F.col("p_size") % 3 == 1, "  through August 31, 2026 (beta)")
        .otherwise("")
    )
    return load(spark, d, "part").select("p_partkey", tx.scrub_name(F.concat("p_name", tail)).alias("name"))


@query("placeholder_filter", r"""
  WITH n AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'm-starting-' || p_partkey ELSE 'm-' || p_partkey || CASE WHEN p_size % 6 = 1 THEN '-2026-05-20' ELSE '' END END AS model_id,
    CASE WHEN p_size % 5 = 0 THEN p_name || ' Starting May 3, 2026' ELSE p_name END AS name,
    'USE1-' || p_partkey || CASE WHEN p_size % 7 = 0 THEN '-Batch' WHEN p_size % 7 = 1 THEN '-T2I' ELSE '' END AS usage FROM part)
  SELECT p_partkey, model_id FROM n WHERE NOT contains(lower(model_id), 'starting-') AND NOT regexp_matches(lower(name), '\bstarting\s+[a-z]+ \d{1,2}, \d{4}')
    AND NOT regexp_matches(model_id, '-20\d{2}-\d{2}-\d{2}$') AND NOT regexp_matches(lower(usage), 'batch|flex|priority|custom-model|cross-region|global|video|image|audio|speech|embeddings|canvas|sonic|reel|t2i|provisioned')""")
def placeholder_filter(spark, d):
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    dated = F.when(size % 6 == 1, "-2026-05-20").otherwise("")
    model = F.when(size % 4 == 0, F.concat(F.lit("m-starting-"), key)).otherwise(F.concat(F.lit("m-"), key, dated))
    name = F.when(size % 5 == 0, F.concat("p_name", F.lit(" Starting May 3, 2026"))).otherwise(F.col("p_name"))
    usage = F.concat(F.lit("USE1-"), key, F.when(size % 7 == 0, "-Batch").when(size % 7 == 1, "-T2I").otherwise(""))
    rows = load(spark, d, "part").select("p_partkey", model.alias("model_id"), name.alias("name"), usage.alias("usage"))
    return rows.filter(
        ~tx.future_placeholder(F.col("model_id"), F.col("name"))
        & ~tx.dated_suffix(F.col("model_id"))
        & ~tx.excluded_usage(F.col("usage"))
    ).select("p_partkey", "model_id")


@query("redact", r"""
  SELECT page_id, regexp_replace(url || '?key=' || page_id || 'secret&x=1', '(key=)[^&\s]+', '\1[REDACTED]', 'g') AS safe FROM pages""")
def redact(spark, d):
    text = F.concat("url", F.lit("?key="), F.col("page_id").cast("string"), F.lit("secret&x=1"))
    return load(spark, d, "pages").select("page_id", tx.redact(text).alias("safe"))


MESSAGES = """msg AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN ' KeyError: ''' || event_type || '''' WHEN 1 THEN 'Sanity check FAILED: x'
      WHEN 2 THEN 'HTTP 403 for ' || user_id WHEN 3 THEN 'quota exceeded' WHEN 4 THEN 'read timed out' WHEN 5 THEN 'Failed after 3 attempts: x'
      WHEN 6 THEN '' WHEN 7 THEN 'odd  thing! in ' || event_type || chr(10) || 'second' ELSE NULL END AS m,
    CASE event_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 400 WHEN 2 THEN 422 END AS code,
    CASE WHEN user_id % 2 = 0 THEN 'This Model is marked as Legacy' ELSE 'Unsupported parameter for this model' END AS body FROM events)"""


@query("classify_error", rf"""
  WITH {MESSAGES}, t AS (SELECT event_id, trim(coalesce(m, '')) AS t, code, body FROM msg), k AS (SELECT *,
    regexp_extract(t, 'KeyError:\s*[''"]?([^''"]+)[''"]?', 1) AS key,
    left(trim(regexp_replace(left(split_part(t, chr(10), 1), 120), '[^a-zA-Z0-9:_-]+', '_', 'g'), '_'), 80) AS rest FROM t)
  SELECT event_id, CASE WHEN key <> '' THEN 'KeyError:' || key WHEN regexp_matches(t, '(?i)sanity check failed') THEN 'SanityCheckFailed'
      WHEN regexp_matches(t, '(?i)auth|401|403|unauthorized|forbidden') THEN 'AuthError' WHEN regexp_matches(t, '(?i)rate.?limit|429|quota') THEN 'RateLimit'
      WHEN regexp_matches(t, '(?i)timeout|timed out') THEN 'Timeout' WHEN regexp_matches(t, 'Failed after \d+ attempts') THEN 'NetworkRetryExhausted'
      ELSE coalesce(nullif(rest, ''), 'UnknownError') END AS signature,
    CASE WHEN key <> '' OR regexp_matches(t, '(?i)sanity check failed') THEN 'parse'
      WHEN regexp_matches(t, '(?i)auth|401|403|unauthorized|forbidden') THEN 'auth' WHEN regexp_matches(t, '(?i)rate.?limit|429|quota') THEN 'rate_limit'
      WHEN regexp_matches(t, '(?i)timeout|timed out') THEN 'timeout' WHEN regexp_matches(t, 'Failed after \d+ attempts') THEN 'network' ELSE 'unknown' END AS category,
    CASE WHEN code IS NULL THEN 0 WHEN code = 404 THEN 1 ELSE (contains(lower(body), 'legacy'))::INT END::BIGINT AS unavailable FROM k""")
def classify_error(spark, d):
    e = F.col("event_id")
    options = {
        0: F.concat(F.lit(" KeyError: '"), "event_type", F.lit("'")),
        1: F.lit("Sanity check FAILED: x"),
        2: F.concat(F.lit("HTTP 403 for "), F.col("user_id").cast("string")),
        3: F.lit("quota exceeded"),
        4: F.lit("read timed out"),
        5: F.lit("Failed after 3 attempts: x"),
        6: F.lit(""),
        7: F.concat(F.lit("odd  thing! in "), "event_type", F.lit("\nsecond")),
    }
    message = F.lit(None).cast("string")
    for k, v in options.items():
        message = F.when(e % 9 == k, v).otherwise(message)
    code = F.when(e % 4 == 0, 404).when(e % 4 == 1, 400).when(e % 4 == 2, 422)
    body = F.when(F.col("user_id") % 2 == 0, "This Model is marked as Legacy").otherwise("Unsupported parameter for this model")
    signature, category = tx.classify_error(message)
    return load(spark, d, "events").select(
        "event_id", signature.alias("signature"), category.alias("category"),
        flag(tx.model_unavailable(code, body)).alias("unavailable"),
    )


@query("url_normalize", r"""
  WITH p AS (SELECT page_id, trim(url) AS u FROM pages), q AS (SELECT page_id, u, regexp_extract(u, '^([a-z]+)://', 1) AS scheme,
      regexp_extract(u, '^([^?#]*)', 1) AS base, regexp_extract(u, '^[^?#]*\?([^#]*)', 1) AS qs, regexp_extract(u, '(#.*)$', 1) AS frag FROM p),
  r AS (SELECT *, [x for x in string_split(qs, '&') if x <> '' AND split_part(x, '=', 1) <> 'ref'] AS kept FROM q)
  SELECT page_id, CASE WHEN scheme IN ('http', 'https') THEN
    CASE WHEN scheme = 'http' THEN 'https' || substr(base, 5) ELSE base END || '?' ||
      array_to_string(kept || CASE WHEN len([x for x in kept if split_part(x, '=', 1) = 'page']) = 0 THEN ['page=1'] ELSE [] END, '&') || frag
    ELSE u END AS url FROM r""")
def url_normalize(spark, d):
    clean = tx.url_without_param(F.col("url"), "ref", ("page", "1"), ("http", "https"))
    return load(spark, d, "pages").select("page_id", clean.alias("url"))


@query("text_sizes", f"""
  SELECT doc_id, length(text) AS chars, strlen(text) AS bytes,
    len([x for x in regexp_split_to_array(text, '{tx.SPACE}') if x <> '']) AS words FROM documents""")
def text_sizes(spark, d):
    sizes = tx.text_sizes(F.col("text"))
    return load(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in sizes.items()])


@query("json_extract_fields", """
  SELECT event_id, (props->>'$.k')::BIGINT AS k, props->>'$.missing' AS missing FROM events""")
def json_extract_fields(spark, d):
    return load(spark, d, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )
