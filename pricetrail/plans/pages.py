"""Page queries: blocks of the page table, and price tables laid out from parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract
from ..sources.html import html_blocks as blocks_of
from .base import load, query


@query("html_blocks", r"""
  WITH parts AS (SELECT page_id, html, list_transform(string_split(string_split(html, '</article>')[1], '<p>')[2:],
      lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS p FROM pages),
  texts AS (SELECT page_id, html, list_filter(list_transform(p, lambda x: replace(replace(replace(replace(x,
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), lambda x: x <> '') AS p FROM parts)
  SELECT page_id, len(regexp_extract_all(html, '<h[1-6][ >]')) AS headings, len(p)::BIGINT AS paragraphs,
    sha256(array_to_string(p, chr(10))) AS text_hash FROM texts""")
def html_blocks(spark, d):
    """Headings of each page, and its paragraphs whole and in order."""
    texts = F.transform(F.array_sort(F.collect_list(F.when(
        (F.col("kind") == "label") & (F.col("tag") == "p"), F.struct("block_ord", "text")))), lambda b: b["text"])
    return blocks_of(load(spark, d, "pages")).groupBy("page_id").agg(
        F.count_if(F.col("kind") == "heading").alias("headings"),
        F.size(texts).cast("long").alias("paragraphs"),
        F.sha2(F.array_join(texts, "\n"), 256).alias("text_hash"))


@query("prev_heading")
def prev_heading(spark, d):
    marked = extract.prev_heading(blocks_of(load(spark, d, "pages")), ("h1",))
    return marked.groupBy("page_id", "heading").agg(
        F.count(F.lit(1)).alias("blocks"), F.min("block_ord").alias("first_block")
    )


def html_row(tag, *cells):
    parts = []
    for c in cells:
        parts += [F.lit(f"<{tag}>"), c if not isinstance(c, str) else F.lit(c), F.lit(f"</{tag}>")]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))


def dollars(c):
    return F.concat(F.lit("$"), c.cast("decimal(12,2)").cast("string"))


# About half a minute of work for a task.
PAGES_PER_TASK = 10_000


def spread(parts):
    """Narrow rows in as many partitions as the pages made of them need to be parsed:
    one for each core at least, and no more than ``PAGES_PER_TASK`` rows in each."""
    cores = parts.sparkSession.sparkContext.defaultParallelism
    return parts.repartition(max(cores, -(-parts.count() // PAGES_PER_TASK)), "p_partkey")


def part_pages(spark, d, provider, before, *rows):
    """One page per part with a price table of the given rows."""
    parts = spread(load(spark, d, "part"))
    html = F.concat(F.lit("<html><body>" + before + "<table>"), *rows, F.lit("</table></body></html>"))
    return parts.select(
        F.col("p_partkey").alias("page_id"), F.lit(provider).alias("provider_id"), html.alias("html")
    )



@query("extract_header_columns", """
  WITH p AS (SELECT p_partkey AS page_id, 'claude-' || replace(p_name, ' ', '-') AS model_id, p_retailprice AS b FROM part)
  SELECT page_id, model_id, 'input' AS component, NULL::VARCHAR AS billing_variant, b AS price FROM p
  UNION ALL SELECT page_id, model_id, 'output', NULL, b * 5 FROM p
  UNION ALL SELECT page_id, model_id, 'cache_write', '5m', b * 2 FROM p
  UNION ALL SELECT page_id, model_id, 'cache_write', '1h', b * 3 FROM p WHERE page_id % 4 <> 0
  UNION ALL SELECT page_id, model_id, 'cache_read', NULL, b * 4 FROM p""")
def extract_header_columns(spark, d):
    base = F.col("p_retailprice")
    hour = F.when(F.col("p_partkey") % 4 == 0, "n/a").otherwise(dollars(base * 3))
    pages = part_pages(
        spark, d, "anthropic", "<h2>Prices</h2>",
        html_row("th", "Model", "Base Input Tokens", "5m Cache Writes", "1h Cache Writes", "Cache Hits &amp; Refreshes", "Output Tokens"),
        html_row("td", F.concat(F.lit("Claude "), F.col("p_name")), dollars(base), dollars(base * 2), hour, dollars(base * 4), dollars(base * 5)),
        html_row("td", "Someone else", "$1", "$1", "$1", "$1", "$1"),
    )
    return extract.extract_prices(pages, ["anthropic"]).select("page_id", "model_id", "component", "billing_variant", "price")


@query("extract_fill_down", """
  WITH p AS (SELECT p_partkey AS page_id, replace(p_name, ' ', '-') AS model_id, p_retailprice AS b FROM part),
  r AS (SELECT page_id, model_id, 'text' AS modality, b AS a, b * 2 AS c, b * 3 AS o FROM p
    UNION ALL SELECT page_id, model_id, 'image', b * 4, NULL, b * 5 FROM p)
  SELECT page_id, model_id, modality, 'image_generation' AS category, 'input' AS component, a AS price FROM r
  UNION ALL SELECT page_id, model_id, modality, 'image_generation', 'cached_input', c FROM r WHERE c IS NOT NULL
  UNION ALL SELECT page_id, model_id, modality, 'image_generation', 'output', o FROM r""")
def extract_fill_down(spark, d):
    base = F.col("p_retailprice")
    pages = part_pages(
        spark, d, "openai", "<h2>Image generation models</h2><button>Standard</button>",
        html_row("th", "Model", "Modality", "Input", "Cached input", "Output"),
        html_row("td", F.col("p_name"), "Text", dollars(base), dollars(base * 2), dollars(base * 3)),
        html_row("td", "Image", dollars(base * 4), "-", dollars(base * 5)),
    )
    return extract.extract_prices(pages, ["openai"]).select("page_id", "model_id", "modality", "category", "component", "price")


@query("extract_model_type", """
  WITH p AS (SELECT p_partkey AS page_id, 'gemini-' || replace(p_name, ' ', '-') AS model_id, p_retailprice AS b FROM part),
  r AS (SELECT page_id, model_id, 'input' AS component, 'multimodal' AS modality, b AS lo, b * 2 AS hi FROM p
    UNION ALL SELECT page_id, model_id, 'output', 'text', b * 3, b * 4 FROM p)
  SELECT page_id, model_id, component, modality, 'gemini_3' AS category, 'standard' AS service_tier, '<=200k' AS context_window, lo AS price FROM r
  UNION ALL SELECT page_id, model_id, component, modality, 'gemini_3', 'standard', '>200k', hi FROM r""")
def extract_model_type(spark, d):
    base = F.col("p_retailprice")
    pages = part_pages(
        spark, d, "google", "<h2>Gemini 3</h2><button>Flex/Batch</button>",
        html_row("th", "Model", "Type", "Region", "Price (/1M tokens) &lt;= 200K input tokens", "Price (/1M tokens) &gt; 200K input tokens"),
        html_row("td", F.concat(F.lit("Gemini "), F.col("p_name")), "Input (text, image, video)", "Global", dollars(base), dollars(base * 2)),
        html_row("td", "", "", "Non-global *", "$0.01", "$0.02"),
        html_row("td", "", "Text output", "Global", dollars(base * 3), dollars(base * 4)),
    )
    return extract.extract_prices(pages, ["google"]).select(
        "page_id", "model_id", "component", "modality", "category", "service_tier", "context_window", "price"
    )


@query("extract_transposed", """
  WITH p AS (SELECT p_partkey AS page_id, 'deepseek-' || replace(p_name, ' ', '-') AS m, p_retailprice AS b FROM part),
  r AS (SELECT page_id, m || '-' || k AS model_id, b * (1 + n) AS hit, b * (2 + n) AS miss, b * (3 + n) AS o, (n + 1) || 'M' AS context_window
    FROM p, (SELECT * FROM (VALUES ('a', 0), ('b', 3), ('c', 6), ('d', 9)) t(k, n)))
  SELECT page_id, model_id, context_window, 'input' AS component, miss AS price FROM r
  UNION ALL SELECT page_id, model_id, context_window, 'cached_input', hit FROM r
  UNION ALL SELECT page_id, model_id, context_window, 'output', o FROM r WHERE NOT ends_with(model_id, '-d')""")
def extract_transposed(spark, d):
    """Four models as columns; the last has no output price, a second such table is not read."""
    base, steps = F.col("p_retailprice"), (0, 3, 6, 9)
    name = F.concat(F.lit("deepseek-"), F.translate("p_name", " ", "-"))
    values = lambda k, upto=4: [dollars(base * (k + n)) for n in steps[:upto]]
    head = html_row("th", "MODEL", *[F.concat(name, F.lit(f"-{k}")) for k in "abcd"])
    pages = part_pages(
        spark, d, "deepseek", "",
        head,
        html_row("td", "CONTEXT LENGTH", *[f"{n + 1}M" for n in steps]),
        html_row("td", "PRICING (1)", "1M INPUT TOKENS (CACHE HIT)", *values(1)),
        html_row("td", "1M INPUT TOKENS (CACHE MISS)", *values(2)),
        html_row("td", "1M OUTPUT TOKENS", *values(3, 3)),
        F.lit("</table><table>"), head,
        html_row("td", "1M INPUT TOKENS (CACHE MISS)", "$1", "$1", "$1", "$1"), html_row("td", "1M OUTPUT TOKENS", "$1", "$1", "$1", "$1"),
    )
    return extract.extract_prices(pages, ["deepseek"]).select("page_id", "model_id", "context_window", "component", "price")


PART = "p AS (SELECT p_partkey AS page_id, replace(p_name, ' ', '-') AS m, p_retailprice AS b FROM part)"


def named(prefix=""):
    return F.concat(F.lit(prefix), F.col("p_name"))


def priced(n):
    return dollars(F.col("p_retailprice") * n)


@query("extract_token_batch", f"""
  WITH {PART} SELECT page_id, 'gemini-' || m AS model_id, c AS component, t AS service_tier, 'text' AS modality, b * k AS price
  FROM p, (VALUES ('input', 'standard', 1), ('input', 'batch', 2), ('output', 'standard', 3), ('output', 'batch', 4)) x(c, t, k)""")
def extract_token_batch(spark, d):
    """Four-column token table: a banner row names the model; grounding rows are no prices."""
    pages = part_pages(
        spark, d, "google", "<h3>Token-based pricing</h3>",
        html_row("th", "Model", "Type", "Price", "Price with Batch API"),
        html_row("td", named("Gemini ")),
        html_row("td", "Input text", priced(1), priced(2)),
        html_row("td", "Grounding with search input", "$9", "$9"),
        html_row("td", "Output text", priced(3), priced(4)),
    )
    return extract.extract_prices(pages, ["google"]).select("page_id", "model_id", "component", "service_tier", "modality", "price")


@query("extract_embeddings", f"""
  WITH {PART} SELECT page_id, 'embed-' || m AS model_id, 'input' AS component, t AS service_tier, 'per_1K_tokens' AS unit, b * k AS price
  FROM p, (VALUES ('online', 1), ('batch', 2), ('online', 3)) x(t, k)""")
def extract_embeddings(spark, d):
    """Embedding tables: online and batch prices in one cell, the model filled down."""
    pages = part_pages(
        spark, d, "google", "<h3>Embeddings</h3>",
        html_row("th", "Model", "Type", "Region", "Price per 1,000 input tokens"),
        html_row("td", named("Embed "), "Input", "Global", F.concat(F.lit("Online requests: "), priced(1), F.lit(" Batch requests: "), priced(2))),
        html_row("td", "Output", "Global", "Online requests: No charge"),
        html_row("td", "Input", "Global", F.concat(F.lit("Online requests: "), priced(3))),
    )
    return extract.extract_prices(pages, ["google"]).select("page_id", "model_id", "component", "service_tier", "unit", "price")


@query("extract_contexts", f"""
  WITH {PART}, k AS (SELECT * FROM (VALUES ('short_context', 'input', 1), ('short_context', 'cached_input', 2), ('short_context', 'output', 3),
    ('long_context', 'input', 4), ('long_context', 'output', 6)) x(w, c, k))
  SELECT page_id, 'gpt-' || m AS model_id, w AS context_window, c AS component, 'flagship' AS category, 'flex' AS service_tier, b * k AS price FROM p, k
  UNION ALL SELECT page_id, 'mini-' || m, w, c, 'flagship', 'flex', b * (k + 6) FROM p, k WHERE w = 'short_context'""")
def extract_contexts(spark, d):
    """Two header rows: short and long context; a row of four cells has the short ones only."""
    pages = part_pages(
        spark, d, "openai", "<h2>Flagship models</h2><button>Standard</button><button>Flex</button>",
        html_row("th", "", "Short context", "Long context"),
        html_row("th", "Model", "Input", "Cached input", "Output", "Input", "Cached input", "Output"),
        html_row("td", named("gpt "), priced(1), priced(2), priced(3), priced(4), "-", priced(6)),
        html_row("td", named("mini "), priced(7), priced(8), priced(9)),
    )
    return extract.extract_prices(pages, ["openai"]).select(
        "page_id", "model_id", "context_window", "component", "category", "service_tier", "price")


VIDEO = ("""SELECT page_id, 'vid-' || m AS model_id, 'generation' AS component, s AS billing_variant, 'per_second' AS unit, b * k AS price
  FROM p, (VALUES ('720p', 1), ('1080p-hd', 2)) x(s, k)""", [
    ("Model", "Size", "Portrait", "Landscape", "Price per second"),
    (("vid ",), "720p", "a", "b", 1), ("1080p HD", "a", "b", 2)])
TRANSCRIPTION = ("""SELECT page_id, 'asr-' || m AS model_id, c AS component, 'speech-to-text' AS billing_variant, 'per_1M_tokens' AS unit, b * k AS price
  FROM p, (VALUES ('input', 3), ('output', 4)) x(c, k)""", [
    ("Model", "Use case", "Input", "Output", "Estimated cost"), (("asr ",), "Speech to text", 3, 4, "x")])
CATEGORY = ("""SELECT page_id, n || m AS model_id, c AS component, 'deep' AS billing_variant, 'per_1M_tokens' AS unit, b * k AS price
  FROM p, (VALUES ('one-', 'input', 5), ('one-', 'output', 6), ('two-', 'input', 7), ('two-', 'cached_input', 8), ('two-', 'output', 9)) x(n, c, k)""", [
    ("Category", "Model", "Input", "Cached input", "Output"), ("Deep", ("one ",), 5, "-", 6), (("two ",), 7, 8, 9)])
FINETUNING = ("""SELECT page_id, 'ft-' || m AS model_id, c AS component, NULL::VARCHAR AS billing_variant, u AS unit, b * k AS price
  FROM p, (VALUES ('training', 'per_hour', 10), ('input', 'per_1M_tokens', 11), ('cached_input', 'per_1M_tokens', 12), ('output', 'per_1M_tokens', 13)) x(c, u, k)""", [
    ("Model", "Training", "Input", "Cached input", "Output"), (("ft ",), 10, 11, 12, 13)])
MODALITY = ("""SELECT page_id, 'img-' || m AS model_id, c AS component, NULL::VARCHAR AS billing_variant, 'per_1M_tokens' AS unit, b * k AS price
  FROM p, (VALUES ('input', 14), ('cached_input', 15), ('output', 16)) x(c, k)""", [
    ("Model", "Modality", "Input", "Cached input", "Output / Cost"), (("img ",), "Text", 14, 15, 16)])


def laid_out(lines):
    """Rows of a table: a number is a price, a tuple a name before the part's own."""
    def show(c):
        return priced(c) if isinstance(c, int) else named(c[0]) if isinstance(c, tuple) else c

    return [html_row("td" if i else "th", *map(show, line)) for i, line in enumerate(lines)]


def five_columns(spark, d, *shapes):
    tables = [row for _, lines in shapes for row in (*laid_out(lines), F.lit("</table><table>"))]
    pages = part_pages(spark, d, "openai", "<h2>Specialized models</h2>", *tables)
    return extract.extract_prices(pages, ["openai"]).select("page_id", "model_id", "component", "billing_variant", "unit", "price")


@query("extract_video", f"WITH {PART} {VIDEO[0]}")
def extract_video(spark, d):
    return five_columns(spark, d, VIDEO)


@query("extract_transcription", f"WITH {PART} {TRANSCRIPTION[0]}")
def extract_transcription(spark, d):
    return five_columns(spark, d, TRANSCRIPTION)


@query("extract_category", f"WITH {PART} {CATEGORY[0]}")
def extract_category(spark, d):
    return five_columns(spark, d, CATEGORY)


@query("extract_finetuning", f"WITH {PART} {FINETUNING[0]}")
def extract_finetuning(spark, d):
    return five_columns(spark, d, FINETUNING)


SHAPES = (VIDEO, TRANSCRIPTION, CATEGORY, FINETUNING, MODALITY)


@query("extract_dispatch", f"WITH {PART} " + " UNION ALL ".join(sql for sql, _ in SHAPES))
def extract_dispatch(spark, d):
    """Pages of five tables of unlike shapes: each table is read by the first shape that fits."""
    return five_columns(spark, d, *SHAPES)


GROK = f"""WITH {PART}, k AS (SELECT * FROM (VALUES ('input', 1), ('cached_input', 2), ('output', 3)) x(c, k)),
  wide AS (SELECT page_id, 'grok-' || m AS model_id, '256k' AS context_window, v AS billing_variant, c AS component, b * (k + n) AS price
    FROM p, k, (VALUES ('lt-200k-prompt', 0), ('gte-200k-prompt', 3)) y(v, n))"""


@query("extract_thresholds", f"{GROK} SELECT * FROM wide")
def extract_thresholds(spark, d):
    """Two header rows with short and long context prices, six to a row."""
    pages = part_pages(
        spark, d, "xai", "",
        html_row("th", "Model", "Context", "Short context", "Long context"),
        html_row("th", "Input", "Cached", "Output", "Input", "Cached", "Output"),
        html_row("td", named("Grok "), "256k", *[priced(n) for n in range(1, 7)]),
        html_row("td", named("Other "), "256k", *[priced(n) for n in range(1, 7)]),
    )
    return extract.extract_prices(pages, ["xai"]).select("page_id", "model_id", "context_window", "billing_variant", "component", "price")


@query("extract_located", f"""
  {GROK} SELECT page_id, 'grok-mini-' || m AS model_id, '128k' AS context_window, c AS component, b * k AS price FROM p, k""")
def extract_located(spark, d):
    """The fallback: columns found by their header text, in any order."""
    pages = part_pages(
        spark, d, "xai", "",
        html_row("th", "Output / 1M tokens", "Model", "Context", "Input / 1M tokens", "Cached input / 1M tokens"),
        html_row("td", priced(3), named("Grok mini "), "128k", priced(1), priced(2)),
    )
    return extract.extract_prices(pages, ["xai"]).select("page_id", "model_id", "context_window", "component", "price")


@query("extract_scopes", f"""
  WITH {PART} SELECT page_id, 'qwen3.7-max' AS model_id, '>200k' AS context_window, c AS component, b * k AS price
  FROM p, (VALUES ('input', 1), ('output', 2)) x(c, k)""")
def extract_scopes(spark, d):
    """Scope, mode and range decide: only the preferred model's international, live, dateless row."""
    name, live = "qwen3.7-max", ("International", "Non-thinking", "0&lt;Token&le;1M")
    pages = part_pages(
        spark, d, "qwen", "",
        html_row("th", "Model ID", "Deployment scope", "Mode", "Input tokens per request", "Input price", "Output price"),
        html_row("td", name, *live, priced(1), priced(2)),
        html_row("td", name, "China", *live[1:], "$1", "$1"),
        html_row("td", name, live[0], "Batch calls", live[2], "$1", "$1"),
        html_row("td", f"{name}-2026-01-01", *live, "$1", "$1"),
        html_row("td", named("unlisted "), *live, "$1", "$1"),
    )
    return extract.extract_prices(pages, ["qwen"]).select("page_id", "model_id", "context_window", "component", "price")


@query("extract_all", f"""
  WITH {PART} SELECT page_id, 'anthropic' AS provider_id, 'claude-' || m AS model_id, c AS component, b * k AS price
  FROM p, (VALUES ('input', 1), ('output', 2)) x(c, k) WHERE page_id % 3 = 0
  UNION ALL SELECT page_id, 'openai', 'img-' || m, c, b * k FROM p, (VALUES ('input', 14), ('cached_input', 15), ('output', 16)) x(c, k) WHERE page_id % 3 = 1
  UNION ALL SELECT page_id, 'xai', 'grok-' || m, c, b * k FROM p, (VALUES ('input', 1), ('cached_input', 2), ('output', 3)) x(c, k) WHERE page_id % 3 = 2""")
def extract_all(spark, d):
    """Pages of several providers at once, each read by its own shapes."""
    kinds = {
        "anthropic": [html_row("th", "Model", "Base Input Tokens", "Output Tokens"), html_row("td", named("Claude "), priced(1), priced(2))],
        "openai": laid_out(MODALITY[1]),
        "xai": [html_row("th", "Model", "Context", "Input / 1M tokens", "Cached input / 1M tokens", "Output / 1M tokens"),
                html_row("td", named("Grok "), "128k", priced(1), priced(2), priced(3))],
    }
    pages = None
    for i, (provider, lines) in enumerate(kinds.items()):
        mine = part_pages(spark, d, provider, "", *lines).filter(F.col("page_id") % 3 == i)
        pages = mine if pages is None else pages.unionByName(mine)
    return extract.extract_prices(pages).select("page_id", "provider_id", "model_id", "component", "price")
