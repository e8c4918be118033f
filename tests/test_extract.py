"""Page parsing and shape rules on small pages."""

import json

import pytest

from pyspark.sql import functions as F

from pricetrail.operators import extract
from pricetrail.operators.tiers import component_pivot, dedupe_last_wins
from pricetrail.sources.html import page_blocks


def table(*rows):
    head = "".join(f"<th>{c}</th>" for c in rows[0])
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows[1:])
    return f"<table><tr>{head}</tr>{body}</table>"


@pytest.fixture()
def prices(spark, rows):
    def run(provider, html):
        pages = spark.createDataFrame([(1, provider, html)], "page_id long, provider_id string, html string")
        return rows(extract.extract_prices(pages, [provider]).orderBy(*extract.ARRIVAL))

    return run


def test_blocks_of_broken_and_nested_html():
    html = (
        "<body><h2>One &amp; two</h2><script>var x='<h1>no</h1>'</script><p>txt<br>more"
        "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td> </td></tr><tr><td></td></tr></table>"
    )
    blocks = page_blocks(html)
    assert [b[3] for b in blocks if b[1] == "heading"] == ["One & two"]
    found = {(b[4], b[5]): b[6] for b in blocks if b[1] == "row"}
    assert found == {(0, 0): ["a in", "in", ""], (0, 1): ["in"], (1, 0): ["in"]}
    assert page_blocks("") == [] and page_blocks(None) == []


def test_long_cells_keep_their_whole_text():
    long = "word " * 500
    row = next(b for b in page_blocks(f"<table><tr><td>{long}</td></tr></table>") if b[1] == "row")
    assert row[6] == [long.strip()]


def test_base_and_cache_columns(prices):
    out = prices("anthropic", table(
        ["Model", "Base Input Tokens", "5m Cache Writes", "1h Cache Writes", "Cache Hits", "Output Tokens"],
        ["Claude Big 5 (deprecated)", "$5 / MTok", "$6.25", "$10", "$0.50", "$25"],
        ["Other", "$1", "$1", "$1", "$1", "$1"],
    ))
    assert [(r["component"], r["billing_variant"], r["price"]) for r in out] == [
        ("input", None, 5.0), ("output", None, 25.0), ("cache_write", "5m", 6.25), ("cache_write", "1h", 10.0), ("cache_read", None, 0.5),
    ]
    assert {r["is_active"] for r in out} == {False}
    assert out[0]["pricing_id"] == "anthropic-claude-big-5-deprecated-input-standardapi-per1mtokens"


def test_model_type_table_skips_other_regions(prices):
    out = prices("google", "<h2>Gemini 3</h2><button>Flex/Batch</button>" + table(
        ["Model", "Type", "Region", "Price (/1M tokens) &lt;= 200K input tokens", "Price (/1M tokens) &gt; 200K input tokens"],
        ["Gemini 3 Swift", "Input (text, image)", "Global", "$1.50", "$1.70"],
        ["", "", "Non-global *", "$1.65", "$1.65"],
        ["", "Text output", "Global", "$9.00", "$9.50"],
        ["", "Image output $/image", "Global", "$7.00", "$7.50"],
    ))
    assert [(r["component"], r["modality"], r["context_window"], r["price"]) for r in out] == [
        ("input", "multimodal", "<=200k", 1.5), ("input", "multimodal", ">200k", 1.7),
        ("output", "text", "<=200k", 9.0), ("output", "text", ">200k", 9.5),
    ]
    assert {(r["service_tier"], r["category"]) for r in out} == {("standard", "gemini_3")}


def test_tier_comes_from_headers_and_old_shape_is_shifted(prices):
    out = prices("google", "<h2>Gemini 2.5</h2>" + table(
        ["Model", "Type", "Price (/1M tokens) with Priority", "Price with Batch API"],
        ["Gemini 2.5 Max"],
        ["Input text", "$2", "$1"],
        ["Output text", "$4", "$3"],
    ))
    assert [(r["display_name"], r["component"], r["service_tier"], r["price"]) for r in out] == [
        ("Gemini 2.5 Max", "input", "priority", 2.0), ("Gemini 2.5 Max", "input", "batch", 1.0),
        ("Gemini 2.5 Max", "output", "priority", 4.0), ("Gemini 2.5 Max", "output", "batch", 3.0),
    ]


def test_token_and_embedding_tables(prices):
    token = "<h3>Token-based pricing</h3>" + table(
        ["Model", "Type", "Price", "Price with Batch API"],
        ["Gemini 2.0 Quick"],
        ["Input text", "$0.10", "$0.05"],
        ["Grounding with search input", "$9", "$9"],
        ["Tuning", "$3", ""],
    )
    embed = "<h3>Embeddings</h3>" + table(
        ["Model", "Type", "Region", "Price per 1,000 input tokens"],
        ["Embed A", "Input", "Global", "Online requests: $0.5 Batch requests: $0.4"],
        ["Output", "Global", "Online requests: No charge"],
        ["Input", "Global", "Online requests: $0.7"],
    )
    hidden = "<h3>Modality-based pricing</h3>" + table(["Model", "Type", "Price", "Price with Batch API"], ["Gemini x"], ["Input", "$1", "$1"])
    out = prices("google", token + embed + hidden)
    assert [(r["display_name"], r["component"], r["unit"], r["service_tier"], r["price"]) for r in out] == [
        ("Gemini 2.0 Quick", "input", "per_1M_tokens", "standard", 0.1),
        ("Gemini 2.0 Quick", "input", "per_1M_tokens", "batch", 0.05),
        ("Gemini 2.0 Quick", "training", "per_1M_tokens", "standard", 3.0),
        ("Embed A", "input", "per_1K_tokens", "online", 0.5),
        ("Embed A", "input", "per_1K_tokens", "batch", 0.4),
        ("Embed A", "input", "per_1K_tokens", "online", 0.7),
    ]


def test_short_and_long_context(prices):
    html = "<h2>Flagship models</h2><button>Standard</button><button>Flex</button>" + table(
        ["", "Short context", "Long context"],
        ["Model", "Input", "Cached input", "Output", "Input", "Cached input", "Output"],
        ["gpt-x", "$1", "$0.1", "$8", "$2", "-", "$9"],
        ["gpt-y", "$3", "-", "$6"],
    )
    out = prices("openai", html)
    assert [(r["model_id"], r["component"], r["context_window"], r["price"]) for r in out] == [
        ("gpt-x", "input", "short_context", 1.0), ("gpt-x", "cached_input", "short_context", 0.1), ("gpt-x", "output", "short_context", 8.0),
        ("gpt-x", "input", "long_context", 2.0), ("gpt-x", "output", "long_context", 9.0),
        ("gpt-y", "input", "short_context", 3.0), ("gpt-y", "output", "short_context", 6.0),
    ]
    assert {(r["category"], r["service_tier"]) for r in out} == {("flagship", "flex")}


@pytest.mark.parametrize(("rows_", "want"), [
    ([["Model", "Modality", "Input", "Cached input", "Output / Cost"], ["img", "Text", "$1", "$2", "$3"], ["Image", "$4", "-", "$5"]],
     [("img", "input", "text", None, 1.0), ("img", "cached_input", "text", None, 2.0), ("img", "output", "text", None, 3.0),
      ("img", "input", "image", None, 4.0), ("img", "output", "image", None, 5.0)]),
    ([["Model", "Size", "Portrait", "Landscape", "Price per second"], ["vid", "720p", "a", "b", "$0.10"], ["1080p HD", "a", "b", "$0.30"]],
     [("vid", "generation", "video", "720p", 0.1), ("vid", "generation", "video", "1080p-hd", 0.3)]),
    ([["Model", "Use case", "Input", "Output", "Estimated cost"], ["asr", "Speech to text", "$2", "$4", "x"]],
     [("asr", "input", None, "speech-to-text", 2.0), ("asr", "output", None, "speech-to-text", 4.0)]),
    ([["Category", "Model", "Input", "Cached input", "Output"], ["Deep", "d1", "$1", "-", "$2"], ["d2", "$3", "$4", "$5"]],
     [("d1", "input", None, "deep", 1.0), ("d1", "output", None, "deep", 2.0), ("d2", "input", None, "deep", 3.0),
      ("d2", "cached_input", None, "deep", 4.0), ("d2", "output", None, "deep", 5.0)]),
    ([["Model", "Training", "Input", "Cached input", "Output"], ["ft", "$25 / hour", "$1", "$2", "$3"]],
     [("ft", "training", None, None, 25.0), ("ft", "input", None, None, 1.0), ("ft", "cached_input", None, None, 2.0), ("ft", "output", None, None, 3.0)]),
])
def test_five_column_shapes(prices, rows_, want):
    out = prices("openai", "<h2>Specialized models</h2>" + table(*rows_))
    assert [(r["model_id"], r["component"], r["modality"], r["billing_variant"], r["price"]) for r in out] == want
    assert {r["category"] for r in out} == {"specialized"}


def test_short_rows_before_any_full_row(prices):
    out = prices("openai", table(
        ["Category", "Model", "Input", "Cached input", "Output"],
        ["m0", "$1", "$2", "$3"], ["m1", "$4", "$5", "$6"], ["c", "m2", "$7", "$8", "$9"],
    ))
    # The first short row is left alone (too short to read); its first cell is then repeated.
    assert [(r["model_id"], r["billing_variant"]) for r in out if r["component"] == "input"] == [("m1", "m0"), ("m2", "c")]


def test_header_located_columns_and_thresholds(prices):
    out = prices("xai", table(
        ["Model", "Context", "Input / 1M tokens", "Cached input / 1M tokens", "Output / 1M tokens"],
        ["grok-9 (&lt; 200k prompt tokens)", "500k", "$2.00", "$0.50", "$6.00"],
        ["other", "1k", "$1", "$1", "$1"],
    ))
    assert [(r["component"], r["price"], r["billing_variant"], r["model_id"], r["context_window"]) for r in out] == [
        ("input", 2.0, "lt-200k-prompt", "grok-9", "500k"), ("cached_input", 0.5, "lt-200k-prompt", "grok-9", "500k"),
        ("output", 6.0, "lt-200k-prompt", "grok-9", "500k"),
    ]


def test_two_header_rows(prices):
    out = prices("xai", table(
        ["Model", "Context", "Short context", "Long context"],
        ["Input", "Cached", "Output", "Input", "Cached", "Output"],
        ["grok-9 Long context over 200k", "2M", "$1", "$2", "$3", "$4", "$5", "$6"],
    ))
    assert [(r["model_id"], r["billing_variant"], r["price"]) for r in out] == [
        ("grok-9", "lt-200k-prompt", 1.0), ("grok-9", "lt-200k-prompt", 2.0), ("grok-9", "lt-200k-prompt", 3.0),
        ("grok-9", "gte-200k-prompt", 4.0), ("grok-9", "gte-200k-prompt", 5.0), ("grok-9", "gte-200k-prompt", 6.0),
    ]


def transposed(a, b):
    return table(
        ["MODEL", a, b],
        ["CONTEXT LENGTH", "1M", "2M"],
        ["PRICING (1)", "1M INPUT TOKENS (CACHE HIT)", "$0.0028", "$0.003625"],
        ["1M INPUT TOKENS (CACHE MISS)", "$0.14", "$0.435"],
        ["1M OUTPUT TOKENS", "$0.28", "$0.87"],
    )


def test_models_as_columns(prices):
    out = prices("deepseek", transposed("gpt-5", "claude") + transposed("deepseek-a", "deepseek-b (deprecated)") + transposed("deepseek-c", "deepseek-d"))
    assert [(r["model_id"], r["component"], r["price"], r["context_window"], r["is_active"]) for r in out] == [
        ("deepseek-a", "input", 0.14, "1M", True), ("deepseek-a", "cached_input", 0.0028, "1M", True), ("deepseek-a", "output", 0.28, "1M", True),
        ("deepseek-b-deprecated", "input", 0.435, "2M", False), ("deepseek-b-deprecated", "cached_input", 0.003625, "2M", False),
        ("deepseek-b-deprecated", "output", 0.87, "2M", False),
    ]


def test_models_of_others_give_nothing(prices):
    assert prices("deepseek", transposed("claude-x", "gpt-5")) == []


def test_scope_mode_and_range(prices):
    out = prices("qwen", table(
        ["Model ID", "Deployment scope", "Mode", "Input tokens per request", "Input price (per 1M)", "Output price (per 1M)"],
        ["qwen3.7-max Currently equivalent to qwen3.7-max-2026-05-20", "International", "All", "0&lt;Token≤1M", "List price $2.5 now", "$7.5"],
        ["qwen3.7-plus", "International", "All", "0&lt;Token≤256K", "$0.48", "$1.92"],
        ["qwen3.7-plus", "International", "All", "256K&lt;Token≤1M", "$5", "$6"],
        ["qwen-flash", "International", "Batch", "0&lt;Token≤256K", "$1", "$1"],
        ["qwen-flash", "International", "One", "0&lt;Token≤256K", "$0.05", "$0.4"],
        ["qwen3.7-max-2026-06-08", "International", "All", "0&lt;Token≤1M", "$2.5", "$7.5"],
        ["qwen3.7-max", "Chinese mainland", "All", "0&lt;Token≤1M", "$1.65", "$4.9"],
        ["qwen-flash", "International", "One", "0&lt;Token≤256K", "free", "$0.4"],
        ["other", "International", "One", "", "$1", "$2"],
    ))
    # A plus row above 256k still names 256k as its lower bound, so it stays.
    assert [(r["model_id"], r["component"], r["price"], r["context_window"]) for r in out] == [
        ("qwen3.7-max", "input", 2.5, ">200k"), ("qwen3.7-max", "output", 7.5, ">200k"),
        ("qwen3.7-plus", "input", 0.48, ">200k"), ("qwen3.7-plus", "output", 1.92, ">200k"),
        ("qwen3.7-plus", "input", 5.0, ">200k"), ("qwen3.7-plus", "output", 6.0, ">200k"),
        ("qwen-flash", "input", 0.05, None), ("qwen-flash", "output", 0.4, None),
    ]


def test_native_catalog(spark, rows):
    def product(usage, model=None):
        return {"attributes": {"usagetype": usage, **({"model": model} if model else {})}}

    def term(usd, unit="1K tokens"):
        return {"o": {"priceDimensions": {"d": {"unit": unit, "pricePerUnit": {"USD": usd}}}}}

    products = {
        "IN": product("USE1-NovaPro-input-tokens", "Nova Pro"),
        "OUT": product("USE1-NovaPro-output-tokens", "Nova Pro"),
        "READ": product("USE1-NovaPro-cache-read-input-token-count", "Nova Pro"),
        "BATCH": product("USE1-NovaPro-input-tokens-batch", "Nova Pro"),
        "TITAN": product("USE1-TitanTextG1-Lite-input-tokens"),
        "SOLD": product("USE1-ClaudeSonnet-input-tokens", "Claude Sonnet"),
        "HOUR": product("USE1-NovaLite-input-tokens", "Nova Lite"),
    }
    terms = {"OnDemand": {
        "IN": term("0.0008000000"), "OUT": term("0.0032"), "READ": term("0.0002"), "BATCH": term("0.0004"),
        "TITAN": term("0.00015"), "SOLD": term("0.003"), "HOUR": term("1", "Hours"), "GONE": term("1"),
    }}
    frame = lambda doc: spark.createDataFrame([(json.dumps(doc),)], "payload string")
    out = rows(extract.catalog_prices(frame(products), frame(terms)).orderBy("sku"))
    assert [(r["sku"], r["model_id"], r["component"], r["price"]) for r in out] == [
        ("IN", "nova-pro", "input", 0.8), ("OUT", "nova-pro", "output", 3.2),
        ("READ", "nova-pro", "cached_input", 0.2), ("TITAN", "titan-text-g1-lite", "input", 0.15),
    ]
    assert {(r["provider_id"], r["unit"], r["service_tier"], r["category"]) for r in out} == {("aws", "per_1M_tokens", "standard", "bedrock")}


def test_pages_to_tiers(spark, rows):
    pages = spark.createDataFrame([
        (1, "anthropic", table(["Model", "Base Input", "Output"], ["Claude A", "$1", "$2"], ["Claude A", "$3", "-"])),
        (2, "qwen", "<p>nothing</p>"),
    ], "page_id long, provider_id string, html string")
    found = dedupe_last_wins(extract.extract_prices(pages), extract.ARRIVAL)
    tiers = rows(component_pivot(found, extract.ARRIVAL))
    assert [(t["input_price"], t["output_price"], t["input_unit"]) for t in tiers] == [(3.0, 2.0, "per_1M_tokens")]


def test_transposed_table_of_four_models(prices):
    """Any number of columns; a model without a value has no price; a later table is not read."""
    names = [f"deepseek-{k}" for k in "wxyz"]
    shape = [["MODEL", *names], ["CONTEXT LENGTH", "1K", "2K", "3K", "4K"], ["PRICING (1)", "INPUT (CACHE HIT)", "$1", "$2", "$3", "$4"],
             ["INPUT (CACHE MISS)", "$5", "$6", "$7", "$8"], ["OUTPUT", "$9", "$10", "$11"]]
    out = prices("deepseek", table(["Other"], ["x"]) + table(*shape) + table(["MODEL", "deepseek-q", "deepseek-r"], ["INPUT (CACHE MISS)", "$1", "$1"], ["OUTPUT", "$1", "$1"]))
    got = {(r["model_id"], r["component"]): (r["price"], r["context_window"]) for r in out}
    assert len(out) == len(got) == 11
    assert got[("deepseek-z", "input")] == (8.0, "4K") and got[("deepseek-z", "cached_input")] == (4.0, "4K")
    assert ("deepseek-z", "output") not in got and got[("deepseek-y", "output")] == (11.0, "3K")


def test_no_shuffle_from_pages_to_prices(spark):
    pages = spark.createDataFrame([(1, "x", "<table></table>")], "page_id long, provider_id string, html string")
    for provider in extract.PROVIDER_RULES:
        plan = extract.extract_prices(pages, [provider])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan, provider


def test_carried_values(spark):
    from pyspark.sql import functions as F

    cases = [[], [None], ["a"], [None, "a", None, None, "b", "", None], [None, None]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v array<string>")
    got = {r["i"]: (r["c"], r["b"]) for r in df.select("i", extract.carried(F.col("v")).alias("c"), extract.before(F.col("v")).alias("b")).collect()}
    assert got[0][0] == [] and got[1][0] == [None] and got[2][0] == ["a"] and got[4][0] == [None, None]
    assert got[3] == ([None, "a", "a", "a", "b", "", ""], [None, None, "a", None, None, "b", ""])


def test_a_table_of_many_rows_is_carried_in_one_pass(prices):
    """Fill-down over 20,000 rows costs no more than the rows."""
    body = [["Deep", "d0", "$1", "-", "$2"]] + [[f"d{i}", "$3", "$4", "$5"] for i in range(1, 20_000)]
    out = prices("openai", "<h2>Specialized models</h2>" + table(["Category", "Model", "Input", "Cached input", "Output"], *body))
    assert len(out) == 2 + 3 * 19_999 and {r["billing_variant"] for r in out} == {"deep"}


def test_plain_tags_are_read_as_the_library_reads_them(monkeypatch):
    import random
    from html.parser import HTMLParser

    from pricetrail.sources import html as h

    class Slow(h.PageBlocks):
        parse_starttag, parse_endtag = HTMLParser.parse_starttag, HTMLParser.parse_endtag

    def slow(text):
        parser = Slow()
        parser.feed(text)
        parser.close()
        return list(parser.blocks())

    parts = [
        *"<p> </p> <table> </table> <tr> </tr> <td> </td> </TD> <br> <br/> <h2> </h2> <b> </b> <title> </title> <script> </script>".split(),
        *"<style> </style> <template> </template> <p/> <textarea> </textarea> < b </ <1 & é &#65; &lt;x&gt; <a b=\" <iframe> </iframe> <svg/>".split(),
        "<div class='a'>", '<a href="x" id="y">', '<td a="<b>">', "<td\n>", "</p x>", "<!-- <p> -->", "<?pi?>", "<![CDATA[x]]>", "a  &amp; b", "text", "\n", '<td b="c"\td="e">',
    ]
    draw = random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 25)))
        assert h.page_blocks(text) == slow(text), text

    # Plain pages are read in runs, not tag by tag.
    calls = []
    read = HTMLParser.parse_starttag
    monkeypatch.setattr(HTMLParser, "parse_starttag", lambda self, i: calls.append(i) or read(self, i))
    page = '<html><body class="c"><table>' + "<tr><td>x</td><td>1</td></tr>" * 50 + "</table></body></html>"
    assert len(h.page_blocks(page)) == 150 and calls == []


def test_tasks_of_page_queries_do_not_grow_with_the_table(spark):
    from pricetrail.plans import pages

    cores = spark.sparkContext.defaultParallelism
    few, many = (pages.spread(spark.range(n).withColumnRenamed("id", "p_partkey")) for n in (10, 30 * pages.PAGES_PER_TASK))
    assert few.rdd.getNumPartitions() == cores and many.rdd.getNumPartitions() == 30
    sizes = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30 * pages.PAGES_PER_TASK and max(sizes) < 1.1 * pages.PAGES_PER_TASK
