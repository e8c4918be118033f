"""Text, price and JSON expressions on single values."""

import pytest
from pyspark.sql import functions as F

from pricetrail.functions import measures as ms
from pricetrail.functions import nested
from pricetrail.functions import text as tx
from pricetrail.operators import panel


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def s(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize(("raw", "want"), [
    ("$1,234.50", 1234.5), ("-1.5", -1.5), ("$-3", None), ("0", 0.0), ("$0", 0.0), ("", None), (None, None),
    ("List price $2.5 now", 2.5), ("1.5\n", None), ("free", None), ("12", 12.0), ("1.", None), ("$.5", None),
])
def test_money(spark, raw, want):
    assert value(spark, tx.money(s(raw))) == want


def test_money_number_zero_is_no_price(spark):
    assert value(spark, tx.money_number(F.lit(0))) is None
    assert value(spark, tx.money_number(F.lit(-2))) == -2.0


def test_first_price(spark):
    assert value(spark, tx.first_price(F.array(s("n/a"), s(None), s("$3"), s("$4")))) == 3.0
    assert value(spark, tx.first_price(F.array(s("n/a")))) is None


@pytest.mark.parametrize(("raw", "want"), [
    ("  A—b  <=200k _x_ é– ", "a-b-200k-x"), (None, ""), ("--a--b--", "a-b"), ("Gemini_2_5", "gemini25"),
    ("  x y ", "x-y"),
])
def test_slugify(spark, raw, want):
    assert value(spark, tx.slugify(s(raw))) == want


def test_context_windows_collide_unless_strict(spark):
    base = {"provider_id": "p", "model_id": "m", "service_tier": None, "modality": None, "category": None,
            "billing_variant": None}
    df = spark.createDataFrame(
        [{**base, "context_window": c} for c in ("<=200k", ">200k")],
        "provider_id string, model_id string, service_tier string, context_window string, modality string, "
        "category string, billing_variant string",
    )
    assert df.select(tx.tier_id().alias("i")).distinct().count() == 1
    assert {r.i for r in df.select(tx.tier_id(True).alias("i")).collect()} == {"p-m-lte-200k", "p-m-gt-200k"}


@pytest.mark.parametrize(("label", "want"), [
    ("Text, image", "multimodal"), ("AUDIO in", "audio"), ("image", "image"), ("Video", "video"), ("text", "text"), ("x", None),
])
def test_infer_modality(spark, label, want):
    assert value(spark, tx.infer_modality(s(label))) == want


@pytest.mark.parametrize(("name", "want"), [
    ("Claude Sonnet 5 starting September 1, 2026", "Claude Sonnet 5"),
    ("Claude Sonnet 5 through August 31, 2026", "Claude Sonnet 5"),
    ("Opus 4 (retired, except elsewhere)", "Opus 4 (retired, except elsewhere)"),
    (None, ""),
])
def test_scrub_name(spark, name, want):
    assert value(spark, tx.scrub_name(s(name))) == want


def test_future_placeholder(spark):
    assert value(spark, tx.future_placeholder(s("m-starting-september-1"), s("x"))) is True
    assert value(spark, tx.future_placeholder(s("m"), s("X Starting May 3, 2026"))) is True
    assert value(spark, tx.future_placeholder(s("m-through-august"), s("X through August 31, 2026"))) is False
    assert value(spark, tx.future_placeholder(s(None), s(None))) is False


@pytest.mark.parametrize(("modality", "context", "show", "want"), [
    ("audio", ">200k", False, "Flash (audio)"), (None, "short_context", True, "Flash (short context)"),
    (None, "short_context", False, "Flash"), ("audio", "long_context", True, "Flash (audio, long context)"), (None, None, True, "Flash"),
])
def test_legend_label(spark, modality, context, show, want):
    assert value(spark, tx.legend_label(s("Flash"), s(modality), s(context), F.lit(show))) == want


@pytest.mark.parametrize(("message", "want"), [
    ("KeyError: 'unit'", ("KeyError:unit", "parse")), ("Sanity check FAILED:\n- x", ("SanityCheckFailed", "parse")),
    ("HTTP 401 from x", ("AuthError", "auth")), ("429 slow down", ("RateLimit", "rate_limit")),
    ("it timed out", ("Timeout", "timeout")), ("Failed after 3 attempts: y", ("NetworkRetryExhausted", "network")),
    ("  odd  thing!\nsecond", ("odd_thing", "unknown")), (None, ("UnknownError", "unknown")),
])
def test_classify_error(spark, message, want):
    a, b = tx.classify_error(s(message))
    assert (value(spark, a), value(spark, b)) == want


def test_classify_error_short_form(spark):
    a, b = tx.classify_error(s("HTTP 401 from x"), short=True)
    assert (value(spark, a), value(spark, b)) == ("HTTP_401_from_x", "unknown")


@pytest.mark.parametrize(("status", "body", "want"), [
    (404, "not found", True), (403, "denied", True), (400, "Access denied. This Model is marked as Legacy", True),
    (400, "The provided model identifier is invalid.", True),
    (400, "Unsupported parameter: 'max_tokens' is not supported with this model.", False), (None, "x", False), (500, "model invalid", False),
])
def test_model_unavailable(spark, status, body, want):
    assert value(spark, tx.model_unavailable(F.lit(status).cast("int"), s(body))) is want


def test_labels_and_names(spark):
    assert value(spark, tx.threshold_variant(s("grok-4.6 (< 200k prompt tokens)"))) == "lt-200k-prompt"
    assert value(spark, tx.threshold_variant(s("grok (≥200K prompt tokens)"))) == "gte-200k-prompt"
    assert value(spark, tx.threshold_variant(s("grok"))) is None
    assert value(spark, tx.threshold_base(s("grok-4.6 (< 200k prompt tokens)"))) == "grok-4.6"
    assert value(spark, tx.camel_split(s("TitanTextG1-Lite"))) == "Titan Text G1 Lite"
    assert value(spark, tx.usage_model_name(s(None), s("USE1-TitanText-Premier-input-tokens"))) == "Titan Text Premier"
    assert value(spark, tx.usage_model_name(s(" Nova  Pro "), s("x"))) == "Nova Pro"
    assert value(spark, tx.redact(s("GET /x?key=abc&y=1 key=zz"))) == "GET /x?key=[REDACTED]&y=1 key=[REDACTED]"
    assert value(spark, tx.describe_row(s("M"), s("std"), s(None), s(""), s("v"))) == "M | std | v"
    assert value(spark, tx.tier_of_headers(F.array(s("Model"), s("Price with Flex")))) == "flexbatch"
    assert value(spark, tx.context_of_header(s("Price =< 200K"))) == "<=200k"


def test_url_cleanup(spark):
    def clean(u):
        return value(spark, tx.url_without_param(s(u), "channel_binding", ("sslmode", "require"), ("postgres", "postgresql")))

    assert clean(' "postgres://u:p@h/db?channel_binding=require&a=1" ') == "postgresql://u:p@h/db?a=1&sslmode=require"
    assert clean("postgresql://h/db?sslmode=disable") == "postgresql://h/db?sslmode=disable"
    assert clean("postgresql://h/db") == "postgresql://h/db?sslmode=require"
    assert clean("mysql://h/db?channel_binding=x") == "mysql://h/db?channel_binding=x"


def test_text_sizes(spark):
    sizes = tx.text_sizes(s("héllo  wörld\n"))
    assert [value(spark, c) for c in sizes.values()] == [13, 15, 2]


def test_measures(spark):
    assert value(spark, ms.density(F.lit(200), F.lit(1000))) == 200.0
    assert value(spark, ms.density(F.lit(200), F.lit(0))) is None
    assert value(spark, ms.usd_value(F.lit(1_000_000), F.lit(2_000_000), F.lit(3.0), F.lit(4.0))) == 11.0
    assert value(spark, ms.implied_per_million(F.lit(0), F.lit(0), F.lit(1.0))) is None
    assert value(spark, ms.hit_cap(F.lit(400), F.lit(400))) is True
    assert value(spark, ms.hit_cap(F.lit(None).cast("int"), F.lit(400))) is False
    assert value(spark, ms.clamp(F.lit(14), 1, 10)) == 10
    assert value(spark, ms.or_else(s(""), s("w"))) == "w"
    day = lambda d: F.lit(d).cast("date")
    assert value(spark, ms.days_between(day("2024-01-05"), day("2024-01-01"))) == 0
    assert value(spark, ms.days_between(day(None), day("2024-01-01"))) is None
    assert value(spark, ms.parse_scraped_at(s("2024-01-05T00:00:00Z"))).isoformat().startswith("2024-01-05")
    assert value(spark, ms.parse_scraped_at(s(None))) is not None


def test_json_rows_and_fields(spark):
    kind = "struct<a: int>"
    assert value(spark, nested.rows_of_json(s('[{"a": 1}]'), kind))[0].a == 1
    assert value(spark, nested.rows_of_json(s('{"rows": [{"a": 2}]}'), kind))[0].a == 2
    assert value(spark, nested.try_field(s('{"run_id": "r"}'), "$.run_id")) == "r"
    assert value(spark, nested.try_field(s('{"run_id"'), "$.run_id")) is None


def test_messages(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, "user", None, "hi"), (1, 1, "assistant", "yo", "old"), (2, 0, None, None, None)],
        "conv_id int, turn int, role string, content string, text string",
    )
    out = rows(nested.with_nudge(nested.message_rows(df, ["conv_id"], "turn"), ["conv_id"], "turn").orderBy("conv_id", "turn"))
    assert [(r["role"], r["content"]) for r in out] == [("user", "hi"), ("assistant", "yo"), ("user", "."), ("user", "")]
    shape = value(spark, nested.nested_parts(s("assistant"), s("x")))
    assert (shape.role, shape.parts[0].text) == ("model", "x")
    assert value(spark, nested.nested_content(s("user"), s("x"))).content[0].text == "x"


def test_dictionaries_and_lists(spark):
    assert value(spark, panel.dict_lookup(s("a"), {"a": "b"})) == "b"
    assert value(spark, panel.dict_lookup(s("z"), {"a": "b"})) == "z"
    assert value(spark, panel.ordered_distinct(F.array(s("b"), s("a")), F.array(s("a"), s("c")))) == ["b", "a", "c"]
    assert value(spark, nested.map_get(F.create_map(s("k"), s("v")), s("q"))) == ""
