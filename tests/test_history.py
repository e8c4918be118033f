"""Series, changes, lifecycle, diff and as-of on small histories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricetrail import schemas
from pricetrail.functions import measures as ms
from pricetrail.operators import history as h
from pricetrail.operators import tiers


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture()
def make(spark):
    def build(schema, *dicts):
        names = schema.names
        return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], schema)

    return build


def series_row(date, **more):
    base = dict(
        date=day(date), pricing_id="p-m", provider_id="p", model_id="m", display_name="M", category="c",
        input_price=15.0, output_price=75.0, cached_input_price=1.5, currency="USD", is_active=True,
    )
    return {**base, **more}


def versions(spark, **by_date):
    return spark.createDataFrame([(day(d), v) for d, v in by_date.items()], "date date, schema_version string")


def test_retired_name_sets_deprecation_while_still_listed(spark, make, rows):
    s = make(schemas.SERIES, series_row("2026-07-24"), series_row("2026-07-30", display_name="M ( retired )"))
    v = versions(spark, **{"2026-07-24": "2.1.0", "2026-07-30": "2.1.0"})
    (m,) = rows(h.lifecycle(s, v))
    assert m["deprecated_on"] == day("2026-07-30")
    assert m["currently_active"] and m["currently_present"] and m["name_marks_deprecation"]
    assert m["last_active"] == day("2026-07-30") and m["disappeared_after"] is None


def test_lifecycle_of_gone_inactive_and_renamed_ids(spark, make, rows):
    s = make(
        schemas.SERIES,
        series_row("2026-07-01", pricing_id="gone"),
        series_row("2026-07-01", pricing_id="off"),
        series_row("2026-07-03", pricing_id="off", is_active=False, input_price=None),
        series_row("2026-07-01", pricing_id="old-only"),
        series_row("2026-07-02", pricing_id="gone"),
    )
    v = versions(spark, **{"2026-07-01": "1.9", "2026-07-02": "2.1.0", "2026-07-03": "2.1.0"})
    out = {m["pricing_id"]: m for m in rows(h.lifecycle(s, v))}
    assert set(out) == {"gone", "off"}
    assert out["gone"]["disappeared_after"] == day("2026-07-02") and not out["gone"]["currently_active"]
    assert out["off"]["last_active"] == day("2026-07-01") and out["off"]["deprecated_on"] == day("2026-07-03")
    assert out["off"]["currently_present"] and not out["off"]["currently_active"] and out["off"]["latest_input"] is None
    archive = rows(h.archive_view(h.lifecycle(s, v), F.lit("2026-07-01").cast("date")))
    assert [(a["pricing_id"], a["retired_on"], a["days_active"], a["days_floor"]) for a in archive] == [
        ("off", day("2026-07-03"), 2, True), ("gone", day("2026-07-02"), 1, True),
    ]
    assert [a["pricing_id"] for a in rows(h.archive_view(h.lifecycle(s, v), F.lit("2026-07-02").cast("date"), flagged=True))] == ["off"]


def test_lifecycle_of_an_empty_series(spark, make, rows):
    s = make(schemas.SERIES, series_row("2026-07-01")).filter("false")
    v = versions(spark, **{"2026-07-01": "2.1.0"})
    assert rows(h.lifecycle(s, v)) == []
    (i,) = rows(h.index_summary(s, v))
    assert (i["snapshot_count"], i["row_count"], i["dates"], i["first_date"]) == (0, 0, [], None)


def test_changes_skip_nulls(spark, make, rows):
    s = make(
        schemas.SERIES,
        series_row("2026-01-01", input_price=10.0, output_price=None, cached_input_price=0.0),
        series_row("2026-01-02", input_price=None, output_price=3.0, cached_input_price=0.0),
        series_row("2026-01-03", input_price=4.0, output_price=3.0, cached_input_price=2.0),
        series_row("2026-01-04", input_price=4.0, output_price=None, cached_input_price=2.0),
    )
    out = {r["field"]: r for r in rows(h.change_events(s, keep=["display_name"]))}
    assert set(out) == {"input_price", "cached_input_price"}
    e = out["input_price"]
    assert (e["prev_date"], e["date"], e["from_value"], e["to_value"], e["delta"], e["pct"]) == (
        day("2026-01-01"), day("2026-01-03"), 10.0, 4.0, -6.0, -60.0)
    assert out["cached_input_price"]["pct"] is None
    assert rows(h.changed_ids(s, "input_price")) == [{"pricing_id": "p-m"}]
    assert rows(h.changed_ids(s, "output_price")) == []


def doc_row(**more):
    base = {f: None for f in schemas.PRICING_ROW.names}
    return {**base, "pricing_id": "x", "provider_id": "p", "model_id": "m", "input_price": 1.0, "cache_read_price": 0.1, **more}


def test_normalize_both_versions(spark, rows):
    full = schemas.T.StructType([
        schemas.T.StructField("date", schemas.T.DateType()), schemas.T.StructField("schema_version", schemas.S), *schemas.PRICING_ROW.fields
    ])
    cases = [
        ("1.4", doc_row(type="chat", unit="per_1M_tokens")),
        ("1.4", doc_row(type="image", unit="per_1M_tokens")),
        ("1.4", doc_row(type="chat", unit="per_image")),
        ("2.1.0", doc_row(pricing_id="in", input_unit="per_1M_tokens", modality="audio")),
        ("2.1.0", doc_row(pricing_id="out", output_unit="per_1M_tokens", output_price=2.0, service_tier="standard", input_price=None)),
        ("2.1.0", doc_row(pricing_id="img", input_unit="per_image")),
        ("2.1.0", doc_row(pricing_id="batch", input_unit="per_1M_tokens", service_tier="batch")),
        ("2.1.0", doc_row(pricing_id="sold", provider_id="aws", display_name="Claude", input_unit="per_1M_tokens")),
        ("2.1.0", doc_row(pricing_id="own", provider_id="aws", display_name="Nova Pro", input_unit="per_1M_tokens")),
        ("2.1.0", doc_row(pricing_id="ds", provider_id="deepseek", model_id="deepseek-v4", input_unit="per_1M_tokens")),
        ("2.1.0", doc_row(pricing_id="nods", provider_id="deepseek", input_unit="per_1M_tokens")),
    ]
    data = [(day("2026-01-01"), v, *[d[n] for n in schemas.PRICING_ROW.names]) for v, d in cases]
    out = {r["pricing_id"]: r for r in rows(h.normalize_versions(spark.createDataFrame(data, full)))}
    assert set(out) == {"p-m-chat", "in", "out", "own", "ds"}
    assert out["p-m-chat"]["cached_input_price"] is None and out["p-m-chat"]["category"] == "standard_api"
    assert out["in"]["cached_input_price"] == 0.1 and out["in"]["service_tier"] == "standard"
    assert out["in"]["display_name"] == "m" and out["in"]["currency"] == "USD" and out["in"]["is_active"]


def test_epoch_filter(spark, rows):
    df = spark.createDataFrame([("2026-08-20",), ("2026-08-21",), ("",), (None,)], "date string")
    assert rows(h.from_epoch(df, "2026-08-21")) == [{"date": "2026-08-21"}]


def test_asof_and_rank(spark, rows):
    points = spark.createDataFrame([
        ("a", day("2026-04-01"), 10), ("a", day("2026-06-01"), 4), ("b", day("2026-05-01"), 8), ("c", day("2026-07-01"), 20),
    ], "pricing_id string, date date, value int")
    assert {r["pricing_id"]: r["value"] for r in rows(h.asof_value(points, "2026-05-15"))} == {"a": 10, "b": 8, "c": None}
    assert {r["pricing_id"]: r["value"] for r in rows(h.asof_value(points, "2026-06-01"))}["a"] == 4
    assert [r["pricing_id"] for r in rows(h.asof_rank(points, "2026-05-15"))] == ["a", "b", "c"]


def tier(pid, **more):
    return {"pricing_id": pid, "display_name": f"N {pid}", "currency": "USD", "is_active": True, "input_price": 1.0,
            "input_unit": "per_1M_tokens", **more}


def test_diff_and_text(spark, make, rows):
    T = schemas.TIER
    ord_ = F.lit(0)
    old = make(T, tier("same"), tier("moved"), tier("meta"), tier("gone"), tier("gone", input_price=2.0)).withColumn("ord", F.monotonically_increasing_id())
    new = make(T, tier("same"), tier("moved", input_price=3.0, output_price=5.0, output_unit="u", service_tier="batch"),
               tier("meta", currency="EUR"), tier("fresh", service_tier="std")).withColumn("ord", ord_)
    diff = h.snapshot_diff(old, new, ["ord"])
    kinds = {r["pricing_id"]: (r["kind"], r["changed_fields"]) for r in rows(diff)}
    assert kinds == {
        "moved": ("PRICE_CHANGED", ["input_price", "output_price", "output_unit"]),
        "meta": ("PRICE_CHANGED", ["currency"]), "gone": ("REMOVED_TIER", []), "fresh": ("NEW_TIER", []),
    }
    text = {r["pricing_id"]: (r["title"], r["detail"]) for r in rows(h.format_changes(diff))}
    assert text["moved"] == ("N moved | batch", "input_price: $1.0 -> $3.0 (per_1M_tokens); output_price: $None -> $5.0 (u)")
    assert text["meta"] == ("N meta", "metadata changed")
    assert text["fresh"] == ("N fresh | std", "input_price: $1.0 per_1M_tokens")
    assert text["gone"] == ("N gone", "")


def test_needs_context(spark, rows):
    df = spark.createDataFrame([
        ("o", "m", "short_context"), ("o", "m", "long_context"), ("g", "f", ">200k"), ("g", "f", None), ("g", "f", ""),
    ], "provider_id string, model_id string, context_window string")
    assert rows(h.needs_context(df)) == [{"provider_id": "o", "model_id": "m"}]


def test_pivot_unpivot_identity_and_overflow(spark, rows):
    comp = spark.createDataFrame([
        ("p", "m", "M", "input", 1.0, "u1", "std", None, 1), ("p", "m", "m2", "input", 2.0, "u2", "std", None, 5),
        ("p", "m", "M", "cache_write", 3.0, "u1", "std", "5m", 2), ("p", "m", "M", "cache_write", 4.0, "u1", "std", None, 3),
        ("p", "m", "M", "output", 9.0, "u1", "std", "v", 4),
    ], "provider_id string, model_id string, display_name string, component string, price double, unit string, "
       "service_tier string, billing_variant string, ord int")
    comp = tiers.component_rows(comp).withColumn("is_active", F.col("ord") != 3)
    out = {r["billing_variant"]: r for r in rows(tiers.component_pivot(comp, ["ord"], keep_other=True))}
    base = out[None]
    assert (base["input_price"], base["input_unit"], base["cache_write_5m_price"], base["display_name"]) == (2.0, "u2", 3.0, "M")
    assert base["is_active"] is False and base["other_prices"] == {"cache_write": 4.0} and base["cache_write_1h_price"] is None
    assert out["v"]["output_price"] == 9.0 and out["v"]["pricing_id"] == "p-m-std-v" and out["v"]["other_prices"] is None
    wide = tiers.component_pivot(comp, ["ord"])
    skus = rows(tiers.unpivot_prices(wide, tiers.SKU_TYPES, ["pricing_id"]))
    assert sorted((s["sku_type"], s["price_usd"]) for s in skus) == [
        ("cache_write_5m_tokens", 3.0), ("input_tokens", 2.0), ("output_tokens", 9.0)]


def test_unit_conversion_is_exact_and_half_up(spark, rows):
    df = spark.createDataFrame([("0.0000015", "per_1M_tokens"), ("0.0025", "per_1K_tokens"), ("3", "per_second")], "p string, unit string")
    out = rows(tiers.with_token_prices(df.withColumn("price_usd", F.col("p").cast(schemas.PRICE_DECIMAL))))
    assert [(r["price_per_1m_tokens_usd"], r["price_per_1k_tokens_usd"]) for r in out][2] == (None, None)
    assert float(out[1]["price_per_1m_tokens_usd"]) == 2.5 and float(out[1]["price_per_1k_tokens_usd"]) == 0.0025
    assert float(out[0]["price_per_1k_tokens_usd"]) == 0.0


def test_sort_treats_null_as_empty(spark, rows):
    df = spark.createDataFrame([("b", "x", None), ("a", "Z", "t"), ("a", "y", "t"), ("a", "y", None)], "provider_id string, display_name string, service_tier string")
    out = rows(tiers.sort_rows(df, ["provider_id", "display_name", "service_tier"]))
    assert [(r["provider_id"], r["display_name"], r["service_tier"]) for r in out] == [
        ("a", "y", None), ("a", "y", "t"), ("a", "Z", "t"), ("b", "x", None)]


def test_best_by_score_first_wins_ties(spark, rows):
    df = spark.createDataFrame([
        ("p", "m", 0, True, None, 1.0), ("p", "m", 1, True, 1.0, None), ("p", "m", 2, False, 1.0, 2.0), ("p", "n", 3, None, None, None),
    ], "provider_id string, model_id string, ord int, is_active boolean, input_price double, output_price double")
    out = {r["model_id"]: r["ord"] for r in rows(tiers.best_by_score(df, ["provider_id", "model_id"], "ord"))}
    assert out == {"m": 0, "n": 3}


def test_events_and_models_in_order(spark, rows):
    kind = "date date, provider_id string, model_id string, display_name string, pricing_id string, field string"
    day = [dt.date(2026, 1, d) for d in (1, 2)]
    events = spark.createDataFrame(
        [(day[0], "a", "m", "x", "1", "f"), (day[1], "b", "m", "x", "2", "f"), (day[1], None, "z", "x", "4", "f"), (day[1], "b", "l", "x", "3", "f")], kind)
    assert [r["pricing_id"] for r in rows(h.newest_first(events).orderBy("position"))] == ["4", "3", "2", "1"]
    assert [r["pricing_id"] for r in rows(h.by_model(events).orderBy("position"))] == ["4", "1", "3", "2"]


def test_percent_is_rounded_as_a_number_of_fifteen_decimals(spark, rows):
    import duckdb

    # 52.33 of 20 is the double next to 261.65, a little under it; the rest are halves, tiny and huge shares.
    pairs = [(20.0, 72.33), (4.0, 5.01), (8.0, 7.99), (16.0, 3.3), (0.0, 1.0), (3.0, 3.0), (2000.0, 2001.0), (1e-20, 5.0), (7.0, 1e15)]
    pairs += [(a / 100, b / 100) for a in (1600, 2000, 4000, 8000) for b in range(1, 9000, 7)]
    found = spark.createDataFrame(pairs, "a double, b double").select("a", "b", ms.percent(F.col("b") - F.col("a"), F.col("a")).alias("pct"))
    con = duckdb.connect()
    want = con.execute(
        "SELECT round(((b - a) / nullif(a, 0) * 100)::DECIMAL(38, 15), 1)::DOUBLE FROM (SELECT unnest(?) AS a, unnest(?) AS b)",
        [[a for a, _ in pairs], [b for _, b in pairs]]).fetchall()
    assert [r["pct"] for r in rows(found)] == [w for w, in want] and rows(found)[0]["pct"] == 261.6
    # Beyond the range of that type.
    assert rows(spark.createDataFrame([(1e-9, 1e30)], "a double, b double").select(ms.percent(F.col("b"), F.col("a")).alias("p"))) == [{"p": 1e41}]
