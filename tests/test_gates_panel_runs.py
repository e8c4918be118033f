"""Gates, health, panel selection, runs and usage on small tables."""

import pytest
from pyspark.sql import functions as F

from pricetrail import schemas
from pricetrail.operators import gates, panel, runs, usage


def counts(spark, **n):
    data = [(p, f"{p}-{i}") for p, k in n.items() for i in range(k)]
    return spark.createDataFrame(data, "provider_id string, pricing_id string")


def test_collapse_is_flagged_and_carried_forward(spark, rows):
    old, new = counts(spark, anthropic=15, google=60, openai=40), counts(spark, anthropic=15, google=5, openai=40)
    issues = {(r["scope"], r["rule"]) for r in rows(gates.sanity_issues(new, old, "2.1.0"))}
    assert {("total", "total_floor"), ("google", "provider_floor"), ("google", "provider_ratio"), ("xai", "provider_floor")} <= issues
    assert ("anthropic", "provider_floor") not in issues and ("total", "total_ratio") not in issues
    merged = gates.carry_forward(new, old, "2.1.0")
    got = {r["provider_id"]: (r["n"], r["c"]) for r in rows(merged.groupBy("provider_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("carried").alias("c")))}
    assert got == {"anthropic": (15, False), "google": (60, True), "openai": (40, False)}
    assert gates.carry_forward(new, old, "1.0").filter("carried").count() == 0
    left = gates.sanity_issues(merged, old, "2.1.0")
    assert ("google", "provider_floor") not in {(r["scope"], r["rule"]) for r in rows(left)}


def test_sanity_text_and_version_rule(spark, rows):
    old, new = counts(spark, google=200), counts(spark, google=60)
    detail = {r["rule"]: r["detail"] for r in rows(gates.sanity_issues(new, old, "2.1.0", {"google": 50}, 10))}
    assert detail == {
        "total_ratio": "total rows 60 dropped below 50% of previous snapshot (200)",
        "provider_ratio": "google rows 60 below 45% of previous snapshot (200)",
    }
    assert rows(gates.sanity_issues(new, old, "1.0", {"google": 50}, 10)) == []
    fallback = gates.fallback_providers(new, old, "2.1.0", {"google": 50})
    assert [r["expected"] for r in rows(fallback)] == [90]
    outcome = lambda *a: tuple(rows(gates.run_outcome(*a))[0].values())
    assert outcome(new, old, "2.1.0", {"google": 50}, 10) == ("degraded", "google", 0)
    assert outcome(new, old, "1.0", {"google": 50}, 10) == ("success", "", 0)
    assert outcome(new, old, "2.1.0", {"google": 50, "xai": 1}, 10) == ("failed", "google", 1)
    assert outcome(old, old, "2.1.0", {"google": 50}, 10) == ("success", "", 0)


def test_gate_checks(spark, rows):
    df = counts(spark, anthropic=12, xai=3)
    out = rows(gates.gate_checks(df, F.lit("2.1.0"), F.lit(31.25), F.lit(None).cast("string"), F.lit("failed"), {"anthropic": 10, "xai": 10}, 10))
    got = {r["name"]: (r["passed"], r["detail"]) for r in out}
    assert got["schema_version"] == (True, "schema_version=2.1.0")
    assert got["pricing_json_recency"][0] is False and got["total_row_floor"] == (True, "rows=15 floor=10")
    assert got["provider_floor_anthropic"] == (True, "anthropic=12 floor=10") and got["provider_floor_xai"][0] is False
    assert got["history_freshness"][0] is False and got["run_report_status"] == (False, "status=failed")
    assert {r["all_passed"] for r in out} == {False}


ATTEMPT = "source string, provider_id string, tier string, date string, run_status string, error string, api_model string, run_at string, ord int"


@pytest.fixture()
def health(spark, rows):
    panel_rows = spark.createDataFrame([("google", "flagship"), ("openai", "flagship")], "provider_id string, tier string")

    def build(*attempts):
        data = [("ledger", p, "flagship", d, s, e, "m", f"{d}T07", i) for i, (p, s, e, d) in enumerate(attempts)]
        return gates.collection_health(panel_rows, spark.createDataFrame(data, ATTEMPT))

    return build


D = "2026-08-21"


def test_failing_row_is_dark(health, rows):
    h = health(("google", "ok", None, D), ("openai", "error", "400 bad", D))
    status = {r["provider_id"]: r for r in rows(gates.panel_status(h))}
    assert status["google"]["reporting"] and not status["openai"]["reporting"]
    assert status["openai"]["dark_sources"] == "ledger"
    assert [r["last_error"] for r in rows(h) if r["provider_id"] == "openai" and r["source"] == "ledger"] == ["400 bad"]
    assert rows(gates.health_summary(gates.panel_status(h))) == [{"reporting_count": 1, "panel_count": 2, "dark": "openai·flagship"}]
    checks = {c["name"]: c for c in rows(gates.gate_collection(h, ["ledger"]))}
    assert not checks["ledger_no_dark_providers"]["passed"] and "400 bad" in checks["ledger_no_dark_providers"]["detail"]
    assert checks["ledger_no_silent_providers"]["passed"] and set(checks) == {
        "provider_health_present", "ledger_no_dark_providers", "ledger_no_silent_providers"}


def test_partial_success_reports(health, rows):
    h = health(("google", "ok", None, D), ("google", "error", "flake", D))
    google = {r["provider_id"]: r for r in rows(gates.panel_status(h))}["google"]
    assert google["reporting"] and google["dark_sources"] == ""


def test_new_failure_is_not_masked(health, rows):
    h = health(("google", "ok", None, D), ("openai", "ok", None, "2026-08-20"), ("openai", "error", "404", D))
    o = next(r for r in rows(h) if r["provider_id"] == "openai" and r["source"] == "ledger")
    assert (o["ok_count"], o["error_count"], o["latest_observed"], o["last_ok"]) == (0, 1, D, "2026-08-20")


def test_dry_runs_and_silence(health, rows):
    h = health(("google", "dry_run", None, D), ("google", None, None, D), ("openai", "ok", None, D))
    g = next(r for r in rows(h) if r["provider_id"] == "google" and r["source"] == "ledger")
    assert (g["ok_count"], g["error_count"]) == (0, 0)
    checks = {c["name"]: c for c in rows(gates.gate_collection(h, ["ledger"]))}
    assert checks["ledger_no_silent_providers"]["detail"] == "google·flagship"
    wrapper = {c["name"]: c["passed"] for c in rows(gates.gate_collection(h, ["ledger", "wrapper"]))}
    assert wrapper["wrapper_no_silent_providers"] is False


def test_last_error_is_first_on_ties(health, rows):
    h = health(("openai", "error", "one", D), ("openai", "error", "two", D))
    assert [r["last_error"] for r in rows(h) if r["provider_id"] == "openai" and r["source"] == "ledger"] == ["one"]


def test_empty_health_fails(health, rows):
    checks = rows(gates.gate_collection(health(("google", "ok", None, D)).filter("false")))
    assert [(c["name"], c["passed"]) for c in checks] == [("provider_health_present", False)]


def test_best_attempt_keeps_later_on_ties(spark, rows):
    data = [("a", 1)] * 2 + [("a", 2)] * 2 + [("b", 1)] * 3 + [("b", 2)]
    out = {r["provider_id"]: r for r in rows(gates.best_attempt(spark.createDataFrame(data, "provider_id string, attempt int"), {"a": 3}))}
    assert (out["a"]["attempt"], out["a"]["low_yield"]) == (2, True) and (out["b"]["attempt"], out["b"]["low_yield"]) == (1, False)


def test_candidates_and_fallbacks(spark, rows):
    lists = spark.createDataFrame([("p", "flagship", ["x", "dear", "off", "half", "good", "spare"]), ("p", "workhorse", ["off"])], "provider_id string, tier string, candidates array<string>")
    models = spark.createDataFrame([
        ("p", "off", "Off", 1.0, 1.0, False), ("p", "half", "Half", 1.0, None, True), ("p", "good", "Good", 1.0, 2.0, True), ("p", "spare", "Spare", 3.0, 4.0, True),
    ], "provider_id string, model_id string, display_name string, input_price double, output_price double, is_active boolean")
    cand = panel.candidate_rows(lists)
    chosen = panel.first_match(cand, models)
    assert [(r["tier"], r["model_id"], r["pos"]) for r in rows(chosen)] == [("flagship", "good", 4)]
    assert [r["model_id"] for r in rows(panel.fallbacks(cand, models, chosen).orderBy("pos"))] == ["off", "half", "spare"]


def test_budget_against_brute_force(spark, rows):
    models = spark.createDataFrame([(5.0, 25.0), (1.0, 5.0), (None, 3.0)], "input_price double, output_price double")
    tasks = spark.createDataFrame([("A", 400, 4000), ("B", 8000, 4000), ("C", 100, 4000), ("D", 90000, 4000), ("Z", 1, 1)], "task_id string, input_chars int, output_cap int")
    want = lambda ids: sum(c / 4 / 1e6 * i + o / 1e6 * p for t, c, o in [("A", 400, 4000), ("B", 8000, 4000), ("C", 100, 4000), ("D", 90000, 4000)] if t in ids for i, p in [(5, 25), (1, 5)])
    out = {r["pack_id"]: r for r in rows(panel.pack_budget(models, tasks))}
    assert set(out) == set(panel.TASK_PACKS)
    for name, ids in panel.TASK_PACKS.items():
        assert out[name]["per_run_usd"] == pytest.approx(want(ids))
        year = out[name]["annual_usd_by_cadence"]
        assert year["daily"] == pytest.approx(want(ids) * 365) and set(year) == set(panel.RUNS_PER_YEAR)
    assert out["chat"]["per_run_usd"] == 0


def test_plans(spark, rows):
    p = spark.createDataFrame([("a", "flagship"), ("a", "workhorse")], "provider_id string, tier string")
    assert panel.plan_grid(p, ["A", "B"], 3).groupBy("tier").count().orderBy("tier").collect()[1]["count"] == 6
    assert panel.turn_grid(p, F.lit(0)).count() == 2 and panel.turn_grid(p, F.lit(99)).count() == 20


def test_prefix_matches(spark, rows):
    frame = lambda c, *v: spark.createDataFrame([(x,) for x in v], f"{c} string")
    out = {r["wanted"]: r["resolved"] for r in rows(panel.prefix_matches(
        frame("wanted", "c-haiku-4.5", "c-opus", "none", "c-h"),
        frame("id", "c-haiku-4-5-20250101", "c-haiku-4-5-20251001", "c-opus", "c-opus-2025", "c-haiku-4-50"),
    ))}
    assert out == {"c-haiku-4-5": "c-haiku-4-5-20251001", "c-opus": "c-opus", "none": "none", "c-h": "c-h"}


def test_precedence_merge_takes_whole_row(spark, rows):
    kind = "k int, a string, b string"
    out = {r["k"]: (r["a"], r["b"], r["is_live"]) for r in rows(panel.precedence_merge(
        spark.createDataFrame([(1, "x", "y"), (2, "x", "y")], kind), spark.createDataFrame([(2, "z", None), (3, "q", "q")], kind), ["k"]))}
    assert out == {1: ("x", "y", False), 2: ("z", None, True), 3: ("q", "q", True)}


def run(**more):
    base = dict(run_date="2026-08-22", provider_id="p", tier="workhorse", task_id="A", replicate=1, tokens_in=100, tokens_out=10,
                input_chars=1000, output_cap=400, run_status="ok", usd_value_same_day=0.01)
    return {**base, **more}


@pytest.fixture()
def medians(spark, rows):
    corpus = spark.createDataFrame([("A", 777), ("B", 0)], "task_id string, input_chars int")

    def build(*data, chunk=2_000_000):
        names = schemas.METER_RUN.names
        df = spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], schemas.METER_RUN)
        good = runs.usable_runs(df, corpus, "2026-08-21")
        return rows(runs.replicate_median(good, rows_per_chunk=chunk).orderBy("date", "provider_id", "tier", "task_id"))

    return build


def test_density_and_censoring(medians):
    (r,) = medians(run(tokens_in=200, tokens_out=400), run(provider_id="q", run_status="error"), run(provider_id="x", run_status="dry_run", tokens_in=None))
    assert (r["tokens_total"], r["tokens_in_per_1k_chars"], r["output_censored"], r["replicate_count"], r["usd"]) == (600.0, 200.0, True, 1, 0.01)
    assert r["output_policy_version"] == "1.0.0"


def test_median_of_replicates(medians):
    (r,) = medians(*[run(replicate=i, tokens_in=t, usd_value_same_day=u) for i, t, u in ((1, 100, None), (2, 200, 3.0), (3, 300, 5.0))])
    assert (r["tokens_in"], r["usd"], r["replicate_count"]) == (200.0, 4.0, 3)
    (r,) = medians(*[run(replicate=i, tokens_in=t, usd_value_same_day=None) for i, t in ((1, 100), (2, 200), (3, 300), (4, 1000))], chunk=1)
    assert (r["tokens_in"], r["usd"]) == (250.0, None)


def test_missing_chars_come_from_the_corpus(medians):
    (r,) = medians(run(input_chars=None, tokens_in=40))
    assert r["input_chars"] == 777 and r["output_censored"] is False
    assert medians(run(task_id="B", input_chars=0)) == [] and medians(run(task_id="C", input_chars=None)) == []


def test_flag_beats_cap_and_first_cap_counts(medians):
    (r,) = medians(run(output_censored=False, tokens_out=400))
    assert r["output_censored"] is False
    (r,) = medians(run(replicate=1, output_cap=400), run(replicate=2, output_cap=9999, tokens_out=400))
    assert r["output_censored"] is True


def test_run_date_falls_back_and_epoch_drops(medians):
    stale = run(run_date=None, run_week="2026-08-10")
    assert [r["date"] for r in medians(stale, run(run_date="", run_week="2026-08-23"), run())] == ["2026-08-22", "2026-08-23"]


def test_complete_groups(spark, rows):
    kind = "date string, provider_id string, tier string, task_id string, tokens_in int, tokens_out int, tokens_total int, input_chars int, usd double, output_censored boolean, replicate_count int, tokens_in_per_1k_chars double"
    row = lambda p, t, **k: tuple({**dict(date="d", provider_id=p, tier="t", task_id=t, tokens_in=10, tokens_out=1, tokens_total=11, input_chars=100, usd=None, output_censored=None, replicate_count=None, density=2.0), **k}.values())
    df = spark.createDataFrame([row("a", "A"), row("a", "B", usd=2.0, output_censored=True, replicate_count=3), row("b", "A"), row("b", "A"), row("a", "Z", density=9.0)], kind)
    points, missing = runs.complete_points(runs.complete_group_sum(df, ["A", "B"]))
    (p,) = rows(points)
    assert (p["provider_id"], p["tokens_in"], p["usd"], p["censored"], p["replicate_count"], p["tokens_in_per_1k_chars"]) == ("a", 20, 2.0, True, 3, 100.0)
    assert rows(missing) == [{"incomplete": 1}]
    led = spark.createDataFrame([row("a", "A", density=1.0), row("a", "B", density=3.0), row("a", "D", density=50.0), row("b", "A"), row("b", "B", density=None)], kind)
    points, missing = runs.complete_points(runs.complete_group_mean(led, ["A", "B", "D"]))
    assert [(p["provider_id"], p["ledger_density"]) for p in rows(points)] == [("a", 2.0)] and rows(missing) == [{"incomplete": 1}]
    only, _ = runs.complete_points(runs.complete_group_mean(led, ["D"]))
    assert [p["ledger_density"] for p in rows(only)] == [50.0]


def test_upsert_is_idempotent_and_null_safe(spark, rows):
    kind = "run_date string, tier string, v int"
    old = spark.createDataFrame([("d", None, 1), ("d", "t", 2), ("e", "t", 3)], kind)
    new = spark.createDataFrame([("d", None, 9)], kind)
    kind = "run_date string, mode string, task_id string, provider_id string, tier string, replicate int, v int"
    key = ("d", "m", "t", "p", "f")
    merged = runs.upsert(
        spark.createDataFrame([(*key, None, 1), (*key, 2, 2)], kind), spark.createDataFrame([(*key, 1, 3)], kind), runs.METER_KEY)
    assert sorted((r["replicate"], r["v"]) for r in rows(merged)) == [(1, 3), (2, 2)]
    once = runs.upsert(old, new, ["run_date", "tier"])
    twice = runs.upsert(once, new, ["run_date", "tier"])
    want = [("d", None, 9), ("d", "t", 2), ("e", "t", 3)]
    assert sorted((r["run_date"], r["tier"], r["v"]) for r in rows(once) if r["tier"]) == want[1:]
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice))) and len(rows(once)) == 3


def test_transcripts(spark, rows):
    turns = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", "é" * (i + 1)) for i in range(24)], "conv_id int, turn int, role string, text string")
    assert len(rows(runs.transcript_prefixes(turns))) == 12
    out = rows(runs.transcript_prefixes(turns, 10).orderBy("exchanges"))
    assert len(out) == 10 and out[2]["prefix_chars"] == sum(range(1, 7))
    assert out[0]["prefix_text"] == "USER: é\n\nASSISTANT: éé"
    (size,) = rows(runs.transcript_sizes(turns))
    assert (size["chars"], size["bytes"], size["words"]) == (300 + 23, 600 + 23, 24)


def test_long_transcripts_are_cut_into_chunks(spark, rows):
    """One conversation holds a third of all turns; lines may be null, ids too."""
    data = [(1, i, "user" if i % 2 == 0 else "assistant", None if i % 11 == 3 else f"t{i}") for i in range(200)]
    data += [(c, i, None if (c, i) == (7, 0) else "user", f"{c}-{i}") for c in range(2, 60) for i in range(6)]
    data += [(None, i, "user", f"n{i}") for i in range(50)]
    turns = spark.createDataFrame(data, "conv_id int, turn int, role string, text string").repartition(7)
    want = {}
    for c in {r[0] for r in data}:
        lines, chars = [], 0
        for _, i, role, text in sorted((r for r in data if r[0] == c), key=lambda r: r[1]):
            chars += len(text or "")
            if role is not None and text is not None:
                lines.append(f"{role.upper()}: {text}")
            if i % 2 == 1:
                want[(c, (i + 1) // 2)] = (chars, "\n\n".join(lines))
    for size in (7, 1000):
        got = {(r["conv_id"], r["exchanges"]): (r["prefix_chars"], r["prefix_text"]) for r in rows(runs.transcript_prefixes(turns, turns_per_chunk=size))}
        assert got == want


def test_alternation(spark, rows):
    good = [(1, i, "user" if i % 2 == 0 else "assistant", 15 if i % 2 == 0 else 50) for i in range(20)]
    bad = [(2, 0, "assistant", 50), (2, 1, "user", 5), (2, 3, "assistant", 50)]
    out = {r["conv_id"]: r for r in rows(gates.alternation_checks(spark.createDataFrame(good + bad, "conv_id int, turn int, role string, words int"), (12, 18), (45, 55)))}
    assert all(out[1][c] for c in ("alternates", "word_budget", "complete")) and out[1]["user_turns"] == 10
    assert not any(out[2][c] for c in ("alternates", "word_budget", "complete"))


def test_forecasts_by_hand(spark, rows):
    values = [10, 20, 30, 40, 50, 60, 90, 10, 70]
    daily = spark.createDataFrame([("u", i, v) for i, v in enumerate(values)] + [("short", i, 1) for i in range(3)], "k string, n int, v int")
    daily = daily.select("k", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).alias("date"), "v")
    assert [(r["v"], r["predicted"]) for r in rows(usage.naive_forecast(daily, "k", "v").orderBy("date"))] == [(90, 60), (10, 60), (70, 60)]
    (b,) = rows(usage.backtest_naive(daily, "k", "v"))
    assert (b["naive_mae"], b["mean_residual"], b["p75_residual"], b["train_mean"]) == (pytest.approx(30), pytest.approx(-10 / 3), 20.0, 35.0)
    assert b["p90_residual"] == pytest.approx(26) and b["buffer_pct_p90"] == pytest.approx(26 / 35)
    band = rows(usage.buffer_band(daily, "k", "v"))
    assert len(band) == 3 and band[0]["predicted"] == 35.0 and band[0]["upper"] == pytest.approx(35 + 51)
    fit = {r["k"]: r for r in rows(usage.exp_smoothing(daily, "k", "v"))}
    assert set(fit) == {"u"} and fit["u"]["alpha"] == 0.9 and fit["u"]["train_days"] == 6
    assert [r["lag_7"] for r in rows(usage.lag_features(daily, "k", "v").orderBy("date"))] == [10, 20]


def test_lag_regression_beats_the_last_value(spark, rows):
    """Two users of different level share one model; a week's pattern is learned from the lags."""
    day = F.col("id").cast("int")
    daily = spark.range(70).select(
        F.explode(F.array(F.lit("low"), F.lit("high"), F.lit(None).cast("string"))).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("date"),
        ((day % 7) * 10).cast("double").alias("v")).withColumn("v", F.when(F.col("k") == "high", F.col("v") + 500).otherwise(F.col("v")))
    out = rows(usage.lag_regression(daily, "k", "v", days=5))
    assert len(out) == 15 and all(abs(r["v"] - r["predicted"]) < 15 for r in out)
    errors = rows(usage.backtest_lags(daily, "k", "v", days=5))
    assert len(errors) == 3 and all(r["days"] == 5 and r["model_mae"] < r["naive_mae"] / 2 for r in errors)
    assert rows(usage.lag_regression(daily.limit(0), "k", "v")) == []
    levels = {r["k"]: r["level"] for r in rows(usage.encoded_key(usage.holdout_split(daily, "k", 5), "k", "v"))}
    assert levels["high"] - levels["low"] == pytest.approx(500) and levels[None] == levels["low"]


def test_cycle_position(spark, rows):
    df = spark.sql("SELECT 'u' AS k, timestamp_ntz'2024-01-01 12:00:00' AS ts UNION ALL SELECT 'u', timestamp_ntz'2024-01-02 06:00:00.5'")
    out = sorted(r["day_of_cycle"] for r in rows(usage.cycle_position(df, "k", "ts")))
    assert out == pytest.approx([0.5, 1.25 + 0.5 / 86400])
