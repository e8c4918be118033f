"""Cumulative usage and forecast queries over events by user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import usage as u
from ..operators.ordered import carry_last
from .base import flag, load, query, r4


def tokens(spark, d):
    return load(spark, d, "events").select(
        "user_id", "ts", "event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("total_tokens")
    )


TOKENS = "tok AS (SELECT *, round(value * 100)::BIGINT AS total_tokens FROM events)"
DAILY = TOKENS + ", daily AS (SELECT user_id, ts::DATE AS date, sum(total_tokens)::BIGINT AS tokens FROM tok GROUP BY ALL)"
SPLIT = DAILY + """, split AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS from_end,
    count(*) OVER (PARTITION BY user_id) AS series_days FROM daily)"""


def daily(spark, d):
    return u.daily_resample(tokens(spark, d), "user_id", "ts", "total_tokens", "tokens")


@query("running_sum", f"""
  WITH {TOKENS} SELECT user_id, event_id, total_tokens,
    (sum(total_tokens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative_tokens FROM tok""")
def running_sum(spark, d):
    out = u.cumulative(tokens(spark, d), "user_id", ["ts", "event_id"], "total_tokens", "cumulative_tokens")
    return out.select("user_id", "event_id", "total_tokens", "cumulative_tokens")


@query("cumulative_after_dedupe", f"""
  WITH {TOKENS}, d AS (SELECT * FROM tok QUALIFY row_number() OVER (PARTITION BY total_tokens ORDER BY ts, event_id) = 1)
  SELECT user_id, event_id,
    (sum(total_tokens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative_tokens FROM d""")
def cumulative_after_dedupe(spark, d):
    kept = u.dedupe_first(tokens(spark, d), "total_tokens", ["ts", "event_id"])
    out = u.cumulative(kept, "user_id", ["ts", "event_id"], "total_tokens", "cumulative_tokens")
    return out.select("user_id", "event_id", "cumulative_tokens")


@query("cycle_position", """
  SELECT user_id, event_id, round((epoch_us(ts) - epoch_us(date_trunc('day', min(ts) OVER (PARTITION BY user_id))::TIMESTAMP)) / 1e6 / 86400, 6) AS day_of_cycle
  FROM events""")
def cycle_position(spark, d):
    out = u.cycle_position(tokens(spark, d), "user_id", "ts")
    return out.select("user_id", "event_id", F.round("day_of_cycle", 6).alias("day_of_cycle"))


@query("daily_resample", f"WITH {DAILY} SELECT * FROM daily")
def daily_resample(spark, d):
    return daily(spark, d)


@query("lag_features", f"""
  WITH {DAILY}, l AS (SELECT *, lag(tokens, 1) OVER w AS lag_1, lag(tokens, 2) OVER w AS lag_2, lag(tokens, 3) OVER w AS lag_3,
    lag(tokens, 7) OVER w AS lag_7 FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY date))
  SELECT * FROM l WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND lag_7 IS NOT NULL""")
def lag_features(spark, d):
    return u.lag_features(daily(spark, d), "user_id", "tokens")


@query("lag_regression")
def lag_regression(spark, d):
    """Error of the lag model and of the last-value forecast for every user."""
    return u.backtest_lags(daily(spark, d), "user_id", "tokens")


@query("lag_backtest", f"""
  WITH {DAILY}, s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS from_end FROM daily),
  l AS (SELECT *, lag(tokens, 7) OVER (PARTITION BY user_id ORDER BY date) AS lag_7 FROM s),
  n AS (SELECT a.user_id, a.tokens, b.tokens AS naive FROM l a JOIN s b ON a.user_id = b.user_id AND b.from_end = 4
    WHERE a.from_end <= 3 AND a.lag_7 IS NOT NULL)
  SELECT user_id, count(*) AS days, avg(abs(tokens - naive)) AS naive_mae FROM n GROUP BY 1""")
def lag_backtest(spark, d):
    """The days and the naive error that the lag model is held against."""
    return u.backtest_lags(daily(spark, d), "user_id", "tokens").drop("model_mae")


@query("holdout_split", f"WITH {SPLIT} SELECT user_id, date, tokens, (from_end <= 3)::BIGINT AS is_holdout FROM split")
def holdout_split(spark, d):
    return u.holdout_split(daily(spark, d), "user_id").select(
        "user_id", "date", "tokens", flag(F.col("is_holdout")).alias("is_holdout")
    )


NAIVE = SPLIT + """, naive AS (SELECT s.user_id, s.date, s.tokens, t.tokens AS predicted, s.series_days FROM split s
    JOIN split t ON s.user_id = t.user_id AND t.from_end = 4 WHERE s.from_end <= 3)"""


@query("naive_forecast", f"WITH {NAIVE} SELECT user_id, date, tokens, predicted FROM naive")
def naive_forecast(spark, d):
    return u.naive_forecast(daily(spark, d), "user_id", "tokens").select("user_id", "date", "tokens", "predicted")


TRAILING = SPLIT + """, means AS (SELECT user_id, avg(tokens) AS predicted FROM split WHERE from_end BETWEEN 4 AND 10 GROUP BY 1),
  tm AS (SELECT s.user_id, s.date, s.tokens, m.predicted, s.series_days FROM split s JOIN means m USING (user_id) WHERE s.from_end <= 3)"""


@query("naive_trailing_mean", f"WITH {TRAILING} SELECT user_id, date, tokens, round(predicted, 4) AS predicted FROM tm")
def naive_trailing_mean(spark, d):
    out = u.trailing_mean_forecast(daily(spark, d), "user_id", "tokens")
    return out.select("user_id", "date", "tokens", r4(F.col("predicted")).alias("predicted"))


@query("forecast_mae", f"WITH {NAIVE} SELECT user_id, round(avg(abs(tokens - predicted)), 4) AS mae FROM naive GROUP BY 1")
def forecast_mae(spark, d):
    out = u.mae(u.naive_forecast(daily(spark, d), "user_id", "tokens"), "user_id", "tokens")
    return out.withColumn("mae", r4(F.col("mae")))


@query("residual_percentiles", f"""
  WITH {TRAILING} SELECT user_id, round(quantile_cont(tokens - predicted, 0.75), 4) AS p75_residual,
    round(quantile_cont(tokens - predicted, 0.9), 4) AS p90_residual, round(quantile_cont(tokens - predicted, 0.95), 4) AS p95_residual
  FROM tm GROUP BY 1""")
def residual_percentiles(spark, d):
    held = u.trailing_mean_forecast(daily(spark, d), "user_id", "tokens")
    out = u.residual_percentiles(held, "user_id", "tokens")
    return out.select("user_id", *[r4(F.col(c)).alias(c) for c in u.PERCENTILES])


@query("backtest_naive", f"""
  WITH {SPLIT}, m AS (SELECT user_id, avg(tokens) AS train_mean FROM split WHERE from_end > 3 GROUP BY 1),
  naive AS (SELECT s.user_id, s.tokens - t.tokens AS r, m.train_mean FROM split s JOIN split t ON s.user_id = t.user_id AND t.from_end = 4
    JOIN m ON m.user_id = s.user_id WHERE s.from_end <= 3 AND s.series_days >= 6)
  SELECT user_id, round(avg(abs(r)), 4) AS naive_mae, round(avg(r), 4) AS mean_residual,
    round(quantile_cont(r::DOUBLE, 0.75), 4) AS p75_residual, round(quantile_cont(r::DOUBLE, 0.9), 4) AS p90_residual,
    round(quantile_cont(r::DOUBLE, 0.95), 4) AS p95_residual, round(any_value(train_mean), 4) AS train_mean,
    round(quantile_cont(r::DOUBLE, 0.9) / any_value(train_mean), 6) AS buffer_pct_p90 FROM naive GROUP BY 1""")
def backtest_naive(spark, d):
    out = u.backtest_naive(daily(spark, d), "user_id", "tokens")
    digits = {c: 6 if c == "buffer_pct_p90" else 4 for c in out.columns if c != "user_id"}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("buffer_band", f"""
  WITH {TRAILING}, b AS (SELECT user_id, quantile_cont(tokens - predicted, 0.9) AS buffer FROM tm WHERE series_days >= 8 GROUP BY 1)
  SELECT user_id, date, tokens, round(predicted, 4) AS predicted, round(buffer, 4) AS buffer,
    round(CASE WHEN buffer > 0 THEN predicted + buffer END, 4) AS upper FROM tm JOIN b USING (user_id)""")
def buffer_band(spark, d):
    out = u.buffer_band(daily(spark, d), "user_id", "tokens")
    return out.select(
        "user_id", "date", "tokens", *[r4(F.col(c)).alias(c) for c in ("predicted", "buffer", "upper")]
    )


@query("exp_smoothing", f"""
  WITH RECURSIVE {SPLIT}, train AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY date) AS i, tokens::DOUBLE AS x
      FROM split WHERE from_end > 3),
  alphas AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS a),
  walk AS (SELECT user_id, a, i, x AS level, 0.0::DOUBLE AS sse FROM train, alphas WHERE i = 1
    UNION ALL SELECT w.user_id, w.a, t.i, t.x * w.a + w.level * (1 - w.a), w.sse + (t.x - w.level) * (t.x - w.level)
      FROM walk w JOIN train t ON t.user_id = w.user_id AND t.i = w.i + 1),
  ends AS (SELECT *, max(i) OVER (PARTITION BY user_id) AS n FROM walk)
  SELECT user_id, n AS train_days, a AS alpha, round(sse, 2) AS sse, round(level, 4) AS forecast FROM ends WHERE i = n
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(sse, 6), a) = 1""")
def exp_smoothing(spark, d):
    out = u.exp_smoothing(daily(spark, d), "user_id", "tokens")
    return out.select(
        "user_id", F.col("train_days").cast("long").alias("train_days"), "alpha",
        F.round("sse", 2).alias("sse"), r4(F.col("forecast")).alias("forecast"),
    )


@query("fill_down", """
  SELECT event_id, user_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_view FROM events""")
def fill_down(spark, d):
    rows = load(spark, d, "events").withColumn("viewed", F.when(F.col("event_type") == "view", F.col("value")))
    return carry_last(rows, ["user_id"], ["ts", "event_id"], "viewed", "last_view").select(
        "event_id", "user_id", "last_view"
    )
