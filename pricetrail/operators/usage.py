"""Usage analytics: cumulative tokens, daily series and simple forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .ordered import ROWS_PER_CHUNK, first_wins, global_value, running_sum

# Window lengths, lags and percentiles of the forecasts.
LAGS = (1, 2, 3, 7)
HOLDOUT_DAYS = 3
MIN_DAYS = 6
BAND_MIN_DAYS = 8
BAND_WINDOW = 7
BAND_PERCENTILE = 0.9
PERCENTILES = {"p75_residual": 0.75, "p90_residual": 0.9, "p95_residual": 0.95}
ALPHAS = tuple(a / 10 for a in range(1, 10))


def dedupe_first(rows: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """First row per value over the whole table; nulls are one value."""
    return first_wins(rows, [value], order)


def cycle_position(rows: DataFrame, key: str, time: str) -> DataFrame:
    """Day of the billing cycle, counted from midnight of the first session.

    The start is a small aggregate joined back, so a hot key is split by AQE
    like any skewed join instead of filling one window partition.
    """
    starts = rows.groupBy(key).agg(F.date_trunc("day", F.min(time)).alias("cycle_start"))
    micros = _micros(F.col(time)) - _micros(F.col("cycle_start"))
    return rows.join(starts, key).withColumn("day_of_cycle", micros / F.lit(1e6) / F.lit(86400.0))


def _micros(c: Column) -> Column:
    """Whole microseconds since 1970 from calendar fields, independent of any zone."""
    minutes = (F.unix_date(F.to_date(c)).cast("long") * 24 + F.hour(c)) * 60 + F.minute(c)
    second = F.date_part(F.lit("SECOND"), c)
    return minutes * 60_000_000 + (second * 1_000_000).cast("long")


def cumulative(
    rows: DataFrame, key: str, order: Sequence[str], value: str, out: str, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    return running_sum(rows, [key], order, value, out, rows_per_chunk)


def daily_resample(rows: DataFrame, key: str, time: str, value: str, out: str = "daily_tokens") -> DataFrame:
    return rows.groupBy(key, F.to_date(time).alias("date")).agg(F.sum(value).alias(out))


# Everything below works on a daily series: one row per key and day, so a key's
# window partition is as long as the calendar, whatever its share of the rows.


def lag_features(daily: DataFrame, key: str, value: str, lags: Sequence[int] = LAGS) -> DataFrame:
    by = Window.partitionBy(key).orderBy("date")
    return daily.withColumns({f"lag_{n}": F.lag(value, n).over(by) for n in lags}).dropna(
        subset=[f"lag_{n}" for n in lags]
    )


def holdout_split(daily: DataFrame, key: str, days: int = HOLDOUT_DAYS) -> DataFrame:
    """Mark the last ``days`` rows of each series as holdout."""
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.col("date").desc()))
    length = F.count(F.lit(1)).over(Window.partitionBy(key))
    return daily.withColumns({"from_end": back, "series_days": length}).withColumn(
        "is_holdout", F.col("from_end") <= days
    )


def naive_forecast(daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS) -> DataFrame:
    """Holdout rows with the last training value as prediction."""
    split = holdout_split(daily, key, days)
    last = F.max_by(
        F.when(~F.col("is_holdout"), F.col(value)), F.when(~F.col("is_holdout"), F.col("date"))
    ).over(Window.partitionBy(key))
    return split.withColumn("predicted", last).filter("is_holdout").filter(F.col("predicted").isNotNull())


def trailing_mean_forecast(
    daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS, window: int = BAND_WINDOW
) -> DataFrame:
    """Holdout rows with the mean of the last training days as prediction."""
    split = holdout_split(daily, key, days)
    recent = (F.col("from_end") > days) & (F.col("from_end") <= days + window)
    mean = F.avg(F.when(recent, F.col(value))).over(Window.partitionBy(key))
    return split.withColumn("predicted", mean).filter("is_holdout").filter(F.col("predicted").isNotNull())


def mae(forecast: DataFrame, key: str, value: str) -> DataFrame:
    return forecast.groupBy(key).agg(F.avg(F.abs(F.col(value) - F.col("predicted"))).alias("mae"))


def backtest_naive(
    daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS, min_days: int = MIN_DAYS
) -> DataFrame:
    """Per key: error, mean and percentile residuals, and the p90 buffer."""
    split = holdout_split(daily, key, days).filter(F.col("series_days") >= min_days)
    train = ~F.col("is_holdout")
    whole = Window.partitionBy(key)
    last = F.max_by(F.when(train, F.col(value)), F.when(train, F.col("date"))).over(whole)
    mean = F.avg(F.when(train, F.col(value))).over(whole)
    held = split.withColumns({"predicted": last, "__mean": mean}).filter("is_holdout")
    residual = F.col(value) - F.col("predicted")
    per_key = held.withColumn("residual", residual).groupBy(key).agg(
        F.avg(F.abs("residual")).alias("naive_mae"),
        F.avg("residual").alias("mean_residual"),
        F.percentile("residual", F.array(*[F.lit(p) for p in PERCENTILES.values()])).alias("__p"),
        F.max("__mean").alias("train_mean"),
    )
    return per_key.select(
        key,
        "naive_mae",
        "mean_residual",
        *[F.col("__p")[i].alias(n) for i, n in enumerate(PERCENTILES)],
        "train_mean",
        (F.col("__p")[1] / F.nullif(F.col("train_mean"), F.lit(0.0))).alias("buffer_pct_p90"),
    )


def residual_percentiles(forecast: DataFrame, key: str, value: str) -> DataFrame:
    residual = F.col(value) - F.col("predicted")
    return (
        forecast.groupBy(key)
        .agg(F.percentile(residual, F.array(*[F.lit(p) for p in PERCENTILES.values()])).alias("__p"))
        .select(key, *[F.col("__p")[i].alias(n) for i, n in enumerate(PERCENTILES)])
    )


def buffer_band(
    daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS,
    min_days: int = BAND_MIN_DAYS, window: int = BAND_WINDOW, percentile: float = BAND_PERCENTILE,
) -> DataFrame:
    """Holdout rows of long enough series with an upper band on the prediction."""
    held = trailing_mean_forecast(daily, key, value, days, window).filter(F.col("series_days") >= min_days)
    residual = F.col(value) - F.col("predicted")
    buffer = F.percentile(residual, F.lit(percentile)).over(Window.partitionBy(key))
    return held.withColumn("buffer", buffer).withColumn(
        "upper", F.when(F.col("buffer") > 0, F.col("predicted") + F.col("buffer"))
    )


def exp_smoothing(
    daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS, alphas: Sequence[float] = ALPHAS
) -> DataFrame:
    """Simple exponential smoothing of the training part of each series.

    The smoothing factor is the one of the grid with the least squared
    one-step error, the smaller on ties.
    """
    train = holdout_split(daily, key, days).filter(~F.col("is_holdout"))
    series = train.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("date", F.col(value).cast("double").alias("v")))).alias("s")
    )
    values = F.transform("s", lambda e: e["v"])

    def fit(alpha: float) -> Column:
        start = F.struct(values[0].alias("level"), F.lit(0.0).alias("sse"))
        tail = F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))
        end = F.aggregate(
            tail,
            start,
            lambda acc, x: F.struct(
                (x * alpha + acc["level"] * (1 - alpha)).alias("level"),
                (acc["sse"] + (x - acc["level"]) * (x - acc["level"])).alias("sse"),
            ),
        )
        return F.struct(
            F.round(end["sse"], 6).alias("sse"), F.lit(alpha).alias("alpha"), end["level"].alias("forecast")
        )

    best = F.array_min(F.array(*[fit(a) for a in alphas]))
    return series.select(key, F.size("s").alias("train_days"), best.alias("b")).select(
        key, "train_days", "b.alpha", "b.sse", "b.forecast"
    )


def encoded_key(split: DataFrame, key: str, value: str, out: str = "level") -> DataFrame:
    """Add the key as a number: the mean of its training days.

    Keys are too many for a column each; a key without a training day gets the mean of
    all training days.
    """
    train = split.filter(~F.col("is_holdout"))
    means = train.groupBy(F.col(key).alias("__k")).agg(F.avg(value).alias(out))
    rows = split.join(means, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")
    return rows.withColumn(out, F.coalesce(out, global_value(train, F.avg(value)), F.lit(0.0)))


def lag_regression(
    daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS, lags: Sequence[int] = LAGS,
    trees: int = 20, seed: int = 7,
) -> DataFrame:
    """The held-out days of every series, predicted by one model of all series.

    Boosted trees over the lags and the encoded key are fitted by Spark on the training
    days of all keys at once, so a short series borrows from the others. Lags reach into
    the held-out days, as each day is predicted from the days before it. Rows without a
    value of every lag are left out; with no training row there are no predictions.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    split = encoded_key(holdout_split(daily, key, days), key, value)
    rows = lag_features(split, key, value, lags)
    # Written, as every round of boosting reads it again.
    rows = checkpointed(
        VectorAssembler(inputCols=["level", *[f"lag_{n}" for n in lags]], outputCol="features").transform(rows), "lags")
    train = rows.filter(~F.col("is_holdout"))
    if train.isEmpty():
        return rows.withColumn("predicted", F.lit(0.0)).drop("features").limit(0)
    model = GBTRegressor(
        featuresCol="features", labelCol=value, predictionCol="predicted", maxIter=trees, seed=seed).fit(train)
    return model.transform(rows.filter("is_holdout")).drop("features")


def backtest_lags(daily: DataFrame, key: str, value: str, days: int = HOLDOUT_DAYS, lags: Sequence[int] = LAGS) -> DataFrame:
    """Per key: mean error of the lag model and of the last-value forecast on the same days."""
    predicted = lag_regression(daily, key, value, days, lags).select(key, "date", value, F.col("predicted").alias("__model"))
    naive = naive_forecast(daily, key, value, days).select(F.col(key).alias("__k"), F.col("date").alias("__d"), F.col("predicted").alias("__naive"))
    both = predicted.join(naive, F.col(key).eqNullSafe(F.col("__k")) & (F.col("date") == F.col("__d")))
    return both.groupBy(key).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(F.abs(F.col(value) - F.col("__model"))).alias("model_mae"),
        F.avg(F.abs(F.col(value) - F.col("__naive"))).alias("naive_mae"),
    )
