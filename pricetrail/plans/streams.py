"""Streaming jobs over the tables; each equals its batch form.

The jobs that report a day once it is over are fed in two parts on one checkpoint: all
days but the last, which are then closed, and the last day, which is closed in turn.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..session import work_path
from ..sources import writers
from ..streaming import jobs
from .base import OBS, load, query


def stream(spark, d, name):
    """A table as a stream, be it one file or a folder of part files."""
    session = jobs.streaming_session(spark)
    # A stream takes a single file only by a pattern.
    return jobs.read_files(session, f"{d}/{{{name}.parquet}}", load(spark, d, name).schema)


def run(spark, name, start):
    """Run a job to its end and give the folder it wrote."""
    target = work_path(spark, name)
    jobs.finish(start(target, work_path(spark, f"{name}-state")))
    return target


ON_TIME = dt.timedelta(0)


class DailyRun:
    """A table fed to a stream day by day: split into rows in time and late ones, and closed."""

    def __init__(self, spark, name, schema):
        self.session = jobs.streaming_session(spark)
        self.schema = schema
        parts = ("in", "closing", "on-time", "late", "split-state", "out", "out-state")
        self.at = {p: work_path(spark, f"{name}-{p}") for p in parts}
        self.session.createDataFrame([], schema).write.parquet(self.at["in"])
        self.rows = jobs.closable(jobs.read_files(self.session, self.at["in"], schema), self.at["closing"])

    def feed(self, rows, close=None):
        """Put rows into the stream, and end the day ``close``."""
        rows.write.mode("append").parquet(self.at["in"])
        if close is not None:
            jobs.close_day(self.session, self.at["closing"], self.schema, "ts", close, ON_TIME)
        jobs.finish(jobs.split_late(self.rows, "ts", ON_TIME, self.at["on-time"], self.at["late"], self.at["split-state"]))

    def work(self, job, sink=jobs.to_table):
        rows = jobs.read_on_time(self.session, self.at["on-time"], self.rows.schema)
        jobs.finish(sink(job(rows), self.at["out"], self.at["out-state"]))

    def late(self):
        return jobs.read_late(self.session, self.at["late"], self.rows.schema)


def run_by_day(spark, name, rows, job, sink=jobs.to_table):
    """All days but the last, closed; then the last day on the same checkpoint, closed."""
    run = DailyRun(spark, name, rows.schema)
    day = jobs.utc_day(F.col("ts"))
    last = rows.agg(F.max(day)).first()[0]
    for part, close in ((rows.filter(day < last), last - dt.timedelta(days=1)), (rows.filter(day == last), last)):
        run.feed(part, close)
        run.work(job, sink)
    return run.at["out"]


@query("stream_insert_if_absent", """
  SELECT sha256(text) AS content_sha256, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def stream_insert_if_absent(spark, d):
    docs = stream(spark, d, "documents").select(
        writers.content_hash(F.col("text")).alias("content_sha256"), "doc_id", F.col("text").alias("payload")
    )
    path = run(spark, "s-absent", lambda t, c: jobs.ingest_once(docs, t, "doc_id", c))
    # A table without rows writes nothing.
    return writers.table_or_empty(spark, path, docs.schema).select("content_sha256", "doc_id")


@query("stream_replace_day", f"WITH {OBS} SELECT pricing_id, date, value FROM obs")
def stream_replace_day(spark, d):
    rows = stream(spark, d, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("pricing_id"),
        F.to_date("ts").alias("date"), "ts", "event_id", "value",
    )
    path = run(spark, "s-days", lambda t, c: jobs.replace_days(rows, t, ["pricing_id", "date"], ["ts", "event_id"], c))
    return writers.table_or_empty(spark, path, rows.schema).select("pricing_id", "date", "value")


@query("stream_upsert", f"WITH {OBS} SELECT pricing_id, date, value + 1 AS value FROM obs")
def stream_upsert(spark, d):
    """Two passes: the second rewrites every key, none is doubled."""
    rows = stream(spark, d, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("pricing_id"),
        F.to_date("ts").alias("date"), "ts", "event_id", "value",
    )
    target = work_path(spark, "s-upsert")
    for step in (0, 1):
        batch = rows.withColumn("value", F.col("value") + step)
        jobs.finish(jobs.upsert_days(
            batch, target, ["pricing_id", "date"], ["ts", "event_id"], work_path(spark, "s-upsert-state")
        ))
    return writers.table_or_empty(spark, target, rows.schema).select("pricing_id", "date", "value")


@query("stream_daily_resample", """
  SELECT user_id, ts::DATE AS date, sum(round(value * 100)::BIGINT)::BIGINT AS tokens FROM events GROUP BY ALL""")
def stream_daily_resample(spark, d):
    rows = load(spark, d, "events").select(
        "user_id", jobs.event_time(F.col("ts")).alias("ts"), F.round(F.col("value") * 100).cast("long").alias("t")
    )
    path = run_by_day(spark, "s-daily", rows, lambda r: jobs.daily_sums(r, "user_id", "ts", "t", "tokens", "0 seconds"))
    return spark.read.parquet(path)


def alert_rows(spark, d):
    return load(spark, d, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("pricing_id"),
        jobs.event_time(F.col("ts")).alias("ts"), F.col("event_id").alias("ord"), "value",
    )


@query("stream_price_alerts", f"""
  WITH {OBS}, l AS (SELECT *, lag(value) OVER w AS from_value, lag(date) OVER w AS prev_date FROM obs
      WINDOW w AS (PARTITION BY pricing_id ORDER BY date))
  SELECT pricing_id, prev_date, date, from_value, value AS to_value FROM l WHERE from_value <> value""")
def stream_price_alerts(spark, d):
    path = run_by_day(spark, "s-alerts", alert_rows(spark, d), lambda r: jobs.daily_last(r, "0 seconds"), jobs.write_moves)
    return jobs.read_moves(spark, path)


@query("stream_late_rows", """
  SELECT ts::DATE AS date, count(*) FILTER (event_type <> 'error' OR ts::DATE = (SELECT max(ts::DATE) FROM events)) AS on_time,
    count(*) FILTER (event_type = 'error' AND ts::DATE < (SELECT max(ts::DATE) FROM events)) AS late FROM events GROUP BY 1""")
def stream_late_rows(spark, d):
    """Failures arrive when all days but the last are closed: late, except for those of the last day."""
    rows = alert_rows(spark, d)
    failed = F.col("pricing_id").endswith("-error")
    run = DailyRun(spark, "s-late", rows.schema)
    last = rows.agg(F.max(jobs.utc_day(F.col("ts")))).first()[0]
    run.feed(rows.filter(~failed), last - dt.timedelta(days=1))
    run.feed(rows.filter(failed))
    whole = run.session.read.schema(run.rows.schema).parquet(f"{run.at['on-time']}/batch-*").filter(~F.col(jobs.CLOSING))
    both = whole.withColumn("late", F.lit(False)).unionByName(run.late().withColumn("late", F.lit(True)))
    return both.groupBy(jobs.utc_day(F.col("ts")).alias("date")).agg(
        F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))
