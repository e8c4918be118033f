"""The dated history as a table of day folders, and reads that touch few of them.

A history is written by ``writers.replace_days``: one folder per day. A constant
range of days prunes folders while the query is planned; days that are themselves
the result of a query prune them at run time, before any file is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from . import writers

DAY = "date"


def read_history(
    spark: SparkSession, path: str, schema: T.StructType, start: str | dt.date | None = None, end: str | dt.date | None = None,
) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included and both optional.

    Only the folders of these days are read. A path without any day gives no rows.
    """
    rows = writers.table_or_empty(spark, path, schema)
    if start is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(end).cast("date"))
    return rows


def rows_on_days(history: DataFrame, days: DataFrame, day: str = DAY) -> DataFrame:
    """Rows of ``history`` on the days that ``days`` computes.

    Days are as many as the calendar has, so they are broadcast, and the folders of
    all other days are not opened. The comparison with the first day there is keeps
    every day; it tells the optimizer that the list is worth pruning with.
    """
    listed = days.select(F.col(day).cast("date").alias(day)).filter(F.col(day) >= F.lit("0001-01-01").cast("date")).distinct()
    return history.join(F.broadcast(listed), day, "left_semi")


def history_days(spark: SparkSession, path: str, schema: T.StructType) -> list[dt.date]:
    """The days a history holds, in order; no column of its rows is read."""
    days = writers.table_or_empty(spark, path, schema).select(DAY).distinct().collect()
    return sorted(r[DAY] for r in days if r[DAY] is not None)


def last_days(spark: SparkSession, path: str, schema: T.StructType, n: int = 2) -> list[DataFrame]:
    """The rows of each of the newest ``n`` days, oldest of them first.

    A history of fewer days gives empty frames in place of the missing older ones.
    """
    days = history_days(spark, path, schema)[-n:]
    none = spark.createDataFrame([], schema)
    return [none] * (n - len(days)) + [read_history(spark, path, schema, d, d) for d in days]


def stored(rows: DataFrame, name: str = "history") -> tuple[str, T.StructType]:
    """Write ``rows`` once as a history in the work folder: (path, schema)."""
    path = work_path(rows.sparkSession, name)
    writers.replace_days(rows, path)
    return path, rows.schema
