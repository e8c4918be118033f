"""Structured Streaming forms of the incremental steps.

Every job takes an input stream and a checkpoint folder and returns the running
query. Batches are merged with the same operators the batch jobs use, and each
merge can be repeated without changing the result, so a batch that is replayed
after a lost driver does no harm.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.ordered import last_wins
from ..operators.runs import upsert
from ..session import checkpointed
from ..sources import store, writers

SEEN = "run string, batch long, date date"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session for stateful streams beside the given one.

    State partitions are fixed for the life of a checkpoint and are not
    coalesced at run time, so they follow the cluster's cores.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", min(wanted, 2 * spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(stream: DataFrame, merge, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_once(stream: DataFrame, target: str, order: str, checkpoint: str) -> StreamingQuery:
    """Append rows with unseen content hashes; exact over all time."""
    return _start(stream, lambda batch, _: writers.insert_if_absent(batch, target, order), checkpoint)


def ingest_once_bounded(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """The same with bounded state: copies within the watermark are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_sha256"])


def replace_days(stream: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Each batch replaces the days it holds; a later file for a day wins.

    A day that one run of the stream brings in two batches is not replaced by its
    second part: within a run, later rows of a day win by key over the earlier ones.
    The days a run has written are kept beside its checkpoint.
    """
    seen = f"{checkpoint.rstrip('/')}-days"
    run = uuid.uuid4().hex

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = checkpointed(last_wins(batch, list(keys), list(order)), "replace-batch")
        days = new.select("date").distinct()
        known = writers.table_or_empty(spark, seen, SEEN).filter((F.col("run") == run) & (F.col("batch") < number))
        again = days.join(known.select(F.col("date").alias("__day")), F.col("date").eqNullSafe(F.col("__day")), "left_semi")
        existing = writers.table_or_empty(spark, target, batch.schema)
        merged = checkpointed(upsert(_rows_of_days(existing, again, "date"), new, keys), "replace-merged")
        writers.replace_days(merged, target)
        days.select(F.lit(run).alias("run"), F.lit(number).cast("long").alias("batch"), F.col("date").cast("date")).write.mode("append").parquet(seen)

    return _start(stream, merge, checkpoint)


def _rows_of_days(table: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """Rows of ``table`` in the days of ``batch``, rows without a day among them.

    The equality prunes the table's folders at run time; the folder of rows
    without a day is read only if the batch has such rows.
    """
    day = F.col(partition)
    days = batch.select(partition).distinct()
    dated = store.rows_on_days(table.filter(day.isNotNull()), batch, partition)
    blank = days.filter(day.isNull()).select(F.lit(True).alias("__blank"))
    undated = table.filter(day.isNull()).withColumn("__blank", F.lit(True)).join(blank, "__blank", "left_semi").drop("__blank")
    return dated.unionByName(undated.select(*dated.columns))


def upsert_days(
    stream: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, partition: str = "date"
) -> StreamingQuery:
    """Merge each batch by key, touching only the days it holds.

    The merged days are written aside before they replace the old ones, since a
    table cannot be overwritten while it is read.
    """

    def merge(batch: DataFrame, _: int) -> None:
        new = checkpointed(last_wins(batch, list(keys), list(order)), "upsert-batch")
        existing = writers.table_or_empty(batch.sparkSession, target, batch.schema)
        touched = _rows_of_days(existing, new, partition)
        writers.replace_days(checkpointed(upsert(touched, new, keys), "upsert"), target, partition)

    return _start(stream, merge, checkpoint)


#: True in the rows that only move the event time on.
CLOSING = "__closing"
WATERMARKS = "batch long, newest timestamp"


def closable(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` together with the closing rows of a folder (see ``close_day``)."""
    rows = stream.withColumn(CLOSING, F.lit(False))
    session = stream.sparkSession
    session.createDataFrame([], rows.schema).write.mode("append").parquet(folder)
    return rows.unionByName(session.readStream.schema(rows.schema).parquet(folder))


def close_day(spark: SparkSession, folder: str, schema: T.StructType, time: str, day: dt.date, delay: dt.timedelta) -> None:
    """End ``day`` for the jobs over ``closable`` rows: put a row into ``folder`` that has
    only an event time, the midnight after it plus the watermark's ``delay``.

    A job that is started again on its checkpoint then sees its watermark reach that
    midnight and reports the day, and the stream goes on: rows of the next day are in
    time. The closing row itself is left out of every result.
    """
    at = dt.datetime.combine(day, dt.time(), dt.UTC) + dt.timedelta(days=1) + delay
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in (time, CLOSING)]
    row = spark.range(1).select(
        F.timestamp_micros(F.lit(int(at.timestamp() * 1_000_000))).alias(time), F.lit(True).alias(CLOSING), *blank)
    row.select(*[f.name for f in schema if f.name != CLOSING], CLOSING).write.mode("append").parquet(folder)


def _watermarked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """``stream`` with a watermark, its closing rows gone.

    The filter names the event time, so it stays above the watermark, which has to see
    the closing rows.
    """
    marked = stream.withWatermark(time, delay)
    if CLOSING not in stream.columns:
        return marked
    return marked.filter(F.when(F.col(time).isNotNull(), ~F.col(CLOSING)).otherwise(F.lit(True))).drop(CLOSING)


def _done(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def split_late(stream: DataFrame, time: str, delay: dt.timedelta, on_time: str, late: str, checkpoint: str) -> StreamingQuery:
    """Rows of days still open go to ``on_time``, rows of closed days to ``late``.

    A day is closed for a batch when its end is not after the newest event time of all
    batches before, less ``delay``: the rule of the engine's watermark. Jobs downstream
    read ``on_time`` (see ``read_on_time``) and so drop nothing; what came too late can
    be counted and loaded by other means. The newest time of every batch is kept beside
    the checkpoint. A batch is written once: run again, it finds its folder complete.
    """
    marks = f"{checkpoint.rstrip('/')}-watermark"

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = writers.table_or_empty(spark, marks, WATERMARKS).filter(F.col("batch") < number)
        newest = known.agg(F.unix_micros(F.max("newest"))).first()[0]
        rows = checkpointed(batch, "split-batch")
        closed = F.lit(False)
        if newest is not None:
            mark = newest - delay // dt.timedelta(microseconds=1)
            ends = (F.floor(F.unix_micros(time) / (86_400 * 1_000_000)) + 1) * (86_400 * 1_000_000)
            closed = F.coalesce(ends <= mark, F.lit(False))
        for path, part in ((late, rows.filter(closed)), (on_time, rows.filter(~closed))):
            folder = f"{path}/batch-{number:012d}"
            if not _done(spark, folder):
                part.write.mode("overwrite").parquet(folder)
        rows.agg(F.lit(number).cast("long").alias("batch"), F.max(time).alias("newest")).write.mode("append").parquet(marks)

    return _start(stream, merge, checkpoint)


def read_on_time(spark: SparkSession, on_time: str, schema: T.StructType) -> DataFrame:
    """The stream that ``split_late`` left in time, batches in their order."""
    return spark.readStream.schema(schema).parquet(f"{on_time}/batch-*")


def read_late(spark: SparkSession, late: str, schema: T.StructType) -> DataFrame:
    """The rows that came after their day was closed."""
    return writers.table_or_empty(spark, f"{late}/batch-*", schema).filter(~F.col(CLOSING) if CLOSING in schema.names else F.lit(True))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the progress kept of a query counts as dropped behind the watermark."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0) if isinstance(state, dict) else state.numRowsDroppedByWatermark
        for progress in query.recentProgress for state in progress["stateOperators"])


def event_time(c: Column) -> Column:
    """A zone-less UTC time as the instant that watermarks need."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def utc_day(c: Column) -> Column:
    """Day windows begin at UTC midnight, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(c) / 86400).cast("int"))


def daily_sums(stream: DataFrame, key: str, time: str, value: str, out: str, delay: str) -> DataFrame:
    """Sum per key and day, emitted once the watermark has passed the day."""
    return (
        _watermarked(stream, time, delay)
        .groupBy(key, F.window(time, "1 day"))
        .agg(F.sum(value).alias(out))
        .select(key, utc_day(F.col("window.start")).alias("date"), out)
    )


ALERTS = T.StructType([
    T.StructField("pricing_id", T.StringType()),
    T.StructField("prev_date", T.DateType()),
    T.StructField("date", T.DateType()),
    T.StructField("from_value", T.DoubleType()),
    T.StructField("to_value", T.DoubleType()),
])


class LastValue(StatefulProcessor):
    """Holds the last value and its day per id, and reports moves.

    Input is one row per id and closed day. A day not after the one held is
    ignored: the watermark has already declared it final.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        state = T.StructType([
            T.StructField("value", T.DoubleType()),
            T.StructField("date", T.DateType()),
        ])
        self.last = handle.getValueState("last", state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        points = pd.concat(list(rows)).dropna(subset=["value"]).sort_values("date")
        held = self.last.get() if self.last.exists() else None
        moves = []
        for value, date in zip(points["value"], points["date"]):
            if held is not None and date <= held[1]:
                continue
            if held is not None and value != held[0]:
                moves.append((key[0], held[1], date, held[0], float(value)))
            held = (float(value), date)
        if held is not None:
            self.last.update(held)
        yield pd.DataFrame(moves, columns=ALERTS.names)

    def close(self) -> None:
        pass


def daily_last(stream: DataFrame, delay: str) -> DataFrame:
    """The last value per id and closed day; ``stream`` has pricing_id, ts, ord and value."""
    return (
        _watermarked(stream, "ts", delay)
        .groupBy("pricing_id", F.window("ts", "1 day"))
        .agg(F.max(F.struct("ts", "ord", "value")).alias("last"))
        .select(
            "pricing_id",
            utc_day(F.col("window.start")).alias("date"),
            F.col("last.value").alias("value"),
        )
    )


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete ``batch=`` folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and _done(spark, f"{path}/{n}"))


HELD = "pricing_id string, date date, value double"


def write_moves(daily: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Price moves of ``daily_last`` rows against the last value of each id, as a table.

    For any number of ids: a batch meets the values held in one shuffle by id. What an id
    held last lies beside the checkpoint, a folder per batch; a closed day brings most ids,
    so writing it anew costs what the batch does. A day not after the one held is ignored.
    A batch run again starts from the folder before its own and overwrites its moves.
    """
    held_at = f"{checkpoint.rstrip('/')}-held"

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = checkpointed(batch.filter(F.col("value").isNotNull()).select("pricing_id", "date", "value"), "moves-batch")
        if new.isEmpty():
            return
        before = [n for n in _batches(spark, held_at) if n < number]
        old = spark.read.schema(HELD).parquet(f"{held_at}/batch={before[-1]}") if before else spark.createDataFrame([], HELD)
        points = old.withColumn("held", F.lit(True)).unionByName(new.withColumn("held", F.lit(False)))
        # At most one id's days.
        of_id = Window.partitionBy("pricing_id")
        known = points.withColumn("since", F.max(F.when(F.col("held"), F.col("date"))).over(of_id))
        fresh = known.filter(F.col("held") | F.col("since").isNull() | (F.col("date") > F.col("since")))
        upto = of_id.orderBy("date")
        moves = fresh.select(
            "pricing_id", F.lag("date").over(upto).alias("prev_date"), "date",
            F.lag("value").over(upto).alias("from_value"), F.col("value").alias("to_value"),
        ).filter(F.col("from_value") != F.col("to_value"))
        moves.write.mode("overwrite").parquet(f"{target}/batch={number}")
        last = points.groupBy("pricing_id").agg(F.max(F.struct("date", "held", "value")).alias("last"))
        last.select("pricing_id", "last.date", "last.value").write.mode("overwrite").parquet(f"{held_at}/batch={number}")
        fs = spark._jvm.org.apache.hadoop.fs
        for n in before[:-1]:
            gone = fs.Path(f"{held_at}/batch={n}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)

    return _start(daily, merge, checkpoint)


def read_moves(spark: SparkSession, target: str) -> DataFrame:
    return writers.table_or_empty(spark, f"{target}/batch=*", ALERTS)


def price_alerts(stream: DataFrame, delay: str) -> DataFrame:
    """Price moves against the last state of each id, as a stream to go on with.

    Python is called once per id and batch; ``write_moves`` does the same for many ids.

    ``stream`` has pricing_id, ts, ord and value. Raw rows are first reduced to
    the last value per id and day, map-side, so the stateful step sees at most
    one row per id and closed day even for an id with most of the rows. Needs
    the RocksDB state store, which ``streaming_session`` sets.
    """
    return daily_last(stream, delay).groupBy("pricing_id").transformWithStateInPandas(
        LastValue(), outputStructType=ALERTS, outputMode="append", timeMode="None"
    )


def to_table(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet table; the sink keeps its own commit log."""
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for an availableNow query and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
