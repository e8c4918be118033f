"""Writers: append-only log, insert-if-absent, day replacement, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import measures as ms
from ..schemas import CURRENT_SCHEMA
from ..session import checkpointed

# Statuses that keep an incident, and the document description.
INCIDENT_STATUSES = ("failed", "degraded", "escalated")
DESCRIPTION = "Tier-aware pricing rows with explicit input and output token prices."
INCIDENT_INDEX = "run_id string, day string"
# Folders of a content table.
PREFIX = "prefix"
PREFIX_DIGITS = 2


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def table_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_log(documents: DataFrame, path: str, run_id: str | None) -> None:
    """One log row per ingested document: random id, run, hash and times."""
    documents.select(
        F.uuid().alias("snapshot_id"),
        F.lit(run_id).cast("string").alias("run_id"),
        content_hash(F.col("payload")).alias("content_sha256"),
        ms.parse_scraped_at(F.col("scraped_at")).alias("scraped_at"),
        F.current_timestamp().alias("ingested_at"),
        "payload",
    ).write.mode("append").parquet(path)


def absent_rows(new: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """First row of each content hash that the table does not hold yet.

    ``new`` has ``content_sha256`` and a unique ``order``. Copies are thinned to
    one order value per hash before any join, so payloads of a heavily copied
    document are never brought together. The table is only ever the streamed
    side of a semi join: with a batch small enough to broadcast it is scanned
    for its hashes and not shuffled. A null payload has a null hash, which is a
    content like any other: the first such row enters once.
    """
    none = F.lit("")
    first = new.groupBy(F.coalesce("content_sha256", none).alias("__hash")).agg(F.min(order).alias(order))
    known = existing.select(F.coalesce("content_sha256", none).alias("__hash")).join(first, "__hash", "left_semi")
    fresh = first.join(known, "__hash", "left_anti")
    return new.join(fresh.select(order), order, "left_semi")


def hash_prefix(c: Column, digits: int = PREFIX_DIGITS) -> Column:
    """The folder of a content hash: its first hex digits; a null hash has one of its own."""
    return F.concat(F.lit("h"), F.substring(F.coalesce(c, F.lit("")), 1, digits))


def known_hashes(batch: DataFrame, path: str, digits: int = PREFIX_DIGITS) -> DataFrame:
    """Hashes that the content table holds in the folders of ``batch``.

    Folders are an index: only those whose prefix occurs in the batch are listed as
    wanted and read, and of these only the hash column. A batch has at most
    16 ** digits + 1 prefixes, so their list is bounded whatever its size.
    """
    wanted = batch.select(hash_prefix(F.col("content_sha256"), digits).alias("p")).distinct()
    prefixes = [r["p"] for r in wanted.collect()]
    schema = T.StructType([*batch.schema.fields, T.StructField(PREFIX, T.StringType())])
    table = table_or_empty(batch.sparkSession, path, schema)
    return table.filter(F.col(PREFIX).isin(prefixes)).select("content_sha256")


def insert_if_absent(new: DataFrame, path: str, order: str, digits: int = PREFIX_DIGITS) -> None:
    """Append rows with unknown hashes; running it twice changes nothing.

    The table is kept in one folder per hash prefix (column ``prefix``), so a small
    batch reads and writes only the folders of its own hashes. ``digits`` must be the
    same for the life of a table: 2 make 256 folders, 3 make 4,096.
    """
    rows = absent_rows(new, known_hashes(new, path, digits), order)
    rows = rows.withColumn(PREFIX, hash_prefix(F.col("content_sha256"), digits))
    by_partition(rows, PREFIX).write.mode("append").partitionBy(PREFIX).parquet(path)


def by_partition(rows: DataFrame, *partition: str) -> DataFrame:
    """Bring the rows of a folder together for writing: few files for a small
    day, and AQE splits a day that is too big for one task."""
    return rows.hint("rebalance", *partition)


def replace_days(rows: DataFrame, path: str, partition: str = "date") -> None:
    """Replace the days present in ``rows`` and leave all others alone."""
    inner = [c for c in ("provider_id", "pricing_id") if c in rows.columns]
    (
        by_partition(rows, partition)
        .sortWithinPartitions(partition, *inner)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def rebuild(artifacts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Overwrite every artifact."""
    paths = {name: f"{root}/{name}" for name in artifacts}
    for name, df in artifacts.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def incidents_by_day(incidents: DataFrame, path: str) -> None:
    """Keep incidents that were not a success, one folder per finishing day.

    An incident is known by its ``run_id``, of several rows of a run the one that
    finished last counts: one that is written again, on the same day or another,
    replaces itself; a run that ends in success leaves the log. ``<path>-index`` holds
    the day of every run ever written, so a batch reads the days it brings and the
    days its runs were in before, and no others.
    """
    spark = incidents.sparkSession
    day = F.substring("finished_at", 1, 10)
    rest = F.struct(*incidents.columns)
    last = incidents.groupBy(F.col("run_id").alias("__run")).agg(F.max_by(rest, F.struct("finished_at", "status")).alias("row"))
    new = checkpointed(last.select("row.*").withColumn("day", day), "incidents")
    index = f"{path.rstrip('/')}-index"
    runs = new.select("run_id").distinct()
    before = table_or_empty(spark, index, INCIDENT_INDEX).join(runs, "run_id", "left_semi")
    # Days are as many as the calendar has.
    days = sorted({r["day"] for r in before.select("day").union(new.select("day")).distinct().collect() if r["day"]})
    try:
        held = spark.read.schema(new.schema).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        held = spark.createDataFrame([], new.schema)
    held = held.filter(F.col("day").isin(days)).join(runs, "run_id", "left_anti").select(*new.columns)
    failed = new.filter(F.col("status").isin(*INCIDENT_STATUSES))
    # The index is written first: run again after a loss, the job still finds every day.
    failed.select("run_id", "day").write.mode("append").parquet(index)
    merged = checkpointed(held.unionByName(failed), "incidents-merged")
    (
        by_partition(merged, "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .json(path)
    )
    # A day that lost its last incident has no rows to overwrite it with: an empty file does.
    left = {r["day"] for r in merged.select("day").distinct().collect()}
    for gone in days:
        if gone not in left:
            merged.limit(0).drop("day").write.mode("overwrite").json(f"{path}/day={gone}")


def latest_incident(incidents: DataFrame) -> DataFrame:
    """The run that finished last, whatever its status; of a tie the larger run_id."""
    rest = [c for c in incidents.columns]
    last = F.max_by(F.struct(*rest), F.struct("finished_at", "run_id")).alias("last")
    return incidents.agg(last).filter("last IS NOT NULL").select("last.*")


def build_documents(
    rows: DataFrame,
    meta: dict[str, Column],
    providers: Column,
    order: str,
    rows_per_part: int,
) -> DataFrame:
    """Snapshot documents of ``rows``: meta, providers and a pricing array.

    A day with more than ``rows_per_part`` rows becomes several parts of about so many,
    each a complete document; readers explode them alike. The caller names the size, as
    it decides how many documents a day is. ``ord`` inside each
    element keeps the order across parts. The table of part counts has one row
    per day, so it is broadcast.
    """
    sizes = rows.groupBy("date").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_part)).cast("long").alias("__parts")
    )
    part = F.pmod(F.xxhash64(order), F.col("__parts"))
    body = [c for c in rows.columns if c != "date"]
    return (
        rows.join(F.broadcast(sizes), "date")
        .withColumn("doc_part", part)
        .groupBy("date", "doc_part")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("ord"), F.struct(*body).alias("row")))).alias("__r"))
        .select(
            "date",
            "doc_part",
            F.struct(*[v.alias(k) for k, v in meta.items()]).alias("meta"),
            providers.alias("providers"),
            F.transform("__r", lambda e: e["row"]).alias("pricing"),
        )
    )


def document_meta(run_at: Column) -> dict[str, Column]:
    return {
        "last_run_datetime": run_at,
        "schema_version": F.lit(CURRENT_SCHEMA),
        "description": F.lit(DESCRIPTION),
    }


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON document part per line, under ``date=``."""
    by_partition(docs.drop("doc_part"), "date").write.mode("append").partitionBy("date").json(path)


def named_by_day(spark: SparkSession, parts: str, folder: str, suffix: str = ".json") -> str:
    """Move the single file of each ``date=`` folder of ``parts`` to ``<folder>/<day><suffix>``.

    Files are renamed, not copied; there are as many as the calendar has days. A folder
    of several files can't be one document and raises.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(parts)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith("date="):
            continue
        files = [f.getPath() for f in fs.listStatus(status.getPath()) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise ValueError(f"{name} holds {len(files)} files")
        fs.rename(files[0], path(f"{folder}/{name.removeprefix('date=')}{suffix}"))
    return folder


def _packed(columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _print_of(packed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count and two sums of row hashes per key, from rows with a hash ``__h``.

    Sums combine map-side and do not depend on row order, so a document is never
    gathered; each sum takes 60 bits of a SHA-256.
    """
    def word(start: int) -> Column:
        return F.sum(F.conv(F.substring("__h", start, 15), 16, 10).cast("decimal(20,0)"))

    return packed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), word(1).alias("h1"), word(16).alias("h2"))


def fingerprints(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("date",)) -> DataFrame:
    """Content fingerprint per date, or per date and provider."""
    return _print_of(rows.select(*keys, _packed(columns).alias("__h")), keys)


def document_prints(
    pricing: DataFrame, pricing_columns: Sequence[str], providers: DataFrame, provider_columns: Sequence[str]
) -> DataFrame:
    """Fingerprint of each provider's share of each day's document: its pricing rows and
    its own entry. ``pricing`` and ``providers`` have date and provider_id; what is not
    listed, such as the time of the run, does not count."""
    keys = ("date", "provider_id")
    both = pricing.select(*keys, _packed(pricing_columns).alias("__h")).unionByName(
        providers.select(*keys, _packed(provider_columns).alias("__h")))
    return _print_of(both, keys)


def _with_previous(prints: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fingerprints beside those of the day before: the last earlier day of the record.

    The record's days are as many as the calendar has; each knows the next by a list.
    """
    days = sorted(r["date"] for r in prints.select("date").distinct().collect())
    after = prints.sparkSession.createDataFrame(list(zip(days, days[1:])), "date date, next date")
    marks = ("n_rows", "h1", "h2")
    earlier = prints.join(F.broadcast(after), "date").select(
        F.col("next").alias("date"), *[k for k in keys if k != "date"], F.struct(*marks).alias("old"))
    return prints.withColumn("new", F.struct(*marks)).join(earlier, list(keys), "full_outer")


def provider_changes(prints: DataFrame) -> DataFrame:
    """(date, provider_id, change) of ``document_prints``: added, removed, changed or same
    since the day before."""
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
        .when(F.col("old") == F.col("new"), "same").otherwise("changed")
    )
    return _with_previous(checkpointed(prints, "prints"), ("date", "provider_id")).select("date", "provider_id", change.alias("change"))


def snapshots_to_write(prints: DataFrame) -> DataFrame:
    """Days with ``changed``: whether the content differs from that of the day before.

    ``prints`` is one row per day, or per day and provider: a day has changed when any
    of its providers has, has come or has gone.
    """
    prints = checkpointed(prints, "prints")
    if "provider_id" in prints.columns:
        rows = _with_previous(prints, ("date", "provider_id"))
        return rows.groupBy("date").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"),
            F.bool_or(~F.col("old").eqNullSafe(F.col("new"))).alias("changed"))
    rows = _with_previous(prints, ("date",)).filter(F.col("new").isNotNull())
    return rows.select("date", "n_rows", "h1", "h2", (~F.col("old").eqNullSafe(F.col("new"))).alias("changed"))


def latest_per_day(versions: DataFrame, time: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Newest version of each UTC day."""
    return (
        versions.groupBy(F.to_date(time).alias("date"))
        .agg(F.max_by(F.struct(*keep), F.struct(time, *order)).alias("__v"))
        .select("date", "__v.*")
    )
