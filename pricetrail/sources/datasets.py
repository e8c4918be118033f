"""Loading many datasets, each of them whole or not at all.

All datasets are read by one scan, which tags rows with their dataset by the folder a
file lies in, and are written to a folder of this load. A dataset becomes visible by
one row in the commit log; readers follow the log, so an aborted load, or the rows of
a broken dataset, are never seen. When the scan fails because a file can't be read,
the datasets are tried in halves, so that d broken ones among n cost about
d * log2(n) more scans and the others load all the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import by_partition, table_or_empty

DATASET = "dataset_id"
COMMITS = "dataset_id string, load string, n_rows long, status string, loaded_at timestamp"
#: What a failed read of a file is called, here or in a cause.
UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED_RECORD", "FAILED_READ")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as file names in rows show it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop)
    return _bare(whole.toUri().toString())


def _bare(uri: str) -> str:
    return "file:/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri.rstrip("/")


def _dataset_of(folders: Mapping[str, str]) -> Column:
    """The dataset of a row: that of the nearest folder above its file, or of the file itself."""
    named = F.create_map(*[x for folder, name in folders.items() for x in (F.lit(folder), F.lit(name))])
    parts = F.split(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"), "/")
    above = F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.try_element_at(named, F.array_join(F.slice(parts, 1, n), "/")))
    return F.try_element_at(F.filter(above, lambda x: x.isNotNull()), F.lit(1))


def _missing(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _broken(problem: Exception) -> str | None:
    """The condition of a failed read, or None where something else went wrong."""
    if isinstance(problem, AnalysisException):
        return problem.getCondition() or "UNREADABLE"
    return next((c for c in UNREADABLE if c in str(problem)), None)


def load_datasets(
    spark: SparkSession, paths: Mapping[str, str], target: str, schema: T.StructType, fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Load ``paths`` (dataset id -> folder or file) into ``target``; the report of the load.

    Each dataset is replaced by what was read, or left as it was when one of its files
    is missing or can't be read. The report has one row per dataset: dataset_id,
    status (``loaded`` or the reason) and n_rows. Text formats are read strictly, so a
    malformed record breaks its dataset.
    """
    load = uuid.uuid4().hex
    status: dict[str, str] = {n: "PATH_NOT_FOUND" for n, p in paths.items() if _missing(spark, p)}
    folders = {n: _qualified(spark, p) for n, p in paths.items() if n not in status}
    strict = {} if fmt == "parquet" else {"mode": "FAILFAST"}

    def attempt(names: Sequence[str], number: int) -> int:
        """Stage ``names``, in halves if one of them breaks; the number of the next attempt."""
        if not names:
            return number
        try:
            rows = spark.read.schema(schema).format(fmt).options(**{**strict, **(options or {})}).option(
                "recursiveFileLookup", True).load([paths[n] for n in names])
            tagged = rows.withColumn(DATASET, _dataset_of({folders[n]: n for n in names}))
            by_partition(tagged, DATASET).write.mode("overwrite").partitionBy(DATASET).parquet(f"{target}/data/load={load}-{number}")
        except (PySparkException, Py4JJavaError) as problem:
            reason = _broken(problem)
            if reason is None:
                raise
            if len(names) == 1:
                status[names[0]] = reason
                return number + 1
            half = len(names) // 2
            return attempt(names[half:], attempt(names[:half], number + 1))
        for n in names:
            status[n] = f"{load}-{number}"
        return number + 1

    attempt([n for n in paths if n not in status], 0)
    staged = {n: s for n, s in status.items() if s.startswith(load)}
    counts = _data(spark, target, schema).filter(F.col("load").isin(sorted(set(staged.values())))).groupBy(DATASET).count()
    counts = {r[0]: r[1] for r in counts.collect()}
    report = [(n, staged.get(n), counts.get(n, 0), "loaded" if n in staged else status[n]) for n in paths]
    log = spark.createDataFrame(report, "dataset_id string, load string, n_rows long, status string")
    log.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{target}/commits")
    return log.select(DATASET, "status", "n_rows")


def _data(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    wanted = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField(DATASET, T.StringType())])
    return table_or_empty(spark, f"{target}/data", wanted)


def read_committed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows of the last load of every dataset, tagged with ``dataset_id``.

    The log has one row per dataset and load; only the folders it names are read.
    """
    log = table_or_empty(spark, f"{target}/commits", COMMITS).filter("status = 'loaded'")
    newest = log.groupBy(DATASET).agg(F.max_by("load", F.struct("loaded_at", "load")).alias("load"))
    rows = _data(spark, target, schema).join(newest, ["load", DATASET], "left_semi")
    return rows.select(DATASET, *[f.name for f in schema.fields])
