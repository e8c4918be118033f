"""Readers: snapshot documents, row artifacts, CSV, JDBC, many datasets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested
from ..schemas import DOCUMENT

CORRUPT = "_corrupt_record"
DATE_IN_NAME = r"([0-9]{4}-[0-9]{2}-[0-9]{2})[^/]*\z"


def read_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """Snapshot documents with an explicit schema.

    The date is the ``date=`` partition when there is one, so a date filter
    prunes files, and the file name otherwise. Malformed documents keep their
    text in ``_corrupt_record``.
    """
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    docs = (
        spark.read.schema(wanted)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    if "date" in docs.columns:
        return docs
    stem = F.regexp_extract(F.col("_metadata.file_name"), DATE_IN_NAME, 1)
    return docs.withColumn("date", F.try_to_date(stem))


def read_document_lines(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """The same for history written as one document part per line; splittable."""
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("date", T.DateType())])
    return spark.read.schema(wanted).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def good_documents(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_documents(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col(CORRUPT).isNotNull()).select("date", CORRUPT)


def document_rows(docs: DataFrame) -> DataFrame:
    """Pricing rows of each document; a document without any gives none."""
    return docs.select("date", F.col("meta.schema_version").alias("schema_version"), F.inline("pricing"))


def schema_by_date(docs: DataFrame) -> DataFrame:
    return docs.groupBy("date").agg(
        F.max(F.coalesce(F.col("meta.schema_version"), F.lit(""))).alias("schema_version")
    )


def read_live(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """One live document, or no rows when it does not exist yet."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_row_artifact(spark: SparkSession, path: str, element: str) -> DataFrame:
    """Rows of files that hold a bare list or an object with ``rows``."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.inline(nested.rows_of_json(F.col("value"), element)))


def read_csv_strings(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """CSV with a header, every column as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(path)


def cast_columns(df: DataFrame, casts: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Typed columns from text. Bad text raises unless ``lenient``."""
    return df.select(*[
        (F.col(c).try_cast(t) if lenient else F.col(c).cast(t)).alias(c) for c, t in casts.items()
    ])


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Database table. Pass partitionColumn, lowerBound, upperBound and
    numPartitions to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def limited(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def staging_views(pricing: DataFrame, usage: DataFrame) -> None:
    """Name the staged tables for SQL; like a view, they are computed when read."""
    pricing.createOrReplaceTempView("stg_pricing")
    usage.createOrReplaceTempView("stg_usage")


def stage_usage(raw: DataFrame) -> DataFrame:
    """Typed session columns from a raw usage table (dataset_id, payload text).

    The payload is parsed once. Times lose their zone, as a cast to a zone-less
    timestamp does; messages stay a variant.
    """
    doc = F.parse_json("payload")
    wanted = {
        "session_id": "string",
        "model": "string",
        "git_branch": "string",
        "start_time": "timestamp_ntz",
        "end_time": "timestamp_ntz",
        "project": "string",
    }
    parsed = raw.filter(F.col("dataset_id").isNotNull()).select("dataset_id", doc.alias("__doc"))
    text = {c: F.variant_get("__doc", f"$.{c}", "string") for c in wanted}
    return parsed.select(
        "dataset_id",
        *[text[c].cast(t).alias(c) for c, t in wanted.items()],
        F.variant_get("__doc", "$.messages", "variant").alias("messages"),
        F.variant_get("__doc", "$.stats.input_tokens", "bigint").alias("input_tokens"),
        F.variant_get("__doc", "$.stats.output_tokens", "bigint").alias("output_tokens"),
    )

