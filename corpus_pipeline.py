"""A training-data pipeline of five of the operators, each stage a filter or a mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again before the next one. All but the last return the columns of documents.
No SQL: the language model and the near copies can't be stated in it.

Defined cases, for every stage: an empty table gives an empty one; columns other than
those of documents are dropped, whatever their names; a null lang or source is a value
of its own; rows without a doc_id, or that repeat one, are judged by their own text and
stay rows of their own; equal texts tie by the smallest doc_id, rows without one last;
very long texts are handled whole. Null texts, and those without a letter, end at the
first stage; later stages given one keep it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.llm.common import NOT_SPACE, table
from pricetrail.llm.decontam import contamination
from pricetrail.llm.langid import UNKNOWN, identify
from pricetrail.llm.linededup import dedup_lines
from pricetrail.llm.mixing import mix, taken
from pricetrail.llm.neardup import distinct_documents
from pricetrail.session import checkpointed

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose language has a smaller posterior than this is rejected.
MIN_LANGUAGE_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is recognised; a missing lang is filled in."""
    rows = identify(docs.select(*COLUMNS))
    known = F.col("lang_pred") != UNKNOWN
    rows = rows.filter(F.col("text").rlike(r"\p{L}") & (~known | (F.col("posterior") >= MIN_LANGUAGE_SCORE)))
    return rows.withColumn("lang", F.coalesce("lang", F.when(known, F.col("lang_pred")))).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of earlier ones; those that lose all they had go."""
    rows = dedup_lines(docs.select(*COLUMNS))
    rows = rows.filter((F.col("n_dropped") == 0) | F.col("text").rlike(NOT_SPACE))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies."""
    return distinct_documents(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark phrase occurs."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS[1:])
    return found.filter(F.size("spans") == 0).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", taken("draws").alias("taken"))


STAGES = [
    ("language", keep_languages),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
