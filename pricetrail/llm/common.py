"""What the operators share: word and white-space rules, tables, safe columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed values of the contracts, as Java patterns.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A-Z become a-z, every other ASCII character outside words a space.
_FOLD = bytearray(range(256))
for _c in range(128):
    if 0x41 <= _c <= 0x5A:
        _FOLD[_c] = _c + 32
    elif not (0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A):
        _FOLD[_c] = 0x20
WORD_FOLD = bytes(_FOLD)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


#: Arrow batches of whole texts, so that a Python task holds a few MB at a time.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch sizes to what texts need; never raise them."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = "".join(c for c in spark.conf.get(key) if c.isdigit())
        if not 0 < int(now or 0) <= most:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(text: str | bytes | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z lower-cased."""
    if text is None:
        return []
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return raw.translate(WORD_FOLD).split()


def utf8(column) -> list[bytes | None]:
    """Values of an Arrow string column as bytes, without decoding."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()


def doc_key(c: Column) -> Column:
    """Identity of a document: its id; rows without an id are one document, after all others."""
    return F.coalesce(c.cast("long"), F.lit(2**63 - 1))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base
