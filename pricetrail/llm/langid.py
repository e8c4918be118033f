"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of each language inside the tasks, Spark sums the
sparse counts, and the log-probability matrix (buckets x languages, of fixed size
but for the number of languages) is broadcast. Scoring turns the texts of a batch into
one sparse matrix of bucket counts (text, bucket, n) and multiplies it with the
log-probability matrix in numpy.
"""

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, query, small_batches, table, utf8

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
ALPHA = 0.5
#: More distinct labels than this are taken for an error in the label column.
MAX_LANGUAGES = 1000
#: In the score, a text and the prior count as so many n-grams at most, so that the
#: score of a long text stays a usable confidence. The language is that of all n-grams.
EVIDENCE = 30
#: Characters handled at once, in training and in scoring.
CHUNK = 1 << 20
GROUP = 1 << 17
#: Cells of a product held at once.
CELLS = 1 << 20

UNKNOWN = "und"

_MUL = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)
_LETTERS = re.compile(rb"[A-Za-z]")
#: ASCII: letters in lower case, all else one kind of gap.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(raw: bytes) -> bool:
    if _LETTERS.search(raw):
        return True
    return not raw.isascii() and any(map(str.isalpha, raw.decode("utf-8", "replace")))


def _codes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.translate(_FOLD).decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)


def _grams(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, the buckets of the n-grams that begin at each character."""
    key = np.zeros(len(codes), np.uint32)
    for order in ORDERS[:len(codes)]:
        n = len(codes) - order + 1
        key = (key[:n] + codes[order - 1:]) * _MUL[order - 1]
        key ^= key >> np.uint32(15)
        yield order, (key * _MUL[0]) >> np.uint32(32 - BUCKET_BITS)


def gram_counts(raw: bytes) -> np.ndarray:
    """Counts of the hashed character n-grams of a whole text."""
    codes = _codes(raw)
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(codes), CHUNK):
        for _, buckets in _grams(codes[lo:lo + CHUNK + ORDERS[-1] - 1]):
            counts += np.bincount(buckets[:CHUNK], minlength=BUCKETS)
    return counts


def sparse_counts(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The n-gram counts of a batch as sparse rows (text, bucket, n), sorted, in parts.

    A part holds about ``GROUP`` characters: many short texts, or a piece of a long
    one, which then has rows in several parts.
    """
    pieces: list[tuple[int, np.ndarray]] = []
    held = 0
    for at, raw in enumerate(texts):
        codes = _codes(raw)
        for lo in range(0, len(codes), GROUP):
            part = codes[lo:lo + GROUP + ORDERS[-1] - 1]
            if pieces and held + len(part) > GROUP:
                yield _sparse(pieces)
                pieces, held = [], 0
            pieces.append((at, part))
            held += len(part)
    if pieces:
        yield _sparse(pieces)


def _sparse(pieces: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = np.array([at for at, _ in pieces])
    sizes = np.array([len(part) for _, part in pieces])
    piece = np.repeat(np.arange(len(pieces), dtype=np.int64), sizes)
    # What follows a piece of a long text is read for its last n-grams only.
    begins = np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < GROUP
    cells = []
    for order, buckets in _grams(np.concatenate([part for _, part in pieces])):
        n = len(buckets)
        inside = (piece[:n] == piece[order - 1:]) & begins[:n]
        cells.append((piece[:n][inside] << BUCKET_BITS) | buckets[inside])
    cell, n = np.unique(np.concatenate(cells), return_counts=True)
    return texts[cell >> BUCKET_BITS], cell & (BUCKETS - 1), n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for raw, lang in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            if raw is not None and has_letter(raw):
                own = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                own[:-1] += gram_counts(raw)
                own[-1] += 1  # documents
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
            names=["lang", "bucket", "n"])


class LanguageModel:
    """Languages in order, the log prior of each, and log P(bucket | language)."""

    def __init__(self, languages: list[str], prior: np.ndarray, logp: np.ndarray):
        self.languages, self.prior, self.logp = languages, prior, logp

    def predict(self, texts: Sequence[bytes | None]) -> list[tuple[str, float, float]]:
        """The language of each text of a batch, its score and its posterior."""
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        known = [i for i, raw in enumerate(texts) if self.languages and raw is not None and has_letter(raw)]
        if not known:
            return out
        loglik = np.tile(self.prior, (len(known), 1))
        grams = np.zeros(len(known))
        step = max(1, CELLS // len(self.languages))
        for text, bucket, n in sparse_counts([texts[i] for i in known]):
            for lo in range(0, len(n), step):
                row, count = text[lo:lo + step], n[lo:lo + step]
                product = self.logp[bucket[lo:lo + step]] * count[:, None].astype(np.float64)
                first = np.flatnonzero(np.diff(row, prepend=-1))
                loglik[row[first]] += np.add.reduceat(product, first, axis=0)
                grams[row[first]] += np.add.reduceat(count, first)
        best = loglik.argmax(axis=1)
        below = loglik - loglik.max(axis=1, keepdims=True)
        scaled = below * np.minimum(1.0, EVIDENCE / grams)[:, None]
        score, posterior = (1 / np.exp(x).sum(axis=1) for x in (scaled, below))
        for at, i in enumerate(known):
            out[i] = self.languages[best[at]], float(score[at]), float(posterior[at])
        return out


def train(docs: DataFrame) -> LanguageModel:
    """A model of all rows of ``docs`` (text, lang) with a label and a letter."""
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        _count, "lang string, bucket int, n long")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages, row, bucket, n = [], [], [], []
    for batch in sums.sort("lang").toLocalIterator():
        if not languages or languages[-1] != batch[0]:
            languages.append(batch[0])
            if len(languages) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        row.append(len(languages) - 1)
        bucket.append(batch[1])
        n.append(batch[2])
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[row, bucket] = n
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    prior = np.log(counts[:, -1] / counts[:, -1].sum())
    grams = counts[:, :-1] + ALPHA
    logp = np.log(grams / grams.sum(axis=1, keepdims=True)).T
    return LanguageModel(languages, prior, logp.astype(np.float32))


def language(docs: DataFrame, model: LanguageModel) -> Column:
    """The (lang_pred, score, posterior) of the texts of ``docs``, by the broadcast model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, posterior double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            rows = own.predict([None if t is None else t.encode("utf-8", "replace") for t in texts])
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "posterior"])

    # A filter on the result must not have it computed a second time below.
    return predict.asNondeterministic()(docs["text"].cast("string"))


def held_out() -> Column:
    """Whether a document is kept from training; one without an id is not."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred, score and posterior; a model of the rows not held out.

    The posterior of the predicted language is that of all n-grams; for the score,
    evidence and prior are scaled to ``EVIDENCE`` n-grams. Input columns of these four
    names are replaced.

    Defined cases: null text, or text without a letter, is ``und`` with both 0; so
    is every text if no row can be learned from; ties go to the first language in
    code-point order; repeated rows count each; n-grams of long texts are counted
    in pieces, over the whole text.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("held_out", "lang_pred", "score", "posterior")
    model = train(docs.filter(~held_out()).select("text", "lang"))
    found = free_name(docs, "found")
    rows = docs.withColumn(found, language(docs, model)).withColumn("held_out", held_out())
    return rows.select(*docs.columns, "held_out", f"{found}.lang_pred", f"{found}.score", f"{found}.posterior")


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """The language of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
