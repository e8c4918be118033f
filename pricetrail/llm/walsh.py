"""Vector codes by product quantization, searched in Walsh-Hadamard order.

A vector is cut into equal parts, each coded by the nearest entry of the codebook of
its position. Parts and entries are filled with zeros to a power of two, n, and
transformed by the integer Walsh-Hadamard matrix with its rows in order of sequency.
The transform multiplies every squared distance by n, so the squared differences of
the coefficients, added up from the lowest sequency on, are an exact lower bound of n
times the distance. After the first coefficients the most promising entry of a part
is finished; entries whose sum is above it are dropped, and again after every further
step. What is left at the end is exact: there is no floating point anywhere, and a
sum that equals the bound is never dropped, so ties go to the lower index.

Training is one pass a round: tasks return sums and counts of the entries they used,
which Spark adds up. The driver holds the codebooks, ``PARTS * ENTRIES`` short vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import query, table
from .vectors import as_matrix, components, pack, unpack, usable

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Coefficients added before the first entries are dropped, then at a time; rows handled at once.
FIRST = 12
REST = 4
ROWS = 256
#: Labels of which no more than this are joined by broadcast.
BROADCAST_LABELS = 100_000


def walsh(rows: np.ndarray) -> np.ndarray:
    """Coefficients of integer rows, filled with zeros to a power of two, by sequency."""
    width = rows.shape[1]
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((len(rows), n), np.int64)
    out[:, :width] = rows
    step = 1
    while step < n:
        pair = out.reshape(len(rows), n // (2 * step), 2, step)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(rows), n)
        step *= 2
    return out[:, sequency(n)]


def sequency(n: int) -> np.ndarray:
    """The row of the natural order that has s sign changes, for s = 0, 1, ..., n - 1:
    the bits of the Gray code of s, reversed."""
    bits = n.bit_length() - 1
    order = np.zeros(n, np.int64)
    for s in range(n):
        gray = s ^ (s >> 1)
        order[s] = int(format(gray, f"0{bits}b")[::-1], 2) if bits else 0
    return order


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part (ties: the lower index) and the squared distance."""
    e = walsh(entries)
    n = e.shape[1]
    index, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    if not len(parts):
        return index, error
    t_all = walsh(parts)
    # 32 bits hold every sum of squares of ordinary vectors; 64 bits hold all.
    widest = int(np.abs(t_all).max()) + int(np.abs(e).max())
    kind = np.int32 if n * widest * widest < 1 << 31 else np.int64
    t_all, e = t_all.astype(kind), e.astype(kind)
    by_sequency = np.ascontiguousarray(e.T)
    head = min(FIRST, n)
    for lo in range(0, len(parts), ROWS):
        t = t_all[lo:lo + ROWS]
        part_sum, step = np.zeros((len(t), len(e)), kind), np.empty((len(t), len(e)), kind)
        for s in range(head):
            np.subtract(t[:, s, None], by_sequency[s], out=step)
            np.multiply(step, step, out=step)
            part_sum += step
        bound = np.square(t - e[part_sum.argmin(axis=1)]).sum(axis=1, dtype=kind)
        kept = np.flatnonzero(part_sum <= bound[:, None])
        row, entry, total, done = kept // len(e), kept % len(e), part_sum.ravel()[kept], head
        while done < n:
            stop = min(n, done + REST)
            total = total + np.square(t[row, done:stop] - e[entry, done:stop]).sum(axis=1, dtype=kind)
            stay = np.flatnonzero(total <= bound[row])
            row, entry, total, done = row[stay], entry[stay], total[stay], stop
        # Rows are in order, the entries of a row too; every row has one at least.
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        best = np.minimum.reduceat(total, start)
        hit = np.flatnonzero(total == best[row])
        first = hit[np.r_[True, row[hit[1:]] != row[hit[:-1]]]]
        index[lo:lo + ROWS], error[lo:lo + ROWS] = entry[first], best // n
    return index, error


def _coded(full: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part of every row, and the errors summed over the parts."""
    parts, _, width = books.shape
    index, error = np.zeros((len(full), parts), np.int64), np.zeros(len(full), np.int64)
    for p in range(parts):
        index[:, p], e = nearest_entries(full[:, p * width:(p + 1) * width].astype(np.int64), books[p])
        error += e
    return index, error


def _round(file: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one assignment of all parts."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            full = unpack(batch.column(0), "<i4", parts * width)
            index, _ = _coded(full, books)
            for p in range(parts):
                by = np.argsort(index[:, p], kind="stable")
                used, start = np.unique(index[by, p], return_index=True)
                if len(used):
                    rows = full[by, p * width:(p + 1) * width].astype(np.int64)
                    sums[p, used] += np.add.reduceat(rows, start, axis=0)
                    counts[p, used] += np.diff(np.append(start, len(by)))
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e], pa.int64()),
             pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], names=["p", "e", "n", "s"])

    partial = file.select("vector").mapInArrow(run, "p int, e int, n long, s array<long>")
    total = partial.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))
    out = books.copy()
    for p, e, n, s in total.collect():
        out[p, e] = np.array(s, dtype=np.int64) // n
    return out


def codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    broadcast_labels: int = BROADCAST_LABELS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    ``embeddings`` is (vec_id, embedding, label). Components are floor(1024 * x). The
    codebook of a part position begins as that part of the ``entries`` smallest vec_ids.
    A code has two hex digits a part, so ``entries`` is 256 at most.

    Defined cases: null vectors and those that hold null or a non-finite number give no
    row; components saturate at 2^24; vectors are filled with zeros to the length of the
    longest, rounded up to whole parts, and empty ones are such vectors; rows that repeat
    a vec_id count each and begin in the order of their components; a null vec_id stays
    null and comes after all others; null labels are one label; fewer than ``entries``
    vectors make smaller codebooks; an entry without parts stays; equal distances go to
    the lower index; an empty table gives no rows. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part")
    spark = embeddings.sparkSession
    schema = "vec_id long, label int, code string, error long"
    kept = embeddings.filter(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        components(F.col("embedding")).alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        out, digest = spark.createDataFrame([], schema), ""
    else:
        width = max(1, -(-longest // parts))
        first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).toArrow()["v"]
        books = as_matrix(first.combine_chunks(), parts * width).astype(np.int64)
        books = books.reshape(-1, parts, width).transpose(1, 0, 2).copy()

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                full = pack(as_matrix(batch.column(2), parts * width))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), full], names=["vec_id", "label", "vector"])

        file = checkpointed(kept.mapInArrow(packed, "vec_id long, label int, vector binary"), "integer_vectors")
        for _ in range(rounds):
            before, books = books, _round(file, books)
            if (before == books).all():
                break

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                index, error = _coded(unpack(batch.column(2), "<i4", parts * width), books)
                code = pa.array([row.tobytes().hex() for row in index.astype(np.uint8)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), code, pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"])

        out = checkpointed(file.mapInArrow(assign, schema), "codes")
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    # Written before it is joined back, so that a hot label can be split.
    labels = checkpointed(
        out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label_errors")
    few = labels.limit(broadcast_labels + 1).count() <= broadcast_labels
    out = out.join(F.broadcast(labels) if few else labels, out["label"].eqNullSafe(labels["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT k.r, k.p, min(list_sum(list_transform(range(1, 17),
  lambda i: (k.v[i] - b.v[i]) * (k.v[i] - b.v[i])))::BIGINT * 256 + b.e) AS best
  FROM parts k JOIN book{r} b USING (p) GROUP BY k.r, k.p)""")
        if r < ROUNDS:
            steps.append(f"""sum{r} AS (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (
  SELECT p, best % 256 AS e, unnest(range(1, 17)) AS i, unnest(v) AS x FROM parts JOIN near{r} USING (r, p)) GROUP BY p, e, i),
book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sum{r} GROUP BY p, e) m USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
parts AS MATERIALIZED (SELECT r, p, list_slice(v, 16 * p + 1, 16 * p + 16) AS v FROM kept, range(4) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= 256),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS d FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


@query("op13_walsh_codes", _sql())
def op13_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector after four rounds."""
    return codes(table(spark, sf_dir, "embeddings"))
