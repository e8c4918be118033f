"""Centroid clustering over a vector approximation file.

Every vector is written once with its approximation: ``CELL_BITS`` bits a dimension
that name the cell of a grid in which the component lies. For a centroid, the cell of
a dimension gives the least and the largest possible squared difference; sums of
these, looked up for two dimensions at a time, are an interval that holds the
distance. A vector whose smallest interval meets no other one is assigned from its
cells alone. The full vector is fetched only where intervals overlap, and where a
vector changes its cluster and so the sums of two centroids.

A round is one pass over the file: tasks return the changes of sums and counts,
which Spark adds up. A task needs no state of the round before, only both sets of
centroids, so a lost executor costs its tasks and nothing else. The driver holds the
centroids, ``k`` vectors. All arithmetic is in integers.

The grid is equal steps between the 0.5 and 99.5 percentiles of the ``GRID_ROWS``
rows with the smallest hash; the outer cells reach to the exact least and largest
component. A poor grid costs fetches, never a result.
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

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
CELL_BITS = 4
GRID_ROWS = 4096
CELLS = 1 << CELL_BITS


class Grid:
    """The bounds of the cells: row d holds the CELLS + 1 edges of dimension d, ends included."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray):
        first, last = np.percentile(sample, [0.5, 99.5], axis=0)
        inner = np.floor(first[:, None] + (last - first)[:, None] * np.arange(CELLS - 1) / (CELLS - 2)).astype(np.int64)
        self.inner = inner
        # Cell i holds inner[i - 1] <= x < inner[i], so its largest integer is inner[i] - 1.
        self.low = np.concatenate([low[:, None], inner], axis=1)
        self.high = np.concatenate([inner - 1, high[:, None]], axis=1)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Packed cells: one byte for two dimensions, the odd one in the upper bits."""
        dims = vectors.shape[1]
        out = np.zeros((len(vectors), dims + dims % 2), np.uint8)
        for d in range(dims):
            out[:, d] = np.searchsorted(self.inner[d], vectors[:, d], side="right")
        return out[:, 0::2] | (out[:, 1::2] << np.uint8(CELL_BITS))

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """[byte position, byte, centroid and then centroid again]: least, then largest squared differences."""
        c = centroids.T[:, None, :]
        below, above = self.low[:, :, None] - c, c - self.high[:, :, None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        both = np.concatenate([least, most], axis=2)
        if len(both) % 2:
            both = np.concatenate([both, np.zeros_like(both[:1])])
        byte = np.arange(1 << (2 * CELL_BITS))
        return both[0::2][:, byte & (CELLS - 1)] + both[1::2][:, byte >> CELL_BITS]


def nearest(cells: np.ndarray, vectors: np.ndarray, tables: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest centroid of every row (ties: the smaller number), and how many vectors were fetched."""
    k = len(centroids)
    bounds = np.zeros((len(cells), 2 * k), np.int64)
    for i in range(cells.shape[1]):
        bounds += tables[i].take(cells[:, i], axis=0)
    least, most = bounds[:, :k], bounds[:, k:]
    near = least <= most.min(axis=1)[:, None]
    out = near.argmax(axis=1)
    open_rows = np.flatnonzero(near.sum(axis=1) > 1)
    if len(open_rows):
        full = vectors[open_rows].astype(np.int64)
        best = np.full(len(full), np.iinfo(np.int64).max)
        for c in range(k):
            rows = np.flatnonzero(near[open_rows, c])
            d = ((full[rows] - centroids[c]) ** 2).sum(axis=1)
            better = d < best[rows]
            best[rows[better]] = d[better]
            out[open_rows[rows[better]]] = c
    return out, len(open_rows)


def approximated(vectors: DataFrame, dims: int) -> tuple[DataFrame, Grid | None]:
    """(vec_id, cells, vector) written once, and its grid; ``vectors`` is (vec_id, v)."""
    ranges = vectors.select(F.posexplode("v")).groupBy("pos").agg(F.min("col"), F.max("col")).collect()
    if not ranges:
        return vectors.select("vec_id", F.lit(b"").alias("cells"), F.lit(b"").alias("vector")), None
    ranges = np.array(sorted(map(tuple, ranges)), dtype=np.int64)
    sample = vectors.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(GRID_ROWS).select("v").toArrow()["v"]
    grid = Grid(as_matrix(sample.combine_chunks(), dims), ranges[:, 1], ranges[:, 2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = as_matrix(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pack(grid.cells(full)), pack(full)], names=["vec_id", "cells", "vector"])

    return checkpointed(vectors.mapInArrow(run, "vec_id long, cells binary, vector binary"), "approximation"), grid


def _changes(file: DataFrame, grid: Grid, now: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """What the sums and counts of the clusters gain from one assignment to the next."""
    k, dims = now.shape
    width = (dims + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.zeros((k, dims + 1), np.int64)
        new = grid.tables(now)
        old = None if before is None else grid.tables(before)
        for batch in batches:
            cells, full = unpack(batch.column(0), "u1", width), unpack(batch.column(1), "<i4", dims)
            to, _ = nearest(cells, full, new, now)
            moved = np.arange(len(to))
            if old is not None:
                since, _ = nearest(cells, full, old, before)
                moved = np.flatnonzero(to != since)
            rows = full[moved].astype(np.int64)
            for c in range(k):
                into = to[moved] == c
                gain[c, 0] += into.sum()
                gain[c, 1:] += rows[into].sum(axis=0)
                if old is not None:
                    out = since[moved] == c
                    gain[c, 0] -= out.sum()
                    gain[c, 1:] -= rows[out].sum(axis=0)
        c, d = np.nonzero(gain)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(gain[c, d], pa.int64())], names=["c", "d", "x"])

    parts = file.select("cells", "vector").mapInArrow(run, "c int, d int, x long")
    total = np.zeros((k, dims + 1), np.int64)
    for c, d, x in parts.groupBy("c", "d").agg(F.sum("x")).collect():
        total[c, d] = x
    return total[:, 1:], total[:, 0]


def cluster(
    embeddings: DataFrame, dims: int = DIMENSIONS, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    ``embeddings`` is (vec_id, embedding). Vectors of exactly ``dims`` finite
    components are kept, each component as floor(1024 * x). The centroids begin as
    the ``k`` kept vectors with the smallest sha256 of ``seed:vec_id``.

    Defined cases: null vectors, those of another length and those that hold null or a
    non-finite number give no row; components saturate at 2^24; rows that repeat a
    vec_id count each, and begin in the order of their components where the hash is
    equal; a null vec_id stays null and is hashed as ``null``; fewer than ``k`` vectors
    make fewer centroids; equal distances go to the smaller number; an empty cluster
    keeps its centroid; an empty table gives no rows. Other columns are not read.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    vectors = vectors.filter(usable(F.col("v")) & (F.size("v") == dims)).select("vec_id", components(F.col("v")).alias("v"))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = vectors.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long"
    if first:
        now = np.array([r["v"] for r in first], dtype=np.int64)
        file, grid = approximated(vectors, dims)
        before, sums, counts = None, np.zeros_like(now), np.zeros(len(now), np.int64)
        for _ in range(rounds):
            gained, more = _changes(file, grid, now, before)
            sums, counts = sums + gained, counts + more
            moved = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], now)
            before, now, same = now, moved, bool((moved == now).all())
            if same:
                break

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = grid.tables(now)
            for batch in batches:
                cells, full = unpack(batch.column(1), "u1", (dims + 1) // 2), unpack(batch.column(2), "<i4", dims)
                to, _ = nearest(cells, full, tables, now)
                distance = ((full.astype(np.int64) - now[to]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(to, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])

        out = checkpointed(file.mapInArrow(assign, schema), "clusters")
        digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    else:
        out, digests = spark.createDataFrame([], schema), []
    # One row a cluster, so at most k.
    inertia = {r["cluster"]: r["x"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("x")).collect()}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), d) for c, d in enumerate(digests)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT k.r, min(list_sum(list_transform(range(1, 65),
  lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT * 8 + c.c) AS best FROM kept k, cen{r} c GROUP BY k.r),
at{r} AS MATERIALIZED (SELECT k.vec_id, k.v, (best % 8)::INTEGER AS c, best // 8 AS distance FROM kept k JOIN near{r} USING (r))""")
        if r < ROUNDS:
            steps.append(f"""sum{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
  SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM at{r}) GROUP BY c, i),
cen{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM cen{r} c LEFT JOIN (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sum{r} GROUP BY c) m USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64),
cen0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept
  ORDER BY sha256('3:' || vec_id), v LIMIT 8),
{", ".join(steps)}
SELECT vec_id, a.c AS cluster, distance, sum(distance) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM at{ROUNDS} a JOIN cen{ROUNDS} f USING (c)
"""


@query("op12_vafile", _sql())
def op12_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds."""
    return cluster(table(spark, sf_dir, "embeddings"))
