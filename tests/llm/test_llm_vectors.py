"""Clustering and vector codes against plain integer versions."""

import hashlib

import pytest

pytest.importorskip("pricetrail.llm")

import numpy as np  # noqa: E402

from pricetrail.llm import vafile, vectors, walsh  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, code int, v string"
INF = float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, "y") for i, v, l in rows], SCHEMA)


def made(n, dims, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (5, dims))
    return (centres[rng.integers(0, 5, n)] + rng.normal(0, 0.3, (n, dims))).astype(np.float32)


def integers(v):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in v]


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def plain_clusters(rows, dims, k=8, rounds=10):
    """Every vector against every centroid, in Python integers."""
    rows = [(i, integers(v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(((name(i), v) for i, v in rows))[:k]]

    def assign():
        return [min((squared(v, c), j) for j, c in enumerate(centroids)) for _, v in rows]

    for _ in range(rounds):
        of = [j for _, j in assign()]
        for j in range(len(centroids)):
            mine = [v for (_, v), a in zip(rows, of) if a == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = assign()
    inertia = {j: sum(d for d, a in last if a == j) for j in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(rows, last))


def got_clusters(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


@pytest.mark.parametrize("dims,spread", [(64, 1.0), (64, 0.01), (5, 1.0)])
def test_clusters_equal_all_distances(spark, dims, spread):
    rows = list(enumerate(made(300, dims, spread=spread).tolist()))
    got = vafile.cluster(frame(spark, [(i, v, None) for i, v in rows]).repartition(5), dims=dims)
    assert got_clusters(got) == plain_clusters(rows, dims)


def test_clusters_of_awkward_rows(spark):
    v = made(40, 64).tolist()
    bad = [None, [], v[0][:63], v[0] + [0.0], [None, *v[0][1:]], [float("nan"), *v[0][1:]], [INF, *v[0][1:]], [-INF, *v[0][1:]]]
    rows = [*enumerate(v), (3, v[3]), (3, v[7]), (None, v[9]), (None, v[10]), *[(900 + i, x) for i, x in enumerate(bad)]]
    # A third of all rows is one vector; ties with every copy of it.
    rows += [(100 + i, v[0]) for i in range(25)]
    got = vafile.cluster(frame(spark, [(i, x, None) for i, x in rows]))
    assert len(set(got.columns)) == len(got.columns)
    assert got_clusters(got) == plain_clusters(rows, 64)


def test_few_and_no_vectors(spark):
    v = made(3, 64).tolist()
    rows = list(enumerate(v))
    assert got_clusters(vafile.cluster(frame(spark, [(i, x, None) for i, x in rows]))) == plain_clusters(rows, 64)
    none = vafile.cluster(frame(spark, []))
    assert none.collect() == [] and none.columns == vafile.cluster(frame(spark, [(1, v[0], 1)])).columns
    # All alike: every distance ties, and goes to the first centroid.
    same = [(i, v[0]) for i in range(20)]
    assert got_clusters(vafile.cluster(frame(spark, [(i, x, None) for i, x in same]))) == plain_clusters(same, 64)


def test_cells_bound_distances():
    """Intervals hold the distance, outliers included, and most vectors need no fetch."""
    full = np.floor(made(2000, 64) * 1024).astype(np.int32)
    full[7, 3] = vectors.LIMIT
    grid = vafile.Grid(full[:500], full.min(axis=0).astype(np.int64), full.max(axis=0).astype(np.int64))
    centroids = full[[1, 50, 99, 3, 8]].astype(np.int64)
    tables, cells = grid.tables(centroids), grid.cells(full)
    bounds = sum(tables[i].take(cells[:, i], axis=0) for i in range(cells.shape[1]))
    exact = ((full[:, None, :].astype(np.int64) - centroids[None]) ** 2).sum(axis=2)
    assert (bounds[:, :5] <= exact).all() and (exact <= bounds[:, 5:]).all()
    to, fetched = vafile.nearest(cells, full, tables, centroids)
    assert (to == exact.argmin(axis=1)).all() and fetched < 1600


def test_packed_rows():
    import pyarrow as pa

    m = np.arange(12, dtype=np.int32).reshape(4, 3)
    packed = vectors.pack(m)
    assert (vectors.unpack(packed, "<i4", 3) == m).all()
    assert (vectors.unpack(packed.slice(1, 2), "<i4", 3) == m[1:3]).all()
    assert vectors.unpack(packed.slice(0, 0), "<i4", 3).shape == (0, 3)
    ragged = pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int32()))
    assert vectors.as_matrix(ragged, 3).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]]


def plain_codes(rows, width, k=256, rounds=4):
    rows = [(i, integers(v), l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, v + [0] * (4 * width - len(v)), l) for i, v, l in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in rows[:k]] for p in range(4)]

    def assign():
        return [[min((squared(cut(v, p), e), j) for j, e in enumerate(books[p])) for p in range(4)] for _, v, _ in rows]

    for _ in range(rounds):
        of = assign()
        for p in range(4):
            groups = {}
            for (_, v, _), a in zip(rows, of):
                groups.setdefault(a[p][1], []).append(cut(v, p))
            for j, g in groups.items():
                books[p][j] = [sum(x) // len(g) for x in zip(*g)]
    last = assign()
    labels = {}
    for (_, _, l), a in zip(rows, last):
        labels[l] = labels.get(l, 0) + sum(d for d, _ in a)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{j:02x}" for _, j in a), sum(d for d, _ in a), labels[l], sha) for (i, _, l), a in zip(rows, last))


def got_codes(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def test_codes_equal_all_distances(spark):
    v = made(320, 20).tolist()
    rows = [(i, x, [None, 1, 2][i % 3]) for i, x in enumerate(v)]
    assert got_codes(walsh.codes(frame(spark, rows).repartition(4))) == plain_codes(rows, 5)
    # Labels too many for a broadcast are joined by a shuffle.
    assert got_codes(walsh.codes(frame(spark, rows), broadcast_labels=1)) == plain_codes(rows, 5)


def test_codes_of_awkward_rows(spark):
    v = made(30, 16).tolist()
    rows = [(i, x, i % 2) for i, x in enumerate(v)]
    rows += [(3, v[3], 1), (3, v[5], None), (None, v[6], 0), (50, v[0][:7], 1), (51, [], 1), (52, None, 1)]
    rows += [(53, [None, *v[0][1:]], 1), (54, [float("nan"), *v[0][1:]], 1), (55, [INF, *v[0][1:]], 1)]
    rows += [(60 + i, v[0], None) for i in range(20)]
    got = walsh.codes(frame(spark, rows))
    assert len(set(got.columns)) == len(got.columns)
    assert got_codes(got) == plain_codes(rows, 4)
    none = walsh.codes(frame(spark, []))
    assert none.collect() == [] and none.columns == got.columns
    assert walsh.codes(frame(spark, [(1, [], 1)])).count() == 1


def test_transform_keeps_distances_and_order():
    rng = np.random.default_rng(3)
    for width in (1, 2, 5, 16, 31):
        a = rng.integers(-5000, 5000, (2, width))
        t = walsh.walsh(a)
        assert t.shape[1] * ((a[0] - a[1]) ** 2).sum() == ((t[0] - t[1]) ** 2).sum()
    rows = np.array([walsh.walsh(np.eye(16, dtype=np.int64)[i:i + 1])[0] for i in range(16)]).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(16))


def test_nearest_entries_with_ties_and_limits():
    rng = np.random.default_rng(4)
    entries = rng.integers(-3, 3, (256, 16))
    entries[200:] = entries[:56]
    parts = np.concatenate([rng.integers(-3, 3, (3000, 16)), entries])
    exact = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    index, error = walsh.nearest_entries(parts, entries)
    assert (index == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()
    far = np.full((1, 16), vectors.LIMIT)
    index, error = walsh.nearest_entries(-far, far)
    assert index[0] == 0 and error[0] == 16 * (2 * vectors.LIMIT) ** 2
