"""Chunked ordered operators against plain windows, with hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetrail.operators import history as h
from pricetrail.operators import ordered as o


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, in bursts; some values are null; one key is null."""
    rnd = random.Random(5)
    data = []
    for i in range(4000):
        hot = rnd.random() < 0.7
        key = 0 if hot else rnd.choice([None, 1, 2, 3, 4])
        t = int(rnd.random() ** 3 * 10_000) if rnd.random() < 0.8 else rnd.choice([None, *range(9)])
        data.append((key, t, i, None if rnd.random() < 0.3 else rnd.randrange(50)))
    return spark.createDataFrame(data, "k int, t int, id int, v int").cache()


@pytest.mark.parametrize("chunk", [7, 60, 10_000])
def test_running_sum_equals_window(skewed, chunk):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.s for r in skewed.withColumn("s", F.when(F.col("v").isNotNull(), F.sum("v").over(w))).collect()}
    got = o.running_sum(skewed, ["k"], ["t", "id"], "v", "s", chunk, total="all")
    rows = got.collect()
    assert len(rows) == 4000
    assert {r.id: r.s for r in rows} == want
    totals = {r.k: r.n for r in skewed.groupBy("k").agg(F.sum("v").alias("n")).collect()}
    assert {r.k: r["all"] for r in rows} == totals


@pytest.mark.parametrize("chunk", [7, 60, 10_000])
def test_carry_last_equals_window(skewed, chunk):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r.id: r.c for r in skewed.withColumn("c", F.last("v", True).over(w)).collect()}
    got = {r.id: r.c for r in o.carry_last(skewed, ["k"], ["t", "id"], "v", "c", chunk).collect()}
    assert got == want


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_exact_quantiles_equal_percentile(skewed, chunk):
    probs = {"q0": 0.0, "q25": 0.25, "median": 0.5, "q90": 0.9, "q100": 1.0}
    got = {r.k: tuple(r[n] for n in probs) for r in o.exact_quantiles(skewed, ["k"], "v", probs, chunk).collect()}
    want = skewed.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, probs.values()))).alias("p"))
    for r in want.collect():
        assert got[r.k] == pytest.approx(tuple(r.p))


def test_hot_keys_are_cut(skewed):
    cut = o.with_chunks(skewed, ["k"], "t", 100)
    sizes = cut.groupBy("k", o.CHUNK).count().collect()
    hot = [r["count"] for r in sizes if r.k == 0]
    assert len(hot) > 20
    assert all(r[o.CHUNK] == 0 for r in o.with_chunks(skewed, ["k"], "t").select(o.CHUNK).distinct().collect())


def test_chunks_are_even_whatever_the_order_values(spark):
    """An outlier, a log-normal measure and a single value: no chunk is far above its size."""
    rnd = random.Random(2)
    data = [(0, 0.5 if i else 1e12, rnd.lognormvariate(0, 3), 7.0, i) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, outlier double, skewed double, same double, id int").cache()
    for order in ("outlier", "skewed", "same"):
        cut = o.with_chunks(df, ["k"], [order, "id"], 500)
        sizes = [r["count"] for r in cut.groupBy(o.CHUNK).count().collect()]
        assert sum(sizes) == 6000 and max(sizes) <= 1000, (order, sorted(sizes)[-3:])
        got = o.running_sum(df, ["k"], [order, "id"], "id", "s", 500).select(order, "id", "s").collect()
        total = 0
        for r in sorted(got, key=lambda r: (r[order], r.id)):
            total += r.id
            assert r.s == total


@pytest.mark.parametrize("chunk", [5, 10_000])
def test_asof_join_against_brute_force(spark, chunk):
    rnd = random.Random(11)
    facts = [(rnd.choice([0, 0, 0, 1, 2]), rnd.randrange(300), i, i * 10) for i in range(400)]
    prices = [(rnd.choice([0, 0, 1]), rnd.randrange(300), i, rnd.randrange(1000)) for i in range(150)]
    f = spark.createDataFrame(facts, "k int, t int, ord int, n int")
    p = spark.createDataFrame(prices, "k int, t int, ord int, price int")
    for strict in (False, True):
        got = {
            r.ord: r.paid
            for r in h.asof_join(f, p, ["k"], "t", "price", "paid", "ord", strict, chunk).collect()
        }
        for k, t, i, _ in facts:
            known = [(pt, po, v) for pk, pt, po, v in prices if pk == k and (pt < t if strict else pt <= t)]
            assert got[i] == (max(known)[2] if known else None)


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), (None, 2, "z"), (None, 5, "w")], "k string, ord int, v string")
    assert {(r.k, r.v) for r in o.last_wins(df, ["k"], ["ord"]).collect()} == {("a", "y"), (None, "w")}
    assert {(r.k, r.v) for r in o.first_wins(df, ["k"], ["ord"]).collect()} == {("a", "x"), (None, "z")}


def test_timestamps_and_dates_keep_their_order(spark):
    df = spark.sql("""
        SELECT 1 AS k, id, timestamp_ntz'2024-03-31 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, CAST(id * 977.5 AS DECIMAL(18, 6))) AS ts,
          date_add(date'2024-01-01', CAST(id AS INT)) AS day FROM range(500)""")
    for order in ("ts", "day"):
        got = o.running_sum(df, ["k"], [order, "id"], "id", "s", 20).collect()
        assert all(r.s == r.id * (r.id + 1) // 2 for r in got)
    with pytest.raises(TypeError):
        o.running_sum(df.withColumn("x", F.col("id").cast("string")), ["k"], ["x"], "id", "s")


def test_results_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("""
        SELECT 0 AS k, id, timestamp_ntz'2024-10-27 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT)) AS ts FROM range(300)""")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = o.running_sum(df, ["k"], ["ts", "id"], "id", "s", 10).collect()
            assert all(r.s == r.id * (r.id + 1) // 2 for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_positions_follow_a_total_order(spark, rows):
    import random

    values = [(random.Random(i).randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(values, "v int, number int").repartition(9)
    out = rows(o.positions(df, [F.col("v").desc(), F.col("number")]))
    assert [(r["v"], r["number"]) for r in sorted(out, key=lambda r: r["position"])] == sorted(values, key=lambda x: (-x[0], x[1]))
    assert sorted(r["position"] for r in out) == list(range(3000))
    plan = o.positions(df, [F.col("v")])._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert rows(o.positions(df.limit(0), [F.col("v")])) == []
