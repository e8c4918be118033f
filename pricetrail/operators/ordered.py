"""Ordered operators that stay balanced when one key holds most of the rows.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. The operators
here cut only the *hot* keys (more than ``rows_per_chunk`` rows) into chunks that
follow the order columns, run the window inside each chunk, and add what came
before from a table with one row per chunk:

    rows --(keys, chunk)--> window ---+
                                      +--> result
    rows --partial agg--> one row per chunk --window over chunks--+

Chunks are of equal depth: their bounds are quantiles of the key's own order
values. A value so frequent that it fills chunks alone gets a chunk of its own,
which is cut again by the next order column, and so on; only rows that tie in
every order column stay together. Bounds are found once and written, so both
branches see the same chunks.

Without hot keys (one narrow count finds out) nothing is cut and the plan is the
plain window. Lists of hot keys and cells have at most ``rows / rows_per_chunk``
entries, whatever the number of keys, so they are broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed

ROWS_PER_CHUNK = 2_000_000
CHUNK = "__chunk"
HOT = "__hot"


def _orderable(df: DataFrame, name: str) -> bool:
    """Whether quantiles of a column can bound chunks."""
    kinds = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(df.schema[name].dataType, kinds)


def _match(names: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of columns with their renamed copies."""
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{prefix}{n}"))
    return same


def _big(df: DataFrame, by: Sequence[str], least: int) -> tuple[DataFrame, int]:
    """Groups of more than ``least`` rows as renamed columns, and the largest size."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > least)
    big = checkpointed(sizes.select(*[F.col(c).alias(f"__g_{c}") for c in by], "__n"), "hot_keys")
    return big.drop("__n"), big.agg(F.max("__n")).first()[0] or 0


def with_chunks(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``__hot`` and ``__chunk``: 0 for ordinary keys, an order-preserving slice for hot ones.

    A level numbers the cells of one order column: 0 for nulls, even for a value
    that is itself a bound, odd for what lies between two bounds. Only cells of
    one value may be cut by the next column.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    if not _orderable(df, order[0]):
        raise TypeError(f"order column {order[0]} must be a number, date or timestamp")
    hot, most = _big(df.select(*keys), keys, rows_per_chunk)
    if not most:
        return df.withColumns({HOT: F.lit(False), CHUNK: F.lit(0).cast("long")})
    marked = hot.withColumn("__g_hot", F.lit(True))
    out = df.join(F.broadcast(marked), _match(keys, "__g_"), "left")
    out = out.withColumns({HOT: F.coalesce("__g_hot", F.lit(False)), CHUNK: F.lit(0).cast("long")})
    out = out.drop("__g_hot", *[f"__g_{k}" for k in keys])
    cells, by = hot.withColumn(f"__g_{CHUNK}", F.lit(0).cast("long")), [*keys, CHUNK]
    for level, column in enumerate(order):
        if not _orderable(df, column):
            break
        if level:
            inside = out.filter(F.col(HOT) & (F.col(CHUNK) % 2 == 0))
            cells, most = _big(inside.select(*by), by, 2 * rows_per_chunk)
            if not most:
                break
        parts = 2 * math.ceil(most / rows_per_chunk)
        probs = [i / parts for i in range(1, parts)]
        inside = out.select(*by, column).join(F.broadcast(cells), _match(by, "__g_"), "left_semi")
        bounds = inside.groupBy(*by).agg(
            F.array_distinct(F.percentile_approx(column, probs, max(10_000, 20 * parts))).alias("__b"))
        bounds = checkpointed(bounds.select(*[F.col(c).alias(f"__g_{c}") for c in by], "__b"), "chunk_bounds")
        value = F.col(column)
        upto = F.size(F.filter("__b", lambda b: b <= value))
        cell = F.when(value.isNull(), 0).otherwise(1 + 2 * upto - F.array_contains("__b", value).cast("int"))
        out = out.join(F.broadcast(bounds), _match(by, "__g_"), "left")
        # Every level makes room below each chunk; a cell that is not cut keeps its parity.
        room = 2 * (parts + 1)
        out = out.withColumn(CHUNK, F.col(CHUNK) * room + F.coalesce(F.when(F.col("__b").isNotNull(), cell), F.col(CHUNK) % 2))
        out = out.drop("__b", *[f"__g_{c}" for c in by])
    return out


def _join_offsets(df: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-chunk offsets; only hot keys have any."""
    renamed = offsets.select(
        *[F.col(k).alias(f"__o_{k}") for k in keys],
        F.col(CHUNK).alias("__o_chunk"),
        *[c for c in offsets.columns if c not in (*keys, CHUNK)],
    )
    condition = F.col(CHUNK).eqNullSafe(F.col("__o_chunk"))
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    return df.join(renamed, condition, "left").drop("__o_chunk", *[f"__o_{k}" for k in keys])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    total: str | None = None,
) -> DataFrame:
    """Running sum per key; a null value stays null and adds nothing.

    With ``total`` the sum over the whole key is added too.
    """
    cut = with_chunks(df, keys, order, rows_per_chunk)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (
        cut.filter(HOT)
        .groupBy(*keys, CHUNK)
        .agg(F.sum(value).alias("__sum"))
        .withColumn("__before", F.sum("__sum").over(before))
        .withColumn("__total", F.sum("__sum").over(whole))
        .drop("__sum")
    )
    inner = Window.partitionBy(*keys, CHUNK)
    upto = inner.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = cut.withColumn("__inside", F.sum(value).over(upto))
    if total:
        done = done.withColumn("__all", F.sum(value).over(inner))
    joined = _join_offsets(done, offsets, keys)
    zero = F.lit(0).cast(done.schema["__inside"].dataType)
    joined = joined.withColumn(
        out,
        F.when(F.col(value).isNotNull(), F.col("__inside") + F.coalesce(F.col("__before"), zero)),
    )
    if total:
        joined = joined.withColumn(total, F.coalesce(F.col("__total"), F.col("__all"))).drop("__all")
    return joined.drop("__inside", "__before", "__total", CHUNK, HOT)


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Last non-null ``value`` at or before each row, within its key."""
    cut = with_chunks(df, keys, order, rows_per_chunk)
    known = F.col(value).isNotNull()
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.filter(HOT)
        .groupBy(*keys, CHUNK)
        .agg(F.max_by(F.col(value), F.when(known, F.struct(*order))).alias("__last"))
        .withColumn("__carried", F.last("__last", ignorenulls=True).over(before))
        .drop("__last")
    )
    upto = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    done = cut.withColumn("__inside", F.last(value, ignorenulls=True).over(upto))
    return (
        _join_offsets(done, offsets, keys)
        .withColumn(out, F.coalesce(F.col("__inside"), F.col("__carried")))
        .drop("__inside", "__carried", CHUNK, HOT)
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Exact interpolated quantiles per key, without holding a key in memory.

    Values are first counted (map-side), the counts get a running sum, and the
    two order statistics around each rank are picked by aggregation. A built-in
    ``percentile`` would keep every distinct value of a key in one buffer.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    ranked = running_sum(checkpointed(counts, "value_counts"), keys, ["__v"], "__c", "__upto", rows_per_chunk, total="__n")
    picks = []
    for name, p in probs.items():
        rank = (F.col("__n") - 1) * F.lit(float(p))
        first = F.col("__upto") - F.col("__c")
        for side, place in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            hit = (first <= place) & (place < F.col("__upto"))
            picks.append(F.max(F.when(hit, F.col("__v"))).alias(f"__{side}_{name}"))
        picks.append(F.max(rank - F.floor(rank)).alias(f"__w_{name}"))
    out = ranked.groupBy(*keys).agg(*picks)
    return out.select(
        *keys,
        *[
            (
                F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")
            ).alias(n)
            for n in probs
        ],
    )


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last one in ``order``. Combines map-side."""
    return _one_per_key(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first one in ``order``; null keys are equal."""
    return _one_per_key(df, keys, order, F.min_by)


def _one_per_key(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    best = pick(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*df.columns)


def positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Rows with their place (from 0) in a total order, without a window over all of them.

    Rows are range-partitioned, sorted and written with a number that counts inside
    their partition; what lies before a partition is the sum of the sizes of those
    before it. Sizes are one row per partition, so the driver adds them up.
    """
    bits = 33
    number = _unused(df, "number")
    rows = checkpointed(df.orderBy(*order).withColumn(number, F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(number, bits)
    sizes = sorted(map(tuple, rows.groupBy(part.alias("p")).count().collect()))
    before, starts = 0, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(starts, "__p long, __before long")
    place = F.col("__before") + F.col(number).bitwiseAND(F.lit((1 << bits) - 1))
    return rows.join(F.broadcast(starts), part == F.col("__p")).select(*df.columns, place.alias(out))


def _unused(df: DataFrame, base: str) -> str:
    while base in df.columns:
        base += "_"
    return base


def global_value(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate of ``df`` as a scalar subquery, in place of a cross join."""
    return df.select(expr).scalar()
