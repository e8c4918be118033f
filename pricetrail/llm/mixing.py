"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources get weights, targets follow by water filling under a cap of epochs. The
documents of a source fall into hash blocks; whole epochs draw every block, the
last epoch draws blocks in a permuted order up to the target, its last block in
part. The drawn (source, epoch, block) units are dealt to output shards by a
tree: each node puts the units of its exact quotas in a random order of its own
and cuts that order at the room of its children, so the quotas of a child follow
the multivariate hypergeometric law and add up exactly. Every shard then takes a
disjoint range of each source's permuted units and shuffles by a local sort key.

The tree is a table of quotas, rows (node, source, n), one table per level. Only
blocks are counted in it, not documents, and no order needs a window over a node
or a source: random keys fall into bins, a bin starts after the sums of those
before it, and rows are only ordered inside their bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import positions
from ..session import checkpointed
from .common import NOT_SPACE, query, table

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BLOCK_WORDS = 1 << 20
BLOCK_ROWS = 4096
SHARDS = 16
#: Children of a node of the tree.
FANOUT = 4
SEED = 17
#: Leading hexadecimal digits of a random key that name its bin.
BIN_DIGITS = 3


def _pos(*parts: Column | str) -> Column:
    """A stable permutation key that SQL engines share."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(p) for p in parts]))


def _before(rows: DataFrame, groups: Sequence[str], value: Column, ties: Sequence[str], out: str) -> DataFrame:
    """The sum of ``value`` over the rows of the group that come earlier in the order
    of the column ``key`` (a hash in hexadecimal digits), then of ``ties``.
    """
    rows = rows.withColumns({"_bin": F.substring("key", 1, BIN_DIGITS), "_value": value})
    in_order = Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*groups, "_bin").agg(F.sum("_value").alias("_sum"))
    starts = starts.select(*groups, "_bin", F.coalesce(F.sum("_sum").over(in_order), F.lit(0)).alias("_start"))
    in_bin = Window.partitionBy(*groups, "_bin").orderBy("key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_upto", F.coalesce(F.sum("_value").over(in_bin), F.lit(0)))
    rows = rows.join(starts, [*groups, "_bin"]).withColumn(out, F.col("_start") + F.col("_upto"))
    return rows.drop("_bin", "_value", "_start", "_upto")


def water_level(sources: DataFrame) -> float | None:
    """The level at which the sum of min(cap, level * weight) is the sum of all sizes.

    Sources below the level are held at their cap and the level is raised to what
    is left for the others, until none falls below: one aggregate a round, each
    of which holds more sources.
    """
    total = F.sum("source_size").cast("double")
    free, level, held = F.lit(True), None, -1
    while True:
        open_ = F.sum(F.when(free, F.col("weight")).otherwise(0.0))
        row = sources.agg(
            ((total - F.sum(F.when(free, F.lit(0.0)).otherwise(F.col("cap")))) / F.nullif(open_, F.lit(0.0))).alias("level"),
            F.count_if(~free).alias("held"),
        ).first()
        if row["held"] == held or row["level"] is None:
            return row["level"]
        level, held = row["level"], row["held"]
        free = F.col("cap") / F.col("weight") >= F.lit(level)


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size) rows: total size shared by weight, capped at
    ``max_epochs`` times the source, the excess shared again until none is above.

    Weights repeat over the sources in code-point order, null last. Sources are
    numbered by their sorted places; no task holds all of them.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = positions(sources, [F.col("source").asc_nulls_last()], "source_no").withColumn("weight", w)
    rows = rows.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    level = water_level(rows)
    return rows.select(
        "source_no", "source", "source_size", "n_rows",
        F.least("cap", F.coalesce(F.lit(level).cast("double") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def split_tree(quotas: DataFrame, shards: int, seed: int = SEED, fanout: int = FANOUT) -> DataFrame:
    """Deal ``quotas`` (source_no, n) to ``shards``: rows (source_no, shard, n).

    A source without units has one row with n 0. Shard sizes differ by one unit at most. A node holds the shards from ``lo`` on;
    every unit of its quotas gets a random key, and the child of a unit is that of
    its place in the order of keys.
    """
    total = quotas.agg(F.sum("n")).first()[0] or 0
    node = quotas.filter("n > 0").select(F.lit(0).cast("long").alias("lo"), "source_no", F.col("n").cast("long").alias("n"))
    width = 1
    while width < shards:
        width *= fanout
    while width > 1:
        step = width // fanout
        # Units of large quotas are numbered in two steps, so no array has an entry per unit.
        units = node.select("lo", "source_no", "n", F.explode(F.expr("sequence(0L, (n - 1) div 4096)")).alias("part"))
        units = units.select("lo", "source_no", F.explode(
            F.expr("sequence(part * 4096 + 1, least(n, part * 4096 + 4096))")).alias("j"))
        units = units.withColumn("key", _pos("t", str(seed), F.lit(width), F.col("lo"), F.col("source_no"), F.col("j")))
        units = _before(units, ["lo"], F.lit(1), ["source_no", "j"], "place")
        shard = F.expr(f"((lo * {total}L div {shards} + place + 1) * {shards} - 1) div {max(total, 1)}L")
        units = units.select((F.col("lo") + F.floor((shard - F.col("lo")) / step) * step).alias("lo"), "source_no")
        node = checkpointed(units.groupBy("lo", "source_no").agg(F.count("*").alias("n")), "mix_tree")
        width = step
    node = node.select("source_no", F.col("lo").alias("shard"), "n")
    return node.union(quotas.filter("n = 0").select("source_no", F.lit(0).cast("long"), F.lit(0).cast("long")))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, block_rows: int = BLOCK_ROWS, seed: int = SEED,
) -> DataFrame:
    """The mix of ``docs`` (doc_id, source, text): one row per input row.

    Columns: doc_id, source, size, source_size, target, and ``draws``, an array of
    (epoch, shard, words, key): the shard that takes the document in an epoch, how
    many of its words, and its sort key inside the shard.

    Defined cases: null text has size 0; a text of size 0, however long, is in no
    block and has no draws; a null source is a source, after all others; rows
    repeated in the input are drawn each, and rows without a doc_id or that repeat
    one are spread by their text (only rows alike in both share a block); of an
    empty table the mix is empty. Other columns are not read.
    """
    sized = checkpointed(docs.select(
        F.col("doc_id"), F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark"),
    ), "mix_sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_rows"))
    sources = source_targets(totals, weights, max_epochs)
    quota = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("int")
    sources = checkpointed(
        sources.withColumn("epochs", epochs)
        .withColumn("rest", quota - F.col("epochs") * F.col("source_size"))
        .withColumn("n_blocks", F.greatest(
            F.lit(1), F.ceil(F.col("source_size") / block_words), F.ceil(F.col("n_rows") / block_rows)).cast("long")),
        "mix_sources",
    )
    named = sources.withColumnRenamed("source", "_source")
    key = _pos("o", str(seed), F.col("doc_id"), F.col("mark"))
    block = F.conv(F.substring(_pos("b", str(seed), F.col("doc_id"), F.col("mark")), 1, 8), 16, 10).cast("long") % F.col("n_blocks")
    every = sized.join(named, sized["source"].eqNullSafe(named["_source"])).select(
        "doc_id", "source", "size", "source_size", "target", "source_no", block.alias("block"), key.alias("key"))
    placed = every.filter("size > 0")

    blocks = placed.groupBy("source_no", "block").agg(F.sum("size").alias("words"))
    blocks = blocks.withColumn("key", _pos("e", str(seed), F.col("source_no"), F.col("block")))
    blocks = _before(checkpointed(blocks, "mix_blocks"), ["source_no"], F.col("words"), ["block"], "upto")
    blocks = blocks.join(sources.select("source_no", "epochs", "rest"), "source_no")
    blocks = blocks.withColumn("room", F.col("rest") - F.col("upto"))
    whole = F.when(F.col("epochs") > 0, F.sequence(F.lit(0), F.col("epochs") - 1)).otherwise(F.array().cast("array<int>"))
    parts = F.concat(
        F.transform(whole, lambda e: F.struct(e.alias("epoch"), F.col("words").alias("upto"))),
        F.when(F.col("room") > 0, F.array(F.struct(F.col("epochs").alias("epoch"), F.least("room", "words").alias("upto"))))
        .otherwise(F.array().cast("array<struct<epoch:int,upto:bigint>>")),
    )
    units = blocks.select("source_no", "block", F.explode(parts).alias("u")).select("source_no", "block", "u.epoch", "u.upto")
    units = units.withColumn("key", _pos("u", str(seed), F.col("source_no"), F.col("epoch"), F.col("block")))
    units = checkpointed(units, "mix_units")

    shares = split_tree(units.groupBy("source_no").agg(F.count("*").alias("n")), shards, seed)
    # One row per shard and source.
    upto_shard = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("lo", F.coalesce(F.sum("n").over(upto_shard), F.lit(0)))
    slots = shares.groupBy("source_no").agg(F.array_sort(F.collect_list(
        F.struct((F.col("lo") + F.col("n")).alias("hi"), "shard"))).alias("slots"))
    ranked = _before(units, ["source_no"], F.lit(1), ["epoch", "block"], "place").join(slots, "source_no")
    at = F.filter("slots", lambda x: x["hi"] > F.col("place"))
    dealt = ranked.withColumn("shard", F.element_at(at, 1)["shard"]).groupBy("source_no", "block").agg(
        F.array_sort(F.collect_list(F.struct("epoch", "shard", "upto"))).alias("units"))

    in_block = Window.partitionBy("source_no", "block").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    out = placed.join(dealt, ["source_no", "block"], "left")
    draws = F.transform(F.coalesce("units", F.array()), lambda u: F.struct(
        u["epoch"].alias("epoch"), u["shard"].alias("shard"),
        F.greatest(F.lit(0), F.least(F.col("size"), u["upto"] - F.col("before"))).cast("long").alias("words"),
        F.xxhash64(F.lit(seed), u["epoch"], F.col("key")).alias("key"),
    ))
    kept = ["doc_id", "source", "size", "source_size", "target"]
    out = out.select(*kept, F.filter(draws, lambda d: d["words"] > 0).alias("draws"))
    none = F.array().cast(out.schema["draws"].dataType)
    return out.unionByName(every.filter("size = 0").select(*kept, none.alias("draws")))


def taken(draws: Column | str) -> Column:
    return F.aggregate(draws, F.lit(0).cast("long"), lambda a, d: a + d["words"])


def listed(draws: Column | str) -> Column:
    """The draws as epoch:shard:words by epoch, comma-joined."""
    return F.array_join(F.transform(F.array_sort(draws), lambda d: F.concat_ws(":", d["epoch"], d["shard"], d["words"])), ",")


def shuffled_shards(mixed: DataFrame) -> DataFrame:
    """Draws of ``mix`` one per row, a shard per partition range, in shuffled order."""
    rows = mixed.select("doc_id", "source", F.explode("draws").alias("d")).select(
        "doc_id", "source", "d.shard", "d.epoch", "d.words", "d.key")
    return rows.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")


def _level_sql(level: str, above: str, width: int) -> str:
    """The nodes of a level of the tree, from the quotas of the level ``above``."""
    step = width // FANOUT
    return f"""{level} AS (
  SELECT lo + ((s - lo) // {step}) * {step} AS lo, source_no, count(*) AS n FROM (
    SELECT lo, source_no, ((lo * n_all // {SHARDS} + place + 1) * {SHARDS} - 1) // n_all AS s FROM (
      SELECT lo, source_no, row_number() OVER (PARTITION BY lo
        ORDER BY md5('t:{SEED}:{width}:' || lo || ':' || source_no || ':' || j), source_no, j) - 1 AS place
      FROM (SELECT lo, source_no, unnest(range(1, n + 1)) AS j FROM {above})), n_units) GROUP BY ALL),
"""


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(doc_id::VARCHAR, '~') || ':' || md5(coalesce(text, '')) AS mark FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS n_rows FROM sized GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM totals),
weighed AS (SELECT *, CASE source_no % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
  (3 * source_size)::DOUBLE AS cap FROM named),
levels AS (SELECT *,
  row_number() OVER o AS pos,
  (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source_no)),
chosen AS (SELECT level FROM levels WHERE cap / weight >= level ORDER BY pos LIMIT 1),
targets AS (SELECT l.source_no, l.source, l.source_size, l.n_rows,
  least(l.cap, coalesce(c.level * l.weight, l.cap)) AS target FROM levels l LEFT JOIN chosen c ON true),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::BIGINT AS epochs,
  greatest(1, ceil(source_size / 1048576.0), ceil(n_rows / 4096.0))::BIGINT AS n_blocks FROM targets),
placed AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.source_no, p.epochs,
  (round(p.target)::BIGINT - p.epochs * p.source_size) AS rest,
  CASE WHEN d.size > 0 THEN ('0x' || substr(md5('b:17:' || d.mark), 1, 8))::BIGINT % p.n_blocks END AS block,
  md5('o:17:' || d.mark) AS key
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
blocks AS (SELECT source_no, block, epochs, rest, sum(size)::BIGINT AS words FROM placed WHERE block IS NOT NULL GROUP BY ALL),
rooms AS (SELECT *, (rest - coalesce(sum(words) OVER (PARTITION BY source_no
  ORDER BY md5('e:17:' || source_no || ':' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS room FROM blocks),
units AS (
  SELECT source_no, block, unnest(range(epochs)) AS epoch, words AS upto FROM rooms
  UNION ALL SELECT source_no, block, epochs, least(room, words) FROM rooms WHERE room > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_no
  ORDER BY md5('u:17:' || source_no || ':' || epoch || ':' || block), epoch, block) - 1 AS place FROM units),
n_units AS (SELECT count(*) AS n_all FROM units),
root AS (SELECT 0::BIGINT AS lo, source_no, count(*) AS n FROM units GROUP BY source_no),
""" + _level_sql("branches", "root", 16) + _level_sql("leaves", "branches", 4) + r"""
shares AS (SELECT source_no, lo AS shard, n,
  sum(n) OVER (PARTITION BY source_no ORDER BY lo) - n AS first FROM leaves),
dealt AS (SELECT r.source_no, r.block, r.epoch, r.upto, s.shard FROM ranked r JOIN shares s
  ON r.source_no = s.source_no AND r.place >= s.first AND r.place < s.first + s.n),
filled AS (SELECT *, row_number() OVER () AS row_no, coalesce(sum(size) OVER (PARTITION BY source_no, block ORDER BY key, doc_id, size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
draws AS (
  SELECT row_no, sum(words)::BIGINT AS taken, string_agg(epoch || ':' || shard || ':' || words, ',' ORDER BY epoch) AS draws
  FROM (SELECT f.row_no, d.epoch, d.shard, greatest(0, least(f.size, d.upto - f.before))::BIGINT AS words
    FROM filled f JOIN dealt d ON f.source_no = d.source_no AND f.block = d.block) WHERE words > 0 GROUP BY row_no)
SELECT f.doc_id, f.size, f.source_size, f.target, coalesce(d.taken, 0)::BIGINT AS taken, coalesce(d.draws, '') AS draws
FROM filled f LEFT JOIN draws d ON f.row_no = d.row_no
"""


@query("op9_mixing", OP9_SQL)
def op9_mixing(spark, sf_dir):
    """All documents mixed at weights 5, 2, 1, with the shards the tree deals them to."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", taken("draws").alias("taken"), listed("draws").alias("draws"))
