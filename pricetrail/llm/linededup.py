"""Line dedup: documents probe sharded minimal perfect hashes of repeated lines.

1. Every document yields the 128-bit hashes of its distinct line keys. Counting
   them combines map-side; only keys held by two documents or more go on.
2. Those keys fall into shards by hash. Each shard becomes one row of compact
   arrays: the bit levels of a minimal perfect hash, and at each key's slot a
   64-bit fingerprint, the number of holders and the first holder.
3. Key hashes of the documents are routed to the shards (24 bytes each, never
   the line), a shard's arrays come first in the sort order of its slot, and the
   hashes stream past them. A shard with many probes is given several slots.
4. The dropped hashes of a document meet its text once, and the text is rewritten.

A slot holds the arrays of one shard and a batch of hashes, however many
documents hold a line.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .common import doc_key, free_name, query, small_batches, table, utf8

MIN_CHARS = 10
#: Sizes of a shard: repeated keys in its arrays, probes that one slot takes.
SHARD_KEYS = 1 << 18
SLOT_PROBES = 1 << 13
#: Bits of a level for each key that reaches it, and the number of levels.
LEVEL_BITS = 2
LEVELS = 40

STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def _long_enough(key: bytes) -> bool:
    n = len(key)
    return n >= 4 * MIN_CHARS or (n >= MIN_CHARS and len(key.decode("utf-8", "surrogatepass")) >= MIN_CHARS)


def _digests(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each key."""
    import xxhash

    one = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([one(k) for k in keys]), dtype="<i8").reshape(-1, 2)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes] = []
        counts = []
        for text in utf8(batch.column(1)):
            own = {line_key(x) for x in text.split(b"\n")} if text else ()
            own = [k for k in own if _long_enough(k)]
            keys += own
            counts.append(len(own))
        if keys:
            h = _digests(keys)
            docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(docs)], names=["h1", "h2", "doc"])


def line_hashes(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc) for every distinct key of at least ten code points of a document."""
    return docs.select(doc_key(F.col("doc_id")).alias("doc"), F.col("text").cast("string").alias("text")).mapInArrow(
        _hash_lines, "h1 long, h2 long, doc long")


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    """A new 64-bit hash of ``h`` for each level (splitmix)."""
    x = h.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class LineIndex:
    """A minimal perfect hash over ``h1`` with fingerprints, counts and first holders.

    On each level a key that meets no other key sets its bit; the others go on to
    the next level. A key's slot is the rank of its bit. Keys still left after
    the last level are kept in a sorted list.
    """

    def __init__(self, bits, left, fingerprint, count, first):
        self.bits, self.left = bits, left
        self.fingerprint, self.count, self.first = fingerprint, count, first
        sizes = [len(b) * 8 for b in bits]
        flat = np.concatenate([np.unpackbits(b) for b in bits]) if bits else np.zeros(0, np.uint8)
        self.flat = flat.astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, h1, fingerprint, count, first) -> LineIndex:
        rest, bits = np.asarray(h1), []
        while len(rest) and len(bits) < LEVELS:
            size = -(-LEVEL_BITS * len(rest) // 64) * 64
            at = (_mix(rest, len(bits)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(np.packbits(alone))
            rest = rest[~alone[at]]
        n = len(h1)
        index = cls(bits, np.sort(rest), np.zeros(n, np.int64), np.zeros(n, np.uint32), np.zeros(n, np.int64))
        slot = index.slots(h1)
        index.fingerprint[slot] = fingerprint
        index.count[slot] = np.minimum(count, 2**32 - 1)
        index.first[slot] = first
        return index

    def slots(self, h1: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level holds it."""
        out = np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for level, packed in enumerate(self.bits):
            at = self.base[level] + (_mix(h1[todo], level) % np.uint64(len(packed) * 8)).astype(np.int64)
            hit = self.flat[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        if len(self.left) and len(todo):
            at = np.minimum(np.searchsorted(self.left, h1[todo]), len(self.left) - 1)
            same = self.left[at] == h1[todo]
            out[todo[same]] = self.rank[-1] + at[same]
        return out

    def probe(self, h1, fingerprint) -> np.ndarray:
        """The slot of each key that the index holds, else -1."""
        slot = self.slots(h1)
        if len(self.fingerprint):
            slot[(slot >= 0) & (self.fingerprint[slot] != fingerprint)] = -1
        return slot

    def to_bytes(self) -> bytes:
        parts = [b.tobytes() for b in self.bits]
        parts += [x.tobytes() for x in (self.left, self.fingerprint, self.count, self.first)]
        return struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> LineIndex:
        (n,) = struct.unpack_from("<I", raw)
        at, parts = 4 + 8 * n, []
        for size in struct.unpack_from(f"<{n}Q", raw, 4):
            parts.append(raw[at:at + size])
            at += size
        kinds = [np.uint8] * (n - 4) + [np.int64, np.int64, np.uint32, np.int64]
        arrays = [np.frombuffer(p, dtype=k) for p, k in zip(parts, kinds)]
        return cls(arrays[:-4], *arrays[-4:])


def _build_shard(rows):
    import pandas as pd

    index = LineIndex.build(*(rows[c].to_numpy() for c in ("h1", "h2", "n", "first")))
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "arrays": [index.to_bytes()]})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, salt, with the arrays of a slot before its probes."""
    index, held = None, None
    for batch in batches:
        shard = batch.column(0).to_numpy(zero_copy_only=False)
        arrays, h1, h2, doc = (batch.column(i) for i in (2, 3, 4, 5))
        cuts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1])]))
        has = np.asarray(arrays.is_valid())
        for lo, hi in zip(cuts, [*cuts[1:], len(shard)]):
            for at in np.flatnonzero(has[lo:hi]):
                if held != shard[lo]:
                    index, held = LineIndex.from_bytes(arrays[int(lo + at)].as_py()), shard[lo]
            if held != shard[lo]:
                continue
            asks = np.flatnonzero(~has[lo:hi]) + lo
            if not len(asks):
                continue
            a, b, d = (np.asarray(x.take(pa.array(asks)).to_numpy(zero_copy_only=False), np.int64) for x in (h1, h2, doc))
            slot = index.probe(a, b)
            drop = slot >= 0
            drop[drop] = index.first[slot[drop]] != d[drop]
            if drop.any():
                yield pa.RecordBatch.from_arrays([pa.array(d[drop]), pa.array(a[drop])], names=["doc", "h1"])


def line_index(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The table of shards (shard, arrays), the slots (shard, slots) of shards that
    many documents probe, and the number of shards."""
    spark = docs.sparkSession
    seen = Observation()
    counted = (
        line_hashes(docs).observe(seen, F.count(F.lit(1)).alias("n"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("first"), F.max("doc").alias("last"))
        .filter("first < last").drop("last")
    )
    repeated = checkpointed(counted, "line_counts")
    keys = repeated.count()
    probes = seen.get["n"] if keys else 0
    n_shards = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(keys / SHARD_KEYS), math.ceil(probes / SLOT_PROBES))
    keyed = repeated.withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    shards = checkpointed(keyed.groupBy("shard").applyInPandas(_build_shard, "shard long, arrays binary"), "line_shards")
    slots = keyed.groupBy("shard").agg(F.ceil(2 * F.sum("n") / SLOT_PROBES).cast("int").alias("slots")).filter("slots > 1")
    return shards, checkpointed(slots, "line_slots"), n_shards


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc, h1): keys that a document loses to the first document holding them."""
    shards, slots, n_shards = line_index(docs)
    n = F.coalesce("slots", F.lit(1))
    none = F.lit(None)
    asks = line_hashes(docs).withColumn("shard", F.pmod("h1", F.lit(n_shards))).join(slots, "shard", "left")
    asks = asks.select(
        "shard", F.pmod(F.xxhash64("doc"), n).cast("int").alias("salt"), none.cast("binary").alias("arrays"), "h1", "h2", "doc")
    held = shards.join(slots, "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0), n - 1)).alias("salt"), "arrays",
        none.cast("long").alias("h1"), none.cast("long").alias("h2"), none.cast("long").alias("doc"))
    routed = held.unionByName(asks).repartition("shard", "salt")
    return routed.sortWithinPartitions("shard", "salt", F.col("arrays").isNull()).mapInArrow(_probe, "doc long, h1 long")


def _rewrite(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, drops in zip(utf8(batch.column(text_at)), batch.column(batch.num_columns - 1)):
                own = text.split(b"\n") if text else [b""]
                n = len(own)
                if drops.is_valid and n:
                    gone = set(drops.values.to_numpy(zero_copy_only=False).tolist())
                    keys = [line_key(x) for x in own]
                    hashes = _digests(keys)[:, 0].tolist()
                    own = [x for x, k, h in zip(own, keys, hashes) if not (h in gone and _long_enough(k))]
                texts.append(b"\n".join(own))
                lines.append(n)
                dropped.append(n - len(own))
            columns = list(batch.columns[:-1])
            columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            names = [*batch.schema.names[:-1], "n_lines", "n_dropped"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=names)

    return run


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines left only in the smallest doc_id holding them.

    The columns of the input, ``text`` rewritten, and n_lines (before) and
    n_dropped; input columns of these two names are replaced. A key is a line
    stripped of ASCII white space with A-Z in lower case; keys of fewer than ten
    code points stay everywhere.

    Defined cases: null or empty text is one empty line; rows that repeat a doc_id
    are one document (each keeps or loses the same lines); rows without a doc_id
    are one document, after all others; a line repeated inside its first document
    stays there as often; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    names, own, drop = docs.columns, free_name(docs, "own"), free_name(docs, "drops")
    drops = dropped_lines(docs.select("doc_id", "text")).groupBy(F.col("doc").alias(own)).agg(F.collect_set("h1").alias(drop))
    joined = docs.withColumn(own, doc_key(F.col("doc_id"))).join(drops, own, "left").select(*names, drop)
    fields = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in docs.schema.fields]
    out = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(_rewrite(names.index("text")), out)


OP5_SQL = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
firsts AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
kept AS (SELECT l.doc_id, l.i, l.line, f.first IS NOT NULL AND f.first <> l.doc_id AS gone
  FROM lines l LEFT JOIN firsts f ON l.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark, sf_dir):
    """All documents without the lines that an earlier document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
