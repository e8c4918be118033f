"""Near-duplicate documents by Order MinHash, verified by banded alignment of words.

Two texts are near copies when at most a fifth of the words of the longer one have to be
inserted, deleted or replaced to turn one into the other (edit similarity 0.8).

Shingles are five consecutive words; the c-th occurrence of a shingle in a text is
labelled c, so shingles of one text are distinct. For each of ``SKETCHES`` hash
functions the ``MINIMA`` smallest labelled shingles, kept in text order, make one
sketch. Texts that share a part j of all their labelled shingles share a sketch with
probability about j ** MINIMA, and are missed with (1 - j ** MINIMA) ** SKETCHES: less
than 0.1 % for j = 0.7 (a similarity of 0.96 if the edits are spread), 1 % for 0.6
(0.94), 13 % for 0.5 (0.93) and more below. Edits that lie together leave more shingles.
The chain of links joins most groups of copies all the same.

Texts of at most ``SHORT`` shingles also meet by single shingles, so that of them no pair
with j of 0.8 or more is missed: in one order of all shingles, the rarest first, two such
texts share one of the first n // 5 + 1 of their n shingles. These are buckets like the
sketches.

0. Every row gets a number, written once; rows are linked by number, whatever their
   doc_id. Below, doc is that number.
1. Equal word sequences are one text: the smallest number stands for all.
2. In every bucket (texts with an equal sketch) all texts are aligned with the
   smallest one; linked texts form components. Texts outside a bucket's largest
   component are then aligned with ``PARTNERS`` of its texts. A bucket of near copies
   so costs a few alignments a text, not one a pair.
3. Buckets that still hold several components are compared in full, block by
   block: texts outside the bucket's largest component against all others. No
   pair inside one component is looked at again, and no cross pair is left out.

An alignment is decided by the words two texts have in common where it can be: too few
of them rule it out, and a chain of them in order that leaves few enough words between
its links proves it. Otherwise the edits are counted exactly, along the diagonals of the
alignment that the limit lets a path reach.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import free_name, query, small_batches, table, utf8, words_of
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
MINIMA = 4
#: Texts of so many shingles at most are compared by single shingles as well.
SHORT = 50
#: Texts aligned with one leader in one slot; texts of a block in full comparison.
SLOT_TEXTS = 2048
BLOCK_TEXTS = 256
#: Partners in a bucket's largest component that every other text of it is aligned with.
PARTNERS = 6
#: Longer texts are aligned along diagonals.
BIT_ROWS = 4096
#: Shingles handled at once.
CHUNK = 1 << 15

_rng = np.random.default_rng(20)
_ODD = _rng.integers(0, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = _rng.integers(0, 2**63, max(SHINGLE, MINIMA), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    one = xxhash.xxh64_intdigest
    return np.array([one(w) for w in words], dtype=np.uint64)


def labelled(h: np.ndarray) -> np.ndarray:
    """Hashes that also tell the how-manieth of its kind each one is, so all differ."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return h
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    label = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    again = label > 0
    out = h.copy()
    out[order[again]] = _mix(h[order[again]] + label[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def labelled_shingles(ids: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles of ``word_hashes`` in text order; a
    shorter text is one shingle."""
    if not len(ids):
        return np.zeros(0, np.uint64)
    width = min(SHINGLE, len(ids))
    n = len(ids) - width + 1
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h += ids[i:i + n] * _POWER[i]
    return labelled(_mix(h))


def sketches(h: np.ndarray) -> np.ndarray:
    """One value per hash function: its smallest labelled shingles, in text order."""
    at = np.zeros((SKETCHES, 0), np.int64)
    for lo in range(0, len(h), CHUNK):
        at = np.concatenate([at, np.tile(np.arange(lo, min(lo + CHUNK, len(h))), (SKETCHES, 1))], axis=1)
        if at.shape[1] > MINIMA:
            key = h[at] * _ODD[:, None]
            at = np.take_along_axis(at, np.argpartition(key, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
    at = np.sort(at, axis=1)
    out = _ODD.copy()
    for i in range(at.shape[1]):
        out = _mix((out + h[at[:, i]]) * _POWER[i])
    return out


def longest_chain(a: np.ndarray) -> np.ndarray:
    """Places of a longest increasing run of a sequence, not necessarily contiguous."""
    if len(a) < 2 or bool((a[1:] > a[:-1]).all()):
        return np.arange(len(a))
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for place, x in enumerate(a.tolist()):
        i = bisect_left(tails, x)
        back.append(ends[i - 1] if i else -1)
        if i == len(tails):
            tails.append(x)
            ends.append(place)
        else:
            tails[i], ends[i] = x, place
    out, place = [], ends[-1]
    while place >= 0:
        out.append(place)
        place = back[place]
    return np.array(out[::-1])


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether at most ``most`` inserted, deleted or replaced words turn ``a`` into ``b``.

    Texts of ordinary length are aligned row by row, a row being one bit vector; longer
    ones along the diagonals within ``most`` of the main one.
    """
    if abs(len(a) - len(b)) > most:
        return False
    if not len(a) or not len(b):
        return max(len(a), len(b)) <= most
    if max(len(a), len(b)) <= BIT_ROWS:
        return _edits_by_rows(places_of(a), len(a), b, most)
    return _edits_by_diagonals(a, b, most)


def places_of(words: np.ndarray) -> dict[int, int]:
    """The places of every word as set bits."""
    at: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    return at


def _edits_by_rows(at: dict[int, int], n: int, b: np.ndarray, most: int) -> bool:
    """Differences of neighbouring cells, up in ``plus`` and down in ``minus``; it ends
    when the last cell can't come down to the limit any more."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, cell, left = full, 0, n, len(b)
    for w in b.tolist():
        left -= 1
        same = at.get(w, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | (~(across | plus) & full)
        back = plus & across
        if up & top:
            cell += 1
        elif back & top:
            cell -= 1
        if cell - left > most:
            return False
        up = ((up << 1) | 1) & full
        back = (back << 1) & full
        plus = back | (~(down | up) & full)
        minus = up & down
    return cell <= most


def _edits_by_diagonals(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """For 0, 1, ... edits, every diagonal keeps the farthest place it can be followed to."""
    n, m = len(a), len(b)
    diagonal = np.arange(-most, most + 1)
    end = most + m - n
    far = np.full(2 * most + 3, -2, np.int64)
    lead = np.minimum(n, m - diagonal)
    for edits in range(most + 1):
        if edits:
            here = np.maximum(np.maximum(far[1:-1] + 1, far[2:] + 1), far[:-2])
            here[(np.abs(diagonal) > edits) | (here + diagonal < 0)] = -2
            here = np.minimum(here, lead)
        else:
            here = np.where(diagonal == 0, 0, -2)
        going = np.flatnonzero((here >= 0) & (here < lead))
        while len(going):
            i = here[going]
            going = going[a[i] == b[i + diagonal[going]]]
            here[going] += 1
            going = going[here[going] < lead[going]]
        if here[end] >= n:
            return True
        far[1:-1] = here
    return False


class Sequence:
    """The words of a text (as 32-bit hashes), ready for alignment."""

    def __init__(self, words: np.ndarray):
        self.words = words
        marks = labelled(words.astype(np.uint64))
        self.order = np.argsort(marks, kind="stable")
        self.sorted = marks[self.order]
        self.places: dict[int, int] | None = None

    def similar(self, other: np.ndarray, marks: np.ndarray | None = None) -> bool:
        """Whether the edit similarity to the words ``other`` is 0.8 or more; ``marks``
        are its labelled words where they are known."""
        n1, n2 = len(self.words), len(other)
        longer = max(n1, n2)
        most = allowed(longer)
        if not n1 or not n2 or abs(n1 - n2) > most:
            return False
        if marks is None:
            marks = labelled(other.astype(np.uint64))
        at = np.minimum(np.searchsorted(self.sorted, marks), n1 - 1)
        there = np.flatnonzero(self.sorted[at] == marks)
        # An edit loses one common word at most.
        if len(there) < longer - most:
            return False
        here = self.order[at[there]]
        near = np.abs(here - there) <= most
        here, there = here[near], there[near]
        short = longer <= BIT_ROWS
        # A word more or less of a kind shifts the labels of all after it; short texts
        # are then aligned outright, which costs less than looking for the chain.
        if not short or bool((here[1:] > here[:-1]).all()):
            chain = longest_chain(here)
            gaps = [np.diff(np.concatenate([[-1], x[chain], [n]])) - 1 for x, n in ((here, n1), (there, n2))]
            if np.maximum(*gaps).sum() <= most:
                return True
        if not short:
            return edits_within(self.words, other, most)
        if self.places is None:
            self.places = places_of(self.words)
        return _edits_by_rows(self.places, n1, other, most)


def allowed(words: int) -> int:
    """Edits that a pair may need whose longer text has so many words."""
    return int(words * (1 - SIMILARITY) + 1e-9)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        n, e1, e2, sigs, seqs, few = [], [], [], [], [], []
        for text in utf8(batch.column(1)):
            words = words_of(text)
            ids = word_hashes(words)
            h = labelled_shingles(ids)
            digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), dtype="<i8")
            n.append(len(h))
            e1.append(int(digest[0]))
            e2.append(int(digest[1]))
            sigs.append(sketches(h).astype(np.int64) if len(h) else [])
            seqs.append((ids >> np.uint64(32)).astype(np.uint32).tobytes())
            few.append(h.astype(np.int64) if len(h) <= SHORT else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(e1, pa.int64()), pa.array(e2, pa.int64()),
             pa.array(sigs, pa.list_(pa.int64())), pa.array(seqs, pa.binary()), pa.array(few, pa.list_(pa.int64()))],
            names=["doc", "doc_id", "n", "e1", "e2", "sketches", "seq", "few"])


def _seq(raw) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint32)


def _align_with_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by leader and salt, the leader's own row first."""
    leader, held = None, None
    for batch in batches:
        a, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3))
        seqs = batch.column(4)
        us, vs = [], []
        for i in range(batch.num_rows):
            if a[i] == doc[i]:
                leader, held = a[i], Sequence(_seq(seqs[i].as_py()))
            elif leader == a[i] and held.similar(_seq(seqs[i].as_py())):
                us.append(int(a[i]))
                vs.append(int(doc[i]))
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many labelled words each left text shares with each right one."""
    hashes = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    values, column = np.unique(hashes, return_inverse=True)
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 8192
    edges = np.searchsorted(column, np.arange(0, len(values) + width, width))
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = np.zeros((len(left) + len(right), width), np.float32)
        part[owner[lo:hi], column[lo:hi] - i * width] = 1
        out += part[: len(left)] @ part[len(left):].T
    return out


def _compare_block(rows: list[tuple]) -> tuple[list[int], list[int]]:
    """Links between texts of different components: rows (side, doc, component, seq).

    Side 0 against side 0 and 1; a component is compared until it is joined.
    """
    rows = [(s, d, c, _seq(q)) for s, d, c, q in rows]
    left = [r for r in rows if r[0] == 0]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    marks: list[np.ndarray | None] = [None] * len(rows)
    if len(rows) <= 4:
        pairs = [(i, j) for i in range(len(left)) for j in range(len(rows)) if rows[j][0] == 1 or j > i]
        rows = left + [r for r in rows if r[0] == 1]
    else:
        rows = left + [r for r in rows if r[0] == 1]
        size = np.array([len(r[3]) for r in rows], np.float32)
        marks = [labelled(r[3].astype(np.uint64)) for r in rows]
        shared = _shared_counts(marks[: len(left)], marks)
        good = shared >= SIMILARITY * np.maximum(size[: len(left), None], size[None, :]) - 1e-3
        side = np.array([r[0] for r in rows])
        good &= (side[None, :] == 1) | (np.arange(len(rows))[None, :] > np.arange(len(left))[:, None])
        i, j = np.nonzero(good)
        # The likeliest pairs of a text come first; most texts need one.
        by = np.lexsort((-shared[i, j] / np.maximum(size[i], size[j]), i))
        pairs = list(zip(i[by].tolist(), j[by].tolist()))
    us, vs, held = [], [], (None, None)
    for i, j in pairs:
        a, b = root(rows[i][2]), root(rows[j][2])
        if a == b:
            continue
        if held[0] != i:
            held = (i, Sequence(rows[i][3]))
        if held[1].similar(rows[j][3], marks[j]):
            parent[a] = b
            us.append(rows[i][1])
            vs.append(rows[j][1])
    return us, vs


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, left block, right block); one such block pair at a time."""
    key, rows = None, []

    def links():
        us, vs = _compare_block(rows) if len(rows) > 1 else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if row[:3] != key:
                yield links()
                key, rows = row[:3], []
            rows.append(row[3:])
    yield links()


def _prefixes(reps: DataFrame) -> DataFrame:
    """(doc, sig) of the rarest shingles of short texts, from ``reps`` (doc, n, few).

    A shingle of one text only meets no other; such ones come first in the order and
    are only counted.
    """
    each = reps.select("doc", "n", F.explode("few").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1")
    each = each.join(checkpointed(shared, "shared_shingles"), "shingle")
    # At most SHORT shingles of a text come together.
    own = each.groupBy("doc", "n").agg(F.array_sort(F.collect_list(F.struct("texts", "shingle"))).alias("own"))
    take = F.expr("greatest(0, n div 5 + 1 - (n - size(own)))").cast("int")
    sig = F.transform(F.slice("own", F.lit(1), take), lambda x: F.xxhash64(F.lit("short"), x["shingle"]))
    return own.select("doc", F.explode(sig).alias("sig"))


def _leader_links(pairs: DataFrame, seqs: DataFrame) -> DataFrame:
    """Links of step 2 between ``pairs`` (leader, doc), with ``seqs`` (doc, seq)."""
    pairs = checkpointed(pairs.filter("doc <> leader").select("leader", "doc").distinct(), "leader_pairs")
    slots = checkpointed(
        pairs.groupBy("leader").agg(F.ceil(F.count("*") / SLOT_TEXTS).cast("int").alias("slots")), "leader_slots")
    n = F.coalesce("slots", F.lit(1))
    member = pairs.join(slots.filter("slots > 1"), "leader", "left").select(
        "leader", F.pmod(F.xxhash64("doc"), n).cast("int").alias("salt"), "doc")
    own = slots.select("leader", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("salt"), F.col("leader").alias("doc"))
    rows = member.union(own).join(seqs, "doc").select(
        "leader", "salt", (F.col("leader") != F.col("doc")).cast("int").alias("kind"), "doc", "seq")
    rows = rows.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "kind")
    return rows.mapInArrow(_align_with_leaders, "u long, v long")


def _in_parts(buckets: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts of buckets with their components ``parts`` (node, component), and what is
    known of each bucket that holds several: its largest one and the sizes."""
    rows = buckets.select("sig", "doc").join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left")
    rows = checkpointed(rows.withColumn("component", F.coalesce("component", "doc")), "bucket_texts")
    sizes = rows.groupBy("sig", "component").agg(
        F.count("*").alias("n"),
        F.array(*[F.min_by("doc", F.xxhash64("doc", "sig", F.lit(i))) for i in range(PARTNERS)]).alias("partners"))
    main = sizes.groupBy("sig").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component", "partners")).alias("most")).filter("parts > 1")
    return rows, main


def _as_links(parts: DataFrame) -> DataFrame:
    return parts.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))


def _partner_pairs(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """(leader, doc): texts outside a bucket's largest component with some texts inside."""
    rows, main = _in_parts(buckets, parts)
    main = checkpointed(main.select("sig", "most"), "bucket_partners")
    return rows.join(main, "sig").filter(F.col("component") != F.col("most.component")).select(
        F.explode("most.partners").alias("leader"), "doc")


def _block_links(buckets: DataFrame, seqs: DataFrame, parts: DataFrame) -> DataFrame:
    """Links of step 3 between the components ``parts`` (node, component)."""
    rows, main = _in_parts(buckets, parts)
    main = main.select(
        "sig", F.col("most.component").alias("main"),
        F.ceil((F.col("n") - F.col("most.n")) / BLOCK_TEXTS).cast("int").alias("n_rest"),
        F.ceil(F.col("most.n") / BLOCK_TEXTS).cast("int").alias("n_main"))
    rows = rows.join(checkpointed(main, "bucket_parts"), "sig").withColumn("is_main", F.col("component") == F.col("main"))
    own = F.pmod(F.xxhash64("doc"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("own", own)
    # Blocks of the rest are numbered from 0, those of the main component after them.
    none = F.array().cast("array<struct<i:int,j:int,side:int>>")
    rest = lambda f: F.when(F.col("n_rest") > 0, F.transform(F.sequence(F.lit(0), F.col("n_rest") - 1), f)).otherwise(none)
    spot = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    mine = F.col("own")
    with_rest = rest(lambda k: spot(F.least(mine, k), F.greatest(mine, k), (mine > k).cast("int")))
    with_main = F.transform(
        F.sequence(F.lit(0), F.col("n_main") - 1), lambda k: spot(mine, F.col("n_rest") + k, F.lit(0)))
    of_main = rest(lambda k: spot(k, F.col("n_rest") + mine, F.lit(1)))
    spots = F.when(F.col("is_main"), of_main).otherwise(F.concat(with_rest, with_main))
    rows = rows.select("sig", F.explode(spots).alias("s"), "doc", "component").join(seqs, "doc")
    rows = rows.select("sig", "s.i", "s.j", "s.side", "doc", "component", "seq").repartition("sig", "i", "j")
    return rows.sortWithinPartitions("sig", "i", "j", "side").mapInArrow(_compare_blocks, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_shingles): one row per row of ``docs`` (doc_id, text).

    A class is a connected component of the links of edit similarity 0.8 or more between
    rows; its id is its smallest doc_id. Words are as in the other operators (A-Z
    lower-cased).

    Defined cases: null, empty and wordless texts have no shingle and are a class
    each; a text of fewer than five words is one shingle; a very long text is sketched
    whole, in pieces; rows that repeat a doc_id
    or have none are in the class of their own text, so unlike classes may have an
    equal id; a class of rows without a doc_id has the id null; an empty table gives
    no rows. Other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), "text", "doc_id")
    return _classes(rows).select("doc_id", "class_id", "n_shingles")


def _classes(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, class_id, n_shingles, kept) of ``docs`` (doc, text, doc_id), doc being
    the number of the row; the row with the smallest doc_id of a class is kept, of
    several the one with the smallest number.
    """
    small_batches(docs.sparkSession)
    own = docs.select("doc", F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = checkpointed(own.mapInArrow(
        _sketch, "doc long, doc_id long, n long, e1 long, e2 long, sketches array<long>, seq binary, few array<long>"), "sketches")
    texts = rows.filter("n > 0")
    # What is joined back to the rows it was counted from is written first: the join
    # then has shuffles of its own, which can be split where one key is hot.
    first = checkpointed(texts.groupBy("e1", "e2").agg(F.min("doc").alias("rep")), "first_copies")
    member = checkpointed(texts.select("doc", "e1", "e2").join(first, ["e1", "e2"]).select("doc", "rep"), "members")
    reps = texts.join(member.filter("doc = rep").select("doc").distinct(), "doc", "left_semi")
    sigs = reps.select("doc", F.explode(F.array_distinct("sketches")).alias("sig")).distinct()
    sigs = checkpointed(sigs.union(_prefixes(reps)), "buckets")
    shared = sigs.groupBy("sig").agg(F.min("doc").alias("leader"), F.count("*").alias("n")).filter("n > 1").drop("n")
    buckets = checkpointed(sigs.join(checkpointed(shared, "bucket_leaders"), "sig"), "shared_buckets")
    seqs = checkpointed(
        reps.join(buckets.select("doc").distinct(), "doc", "left_semi").select("doc", "seq"), "sequences")
    # Each step goes on from the components of the one before, not from all its links.
    parts = components(checkpointed(_leader_links(buckets.select("leader", "doc"), seqs), "leader_links"))
    nearer = checkpointed(_leader_links(_partner_pairs(buckets, parts), seqs), "partner_links")
    parts = components(_as_links(parts).union(nearer))
    more = checkpointed(_block_links(buckets, seqs, parts), "block_links")
    copies = member.filter("doc <> rep").select(F.col("rep").alias("u"), F.col("doc").alias("v"))
    links = _as_links(parts).union(more).union(copies)
    classes = components(links).withColumnRenamed("node", "doc")
    out = rows.select("doc", "doc_id", F.col("n").alias("n_shingles")).join(classes, "doc", "left")
    out = checkpointed(out, "row_components")
    # Rows without an id come after all others.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc")
    best = out.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("best"))
    out = out.join(checkpointed(best, "class_names"), "component", "left")
    alone = F.col("component").isNull()
    return out.select(
        "doc", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"), "n_shingles",
        (alone | (F.col("doc") == F.col("best.doc"))).alias("kept"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest doc_id.

    Rows without a doc_id come after all others; of several rows with the smallest
    doc_id in one class any one stays.
    """
    row = free_name(docs, "row")
    # Written, so that a row keeps its number until it is filtered.
    numbered = checkpointed(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    copies = _classes(numbered.select(F.col(row).alias("doc"), "text", "doc_id")).filter(~F.col("kept"))
    return numbered.join(copies.select(F.col("doc").alias(row)), row, "left_anti").select(*docs.columns)


@query("op1_near_dedup")
def op1_near_dedup(spark, sf_dir):
    """The class of near copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
