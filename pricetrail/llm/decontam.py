"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of one task, up to a number of words. Its text is
written in the alphabet of the phrases: a word of no phrase ends a segment, since
no phrase can reach over it, and segments shorter than the shortest phrase hold no
occurrence. The FM-index of the shard is searched backward for all phrases at once
through wavelet-tree ranks; occurrences are located by sampled suffix positions and
merged to spans per document.

The phrases travel to the tasks in blocks of a bounded number of words. Documents
are never shuffled. With one block, one pass over them gives the result; with more,
each block has a pass of its own that writes the spans it finds, and its phrases are
let go before the next block is read, so driver and tasks hold one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import WORD, ascii_lower, query, small_batches, table, utf8, words_of
from .fmindex import FMIndex

WINDOW = 10
#: Words of phrases in one block (at most 0.6 KB each in a task), words of text that one
#: index covers.
BLOCK_WORDS = 1_000_000
SHARD_WORDS = 4_000_000


class Phrases:
    """The windows of a block of items as symbols, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        windows: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - width + 1) if words else 0):
                windows.setdefault(tuple(words[i:i + width]), set()).add(item)
        self.alphabet: dict[bytes, int] = {}
        for window in windows:
            for word in window:
                # 0 is the end of the text and of unknown words, 1 stands between segments.
                self.alphabet.setdefault(word, len(self.alphabet) + 2)
        self.length = np.array([len(w) for w in windows], np.int64)
        self.rows = np.zeros((len(windows), width), np.int64)
        for row, window in zip(self.rows, windows):
            row[width - len(window):] = [self.alphabet[w] for w in window]
        self.items = [sorted(x for x in s if x is not None) for s in windows.values()]
        self.shortest = int(self.length.min()) if len(windows) else 0
        self.n_symbols = len(self.alphabet) + 2


def occurrences(docs: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (document number, first word, phrase) of a shard of symbol sequences."""
    none = np.zeros(0, np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    if not len(phrases.length) or not sizes.sum():
        return none, none, none
    whole = np.concatenate(docs)
    start = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(docs)), sizes)
    known = whole > 0
    # Segments: maximal runs of known words inside one document.
    edge = np.concatenate([[True], (known[1:] != known[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(whole)))
    good = known[first] & (size >= phrases.shortest)
    first, size = first[good], size[good]
    if not len(first):
        return none, none, none
    # Each segment and one separator after it.
    out = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.ones(out[-1], np.int64)
    shift = np.repeat(first - out[:-1], size)
    places = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    text[places] = whole[places + shift]
    source = np.zeros(len(text), np.int64)
    source[places] = places + shift
    index = FMIndex(text, phrases.n_symbols)
    lo, hi = index.search(phrases.rows, phrases.length)
    count = hi - lo
    phrase = np.repeat(np.arange(len(lo)), count)
    rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    at = source[index.locate(rows)]
    doc = owner[at] if len(at) else none
    return doc, at - start[doc], phrase


def merge_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    by = np.lexsort((end, start))
    start, end = start[by], np.maximum.accumulate(end[by]) if len(end) else end
    new = np.concatenate([[True], start[1:] > end[:-1]]) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return [(int(a), int(b)) for a, b in zip(start[first], end[last])]


def _search_shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[list, list]]:
    doc, at, phrase = occurrences(docs, phrases)
    out: list[tuple[list, list]] = [([], []) for _ in docs]
    by = np.argsort(doc, kind="stable")
    doc, at, phrase = doc[by], at[by], phrase[by]
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(doc)]):
        spans = merge_spans(at[lo:hi], at[lo:hi] + phrases.length[phrase[lo:hi]])
        items = {i for p in np.unique(phrase[lo:hi]) for i in phrases.items[p]}
        out[doc[lo]] = ([{"start": a, "end": b} for a, b in spans], sorted(items))
    return out


def _searcher(shared, width: int, keep_text: bool):
    """Rows (doc_id, text, ...) of a task, shard by shard, with n_words, spans and items added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value, width)
        get, zero = phrases.alphabet.get, 0
        held, docs, words = [], [], 0

        def flush():
            found, at = _search_shard(docs, phrases), 0
            for batch in held:
                rows = found[at:at + batch.num_rows]
                extra = [
                    pa.array([len(d) for d in docs[at:at + batch.num_rows]], pa.int64()),
                    pa.array([r[0] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([r[1] for r in rows], pa.list_(pa.string())),
                ]
                at += batch.num_rows
                names = [*batch.schema.names, "n_words", "spans", "items"]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)

        for batch in batches:
            for text in utf8(batch.column(1)):
                found = words_of(text)
                docs.append(np.array([get(w, zero) for w in found], np.int32))
                words += len(found)
            # The text has been read; it is held for the shard only where it is asked for.
            text = batch.column(1) if keep_text else pa.nulls(batch.num_rows, pa.string())
            held.append(batch.set_column(1, batch.schema.names[1], text))
            if words >= SHARD_WORDS:
                yield from flush()
                held, docs, words = [], [], 0
        if held:
            yield from flush()

    return run


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of about ``block_words`` words, streamed through the driver.

    The next block is read when it is asked for.
    """
    block, words, full = [], 0, False
    for row in items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        text = row[1]
        if text is None:
            continue
        text = text.encode("utf-8", "surrogatepass")
        block.append((row[0], text))
        words += len(text) // 2 + 1
        if words >= block_words:
            yield block
            block, words, full = [], 0, True
    if block or not full:
        yield block


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, keep: Sequence[str] = ()) -> DataFrame:
    """Where the phrases of ``items`` (item_id, text) occur in ``docs`` (doc_id, text).

    A phrase is a window of ``width`` consecutive words of an item; an item with
    fewer words is one phrase. Columns: doc_id, n_words, spans (merged word ranges
    to remove, end exclusive) and items (ids with occurring phrases, as sorted
    strings), then the columns of the row named by ``keep``, which are not any of
    these; one row per input row.

    Defined cases: null and wordless texts have no words and no spans; an item
    without words has no phrase; a null item_id marks spans but is not listed;
    repeated items count once; empty tables give empty spans or no rows. Other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    others = [c for c in keep if c != "text"]
    if others:
        rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.struct(*others).alias("kept"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string"
    if others:
        schema += f", kept {rows.schema['kept'].dataType.simpleString()}"
    found = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    blocks = item_blocks(items)
    block, second = next(blocks), next(blocks, None)
    if second is None:
        shared = docs.sparkSession.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_searcher(shared, width, "text" in keep), f"{schema}, {found}")
    else:
        rows = _in_blocks(rows, chain([block, second], blocks), width, found)
    return rows.select(
        "doc_id", "n_words", "spans", "items",
        *[F.col("text") if c == "text" else F.col("kept")[c].alias(c) for c in keep])


def _in_blocks(rows: DataFrame, blocks: Iterator[list], width: int, found: str) -> DataFrame:
    """``rows`` with n_words, spans and items, by one pass for each block of phrases."""
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()), "decontam_rows")
    hits = []
    for block in blocks:
        shared = rows.sparkSession.sparkContext.broadcast(block)
        own = rows.select("row", "text").mapInArrow(_searcher(shared, width, False), f"row long, text string, {found}")
        hits.append(checkpointed(own.filter(F.size("spans") > 0).select("row", "spans", "items"), "decontam_hits"))
        shared.destroy()
    hits = reduce(DataFrame.union, hits)
    items = hits.select("row", F.explode("items").alias("item")).groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    # The spans of one document, so the window holds no more than a text.
    in_order = Window.partitionBy("row").orderBy("start", "end")
    spans = hits.select("row", F.explode("spans").alias("s")).select("row", "s.start", "s.end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("apart", F.coalesce(F.col("start") > reach, F.lit(True)).cast("long"))
    spans = spans.withColumn("span", F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    out = rows.join(spans, "row", "left").join(items, "row", "left")
    return out.withColumns({
        "n_words": F.coalesce(F.regexp_count(ascii_lower(F.col("text")), F.lit(WORD)), F.lit(0)).cast("long"),
        "spans": F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")),
        "items": F.coalesce("items", F.array().cast("array<string>")),
    })


def n_hit(spans: Column | str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


OP2_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
places AS (
  SELECT doc_id, w, k, i FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
found AS (
  SELECT p.doc_id, p.i, p.k, x.item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places) p
  JOIN windows x ON p.k = x.k AND p.phrase = x.phrase),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
  coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""


@query("op2_decontamination", OP2_SQL)
def op2_decontamination(spark, sf_dir):
    """All documents against all benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
