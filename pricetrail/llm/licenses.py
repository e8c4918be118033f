"""License scans by a positional index of rare licence words.

The index holds, for every template, its words of highest IDF in the corpus with
their positions. A file's occurrences of those words look up the postings; where two
of them point at the same start (equal file position minus template position), the
template is a candidate there. A candidate counts if its mandatory key phrases
stand at their relative positions and enough of its other words do.

Every phrase of the base set is a template of its own whose words are all mandatory,
so its places are found whole. All steps are column expressions over one row's
word array; only the document frequencies of the licence words are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WORD, ascii_lower, query, table

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Label, notice text (as words) and the phrase that must stand in it.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met", "source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted", "with or without fee"),
    ("lgpl", "licensed under the gnu lesser general public license version", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "into the public domain"),
]

#: Rare words of a template in the index, and the share of its words a place needs.
ANCHORS = 2
COVERAGE = 0.8


def _templates() -> list[dict]:
    """All templates with their words, mandatory positions, label and whether they are base."""
    out = []
    for phrase, label in BASE.items():
        words = phrase.split()
        out.append({"label": label, "words": words, "need": list(range(len(words))), "base": True})
    for label, text, phrase in TEMPLATES:
        words, key = text.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        out.append({"label": label, "words": words, "need": list(range(at, at + len(key))), "base": False})
    return out


VOCABULARY = sorted({w for t in _templates() for w in t["words"]})


def word_array(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; of a null text none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text.cast("string")), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def licence_word_counts(docs: DataFrame) -> dict[str, int]:
    """How many rows hold each licence word; as many entries as the templates have words."""
    known = F.array(*map(F.lit, VOCABULARY))
    held = docs.select(F.explode(F.array_intersect(word_array(F.col("text")), known)).alias("word"))
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}


def positional_index(counts: dict[str, int]) -> list[dict]:
    """The templates, each with its rarest words and their first positions."""
    out = []
    for t in _templates():
        rare = sorted(set(t["words"]), key=lambda w: (counts.get(w, 0), w))[:ANCHORS]
        out.append({**t, "postings": [(w, t["words"].index(w)) for w in rare]})
    return out


def _starts(words: Column, hits: Column, t: dict) -> Column:
    """Where a template stands: starts and the share of its words, as an array of structs."""
    def starts(word: str, at: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["at"] - at)

    same = starts(*t["postings"][0])
    for posting in t["postings"][1:]:
        same = F.array_intersect(same, starts(*posting))
    text = F.array(*map(F.lit, t["words"]))
    lo, n = t["need"][0], len(t["need"])
    key = F.array(*[F.lit(t["words"][i]) for i in t["need"]])
    good = F.filter(same, lambda s: (s + lo >= 0) & (F.slice(words, F.greatest(s + lo + 1, F.lit(1)), n) == key))
    if len(t["need"]) == len(t["words"]):
        return F.transform(good, lambda s: F.struct(s.alias("at"), F.lit(1.0).alias("share")))

    def share(s: Column) -> Column:
        there = F.filter(F.transform(text, lambda w, j: w.eqNullSafe(F.get(words, s + j))), lambda x: x)
        return F.size(there) / F.lit(len(t["words"]))

    return F.filter(
        F.transform(good, lambda s: F.struct(s.alias("at"), share(s).alias("share"))),
        lambda p: p["share"] >= COVERAGE)


def scan_licences(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, places): one row per row of ``docs`` (doc_id, text).

    ``places`` is an array of (label, base, at, share): the template, whether it is a
    base phrase, the word it starts at (from 0, negative if its first words are cut
    off) and the share of its words that stand there. ``share`` is at least
    ``COVERAGE``.

    Defined cases: null, empty and wordless texts have no places; equal rows give
    equal results; ties of document frequency go to the smaller word; empty tables
    give no rows. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    index = positional_index(licence_word_counts(docs))
    rare = sorted({w for t in index for w, _ in t["postings"]})
    rows = docs.select("doc_id", word_array(F.col("text")).alias("words"))
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(rare), F.struct(i.alias("at"), w.alias("word")))),
        lambda h: h.isNotNull())
    rows = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))

    def found_at(t: dict) -> Column:
        return F.transform(_starts(F.col("words"), F.col("hits"), t), lambda p: F.struct(
            F.lit(t["label"]).alias("label"), F.lit(t["base"]).alias("base"), p["at"].cast("long").alias("at"), p["share"].alias("share")))

    found = [found_at(t) for t in index]
    none = F.array().cast("array<struct<label:string,base:boolean,at:bigint,share:double>>")
    places = F.when(F.size("hits") > 0, F.concat(*found)).otherwise(none)
    return rows.select("doc_id", "n_words", places.alias("places"))


def _labels(places: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))


def _sql() -> str:
    parts = _templates()
    words = ", ".join(
        f"({k}, {j}, '{w}', {str(j in t['need']).lower()})" for k, t in enumerate(parts) for j, w in enumerate(t["words"]))
    heads = ", ".join(
        f"({k}, '{t['label']}', {str(t['base']).lower()}, {len(t['words'])}, {len(t['need'])})" for k, t in enumerate(parts))
    return rf"""
WITH tw(t, j, word, need) AS (VALUES {words}),
th(t, label, base, len, n_need) AS (VALUES {heads}),
docs AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) AS w FROM documents),
spots AS (SELECT doc_id, word, pos FROM (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs) WHERE word IN (SELECT word FROM tw)),
freq AS (SELECT word, count(DISTINCT doc_id) AS df FROM spots GROUP BY word),
anchors AS (SELECT t, word, j FROM (
  SELECT x.t, x.word, min(x.j) AS j, row_number() OVER (PARTITION BY x.t ORDER BY coalesce(min(f.df), 0), x.word) AS k
  FROM tw x LEFT JOIN freq f ON x.word = f.word GROUP BY x.t, x.word) WHERE k <= {ANCHORS}),
n_anchors AS (SELECT t, count(*) AS n FROM anchors GROUP BY t),
met AS (SELECT s.doc_id, x.t, s.pos - x.j AS start, count(*) AS n, sum(x.need::INT) AS need, count(a.word) AS anchors
  FROM spots s JOIN tw x ON s.word = x.word LEFT JOIN anchors a ON a.t = x.t AND a.word = x.word AND a.j = x.j
  GROUP BY ALL),
places AS (SELECT m.doc_id, h.label, h.base, m.start, m.n / h.len AS share
  FROM met m JOIN th h ON m.t = h.t JOIN n_anchors a ON m.t = a.t
  WHERE m.need = h.n_need AND m.anchors = a.n AND m.n / h.len >= {COVERAGE}),
sums AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base,
    min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM places GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(s.n_base, 0)::BIGINT AS n_base,
  s.first_word::BIGINT AS first_word, s.last_word::BIGINT AS last_word,
  coalesce(s.base_labels, '') AS base_labels, coalesce(s.labels, '') AS labels, coalesce(s.score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""


@query("op6_licenses", _sql())
def op6_licenses(spark, sf_dir):
    """Licence places of all documents."""
    places = F.col("places")
    found = scan_licences(table(spark, sf_dir, "documents")).withColumn("at", F.filter(places, lambda p: p["base"]))
    starts = F.transform("at", lambda p: p["at"])
    return found.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(F.col("at")).alias("base_labels"), _labels(places).alias("labels"),
        F.coalesce(F.array_max(F.transform(places, lambda p: p["share"])), F.lit(0.0)).alias("score"))
