"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import zlib

import pytest

pytest.importorskip("pricetrail.llm")

from pyspark.sql import functions as F  # noqa: E402

from pricetrail.llm import (  # noqa: E402
    decontam, langid, licenses, linededup, mixing, neardup, pages, pii, quality, secrets,
)

DOCS = "doc_id long, text string, lang string, source string, n_lines string, _drops int, spans string, score string"
PROSE = " ".join(f"word{i} goes{i % 7} here{i % 11}" for i in range(60))
LONG = " ".join(f"w{i}" for i in range(200_000))


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if k % 2 else None, None if k % 3 == 0 else "s", "x", 1, "y", "z") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", " \n\t ", "!!!", PROSE, PROSE, "short words", LONG, "\n".join(["a repeated line"] * 30)]


@pytest.fixture(scope="module")
def awkward(spark):
    return docs(spark, AWKWARD + [PROSE, "no id"], [*range(len(AWKWARD)), 4, None]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int"


@pytest.fixture(scope="module")
def runs(spark):
    items = spark.createDataFrame([(1, PROSE), (2, None), (None, "short words"), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1), (4, 1), (3, 0), (None, 0), (5, None)], LABELS)
    return {
        "near": neardup.near_duplicates,
        "decontam": lambda d: decontam.contamination(d, items),
        "language": langid.identify,
        "lines": linededup.dedup_lines,
        "licenses": licenses.scan_licences,
        "secrets": secrets.scan_secrets,
        "quality": lambda d: quality.judge(d, labels),
        "mixing": mixing.mix,
        "pii": pii.find_pii,
    }


@pytest.mark.parametrize("name", ["near", "decontam", "language", "lines", "licenses", "secrets", "quality", "mixing", "pii"])
def test_one_row_per_row_and_none_for_none(runs, awkward, empty, name):
    out = runs[name](awkward)
    assert out.count() == awkward.count()
    assert len(set(out.columns)) == len(out.columns)
    none = runs[name](empty)
    assert none.count() == 0 and none.schema.simpleString() == out.schema.simpleString()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_copies(spark):
    words = [f"w{i}" for i in range(300)]
    near, far = words[:100] + ["x"] + words[101:], words[150:] + words[:150]
    rows = docs(spark, [" ".join(words), " ".join(near), " ".join(words).upper(), " ".join(far), None, "", "a b", "A, b!"])
    got = {i: r["class_id"] for i, r in by_id(neardup.near_duplicates(rows)).items()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6}
    kept = {r["doc_id"] for r in neardup.distinct_documents(rows).collect()}
    assert kept == {0, 3, 4, 5, 6}


def test_near_copies_by_row(spark):
    """Rows that share an id or have none are judged by their own text."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = docs(spark, [a, b, f"{a} more", f"{b} more", c, f"{c} more", "lone text", a, c], [1, 2, None, None, None, None, None, 7, 7])
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_shingles"]) for r in neardup.near_duplicates(rows).collect())
    assert got == [(0, 0, 1), (0, 1, 57), (0, 2, 57), (0, 7, 56), (0, 7, 57), (1, 1, 56), (2, 2, 56), (7, 1, 56), (7, 7, 56)]
    kept = neardup.distinct_documents(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "lone text"), (1, a), (2, b), (7, c)]


def test_near_copies_chain_and_blocks(spark, monkeypatch):
    """A large group of edits of edits: links across blocks of one bucket are found."""
    monkeypatch.setattr(neardup, "SLOT_TEXTS", 7)
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 5)
    words, texts = [f"w{i}" for i in range(200)], []
    for i in range(60):
        texts.append(" ".join(words))
        words = words[:]
        words[(i * 3) % 200] = f"e{i}"
    got = {i: r["class_id"] for i, r in by_id(neardup.near_duplicates(docs(spark, texts))).items()}
    assert set(got.values()) == {0}


def test_short_texts_of_similar_shingles_are_not_missed(spark):
    """Edits at the ends of texts of 9 to 20 words: four fifths of the shingles stay."""
    texts = []
    for n in range(9, 21):
        for k in range(4):
            words = [f"a{n}x{k}x{i}" for i in range(n)]
            texts += [" ".join(x) for x in (words, ["first", *words], [*words, "last"], words[1:])]
    # Beginnings common to texts that are unlike otherwise.
    texts += ["one common beginning of some words then " + " ".join(f"z{i}y{j}" for j in range(10, 20 + i % 4 * 10)) for i in range(40)]
    got = {i: r["class_id"] for i, r in by_id(neardup.near_duplicates(docs(spark, texts))).items()}
    assert got == {i: i - i % 4 if i < 192 else i for i in range(len(texts))}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_alignment_equals_the_plain_table(monkeypatch):
    """Bit rows, diagonals and the shortcuts by common words all tell the same edits."""
    import random

    import numpy as np

    rng = random.Random(2)
    for _ in range(1500):
        a = [rng.randrange(6) for _ in range(rng.randrange(30))]
        b = a[:]
        for _ in range(rng.randrange(8)):
            kind, at = rng.randrange(3), rng.randrange(len(b) + 1)
            b[at:at + (kind > 0)] = [] if kind == 1 else [rng.randrange(6)]
        d = plain_distance(a, b)
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        for most in {0, max(d - 1, 0), d, d + 1, 9}:
            assert neardup.edits_within(x, y, most) == (d <= most)
            if a and b and abs(len(a) - len(b)) <= most:
                assert neardup._edits_by_diagonals(x, y, most) == (d <= most)
        if a and b:
            assert neardup.Sequence(x).similar(y) == (5 * d <= max(len(a), len(b)))
    # A long text with every ninth word replaced is a near copy, with every third it is not.
    whole = np.array([rng.randrange(3000) for _ in range(9000)], np.uint32)
    for step, near in ((9, True), (3, False)):
        other = whole.copy()
        other[::step] = 99_999
        assert neardup.Sequence(whole).similar(other) == near


def test_chain_is_ordered():
    import numpy as np

    assert neardup.longest_chain(np.array([5, 1, 2, 9, 3, 4])).tolist() == [1, 2, 4, 5]
    assert neardup.longest_chain(np.array([], dtype=int)).tolist() == []


def test_decontamination_blocks_and_spans(spark, monkeypatch):
    item = " ".join(f"q{i}" for i in range(14))
    items = spark.createDataFrame([(10, item), (9, "alpha beta"), (10, item), (None, "gamma"), (8, None)], "item_id long, text string")
    rows = docs(spark, [
        f"x {item} y", "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 stop q10", "Alpha-BETA alpha", "gamma", None, f"{item} {item}", "q1 " * 50])
    want = {
        0: (16, [(1, 15)], ["10"]), 1: (12, [(0, 10)], ["10"]), 2: (3, [(0, 2)], ["9"]), 3: (1, [(0, 1)], []),
        4: (0, [], []), 5: (28, [(0, 28)], ["10"]), 6: (50, [], [])}

    def shape(df):
        return {r["doc_id"]: (r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in df.collect()}

    got = shape(decontam.contamination(rows, items))
    # Adjacent windows are one span, whether they overlap or touch.
    assert got == want
    parts = list(decontam.item_blocks(items, block_words=8))
    assert len(parts) > 2
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 8)
    blocks = decontam.item_blocks
    monkeypatch.setattr(decontam, "item_blocks", lambda x: blocks(x, 8))
    assert shape(decontam.contamination(rows, items)) == want


def test_language_without_letters_or_labels(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:5]
    rows = docs(spark, ["123 456", None, "", "Ω", "abc"], ids)
    got = by_id(langid.identify(rows.withColumn("lang", F.lit(None).cast("string"))))
    assert {r["lang_pred"] for r in got.values()} == {"und"} and {r["score"] for r in got.values()} == {0.0}
    some = by_id(langid.identify(rows.withColumn("lang", F.lit("xx"))))
    assert [some[i]["lang_pred"] for i in ids] == ["und", "und", "und", "xx", "xx"]


def test_long_text_of_a_rare_language(spark):
    """All n-grams of a long text outweigh the prior of a frequent, related language."""
    usual = "the old house by the river had a red door and ten small windows".split()
    rare = lambda n: " ".join("zjq" if i % 9 == 4 else usual[i * 5 % 14] for i in range(n))
    ids = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 3 != 1][:3001]
    held = next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 3 == 1)
    texts = [(i, " ".join(usual[(i + k) * 5 % 14] for k in range(14)), "often") for i in ids[:-1]]
    texts += [(ids[-1], rare(40_000), "rare"), (held, rare(2000), None)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = langid.identify(rows).filter(F.col("doc_id") == held).first()
    assert got["lang_pred"] == "rare" and got["posterior"] > 0.99 and 0.5 <= got["score"] < got["posterior"]
    # Among close languages the score of a long text may be low, its posterior is not.
    import numpy as np

    names = [f"l{i}" for i in range(8)]
    near = np.tile(np.log(np.full(langid.BUCKETS, 1 / langid.BUCKETS)), (8, 1)).T.copy()
    near[:, 3] += 0.02
    lang, score, posterior = langid.LanguageModel(names, np.log(np.full(8, 1 / 8)), near).predict([b"some words " * 500])[0]
    assert lang == "l3" and score < 0.5 < posterior


def test_language_pieces_are_whole():
    import numpy as np

    text = ("abc déf " * 5000).encode()
    whole = langid.gram_counts(text)
    chunk, langid.CHUNK = langid.CHUNK, 777
    try:
        assert (langid.gram_counts(text) == whole).all()
    finally:
        langid.CHUNK = chunk
    assert whole.sum() == sum(40_000 - n + 1 for n in (1, 2, 3)) and isinstance(whole, np.ndarray)


def test_language_batch_is_sparse_counts(monkeypatch):
    """The sparse matrix of a batch holds the counts of every text, whatever its pieces."""
    import numpy as np

    texts = [b"", b"a", "d\u00e9f".encode(), b"ab " * 400, b"x1y", "\u4f60\u597d".encode() * 300, b"ab " * 400]
    for group in (1, 5, 1 << 17):
        monkeypatch.setattr(langid, "GROUP", group)
        got = np.zeros((len(texts), langid.BUCKETS), np.int64)
        for text, bucket, n in langid.sparse_counts(texts):
            assert (np.diff(text) >= 0).all()
            np.add.at(got, (text, bucket), n)
        assert (got == np.array([langid.gram_counts(t) for t in texts])).all()
    assert langid.LanguageModel([], np.zeros(0), np.zeros((langid.BUCKETS, 0))).predict([b"abc", None]) == [("und", 0.0, 0.0)] * 2


def test_lines(spark):
    rows = docs(
        spark, ["A long enough line\nshort\nA long enough line", " a LONG enough line \nshort\nother text here", None, "", "x\n\n", "a long enough line"],
        [1, 2, 3, 4, 5, None])
    got = by_id(linededup.dedup_lines(rows))
    assert got[1]["text"] == "A long enough line\nshort\nA long enough line" and got[1]["n_dropped"] == 0
    assert got[2]["text"] == "short\nother text here" and (got[2]["n_lines"], got[2]["n_dropped"]) == (3, 1)
    assert (got[3]["text"], got[3]["n_lines"]) == ("", 1) and (got[5]["text"], got[5]["n_lines"]) == ("x\n\n", 3)
    assert got[None]["text"] == "" and got[None]["n_dropped"] == 1


def test_line_index_holds_its_keys_only():
    import numpy as np

    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(-2**63, 2**63 - 1, 5000) for _ in range(2))
    index = linededup.LineIndex.from_bytes(linededup.LineIndex.build(h1, h2, np.arange(5000), np.arange(5000) * 2).to_bytes())
    slot = index.probe(h1, h2)
    assert sorted(slot) == list(range(5000)) and (index.first[slot] == np.arange(5000) * 2).all()
    other, print_ = (rng.integers(-2**63, 2**63 - 1, 5000) for _ in range(2))
    assert (index.probe(other, print_) < 0).all() and (index.probe(h1, print_) < 0).all()
    none = linededup.LineIndex.build(h1[:0], h2[:0], h1[:0], h1[:0])
    assert (none.probe(h1, h2) < 0).all()


def test_hot_lines_take_several_slots(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SLOT_PROBES", 10)
    rows = docs(spark, [f"the very same line\nline number {i} of its own" for i in range(100)])
    got = by_id(linededup.dedup_lines(rows))
    assert got[0]["n_dropped"] == 0 and all(got[i]["text"] == f"line number {i} of its own" for i in range(1, 100))


def test_licences(spark):
    rows = docs(spark, [
        "All rights reserved. ALL RIGHTS RESERVED", "Licensed under CC BY-NC 4.0.", "cc, by", None,
        "x Licensed under the Apache License, Version 2.0.", "under the GNU General Public License version 3", "all rights"])
    got = {i: [(p["label"], p["at"]) for p in r["places"]] for i, r in by_id(licenses.scan_licences(rows)).items()}
    assert got[0] == [("reserved", 0), ("reserved", 3)] or sorted(got[0]) == [("reserved", 0), ("reserved", 3)]
    assert sorted(got[1]) == [("cc-by", 2), ("cc-by-nc-4.0", 0)]
    assert got[2] == [("cc-by", 0)] and got[3] == [] and got[6] == []
    assert ("apache-2.0", 1) in got[4]
    assert ("gpl", 3) in got[5] and ("gpl-3.0", -1) in got[5]


def test_secrets_by_owner(spark):
    key = "ghp_" + "aB3dE6" * 7
    rows = spark.createDataFrame(
        [(i, f"token = '{'abcdef0123' * 2}'", f"o{i}") for i in range(6)]
        + [(10, f"😀 {key}", "me"), (11, key, "me"), (12, None, None), (13, "secret: token: abcdefgh", "z"), (14, "AKIA" + "A" * 15, "z")],
        "doc_id long, text string, source string")
    got = by_id(secrets.scan_secrets(rows))
    assert {s["verdict"] for i in range(6) for s in got[i]["spans"]} == {"example"}
    assert [(s["kind"], s["start"], s["verdict"], s["n_repos"], s["n_owners"]) for s in got[10]["spans"]] == [("github", 2, "live", 2, 1)]
    assert got[12]["spans"] == [] and got[13]["spans"] == [] and got[14]["spans"] == []


def test_private_keys_count_by_their_body(spark):
    """Keys of one type are told apart, and a document copied into few sources keeps its spans."""
    def pem(n, end="-----END RSA PRIVATE KEY-----"):
        body = "\n".join(f"MIIEow{n}{'aB3+/x' * 9}{i}Q9" for i in range(5))
        return f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n{end}"

    token = "ghp_" + "aB3dE6" * 7
    texts = [(i, f"key: {pem(i)} end", f"o{i}") for i in range(8)]
    texts += [(20 + i, pem("x").replace("\n", "\r\n" if i % 2 else "\\n"), f"o{i}") for i in range(5)]
    texts += [(30 + i, pem("y"), f"o{i}") for i in range(3)] + [(40 + i, token, f"o{i}") for i in range(4)]
    texts += [(50, pem("cut", ""), "o1"), (51, f"{pem('a', '')}{pem('b')}", "o1"), (52, "-----BEGIN PRIVATE KEY----- is its header", "o1")]
    texts += [(60 + i, "ghp_" + "x" * 40, "o1") for i in range(2)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, source string")
    got = {i: [(s["kind"], s["start"], s["end"], s["verdict"], s["n_owners"]) for s in r["spans"]] for i, r in by_id(secrets.scan_secrets(rows)).items()}
    assert all(got[i] == [("pem", 5, 5 + len(pem(i)), "live", 1)] for i in range(8))
    # Five owners of one key, however its lines end, hold an example.
    assert all(got[20 + i] == [] for i in range(5))
    assert all(got[30 + i] == [("pem", 0, len(pem("y")), "unsure", 3)] for i in range(3))
    assert all(got[40 + i] == [("github", 0, 46, "unsure", 4)] for i in range(4))
    # A key that is cut off counts by what it has; a header alone is no key.
    assert got[50] == [("pem", 0, len(pem("cut", "").rstrip()), "live", 1)]
    assert [s[0] for s in got[51]] == ["pem", "pem"] and got[52] == [] and got[60] == []


def test_quality_rules(spark):
    good = [" ".join(f"word{i * j % 97}" for i in range(40)) for j in range(1, 60)]
    bad = [g.replace(" ", " # ") for g in good]
    rows = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < len(good))) for i in range(len(good + bad))], LABELS)
    got = by_id(quality.judge(rows, labels))
    assert all(got[i]["rule"] == 0 for i in range(len(good))) and all(got[i]["rule"] > 0 for i in range(len(good), len(got)))
    plain = by_id(quality.judge(rows, labels.limit(0)))
    assert all(r["rule"] == 0 for r in plain.values())


def test_targets_fill_up(spark):
    totals = spark.createDataFrame([("a", 10, 1), ("b", 200, 1), (None, 1000, 1), ("c", 0, 1)], "source string, source_size long, n_rows long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(totals).collect()}
    # Weights a 5, b 2, c 1, null 5: a and c are full at three times their size.
    assert got["a"] == 30.0 and got["c"] == 0.0
    assert got["b"] == pytest.approx(1180 * 2 / 7) and got[None] == pytest.approx(1180 * 5 / 7)


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_tree_splits_exactly(spark, shards):
    quotas = {0: 100, 1: 3, 2: 0, 3: 41}
    rows = spark.createDataFrame(list(quotas.items()), "source_no long, n long")
    got = mixing.split_tree(rows, shards).collect()
    sums, sizes = {}, {}
    for r in got:
        assert r["n"] >= 0
        sums[r["source_no"]] = sums.get(r["source_no"], 0) + r["n"]
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["n"]
    assert sums == quotas and len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.split_tree(rows, shards).collect()))


def test_mix_meets_targets(spark):
    rows = docs(spark, [" ".join(["w"] * (1 + i * 7 % 40)) for i in range(400)] + [None])
    mixed = mixing.mix(rows, block_words=100, block_rows=20).withColumn("taken", mixing.taken("draws"))
    out = mixed.collect()
    for source in (None, "s"):
        own = [r for r in out if r["source"] == source]
        assert sum(r["taken"] for r in own) == round(own[0]["target"])
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    units = [(d["epoch"], r["doc_id"]) for r in out for d in r["draws"]]
    assert len(units) == len(set(units))
    again = mixing.mix(rows, block_words=100, block_rows=20).collect()
    assert {r["doc_id"]: sorted(map(tuple, r["draws"])) for r in again} == {r["doc_id"]: sorted(map(tuple, r["draws"])) for r in out}
    # The shards' units are those of the tree: as many as its quotas say, each taken once.
    dealt = {(r["source"], d["epoch"], d["shard"]) for r in out for d in r["draws"]}
    assert {s for _, _, s in dealt} == set(range(mixing.SHARDS))
    shards = mixing.shuffled_shards(mixed)
    assert shards.agg(F.sum("words")).first()[0] == sum(r["taken"] for r in out)


def test_mix_without_ids(spark):
    """Rows without an id, or that repeat one, are spread over the blocks by their text."""
    texts = [" ".join(["w"] * (1 + i % 40)) + f" t{i}" for i in range(300)] + ["", None, "   "]
    rows = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 1, F.lit(7)).cast("long"))
    out = mixing.mix(rows, block_words=200, block_rows=20).withColumn("taken", mixing.taken("draws")).collect()
    assert len(out) == len(texts)
    assert len({d["shard"] for r in out for d in r["draws"]}) > 4
    for source in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == source]
        assert sum(r["taken"] for r in own) == round(own[0]["target"])
    assert all(r["draws"] == [] for r in out if r["size"] == 0)


def test_tree_is_hypergeometric(spark):
    """Over many seeds a shard's share of a source has the mean and variance of the law."""
    rows = spark.createDataFrame([(0, 12), (1, 36)], "source_no long, n long")
    n = []
    for seed in range(12):
        got = mixing.split_tree(rows, 4, seed).filter("source_no = 0").collect()
        own = {r["shard"]: r["n"] for r in got}
        n += [own.get(s, 0) for s in range(4)]
        assert sum(own.values()) == 12
    # Mean 3; variance 12 * 1/4 * 3/4 * 36/47 = 1.7.
    assert sum(n) == 36 * 4 and 0.9 < sum((x - 3) ** 2 for x in n) / len(n) < 2.9


PAGE = """<html><body><header class="site"><h1>Site</h1></header><div id="cookie-notice">Cookies</div><div class="wrap p{n}">
<ul class="menu"><li><a href=x>Home</a></ul><div class="post-content"><h1>Title &amp; more</h1><p>First <b>bold</b>text.
<p>Second &lt;para&gt;&nbsp;here<br>line two<ul><li>one<li>two</ul><div class="ad-box">BUY</div><form>Mail</form>
<blockquote>Quote</blockquote></div><section class="comments"><p>Nice post!</p></section></div>
<aside>side</aside><footer>(c)</footer><script>if(a<b)x="</div>"</script></body></html>"""
TEXT = "Title & more\nFirst boldtext.\nSecond <para> here line two\none\ntwo\nQuote"


def test_pages(spark):
    rows = spark.createDataFrame(
        [(i, f"http://h.example/{i}", PAGE.replace("{n}", str(i))) for i in range(4)]
        + [(10, None, PAGE), (11, "not a url", None), (12, "", ""), (13, "http://h.example/x", "<p>plain &copy; text<p>two"),
           (14, "http://k/", "<nav>menu</nav>"), (15, "http://k/", "<div><p>a" + "<b>" * 3000 + "deep < unclosed \"quote")],
        "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("path", F.lit("x"))
    got = {r["page_id"]: r["text"] for r in pages.extract_pages(rows).collect()}
    assert all(got[i] == TEXT for i in (0, 1, 2, 3, 10))
    assert got[11] == got[12] == got[14] == "" and got[13] == "plain © text\ntwo"
    assert got[15].startswith("adeep < unclosed")
    assert pages.extract_pages(rows.limit(0)).count() == 0


def test_host_vote_overrules_a_page(spark):
    """A page whose own best container is another one follows its host."""
    usual = "<div class='story'><h1>T</h1><p>{}</p></div><div class='more'><p>few</p></div>"
    odd = "<div class='story'><p>few words</p></div><div class='more'><h1>T</h1><p>" + "much more text " * 30 + "</p></div>"
    rows = spark.createDataFrame(
        [(i, "http://h/", usual.format("long text " * 20)) for i in range(5)] + [(9, "http://h/", odd), (10, "http://other/", odd)],
        "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract_pages(rows).collect()}
    assert got[9] == "few words" and "T\nmuch more" in got[10]


def test_pii_votes_and_kinds(spark):
    rows = docs(spark, [
        "mail me: a.b@c.example.org, or x@y", "999.1.2.3 and 10.0.0.1", "card 4111 1111 1111 1111", "+1 (555) 010-9999", None,
        "IBAN DE89 3704 0044 0532 0130 00 please", "a@b.c._d@e.f"] + ["my ssn 123-45-6789"] * 12)
    got = {i: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for i, r in by_id(pii.find_pii(rows)).items()}
    assert got[0] == [("email", 9, 26)] and got[1] == [("ip", 14, 22)]
    assert got[2][0] == ("card", 5, 24) and got[3][0] == ("phone", 0, 17) and got[4] == []
    assert got[5] == [("iban", 5, 32)]
    assert got[6] == [("email", 0, 5), ("email", 5, 11)] or got[6][0] == ("email", 0, 5)
    assert all(got[i] == [("ssn", 7, 18)] for i in range(7, 19))


def test_names_after_a_capitalised_word(spark):
    """Every adjacent pair is a candidate, accents included, and the better one is chosen."""
    texts = ["Dear Anna Weber, hello", "to Mr John Smith of here", "so The Peter Miller came", "Dear José Müller, hello"] * 10
    texts += ["Green House stands there", "see New York City now"] * 20
    rows = docs(spark, texts)
    got = {i: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for i, r in by_id(pii.find_pii(rows)).items()}
    assert got[0] == [("name", 5, 15)] and got[1] == [("name", 6, 16)]
    assert got[2] == [("name", 7, 19)] and got[3] == [("name", 5, 16)]
    assert all(got[i] == [] for i in range(40, 80))
    value = lambda *xs: [{"start": 5 * i, "end": 5 * i + 9, "score": x} for i, x in enumerate(xs)]
    assert [s["score"] for s in pii.disjoint(value(0.7, 0.8, 0.9))] == [0.7, 0.9]
    assert [s["start"] for s in pii.disjoint(value(0.8, 0.8))] == [0]


def test_em_tells_good_labelers_from_bad():
    patterns = [((1, 1, 0), 90.0), ((-1, -1, 0), 90.0), ((1, 0, 1), 30.0), ((1, 0, -1), 30.0), ((-1, 0, 1), 30.0), ((-1, 0, -1), 30.0)]
    share, rely, post = pii.reliabilities(patterns, 0.5)
    assert rely["regex"] > 0.9 and rely["gazetteer"] > 0.9 and rely["context"] < 0.65
    assert post[(1, 1, 0)] > 0.95 and post[(-1, -1, 0)] < 0.05 and 0.4 < share < 0.6


@pytest.mark.parametrize("name", ["content no-sidebar", "content-sidebar-wrap", "page with-sidebar", "has-related post-body"])
def test_layout_classes_keep_their_article(spark, name):
    """A class that tells of a sidebar is no sidebar; a real one inside still goes."""
    body = "".join(f"<p>Sentence {i} of the article, long enough to be its text.</p>" for i in range(6))
    page = f'<body><div class="{name}"><div class="entry">{body}</div><div class="sidebar"><p>Buy now</p></div><div class="post-navigation"><p>Next</p></div></div></body>'
    rows = spark.createDataFrame([(1, "http://a.example/x", page)], "page_id long, url string, html string")
    (row,) = pages.extract_pages(rows).collect()
    assert row["text"].split("\n") == [f"Sentence {i} of the article, long enough to be its text." for i in range(6)]
