"""BPE against the library that the vocabulary files belong to."""

import hashlib
import os
import random

import pytest

pytest.importorskip("pricetrail.llm")
tokenizers = pytest.importorskip("tokenizers")

import numpy as np  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from pricetrail.llm import bpe  # noqa: E402
from pricetrail.llm.queries import QUERIES  # noqa: E402

PATH = bpe.vocabulary_path()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.Vocabulary.read(PATH))
SF = "/root/testdata/sf0.001"


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def mine(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


def check(text):
    ids = library(text)
    assert mine(text) == ids, repr(text[:80])
    assert ENCODER.decode(ENCODER.encode(text)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


def test_texts_of_awkward_parts(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 20)
    parts = ["ab", " ", "c", "'s", "'LL", "\n\n", "\t", "é", "́", "Σ", "ΑΣ ", "İ", "½", "12", "!?", "日本", "\x1c", "\x85", "\xa0",
             "<|endoftext|>", "<|startoftext|>", "<|", "_", "\U0001f600", "‍", "the", "ing"]
    rng = random.Random(5)
    for _ in range(3000):
        check("".join(rng.choice(parts) for _ in range(rng.randrange(30))))


def test_every_character_class():
    """One character of every block of 61, between letters, digits and signs."""
    for c in range(0, 0x110000, 61):
        if not 0xD800 <= c < 0xE000:
            check(f"a{chr(c)}b1{chr(c)}!{chr(c)}")


def test_long_words():
    """Scan and heap merge alike; a word of a million letters is no trouble."""
    rng = random.Random(6)
    for n in (1, 2, bpe.SHORT_WORD - 1, bpe.SHORT_WORD, bpe.SHORT_WORD + 1, 4000):
        for letters in ("a", "ab", "etaoinshr"):
            word = "".join(rng.choice(letters) for _ in range(n))
            check(word)
            v = ENCODER.vocabulary
            ids = [v.inner[b] for b in word.encode()]
            assert bpe.merge_short(ids[:], v.merges) == bpe.merge_long(ids[:], v.merges)
    assert len(mine("ab" * 500_000)) > 1


def test_cache_bound(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 8)
    encoder = bpe.Encoder(ENCODER.vocabulary)
    text = " ".join(f"word{i}" for i in range(300)) + " " + "long" * 100
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text)
    assert len(encoder.words) <= 8 and len(encoder.chunks) <= 8


def test_vocabulary_bounds(tmp_path):
    with pytest.raises(ValueError):
        bpe.Vocabulary.read(PATH, max_bytes=10)
    with pytest.raises(ValueError):
        bpe.Vocabulary({
            "model": {"type": "Unigram"}, "normalizer": {"normalizers": []},
            "pre_tokenizer": {"pretokenizers": [{"type": "Split"}, {"type": "ByteLevel"}]}})


def test_operator_on_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    texts = [None, "", " \n\t", "Hello, World!", "Hello, World!", long, "<|endoftext|> x"]
    ids = [1, 2, 3, 4, 4, None, 6]
    schema = "doc_id long, text string, tokens string, decoded int, lang string"
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in zip(ids, texts)], schema)
    encoded = bpe.encode_texts(docs, PATH)
    assert encoded.columns == ["doc_id", "tokens"]
    got = sorted(((r["doc_id"] or 0, r["tokens"], r["decoded"]) for r in bpe.decode_tokens(encoded, PATH).collect()))
    want = []
    for i, t in zip(ids, texts):
        x = library(t or "")
        want.append((i or 0, np.array(x, "<u4").tobytes(), LIBRARY.decode(x, skip_special_tokens=False)))
    assert [(i, bytes(t), d) for i, t, d in got] == sorted(want)
    empty = spark.createDataFrame([], schema)
    assert bpe.decode_tokens(bpe.encode_texts(empty, PATH), PATH).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, tokens binary")
    assert bpe.decode_tokens(none, PATH).first()["decoded"] is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_the_library(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op11_bpe"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library(t or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
