"""BPE encoding and decoding with a contiguous array of ranks.

A word is held as parts side by side: where each part begins, its token, and the
rank of the merge with the part to its right. The smallest rank, the leftmost of
equal ones, is searched by scanning the array; that boundary is deleted and the ranks
of the two parts beside it are looked up again, until no merge is left. A word of
more than ``SHORT_WORD`` parts would cost the square of its length this way: its
ranks lie in a heap instead, with the same order of merges.

The vocabulary is a file of the ``tokenizers`` library, BPE with word ends: text in
canonical composition and lower case, split by the file's pattern, bytes written as
printable characters. The driver reads it once and broadcasts it; its size is
checked. Texts are encoded in Arrow batches; a Python worker keeps the tokens of the
words it has seen, up to ``CACHE_WORDS`` of them.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import query, small_batches, table

#: Words of more parts (bytes) are merged through a heap.
SHORT_WORD = 96
#: Words and chunks that a Python worker remembers, each of at most CACHE_LENGTH characters.
CACHE_WORDS = 1 << 18
CACHE_LENGTH = 64
#: Characters of a text handled at once; a text is cut at white space only.
PIECE = 1 << 20
#: A larger vocabulary file is not broadcast.
MAX_FILE_BYTES = 64 << 20

_NO_MERGE = 1 << 62
_LEFT = 32
_GAP = re.compile(r"[\t-\r ]")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable
    in Latin-1 and no space, the others in order from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in keep else next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "dropout") if model.get(k)]
        if (model["type"], split["type"], level["type"]) != ("BPE", "Split", "ByteLevel") or odd:
            raise ValueError(f"not a BPE tokenizer with word ends: {model['type']}, {odd}")
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or spec["decoder"] is not None:
            raise ValueError(f"normalizer, split or decoder not supported: {steps}")
        vocab = model["vocab"]
        self.pattern = split["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"]
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + self.end] for c in chars]
        #: (left << 32 | right) -> (rank << 32 | merged)
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << _LEFT | vocab[b], rank << _LEFT | vocab[a + b])
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()], default=-1) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token

    @classmethod
    def read(cls, path: str, max_bytes: int = MAX_FILE_BYTES) -> "Vocabulary":
        if os.path.getsize(path) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes; give the bound as max_bytes")
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))


def merge_short(ids: list[int], merges: dict[int, int]) -> list[int]:
    """Tokens of a word from the tokens of its bytes, by scanning adjacent ranks.

    ``ids[i]`` is the part that begins at boundary i; deleting a boundary removes its
    entry, so parts, boundaries and ranks stay side by side.
    """
    rank = merges.get
    ranks = [rank(a << _LEFT | b, _NO_MERGE) for a, b in zip(ids, ids[1:])]
    while ranks:
        low = min(ranks)
        if low == _NO_MERGE:
            break
        i = ranks.index(low)
        ids[i] = low & 0xFFFFFFFF
        del ids[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = rank(ids[i] << _LEFT | ids[i + 1], _NO_MERGE)
        if i:
            ranks[i - 1] = rank(ids[i - 1] << _LEFT | ids[i], _NO_MERGE)
    return ids


def merge_long(ids: list[int], merges: dict[int, int]) -> list[int]:
    """As ``merge_short`` in n log n: ranks in a heap, parts linked to their neighbours."""
    n = len(ids)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    rank = merges.get
    heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << _LEFT | ids[i + 1], _NO_MERGE)) != _NO_MERGE]
    heapify(heap)
    while heap:
        r, i = heappop(heap)
        j = right[i]
        if ids[i] < 0 or j >= n or rank(ids[i] << _LEFT | ids[j], _NO_MERGE) != r:
            continue
        ids[i], ids[j] = r & 0xFFFFFFFF, -1
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if (r := rank(ids[i] << _LEFT | ids[k], _NO_MERGE)) != _NO_MERGE:
                heappush(heap, (r, i))
        if (h := left[i]) >= 0 and (r := rank(ids[h] << _LEFT | ids[i], _NO_MERGE)) != _NO_MERGE:
            heappush(heap, (r, h))
    return [x for x in ids if x >= 0]


class Seen(dict):
    """Packed tokens of what was met before; an unknown key is encoded on access."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, key: str) -> bytes:
        out = self.encode(key)
        if len(key) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[key] = out
        return out


class Encoder:
    """Encodes and decodes single texts; one per Python worker.

    A text is cut at white space first: neither a word nor a composition reaches
    across. The words of such a chunk are split off by the file's pattern. Character
    classes, composition and lower case outside ASCII are those of the library's own
    normalizer and splitter, whose Unicode version differs from Python's.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        inner = vocabulary.pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]")
        self.ascii_words = re.compile(inner.replace(r"[^\s\p{L}\p{N}]", r"[^\x09-\x0D\x20a-z0-9]")).findall
        self.normalize = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.split = pre_tokenizers.Split(Regex(vocabulary.pattern), "removed", invert=True).pre_tokenize_str
        self.special = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None
        self.words = Seen(self.word)
        self.chunks = Seen(self.chunk)

    def word(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        ids = [self.vocabulary.inner[b] for b in raw]
        ids[-1] = self.vocabulary.last[raw[-1]]
        merge = merge_short if len(ids) <= SHORT_WORD else merge_long
        ids = merge(ids, self.vocabulary.merges)
        return struct.pack(f"<{len(ids)}I", *ids)

    def chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            words = self.ascii_words(chunk.lower())
        else:
            words = [w for w, _ in self.split(self.normalize(chunk))]
        return b"".join(map(self.words.__getitem__, words))

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about ``PIECE`` characters, cut before white space."""
        at = 0
        while len(text) - at > PIECE:
            stop = _GAP.search(text, at + PIECE)
            if stop is None:
                break
            yield text[at:stop.start()]
            at = stop.start()
        yield text[at:] if at else text

    def plain(self, text: str) -> bytes:
        out = []
        for piece in self.pieces(text):
            if piece.isascii():
                piece = piece.lower()
            # Python alone takes these four separators for white space.
            chunks = _GAP.split(piece) if _SEPARATORS.search(piece) else piece.split()
            out.append(b"".join(map(self.chunks.__getitem__, chunks)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Tokens as little-endian unsigned 32-bit integers."""
        if self.special is None or "<|" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append(self.plain(text[at:m.start()]))
            out.append(struct.pack("<I", self.vocabulary.special[m.group()]))
            at = m.end()
        out.append(self.plain(text[at:]))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """Tokens joined by a space, special ones included: the file names no decoder."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


#: The encoder of this Python worker, under the name its driver gave the vocabulary.
_own: dict[str, Encoder] = {}


def _encoder(name: str, known) -> Encoder:
    if name not in _own:
        _own.clear()
        _own[name] = Encoder(known.value)
    return _own[name]


def encode_texts(docs: DataFrame, vocabulary: str, column: str = "text", max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(doc_id, tokens): every text as the packed tokens (little-endian unsigned 32-bit
    integers) of the vocabulary file at the path ``vocabulary``.

    Texts are whole, whatever their length: a text is handled in pieces cut at white
    space, and a single word of any length costs n log n. Strings of special tokens in
    a text become those tokens; none is added.

    Defined cases: null and empty texts, and those of white space only, have no token;
    a null doc_id stays null; repeated rows and texts give a row each; an empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known, name = spark.sparkContext.broadcast(Vocabulary.read(vocabulary, max_bytes)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, known)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = pa.array((encoder.encode(t) if t else b"" for t in texts), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), tokens], names=["doc_id", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tokens binary")


def decode_tokens(rows: DataFrame, vocabulary: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(doc_id, tokens, decoded): the text that the library's decoding gives for packed
    ``tokens``, special tokens kept.

    Defined cases: null tokens decode to null, none to the empty text; tokens that the
    vocabulary lacks, or bytes that are no whole number of tokens, raise an error.
    """
    spark = rows.sparkSession
    small_batches(spark)
    known, name = spark.sparkContext.broadcast(Vocabulary.read(vocabulary, max_bytes)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, known)
        for batch in batches:
            packed: Iterable[bytes | None] = batch.column(1).to_pylist()
            decoded = pa.array((None if p is None else encoder.decode(p) for p in packed), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), decoded], names=["doc_id", "tokens", "decoded"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "tokens").mapInArrow(
        run, "doc_id long, tokens binary, decoded string")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op11_bpe")
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, encoded and decoded again."""
    path = vocabulary_path()
    rows = decode_tokens(encode_texts(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id", F.expr("octet_length(tokens) div 4").cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
