"""PII by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are found by patterns; labelers of three families (regex and checksum,
gazetteer, context words) vote yes, no or abstain on each. Spark counts the vote
patterns of each kind; expectation-maximisation on these counts estimates how
reliable each labeler is, with no labels given. The posteriors train the final
classifier, a naive Bayes over discrete span features whose weighted counts Spark
sums. Counts are bounded by labelers and feature values, not by the corpus.

Base kinds are always reported; the classifier decides on candidates of added kinds.
"""

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import query, small_batches, table

# The base kinds in their order, as patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

def _letters(*categories: str) -> str:
    """The characters of Unicode categories, as the inside of a character class.

    Of the scripts with case beyond the first 65536 characters all letters are taken,
    as one range: a class of many such characters is searched one by one.
    """
    return "".join(c for c in map(chr, range(1 << 16)) if unicodedata.category(c) in categories) + "\U00010400-\U0001e943"


# A word of a name, a capital and letters with their accents.
CAPITAL, TAIL = f"[{_letters('Lu', 'Lt')}]", f"[{_letters('Ll', 'Mn')}]{{1,20}}"

# Shapes of added candidates. Names overlap: every adjacent pair is one.
ADDED = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "name": re.compile(rf"{CAPITAL}(?<!\w.)(?=({TAIL} {CAPITAL}{TAIL})(?!\w))"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "user": re.compile(r"(?<![\w@.])@[A-Za-z][A-Za-z0-9_]{2,30}(?![\w@.])"),
}
KINDS = (*BASE_KINDS, *ADDED)

# Gazetteers and context words.
GIVEN_NAMES = frozenset(
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Anna Maria Peter Paul Hans Klaus Ursula Pierre Marie Jean Claire Carlos Carmen Jose Juan".split())
RESERVED = ("example.com", "example.org", "example.net", "test", "invalid", "localhost")
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login", "from"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "cc"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "whatsapp"),
    "iban": ("iban", "account", "bank", "transfer"),
    "name": ("name", "mr", "mrs", "ms", "dr", "dear", "by", "herr", "frau", "madame", "señor"),
    "ssn": ("ssn", "social", "security"),
    "user": ("twitter", "instagram", "handle", "follow", "user"),
}
NOT_CONTEXT = ("version", "order", "isbn", "article", "section", "example", "sample", "invoice")

#: Code points of text before a span that the context labeler reads.
CONTEXT_CHARS = 40
#: Rounds of EM, and the posterior from which a candidate of an added kind is a span.
ROUNDS = 50
THRESHOLD = 0.5
PRIOR = {k: 0.9 for k in BASE_KINDS} | {"iban": 0.7, "name": 0.2, "ssn": 0.5, "user": 0.3}

LABELERS = ("regex", "gazetteer", "context")
#: Reliability that EM starts from and is drawn to, as votes seen before.
START = {"regex": 0.85, "gazetteer": 0.8, "context": 0.75}
WEIGHT = 20.0

FEATURES = ("shape", "length", "context", "before", "after", "gazetteer")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outward in linear time."""
    floor, at = 0, text.find("@")
    while at >= 0:
        head = text[floor:at]
        size = len(head) - len(head.rstrip(LOCAL))
        match = DOMAIN.match(text, at + 1) if size else None
        if match:
            yield at - size, match.end()
            floor = match.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def added_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, m.start(), m.end(pattern.groups)) for kind, pattern in ADDED.items() for m in pattern.finditer(text)]


def _iban(value: str) -> bool:
    s = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _shape(value: str) -> str:
    """Runs of letters, digits and others as one sign each; eight signs, so 384 shapes at most."""
    short = re.sub(r"[^\W\d_]+", "a", value[:64])
    return re.sub(r"[^a9]+", ".", re.sub(r"[0-9]+", "9", short))[:8]


_WORDS = re.compile(r"[\w-]+")


def _plain(name: str) -> str:
    """A name without accents, as the gazetteer has it."""
    return name if name.isascii() else "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))


def vote(kind: str, value: str, before: str) -> tuple[tuple[int, int, int], tuple[str, ...]]:
    """The votes of the labelers (1 yes, -1 no, 0 abstain) and the features of a span."""
    near = [w.lower() for w in _WORDS.findall(before)]
    if kind == "iban":
        regex = 1 if _iban(value) else -1
    elif kind == "ssn":
        a, b, c = value.split("-")
        regex = -1 if a in ("000", "666") or a[0] == "9" or b == "00" or c == "0000" else 1
    elif kind == "ip":
        regex = -1 if value.startswith(("0.", "127.", "255.")) else 1
    elif kind == "card":
        regex = 1 if value[0] in "3456" else -1
    elif kind == "email":
        regex = 1 if value.rsplit(".", 1)[-1].isalpha() else -1
    elif kind == "phone":
        regex = 1
    else:
        regex = 0
    if kind == "email":
        gazetteer = -1 if value.lower().endswith(RESERVED) else 0
    elif kind == "name":
        gazetteer = 1 if _plain(value.split()[0]) in GIVEN_NAMES else -1
    else:
        gazetteer = 0
    if any(w in CONTEXT[kind] for w in near):
        context = 1
    elif any(w in NOT_CONTEXT for w in near):
        context = -1
    else:
        context = 0
    features = (
        _shape(value), str(min(len(value) // 4, 12)), str(context),
        _shape(before[-2:]), "1" if value[:1].isupper() else "0", str(gazetteer))
    return (regex, gazetteer, context), features


_SPAN = pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
    ("votes", pa.list_(pa.int8())), ("features", pa.list_(pa.string()))])
_SPANS = "spans array<struct<kind:string,start:long,end:long,votes:array<tinyint>,features:array<string>>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            rows = []
            for kind, a, b in base_spans(text) + added_spans(text) if text else ():
                votes, features = vote(kind, text[a:b], text[max(0, a - CONTEXT_CHARS):a])
                rows.append({"kind": kind, "start": a, "end": b, "votes": votes, "features": features})
            out.append(rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(_SPAN))], names=["doc_id", "spans"])


def reliabilities(patterns: list[tuple[tuple[int, ...], float]], prior: float) -> tuple[float, dict[str, float], dict]:
    """EM over (votes, count): the share of true spans, each labeler's reliability, and
    the posterior of each vote pattern.

    A labeler is right with its reliability on spans of either class, where it votes.
    The start values count as ``WEIGHT`` votes, so that few spans don't run away.
    """
    share = prior
    rely = dict(START)
    post: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        for votes, _n in patterns:
            yes, no = share, 1 - share
            for name, v in zip(LABELERS, votes):
                if v:
                    yes *= rely[name] if v > 0 else 1 - rely[name]
                    no *= 1 - rely[name] if v > 0 else rely[name]
            post[votes] = yes / (yes + no)
        total = sum(n for _, n in patterns)
        share = (prior * WEIGHT + sum(post[v] * n for v, n in patterns)) / (WEIGHT + total)
        share = min(max(share, 1e-3), 1 - 1e-3)
        for i, name in enumerate(LABELERS):
            right, seen = START[name] * WEIGHT, WEIGHT
            for votes, n in patterns:
                if votes[i]:
                    p = post[votes]
                    right += n * (p if votes[i] > 0 else 1 - p)
                    seen += n
            rely[name] = min(max(right / seen, 0.05), 0.99)
    return share, rely, post


class SpanClassifier:
    """Naive Bayes over span features, per kind, from EM posteriors."""

    def __init__(self, shares: dict[str, float], weights: dict[tuple[str, str, str], tuple[float, float]]):
        self.shares = shares
        self.table: dict[tuple[str, str, str], float] = {}
        totals: dict[tuple[str, str], np.ndarray] = {}
        sizes: dict[tuple[str, str], int] = {}
        for (kind, feature, _), w in weights.items():
            totals[kind, feature] = totals.get((kind, feature), np.zeros(2)) + w
            sizes[kind, feature] = sizes.get((kind, feature), 1) + 1
        for (kind, feature, value), w in weights.items():
            p = (np.array(w) + 1.0) / (totals[kind, feature] + sizes[kind, feature])
            self.table[kind, feature, value] = float(np.log(p[0]) - np.log(p[1]))

    def log_odds(self) -> list[tuple[str, str, str, float]]:
        """The model as rows: the share of a kind, and the weight of each feature value."""
        rows = [(k, "", "", float(np.log(s) - np.log(1 - s))) for k, s in self.shares.items()]
        return rows + [(*k, w) for k, w in self.table.items()]


def train(spans: DataFrame) -> SpanClassifier:
    """EM on the vote patterns of ``spans`` (kind, votes, features), then the classifier.

    A vote pattern is one of 27 and a feature value one of a fixed set, so what comes
    to the driver has a fixed bound; smoothing holds back values of few spans.
    """
    counts = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    shares, posts = {}, []
    for kind in KINDS:
        patterns = sorted((tuple(r["votes"]), float(r["n"])) for r in counts if r["kind"] == kind)
        share, _, post = reliabilities(patterns, PRIOR[kind])
        shares[kind] = share
        posts += [(kind, list(v), p) for v, p in post.items()]
    session = spans.sparkSession
    table_ = session.createDataFrame(posts, "kind string, votes array<tinyint>, p double")
    named = F.arrays_zip(F.array(*map(F.lit, FEATURES)).alias("feature"), F.col("features").alias("value"))
    each = spans.join(F.broadcast(table_), ["kind", "votes"]).select("kind", "p", F.explode(named).alias("x"))
    sums = each.groupBy("kind", F.col("x.feature").alias("feature"), F.col("x.value").alias("value")).agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    weights = {(r["kind"], r["feature"], r["value"]): (r["yes"], r["no"]) for r in sums.collect()}
    return SpanClassifier(shares, weights)


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): one row per row of ``docs`` (doc_id, text).

    ``spans`` is an array of (kind, start, end, score) by kind as listed, then start,
    in code points with the end exclusive. Base kinds are all there with their score;
    spans of added kinds where the score is ``THRESHOLD`` or more; of overlapping names
    the one with the highest score, then the first.

    Defined cases: null and empty texts have no spans; repeated rows get equal spans
    and count each in training; a corpus without candidates trains nothing; empty
    tables give no rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    found = checkpointed(own.mapInArrow(_find, f"doc_id {kind}, {_SPANS}"), "pii_candidates")
    model = train(found.select(F.explode("spans").alias("s")).select("s.*"))
    rows = model.log_odds()
    odds = F.create_map(*[x for k, f, v, w in rows for x in (F.lit(f"{k}\t{f}\t{v}"), F.lit(w))])
    return _decide(found, odds)


def _decide(found: DataFrame, odds: Column) -> DataFrame:
    weight = lambda *key: F.coalesce(F.try_element_at(odds, F.concat_ws("\t", *key)), F.lit(0.0))

    def score(s: Column) -> Column:
        total = weight(s["kind"], F.lit(""), F.lit(""))
        for i, name in enumerate(FEATURES):
            total = total + weight(s["kind"], F.lit(name), F.get(s["features"], F.lit(i)))
        return 1 / (1 + F.exp(-total))

    order = F.array(*map(F.lit, KINDS))
    spans = F.transform("spans", lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("order"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind"), score(s).alias("score")))
    good = F.filter(F.array_sort(spans), lambda s: (s["order"] <= len(BASE_KINDS)) | (s["score"] >= THRESHOLD))
    rows = found.select("doc_id", F.transform(good, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))).alias("spans"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_choose, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,score:double>>")


def disjoint(names: list[dict]) -> list[dict]:
    """Spans in order of their start without those that overlap a better one that stays."""
    stays = [False] * len(names)
    # Adjacent pairs of words: a span overlaps at most the one before and the one after.
    for i in sorted(range(len(names)), key=lambda i: -names[i]["score"]):
        before = i > 0 and stays[i - 1] and names[i - 1]["end"] > names[i]["start"]
        after = i + 1 < len(names) and stays[i + 1] and names[i]["end"] > names[i + 1]["start"]
        stays[i] = not before and not after
    return [s for s, stay in zip(names, stays) if stay]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans in batch.column(1).to_pylist():
            at = [i for i, s in enumerate(spans) if s["kind"] == "name"]
            # The spans of a kind stand together.
            out.append(spans[:at[0]] + disjoint(spans[at[0]:at[-1] + 1]) + spans[at[-1] + 1:] if at else spans)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, batch.schema.field(1).type)], names=["doc_id", "spans"])


def listed(spans: Column) -> Column:
    """Spans as kind:start:end in their order, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op10_pii")
def op10_pii(spark, sf_dir):
    """Personal data of all documents."""
    found = find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))
