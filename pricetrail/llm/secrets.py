"""Secret scans with corpus-wide ownership frequency.

Every text is scanned for candidates; their hashes are counted over the distinct
repositories and owners that hold them. A value many owners hold is a copied
example, a value of one owner that looks random is a live-looking credential. The
base kinds are always reported; the method adds spans of further kinds unless their
value is a copied example or has too few distinct characters for a credential. The
value of a private key is its body, so keys of one type are told apart.

The hashes are counted in two steps (distinct holders first), both with partial
sums before the shuffle, so a value copied into a third of all files is no hot task.
Texts are read once and never shuffled; the spans are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import query, table

# The base kinds in their order, as patterns.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

# A key up to its END line; of one that is cut off, the header and the
# runs of key characters after it. No '-----' is inside, so a text is read once.
PEM_BEGIN, PEM_END = r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", r"-----END (?:[A-Z]+ )?PRIVATE KEY-----"
PEM = rf"{PEM_BEGIN}(?:[^-]*+(?:-(?!----)[^-]*+)*+{PEM_END}|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{{16,}}+)*+)"
#: What is not the body of a key: its lines of dashes, white space, escaped or not.
NOT_BODY = rf"{PEM_BEGIN}|{PEM_END}|\s|\\[nr]"

# Shapes of further credentials, added unless their value is a copied example.
ADDED = [
    ("github", r"\bgh[opsur]_[A-Za-z0-9]{36,}"),
    ("google", r"\bAIza[0-9A-Za-z_-]{35}"),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    ("pem", PEM),
    ("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    ("url", r"\b[a-z][a-z0-9+]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
]

#: A value that this many owners hold is a copied example.
EXAMPLE_OWNERS = 5
#: Distinct characters that a live-looking value has at least.
LIVE_CHARS = 6


def _spans(text: Column, pattern: str, least: int, kind: str, order: int) -> Column:
    """Leftmost non-overlapping matches of at least ``least`` characters, as structs.

    The pieces between the matches and the matches themselves, put together,
    are the text; so their lengths give the places in code points.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else match
    if kind == "pem":
        value = F.transform(match, lambda m: F.regexp_replace(m, NOT_BODY, ""))
    gap = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(match, F.length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        return F.struct(
            (begin + x["whole"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), (begin + x["whole"]).alias("end")))).alias("spans"))

    pieces = F.zip_with(F.slice(gap, F.lit(1), F.size(whole)), whole, lambda g, w: F.struct(g.alias("gap"), w.alias("whole")))
    places = F.aggregate(pieces, start, step, lambda acc: acc["spans"])
    spans = F.zip_with(places, value, lambda p, v: F.struct(
        p["start"].cast("long").alias("start"), p["end"].cast("long").alias("end"), F.lit(order).alias("order"),
        F.lit(kind).alias("kind"), v.alias("value")))
    return F.filter(spans, lambda s: F.length(s["value"]) >= least)


_SPAN = "struct<start:bigint,end:bigint,order:int,kind:string,value:string>"
_NONE = f"array<{_SPAN}>"


def candidates(text: Column) -> Column:
    """All candidate spans of a text in order: start, end, order of the kind, kind, value."""
    none = F.array().cast(_NONE)
    # Runs too short to pass never need a place: a text without a passing run is left alone.
    base = [
        F.when(text.rlike(ASSIGN), _spans(text, ASSIGN, MIN_ASSIGN, "assign", 0)).otherwise(none),
        F.when(text.rlike(ACCESS), _spans(text, ACCESS, MIN_ACCESS, "access", 1)).otherwise(none),
        # A run of 24 starts where a maximal run starts, so only such runs are matched.
        F.when(text.rlike(f"[0-9a-f]{{{MIN_HEX}}}"), _spans(text, f"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}", MIN_HEX, "hex", 2)).otherwise(none),
    ]
    more = [
        F.when(text.rlike(pattern), _spans(text, pattern, 1, kind, len(base) + i)).otherwise(none)
        for i, (kind, pattern) in enumerate(ADDED)
    ]
    return F.array_sort(F.concat(*base, *more))


def ownership(held: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners) of rows (hash, repo, owner); nulls are one repository or owner."""
    null = F.lit("~")
    seen = held.select("hash", F.coalesce("owner", null).alias("owner"), F.coalesce("repo", null).alias("repo")).distinct()
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def scan_secrets(files: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """(doc_id, spans): one row per row of ``files``, which has doc_id, text and the
    columns named by ``repo`` and ``owner``.

    ``spans`` is an array of (start, end, order, kind, hash, n_repos, n_owners,
    verdict) by start and order of the kind, code points with the end exclusive. The
    verdict is ``example`` (``EXAMPLE_OWNERS`` owners or more hold the value),
    ``live`` (one owner does and it has ``LIVE_CHARS`` distinct characters) or
    ``unsure``. Spans of added kinds are kept where fewer than ``EXAMPLE_OWNERS`` owners
    hold the value and it has ``LIVE_CHARS`` distinct characters.

    Defined cases: null and empty texts have no spans; a null repository or owner is
    one of its own; repeated rows get equal spans and count once per repository; a key
    without an END line counts by what it has, a header without a key is no span; empty
    tables give no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = files.select("doc_id", F.col(repo).cast("string").alias("repo"), F.col(owner).cast("string").alias("owner"), text.alias("text"))
    found = rows.select("doc_id", "repo", "owner", candidates(F.col("text")).alias("c"))
    found = found.select("doc_id", "repo", "owner", F.transform("c", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["order"].alias("order"), c["kind"].alias("kind"),
        F.sha2(c["value"], 256).alias("hash"),
        F.size(F.array_distinct(F.regexp_extract_all(c["value"], F.lit("(?s)."), F.lit(0)))).alias("chars"))).alias("c"), F.expr("uuid()").alias("row"))
    found = checkpointed(found, "secret_candidates")
    spans = found.select("row", "repo", "owner", F.explode("c").alias("c")).select("row", "repo", "owner", "c.*")
    # Written, so that the join has shuffles of its own, which can be split for a hot value.
    spans = spans.join(checkpointed(ownership(spans), "secret_owners"), "hash", "left")
    verdict = (
        F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example")
        .when((F.col("n_owners") == 1) & (F.col("chars") >= LIVE_CHARS), "live").otherwise("unsure"))
    added = (F.col("n_owners") < EXAMPLE_OWNERS) & (F.col("chars") >= LIVE_CHARS)
    spans = spans.withColumn("verdict", verdict).filter((F.col("order") < len(BASE_KINDS)) | added)
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", "end", "order", "kind", "hash", "n_repos", "n_owners", "verdict"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind, comma-joined."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.concat_ws(",", F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _sql() -> str:
    kinds = [("assign", ASSIGN, 2, MIN_ASSIGN), ("access", ACCESS, 0, MIN_ACCESS), ("hex", HEX, 0, MIN_HEX)]
    # The SQL knows a key by its header, as its engine's patterns can't tell the body: it
    # is equal where no table holds a key.
    kinds += [(k, PEM_BEGIN if k == "pem" else p, 0, 1) for k, p in ADDED]
    scans = "\n  UNION ALL ".join(
        f"SELECT doc_id, source, {i} AS ord, '{k}' AS kind, {least} AS least, regexp_extract_all(x, {q}) AS m, "
        f"regexp_extract_all(x, {q}, {group}) AS v, string_split_regex(x, {q}) AS g FROM docs WHERE regexp_matches(x, {q})"
        for i, (k, pattern, group, least) in enumerate(kinds) for q in ["'" + pattern.replace("'", "''") + "'"])
    return rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS x FROM documents),
scans AS ({scans}),
spans AS (SELECT doc_id, source, ord, kind, v[i] AS value, length(m[i]) AS n,
    (list_sum(list_transform(g[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda z: length(z))), 0))::BIGINT AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM scans) WHERE length(v[i]) >= least),
owners AS (SELECT value, count(DISTINCT coalesce(source, '~')) AS n_owners FROM spans GROUP BY value),
judged AS (SELECT s.*, n_owners, len(list_distinct(string_split(s.value, ''))) AS chars, CASE WHEN n_owners >= {EXAMPLE_OWNERS} THEN 'example'
    WHEN n_owners = 1 AND len(list_distinct(string_split(s.value, ''))) >= {LIVE_CHARS} THEN 'live' ELSE 'unsure' END AS verdict,
    kind || ':' || s || ':' || (s + n) AS told FROM spans s JOIN owners o ON s.value = o.value),
kept AS (SELECT * FROM judged WHERE ord < {len(BASE_KINDS)} OR (n_owners < {EXAMPLE_OWNERS} AND chars >= {LIVE_CHARS})),
sums AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(told, ',' ORDER BY s, ord) FILTER (WHERE ord < {len(BASE_KINDS)}) AS base,
    string_agg(told, ',' ORDER BY s, ord) AS spans, count(*) FILTER (WHERE verdict = 'live') AS n_live,
    count(*) FILTER (WHERE verdict = 'example') AS n_example FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live,
  coalesce(n_example, 0)::BIGINT AS n_example
FROM docs d LEFT JOIN sums USING (doc_id)
"""


@query("op7_secrets", _sql())
def op7_secrets(spark, sf_dir):
    """Secrets of all documents; a document is a repository, its source the owner."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["order"] < len(BASE_KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    verdicts = lambda v: F.size(F.filter(spans, lambda s: s["verdict"] == v)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"), verdicts("live").alias("n_live"), verdicts("example").alias("n_example"))
