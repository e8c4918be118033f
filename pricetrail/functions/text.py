"""Text functions as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists, patterns and labels that results depend on.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# The same characters in the form the JVM matches fastest, and the runs of them
# that are not already one plain space.
ANY_SPACE = r"[\s\x1c-\x1f]"
SPACE_RUN = rf"(?U) {ANY_SPACE}+|[\s\x1c-\x1f&&[^ ]]{ANY_SPACE}*"
BARE_NUMBER = r"\A-?[0-9]+(\.[0-9]+)?\z"
DOLLAR_NUMBER = r"\$([0-9]+(?:\.[0-9]+)?)"
MODALITIES = ("text", "image", "video", "audio")
DEPRECATION_WORDS = ("deprecated", "retired", "legacy")
TOKEN_SUFFIXES = {
    "-input-tokens": "input",
    "-output-tokens": "output",
    "-cache-read-input-token-count": "cached_input",
    "-cache-write-input-token-count": "cache_write",
}
EXCLUDED_FRAGMENTS = (
    "batch",
    "flex",
    "priority",
    "custom-model",
    "cross-region",
    "global",
    "video",
    "image",
    "audio",
    "speech",
    "embeddings",
    "canvas",
    "sonic",
    "reel",
    "t2i",
    "provisioned",
)
UNAVAILABLE_PHRASES = (
    "not_found",
    "not found",
    "does not exist",
    "invalid",
    "legacy",
    "access denied",
    "no access",
    "not authorized",
    "unsupported model",
)
THRESHOLD_LABEL = r"(?i)\((<|≥)\s*([0-9]+k?)\s*prompt tokens\)"
THRESHOLD_TAIL = r"(?i)\s*\((<|≥)\s*[0-9]+k?\s*prompt tokens\)\s*"
CAMEL_BREAK = r"(?<=[a-z])(?=[A-Z0-9])"
USAGE_NAME = r"\AUSE1-([A-Za-z0-9.]+(?:-[A-Za-z0-9.]+)?)-(?:input|output|cache)"
DATED_SUFFIX = r"-20[0-9]{2}-[0-9]{2}-[0-9]{2}\z"
BYLINES = (
    r"\s+starting\s+[A-Za-z]+ [0-9]{1,2}, [0-9]{4}",
    r"\s+through\s+[A-Za-z]+ [0-9]{1,2}, [0-9]{4}",
)
FUTURE_BYLINE = r"\bstarting\s+[a-z]+ [0-9]{1,2}, [0-9]{4}"


def strip_space(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"(?U)\A{ANY_SPACE}+", ""), rf"(?U){ANY_SPACE}+\z", "")


def norm(c: Column) -> Column:
    """Trim and collapse whitespace; null becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE_RUN, " "))


def slugify(c: Column) -> Column:
    """Lower-case slug of letters, digits, dots and single dashes."""
    dash = F.lit("-")
    dashed = F.replace(F.replace(F.lower(norm(c)), F.lit("—"), dash), F.lit("–"), dash)
    kept = F.regexp_replace(dashed, r"[^a-z0-9.\- ]+", "")
    return F.btrim(F.regexp_replace(kept, "[ -]+", "-"), dash)


def joined_id(*parts: Column) -> Column:
    """Slug of the non-empty parts joined by a dash."""
    return slugify(F.concat_ws("-", *[F.nullif(p, F.lit("")) for p in parts]))


ID_FIELDS = ("service_tier", "context_window", "modality", "category", "billing_variant")


def pricing_id(strict: bool = False) -> Column:
    """Id of a component row. The slug drops comparison signs, so two context
    windows of one model share an id; ``strict`` spells the signs out."""
    parts = ["provider_id", "model_id", "component", *ID_FIELDS, "unit"]
    return joined_id(*[_spelled(F.col(p)) if strict else F.col(p) for p in parts])


def tier_id(strict: bool = False) -> Column:
    parts = ["provider_id", "model_id", *ID_FIELDS]
    return joined_id(*[_spelled(F.col(p)) if strict else F.col(p) for p in parts])


def _spelled(c: Column) -> Column:
    for sign, word in (("<=", "lte-"), (">=", "gte-"), ("≤", "lte-"), ("≥", "gte-"), ("<", "lt-"), (">", "gt-")):
        c = F.replace(c, F.lit(sign), F.lit(word))
    return c


def money(c: Column) -> Column:
    """A price read from text: a bare signed number, or the first ``$n``."""
    text = F.replace(c, F.lit(","), F.lit(""))
    dollars = F.regexp_extract(text, DOLLAR_NUMBER, 1)
    return (
        F.when(text.rlike(BARE_NUMBER), text.try_cast("double"))
        .when(dollars != "", dollars.try_cast("double"))
    )


def money_number(c: Column) -> Column:
    """Numeric input: zero means no price."""
    return F.nullif(c.cast("double"), F.lit(0.0))


def first_price(cells: Column) -> Column:
    """First price in a list of cells, null when none has one."""
    found = F.filter(F.transform(cells, money), lambda p: p.isNotNull())
    return F.try_element_at(found, F.lit(1))


def infer_modality(label: Column) -> Column:
    low = F.lower(label)
    has = {m: low.contains(m) for m in MODALITIES}
    hits = sum((has[m].cast("int") for m in MODALITIES), F.lit(0))
    return (
        F.when(hits > 1, "multimodal")
        .when(has["audio"], "audio")
        .when(has["image"], "image")
        .when(has["video"], "video")
        .when(has["text"], "text")
    )


def component_of_label(label: Column) -> Column:
    """Component named by a row label; unknown labels give their own slug."""
    low = F.lower(label)
    return (
        F.when(low.contains("cached input"), "cached_input")
        .when(low.contains("input"), "input")
        .when(low.contains("output"), "output")
        .when(low.contains("training"), "training")
        .otherwise(F.coalesce(F.nullif(slugify(low), F.lit("")), F.lit("price")))
    )


def component_of_suffix(usage: Column) -> Column:
    low = F.lower(F.coalesce(usage, F.lit("")))
    ladder = F.lit(None).cast("string")
    for suffix, name in reversed(TOKEN_SUFFIXES.items()):
        ladder = F.when(low.endswith(suffix), name).otherwise(ladder)
    return ladder


def tier_of_headers(headers: Column) -> Column:
    """Service tier read from the column titles of a table (an array)."""
    text = F.lower(F.array_join(headers, " "))
    return (
        F.when(text.contains("flex/batch") | text.contains("with flex"), "flexbatch")
        .when(text.contains("priority"), "priority")
        .when(text.rlike("batch api|200k|1m|token"), "standard")
    )


def context_of_header(header: Column) -> Column:
    low = F.lower(header)
    return F.when(low.rlike("<= 200k|<=200k|=< 200k"), "<=200k").when(
        low.rlike("> 200k|>200k"), ">200k"
    )


def threshold_variant(label: Column) -> Column:
    sign = F.regexp_extract(label, THRESHOLD_LABEL, 1)
    size = F.lower(F.regexp_extract(label, THRESHOLD_LABEL, 2))
    return F.when(
        sign != "",
        F.concat(F.when(sign == "<", "lt").otherwise("gte"), F.lit("-"), size, F.lit("-prompt")),
    )


def threshold_base(label: Column) -> Column:
    return strip_space(F.regexp_replace(label, THRESHOLD_TAIL, ""))


def camel_split(c: Column) -> Column:
    return norm(F.translate(F.regexp_replace(c, CAMEL_BREAK, " "), "-", " "))


def usage_model_name(model: Column, usage: Column) -> Column:
    """Given name, else the name embedded in a usage type."""
    given = F.nullif(norm(model), F.lit(""))
    raw = F.nullif(F.regexp_extract(F.coalesce(usage, F.lit("")), USAGE_NAME, 1), F.lit(""))
    return F.coalesce(given, F.when(F.lower(raw).startswith("titan"), camel_split(raw)).otherwise(raw))


def excluded_usage(usage: Column) -> Column:
    return F.lower(usage).rlike("|".join(EXCLUDED_FRAGMENTS))


def owned_by_family(model: Column, usage: Column) -> Column:
    return F.coalesce(F.lower(norm(model)).rlike("nova|titan"), F.lit(False)) | F.coalesce(
        F.lower(usage).rlike("use1-titan|use1-nova"), F.lit(False)
    )


def owned_rows(provider: Column, model_id: Column, name: Column) -> Column:
    """True unless the row is a resold model listed under one of two providers."""
    text = F.lower(F.concat(F.coalesce(model_id, F.lit("")), F.lit(" "), F.coalesce(name, F.lit(""))))
    families = text.contains("nova") | text.contains("titan")
    prefixed = strip_space(text).startswith("deepseek-") | F.concat(F.lit(" "), text).contains(" deepseek-")
    return (
        F.when(provider == "aws", families)
        .when(provider == "deepseek", prefixed)
        .otherwise(F.lit(True))
    )


def starts_with_family(name: Column, family: str) -> Column:
    low = F.lower(norm(name))
    return low.startswith(f"{family}-") | low.startswith(f"{family} ")


def online_batch_prices(cell: Column) -> tuple[Column, Column]:
    def named(word: str) -> Column:
        return F.regexp_extract(cell, word + r" requests:\s*\$([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")

    return named("Online"), named("Batch")


def marks_deprecation(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike("|".join(DEPRECATION_WORDS)), F.lit(False))


def dated_suffix(model_id: Column) -> Column:
    return model_id.rlike(DATED_SUFFIX)


def before_phrase(c: Column, phrase: str) -> Column:
    return strip_space(F.substring_index(c, phrase, 1))


def scrub_name(name: Column) -> Column:
    out = F.coalesce(name, F.lit(""))
    for byline in BYLINES:
        out = F.regexp_replace(out, byline, "")
    return norm(out)


def future_placeholder(model_id: Column, name: Column) -> Column:
    return F.coalesce(F.lower(model_id).contains("starting-"), F.lit(False)) | F.coalesce(
        F.lower(name).rlike(FUTURE_BYLINE), F.lit(False)
    )


def pretty_context(context: Column) -> Column:
    return (
        F.when(context == "short_context", "short context")
        .when(context == "long_context", "long context")
        .otherwise(F.coalesce(context, F.lit("")))
    )


def legend_label(name: Column, modality: Column, context: Column, show_context: Column) -> Column:
    shown = F.when(show_context & (F.coalesce(context, F.lit("")) != ""), pretty_context(context))
    extras = F.concat_ws(", ", F.nullif(modality, F.lit("")), shown)
    base = scrub_name(name)
    return F.when(extras != "", F.concat(base, F.lit(" ("), extras, F.lit(")"))).otherwise(base)


def describe_row(name: Column, *extras: Column) -> Column:
    return F.concat_ws(" | ", name, *[F.nullif(e, F.lit("")) for e in extras])


def redact(c: Column) -> Column:
    return F.regexp_replace(c, r"(key=)[^&\s]+", "$1[REDACTED]")


def _fallback_signature(text: Column) -> Column:
    head = F.substring(F.substring_index(text, "\n", 1), 1, 120)
    clean = F.btrim(F.regexp_replace(head, r"[^a-zA-Z0-9:_-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.substring(clean, 1, 80), F.lit("")), F.lit("UnknownError"))


def classify_error(message: Column, short: bool = False) -> tuple[Column, Column]:
    """(signature, category) of an error message; first matching rule wins.

    ``short`` keeps only the two parse rules, as the run report does.
    """
    text = strip_space(F.coalesce(message, F.lit("")))
    key = F.regexp_extract(text, r"""KeyError:\s*['"]?([^'"]+)['"]?""", 1)
    rules = [
        (key != "", F.concat(F.lit("KeyError:"), key), "parse"),
        (text.rlike("(?i)sanity check failed"), F.lit("SanityCheckFailed"), "parse"),
    ]
    if not short:
        rules += [
            (text.rlike("(?i)auth|401|403|unauthorized|forbidden"), F.lit("AuthError"), "auth"),
            (text.rlike("(?i)rate.?limit|429|quota"), F.lit("RateLimit"), "rate_limit"),
            (text.rlike("(?i)timeout|timed out"), F.lit("Timeout"), "timeout"),
            (text.rlike("Failed after [0-9]+ attempts"), F.lit("NetworkRetryExhausted"), "network"),
        ]
    signature, category = _fallback_signature(text), F.lit("unknown")
    for hit, sign, kind in reversed(rules):
        signature = F.when(hit, sign).otherwise(signature)
        category = F.when(hit, kind).otherwise(category)
    return signature, category


def model_unavailable(status: Column, body: Column) -> Column:
    """Whether an HTTP failure means the model id cannot be used here."""
    low = F.lower(F.coalesce(body, F.lit("")))
    worded = low.contains("model") & low.rlike("|".join(UNAVAILABLE_PHRASES))
    return (
        F.when(status.isNull(), F.lit(False))
        .when(status.isin(403, 404), F.lit(True))
        .when(status.isin(400, 422), worded)
        .otherwise(F.lit(False))
    )


def url_without_param(url: Column, drop: str, default: tuple[str, str], schemes: Sequence[str]) -> Column:
    """Drop one query key and add a default one; other schemes pass through.

    The first of ``schemes`` is the short spelling of the last.
    """
    clean = F.btrim(strip_space(url), F.lit("\"'"))
    scheme = F.regexp_extract(clean, r"\A([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    base = F.regexp_extract(clean, r"\A([^?#]*)", 1)
    query = F.regexp_extract(clean, r"\A[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(clean, r"(#.*)\z", 1)
    pairs = F.filter(
        F.split(query, "&"),
        lambda p: (p != "") & (F.substring_index(p, "=", 1) != F.lit(drop)),
    )
    full = F.transform(pairs, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    missing = ~F.exists(full, lambda p: F.substring_index(p, "=", 1) == F.lit(default[0]))
    extra = F.when(missing, F.array(F.lit("=".join(default)))).otherwise(F.array().cast("array<string>"))
    renamed = F.when(
        scheme == schemes[0], F.concat(F.lit(schemes[-1]), F.substring(base, len(schemes[0]) + 1, 1 << 30))
    ).otherwise(base)
    rebuilt = F.concat(renamed, F.lit("?"), F.array_join(F.concat(full, extra), "&"), fragment)
    return F.when(scheme.isin(*schemes), rebuilt).otherwise(clean)


def words(c: Column) -> Column:
    """Number of whitespace-separated words."""
    text = norm(c)
    gaps = F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(c.isNotNull(), gaps + (text != "").cast("int"))


def text_sizes(c: Column) -> dict[str, Column]:
    return {
        "chars": F.char_length(c).cast("long"),
        "bytes": F.octet_length(c).cast("long"),
        "words": words(c).cast("long"),
    }
