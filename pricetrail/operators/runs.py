"""Metering rows: medians of replicates, complete-group series, keyed upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions.text import words
from ..session import checkpointed
from .ordered import CHUNK, HOT, ROWS_PER_CHUNK, _big, _join_offsets, _match, exact_quantiles, with_chunks

# Tie order of stored runs, defaults of older rows, upsert keys.
GROUP = ("date", "provider_id", "tier", "task_id")
STORED_ORDER = ("replicate",)
DEFAULT_POLICY = "1.0.0"
METER_KEY = ("run_date", "mode", "task_id", "provider_id", "tier", "replicate")
UNSET = {"replicate": 1}
LEDGER_KEY = ("date", "provider_id", "tier", "task_id")
WRAPPER_KEY = ("run_date", "provider_id", "tier", "turn")
LAST_TURN = 10
LONG_TASK = "D"
CHAT_TASK = "E"
#: Turns of one conversation whose text is joined in one row.
TURNS_PER_CHUNK = 1000


def run_date(df: DataFrame) -> Column:
    """Run date, else the older week anchor, else empty."""
    have = [F.col(c) for c in ("run_date", "run_week") if c in df.columns]
    return ms.or_else(have[0], have[1] if len(have) > 1 else F.lit(None).cast("string"))


def usable_runs(runs: DataFrame, corpus: DataFrame, start: str | None = None) -> DataFrame:
    """Good runs with both counts and a known corpus size, dated from ``start``.

    ``corpus`` holds one row per task; a zero size counts as unknown.
    """
    sizes = corpus.select("task_id", F.col("input_chars").cast("long").alias("__chars"))
    dated = runs.withColumn("date", run_date(runs)).filter(
        (F.col("run_status") == "ok") & F.col("tokens_in").isNotNull() & F.col("tokens_out").isNotNull()
    )
    if start:
        dated = dated.filter(F.col("date") >= start)
    chars = F.coalesce(F.nullif(F.col("input_chars"), F.lit(0)), F.nullif(F.col("__chars"), F.lit(0)))
    return (
        dated.join(sizes, "task_id", "left")
        .withColumn("input_chars", chars)
        .drop("__chars")
        .filter(F.col("input_chars").isNotNull())
    )


MEASURES = (("in", "tokens_in"), ("out", "tokens_out"), ("usd", "usd_value_same_day"))
FIRST_RUN = ("input_chars", "model_id", "api_model", "output_cap", "corpus_version", "output_policy_version")


def _group_facts(order: Sequence[str]) -> list[Column]:
    """What a group takes from its runs besides the medians."""
    return [
        F.min_by(F.struct(*FIRST_RUN), F.struct(*order)).alias("f"),
        F.bool_or("output_censored").alias("flagged"),
        F.max(F.when(F.col("output_censored").isNull(), F.col("tokens_out"))).alias("unflagged_out"),
        F.count(F.lit(1)).alias("replicate_count"),
    ]


def _large_groups(runs: DataFrame, order: Sequence[str], group: list[str], rows_per_chunk: int) -> DataFrame:
    """Medians and facts of groups too large for a buffer: ranks picked from value counts."""
    measures = F.array(*[F.struct(F.lit(n).alias("field"), F.col(c).cast("double").alias("x")) for n, c in MEASURES])
    long = runs.select(*group, F.inline(F.filter(measures, lambda m: m["x"].isNotNull())))
    mid = exact_quantiles(long, [*group, "field"], "x", {"median": 0.5}, rows_per_chunk)
    medians = mid.groupBy(*group).agg(*[F.max(F.when(F.col("field") == n, F.col("median"))).alias(f"median_{n}") for n, _ in MEASURES])
    keyed = runs.groupBy(*[F.col(g).alias(f"__g_{g}") for g in group]).agg(*_group_facts(order))
    return keyed.join(medians, _match(group, "__g_"), "left").select(
        *[F.col(f"__g_{g}").alias(g) for g in group], *[f"median_{n}" for n, _ in MEASURES],
        "f", "flagged", "unflagged_out", "replicate_count")


def replicate_median(
    runs: DataFrame,
    order: Sequence[str] = STORED_ORDER,
    group: Sequence[str] = GROUP,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Collapse replicates to medians, with attributes of the first run.

    Medians and attributes come from one aggregation. Groups of more than
    ``rows_per_chunk`` runs, which a narrow count finds first, are kept out of it: their
    medians are picked by rank from value counts, so no buffer holds such a group.
    """
    group = list(group)
    hot, most = _big(runs.select(*group), group, rows_per_chunk)
    rows = runs.join(F.broadcast(hot), _match(group, "__g_"), "left_anti") if most else runs
    merged = rows.groupBy(*group).agg(
        *[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(f"median_{n}") for n, c in MEASURES], *_group_facts(order))
    if most:
        large = runs.join(F.broadcast(hot), _match(group, "__g_"), "left_semi")
        merged = merged.unionByName(_large_groups(large, order, group, rows_per_chunk))
    # A run without its own flag is held against the cap of the group's first run.
    cap = F.nullif(F.col("f.output_cap"), F.lit(0))
    tokens_in, tokens_out = F.col("median_in"), F.col("median_out")
    return merged.select(
        *group,
        F.col("f.model_id").alias("model_id"),
        F.col("f.api_model").alias("api_model"),
        tokens_in.alias("tokens_in"),
        tokens_out.alias("tokens_out"),
        (tokens_in + tokens_out).alias("tokens_total"),
        F.col("f.input_chars").alias("input_chars"),
        ms.density(tokens_in, F.col("f.input_chars")).alias("tokens_in_per_1k_chars"),
        F.col("median_usd").alias("usd"),
        F.col("f.output_cap").alias("output_cap"),
        (F.coalesce("flagged", F.lit(False)) | ms.hit_cap(F.col("unflagged_out"), cap)).alias("output_censored"),
        "replicate_count",
        F.col("f.corpus_version").alias("corpus_version"),
        F.coalesce("f.output_policy_version", F.lit(DEFAULT_POLICY)).alias("output_policy_version"),
    )


def _task_mask(required: Sequence[str]) -> tuple[Column, int]:
    """Bit set of the required tasks seen; cheaper than counting distinct ones."""
    bits = F.create_map(*[x for i, t in enumerate(required) for x in (F.lit(t), F.lit(1 << i))])
    return F.bit_or(F.try_element_at(bits, F.col("task_id"))), (1 << len(required)) - 1


def complete_group_sum(
    rows: DataFrame, required: Sequence[str], group: Sequence[str] = ("date", "provider_id", "tier")
) -> DataFrame:
    """Sums per group, with a flag for groups that hold every required task."""
    seen, full = _task_mask(required)
    chars = F.sum("input_chars")
    return rows.filter(F.col("task_id").isin(*required)).groupBy(*group).agg(
        (seen == full).alias("complete"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
        F.sum("tokens_total").alias("tokens_total"),
        chars.alias("input_chars"),
        F.sum(F.coalesce("usd", F.lit(0.0))).alias("usd"),
        F.bool_or(F.coalesce("output_censored", F.lit(False))).alias("censored"),
        F.max(F.coalesce("replicate_count", F.lit(1))).alias("replicate_count"),
        (F.sum("tokens_in") / (F.nullif(chars, F.lit(0)) / 1000)).alias("tokens_in_per_1k_chars"),
    )


def complete_group_mean(
    rows: DataFrame, tasks: Sequence[str], group: Sequence[str] = ("date", "provider_id", "tier")
) -> DataFrame:
    """Mean density over a fixed task set, flagged when a task is missing.

    The long task is left out unless it is the only one asked for.
    """
    required = [t for t in tasks if t != LONG_TASK] or list(tasks)
    seen, full = _task_mask(required)
    return (
        rows.filter(F.col("task_id").isin(*required) & F.col("tokens_in_per_1k_chars").isNotNull())
        .groupBy(*group)
        .agg(
            (seen == full).alias("complete"),
            F.avg("tokens_in_per_1k_chars").alias("ledger_density"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def complete_points(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete groups, one-row count of the incomplete ones), from one aggregation."""
    groups = checkpointed(groups, "groups")
    return (
        groups.filter("complete").drop("complete"),
        groups.agg(F.count_if(~F.col("complete")).alias("incomplete")),
    )


def last_turn_points(rows: DataFrame, order: Sequence[str], turn: int = LAST_TURN) -> DataFrame:
    """Prompt tokens at one turn, the last stored row per (date, provider, tier)."""
    at = rows.filter((F.col("turn") == turn) & F.col("api_prompt_tokens").isNotNull())
    return (
        at.groupBy("run_date", "provider_id", "tier")
        .agg(F.max_by(F.struct("model_id", "api_model", "api_prompt_tokens"), F.struct(*order)).alias("p"))
        .select("run_date", "provider_id", "tier", "p.*")
    )


def ledger_union(ledger: DataFrame, wrapper: DataFrame, turn: int = LAST_TURN) -> DataFrame:
    """Ledger rows and last-turn wrapper rows in one shape, newest first."""
    model = F.coalesce(F.nullif(F.col("api_model"), F.lit("")), F.col("model_id")).alias("model")
    counted = ledger.filter(F.col("run_status") == "ok").select(
        "date", "provider_id", "tier", model, "task_id", "tokens_in",
        F.col("tokens_in_per_1k_chars").alias("density"),
    )
    chat = wrapper.filter(
        (F.col("run_status") == "ok") & (F.col("turn") == turn) & F.col("api_prompt_tokens").isNotNull()
    ).select(
        F.col("run_date").alias("date"), "provider_id", "tier", model, F.lit(CHAT_TASK).alias("task_id"),
        F.col("api_prompt_tokens").alias("tokens_in"), F.col("tokens_per_1k_chars").alias("density"),
    )
    return counted.unionByName(chat).orderBy(F.col("date").desc_nulls_last(), "provider_id", "tier", "task_id")


def ledger_filter(
    rows: DataFrame, start: str | None = None, end: str | None = None, task: str | None = None
) -> DataFrame:
    """Closed date range and task, each optional."""
    kind = rows.schema["date"].dataType
    out = rows
    if task:
        out = out.filter(F.col("task_id") == task)
    if start:
        out = out.filter(F.col("date") >= F.lit(start).cast(kind))
    if end:
        out = out.filter(F.col("date") <= F.lit(end).cast(kind))
    return out


def upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], unset: Mapping[str, object] = UNSET
) -> DataFrame:
    """Existing rows whose key is not rewritten, plus the new rows.

    The join is null-safe, so an unset key part is a value like any other, but for
    those with a default in ``unset``: a run without a replicate is replicate 1.
    """
    def part(k: str) -> Column:
        return F.coalesce(F.col(k), F.lit(unset[k])) if k in unset else F.col(k)

    marks = new.select(*[part(k).alias(f"__{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        term = part(k).eqNullSafe(F.col(f"__{k}"))
        same = term if same is None else same & term
    return existing.join(marks, same, "left_anti").unionByName(new, allowMissingColumns=True)


def transcript_prefixes(
    turns: DataFrame, max_exchanges: int | None = None, turns_per_chunk: int = TURNS_PER_CHUNK
) -> DataFrame:
    """Size and text of the first n exchanges of each conversation.

    All exchanges, or as many as ``max_exchanges`` asks for. A conversation of more
    than ``turns_per_chunk`` turns is cut into chunks of turns; text is joined inside
    a chunk, and a table with one row per chunk carries the text before it. So no
    task gathers the turns of a conversation, and an exchange holds no more than its
    own prefix.
    """
    head = turns if max_exchanges is None else turns.filter(F.col("turn") < 2 * max_exchanges)
    rows = head.select(
        "conv_id", "turn", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("chars"),
        F.concat(F.upper("role"), F.lit(": "), F.col("text")).alias("line"))
    cut = checkpointed(with_chunks(rows, ["conv_id"], "turn", turns_per_chunk).drop(HOT), "turn_chunks")
    inside = Window.partitionBy("conv_id", CHUNK).orderBy("turn", "chars", "line")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = cut.select(
        "conv_id", CHUNK, "turn", F.sum("chars").over(upto).alias("chars"),
        F.coalesce(F.sum(F.char_length("line") + 2).over(upto), F.lit(2)).alias("at"),
    ).filter(F.col("turn") % 2 == 1)
    lines = F.array_sort(F.collect_list(F.struct("turn", "chars", "line")))
    chunks = cut.groupBy("conv_id", CHUNK).agg(
        F.sum("chars").alias("__chars"),
        F.nullif(F.array_join(F.transform(lines, lambda t: t["line"]), "\n\n"), F.lit("")).alias("__text"))
    earlier = Window.partitionBy("conv_id").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(
        "conv_id", CHUNK, "__text", F.coalesce(F.sum("__chars").over(earlier), F.lit(0)).alias("__before"),
        F.nullif(F.array_join(F.collect_list("__text").over(earlier), "\n\n"), F.lit("")).alias("__text_before"))
    own = F.nullif(F.substring("__text", F.lit(1), (F.col("at") - 2).cast("int")), F.lit(""))
    return _join_offsets(ends, carried, ["conv_id"]).select(
        "conv_id",
        F.floor((F.col("turn") + 1) / 2).cast("int").alias("exchanges"),
        (F.col("__before") + F.col("chars")).alias("prefix_chars"),
        F.concat_ws("\n\n", "__text_before", own).alias("prefix_text"),
    )


def transcript_sizes(turns: DataFrame) -> DataFrame:
    """Characters, bytes and words of the messages joined by line breaks.

    The joined text is never built: separators add one character and one byte
    between messages and no words.
    """
    gaps = F.count(F.lit(1)) - 1
    return turns.groupBy("conv_id").agg(
        (F.sum(F.char_length("text")) + gaps).alias("chars"),
        (F.sum(F.octet_length("text")) + gaps).alias("bytes"),
        F.sum(words(F.col("text"))).alias("words"),
    )
