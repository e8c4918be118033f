"""Price rows out of page tables: shape rules as Column expressions.

``page_tables`` gives every table as nested cells with the texts that name it. A
*shape rule* says which tables it reads (by their header row) and which cells of a row
carry which price. What a row takes from the rows above it is carried along the nested
cells by array functions, so from the page to its prices nothing is shuffled. All rules
of a provider are branches of one projection: one pass and one ``posexplode``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import nested
from ..functions import text as tx
from ..sources.html import page_tables
from .tiers import component_rows

# Section labels, header rows and model families of the pages.
SECTION_HEADINGS = ("h2", "h3", "h4")
OPENAI_TIERS = ("Standard", "Batch", "Flex", "Priority")
OPENAI_CATEGORIES = {
    "Flagship models": "flagship",
    "Realtime and audio generation models": "realtime_audio",
    "Image generation models": "image_generation",
    "Video generation models": "video_generation",
    "Transcription models": "transcription",
    "Specialized models": "specialized",
    "Finetuning": "fine_tuning",
}
VERTEX_TIERS = ("Standard", "Priority", "Flex/Batch")
VERTEX_GROUPS = {
    "Gemini 3": "gemini_3",
    "Gemini 2.5": "gemini_2_5",
    "Gemini 2.0": "gemini_2_0",
}
VERTEX_COMPONENTS = ("input", "output", "cached_input", "training", "generation")
VERTEX_SKIPPED_LABELS = ("$/m char", "$/image", "$/sec", "per image", "per second")
MODALITY_HEADERS = (
    ["model", "modality", "input", "cached input", "output / cost"],
    ["model", "modality", "input", "cached input", "output"],
)
VIDEO_HEADER = ["model", "size", "portrait", "landscape", "price per second"]
TRANSCRIPTION_HEADER = ["model", "use case", "input", "output", "estimated cost"]
CATEGORY_HEADER = ["category", "model", "input", "cached input", "output"]
FINETUNING_HEADER = ["model", "training", "input", "cached input", "output"]
BATCH_TOKEN_HEADER = ["model", "type", "price", "price with batch api"]
EMBEDDING_HEADERS = {
    "per_1K_tokens": ["model", "type", "region", "price per 1,000 input tokens"],
    "per_1K_characters": ["model", "type", "region", "price per 1,000 characters"],
}
LONG_CONTEXT_TAIL = r"(?i)\s+Long context.*$"
QWEN_MODELS = {"qwen3.7-max": "1m", "qwen3.7-plus": "256k", "qwen-flash": "256k"}
CATALOG_UNIT = "1k tokens"



# The texts before a table that say what it lists.
WATCHED = {
    "group_text": tuple(VERTEX_GROUPS),
    "vertex_tier_text": VERTEX_TIERS,
    "category_text": tuple(OPENAI_CATEGORIES),
    "openai_tier_text": OPENAI_TIERS,
}


def prev_heading(blocks: DataFrame, tags: Sequence[str] = SECTION_HEADINGS) -> DataFrame:
    """Nearest heading before each block, in document order."""
    upto = Window.partitionBy("page_id").orderBy("block_ord", F.coalesce("row_ord", F.lit(-1))).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    mine = F.when((F.col("kind") == "heading") & F.col("tag").isin(*tags), F.col("text"))
    return blocks.withColumn("heading", F.last(mine, ignorenulls=True).over(upto))


def carried(values: Column) -> Column:
    """An array of texts with every null replaced by the last text before it.

    Each text is repeated up to the next one, so the cost is that of the array.
    """
    none = F.lit(None).cast("string")
    size = F.size(values)
    known = F.filter(F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda k: k["v"].isNotNull())
    ends = F.when(F.size(known) > 0, F.concat(
        F.transform(F.slice(known, F.lit(2), F.greatest(F.size(known) - 1, F.lit(0))), lambda k: k["i"]), F.array(size)))
    spans = F.zip_with(known, F.coalesce(ends, F.array().cast("array<int>")), lambda k, end: F.array_repeat(k["v"], end - k["i"]))
    return F.concat(F.array_repeat(none, F.coalesce(F.try_element_at(known, F.lit(1))["i"], size)), F.flatten(spans))


def before(values: Column) -> Column:
    """An array moved on by one place: at each row the value of the row before."""
    return F.concat(F.array(F.lit(None).cast("string")), F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0))))


def fill_down(tables: DataFrame) -> DataFrame:
    """Add ``filled``: rows exactly one cell short of the header begin with the last first cell.

    Only rows below the header count. Until a full row has set it, the cell to repeat
    is the first one seen; an empty first cell sets nothing.
    """
    def first(cells: Column) -> Column:
        return F.nullif(F.try_element_at(cells, F.lit(1)), F.lit(""))

    short = lambda cells: F.size(cells) == F.size("head") - 1
    marked = tables.withColumns({
        "__full": before(carried(F.transform("grid", lambda c, i: F.when((i >= 1) & ~short(c), first(c))))),
        "__seen": F.transform("grid", lambda c, i: F.when(i >= 1, first(c))),
    }).withColumn("__first", F.try_element_at(
        F.filter(F.transform("__seen", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda k: k["v"].isNotNull()), F.lit(1)))

    def filled(cells: Column, i: Column) -> Column:
        earliest = F.when(F.col("__first.i") < i, F.col("__first.v"))
        carry = F.coalesce(F.try_element_at("__full", i + 1), earliest)
        return F.when((i >= 1) & short(cells) & carry.isNotNull(), F.concat(F.array(carry), cells)).otherwise(cells)

    return marked.withColumn("filled", F.transform("grid", filled)).drop("__full", "__seen", "__first")


def parsed_pages(pages: DataFrame) -> DataFrame:
    return page_tables(pages, SECTION_HEADINGS, WATCHED)


def lowered(row: Column) -> Column:
    return F.transform(row, lambda c: F.lower(c))


def tables_of(parsed: DataFrame, **of_page: Column) -> DataFrame:
    """One row per table: what names it, its header rows, ``grid`` and ``filled`` cells.

    ``of_page`` are facts about all tables of a page.
    """
    facts = parsed.withColumns(of_page) if of_page else parsed
    tables = facts.select("page_id", *of_page, F.posexplode("tables").alias("table_ord", "t"))
    tables = tables.select(
        "page_id", "table_ord", *of_page, F.col("t.heading").alias("heading"),
        *[F.try_element_at("t.labels", F.lit(n)).alias(n) for n in WATCHED],
        F.col("t.grid").alias("grid"), F.col("t.grid")[0].alias("names"),
        F.try_element_at("t.grid", F.lit(2)).alias("second"), F.size("t.grid").alias("n_rows"))
    return fill_down(tables.withColumns({
        "head": lowered(F.col("names")),
        "head2": F.coalesce(lowered(F.col("second")), F.array().cast("array<string>")),
    }))


def rows_of(tables: DataFrame, **carry: Column) -> DataFrame:
    """One row per table row, with ``row_ord``, ``cells`` and its ``filled`` cells.

    ``carry`` are arrays with an entry per row of the table, each added under its name.
    """
    wide = tables.withColumns({f"__{n}": c for n, c in carry.items()}) if carry else tables
    at = F.col("row_ord") + 1
    keep = [c for c in tables.columns if c not in ("grid", "filled")]
    rows = wide.select(*keep, "filled", *[f"__{n}" for n in carry], F.posexplode("grid").alias("row_ord", "cells"))
    return rows.select(
        *keep, "row_ord", "cells", F.try_element_at("filled", at).alias("filled"),
        *[F.try_element_at(f"__{n}", at).alias(n) for n in carry])


def cell(i: int | Column, of: str | Column = "cells") -> Column:
    """Cell by 0-based position; null past the end of the row."""
    return F.try_element_at(of, F.lit(i + 1) if isinstance(i, int) else i + 1)


def column_with(test: Callable[[Column], Column]) -> Column:
    """0-based position of the first header that passes; null if none does."""
    return F.nullif(F.array_position(F.transform("head", test), True) - 1, F.lit(-1)).cast("int")


def at_column(position: Column) -> Column:
    return F.when(position.isNotNull(), cell(position))


def header_is(*names: Sequence[str]) -> Column:
    """Whether the table's first header cells equal one of the given lists."""
    test = F.lit(False)
    for want in names:
        test = test | (F.slice("head", 1, len(want)) == F.array(*[F.lit(w) for w in want]))
    return test


FIELDS = ("component", "price_text", "unit", "service_tier", "context_window", "modality", "category", "billing_variant")


def price(component, text: Column, unit: str = ms.PER_MILLION, **fields) -> Column:
    """One component entry; ``fields`` may be text, Columns or None. The price is
    read from its text after the entries are exploded."""
    given = {"component": component, "price_text": text, "unit": unit, **fields}

    def as_column(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(*[as_column(given.get(n)).cast("string").alias(n) for n in FIELDS])


@dataclass
class Rule:
    """Rows a shape reads, the name cell, and the entries of such a row."""

    test: Column
    name: Column
    entries: Sequence[Column] | Column
    retires: bool = True

    def array(self) -> Column:
        listed = self.entries if isinstance(self.entries, Column) else F.array(*self.entries)
        return F.transform(
            listed,
            lambda e: F.struct(self.name.alias("display_name"), F.lit(self.retires).alias("retires"), e.alias("e")),
        )


def apply_rules(rows: DataFrame, provider: str, rules: Sequence[Rule]) -> DataFrame:
    """Component rows of all rules in one pass; rules of a provider exclude one
    another by their header rows, so the first that fits is the only one."""
    chosen = None
    for rule in reversed(rules):
        chosen = F.when(rule.test, rule.array()).otherwise(chosen) if chosen is not None else F.when(rule.test, rule.array())
    entries = rows.select(
        "page_id", "table_ord", "row_ord", F.posexplode(chosen).alias("entry_ord", "x")
    ).select("page_id", "table_ord", "row_ord", "entry_ord", "x.display_name", "x.retires", "x.e.*")
    priced = entries.withColumns({
        "price": tx.money(F.col("price_text")),
        "display_name": tx.norm(F.col("display_name")),
    }).filter(F.col("price").isNotNull() & (F.col("display_name") != ""))
    deprecated = F.lower("display_name").contains("deprecated")
    return priced.select(
        "page_id", "table_ord", "row_ord", "entry_ord", "display_name", "component", "price", "unit",
        "service_tier", "context_window", "modality", "category", "billing_variant",
        tx.slugify(F.col("display_name")).alias("model_id"),
        F.lit(provider).alias("provider_id"),
        (~(F.col("retires") & deprecated)).alias("is_active"),
    )


def claude_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    rows = rows_of(tables_of(parsed))
    joined = F.array_join("head", " ")

    def has(*words: str) -> Column:
        return at_column(column_with(lambda h: h.rlike("|".join(words))))

    same = {"category": "standard_api"}
    return rows, [Rule(
        (F.col("n_rows") >= 2) & (F.col("row_ord") >= 1)
        & joined.contains("base input") & joined.contains("output") & F.lower(cell(0)).contains("claude"),
        cell(0),
        [
            price("input", has("base input"), **same),
            price("output", has("output"), **same),
            price("cache_write", has("cache writes"), billing_variant="5m", **same),
            price("cache_write", has("1 hr cache writes", "1h cache writes"), billing_variant="1h", **same),
            price("cache_read", has("cache hits"), **same),
        ],
    )]


def xai_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    rows = rows_of(tables_of(parsed))
    head = F.col("head")
    two_rows = (
        (F.col("n_rows") >= 3)
        & (F.size("head") >= 4)
        & (cell(0, "head") == "model")
        & (cell(1, "head") == "context")
        & cell(2, "head").contains("short context")
        & cell(3, "head").contains("long context")
        & (F.size("head2") >= 6)
    )
    rows = rows.withColumn("two_rows", F.coalesce(two_rows, F.lit(False)))
    same = {"service_tier": "standard", "modality": "text", "category": "text_api"}
    kinds = ("input", "cached_input", "output")
    context = F.nullif(tx.norm(cell(1)), F.lit(""))
    wide = Rule(
        F.col("two_rows") & (F.col("row_ord") >= 2) & (F.size("cells") >= 8) & F.lower(cell(0)).contains("grok"),
        tx.strip_space(F.regexp_replace(cell(0), LONG_CONTEXT_TAIL, "")),
        [
            price(k, cell(start + i), context_window=context, billing_variant=variant, **same)
            for start, variant in ((2, "lt-200k-prompt"), (5, "gte-200k-prompt"))
            for i, k in enumerate(kinds)
        ],
    )
    at = {
        "model": column_with(lambda h: h == "model"),
        "context": column_with(lambda h: h == "context"),
        "input": column_with(lambda h: h.contains("input / 1m tokens")),
        "cached_input": column_with(lambda h: h.contains("cached input / 1m tokens")),
        "output": column_with(lambda h: h.contains("output / 1m tokens")),
    }
    label = at_column(at["model"])
    single = Rule(
        ~F.col("two_rows") & (F.col("n_rows") >= 2) & (F.col("row_ord") >= 1) & (F.size(head) > 0)
        & at["model"].isNotNull() & at["input"].isNotNull() & at["output"].isNotNull()
        & F.lower(label).contains("grok"),
        tx.threshold_base(label),
        [
            price(k, at_column(at[k]), context_window=at_column(at["context"]),
                  billing_variant=tx.threshold_variant(label), **same)
            for k in kinds
        ],
    )
    return rows, [wide, single]


def _transposed(names: Column, n_rows: Column) -> Column:
    """Whether a table has models as columns: its header is MODEL and a known family."""
    head = F.lower(F.try_element_at(names, F.lit(1)))
    family = tx.starts_with_family(F.lower(F.try_element_at(names, F.lit(2))), "deepseek")
    return F.coalesce((n_rows >= 3) & (F.size(names) >= 3) & (head == "model") & family, F.lit(False))


def deepseek_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Models are columns, any number of them: the header cells become rows, and each
    looks its values up in the labelled rows. Only the first such table of a page counts."""
    fitting = F.transform("tables", lambda t: _transposed(t["grid"][0], F.size(t["grid"])))
    tables = tables_of(parsed, first_fit=F.array_position(fitting, True) - 1)

    def labelled(cells: Column, i: Column) -> Column:
        label = F.lower(F.array_join(F.slice(cells, 1, 2), " "))
        kind = F.when(i >= 1, (
            F.when(label.contains("context length"), "context")
            .when(label.contains("cache hit"), "cached_input")
            .when(label.contains("cache miss"), "input")
            .when(label.contains("output"), "output")
        ))
        # A priced row may carry a second label cell, which moves its values right.
        moved = (kind == "cached_input") & (F.size(cells) > 2) & F.lower(cell(0, cells)).contains("pricing")
        start = F.when(F.coalesce(moved, F.lit(False)), 3).otherwise(2)
        return F.struct(kind.alias("kind"), F.slice(cells, start, F.greatest(F.size(cells), F.lit(1))).alias("v"))

    tables = tables.filter(F.col("table_ord") == F.col("first_fit")).withColumn("labelled", F.transform("grid", labelled))
    models = tables.select("page_id", "table_ord", "labelled", F.posexplode(F.slice("names", F.lit(2), F.size("names"))).alias("row_ord", "name"))

    def found(k: str) -> Column:
        fits = F.filter("labelled", lambda r: (r["kind"] == k) & (F.size(r["v"]) > F.col("row_ord")))
        return F.try_element_at(F.try_element_at(fits, F.lit(-1))["v"], F.col("row_ord") + 1)

    kinds = ("input", "cached_input", "output")
    name = F.col("name")
    owned = tx.starts_with_family(name, "deepseek") | tx.starts_with_family(tx.slugify(name), "deepseek")
    entries = [
        price(k, found(k), service_tier="standard", modality="text", category="text_api", context_window=found("context"))
        for k in kinds
    ]
    return models, [Rule(F.coalesce(owned, F.lit(False)), name, entries)]


def qwen_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    rows = rows_of(tables_of(parsed))
    at = {
        "scope": column_with(lambda h: h.contains("deployment scope")),
        "input": column_with(lambda h: h.contains("input price")),
        "output": column_with(lambda h: h.contains("output price")),
        "mode": column_with(lambda h: h == "mode"),
        "range": column_with(lambda h: h.contains("input tokens per request")),
    }

    def low(k: str) -> Column:
        return F.lower(tx.norm(at_column(at[k])))

    rows = rows.withColumns({
        "name": tx.before_phrase(tx.norm(cell(0)), " Currently equivalent to "),
        "label_slug": tx.slugify(cell(0)),
        "range_text": low("range"),
    }).withColumn("model", tx.slugify(F.col("name")))
    listed, in_range = F.lit(False), F.lit(True)
    for prefix, size in reversed(QWEN_MODELS.items()):
        listed = listed | F.col("label_slug").startswith(prefix)
        in_range = F.when(
            F.col("model").startswith(prefix), (F.col("range_text") == "") | F.col("range_text").contains(size)
        ).otherwise(in_range)
    test = (
        (F.col("n_rows") >= 2) & (F.col("row_ord") >= 1) & (cell(0, "head") == "model id")
        & at["scope"].isNotNull() & at["input"].isNotNull() & at["output"].isNotNull()
        & listed & (low("scope") == "international") & ~low("mode").contains("batch")
        & tx.money(at_column(at["input"])).isNotNull() & tx.money(at_column(at["output"])).isNotNull()
        & ~tx.dated_suffix(F.col("model")) & in_range
    )
    same = {
        "service_tier": "standard",
        "modality": "text",
        "category": "text_api",
        "context_window": F.when(F.col("model").contains("3.7"), ">200k"),
    }
    return rows, [Rule(test, F.col("name"), [price(k, at_column(at[k]), **same) for k in ("input", "output")])]


def vertex_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Three shapes: model/type tables of a model group, the four-column token
    table under its own heading, and embedding tables anywhere else."""
    groups = F.create_map(*[F.lit(x) for kv in VERTEX_GROUPS.items() for x in kv])
    group = F.coalesce("group_text", F.when(F.col("heading").isin(*VERTEX_GROUPS), F.col("heading")))
    tier_text = F.nullif(tx.slugify(F.col("vertex_tier_text")), F.lit(""))
    region_at = column_with(lambda h: h == "region")

    def first(cells: Column) -> Column:
        return F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit(""))

    def gemini(cells: Column) -> Column:
        return F.lower(first(cells)).contains("gemini")

    def banner(cells: Column) -> Column:
        return gemini(cells) & (F.size(cells) == 1)

    def foreign(cells: Column) -> Column:
        region = F.when(F.col("region_at").isNotNull(), cell(F.col("region_at"), cells))
        return F.coalesce(F.lower(tx.norm(region)).contains("non-global"), F.lit(False))

    tables = tables_of(parsed).filter(F.coalesce("heading", F.lit("")) != "Modality-based pricing").withColumn("region_at", region_at)
    tables = tables.withColumns({
        "models": carried(F.transform("grid", lambda c, i: F.when((i >= 1) & gemini(c), tx.norm(first(c))))),
        "banners": carried(F.transform("grid", lambda c, i: F.when((i >= 1) & banner(c), tx.norm(first(c))))),
        "filled_models": carried(F.transform("filled", lambda f, i: F.when((i >= 1) & (F.size(f) >= 4), F.nullif(tx.norm(first(f)), F.lit(""))))),
    })

    def label(cells: Column, i: Column) -> Column:
        second = cell(1, cells)
        typed = F.when((second != "") & tx.money(second).isNull(), tx.norm(second))
        # Older tables keep the label in the first column.
        legacy = F.when((first(cells) != "") & ~gemini(cells) & tx.money(first(cells)).isNull(), tx.norm(first(cells)))
        counted = (i >= 1) & F.try_element_at("models", i + 1).isNotNull() & ~foreign(cells)
        return F.when((i >= 1) & banner(cells), F.lit("")).when(counted, F.coalesce(typed, legacy))

    rows = rows_of(
        tables, model=F.col("models"), banner_model=F.col("banners"), filled_model=F.col("filled_models"),
        label=carried(F.transform("grid", label)))
    below = F.col("row_ord") >= 1
    embedding = F.size("filled") >= 4
    rows = rows.withColumns({
        "vertex_category": F.try_element_at(groups, group),
        "tier": F.coalesce(tx.tier_of_headers(F.col("head")), tier_text, F.lit("standard")),
        "is_group": F.coalesce(
            (cell(0, "head") == "model") & (cell(1, "head") == "type") & group.isNotNull(), F.lit(False)
        ),
        "is_token": F.coalesce(F.col("heading") == "Token-based pricing", F.lit(False)),
        "banner": banner(F.col("cells")),
        "component": tx.component_of_label(F.col("label")),
        "label_modality": tx.infer_modality(F.col("label")),
    })
    counted = below & F.col("model").isNotNull() & ~foreign(F.col("cells"))
    skipped = F.lit(False)
    for mark in VERTEX_SKIPPED_LABELS:
        skipped = skipped | F.lower("label").contains(mark)
    shifted = F.when(F.size("cells") == F.size("head") - 1, 1).otherwise(0)
    start = F.greatest(F.lit(2), F.coalesce(F.col("region_at") + 1, F.lit(0)))
    columns = F.filter(F.sequence(F.lit(0), F.size("head") - 1), lambda i: i >= start)

    def entry(i: Column) -> Column:
        header = F.try_element_at("head", i + 1)
        return price(
            F.when(header.contains("cached input"), "cached_input").otherwise(F.col("component")),
            F.try_element_at("cells", i - shifted + 1),
            service_tier=(
                F.when(header.contains("batch api"), "batch")
                .when(header.contains("priority"), "priority")
                .when(header.contains("flex/batch") | header.contains("with flex"), "flexbatch")
                .otherwise(F.col("tier"))
            ),
            context_window=tx.context_of_header(header),
            modality=F.col("label_modality"),
            category=F.col("vertex_category"),
        )

    grouped = Rule(
        F.col("is_group") & (F.col("n_rows") >= 2) & counted & ~F.col("banner")
        & (F.coalesce("label", F.lit("")) != "") & ~skipped,
        F.col("model"),
        F.transform(columns, entry),
        retires=False,
    )

    low = F.lower(tx.norm(cell(0)))
    component = (
        F.when(low.contains("input"), "input")
        .when(low.contains("output"), "output")
        .when(low.rlike("tuning|training"), "training")
        .otherwise("price")
    )
    modality = F.lit(None).cast("string")
    for word in ("text", "video", "image", "audio"):
        modality = F.when(low.contains(word), word).otherwise(modality)
    grounding = low.startswith("grounding with") | low.startswith("web grounding")
    same = {"modality": modality, "category": "gemini_2_0"}
    plain = ~F.col("is_group") & (F.col("n_rows") >= 2) & below
    token = Rule(
        plain & F.col("is_token") & header_is(BATCH_TOKEN_HEADER) & F.col("banner_model").isNotNull()
        & (F.size("cells") >= 3) & ~grounding,
        F.col("banner_model"),
        [price(component, cell(1), service_tier="standard", **same), price(component, cell(2), service_tier="batch", **same)],
        retires=False,
    )
    rules = [grouped, token]
    kind = F.when(F.lower(cell(1, "filled")).contains("input"), "input").otherwise("output")
    for unit, header in EMBEDDING_HEADERS.items():
        online, batch = tx.online_batch_prices(cell(3, "filled"))
        rules.append(Rule(
            plain & ~F.col("is_token") & header_is(header) & embedding & F.col("filled_model").isNotNull(),
            F.col("filled_model"),
            [
                price(kind, online, unit, service_tier="online", category="embeddings"),
                price(kind, batch, unit, service_tier="batch", category="embeddings"),
            ],
            retires=False,
        ))
    return rows, rules


def openai_rules(parsed: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Six shapes told apart by their header rows."""
    rows = rows_of(tables_of(parsed))
    names = F.create_map(*[F.lit(x) for kv in OPENAI_CATEGORIES.items() for x in kv])
    rows = rows.withColumns({
        "category": F.try_element_at(names, F.col("category_text")),
        "tier": F.nullif(tx.slugify(F.col("openai_tier_text")), F.lit("")),
    })
    category, tier = F.col("category"), F.col("tier")
    prices3 = ("input", "cached_input", "output")

    def slug(c: Column) -> Column:
        return F.nullif(tx.slugify(c), F.lit(""))

    def shape(*headers: Sequence[str], width: int, of: str) -> Column:
        return (F.col("n_rows") >= 2) & (F.col("row_ord") >= 1) & header_is(*headers) & (F.size(of) >= width)

    flagship = (
        (F.col("n_rows") >= 3) & (F.col("row_ord") >= 2) & (F.size("cells") >= 4)
        & F.exists("head", lambda h: h.contains("context")) & F.array_contains("head2", "model")
    )
    full = F.size("cells") >= 7
    return rows, [
        Rule(flagship, cell(0), [
            *[price(k, cell(1 + i), service_tier=tier, context_window="short_context", category=category)
              for i, k in enumerate(prices3)],
            *[price(k, F.when(full, cell(4 + i)), service_tier=tier, context_window="long_context", category=category)
              for i, k in enumerate(prices3)],
        ], retires=False),
        Rule(shape(*MODALITY_HEADERS, width=5, of="filled"), cell(0, "filled"), [
            price(k, cell(2 + i, "filled"), modality=slug(cell(1, "filled")), category=category)
            for i, k in enumerate(prices3)
        ], retires=False),
        Rule(shape(VIDEO_HEADER, width=5, of="filled"), cell(0, "filled"), [
            price("generation", cell(4, "filled"), "per_second", modality="video", category=category,
                  billing_variant=slug(cell(1, "filled"))),
        ], retires=False),
        Rule(shape(TRANSCRIPTION_HEADER, width=4, of="cells"), cell(0), [
            price(k, cell(2 + i), category=category, billing_variant=slug(cell(1)))
            for i, k in enumerate(("input", "output"))
        ], retires=False),
        Rule(shape(CATEGORY_HEADER, width=5, of="filled"), cell(1, "filled"), [
            price(k, cell(2 + i, "filled"), service_tier=tier, category=category, billing_variant=slug(cell(0, "filled")))
            for i, k in enumerate(prices3)
        ], retires=False),
        Rule(shape(FINETUNING_HEADER, width=5, of="cells"), cell(0), [
            price("training", cell(1), "per_hour", service_tier=tier, category=category),
            *[price(k, cell(2 + i), service_tier=tier, category=category) for i, k in enumerate(prices3)],
        ], retires=False),
    ]


# The order in which providers arrive, for last-wins dedupe.
PROVIDER_RULES: dict[str, Callable[[DataFrame], tuple[DataFrame, list[Rule]]]] = {
    "anthropic": claude_rules,
    "google": vertex_rules,
    "openai": openai_rules,
    "xai": xai_rules,
    "deepseek": deepseek_rules,
    "qwen": qwen_rules,
}
ARRIVAL = ("provider_ord", "page_id", "table_ord", "row_ord", "entry_ord")


def provider_prices(pages: DataFrame, provider: str) -> DataFrame:
    """Component rows of one provider's pages."""
    rows, rules = PROVIDER_RULES[provider](parsed_pages(pages))
    found = apply_rules(rows, provider, rules)
    return found.filter(F.col("component").isin(*VERTEX_COMPONENTS)) if provider == "google" else found


def extract_prices(pages: DataFrame, providers: Sequence[str] = tuple(PROVIDER_RULES), strict_ids: bool = False) -> DataFrame:
    """Component rows of all pages; ``pages`` has provider_id, page_id, html.

    A provider's pages are parsed once, by its own branch: the provider filter
    sits below the parser, and prunes folders when pages are stored by provider.
    The arrival columns order rows for last-wins dedupe.
    """
    out = None
    for place, provider in enumerate(PROVIDER_RULES):
        if provider not in providers:
            continue
        mine = pages.filter(F.col("provider_id") == provider)
        found = provider_prices(mine, provider).withColumn("provider_ord", F.lit(place))
        out = found if out is None else out.unionByName(found)
    return component_rows(out, strict_ids)


def catalog_prices(products: DataFrame, terms: DataFrame) -> DataFrame:
    """Own-family token prices of a native catalog, per million tokens."""
    usage = tx.norm(F.col("attributes.usagetype"))
    name = tx.usage_model_name(F.col("attributes.model"), usage)
    rows = nested.catalog_rows(products, terms).withColumns({
        "component": tx.component_of_suffix(usage),
        "display_name": name,
        "price": ms.thousand_to_million(tx.money(F.col("usd"))),
    }).filter(
        (usage != "")
        & tx.owned_by_family(F.col("attributes.model"), F.col("attributes.usagetype"))
        & F.col("component").isNotNull()
        & ~tx.excluded_usage(usage)
        & F.col("display_name").isNotNull()
        & (F.lower(tx.norm(F.col("unit"))) == CATALOG_UNIT)
        & F.col("price").isNotNull()
    )
    return component_rows(rows.select(
        "sku",
        tx.slugify(F.col("display_name")).alias("model_id"),
        "display_name",
        F.lit("aws").alias("provider_id"),
        "component",
        "price",
        F.lit(ms.PER_MILLION).alias("unit"),
        F.lit("standard").alias("service_tier"),
        F.lit("bedrock").alias("category"),
        F.lit("text").alias("modality"),
    ))
