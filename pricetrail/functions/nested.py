"""JSON, array and map expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_of_json(c: Column, element: str) -> Column:
    """Rows of a row artifact: a bare list, or an object with a ``rows`` list."""
    bare = F.from_json(c, f"array<{element}>")
    wrapped = F.from_json(c, f"rows array<{element}>")["rows"]
    return F.when(F.ltrim(c).startswith("["), bare).otherwise(wrapped)


def try_field(c: Column, path: str, kind: str = "string") -> Column:
    """One field of a document, null when the document or field is unusable."""
    return F.try_variant_get(F.try_parse_json(c), path, kind)


def message_rows(df: DataFrame, keys: list[str], turn: str) -> DataFrame:
    """Coerce ``role``/``content``/``text`` columns to the chat shape.

    A conversation stays a set of rows, so its length is not limited by what
    fits into one array.
    """
    have = set(df.columns)
    content = [F.col(c) for c in ("content", "text") if c in have] + [F.lit("")]
    role = F.coalesce(F.col("role"), F.lit("user")) if "role" in have else F.lit("user")
    return df.select(*keys, turn, role.alias("role"), F.coalesce(*content).alias("content"))


def with_nudge(messages: DataFrame, keys: list[str], turn: str, nudge: str = ".") -> DataFrame:
    """Add a closing user message to conversations that end on the assistant."""
    ends = messages.groupBy(*keys).agg(
        F.max(turn).alias("__end"), F.max_by("role", turn).alias("__role")
    )
    extra = ends.filter(F.col("__role") == "assistant").select(
        *keys, (F.col("__end") + 1).alias(turn), F.lit("user").alias("role"), F.lit(nudge).alias("content")
    )
    return messages.unionByName(extra)


def nested_content(role: Column, content: Column) -> Column:
    """``{role, content: [{text}]}``."""
    return F.struct(role.alias("role"), F.array(F.struct(content.alias("text"))).alias("content"))


def nested_parts(role: Column, content: Column) -> Column:
    """``{role, parts: [{text}]}`` with every non-user role named ``model``."""
    who = F.when(role == "user", "user").otherwise("model")
    return F.struct(who.alias("role"), F.array(F.struct(content.alias("text"))).alias("parts"))


def map_get(m: Column, key: Column, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


CATALOG_PRODUCTS = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField(
            "attributes",
            T.StructType([
                T.StructField(n, T.StringType())
                for n in ("model", "inferenceType", "feature", "usagetype", "servicename")
            ]),
        )
    ]),
)
CATALOG_TERMS = T.StructType([
    T.StructField(
        "OnDemand",
        T.MapType(
            T.StringType(),
            T.MapType(
                T.StringType(),
                T.StructType([
                    T.StructField(
                        "priceDimensions",
                        T.MapType(
                            T.StringType(),
                            T.StructType([
                                T.StructField("unit", T.StringType()),
                                T.StructField("pricePerUnit", T.MapType(T.StringType(), T.StringType())),
                            ]),
                        ),
                    )
                ]),
            ),
        ),
    )
])


def catalog_rows(products: DataFrame, terms: DataFrame) -> DataFrame:
    """Join a catalog's product map with its term map, one row per price dimension.

    Both maps arrive as JSON text in a column ``payload``; any number of
    documents may hold parts of either map.
    """
    left = products.select(F.explode(F.from_json("payload", CATALOG_PRODUCTS))).select(
        F.col("key").alias("sku"), F.col("value.attributes").alias("attributes")
    )
    right = (
        terms.select(F.explode(F.from_json("payload", CATALOG_TERMS)["OnDemand"]).alias("sku", "offers"))
        .select("sku", F.explode("offers").alias("offer_id", "offer"))
        .select("sku", "offer_id", F.explode("offer.priceDimensions").alias("dimension_id", "dimension"))
        .select(
            "sku",
            "offer_id",
            "dimension_id",
            F.col("dimension.unit").alias("unit"),
            F.try_element_at(F.col("dimension.pricePerUnit"), F.lit("USD")).alias("usd"),
        )
    )
    return left.join(right, "sku")
