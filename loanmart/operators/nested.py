"""Nested-document operators (N1-N5, N7): draws, payees, item lists.

All are narrow (explode / from_json / higher-order functions): no shuffle,
work grows linearly with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Draw header fields and item fields of the draw document.
DRAW_HEADER = ("id", "requestedBy", "name", "type", "containerNumber", "status", "createdDate",
               "submittedDate", "approvedDate", "effectiveDate", "folderId")
ITEM_FIELDS = ("number", "description", "subDescription", "requested", "retainage", "totalLessRetainage")

ITEM_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ITEM_FIELDS])
LINE_ITEMS_SCHEMA = T.StructType([
    T.StructField("payee", T.MapType(T.StringType(), T.StructType([
        T.StructField("items", T.ArrayType(T.ArrayType(ITEM_SCHEMA)))]))),
])
DRAW_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in DRAW_HEADER]
    + [T.StructField("lineItems", LINE_ITEMS_SCHEMA)])

# Output names of the flattened draw rows, in output order.
DRAW_ROW_COLUMNS = (
    "draw_id", "requestedBy", "name", "type", "containerNumber", "status", "createdDate",
    "submittedDate", "approvedDate", "effectiveDate", "folderId",
    "lineItems.number", "payee.name", "lineItems.description", "lineItems.subDescription",
    "lineItems.amount", "lineItems.retainage", "lineItems.totalLessRetainage",
)


def line_items_struct(df: DataFrame, col: str = "lineItems") -> Column:
    """``lineItems`` as a struct, parsing it when it was landed as JSON text."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return F.from_json(F.col(col), LINE_ITEMS_SCHEMA)
    return F.col(col)


def flatten_draws(draws: DataFrame) -> DataFrame:
    """One row per item of every payee's item lists.

    payee map -> entries (N2), list of lists -> one list (N3), then header
    and item fields in report order (N4); ``amount`` is the requested value.
    Draws with no payee or no items give no rows.
    """
    header = [F.col(h) for h in DRAW_HEADER]
    payees = draws.select(*header, F.explode(F.map_entries(line_items_struct(draws).getField("payee"))).alias("p"))
    items = payees.select(*header, F.col("p.key").alias("_payee"),
                          F.explode(F.flatten(F.col("p.value.items"))).alias("it"))
    return items.select(
        F.col("id").cast("string").alias("draw_id"), *[F.col(h) for h in DRAW_HEADER[1:]],
        F.col("it.number").alias("lineItems.number"),
        F.col("_payee").alias("payee.name"),
        F.col("it.description").alias("lineItems.description"),
        F.col("it.subDescription").alias("lineItems.subDescription"),
        F.col("it.requested").alias("lineItems.amount"),
        F.col("it.retainage").alias("lineItems.retainage"),
        F.col("it.totalLessRetainage").alias("lineItems.totalLessRetainage"),
    )


def nested_get(col: str, default=None) -> Column:
    """Struct field by dotted path, with a default for null."""
    c = F.col(col)
    return c if default is None else F.coalesce(c, F.lit(default))


def explode_matching(df: DataFrame, array_col: str, field: str, value: str,
                     keep: list[str]) -> DataFrame:
    """N7 + F14: keep array elements whose ``field`` equals ``value`` exactly,
    one row each; parents with no match (or no array) give no rows."""
    matched = F.filter(F.col(array_col), lambda x: x.getField(field) == F.lit(value))
    return df.select(*keep, F.explode(matched).alias("_e")).select(*keep, "_e.*")
