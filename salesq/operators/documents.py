"""Document forms of the star (D2–D6): snake_case fields, ``_id`` keys,
decimals as doubles, dates as midnight timestamps, one level of nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup dimensions: table -> (id column, name column, document name field)
LOOKUPS = {
    "categories": ("category_id", "category_name", "category_name"),
    "locations": ("location_id", "location_name", "location_name"),
    "payment_methods": ("payment_method_id", "payment_method_name", "payment_method_name"),
}


def _audit_cols(df: DataFrame):
    """created_at/updated_at when the source table carries them (loaded tables)."""
    return [F.col(c) for c in ("created_at", "updated_at") if c in df.columns]


def lookup_documents(dim: DataFrame, table: str) -> DataFrame:
    """``_id`` + name (+ audit timestamps)."""
    id_col, name_col, field = LOOKUPS[table]
    return dim.select(F.col(id_col).alias("_id"), F.col(name_col).alias(field), *_audit_cols(dim))


def customer_documents(dim: DataFrame) -> DataFrame:
    """D3: key and timestamps only."""
    return dim.select(F.col("customer_id").alias("_id"), *_audit_cols(dim))


def item_documents(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Items with the category name copied in (INNER: items without a category vanish)."""
    cats = categories.select("category_id", "category_name")
    return (items.join(cats, "category_id", "inner")
            .select(F.col("item_id").alias("_id"), "item_name",
                    F.col("price_per_unit").cast("double").alias("price_per_unit"),
                    "category_id", "category_name", *_audit_cols(items)))


def transaction_documents(fact: DataFrame) -> DataFrame:
    """Flat transaction documents with document-side types."""
    return fact.select(
        F.col("transaction_id").alias("_id"), "customer_id", "item_id", "payment_method_id", "location_id",
        F.col("quantity"), F.col("total_price").cast("double").alias("total_price"),
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        F.coalesce(F.col("discount_applied").cast("boolean"), F.lit(False)).alias("discount_applied"),
        *_audit_cols(fact))


def embedded_documents(star: dict[str, DataFrame]) -> DataFrame:
    """Transactions with item/category/payment_method/location sub-documents.
    INNER joins on all four (a transaction with any dangling key is not copied)."""
    t = star["transactions"]
    items = star["items"].select(F.col("item_id"), F.col("item_name"),
                                 F.col("price_per_unit").alias("_price"), F.col("category_id").alias("_cat"))
    cats = star["categories"].select(F.col("category_id").alias("_cat"), "category_name")
    pms = star["payment_methods"].select("payment_method_id", "payment_method_name")
    locs = star["locations"].select("location_id", "location_name")
    j = (t.join(items, "item_id").join(cats, "_cat").join(pms, "payment_method_id").join(locs, "location_id"))
    return j.select(
        F.col("transaction_id").alias("_id"), "customer_id",
        F.col("quantity"), F.col("total_price").cast("double").alias("total_price"),
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        F.coalesce(F.col("discount_applied").cast("boolean"), F.lit(False)).alias("discount_applied"),
        F.struct(F.col("item_id"), F.col("item_name"), F.col("_price").cast("double").alias("price_per_unit")).alias("item"),
        F.struct(F.col("_cat").alias("category_id"), F.col("category_name")).alias("category"),
        F.struct("payment_method_id", "payment_method_name").alias("payment_method"),
        F.struct("location_id", "location_name").alias("location"),
        *_audit_cols(t))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Sub-document fields as top-level columns (``item.item_id`` -> ``item_item_id``)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"{f.name}.{s.name}").alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
