"""Normalisation into a star schema (N1–N6) and the flat denormalised view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesq.operators.keys import assign_ids
from salesq.session import cut_lineage


def surrogate_dim(df: DataFrame, col: str, id_name: str, name_name: str) -> DataFrame:
    """Distinct non-null names sorted ascending, ids 1..n."""
    names = df.select(F.col(col).alias(name_name)).filter(F.col(name_name).isNotNull()).distinct()
    return assign_ids(names, [name_name], id_name)


def null_names(df: DataFrame, col: str) -> DataFrame:
    """Rows a dimension cannot take (NULL name) — reported, not failed on."""
    return df.agg(F.sum(F.col(col).isNull().cast("bigint")).alias("null_names"))


def customer_dim(df: DataFrame, col: str = "customer_id") -> DataFrame:
    """Distinct customer ids; name = 'Customer_' + second '_' token (NULL if none)."""
    ids = df.select(F.col(col).alias("customer_id")).filter(F.col("customer_id").isNotNull()).distinct()
    token = F.try_element_at(F.split(F.col("customer_id"), "_"), F.lit(2))
    return ids.withColumn("customer_name", F.concat(F.lit("Customer_"), token))


def item_dim(df: DataFrame, categories: DataFrame, ordinal: str | None = None,
             item: str = "item", category: str = "category", price: str = "price_per_unit") -> DataFrame:
    """One row per distinct (item, category, price); CategoryID looked up by
    name. Ids follow the first appearance by ``ordinal``, a column with the
    source's row order; without one a frame has no order, and ids follow item,
    category and price."""
    key = ["item_name", "category_name", "price_per_unit"]
    named = df.filter(F.col(item).isNotNull()).select(
        F.col(item).alias(key[0]), F.col(category).alias(key[1]), F.col(price).alias(key[2]),
        *([F.col(ordinal).alias("_first")] if ordinal else []))
    if ordinal:
        ided = assign_ids(named.groupBy(*key).agg(F.min("_first").alias("_first")), ["_first", *key], "item_id")
    else:
        ided = assign_ids(named.distinct(), key, "item_id")
    return (ided.join(categories.select("category_id", "category_name"), "category_name", "left")
            .select("item_id", "item_name", "price_per_unit", "category_id"))


def build_fact(df: DataFrame, dims: dict[str, DataFrame], carry: list[str] | None = None) -> DataFrame:
    """Look keys up by name; item by (item name, category id) where the
    highest ItemID wins for multi-price items; missing lookups stay NULL.
    Columns of ``carry`` (e.g. an ordinal) go along."""
    cats = dims["categories"].select(F.col("category_name").alias("_cat_name"), F.col("category_id").alias("_cat_id"))
    # written: a join side that is an aggregate in the same plan keeps AQE from
    # splitting the fact's partition of a hot item
    items = cut_lineage(dims["items"].groupBy("item_name", "category_id").agg(F.max("item_id").alias("item_id"))
                        .select(F.col("item_name").alias("_item_name"), F.col("category_id").alias("_item_cat"), "item_id"))
    pms = dims["payment_methods"].select(F.col("payment_method_name").alias("_pm_name"), "payment_method_id")
    locs = dims["locations"].select(F.col("location_name").alias("_loc_name"), "location_id")
    f = (df.join(cats, F.col("category") == F.col("_cat_name"), "left")
         .join(items, (F.col("item") == F.col("_item_name")) & (F.col("_cat_id") == F.col("_item_cat")), "left")
         .join(pms, F.col("payment_method") == F.col("_pm_name"), "left")
         .join(locs, F.col("location") == F.col("_loc_name"), "left"))
    return f.select(
        F.col("transaction_id"), F.col("customer_id"), F.col("item_id"), F.col("payment_method_id"),
        F.col("location_id"), F.col("quantity"), F.col("total_spent").alias("total_price"),
        F.col("transaction_date"), F.col("discount_applied"), *[F.col(c) for c in carry or []])


def normalize(clean_df: DataFrame) -> dict[str, DataFrame]:
    """The six star tables from the clean table."""
    categories = surrogate_dim(clean_df, "category", "category_id", "category_name")
    customers = customer_dim(clean_df)
    payment_methods = surrogate_dim(clean_df, "payment_method", "payment_method_id", "payment_method_name")
    locations = surrogate_dim(clean_df, "location", "location_id", "location_name")
    items = item_dim(clean_df, categories)
    dims = {"categories": categories, "customers": customers, "payment_methods": payment_methods,
            "locations": locations, "items": items}
    return {**dims, "transactions": build_fact(clean_df, dims)}


def denormalize_flat(star: dict[str, DataFrame]) -> DataFrame:
    """Fact LEFT JOIN every dimension (orphans kept), 11 columns."""
    t = star["transactions"]
    items = star["items"].select("item_id", "item_name", "price_per_unit", F.col("category_id").alias("_item_cat"))
    return (t.join(star["customers"].select("customer_id", "customer_name"), "customer_id", "left")
            .join(items, "item_id", "left")
            .join(star["categories"].select(F.col("category_id").alias("_item_cat"), "category_name"),
                  "_item_cat", "left")
            .join(star["payment_methods"].select("payment_method_id", "payment_method_name"),
                  "payment_method_id", "left")
            .join(star["locations"].select("location_id", "location_name"), "location_id", "left")
            .select("transaction_id", "customer_name", "category_name", "item_name", "price_per_unit",
                    "quantity", "total_price", "payment_method_name", "location_name",
                    "transaction_date", "discount_applied"))
