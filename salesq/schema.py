"""Table contracts (S12): Spark types, keys, foreign keys and text limits of the
relational star. Spark enforces none of these; ``conform`` and the checks do."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    pk: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    fks: dict[str, tuple[str, str]] = field(default_factory=dict)   # column -> (table, column)
    max_bytes: dict[str, int] = field(default_factory=dict)          # VARCHAR(n) limits
    not_null: tuple[str, ...] = ()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


AUDIT = [_f("created_at", T.TimestampNTZType()), _f("updated_at", T.TimestampNTZType())]
MONEY = T.DecimalType(10, 2)

# The relational contract (types, keys and VARCHAR limits).
TABLES: dict[str, TableSpec] = {
    "categories": TableSpec(
        "categories",
        T.StructType([_f("category_id", T.IntegerType(), False), _f("category_name", T.StringType(), False), *AUDIT]),
        pk=("category_id",), unique=(("category_name",),), max_bytes={"category_name": 64},
        not_null=("category_name",)),
    "locations": TableSpec(
        "locations",
        T.StructType([_f("location_id", T.IntegerType(), False), _f("location_name", T.StringType(), False), *AUDIT]),
        pk=("location_id",), unique=(("location_name",),), max_bytes={"location_name": 32},
        not_null=("location_name",)),
    "payment_methods": TableSpec(
        "payment_methods",
        T.StructType([_f("payment_method_id", T.IntegerType(), False),
                      _f("payment_method_name", T.StringType(), False), *AUDIT]),
        pk=("payment_method_id",), unique=(("payment_method_name",),), max_bytes={"payment_method_name": 32},
        not_null=("payment_method_name",)),
    "customers": TableSpec(
        "customers",
        T.StructType([_f("customer_id", T.StringType(), False), *AUDIT]),
        pk=("customer_id",), max_bytes={"customer_id": 32}, not_null=("customer_id",)),
    "items": TableSpec(
        "items",
        T.StructType([_f("item_id", T.IntegerType(), False), _f("item_name", T.StringType(), False),
                      _f("price_per_unit", MONEY, False), _f("category_id", T.IntegerType(), False), *AUDIT]),
        pk=("item_id",), unique=(("item_name", "category_id"),), fks={"category_id": ("categories", "category_id")},
        max_bytes={"item_name": 64}, not_null=("item_name", "price_per_unit", "category_id")),
    "transactions": TableSpec(
        "transactions",
        T.StructType([_f("transaction_id", T.StringType(), False), _f("customer_id", T.StringType(), False),
                      _f("item_id", T.IntegerType(), False), _f("payment_method_id", T.IntegerType(), False),
                      _f("location_id", T.IntegerType(), False), _f("quantity", T.IntegerType(), False),
                      _f("total_price", MONEY, False), _f("transaction_date", T.DateType(), False),
                      _f("discount_applied", T.BooleanType()), *AUDIT]),
        pk=("transaction_id",),
        fks={"customer_id": ("customers", "customer_id"), "item_id": ("items", "item_id"),
             "payment_method_id": ("payment_methods", "payment_method_id"),
             "location_id": ("locations", "location_id")},
        max_bytes={"transaction_id": 32, "customer_id": 32},
        not_null=("transaction_id", "customer_id", "item_id", "payment_method_id", "location_id",
                  "quantity", "total_price", "transaction_date")),
}

# Parents before children.
LOAD_ORDER = ["categories", "locations", "payment_methods", "customers", "items", "transactions"]
