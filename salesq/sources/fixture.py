"""Deterministic dirty inputs derived from the driver's TPC-H-style tables.

``raw_sales``   : the 11-column raw sales feed (snake_case), with nulls,
                  off-grid prices, bad dates and inconsistent totals placed by
                  a hash of the line keys (see FIXTURES.md §3).
``damaged_star``: a star schema with orphans, rule violations and duplicates
                  for the validation checks (FIXTURES.md §4).

Everything is a lazy join of ``lineitem``, ``orders``, ``part`` (and
``customer``); work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesq.session import materialize, read_table

# The order of the feed's rows, where the scan gives it (sources.io.read_raw_sales).
ORDINAL = "row_order"

RAW_COLUMNS = [
    "transaction_id", "customer_id", "category", "item", "price_per_unit",
    "quantity", "total_spent", "payment_method", "location",
    "transaction_date", "discount_applied",
]

# The raw feed's CSV header names, in column order.
CSV_HEADERS = [
    "Transaction ID", "Customer ID", "Category", "Item", "Price Per Unit",
    "Quantity", "Total Spent", "Payment Method", "Location",
    "Transaction Date", "Discount Applied",
]


def _between(c, lo: int, hi: int):
    return (c >= lo) & (c <= hi)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part with only the columns the fixtures use."""
    # parts first, while the rows are narrow: where part is too big to broadcast, the
    # orders' columns are not shuffled by its key. Then hash-partitioned by order key:
    # the partitioning the order join needs when orders is too big to broadcast, and
    # parallelism when a source file is a single row group
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # (the key goes through the exchange once, not as p_partkey again)
    typed = li.join(p, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey").repartition("l_orderkey")
    return (typed.withColumn("p_partkey", F.col("l_partkey"))
            .join(o, F.col("l_orderkey") == F.col("o_orderkey")))


def _txn_id():
    return F.concat_ws("_", F.lit("TXN"), F.col("l_orderkey").cast("string"),
                       F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                       F.col("l_suppkey").cast("string"))


def _grid_price():
    return F.lit(5.0) + F.lit(1.5) * (F.col("p_partkey") % 25).cast("double")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty raw feed, typed as the raw reader would type it.

    Written once per session to the shared checkpoint folder, so every
    consumer scans it like the raw table it stands for."""
    return materialize(spark, f"raw_sales:{sf_dir}", lambda: build_raw_sales(spark, sf_dir))


def build_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17
         + F.col("l_partkey") * 7 + F.col("l_suppkey")) % 1000
    d = _lines(spark, sf_dir).withColumn("_k", k).withColumn("_price", _grid_price())
    k = F.col("_k")
    price = F.col("_price")
    qty = F.col("l_quantity")
    adj = (F.when(_between(k, 117, 121), price + F.lit(0.5))
            .when(_between(k, 122, 125), price + F.lit(0.75))
            .when(_between(k, 126, 129), price + F.lit(60.0))
            .otherwise(price))
    return d.select(
        _txn_id().alias("transaction_id"),
        F.when(_between(k, 130, 134), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        F.col("p_type").alias("category"),
        F.when((k < 97) | _between(k, 117, 129), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Item_"), ((F.col("p_partkey") % 25) + 1).cast("string"),
                             F.lit("_"), F.col("p_type"))).alias("item"),
        F.when(_between(k, 48, 96), F.lit(None).cast("double")).otherwise(adj).alias("price_per_unit"),
        F.when((k < 48) | _between(k, 97, 106), F.lit(None).cast("double")).otherwise(qty).alias("quantity"),
        F.when((k < 48) | _between(k, 107, 116), F.lit(None).cast("double"))
         .when(_between(k, 117, 129), adj * qty)
         .when(_between(k, 135, 139), price * qty + F.lit(1.0))
         .otherwise(price * qty).alias("total_spent"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("location"),
        F.when(_between(k, 140, 144), F.lit("not-a-date"))
         .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("transaction_date"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .when(F.col("l_discount") > 0.05, F.lit("True"))
         .otherwise(F.lit("False")).alias("discount_applied"),
    )


def raw_sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_sales`` as a CSV would carry it: all text, CSV headers, and missing
    values written as assorted pandas missing tokens (chosen by a key hash)."""
    df = raw_sales(spark, sf_dir)
    tok_sel = F.abs(F.xxhash64("transaction_id")) % 4
    token = (F.when(tok_sel == 0, F.lit("")).when(tok_sel == 1, F.lit("NaN"))
              .when(tok_sel == 2, F.lit("NULL")).otherwise(F.lit("nan")))
    cols = []
    for name, header in zip(RAW_COLUMNS, CSV_HEADERS):
        c = F.col(name)
        txt = c.cast("string")
        if name in ("transaction_id", "customer_id"):
            # keys keep real NULLs (an empty CSV field)
            cols.append(txt.alias(header))
        else:
            cols.append(F.when(c.isNull(), token).otherwise(txt).alias(header))
    return df.select(*cols)


# ---------------------------------------------------------------- damaged star

def _j():
    return (F.col("l_orderkey") * 13 + F.col("l_linenumber") * 7
            + F.col("l_partkey") * 3 + F.col("l_suppkey")) % 1000


def _category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category_name, category_id): rank of the category name (written once)."""
    from salesq.operators.keys import assign_ids

    def build():
        types = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("category_name")).distinct()
        return assign_ids(types, ["category_name"], "category_id")
    return materialize(spark, f"category_rank:{sf_dir}", build)


def damaged_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Star tables with planted defects (each written once per session)."""
    built = None

    def get(name):
        def build():
            nonlocal built
            if built is None:
                built = build_damaged_star(spark, sf_dir)
            return built[name]
        return materialize(spark, f"damaged_star.{name}:{sf_dir}", build)

    out = {name: get(name) for name in
           ("items", "customers", "categories", "payment_methods", "locations", "_fact_with_j")}
    out["transactions"] = out["_fact_with_j"].drop("_j")
    return out


def build_damaged_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Star tables with planted defects for the validation checks."""
    cats = _category_rank(spark, sf_dir)
    base = (_lines(spark, sf_dir)
            .join(cats, F.col("p_type") == F.col("category_name"))
            .withColumn("_j", _j())
            .withColumn("_g", F.col("p_partkey") % 25)
            .withColumn("_price", _grid_price()))
    # j = 2 rows appear twice; made from the joined row, so that the joins run once
    base = base.withColumn("_copy", F.explode(F.when(F.col("_j") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_copy")
    j = F.col("_j")
    price = F.col("_price")
    qty = F.col("l_quantity")
    tid = _txn_id()
    fact = base.select(
        F.when(j == 0, F.lit(None).cast("string"))
         .when(j == 1, F.concat(tid, F.lit("_"), F.lit("x" * 40)))
         .otherwise(tid).alias("transaction_id"),
        F.when(j == 3, F.lit("CUST_missing")).when(j == 4, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        F.when(j == 5, F.lit(-1).cast("int"))
         .otherwise(((F.col("category_id") - 1) * 25 + F.col("_g") + 1).cast("int")).alias("item_id"),
        F.when(j == 6, F.lit(99))
         .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")).cast("int").alias("payment_method_id"),
        F.when(j == 7, F.lit(99)).when(F.col("o_orderstatus") == "F", F.lit(1))
         .when(F.col("o_orderstatus") == "O", F.lit(2)).when(F.col("o_orderstatus") == "P", F.lit(3))
         .cast("int").alias("location_id"),
        F.when(j == 8, F.lit(0.0)).when(j == 9, F.lit(-1.0)).when(j == 10, F.lit(5000.0))
         .otherwise(qty).alias("quantity"),
        F.when(j == 11, price * qty + F.lit(1.0)).when(j == 12, F.lit(100000001.0))
         .when(j == 13, F.lit(10.005)).when(j == 8, F.lit(0.0)).when(j == 9, -price)
         .when(j == 10, F.lit(5000.0) * price).otherwise(price * qty).alias("total_price"),
        F.when(j == 14, F.to_date(F.lit("2030-01-01")))
         .otherwise(F.to_date(F.col("o_orderdate"))).alias("transaction_date"),
        (F.col("l_discount") > 0.05).alias("discount_applied"),
        j.alias("_j"),
    )
    parts = read_table(spark, sf_dir, "part").select("p_type", (F.col("p_partkey") % 25).alias("_g")).distinct()
    items = (parts.join(cats, F.col("p_type") == F.col("category_name"))
             .select(((F.col("category_id") - 1) * 25 + F.col("_g") + 1).cast("int").alias("item_id"),
                     F.concat(F.lit("Item_"), (F.col("_g") + 1).cast("string"), F.lit("_"),
                              F.col("p_type")).alias("item_name"),
                     (F.lit(5.0) + F.lit(1.5) * F.col("_g").cast("double")).alias("price_per_unit"),
                     F.col("category_id").cast("int").alias("category_id")))
    # one item of a category that does not exist (V5)
    items = items.unionByName(spark.range(1).select(
        F.lit(1000000).alias("item_id"), F.lit("Item_lost").alias("item_name"), F.lit(9.5).alias("price_per_unit"),
        F.lit(9999).alias("category_id")))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    customers = (cust.select(F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("customer_id"))
                 .unionByName(cust.filter(F.col("c_custkey") < 5)
                              .select(F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("customer_id")))
                 .unionByName(spark.range(1).select(F.lit("CUST_" + "L" * 35).alias("customer_id"))))
    orders = read_table(spark, sf_dir, "orders")
    pms = (orders.select(F.col("o_orderpriority").alias("payment_method_name")).distinct()
           .select(F.substring("payment_method_name", 1, 1).cast("int").alias("payment_method_id"),
                   "payment_method_name"))
    locs = (orders.select(F.col("o_orderstatus").alias("location_name")).distinct()
            .select(F.when(F.col("location_name") == "F", 1).when(F.col("location_name") == "O", 2)
                    .when(F.col("location_name") == "P", 3).cast("int").alias("location_id"),
                    "location_name"))
    return {
        "transactions": fact.drop("_j"),
        "items": items,
        "customers": customers,
        "categories": cats.select(F.col("category_id").cast("int").alias("category_id"), "category_name"),
        "payment_methods": pms,
        "locations": locs,
        "_fact_with_j": fact,
    }


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction documents copied from the damaged star with planted differences:
    j=20 removed, j=21 quantity+1, j=22 total+0.02, j=23 date+1 day."""
    from salesq.operators.documents import transaction_documents
    fact = damaged_star(spark, sf_dir)["_fact_with_j"]
    j = F.col("_j")
    fact = (fact.filter(j != 20)
            .withColumn("quantity", F.when(j == 21, F.col("quantity") + 1).otherwise(F.col("quantity")))
            .withColumn("total_price", F.when(j == 22, F.col("total_price") + F.lit(0.02))
                        .otherwise(F.col("total_price")))
            .withColumn("transaction_date", F.when(j == 23, F.date_add("transaction_date", 1))
                        .otherwise(F.col("transaction_date")))
            .drop("_j"))
    return transaction_documents(fact)
