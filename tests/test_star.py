from pyspark.sql import functions as F

from salesq.operators import documents as D
from salesq.operators import star as N
from salesq.operators.keys import assign_ids


def test_assign_ids_dense_and_ordered(spark):
    df = spark.range(0, 1000).select(F.format_string("k%04d", (F.col("id") * 7919) % 1000).alias("k"))
    for n in (None, 7):            # AQE-sized ranges, and a fixed 7 ranges (offsets across partitions)
        rows = assign_ids(df, ["k"], "kid", num_partitions=n).collect()
        ids = sorted((r["k"], r["kid"]) for r in rows)
        assert [i for _, i in ids] == list(range(1, 1001))


def test_customer_name_and_multi_price_items(spark):
    clean = spark.createDataFrame(
        [("T1", "CUST_7", "A", "I1", 10.0, 1.0, 10.0, "Cash", "S", None, True),
         ("T2", "CUST", "A", "I1", 12.0, 1.0, 12.0, "Cash", "S", None, False)],
        "transaction_id string, customer_id string, category string, item string, price_per_unit double, "
        "quantity double, total_spent double, payment_method string, location string, transaction_date date, "
        "discount_applied boolean")
    star = N.normalize(clean)
    names = {r["customer_id"]: r["customer_name"] for r in star["customers"].collect()}
    assert names == {"CUST_7": "Customer_7", "CUST": None}
    items = sorted((r["price_per_unit"], r["item_id"]) for r in star["items"].collect())
    assert items == [(10.0, 1), (12.0, 2)]
    assert {r["item_id"] for r in star["transactions"].collect()} == {2}   # highest id wins


def test_unknown_category_kept_left_lost_inner(spark):
    star = {
        "transactions": spark.createDataFrame([("T1", "C1", 1, 1, 1, 1.0, 5.0, None, False)],
                                              "transaction_id string, customer_id string, item_id int, "
                                              "payment_method_id int, location_id int, quantity double, "
                                              "total_price double, transaction_date date, discount_applied boolean"),
        "customers": spark.createDataFrame([("C1", "Customer_1")], "customer_id string, customer_name string"),
        "items": spark.createDataFrame([(1, "I", 5.0, 42)], "item_id int, item_name string, price_per_unit double, category_id int"),
        "categories": spark.createDataFrame([(1, "A")], "category_id int, category_name string"),
        "payment_methods": spark.createDataFrame([(1, "Cash")], "payment_method_id int, payment_method_name string"),
        "locations": spark.createDataFrame([(1, "S")], "location_id int, location_name string"),
    }
    assert N.denormalize_flat(star).count() == 1
    assert D.item_documents(star["items"], star["categories"]).count() == 0
    assert D.embedded_documents(star).count() == 0


def test_ids_are_unique_with_payload_columns_and_several_ranges(spark):
    n = 500_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    for parts in (7, None):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
        try:
            got = assign_ids(df, ["k"], "kid", num_partitions=parts)
            r = got.agg(F.count(F.lit(1)), F.count_distinct("kid"), F.max("kid"), F.sum((F.col("kid") != F.col("k") + 1).cast("int"))).first()
            assert tuple(r) == (n, n, n, 0)
            assert got.columns == ["kid", "k", "payload"]
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_item_ids_by_first_appearance(spark):
    clean = spark.createDataFrame([("z", 9), ("a", 5), ("z", 1)], "item string, line int").select(
        "item", F.lit("C").alias("category"), F.lit(1.0).alias("price_per_unit"), "line")
    cats = spark.createDataFrame([(1, "C")], "category_id int, category_name string")
    assert {r["item_name"]: r["item_id"] for r in N.item_dim(clean, cats, ordinal="line").collect()} == {"z": 1, "a": 2}
    assert {r["item_name"]: r["item_id"] for r in N.item_dim(clean, cats).collect()} == {"a": 1, "z": 2}
