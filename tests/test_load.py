import datetime as dt

from pyspark.sql import functions as F

from salesq.operators import load as L
from salesq.schema import TABLES


def test_dimension_upsert_is_idempotent_and_keeps_created(spark):
    names = spark.createDataFrame([("b",), ("a",)], "category_name string")
    t1 = L.upsert_dimension(L.empty_table(spark, "categories"), names, "category_id", "category_name",
                            "2024-01-01 00:00:00")
    more = spark.createDataFrame([("c",), ("a",)], "category_name string")
    t2 = L.upsert_dimension(t1, more, "category_id", "category_name", "2024-01-02 00:00:00")
    got = {r["category_name"]: (r["category_id"], r["created_at"], r["updated_at"]) for r in t2.collect()}
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert got == {"a": (1, d1, d2), "b": (2, d1, d1), "c": (3, d2, d2)}
    again = L.upsert_dimension(t2, more, "category_id", "category_name", "2024-01-02 00:00:00")
    assert sorted(again.collect()) == sorted(t2.collect())


def test_items_upsert_latest_price_wins_and_ids_kept(spark):
    src = spark.createDataFrame([(1, "I", 10.0, 1), (2, "I", 12.0, 1)],
                                "item_id int, item_name string, price_per_unit double, category_id int")
    t = L.upsert_items(L.empty_table(spark, "items"), src, "2024-01-01 00:00:00")
    rows = t.collect()
    assert len(rows) == 1 and float(rows[0]["price_per_unit"]) == 12.0 and rows[0]["item_id"] == 1


def test_transactions_upsert_twice_changes_nothing(spark):
    src = spark.createDataFrame([("T1", "C", 1, 1, 1, 2.0, 5.0, dt.date(2020, 1, 1), True)],
                                "transaction_id string, customer_id string, item_id int, payment_method_id int, "
                                "location_id int, quantity double, total_price double, transaction_date date, "
                                "discount_applied boolean")
    empty = spark.createDataFrame([], src.schema.add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz"))
    t1 = L.upsert_transactions(empty, src, "2024-01-01 00:00:00")
    t2 = L.upsert_transactions(t1, src, "2024-01-05 00:00:00")
    assert t1.collect() == t2.collect()
    changed = src.withColumn("quantity", F.lit(3.0))
    t3 = L.upsert_transactions(t2, changed, "2024-01-06 00:00:00").first()
    assert t3["quantity"] == 3.0 and t3["updated_at"] == dt.datetime(2024, 1, 6)
    assert t3["created_at"] == dt.datetime(2024, 1, 1)


def test_reconcile_modes(spark):
    e = spark.createDataFrame([("t", 10)], "table_name string, row_count long")
    a = spark.createDataFrame([("t", 12)], "table_name string, row_count long")
    assert L.reconcile_counts(e, a, "at_least").first()["passed"] is True
    assert L.reconcile_counts(e, a, "exact").first()["passed"] is False


def test_split_valid_reasons(spark):
    df = spark.createDataFrame(
        [("T" * 40, None, 1, 1, 1, 2.0, 1e9, dt.date(2020, 1, 1), True),
         ("T2", "C", 9, 1, 1, 2.4, 5.0, dt.date(2020, 1, 1), True)],
        "transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
        "quantity double, total_price double, transaction_date date, discount_applied boolean")
    parents = {"items": spark.createDataFrame([(1,)], "item_id int")}
    valid, rejects = L.split_valid(df, TABLES["transactions"], parents)
    r = {x["transaction_id"]: x["reasons"] for x in rejects.collect()}
    assert set(r["T" * 40]) == {"bad_type:total_price", "null:customer_id", "too_long:transaction_id"}
    assert r["T2"] == ["missing_parent:item_id"]
    assert valid.count() == 0


def test_partitioned_upsert_touches_only_changed_months(spark, tmp_out):
    import os
    schema = ("transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
              "quantity double, total_price double, transaction_date date, discount_applied boolean")
    b1 = spark.createDataFrame([("A", "C", 1, 1, 1, 1.0, 5.0, dt.date(2020, 1, 5), True),
                                ("B", "C", 1, 1, 1, 2.0, 10.0, dt.date(2020, 2, 5), False),
                                ("D", "C", 1, 1, 1, 3.0, 15.0, dt.date(2020, 3, 5), False)], schema)
    target = os.path.join(tmp_out, "fact")
    assert L.upsert_partitioned(spark, target, b1, "2024-01-01 00:00:00") == ["2020-01", "2020-02", "2020-03"]
    march = os.path.join(target, "year_month=2020-03")
    before = sorted(os.listdir(march))
    # B changes quantity; D moves from March to January; E is new in April
    b2 = spark.createDataFrame([("B", "C", 1, 1, 1, 9.0, 10.0, dt.date(2020, 2, 5), False),
                                ("D", "C", 1, 1, 1, 3.0, 15.0, dt.date(2020, 1, 9), False),
                                ("E", "C", 1, 1, 1, 1.0, 5.0, dt.date(2020, 4, 1), True)], schema)
    touched = L.upsert_partitioned(spark, target, b2, "2024-01-02 00:00:00")
    assert touched == ["2020-01", "2020-02", "2020-03", "2020-04"]
    assert not os.path.exists(march) or sorted(os.listdir(march)) != before
    got = {r["transaction_id"]: r for r in spark.read.parquet(target).collect()}
    assert set(got) == {"A", "B", "D", "E"}
    assert got["B"]["quantity"] == 9.0 and got["B"]["updated_at"] == dt.datetime(2024, 1, 2)
    assert got["A"]["updated_at"] == dt.datetime(2024, 1, 1)
    assert got["D"]["year_month"] == "2020-01" and got["D"]["created_at"] == dt.datetime(2024, 1, 1)
    # an untouched month keeps its files
    b3 = spark.createDataFrame([("E", "C", 1, 1, 1, 2.0, 5.0, dt.date(2020, 4, 1), True)], schema)
    jan = sorted(os.listdir(os.path.join(target, "year_month=2020-01")))
    assert L.upsert_partitioned(spark, target, b3, "2024-01-03 00:00:00") == ["2020-04"]
    assert sorted(os.listdir(os.path.join(target, "year_month=2020-01"))) == jan


def test_dimension_upsert_with_collation(spark):
    t1 = L.upsert_dimension(L.empty_table(spark, "categories"),
                            spark.createDataFrame([("cafe",)], "category_name string"),
                            "category_id", "category_name", "2024-01-01 00:00:00")
    src = spark.createDataFrame([("Café ",), ("Tea",)], "category_name string")
    binary = L.upsert_dimension(t1, src, "category_id", "category_name", "2024-01-02 00:00:00")
    assert binary.count() == 3
    ci = L.upsert_dimension(t1, src, "category_id", "category_name", "2024-01-02 00:00:00",
                            collation="UNICODE_CI_AI_RTRIM")
    got = {r["category_name"]: (r["category_id"], r["updated_at"]) for r in ci.collect()}
    assert got == {"cafe": (1, dt.datetime(2024, 1, 2)), "Tea": (2, dt.datetime(2024, 1, 2))}


def test_check_rows_split_and_non_integral(spark, tmp_out):
    import os
    df = spark.createDataFrame([("T1", "C", 1, 1, 1, 2.4, 5.0, dt.date(2020, 1, 1), True),
                                ("T2", None, 1, 1, 1, 2.0, 5.0, dt.date(2020, 1, 1), True)],
                               "transaction_id string, customer_id string, item_id int, payment_method_id int, "
                               "location_id int, quantity double, total_price double, transaction_date date, "
                               "discount_applied boolean")
    p = os.path.join(tmp_out, "checked")
    L.check_rows(df, TABLES["transactions"]).write.partitionBy("_ok").parquet(p)
    checked = spark.read.parquet(p)
    valid = L.valid_part(checked, TABLES["transactions"]).collect()
    rejects = L.reject_part(checked).collect()
    assert [(r["transaction_id"], r["quantity"]) for r in valid] == [("T1", 2)]      # rounded to INT
    assert [(r["transaction_id"], r["reasons"]) for r in rejects] == [("T2", ["null:customer_id"])]
    assert L.non_integral_count(df).first()["non_integral"] == 1


def test_null_dimension_names_reported(spark):
    from salesq.operators import star as N
    df = spark.createDataFrame([("A",), (None,), ("B",), (None,)], "category string")
    assert N.null_names(df, "category").first()["null_names"] == 2
    assert sorted(r["category_name"] for r in N.surrogate_dim(df, "category", "category_id", "category_name")
                  .collect()) == ["A", "B"]


def _fact(spark, rows):
    schema = ("transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
              "quantity double, total_price double, transaction_date date, discount_applied boolean")
    return spark.createDataFrame([(i, "C", 1, 1, 1, q, 5.0, d, True) for i, q, d in rows], schema)


def test_partitioned_upsert_keeps_rows_without_a_date_and_empty_batches(spark, tmp_out):
    import os
    target = os.path.join(tmp_out, "fact")
    assert L.upsert_partitioned(spark, target, _fact(spark, []), "2024-01-01 00:00:00") == []
    L.upsert_partitioned(spark, target, _fact(spark, [("A", 1.0, dt.date(2020, 1, 5))]), "2024-01-01 00:00:00")
    batch = _fact(spark, [("A", 2.0, None), ("B", 1.0, None), ("Z", 1.0, dt.date(2020, 2, 1))])
    assert L.upsert_partitioned(spark, target, batch, "2024-01-02 00:00:00") == ["2020-01", "2020-02", None]
    assert not os.path.exists(os.path.join(target, "year_month=2020-01"))      # A moved out, nothing is left
    assert L.upsert_partitioned(spark, target, _fact(spark, []), "2024-01-03 00:00:00") == []
    got = {r["transaction_id"]: (r["quantity"], r["year_month"]) for r in spark.read.parquet(target).collect()}
    assert got == {"A": (2.0, None), "B": (1.0, None), "Z": (1.0, "2020-02")}
    # only rows without a date remain in a batch: still loaded
    assert L.upsert_partitioned(spark, target, _fact(spark, [("B", 5.0, None)]), "2024-01-04 00:00:00") == [None]
    assert {r["transaction_id"]: r["quantity"] for r in spark.read.parquet(target).collect()}["B"] == 5.0


def test_last_row_wins_by_ordinal(spark):
    src = _fact(spark, [("A", 9.0, dt.date(2020, 1, 1)), ("A", 1.0, dt.date(2020, 1, 2))]).withColumn(
        "line", F.when(F.col("quantity") == 9.0, 1).otherwise(2))
    empty = spark.createDataFrame([], src.drop("line").schema.add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz"))
    assert L.upsert_transactions(empty, src, "2024-01-01 00:00:00").first()["quantity"] == 9.0      # greatest values
    assert L.upsert_transactions(empty, src, "2024-01-01 00:00:00", order_by=["line"]).first()["quantity"] == 1.0


def test_many_new_items_get_unique_dense_ids(spark):
    n = 500_000
    items = spark.range(n).select((F.col("id") + 1).cast("int").alias("item_id"), F.format_string("i%07d", (F.col("id") * 7919) % n).alias("item_name"),
                                  (F.col("id") % 900 / 4).alias("price_per_unit"), (F.col("id") % 50).cast("int").alias("category_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        t = L.upsert_items(L.empty_table(spark, "items"), items, "2024-01-01 00:00:00")
        r = t.agg(F.count(F.lit(1)), F.count_distinct("item_id"), F.min("item_id"), F.max("item_id")).first()
        assert tuple(r) == (n, n, 1, n)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_items_without_category_are_not_added_again(spark):
    src = spark.createDataFrame([(1, "I", 10.0, None)], "item_id int, item_name string, price_per_unit double, category_id int")
    one = L.upsert_items(L.empty_table(spark, "items"), src, "2024-01-01 00:00:00")
    two = L.upsert_items(one, src.withColumn("price_per_unit", F.lit(11.0)), "2024-01-02 00:00:00").collect()
    assert len(two) == 1 and float(two[0]["price_per_unit"]) == 11.0


def test_contract_duplicates_and_key_errors(spark):
    cats = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, None)], "category_id int, category_name string")
    got = {(r["table_name"], r["key_columns"]): (r["duplicates"], r["null_keys"]) for r in L.contract_duplicates({"categories": cats}).collect()}
    assert got == {("categories", "category_id"): (1, 0), ("categories", "category_name"): (1, 1)}
    docs = spark.createDataFrame([("x",), ("x",), (None,)], "_id string")
    summary = L.migration_summary(spark.createDataFrame([("d", 3)], "table_name string, row_count long"),
                                  spark.createDataFrame([("d", 3)], "table_name string, row_count long"), L.key_errors({"d": docs}))
    assert {r["table_name"]: r["errors"] for r in summary.collect()} == {"d": 2, "__total__": 2}


def test_superseded_rows_are_reported_once_each(spark):
    """Brute force on random rows: of each key the greatest stays, all others come back."""
    import collections
    import random
    rng = random.Random(8)
    rows = [(rng.choice(["A", "B", "C", None, *(f"K{k}" for k in range(30))]), float(rng.randrange(3)), rng.choice([None, dt.date(2020, 1, 1)]))
            for _ in range(200)]
    src = _fact(spark, rows)
    winners, gone = L.split_superseded(src, "transaction_id")
    want = {}
    for k, q, d in rows:
        if k is not None:
            want.setdefault(k, []).append((q, d is not None, d))
    stay = {k: max(v, key=lambda x: x[:2]) for k, v in want.items()}
    got = winners.collect()
    assert {r["transaction_id"]: (r["quantity"], r["transaction_date"]) for r in got if r["transaction_id"]} == {k: (v[0], v[2]) for k, v in stay.items()}
    assert sum(r["transaction_id"] is None for r in got) == sum(k is None for k, _, _ in rows) and len(got) == len(stay) + sum(k is None for k, _, _ in rows)
    lost = collections.Counter()
    for r in gone.collect():
        assert r["reasons"] == ["superseded:transaction_id"]
        lost[r["transaction_id"], r["quantity"], r["transaction_date"]] += r["copies"]
    all_rows = collections.Counter((k, q, d) for k, q, d in rows if k is not None)
    assert lost == all_rows - collections.Counter((k, v[0], v[2]) for k, v in stay.items())
    # the last row of the file wins; a key of several columns; a frame of the key alone; no repeats
    lined = _fact(spark, [("A", 9.0, dt.date(2020, 1, 1)), ("A", 1.0, dt.date(2020, 1, 2))]).withColumn("line", 10 - F.col("quantity"))
    winners, gone = L.split_superseded(lined, "transaction_id", ["line"])
    assert winners.first()["quantity"] == 1.0 and gone.first()["quantity"] == 9.0
    two = spark.createDataFrame([("i", 1, 5.0), ("i", 2, 6.0), ("i", 1, 7.0), ("i", None, 1.0), ("i", None, 1.0)], "n string, c int, p double")
    winners, gone = L.split_superseded(two, ["n", "c"], ["p"])
    assert winners.count() == 4 and [tuple(r) for r in gone.select("p", "copies").collect()] == [(5.0, 1)]
    winners, gone = L.split_superseded(spark.createDataFrame([("x",), ("x",), ("x",), ("y",)], "k string"), "k")
    assert sorted(r[0] for r in winners.collect()) == ["x", "y"] and gone.first()["copies"] == 2
    winners, gone = L.split_superseded(two.limit(2), ["n", "c"])
    assert winners.count() == 2 and gone.count() == 0 and "copies" in gone.columns
    assert L.split_superseded(two.limit(0), "n")[1].count() == 0


def test_a_hot_repeated_key_is_counted_before_it_moves(spark):
    hot = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                     (F.col("id") % 5).alias("v"))
    winners, gone = L.split_superseded(hot, "k")
    assert winners.count() == 40_001 and gone.agg(F.sum("copies")).first()[0] == 19_999 and gone.count() == 5


def test_unique_keys_are_not_grouped_with_their_values(spark):
    rows = [(f"T{k}", float(k)) for k in range(20)]
    src = spark.createDataFrame(rows, "transaction_id string, quantity double")
    plan = L.dedupe_latest(src, "transaction_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    more = src.unionByName(spark.createDataFrame([("T3", 1.0), ("T3", 50.0), (None, 9.0)], src.schema))
    got = {r[0]: r[1] for r in L.dedupe_latest(more, "transaction_id").collect()}
    assert len(got) == 20 and got["T3"] == 50.0 and got["T4"] == 4.0 and None not in got


def test_parents_are_searched_by_distinct_keys(spark, monkeypatch):
    from salesq.schema import TABLES
    plain, written = L.cut_lineage, []

    def cut(df, *a, **k):
        out = plain(df, *a, **k)
        written.append(out.count())
        return out
    monkeypatch.setattr(L, "cut_lineage", cut)
    fact = _fact(spark, [(f"T{k}", 1.0, dt.date(2020, 1, 1)) for k in range(10)]).withColumn(
        "customer_id", F.when(F.col("transaction_id") < "T8", F.lit("C")).otherwise(F.lit("lost")))
    customers = spark.createDataFrame([("C",), ("C",), *[(f"X{k}",) for k in range(50)], (None,)], "customer_id string")
    valid, rejects = L.split_valid(fact, TABLES["transactions"], {"customers": customers})
    assert valid.count() == 8 and {tuple(r["reasons"]) for r in rejects.collect()} == {("missing_parent:customer_id",)}
    assert written == [1]                             # the one lost key, not the parent's


def test_merging_by_month_is_the_plain_upsert(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_A_FILE", 3)          # several tasks a month
    old = [(f"T{k}", float(k), None if k % 9 == 0 else dt.date(2020, 1 + k % 4, 5)) for k in range(40)]
    new = [(f"T{k}", float(k + (k % 2)), None if k % 10 == 0 else dt.date(2020, 1 + (k % 4 if k % 3 else k % 5), 5)) for k in range(20, 60)]

    def month(df):
        return df.withColumn("m", F.date_format("transaction_date", "yyyy-MM"))
    target = L.first_transactions(_fact(spark, old), "2024-01-01 00:00:00")
    source = _fact(spark, new)
    a, b = month(target).select("transaction_id", F.col("m").alias("was")), month(source).select("transaction_id", "m")
    moved = a.join(b, "transaction_id").filter(~F.col("was").eqNullSafe(F.col("m")))
    assert moved.count() > 0
    want = L.upsert_transactions(target, source, "2024-01-02 00:00:00")
    got = L.merge_months(month(target), month(source), moved, "m", "2024-01-02 00:00:00")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.filter(~F.col("m").eqNullSafe(F.date_format("transaction_date", "yyyy-MM"))).count() == 0
    assert got.select("m").distinct().count() == 6     # five months, and rows without a date
