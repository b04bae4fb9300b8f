import datetime as dt

from pyspark.sql import functions as F

from salesq.operators import validate as V


def _docs(spark, rows):
    return spark.createDataFrame(rows, "_id string, quantity double, total_price double, transaction_date timestamp_ntz")


def _rel(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, quantity double, total_price double, transaction_date date")


def test_compare_rows_reasons_and_empty_sample(spark):
    rel = _rel(spark, [("A", 1.0, 5.0, dt.date(2020, 1, 1)), ("B", 2.0, 5.0, dt.date(2020, 1, 1)),
                       ("C", 1.0, 5.0, dt.date(2020, 1, 1))])
    docs = _docs(spark, [("A", 1.0, 5.0, dt.datetime(2020, 1, 1)), ("B", 3.0, 5.0, dt.datetime(2020, 1, 1))])
    r = V.compare_rows(rel, docs).first()
    assert (r["checked"], r["missing_count"], r["quantity_mismatches"]) == (3, 1, 1)
    empty = V.compare_rows(rel.limit(0), docs, sample=5).first()
    assert empty["checked"] == 0 and empty["missing_count"] == 0


def test_status_minor_difference_passes_compat_only(spark):
    counts = spark.createDataFrame([("t", 1, 1, True)], "table_name string, relational_count long, "
                                                        "document_count long, match boolean")
    metrics = spark.createDataFrame([(True, True)], "revenue_match boolean, quantity_match boolean")
    dates = spark.createDataFrame([(True, True)], "min_match boolean, max_match boolean")
    spot = spark.createDataFrame([(0, 1, 1)], "missing_count long, mismatch_count long, non_date_mismatches long")
    checks = spark.createDataFrame([(6, 0)], "check_id int, issues long")
    s = V.validation_status(counts, metrics, dates, spot, checks).first()
    assert s["status_compat"] == "PASSED - minor differences"
    assert s["status_strict"] == "FAILED"


def test_checks_with_hot_and_null_keys_match_pandas(spark):
    """One customer holds a third of the rows and a sixth have NULL keys; the
    fused check plan must count exactly what the per-check SQL would."""
    import random
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        r = rnd.random()
        cust = "HOT" if r < 1 / 3 else (None if r < 0.5 else f"C{rnd.randint(0, 60)}")
        tid = None if rnd.random() < 0.02 else f"T{rnd.randint(0, 2800)}"
        rows.append((tid, cust, rnd.randint(0, 12), rnd.randint(0, 4), rnd.randint(0, 3),
                     float(rnd.randint(-1, 3)), float(rnd.choice([0, 5, 10.005, 20000])), dt.date(2020, 1, 1), True))
    fact = spark.createDataFrame(rows, "transaction_id string, customer_id string, item_id int, "
                                       "payment_method_id int, location_id int, quantity double, total_price double, "
                                       "transaction_date date, discount_applied boolean")
    star = {
        "transactions": fact,
        "customers": spark.createDataFrame([("HOT",)] + [(f"C{i}",) for i in range(0, 50)] + [("C1",)],
                                           "customer_id string"),
        "items": spark.createDataFrame([(i, 5.0) for i in range(1, 10)], "item_id int, price_per_unit double"),
        "payment_methods": spark.createDataFrame([(i,) for i in range(1, 4)], "payment_method_id int"),
        "locations": spark.createDataFrame([(i,) for i in range(1, 3)], "location_id int"),
    }
    got = {r["check_id"]: r["issues"] for r in V.run_checks(star, as_of="2022-01-01").collect()}
    pdf = fact.toPandas()
    custs = {f"C{i}" for i in range(50)} | {"HOT"}
    exp = {
        6: int((~pdf.customer_id.isin(custs)).sum()),
        7: int((~pdf.item_id.isin(range(1, 10))).sum()),
        8: int((~pdf.payment_method_id.isin(range(1, 4))).sum()),
        9: int((~pdf.location_id.isin(range(1, 3))).sum()),
        10: int(((pdf.item_id.isin(range(1, 10))) & ((pdf.total_price - 5.0 * pdf.quantity).abs() > 0.01)).sum()),
        16: int(pdf.customer_id.isna().sum()),
        17: int(pdf.transaction_id.isna().sum()),
        21: int(len(pdf) - pdf.transaction_id.nunique()),
        22: 1,
    }
    for k, v in exp.items():
        assert got[k] == v, (k, got[k], v)


def test_rows_without_an_id_are_reported(spark):
    rel = _rel(spark, [(None, 1.0, 5.0, dt.date(2020, 1, 1)), ("A", 1.0, 5.0, dt.date(2020, 1, 1))])
    docs = _docs(spark, [("A", 1.0, 5.0, dt.datetime(2020, 1, 1)), (None, 1.0, 5.0, dt.datetime(2020, 1, 1))])
    r = V.compare_rows(rel, docs).first()
    assert (r["checked"], r["null_ids"], r["missing_count"], r["mismatch_count"]) == (1, 1, 0, 0)


def test_orphan_checks_join_counts_not_rows(spark, monkeypatch):
    """A hot and a NULL key are counted map-side: the join reads one row a key."""
    from pyspark.sql import functions as F
    fact = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.lit("HOT")).when(F.col("id") % 4 == 1, F.lit(None))
                                       .otherwise(F.concat(F.lit("C"), F.col("id") % 100)).alias("customer_id"))
    parents = spark.createDataFrame([("HOT",), ("C3",)], "customer_id string")
    df = V.orphan_count(fact, "customer_id", parents)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join LeftAnti"):]
    assert below.split("\n")[1].strip(" +-:").startswith("Aggregate")
    assert df.first()["_issues"] == 100_000 - 2_000


def test_only_builds_only_what_is_asked(spark):
    from salesq.sources.fixture import damaged_star
    from tests.conftest import SF001
    star = damaged_star(spark, SF001)
    plan = V.run_checks(star, as_of="2002-01-01", only=[11, 12])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 1 and "customer_id" not in plan.split("Relation")[0]


def _stores(spark, n, damage):
    """Rows and documents of ``n`` ids, some with NULLs; ``damage`` changes the documents."""
    import datetime as dt
    rows = [(f"T{k}", None if k % 11 == 0 else k % 7, None if k % 13 == 0 else k / 4, None if k % 17 == 0 else dt.date(2020, 1, 1 + k % 28))
            for k in range(n)]
    rel = spark.createDataFrame(rows, "transaction_id string, quantity int, total_price double, transaction_date date")
    docs = spark.createDataFrame(damage([list(r) for r in rows]), "_id string, quantity int, total_price double, transaction_date date")
    return rel, docs


def test_digests_give_the_same_comparison(spark):
    import datetime as dt

    def damaged(rows):
        rows[3][1] = 99
        rows[5][2] = 12345.0
        rows[8][2] += 0.005                                   # within the tolerance
        rows[9][3] = dt.date(1999, 1, 1)
        rows[11][1], rows[11][2] = 2, None                    # a NULL and a value change places
        rows.append(list(rows[20]))                           # a repeated document, and one of another value
        rows.append([rows[21][0], 1000, 0.0, None])
        rows.append([None, 1, 1.0, None])
        rows.append(["extra", 1, 1.0, None])
        return [r for k, r in enumerate(rows) if k != 15]
    for damage in (damaged, lambda rows: rows, lambda rows: [], lambda rows: rows + [[r[0], 50, 50.0, r[3]] for r in rows[:3]]):
        rel, docs = _stores(spark, 300, damage)
        rel = rel.unionByName(rel.limit(2).withColumn("transaction_id", F.lit(None).cast("string")))
        plain, quick = V.compare_rows(rel, docs).first(), V.compare_rows(rel, docs, digests=True).first()
        assert quick.asDict() == plain.asDict() and quick["null_ids"] == 2 and quick["checked"] == 300
    # repeated ids on both sides, the same rows: equal digests, but not equal answers without the repeated ids
    rel, docs = _stores(spark, 40, lambda rows: rows + [[rows[1][0], 77, 7.0, None]])
    more = rel.unionByName(spark.createDataFrame([("T1", 77, 7.0, None)], rel.schema))
    assert V.compare_rows(more, docs, digests=True).first().asDict() == V.compare_rows(more, docs).first().asDict()


def test_undamaged_stores_are_not_joined_and_half_null_ids_are_no_hot_key(spark):
    rel, docs = _stores(spark, 200, lambda rows: rows)
    assert V.differing_buckets(rel, docs).count() == 0
    assert "Join" not in V.compare_rows(rel, docs, digests=True)._jdf.queryExecution().optimizedPlan().toString()
    half = rel.withColumn("transaction_id", F.when(F.col("quantity") % 2 == 0, F.col("transaction_id")))
    plan = V.row_differences(half, docs)._jdf.queryExecution().optimizedPlan().toString()
    left = plan[plan.index("Join"):].split("\n")[1:]
    assert any("isnotnull(transaction_id" in line for line in left)            # the join's left side holds named rows only
    r = V.compare_rows(half, docs).first()
    assert r["null_ids"] + r["checked"] == 200 and r["null_ids"] > 80 and r["mismatch_count"] == 0


def test_a_sample_meets_its_own_documents_only(spark, monkeypatch):
    rel, docs = _stores(spark, 100, lambda rows: rows)
    plain, seen = V.repeated_documents, []

    def repeated(df, *a):
        seen.append(df.count())
        return plain(df, *a)
    monkeypatch.setattr(V, "repeated_documents", repeated)
    r = V.compare_rows(rel, docs, sample=5).first()
    assert r["checked"] == 5 and r["missing_count"] == r["mismatch_count"] == 0 and seen == [5]


def test_single_documents_are_not_grouped_and_distinct_counts_do_not_multiply_rows(spark):
    rel, docs = _stores(spark, 50, lambda rows: rows)
    plan = V.row_differences(rel, docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    star = {"transactions": spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "customer_id string, item_id int"),
            "items": spark.createDataFrame([(1,), (1,), (None,)], "category_id int")}
    stats = V.distinct_stats(star)
    assert tuple(stats.first()) == (1, 2, 1)
    assert "Expand" not in stats._jdf.queryExecution().optimizedPlan().toString()
