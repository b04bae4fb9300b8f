import os

from pyspark.sql import functions as F

from salesq.sources import io as IO
from tests.conftest import SF001


def test_parse_raw_tokens(spark):
    text = spark.createDataFrame([("T1", "C_1", "A", "NaN", "NaN", "2", "", "x", "y", "2020-01-01", "nan")],
                                 ", ".join(f"`{h}` string" for h in IO.CSV_HEADERS))
    r = IO.parse_raw(text).first()
    assert r["item"] is None and r["price_per_unit"] is None and r["total_spent"] is None
    assert r["quantity"] == 2.0 and r["discount_applied"] is None


def test_csv_round_trip(spark, tmp_out):
    from salesq.sources.fixture import raw_sales_text
    p = os.path.join(tmp_out, "raw_csv")
    raw_sales_text(spark, SF001).write.option("header", True).csv(p)
    back = IO.read_raw_sales(spark, p)
    from salesq.sources.fixture import raw_sales
    want = raw_sales(spark, SF001)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_raw_csv_by_header_name_with_quotes_and_commas(spark, tmp_out):
    values = {"Transaction ID": "T1", "Customer ID": "C_1", "Category": 'Food, "fresh"', "Item": 'a ""b"" , c',
              "Price Per Unit": "2.5", "Quantity": "NaN", "Total Spent": "", "Payment Method": "Cash, or card",
              "Location": "NULL", "Transaction Date": "2020-01-01", "Discount Applied": "True"}
    headers = list(reversed(IO.CSV_HEADERS))
    text = spark.createDataFrame([tuple(values[h] for h in headers)], ", ".join(f"`{h}` string" for h in headers))
    r = IO.read_raw_sales(spark, IO.write_raw_csv(text, os.path.join(tmp_out, "q"))).first()
    assert (r["category"], r["item"], r["payment_method"]) == ('Food, "fresh"', 'a ""b"" , c', "Cash, or card")
    assert r["price_per_unit"] == 2.5 and r["quantity"] is None and r["total_spent"] is None and r["location"] is None


def test_star_csv_by_header_name(spark, tmp_out):
    """Headers in another spelling and order, and numbers as the normaliser writes them."""
    frames = {
        "categories": [("CategoryName", "CategoryID"), ("Food", "1")],
        "locations": [("LocationID", "LocationName"), ("1", "Shop")],
        "payment_methods": [("PaymentMethodID", "PaymentMethodName"), ("1", "Cash")],
        "customers": [("CustomerID", "CustomerName"), ("CUST_1", "Customer_1")],
        "items": [("ItemID", "ItemName", "PricePerUnit", "CategoryID"), ("1", "I1", "5.0", "1")],
        "transactions": [("TransactionID", "CustomerID", "ItemID", "PaymentMethodID", "LocationID", "Quantity", "TotalPrice",
                          "TransactionDate", "DiscountApplied"), ("T1", "CUST_1", "1.0", "1", "1", "5.0", "25.5", "2020-02-01", "True")],
    }
    for name, (header, row) in frames.items():
        spark.createDataFrame([row], ", ".join(f"`{h}` string" for h in header)).write.option("header", True).csv(os.path.join(tmp_out, name))
    star = IO.read_star(spark, tmp_out)
    t = star["transactions"].first()
    assert (t["quantity"], t["item_id"], float(t["total_price"]), str(t["transaction_date"]), t["discount_applied"]) == (5, 1, 25.5, "2020-02-01", True)
    assert star["customers"].first()["customer_name"] == "Customer_1" and star["categories"].first()["category_id"] == 1


def test_read_clean_only_forgives_a_missing_snapshot(spark, tmp_out):
    import pytest
    assert IO.read_clean(spark, os.path.join(tmp_out, "none")) is None
    broken = os.path.join(tmp_out, "broken")
    os.makedirs(broken)
    open(os.path.join(broken, "_SUCCESS"), "w").close()
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        IO.read_clean(spark, broken).count()


def test_documents_round_trip(spark, tmp_out):
    import __spark_entry__ as E
    docs = E.queries()["docs_transactions"](spark, SF001)
    p = IO.write_documents(docs, os.path.join(tmp_out, "docs"))
    back = IO.read_documents(spark, p, docs.schema)
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


def test_streaming_upsert_matches_batch(spark, tmp_out):
    import __spark_entry__ as E
    from salesq.operators.load import upsert_transactions
    from salesq.streaming.incremental import latest, load_stream
    fact = E.queries()["fact_transactions"](spark, SF001)
    src = os.path.join(tmp_out, "incoming")
    fact.filter(F.col("transaction_date") < "1997-01-01").write.parquet(os.path.join(src, "b1"))
    fact.write.mode("overwrite").parquet(os.path.join(src, "b2"))
    empty = spark.createDataFrame([], fact.schema.add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz"))
    stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    q = load_stream(stream, os.path.join(tmp_out, "target"), os.path.join(tmp_out, "ckpt"), empty,
                    load_ts="2024-01-01 00:00:00", mode="snapshot")
    q.awaitTermination(300)
    got = latest(spark, os.path.join(tmp_out, "target"))
    batch = upsert_transactions(empty, fact, "2024-01-01 00:00:00")
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0
    # month-partitioned form: same rows in one table
    stream2 = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    q2 = load_stream(stream2, os.path.join(tmp_out, "target_pm"), os.path.join(tmp_out, "ckpt_pm"),
                     load_ts="2024-01-01 00:00:00", mode="partitioned")
    q2.awaitTermination(300)
    pm = spark.read.parquet(os.path.join(tmp_out, "target_pm")).drop("year_month")
    assert pm.exceptAll(batch.select(*pm.columns)).count() == 0
    assert pm.count() == batch.count()      # rows without a date are there too


def test_pipeline_end_to_end_and_rerun(spark, tmp_out):
    from salesq.plans.batch_run import run
    from salesq.sources.fixture import raw_sales
    res = run(spark, raw_sales(spark, SF001), tmp_out, load_ts="2024-01-01 00:00:00", as_of="2002-01-01")
    fact = spark.read.parquet(os.path.join(tmp_out, "relational", "snapshot=v1", "transactions"))
    star_fact = spark.read.parquet(os.path.join(tmp_out, "star", "transactions"))
    # every star fact row is loaded except the ones with a NULL date (NOT NULL contract)
    assert fact.count() == star_fact.filter(F.col("transaction_date").isNotNull()).count() == 5640 - 19
    recon = {r["table_name"]: r["passed"] for r in res.reports["reconcile"].collect()}
    # multi-price items collapse to one row per (name, category): fewer than the star rows
    assert recon["categories"] is True and recon["items"] is False and recon["transactions"] is False
    events = {r["event"]: r["message"] for r in spark.read.parquet(os.path.join(tmp_out, "audit")).collect()}
    assert "RECONCILIATION_SUCCESS" in events and "RECONCILIATION_FAILURE" in events
    assert "MIGRATION_INCOMPLETE" in events and "MIGRATION_COMPLETE" not in events
    assert res.reports["status"].first()["status_compat"] == "PASSED - EXCELLENT"
    sections = {r["section"] for r in res.reports["report"].collect()}
    assert {"relational_counts", "document_counts", "relational_business", "document_statistics", "checks", "counts",
            "metrics", "dates", "rows", "summary", "status"} <= sections
    assert os.path.exists(os.path.join(tmp_out, "validation", "report", "_SUCCESS"))
    from salesq.plans.batch_run import document_stage, validate_stage, LOAD_ORDER
    loaded = {n: spark.read.parquet(os.path.join(tmp_out, "relational", "snapshot=v1", n)) for n in LOAD_ORDER}
    emb = os.path.join(tmp_out, "emb")
    document_stage(spark, loaded, emb, embedded=True)
    tables = validate_stage(spark, loaded, emb, as_of="2002-01-01", embedded=True)
    assert [r["table_name"] for r in tables["counts"].collect()] == ["transactions"]
    assert tables["rows"].first()["missing_count"] == 0 and tables["status"].first()["status_compat"] == "PASSED - EXCELLENT"
    rows = res.reports["rows"].first()
    assert rows["missing_count"] == 0 and rows["mismatch_count"] == 0
    summ = {r["table_name"]: r for r in res.reports["migration_summary"].collect()}
    assert summ["transactions"]["rows_written"] == summ["transactions"]["rows_read"]
    again = run(spark, raw_sales(spark, SF001), tmp_out, load_ts="2024-01-01 00:00:00", snapshot="v2")
    a = spark.read.parquet(os.path.join(tmp_out, "relational", "snapshot=v1", "transactions"))
    b = spark.read.parquet(os.path.join(tmp_out, "relational", "snapshot=v2", "transactions"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert again.paths["out"] == tmp_out


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1
    assert set(E.oracle_sql()) <= set(E.queries())


def test_resume_notices_a_changed_feed(spark, tmp_out):
    from salesq.plans import batch_run as PL
    from salesq.sources.fixture import raw_sales_text
    feed, out = os.path.join(tmp_out, "feed"), os.path.join(tmp_out, "out")
    IO.write_raw_csv(raw_sales_text(spark, SF001).limit(200).coalesce(1), feed)

    def clean(**how):
        return PL.clean_stage(spark, IO.read_raw_sales(spark, feed), out, skip_cleaning=True, **how)

    def made():
        return sorted(os.listdir(os.path.join(out, "clean_flagged", "_live=true")))
    assert "quarantine" in clean().paths                          # nothing to resume from
    star = PL.star_stage(spark, clean().paths["clean"], out)
    before, stars = made(), sorted(os.listdir(os.path.join(out, "star", "items")))
    assert "quarantine" not in clean().paths and made() == before
    PL.star_stage(spark, clean().paths["clean"], out, resume=True)
    assert sorted(os.listdir(os.path.join(out, "star", "items"))) == stars
    assert "quarantine" in clean(include_unmatched=True).paths    # other parameters
    rows = star["transactions"].count()
    IO.write_raw_csv(raw_sales_text(spark, SF001).limit(100).coalesce(1), feed)
    assert "quarantine" in clean().paths and made() != before     # other files
    again = PL.star_stage(spark, clean().paths["clean"], out, resume=True)
    assert 0 < again["transactions"].count() < rows
    # a clean stage that died is not resumed from, though its table is there
    os.remove(os.path.join(out, "_stages", "clean.txt"))
    assert "quarantine" in clean().paths


def test_resume_dry_run_profile_and_audit(spark, tmp_out):
    from salesq.operators import profile as P
    from salesq.plans import batch_run as PL
    from salesq.sources.fixture import raw_sales
    raw = raw_sales(spark, SF001)
    first = PL.clean_stage(spark, raw, tmp_out)
    resumed = PL.clean_stage(spark, raw, tmp_out, skip_cleaning=True)          # S2
    assert resumed.paths["clean"] == first.paths["clean"] and "quarantine" not in resumed.paths
    star = PL.star_stage(spark, first.paths["clean"], tmp_out)
    loaded = PL.load_stage(spark, star, tmp_out, load_ts="2024-01-01 00:00:00")
    audit = spark.read.parquet(os.path.join(tmp_out, "audit"))
    assert audit.filter(F.col("event") == "TABLE_LOADED").count() == 6         # S11
    summary = PL.document_stage(spark, loaded, os.path.join(tmp_out, "dry"), dry_run=True)   # L10
    assert not os.path.exists(os.path.join(tmp_out, "dry", "documents"))
    tot = summary.filter(F.col("table_name") == "__total__").first()
    assert tot["rows_read"] == tot["rows_written"]
    emb = {r["table_name"]: r for r in PL.document_stage(spark, loaded, os.path.join(tmp_out, "emb"),
                                                          embedded=True).collect()}
    assert emb["transactions_with_details"]["rows_lost"] == 0
    assert spark.read.json(os.path.join(tmp_out, "emb", "documents", "transactions_with_details")) \
        .select("item.item_id").count() == emb["transactions_with_details"]["rows_written"]
    paths = IO.write_profile({"missing": P.profile_missing(raw)}, os.path.join(tmp_out, "profile"))   # S10
    assert spark.read.option("header", True).csv(paths["missing"]).count() == 11
    quarantine = spark.read.parquet(first.paths["quarantine"])                  # S6
    assert quarantine.count() == 33 + 298


def _snapshot(spark, path, v, tables=None):
    """All six tables (or the first few: a load that died), categories with one row."""
    from salesq.plans.batch_run import LOAD_ORDER, mark_complete
    for name in LOAD_ORDER[:tables]:
        rows = [(v, f"c{v}", None, None)] if name == "categories" else []
        spark.createDataFrame(rows, IO.TABLES[name].schema).write.parquet(os.path.join(path, name))
    if tables is None:
        mark_complete(spark, path)


def test_a_snapshot_that_died_is_no_base(spark, tmp_out):
    """v1 complete, v2 died after two tables: v3 starts from v1 and loses nothing."""
    import pytest
    import shutil
    from salesq.plans.batch_run import _latest_snapshot, mark_complete
    _snapshot(spark, os.path.join(tmp_out, "snapshot=v1"), 1)
    _snapshot(spark, os.path.join(tmp_out, "snapshot=v2"), 2, tables=2)
    base = _latest_snapshot(spark, tmp_out, before="v3")
    assert len(base) == 6 and base["categories"].first()["category_id"] == 1
    with pytest.raises(RuntimeError):
        mark_complete(spark, os.path.join(tmp_out, "snapshot=v2"))
    shutil.rmtree(os.path.join(tmp_out, "snapshot=v1", "items"))
    with pytest.raises(RuntimeError, match="lost items"):
        _latest_snapshot(spark, tmp_out, before="v3")


def test_a_load_that_dies_is_repaired_by_the_next(spark, tmp_out, monkeypatch):
    import pytest
    from salesq.operators import load as L
    from salesq.plans import batch_run as PL
    from salesq.sources.fixture import raw_sales
    first = PL.clean_stage(spark, raw_sales(spark, SF001), tmp_out)
    star = PL.star_stage(spark, first.paths["clean"], tmp_out)
    v1 = PL.load_stage(spark, star, tmp_out, load_ts="2024-01-01 00:00:00", snapshot="v1")
    with monkeypatch.context() as m:
        m.setattr(L, "upsert_items", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost")))
        with pytest.raises(RuntimeError, match="executor lost"):
            PL.load_stage(spark, star, tmp_out, load_ts="2024-01-02 00:00:00", snapshot="v2")
    v3 = PL.load_stage(spark, star, tmp_out, load_ts="2024-01-03 00:00:00", snapshot="v3")
    for name in PL.LOAD_ORDER:
        assert v3[name].count() == v1[name].count() > 0
        assert v3[name].agg(F.min("created_at")).first()[0] == v1[name].agg(F.min("created_at")).first()[0]
    again = PL.load_stage(spark, star, tmp_out, load_ts="2024-01-02 00:00:00", snapshot="v2")
    assert again["transactions"].exceptAll(v1["transactions"]).count() == 0


def test_run_on_a_csv_follows_the_file(spark, tmp_out):
    """Item ids by first appearance, the last row of a key wins, the others are reported."""
    from salesq.plans.batch_run import run_csv
    from salesq.sources.fixture import RAW_COLUMNS

    def line(t, item, price, q, cat="Food"):
        return (t, "CUST_1", cat, item, str(price), str(q), str(price * q), "Cash", "Shop", "2020-01-05", "True")
    parts = [[line("T9", "zebra", 2.0, 1), line("T1", "apple", 3.0, 2), line("T5", "zebra", 2.5, 1)],
             [line("T2", "mango", 1.0, 1), line("T9", "apple", 3.0, 4), line("T9", "mango", 1.0, 2)]]
    csv = os.path.join(tmp_out, "feed")
    for k, rows in enumerate(parts):
        df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in IO.CSV_HEADERS)).coalesce(1)
        IO.write_raw_csv(df, os.path.join(csv, f"part={k}"))
    assert IO.read_raw_sales(spark, os.path.join(csv, "*")).columns == RAW_COLUMNS
    raw = IO.read_raw_sales(spark, os.path.join(csv, "*"), ordinal=True)
    assert set(raw.columns) == {*RAW_COLUMNS, "row_order"}
    assert [r["item"] for r in raw.orderBy("row_order").collect()] == [r[3] for p in parts for r in p]
    out = os.path.join(tmp_out, "out")
    res = run_csv(spark, os.path.join(csv, "*"), out, load_ts="2024-01-01 00:00:00", as_of="2024-01-01")
    items = {(r["item_name"], r["price_per_unit"]): r["item_id"] for r in spark.read.parquet(os.path.join(out, "star", "items")).collect()}
    assert items == {("zebra", 2.0): 1, ("apple", 3.0): 2, ("zebra", 2.5): 3, ("mango", 1.0): 4}
    fact = {r["transaction_id"]: r for r in spark.read.parquet(os.path.join(out, "relational", "snapshot=v1", "transactions")).collect()}
    assert set(fact) == {"T9", "T1", "T5", "T2"} and fact["T9"]["quantity"] == 2 and "row_order" not in fact["T9"].asDict()
    gone = spark.read.parquet(os.path.join(out, "superseded", "v1", "transactions")).collect()
    assert sorted(r["quantity"] for r in gone) == [1, 4] and all(r["reasons"] == ["superseded:transaction_id"] for r in gone)
    audit = spark.read.parquet(os.path.join(out, "audit")).filter("event = 'SUPERSEDED'").collect()
    assert {r["message"].split(":")[0]: r["message"].split()[1] for r in audit} == {"transactions": "2", "items": "1"}
    assert res.reports["status"].first()["status_compat"].startswith("PASSED")


def test_stream_with_checks_gives_the_batch_loads_facts_and_rejects(spark, tmp_out):
    import datetime as dt
    from salesq.operators import load as L
    from salesq.operators.month_table import fact_table
    from salesq.schema import TABLES
    from salesq.streaming.incremental import load_stream
    schema = ("transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
              "quantity double, total_price double, transaction_date date, discount_applied boolean, line int")
    d = dt.date(2020, 1, 5)
    rows = [("A", "C1", 1, 1, 1, 2.4, 5.0, d, True, 1), ("B", "C9", 1, 1, 1, 1.0, 5.0, d, True, 2), (None, "C1", 1, 1, 1, 1.0, 5.0, d, True, 3),
            ("D", "C1", 7, 1, 1, 1.0, 5.0, None, None, 4), ("E", "C1", 1, 1, 1, 1.0, 1e12, d, True, 5), ("A", "C1", 1, 1, 1, 7.0, 5.0, d, True, 6),
            ("F" * 40, "C1", 1, 1, 1, 1.0, 5.0, d, True, 7), ("G", "C1", 1, 1, 1, None, None, dt.date(2020, 3, 1), None, 8)]
    parents = {"customers": spark.createDataFrame([("C1",)], "customer_id string"), "items": spark.createDataFrame([(1,)], "item_id int"),
               "payment_methods": spark.createDataFrame([(1,)], "payment_method_id int"),
               "locations": spark.createDataFrame([(1,)], "location_id int")}
    src = os.path.join(tmp_out, "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    batch = L.fill_defaults(spark.createDataFrame(rows, schema).drop("line"))
    valid, refused = L.split_valid(batch, TABLES["transactions"], parents=parents)
    target, ck = os.path.join(tmp_out, "fact"), os.path.join(tmp_out, "ck")
    for _ in range(2):          # the second start finds nothing new
        load_stream(spark.readStream.schema(schema).parquet(src), target, ck, load_ts="2024-01-01 00:00:00", mode="versioned",
                    order_by=["line"], parents=parents, buckets=4).awaitTermination(300)
    table = fact_table(spark, target, valid, 4)
    got = {r["transaction_id"]: (r["quantity"], float(r["total_price"]), r["discount_applied"]) for r in table.read().collect()}
    assert got == {"A": (7, 5.0, True), "G": (0, 0.0, False)} and table.versions() == [1]
    rejects = spark.read.parquet(target + "_rejects").collect()
    want = sorted((r["transaction_id"] or "", r["reasons"]) for r in refused.collect()) + [("A", ["superseded:transaction_id"])]
    assert sorted((r["transaction_id"] or "", r["reasons"]) for r in rejects) == sorted(want)
    assert all('"customer_id"' in r["row"] and r["copies"] == 1 for r in rejects)


def test_snapshots_are_ordered_by_number(spark, tmp_out):
    from salesq.plans.batch_run import _latest_snapshot
    for v in (1, 2, 9, 10):
        _snapshot(spark, os.path.join(tmp_out, f"snapshot=v{v}"), v)

    def newest(**how):
        return _latest_snapshot(spark, tmp_out, **how)["categories"].first()["category_id"]
    assert newest(before="v10") == 9 and newest(before="v9") == 2 and newest() == 10
    assert _latest_snapshot(spark, tmp_out, before="v1") is None


def test_stream_modes_agree_and_null_keys_are_rejected(spark, tmp_out):
    import datetime as dt
    from salesq.streaming.incremental import latest, load_stream
    schema = ("transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
              "quantity double, total_price double, transaction_date date, discount_applied boolean")

    def row(i, q, d):
        return (i, "C", 1, 1, 1, q, 5.0, d, True)
    batches = [[row("A", 1.0, dt.date(2020, 1, 5)), row("B", 1.0, None), row(None, 9.0, dt.date(2020, 1, 1)), row("D", 1.0, dt.date(2020, 3, 1))],
               [row("A", 2.0, None), row("B", 2.0, dt.date(2020, 2, 1)), row("E", 1.0, None)],
               [row("D", 3.0, dt.date(2020, 1, 9)), row(None, 1.0, None)], [row(None, 7.0, None)]]
    src = os.path.join(tmp_out, "in")
    for k, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(os.path.join(src, f"b{k}"))
    empty = spark.createDataFrame([], spark.createDataFrame([], schema).schema.add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz"))
    for mode in ("snapshot", "partitioned"):
        for k in range(len(batches)):     # one run a batch: the order is that of the list
            stream = spark.readStream.schema(schema).parquet(os.path.join(src, f"[b][0-{k}]"))
            load_stream(stream, os.path.join(tmp_out, mode), os.path.join(tmp_out, f"ck_{mode}"), empty,
                        load_ts=f"2024-01-0{k + 1} 00:00:00", mode=mode).awaitTermination(300)
    a = latest(spark, os.path.join(tmp_out, "snapshot"))
    p = os.path.join(tmp_out, "partitioned")
    b = spark.read.option("basePath", p).parquet(p)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count() == 4
    got = {r["transaction_id"]: (r["quantity"], str(r["transaction_date"]), r["year_month"]) for r in b.collect()}
    assert got == {"A": (2.0, "None", None), "B": (2.0, "2020-02-01", "2020-02"), "D": (3.0, "2020-01-09", "2020-01"), "E": (1.0, "None", None)}
    rejects = spark.read.parquet(p + "_rejects")
    assert rejects.count() == 3 and rejects.select("reasons").distinct().collect()[0][0] == ["null:transaction_id"]
