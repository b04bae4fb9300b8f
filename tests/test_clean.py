from pyspark.sql import functions as F

from salesq.operators import clean as C
from tests.conftest import raw_frame


def _row(tid="T1", cid="C_1", cat="A", item="I1", price=10.0, qty=2.0, total=20.0, disc="True", date="2020-01-01"):
    return (tid, cid, cat, item, price, qty, total, "Cash", "Store", date, disc)


def _by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_key_null_takes_precedence_over_unrecoverable(spark):
    df = raw_frame(spark, [_row(tid="T1", cid=None, qty=None, total=None), _row(tid="T2", qty=None, total=None)])
    q = _by_id(C.clean(df).quarantine)
    assert q["T1"]["drop_reason"] == C.MISSING_KEY and q["T1"]["has_price"] is None
    assert q["T2"]["drop_reason"] == C.UNRECOVERABLE and q["T2"]["has_price"] is True


def test_discount_unmapped_is_false_but_not_imputed(spark):
    df = raw_frame(spark, [_row(tid="T1", disc="yes"), _row(tid="T2", disc=None), _row(tid="T3", disc="False")])
    r = C.clean(df)
    got = _by_id(r.clean)
    assert [got[t]["discount_applied"] for t in ("T1", "T2", "T3")] == [False, False, False]
    assert r.report.first()["discounts_imputed"] == 1


def test_price_recovery_guards(spark):
    df = raw_frame(spark, [
        _row(tid="Q0", price=None, qty=0.0, total=5.0, item="I1"),     # quantity 0 -> price stays NULL
        _row(tid="QN", price=None, qty=None, total=5.0, item="I1"),    # both stay NULL
        _row(tid="OK", price=None, qty=4.0, total=10.0, item="I1"),    # 2.5
    ])
    f = _by_id(C.clean(df).flagged)
    assert f["Q0"]["price_per_unit"] is None
    assert f["QN"]["price_per_unit"] is None and f["QN"]["quantity"] is None
    assert f["OK"]["price_per_unit"] == 2.5


def test_quantity_recovered_to_one_decimal(spark):
    df = raw_frame(spark, [_row(tid="T", price=3.0, qty=None, total=10.0)])
    assert _by_id(C.clean(df).clean)["T"]["quantity"] == 3.3


def test_numpy_rounding_of_total(spark):
    df = raw_frame(spark, [_row(tid="T", price=1.005, qty=1.0, total=None)])
    f = _by_id(C.clean(df).flagged)
    assert f["T"]["total_spent"] == 1.0   # rint(100.49999..)/100, as numpy


def test_consistency_tolerance_is_strict(spark):
    df = raw_frame(spark, [_row(tid="K", price=10.0, qty=1.0, total=10.01),
                           _row(tid="R", price=10.0, qty=1.0, total=10.02)])
    got = _by_id(C.clean(df).clean)
    assert got["K"]["total_spent"] == 10.01
    assert got["R"]["total_spent"] == 10.0


def test_bad_date_becomes_null_and_row_stays(spark):
    df = raw_frame(spark, [_row(tid="T", date="not-a-date")])
    got = _by_id(C.clean(df).clean)
    assert got["T"]["transaction_date"] is None


def test_unmatched_item_dropped_and_optionally_quarantined(spark):
    df = raw_frame(spark, [_row(tid="A", item="I1", price=10.0), _row(tid="B", item=None, price=100.0, total=200.0)])
    r = C.clean(df, include_unmatched=True)
    assert set(_by_id(r.clean)) == {"A"}
    assert _by_id(r.quarantine)["B"]["drop_reason"] == C.UNMATCHED_ITEM
    rep = r.report.first()
    assert rep["dropped_unmatched_item"] == 1 and rep["final_rows"] == 1


def test_completeness_counts(spark):
    df = raw_frame(spark, [_row(tid="T", price=None, qty=None, total=5.0)])
    comp = {r["column_name"]: r["missing_count"] for r in C.clean(df).completeness.collect()}
    # price unrecoverable (quantity missing) but the item is present: row survives with NULLs
    assert comp["price_per_unit"] == 1 and comp["quantity"] == 1


def test_bucket_count_does_not_matter(spark):
    from salesq.sources.fixture import raw_sales
    from tests.conftest import SF001
    raw = raw_sales(spark, SF001)
    a = C.clean(raw).clean
    b = C.clean(raw, buckets=3).clean
    assert a.count() == b.count() == 5640
    assert a.exceptAll(b).count() == 0


def test_catalogue_means_do_not_depend_on_partitions(spark):
    rows = [(f"T{i}", "C_1", "A", f"I{i % 7}", round(0.1 * (i % 13) + 0.07, 2), 1.0, 1.0, "x", "y", None, None) for i in range(4000)]
    df = raw_frame(spark, rows)
    got = [sorted(map(tuple, C.price_catalog(df.repartition(n)).collect())) for n in (1, 7, 200)]
    assert got[0] == got[1] == got[2]


def test_second_clean_query_writes_nothing(spark):
    import os
    import __spark_entry__ as E
    from salesq.session import ensure_checkpoint_dir
    from tests.conftest import SF001
    q = E.queries()
    q["sales_clean"](spark, SF001).count()

    def folders():
        base = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {os.path.join(d, x) for d, names, _ in os.walk(base) for x in names if "salesq" in d}
    before = folders()
    for name in ("sales_clean", "clean_dates", "clean_completeness", "cleaning_report"):
        q[name](spark, SF001).count()
    assert folders() == before


def test_duplicate_rows_are_found_by_digest(spark):
    """Against grouping by all columns: NULLs in different places, zeros of both signs, names with dots."""
    import random
    from salesq.operators import profile as P
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]), rng.choice([None, True]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "`a.b` string, n int, h1 double, row boolean")
    want = 400 - df.groupBy("`a.b`", "n", "h1", "row").count().count()
    assert P.profile_duplicates(df).first()["duplicate_rows"] == want
    assert P.profile_duplicates(df.limit(0)).first()["duplicate_rows"] == 0
    swapped = spark.createDataFrame([(None, 5), (5, None)], "x int, y int")
    assert P.profile_duplicates(swapped).first()["duplicate_rows"] == 0
    got = {tuple(r) for r in P.profile_values(df.withColumnRenamed("a.b", "s"), ["s", "n"]).collect()}
    assert got == {("s", "a"), ("s", "b"), ("s", "nan"), ("n", "1"), ("n", "2"), ("n", "nan")}


def test_sketch_profile_is_one_scan_within_its_bounds(spark, tmp_out):
    import numpy as np
    from salesq.operators import profile as P
    from salesq.sources.fixture import raw_sales
    path = f"{tmp_out}/raw"
    raw_sales(spark, "/root/testdata/sf0.01").write.parquet(path)
    raw = spark.read.parquet(path)
    sketch = P.profile_sketch(raw, rsd=0.02, accuracy=1000)
    plan = sketch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" not in plan       # one scan, no row is multiplied
    got = {r["column_name"]: r for r in sketch.collect()}
    frame = raw.toPandas()
    assert list(got) == raw.columns
    for c, r in got.items():
        exact = frame[c].nunique()
        assert (r["non_null"], r["missing"]) == (frame[c].notna().sum(), frame[c].isna().sum())
        assert abs(r["distinct_approx"] - exact) <= max(2, 5 * 0.02 * exact), c
    for c in ("price_per_unit", "quantity", "total_spent"):
        r, v = got[c], np.sort(frame[c].dropna().to_numpy())
        assert (r["min_value"], r["max_value"]) == (v[0], v[-1]) and abs(r["mean_value"] - v.mean()) < 1e-9 * v.mean()
        for p, q in ((.25, r["q25"]), (.5, r["q50"]), (.75, r["q75"])):
            low, high = np.searchsorted(v, q, "left"), np.searchsorted(v, q, "right")
            assert low - len(v) / 1000 - 1 <= p * len(v) <= high + len(v) / 1000 + 1
    assert got["item"]["q50"] is None
    empty = P.profile_sketch(raw.limit(0), ["item", "quantity"]).collect()
    assert [(r["non_null"], r["distinct_approx"]) for r in empty] == [(0, 0), (0, 0)]


def test_only_rows_that_need_an_item_are_copied(spark, monkeypatch):
    plain, written = C.cut_lineage, []

    def cut(df, *a, **k):
        out = plain(df, *a, **k)
        written.append(out.count())
        return out
    monkeypatch.setattr(C, "cut_lineage", cut)
    rows = [_row(tid=f"T{k}", item=f"I{k % 3}", price=10.0 + k % 3) for k in range(60)]
    r = C.clean(raw_frame(spark, [*rows, _row(tid="N", item=None, price=11.0), _row(tid="U", item=None, price=99.0)]))
    got = _by_id(r.flagged)
    assert len(got) == 62 and got["N"]["item"] == "I1" and got["U"]["_drop"] == C.UNMATCHED_ITEM
    assert sorted(written) == [1, 2]                  # the match, and the two rows without an item


def test_damaged_fact_joins_its_tables_once(spark):
    from salesq.sources.fixture import build_damaged_star
    from tests.conftest import SF001
    fact = build_damaged_star(spark, SF001)["_fact_with_j"]
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    copies = {r["_j"]: r["n"] for r in fact.groupBy("_j", "transaction_id").agg(F.count(F.lit(1)).alias("n")).collect()
              if r["_j"] in (2, 21)}
    assert copies[2] == 2 * copies[21]
