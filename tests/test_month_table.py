"""Whole-or-nothing publishing of the month-partitioned fact and its key index."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from salesq.operators import load as L
from salesq.operators import month_table as M

SCHEMA = ("transaction_id string, customer_id string, item_id int, payment_method_id int, location_id int, "
          "quantity double, total_price double, transaction_date date, discount_applied boolean")


def fact(spark, rows):
    return spark.createDataFrame([(i, "C", 1, 1, 1, q, 5.0, d, True) for i, q, d in rows], SCHEMA)


def day(m, d=1):
    return dt.date(2020, m, d)


def state(table, number=None):
    return {r["transaction_id"]: (r["quantity"], r["year_month"]) for r in table.read(number).collect()}


def test_upserts_by_month_and_key(spark, tmp_out):
    t = M.fact_table(spark, os.path.join(tmp_out, "fact"), fact(spark, []), buckets=4)
    assert t.upsert(fact(spark, []), "2024-01-01 00:00:00") == [] and state(t) == {}
    assert t.upsert(fact(spark, [("A", 1.0, day(1)), ("B", 1.0, day(2)), ("D", 1.0, day(5)), (None, 1.0, day(7))]),
                    "2024-01-01 00:00:00") == ["2020-01", "2020-02", "2020-05"]
    first = state(t)
    # A loses its date, B moves, C is new
    assert t.upsert(fact(spark, [("A", 2.0, None), ("B", 3.0, day(3)), ("C", 1.0, day(2))]),
                    "2024-01-02 00:00:00") == ["2020-01", "2020-02", "2020-03", None]
    assert state(t) == {"A": (2.0, None), "B": (3.0, "2020-03"), "C": (1.0, "2020-02"), "D": (1.0, "2020-05")}
    assert state(t, 1) == first                                   # the version before is still there
    rows = {r["transaction_id"]: r for r in t.read().collect()}
    assert rows["B"]["created_at"] == dt.datetime(2024, 1, 1) and rows["B"]["updated_at"] == dt.datetime(2024, 1, 2)
    assert rows["D"]["updated_at"] == dt.datetime(2024, 1, 1)
    assert {r["transaction_id"] for r in t.read(months=["2020-03", None]).collect()} == {"A", "B"}
    # the same as the plain upsert of the whole fact
    empty = spark.createDataFrame([], t.schema)
    whole = L.upsert_transactions(empty, fact(spark, [("A", 1.0, day(1)), ("B", 1.0, day(2)), ("D", 1.0, day(5))]), "2024-01-01 00:00:00")
    whole = L.upsert_transactions(whole, fact(spark, [("A", 2.0, None), ("B", 3.0, day(3)), ("C", 1.0, day(2))]), "2024-01-02 00:00:00")
    assert sorted(map(str, t.read().select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("dies", ["first month", "index", "publish"])
def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_out, monkeypatch, dies):
    t = M.fact_table(spark, os.path.join(tmp_out, "fact"), fact(spark, []), buckets=4)
    t.upsert(fact(spark, [("A", 1.0, day(1)), ("B", 1.0, day(2)), ("C", 1.0, day(3))]), "2024-01-01 00:00:00")
    before = state(t)
    batch = fact(spark, [("A", 9.0, day(2)), ("B", 9.0, day(1)), ("C", 9.0, None)])
    plain_store = M.MonthTable._store

    class Died(Exception):
        pass

    def store(self, df, folder, by):
        if dies == "first month" and by == "year_month":
            plain_store(self, df.filter("year_month = '2020-01'"), folder, by)      # one month is there, then it dies
            raise Died
        plain_store(self, df, folder, by)
        if dies == ("rows" if by == "year_month" else "index"):
            raise Died

    def publish(self, version):
        raise Died
    with monkeypatch.context() as m:
        m.setattr(M.MonthTable, "_store", store)
        if dies == "publish":
            m.setattr(M.MonthTable, "_publish", publish)
        with pytest.raises(Died):
            t.upsert(batch, "2024-01-02 00:00:00")
    assert state(t) == before and t.versions() == [1]             # all old rows
    t.upsert(batch, "2024-01-02 00:00:00")                        # a rerun repairs
    assert state(t) == {"A": (9.0, "2020-02"), "B": (9.0, "2020-01"), "C": (9.0, None)}
    left = t.vacuum()
    assert any("0000000002" in d for d in left)                   # what the dead job left behind
    assert state(t) == {"A": (9.0, "2020-02"), "B": (9.0, "2020-01"), "C": (9.0, None)}
    assert t.upsert(fact(spark, [("A", 1.0, day(4))]), "2024-01-03 00:00:00") == ["2020-02", "2020-04"]


def test_second_of_two_writers_fails(spark, tmp_out, monkeypatch):
    t = M.fact_table(spark, os.path.join(tmp_out, "fact"), fact(spark, []), buckets=2)
    t.upsert(fact(spark, [("A", 1.0, day(1))]), "2024-01-01 00:00:00")
    other = M.fact_table(spark, t.path, fact(spark, []), buckets=2)
    plain = M.MonthTable._publish

    def late(self, version):            # the other writer is faster
        monkeypatch.setattr(M.MonthTable, "_publish", plain)
        other.upsert(fact(spark, [("A", 5.0, day(2))]), "2024-01-02 00:00:00")
        plain(self, version)
    monkeypatch.setattr(M.MonthTable, "_publish", late)
    with pytest.raises(M.ConcurrentUpdate):
        t.upsert(fact(spark, [("B", 7.0, day(1))]), "2024-01-02 00:00:00")
    assert state(t) == {"A": (5.0, "2020-02")}
    t.upsert(fact(spark, [("B", 7.0, day(1))]), "2024-01-02 00:00:00")
    assert state(t) == {"A": (5.0, "2020-02"), "B": (7.0, "2020-01")}


def test_a_batch_scans_its_buckets_and_months_only(spark, tmp_out):
    t = M.fact_table(spark, os.path.join(tmp_out, "fact"), fact(spark, []), buckets=32)
    t.upsert(fact(spark, [(f"K{k}", 1.0, day(1 + k % 12)) for k in range(400)]), "2024-01-01 00:00:00")
    batch = fact(spark, [("K0", 2.0, day(6))]).withColumn("year_month", F.lit("2020-06"))
    version = t.version()
    months, buckets = t.plan(batch, version)
    assert months == ["2020-01", "2020-06"] and len(buckets) == 1 and len(version.index) == 32

    def files(df):
        return df.inputFiles()
    assert files(t._index(version, buckets)) and all(f"_bucket={buckets[0]}/" in f for f in files(t._index(version, buckets)))
    read = files(t._rows(version, months))
    assert read and {re.search(r"year_month=([^/]+)", f)[1] for f in read} == set(months)
    t.upsert(batch.drop("year_month"), "2024-01-02 00:00:00")
    after = t.version()
    assert {m for m in after.months if after.months[m] != version.months.get(m)} == set(months)     # others keep their files
    assert {b for b in after.index if after.index[b] != version.index[b]} == set(buckets)
    # the index holds every key once, with the month its row is in
    index = t._index(after, list(after.index))
    rows = t.read()
    assert index.count() == 400
    assert sorted(map(tuple, index.select("transaction_id", "year_month").collect())) == sorted(
        map(tuple, rows.select("transaction_id", "year_month").collect()))


def test_numbered_batches_apply_once(spark, tmp_out):
    t = M.fact_table(spark, os.path.join(tmp_out, "fact"), fact(spark, []), buckets=2)
    b0, b1 = fact(spark, [("A", 1.0, day(1))]), fact(spark, [("A", 2.0, day(1))])
    t.upsert(b0, "2024-01-01 00:00:00", source_name="s", batch=0)
    t.upsert(b1, "2024-01-02 00:00:00", source_name="s", batch=1)
    assert t.upsert(b0, "2024-01-03 00:00:00", source_name="s", batch=0) == []      # a replay changes nothing
    assert state(t)["A"][0] == 2.0 and t.version().applied == {"s": 1}
    t.upsert(b0, "2024-01-03 00:00:00", source_name="other", batch=0)
    assert state(t)["A"][0] == 1.0
    assert len(t.versions()) == 3 and t.vacuum(keep=2) and len(t.versions()) == 2
    assert state(t, 2)["A"][0] == 2.0 and state(t)["A"][0] == 1.0
