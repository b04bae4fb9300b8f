from pyspark.sql import functions as F

from salesq.llm import mixing


def fill(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Brute force: hand the excess on until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, full, out = share * sum(sizes.values()), set(), {}
    while True:
        unit = sum(w[s] for s in names if s not in full)
        free = left - sum(most * sizes[s] for s in full)
        out = {s: most * sizes[s] if s in full else free * w[s] / unit for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    sizes = {r[0]: r[1] for r in docs.select("source", mixing.word_count(F.col("text")).alias("n")).groupBy("source").agg(F.sum("n")).collect()}
    want = fill(sizes)
    assert len(rows) == docs.count()
    for s, n in sizes.items():
        mine = [r for r in rows if r.source == s]
        assert sum(r["size"] for r in mine) == n and all(r.source_size == n for r in mine)
        assert abs(mine[0].target - want[s]) < 1e-6 * want[s]
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.05 * want[s]
        assert all(r.copies in (int(want[s] / n), int(want[s] / n) + 1) and r.taken <= 2 * r["size"] for r in mine)
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_uneven_sources_fill_up(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 300, None: 5}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = fill(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_expectation_is_kept(spark):
    rows = spark.range(20_000).select(F.lit("s").alias("source"), F.col("id").alias("doc_id"),
                                      (F.col("id") % 300 + 1).alias("size"), F.lit(1.3).alias("rate"))
    got = mixing.pivotal_copies(rows).agg(F.avg("copies").alias("m"), F.sum(F.col("copies") * F.col("size")).alias("w"),
                                          F.sum("size").alias("s"), F.min("copies"), F.max("copies")).first()
    assert abs(got.m - 1.3) < 0.02 and abs(got.w - 1.3 * got.s) < 310 and tuple(got)[3:] == (1, 2)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs()
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(r.taken <= 2 * r["size"] for r in rows)
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(1 if r["size"] == 0 else r.copies for r in rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_native_plan(spark, no_docs):
    plan = mixing.mix(no_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
