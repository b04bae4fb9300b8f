import random

from salesq.operators.nearest import nearest_match


def _brute(probes, catalog, tol):
    out = {}
    for (k, v) in probes:
        if v is None:
            continue
        cands = [(abs(m - v), lab) for (kk, lab, m) in catalog if kk == k and abs(m - v) <= v * tol]
        if cands:
            out[(k, v)] = min(cands)[1]
    return out


def _run(spark, probes, catalog, tol=0.15, buckets=64, fanout=1024):
    p = spark.createDataFrame(probes, "category string, price double")
    c = spark.createDataFrame(catalog, "category string, item string, mean_price double")
    m = nearest_match(p, c, key="category", value="price", label="item", mean="mean_price",
                      tolerance=tol, buckets=buckets, fanout=fanout)
    return {(r["category"], r["price"]): r["item"] for r in m.collect()}


def test_exact_band_edge_and_ties(spark):
    catalog = [("A", "x", 100.0), ("A", "b", 10.0), ("A", "a", 11.0), ("A", "c", 11.0)]
    probes = [("A", 115.0 / 1.15 * 1.0), ("A", 10.5), ("A", 85.0), ("A", -10.0), ("B", 10.0)]
    got = _run(spark, probes, catalog)
    # 10.5 is equally near 10 (b) and 11 (a, c -> a): smaller label wins
    assert got[("A", 10.5)] == "a"
    assert ("A", -10.0) not in got and ("B", 10.0) not in got
    assert got == _brute(probes, catalog, 0.15)


def test_matches_brute_force_across_buckets(spark):
    rnd = random.Random(7)
    catalog = [(rnd.choice("AB"), f"i{n:03d}", round(rnd.uniform(1, 60), 2)) for n in range(60)]
    probes = list({(rnd.choice("AB"), round(rnd.uniform(0.5, 70), 2)) for _ in range(300)})
    expected = _brute(probes, catalog, 0.15)
    for buckets, fanout in ((64, 1024), (1, 1024), (5, 1024), (64, 3), (200, 2)):
        assert _run(spark, probes, catalog, buckets=buckets, fanout=fanout) == expected


def test_one_narrow_price_range_is_spread(spark):
    from pyspark.sql import functions as F
    both = spark.range(20_000).select(F.lit("A").alias("k"), (5 + F.col("id") / 20_000).alias("v"))
    edges = both.groupBy("k").agg(F.percentile_approx("v", [i / 64 for i in range(1, 64)], 1000).alias("e"))
    sizes = [r[1] for r in both.join(edges, "k").groupBy(F.size(F.filter("e", lambda x: x <= F.col("v")))).count().collect()]
    assert len(sizes) >= 60 and max(sizes) < 600
    probes = [("A", round(5 + i / 1000, 4)) for i in range(0, 1000, 37)]
    catalog = [("A", f"i{i:05d}", 5 + i / 2000) for i in range(2000)]
    assert _run(spark, probes, catalog, tol=0.0001) == _brute(probes, catalog, 0.0001)
