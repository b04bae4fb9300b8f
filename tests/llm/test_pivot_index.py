import numpy as np
from pyspark.sql import functions as F

from salesq.llm import pivot_index as V


def brute(rows, cosine=0.95):
    good = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for d in {len(rows[k][1]) for k in good}:
        at = [k for k in good if len(rows[k][1]) == d]
        x = np.array([rows[k][1] for k in at], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links[np.ix_(at, at)] = x @ x.T >= cosine
    np.fill_diagonal(links, False)
    label = np.arange(n)
    for _ in range(n):
        new = np.minimum(label, np.where(links, label[None], n).min(1, initial=n))
        if (new == label).all():
            break
        label = new
    groups = {}
    for k in range(n):
        groups.setdefault(label[k], []).append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], int(links[k].sum()), least[label[k]], rows[k][0] == least[label[k]]) for k in range(n)), key=str)


def run(df):
    return sorted(map(tuple, V.near_duplicates(df).collect()), key=str)


def near(rng, x, c):
    z = rng.normal(size=x.shape)
    z -= (z @ x) * x
    return c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z)


def test_odd_rows_and_groups(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 16)  # so that a group spans several blocks
    rng = np.random.default_rng(1)
    rows = []
    for k in range(12):
        x = rng.normal(size=24)
        x /= np.linalg.norm(x)
        rows += [near(rng, x, c).tolist() for c in (1.0, 0.999, 0.97, 0.5)]
    hub = rng.normal(size=24)
    hub /= np.linalg.norm(hub)
    rows += [near(rng, hub, 0.998).tolist() for _ in range(60)] + [hub.tolist()] * 5
    rows += [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0]]
    data = [(k if k != 3 else None, v) for k, v in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("v", F.lit(2))
    assert run(df) == brute(data)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    data = [(2 * k + s, (x if s == 0 else near(rng, x, 0.952)).tolist()) for k, x in enumerate(base) for s in (0, 1)]
    got = run(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    want = brute(data)
    found, present = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= present and found >= 0.97 * present


def test_given_table_and_empty(spark, sf001):
    df = spark.read.parquet(f"{sf001}/embeddings.parquet")
    assert run(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert run(df.limit(0)) == []
