import random

import xxhash
from pyspark.sql import functions as F

from salesq.llm import simhash
from salesq.llm.components import components


def brute_print(text):
    out = text or ""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in out)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    return sorted(((i, f"{p:016x}", ids.get(find(k))) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=str)


def run(df):
    return sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)


def test_matches_brute_force(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert run(docs) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs()
    assert run(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert run(no_docs) == []


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = {b ^ sum(1 << p for p in rng.sample(range(64), k)) for b in base for k in (0, 1, 2, 3, 3, 4)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "f long")).collect()}
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert found == want and want


def test_components_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    groups = got.groupBy("root").agg(F.count("node").alias("n"), F.min("node").alias("least")).collect()
    assert sorted((r.least, r.n) for r in groups) == [(0, 201), (1000, 100)]


def test_keep_one_keeps_one_row_of_each_group(odd_docs):
    docs = odd_docs()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = {brute_print(t) for _, t in given}
    groups = []                     # of prints, joined while any two are near
    for p in prints:
        near = [g for g in groups if any((p ^ q).bit_count() <= 3 for q in g)]
        groups = [g for g in groups if g not in near] + [{p}.union(*near)]
    assert len(rows) == len(groups) and set(rows) <= set(given)
    assert all(sum(brute_print(t) in g for _, t in rows) == 1 for g in groups)
    assert sum(r[0] == 1 for r in rows) == 1 and sum(r[0] in (2, 3, 4) for r in rows) == 1
