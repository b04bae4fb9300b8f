import hashlib
import random
import zlib

import numpy as np

from salesq.llm import word_runs as W


def brute_runs(words, min_length, min_exponent):
    """Every period, every stretch of words equal to those one period on."""
    number = {}
    ids, out = np.array([number.setdefault(w, len(number)) for w in words], int), []
    for p in range(1, len(ids) // min_exponent + 1):
        same = np.concatenate(([0], ids[p:] == ids[:-p], [0]))
        edges = np.flatnonzero(np.diff(same))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + p
            part = ids[start:start + length]
            if length >= max(min_length, min_exponent * p) and not any((part[q:] == part[:-q]).all() for q in range(1, p)):
                out.append((start, length, p))
    return sorted(out)


def brute_row(doc_id, text):
    """The contract, word for word."""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words, 24, 3)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_lyndon_arrays():
    rng = random.Random(1)
    for _ in range(600):
        a = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(40))]
        for x in (a, [-v for v in a]):
            assert W.lyndon_array(x) == [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) - i for i in range(len(x))]


def test_runs_against_brute_force():
    rng = random.Random(2)
    for _ in range(500):
        a = []
        while len(a) < rng.randrange(1, 120):
            unit = [rng.randrange(rng.choice([2, 4])) for _ in range(rng.randrange(1, 14))]
            a += unit * rng.randrange(1, 7)
            if rng.random() < .3:
                a.pop()
        for length, exponent in ((24, 3), (2, 2), (9, 3), (24, 4), (30, 5)):
            assert W.runs(a, length, exponent) == brute_runs(a, length, exponent)


def test_long_texts_are_walked_over_once():
    for words, n in ((["x"] * 200_000, 1), ([str(k % 7) for k in range(200_000)], 1), (["a", "b"] * 12, 1), (["a"] * 23, 0)):
        found = W.runs(words)
        assert len(found) == n
        assert len(W.collapse(words, found)) == (len(words) if not n else found[0][2])


def test_query_rows(spark, odd_docs, no_docs, sf001):
    periodic = next(k for k in range(100, 1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    more = [(periodic, " ".join(f"w{k}" for k in range(400)), "en", "a", 1), (periodic, "", "en", "a", 1), (periodic, None, None, None, None),
            (9, " x  y\x0bz " * 40, "en", "a", 1)]
    given = spark.read.parquet(f"{sf001}/documents.parquet")
    odd = odd_docs().filter("length(text) < 1000 or text is null")      # the long one is beyond brute force
    for docs in (odd, spark.createDataFrame(more, odd_docs(False).schema), given):
        rows = W.digests(W.detect(W.with_periodic_tail(docs))).collect()
        want = [brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert any(r.n_runs for r in W.digests(W.detect(W.with_periodic_tail(given))).collect())
    assert W.digests(W.detect(W.with_periodic_tail(no_docs))).collect() == []
    longest = W.detect(odd_docs()).orderBy("n_words").collect()[-1]
    assert longest.n_words == 90_000 and [tuple(r) for r in longest.runs] == [(0, 90_000, 3 * 977)]
    found = W.detect(odd).filter("doc_id = 1").first()
    assert found.n_words == 11 and found.runs == [] and found.collapsed.startswith("the quick")
