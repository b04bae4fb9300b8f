import collections
import math
import random

import numpy as np

from salesq.llm import perplexity as P


def brute_base(text):
    text = text or ""
    spaced = text
    for c in "\t\n\x0b\x0c\r":
        spaced = spaced.replace(c, " ")
    words = [w for w in spaced.split(" ") if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = collections.Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_base_counts_match_brute_force(spark, sf001, odd_docs):
    for docs in (spark.read.parquet(f"{sf001}/documents.parquet"), odd_docs()):
        texts = collections.defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            texts[r.doc_id].append(brute_base(r.text))
        got = collections.defaultdict(list)
        for r in P.quality(docs).collect():
            got[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)
        assert got == texts


def brute_model(lines):
    """Interpolated modified Kneser-Ney over byte 5-grams, straight from the counts."""
    counts = {P.ORDER: collections.Counter()}
    for line in lines:
        s = b" " * (P.ORDER - 1) + line + b" "
        counts[P.ORDER].update(s[i:i + P.ORDER] for i in range(len(s) - P.ORDER + 1))
    for n in range(P.ORDER - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    cuts, totals = {}, {}
    for n, c in counts.items():
        k = collections.Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + k[2] else None
        cuts[n] = [0.0]
        for i, plain in ((1, 0.5), (2, 1.0), (3, 1.5)):
            d = i - (i + 1) * y * k[i + 1] / k[i] if y is not None and k[i] else None
            cuts[n].append(d if d is not None and 0 <= d <= i else plain)
        totals[n] = collections.defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            t = totals[n][g[:-1]]
            t[0] += v
            t[1] += cuts[n][min(v, 3)]

    def p(g):
        if not g:
            return 1 / 256
        n, lower = len(g), p(g[1:])
        if g[:-1] not in totals[n]:
            return lower
        c, cut = totals[n][g[:-1]]
        v = counts[n][g]
        return (v - cuts[n][min(v, 3)] + cut * lower) / c
    return p


def test_perplexity_matches_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    words = ["the", "cat", "sat", "on", "a", "mat", "and", "ran", "far", "away"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(12)), "xx" if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F
    sides = {r[0]: r[1] for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(2))).collect()}
    got = {r.doc_id: r.perplexity for r in P.quality(df.repartition(3)).collect()}
    for lang in ("xx", None):
        for side in (0, 1):
            p = brute_model([t.encode() for i, t, k in docs if k == lang and sides[i] != side])
            for i, t, k in docs:
                if k == lang and sides[i] == side:
                    s = b"    " + t.encode() + b" "
                    want = -sum(math.log(p(s[j:j + 5])) for j in range(len(s) - 4)) / (len(s) - 4)
                    assert abs(math.log(got[i]) - want) < 1e-4


def test_long_text_is_scored_in_parts(monkeypatch):
    line = bytes(np.random.default_rng(0).integers(97, 123, 10_000).astype(np.uint8))
    whole = P.codes(line)
    assert len(whole) == len(line) + 1 and whole[4] == int.from_bytes(line[:5], "big")


def test_junk_is_rejected_and_empty_table(spark, no_docs):
    rng = random.Random(5)
    words = [w + x for w in ("rain", "sun", "wind", "cloud") for x in ("", "y", "ing", "s")]
    good = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(300)]
    junk = [(1000 + i, " ".join("".join(rng.choice("qzxjkvw#$%0123456789") for _ in range(7)) for _ in range(60)), "en") for i in range(5)]
    kept = {r.doc_id for r in P.quality(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")).filter("kept").collect()}
    assert not kept & {i for i, *_ in junk} and len(kept) >= 297
    assert P.quality(no_docs).count() == 0


def test_copies_count_as_one_text(spark):
    rng = random.Random(7)
    words = [w + x for w in ("rain", "sun", "wind", "cloud") for x in ("", "y", "ing", "s")]
    good = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(200)]
    junk = [(1000 + i, " ".join("".join(rng.choice("qzxjkvw#$%0123456789") for _ in range(7)) for _ in range(60)), "en") for i in range(3)]
    copies = [(2000 + i, "a single   notice\nof twelve words that stands on every third page here" if i % 2 else
               "a single notice of twelve words that stands on every third page here", "en") for i in range(100)]
    schema = "doc_id long, text string, lang string"
    once = {r.doc_id: r for r in P.quality(spark.createDataFrame(good + junk + copies[:1], schema)).collect()}
    got = {r.doc_id: r for r in P.quality(spark.createDataFrame(good + junk + copies, schema).repartition(5)).collect()}
    assert len(got) == 303
    for i, r in got.items():  # copies change nothing, and share one verdict
        assert (r.perplexity, r.lower, r.upper, r.kept) == (o := once[min(i, 2000)], (o.perplexity, o.lower, o.upper, o.kept))[1]
    assert not any(got[i].kept for i, *_ in junk)


def test_bands_reject_junk_of_the_given_documents(spark):
    from pyspark.sql import functions as F

    from salesq.llm.common import held_out
    from salesq.llm.queries import QUERIES
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = QUERIES["op1_perplexity_quality"](spark, "/root/testdata/sf0.1").filter("not base_failed").join(labels.filter("quality is not null"), "doc_id")
    got = {(r.lang, r.quality, r.held): (r.rejected, r.n) for r in rows.groupBy("lang", "quality", held_out(F.col("doc_id")).alias("held"))
           .agg(F.sum((~F.col("kept")).cast("int")).alias("rejected"), F.count("*").alias("n")).collect()}
    print(sorted(got.items()))
    junk, good = ([got[k] for k in got if k[1:] == (q, True)] for q in (0, 1))
    assert got["en", 0, True][0] >= 0.4 * got["en", 0, True][1]
    assert sum(r for r, _ in junk) >= 0.3 * sum(n for _, n in junk)
    assert sum(r for r, _ in good) <= 0.08 * sum(n for _, n in good)
