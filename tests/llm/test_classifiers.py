import zlib

import numpy as np
from pyspark.sql import functions as F

from salesq.llm import language_id as L
from salesq.llm import toxicity as T


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs()
    rows = L.identify(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4, 7))
    kept = L.accepted(docs)
    assert kept.columns == docs.columns and not {2, 3, 4, 7} & {r.doc_id for r in kept.collect()}
    assert L.identify(no_docs).count() == 0
    unlabelled = L.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_codewords_are_apart():
    for n in (1, 2, 3, 4, 6, 9, 30):
        m = L.codewords(n)
        assert m.shape[0] == n and set(np.unique(m)) <= {-1.0, 1.0}
        if n > 2:
            gaps = [(m[a] != m[b]).sum() for a in range(n) for b in range(a)]
            assert min(gaps) >= (2 if n < 5 else 4)


def test_ambiguous_text_is_flagged():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 40)).astype(np.float32)
    labels = [("a", "b", "c")[k % 3] for k in range(300)]
    x[np.arange(300), [k % 3 for k in range(300)]] += 8
    model = L.fit(x, labels)
    names, p = model.decode(x[:30])
    assert list(names) == labels[:30] and p.min() > 0.5
    middle = np.zeros((1, 40), np.float32)
    assert model.decode(middle)[1][0] < 0.6


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = (T.classify(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
            .filter("held_out").toPandas())
    y, s = rows.toxic.to_numpy(), rows.score.rank().to_numpy()
    auc = (s[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc >= 0.9 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert rows.predicted[y == 0].mean() <= 0.03 and rows.predicted[y == 1].mean() >= 0.65
    for lang, part in rows.groupby("lang"):     # every language, the small ones too
        caught, alarms = (part.predicted[part.toxic == k].mean() for k in (1, 0))
        assert caught >= 0.7 and alarms <= 0.03, lang


def test_pieces_and_their_choice():
    assert T.pieces({"größer".encode(), b"ab"}) == sorted({b"ab", "größer".encode(), "grö".encode(), "größ".encode(), "größe".encode()} - {b""})
    assert T.strongest([b"bomente", b"bomen", b"bomentera", b"idiot", b"idio", b"idiots", b"x"], 3) == [b"bomente", b"idiot", b"x"]
    assert T.strongest([], 3) == []


def test_window_lengths_are_the_compressors(spark):
    """Bytes saved, against compressing every window anew without the memory."""
    import zstandard
    model = T.Model(T._dictionary([b"bomente", b"idiot"]), T._dictionary([b"the", b"and", b"of"]))
    c = T.Compressor(model)
    how = zstandard.ZstdCompressionParameters(
        window_log=14, hash_log=12, chain_log=12, search_log=5, min_match=3, target_length=16, strategy=zstandard.STRATEGY_BTOPT,
        write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)

    def length(dictionary, window):
        d = zstandard.ZstdCompressionDict(dictionary + T._LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=how, dict_data=d).compress(T._LEAD + b" " + window + b" "))
    text = b"the idiots and bomentera of the Bomente-house, idiotic. \xc3\xa9t\xc3\xa9"
    words = T.windows(text)
    saved = [min(max(length(model.ordinary, w) - length(model.toxic, w), 0), T.THRESHOLDS) for w in words]
    counts = c.counts(text)
    assert counts[0] == len(words) and [int(x) for x in counts[1:T.THRESHOLDS + 1]] == [
        sum(s >= k for s in saved) for k in range(1, T.THRESHOLDS + 1)]
    assert max(s for w, s in zip(words, saved) if w.startswith((b"idiot", b"bomente"))) > 2
    assert list(c.counts(None)) == list(c.counts(b"")) == [0] * (2 * T.THRESHOLDS + 1)


def test_toxicity_catches_planted_words_only(spark, no_docs):
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in ("gar", "hou", "riv", "mou", "fie", "roa") for b in ("den", "se", "er", "tain", "ld", "d")]

    def text(n_bad):
        words = list(rng.choice(plain, 40))
        for k in rng.choice(40, n_bad, replace=False):
            words[k] = str(rng.choice(["vilescum", "dunderhead", "nitwitted"]))
        return " ".join(words)
    rows = [(k, text(4 if k % 4 == 0 else 0)) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(1200)] + [(9999, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.classify(docs, labels).collect()}
    assert all(got[k].predicted == int(k % 4 == 0) for k in got if got[k].held_out)
    kept = {r.doc_id for r in T.accepted(docs, labels).collect()}
    assert kept == {k for k in range(1200) if k % 4}
    assert T.classify(no_docs, labels).count() == 0


def test_toxicity_odd_rows(spark, odd_docs):
    docs = odd_docs()
    for labels in ([(1, 1), (5, 0), (6, 0)], [], [(1, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = T.classify(docs, table).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert T.accepted(docs, table).columns == docs.columns


def test_copies_of_a_toxic_text_are_one_witness(spark):
    """Stems with many endings mark toxic texts; many copies of some of them, near ones
    among them, must not put the words of those into the dictionary."""
    rng = np.random.default_rng(7)
    parts = ["gar", "hou", "riv", "mou", "fie", "roa", "den", "se", "er", "tain", "ld", "vo"]

    def text(toxic):
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(60)]
        for k in rng.choice(60, 3 if toxic else 0, replace=False):
            words[k] = str(rng.choice(["zweku", "bl\u00f3n"])) + "".join(rng.choice(parts, 2))
        return " ".join(words)
    texts = [(text(k % 8 == 0), int(k % 8 == 0)) for k in range(1600)]
    shouted = [(t.upper(), 1) for t, y in texts[:80] if y]
    for copied in range(0, 80, 8):
        for _ in range(40):
            words = texts[copied][0].split()
            words[rng.integers(60)] = str(rng.choice(parts))
            texts.append((" ".join(words), 1))
    rows = [(k, t, y) for k, (t, y) in enumerate(texts + shouted)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    marks = {w for w in T.train(docs, labels).toxic.replace(T._LEAD, b" ").split()}
    assert marks and all(w.startswith(("zwek".encode(), "bl\u00f3n".encode())) for w in marks)
    got = {r.doc_id: r for r in T.classify(docs, labels).collect()}
    held = [(got[k].predicted, y) for k, _, y in rows if got[k].held_out and (k < 1600 or k >= len(texts))]
    caught, alarms = (np.mean([p for p, y in held if y == c]) for c in (1, 0))
    assert caught >= 0.95 and alarms <= 0.02
    assert {r.doc_id for r in T.accepted(docs, labels).collect()} == {k for k, r in got.items() if r.predicted == 0}


def test_ordinary_words_like_the_marks_come_first():
    assert T.likest([b"vequ", b"scum", b"zz"], [b"the", b"ve", b"scale", b"very"]) == [b"ve", b"scale", b"the", b"very"]
    assert T.likest([b"vequ"], []) == [] and T.likest([], [b"a", b"b"]) == [b"a", b"b"]


def test_passages_of_pieces():
    words = T.windows("SO \u00dcBELST ist so \u00fcbel. So".encode())
    assert words == ["so".encode(), "\u00fcbelst".encode(), b"ist", b"so", "\u00fcbel".encode(), b"so"]
    found = T.passages(words)
    assert sorted(found) == T.pieces(set(words))
    assert found["\u00fcbel".encode()] == found["\u00fcbelst".encode()] == zlib.crc32(b" ".join(words[:3]))
    assert T.passages([]) == {}
