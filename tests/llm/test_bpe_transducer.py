import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from salesq.llm import bpe_transducer as B
from salesq.llm.common import Memory

PATH = P.path(B.RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_same_ids_as_the_library(library, sf001, spark):
    codec = B.codec(PATH, P.PATTERN)
    rng = random.Random(5)
    odd = ["a", "b", "e", "th", "in", " ", "  ", "\n", "\t", "!", "=", "-", "1", "é", "執", " ", "😀", "'s", "<|endoftext|>"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(300))) for _ in range(400)]
    for lo in range(0, 0x30000, 256):       # every character, in three surroundings
        signs = [chr(k) for k in range(lo, lo + 256) if not 0xD800 <= k < 0xE000]
        texts += ["".join(signs), " ".join(signs), "a".join(signs)]
    texts += [r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    for t in texts:
        assert ids(codec, t) == library.encode_ordinary(t)
        assert codec.decode(ids(codec, t)) == t


def random_ranks(rng, signs):
    """A vocabulary whose merges are in no trained order."""
    ranks = {bytes([b]): b for b in range(256)}
    for _ in range(60):
        a, b = rng.choice(list(ranks)[-40:] + signs), rng.choice(list(ranks)[-40:] + signs)
        if len(a + b) < 9 and set(a + b) <= set(b"".join(signs)):
            ranks.setdefault(a + b, len(ranks))
    order = [t for t in ranks if len(t) > 1]
    rng.shuffle(order)
    return {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(order)}


def plain_merges(ranks, text):
    parts = [text[k:k + 1] for k in range(len(text))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def test_any_order_of_merges_streaming_and_bounded_lookahead(monkeypatch):
    rng = random.Random(11)
    signs = [b"a", b"b", b"c"]
    for round_ in range(40):
        ranks = random_ranks(rng, signs)
        monkeypatch.setattr(B, "STATES", rng.choice([3, 50, 100_000]))     # a table that starts anew gives the same
        t = B.Transducer(ranks)
        longest = max(map(len, ranks))
        for _ in range(40):
            text = b"".join(rng.choice(signs) for _ in range(rng.randrange(1, 60)))
            want = plain_merges(ranks, text)
            assert t.encode(text) == want
            out, state = [], t.start
            for k, byte in enumerate(text):         # what is out is a prefix of the answer, a bounded way behind
                state = t.feed(state, bytes([byte]), out)
                assert out == want[:len(out)]
                behind = k + 1 - sum(len(t.bytes_of[i]) for i in out)
                assert behind <= 6 * longest
    with pytest.raises(ValueError):
        B.Transducer({b"a": 0})


def test_long_matches_without_a_space():
    codec = B.codec(PATH, P.PATTERN)
    for unit, n in (("a", 300_000), (" ", 300_000), ("=", 300_000), ("abcab", 60_000)):
        text = unit * n
        got = ids(codec, text)
        assert codec.decode(got) == text and got[:20] == ids(codec, unit * (n // 100))[:20]


def test_decode_holds_back_incomplete_characters(monkeypatch):
    codec = B.codec(PATH, P.PATTERN)
    single = B.read_ranks(PATH)
    text = "é執😀a"
    one_by_one = [single[bytes([b])] for b in text.encode()]
    monkeypatch.setattr(B, "DECODED", 1)            # every byte comes alone
    pieces = list(codec.decode_stream(np.array(one_by_one)))
    assert "".join(pieces) == text and "é" in pieces and "�" not in "".join(pieces)
    assert codec.decode(one_by_one[:-2]) == "é執�"
    assert codec.decode([]) == ""


def test_memory_keeps_what_is_in_use():
    made = []
    m = Memory(lambda k: made.append(k) or k.upper(), 3, 5)
    for k in ["hot", "a", "hot", "b", "hot", "c", "hot", "d", "hot", "e", "hot", "too long", "too long"]:
        assert m[k] == k.upper()
    assert made.count("hot") == 1 and made.count("too long") == 2 and len(m) <= 3 and len(m.old) <= 3


def test_query_rows_on_odd_documents(spark, odd_docs, no_docs, library):
    docs = odd_docs()
    encoded = B.encode(docs, PATH, P.PATTERN, decoded=True)
    rows = B.digests(encoded).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        t = r.text or ""
        i = library.encode_ordinary(t)
        want.append((r.doc_id or -1, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)
    plain = B.decode(B.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert plain.columns == ["doc_id", "ids", "decoded"]
    assert sorted(r.decoded for r in plain.collect()) == sorted(r.text or "" for r in docs.select("text").collect())
    assert B.decode(encoded.select(F.lit(None).cast("array<int>").alias("ids")), PATH, P.PATTERN).first().decoded is None
    assert B.digests(B.encode(no_docs, PATH, P.PATTERN, decoded=True)).collect() == []
