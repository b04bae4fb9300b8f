import collections
import hashlib
import random
from functools import reduce

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from salesq.llm import token_alignment as T

A, B = P.path(T.A_FILE), P.path(T.B_FILE)


@pytest.fixture(scope="module")
def al():
    return T.Aligner(A, B)


def brute_tokens(text):
    """(id, bytes) of both tokenizers by their libraries, or None."""
    a_lib, b_lib = brute_tokens.libs
    if not text:
        return None
    signs = T._byte_of_sign()
    a = [(i, bytes(signs[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode())
         for i in b_lib.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def _libs():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


brute_tokens.libs = _libs()


def same(x):
    """A fragment that can be compared."""
    x.links = list(map(int, x.links))
    return x


def ends(tokens):
    out, at = [], 0
    for _, t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute_rows(docs):
    aligned, counts = [], collections.Counter()
    for doc_id, text in docs:
        found = brute_tokens(text)
        if found is None:
            aligned.append((doc_id, 0, 0, [], [], ""))
            continue
        a, b = found
        ends_a, ends_b = ends(a), ends(b)
        both = set(ends_a) & set(ends_b)
        cuts = sorted(both)
        sides = []
        for tokens, at in ((a, ends_a), (b, ends_b)):
            split, now = [], []
            for (i, _), e in zip(tokens, at):
                now.append(str(i))
                if e in both:
                    split.append(",".join(now))
                    now = []
            sides.append(split)
        groups = [f"{x}|{y}" for x, y in zip(*sides)]
        at_a, at_b = dict(zip(ends_a, a)), dict(zip(ends_b, b))
        links = [(at_a[c][0], at_b[c][0]) for c in cuts]
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(d, na, nb, len(g), len(k), sum(counts[x] == most[x[1]] for x in k), sum(counts[x] for x in k), h)
            for d, na, nb, g, k, h in aligned]


def rows_of(docs, monkeypatch=None):
    return sorted(map(str, map(tuple, T.digests(T.align(docs, A, B), A, B).collect())))


def test_fragments_compose_in_any_tree(al):
    rng = random.Random(3)
    words = ["Häuser", "the", "of", "ération", "執筆", "12345", "x\n\ny", "  ", "<s>", "naïve", "\t", "qwzx" * 5]
    for _ in range(60):
        data = (" " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))).encode()
        whole = same(T.finish(al.fragment(data)))
        edges = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(rng.randrange(12)))})
        parts = [al.fragment(data, 0, lo, hi) for lo, hi in zip(edges, edges[1:])]
        while len(parts) > 1:       # any order of composing neighbours
            k = rng.randrange(len(parts) - 1)
            parts[k:k + 2] = [T.compose(parts[k], parts[k + 1], al.n_b)]
        assert same(T.finish(reduce(lambda x, y: T.compose(x, y, al.n_b), [T.Fragment(), *parts, T.Fragment()]))) == whole
        assert (len(whole.links) == whole.groups.count(";") + 1) if whole.ok else (whole.n_a == 0)


def test_divided_ranges_hold_all_tokens(al, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 40)
    rng = random.Random(4)
    for text in ("".join(rng.choice(["word", "Öl", "　 ", "  ", " a", "  x", "  ", ".\n", "執執執 "]) for _ in range(300)),
                 "a" * 500, "x " * 300, "a" * 130 + " b" * 90):
        data = f" {text}".encode()
        ranges = al.divide(data)
        assert ranges[0][0] == 0 and ranges[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        parts = [al.fragment(piece, at, lo, hi) for lo, hi, at, piece in ranges]
        assert same(T.finish(reduce(lambda x, y: T.compose(x, y, al.n_b), parts))) == same(T.finish(al.fragment(data)))
    assert len(al.divide(b" " + b"x " * 300)) > 10 and len(al.divide(b" " + b"a" * 500)) == 1


def test_fast_library_gives_the_files_ids(al):
    assert al.fast is not None
    for lo in range(0, 0x30000, 512):
        signs = [chr(k) for k in range(lo, lo + 512) if not 0xD800 <= k < 0xE000]
        for t in (" " + "".join(signs), " " + " ".join(signs)):
            assert al.fast.encode_ordinary(t) == al.a.encode(t, add_special_tokens=False).ids


def test_rows_on_given_documents(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    assert rows_of(docs) == sorted(map(str, brute_rows([tuple(r) for r in docs.collect()])))


def test_rows_on_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs()           # with a text that several tasks share, and one that B does not give back
    assert max(len(r.text or "") for r in docs.select("text").collect()) > 4 * T.CHUNK
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(docs) == sorted(map(str, brute_rows(plain)))
    assert any(r[1] == 0 for r in brute_rows(plain))
    assert rows_of(no_docs) == []


def test_very_long_text_without_a_place(spark):
    text = "ab" * 60_000 + " " * 60_000 + "end"
    docs = spark.createDataFrame([(1, text), (2, "<|endoftext|> </s> a▁b"), (3, "<|endoftext|> </s> ab")], "doc_id long, text string")
    rows = {r.doc_id: r for r in T.digests(T.align(docs, A, B), A, B).collect()}
    assert rows[1].n_a and rows[1].n_links == rows[1].n_groups and rows[2].n_a == 0 and rows[3].n_a > 5


def test_pairs_are_bounded_by_the_vocabularies(spark, al, sf001):
    pairs = T.align(spark.read.parquet(f"{sf001}/documents.parquet"), A, B).selectExpr("explode(links) link").distinct().collect()
    assert len(pairs) <= al.pair_bound() <= T.BROADCAST_PAIRS
    for (link,) in pairs:
        a, b = al.a_bytes[link // al.n_b], al.b_bytes[link % al.n_b]
        assert a.endswith(b) or b.endswith(a)
