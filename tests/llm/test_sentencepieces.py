import random
import re

import public_tokenizers
import sentencepiece

from salesq.llm import sentencepieces as S
from salesq.llm.token_counts import MODEL

PATH = public_tokenizers.path(MODEL)


def brute_score(codec, text):
    """Best total score over the whole text at once, trying every piece everywhere."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            pieces[sp.id_to_piece(i)] = sp.get_score(i)
    s = ("▁" + text.replace(" ", "▁"))
    best = [0.0] + [float("-inf")] * len(s)
    for end in range(1, len(s) + 1):
        best[end] = best[end - 1] + codec.worst
        for start in range(max(0, end - 20), end):
            if s[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[s[start:end]])
    return best[-1], pieces, sp


def test_best_score_and_round_trip():
    codec = S.codec(PATH)
    rng = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyz     ,.\nABCéüñ執①\t_²13$-"
    for k in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80)))
        ids = __import__("numpy").frombuffer(codec.encode(text), "int32").tolist()
        assert codec.decode(ids) == text
        want, pieces, sp = brute_score(codec, text)
        score, byte = 0.0, b""
        for i in ids:
            if sp.is_byte(i):
                byte += bytes([int(sp.id_to_piece(i)[3:5], 16)])
                try:
                    byte.decode()
                    score, byte = score + codec.worst, b""
                except UnicodeDecodeError:
                    pass
            else:
                score += pieces[sp.id_to_piece(i)]
        assert abs(score - want) <= 1e-9 * abs(want) + 1e-6, text


def test_finer_chunks_and_a_small_memory_change_nothing(spark, sf001, monkeypatch):
    fine, coarse = S.Codec(PATH), S.Codec(PATH)
    coarse.fine = coarse.chunks
    monkeypatch.setattr(S, "MEMORY", 7)
    small = S.Codec(PATH)
    assert len(fine.mixed) < 10         # pieces that go from letters to other signs
    texts = [r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").limit(60).collect()]
    for t in [*texts, "x². y² .z ² a_b__c -> 12ab3", *(f"a{p}b {p}" for p in fine.mixed)]:
        assert fine.encode(t) == coarse.encode(t) == small.encode(t)
        assert b"".join(d for _, d in fine.parts(t)) == b" " + t.encode()
    assert len(small.memory) <= 7 and len(small.memory.old) <= 7


def test_odd_rows_and_decode(spark, odd_docs, no_docs, sf001):
    for docs in (odd_docs(), spark.read.parquet(f"{sf001}/documents.parquet")):
        out = S.decode(S.encode(docs, PATH), PATH)
        rows = out.collect()
        assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
        assert sorted((r.doc_id or -1, r.decoded) for r in rows) == sorted((r.doc_id or -1, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert S.encode(no_docs, PATH).count() == 0


def test_chunk_cut_is_checked():
    assert not any(re.search(r"[^▁]▁", p) for p in map(sentencepiece.SentencePieceProcessor(model_file=PATH).id_to_piece, range(32000)))
