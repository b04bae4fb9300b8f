import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from salesq.llm import token_counts as T

MODEL = public_tokenizers.path(T.MODEL)


def want(rows, count):
    return sorted(((i, len((t or "").encode()), count(t or ""), count(t or "") > T.LIMIT) for i, t in rows), key=str)


def got(df, path=MODEL, **how):
    return sorted(map(tuple, T.token_counts(df, path, **how).collect()), key=str)


def test_counts_are_the_librarys(spark, odd_docs, no_docs, sf001):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for docs in (odd_docs(), spark.read.parquet(f"{sf001}/documents.parquet")):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert got(docs) == want(rows, lambda t: len(sp.encode(t)))
    assert got(no_docs) == []


def test_json_tokenizer(odd_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    docs = odd_docs()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs, path) == want(rows, lambda t: len(tk.encode(t, add_special_tokens=False).ids))


def test_cache_is_appended_and_only_misses_are_encoded(spark, tmp_path):
    cache = f"file://{tmp_path}/cache"
    one = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id long, text string")
    two = spark.createDataFrame([(4, "a b c"), (5, "new text"), (6, "")], "doc_id long, text string")
    got(one, cache=cache)
    assert spark.read.parquet(cache).count() == 2
    # a count in the cache is used as it is: the text isn't encoded again
    version = T.tokenizer_digest(MODEL)
    assert got(two, cache=cache)[0][2] == got(one, cache=cache)[0][2]
    assert spark.read.parquet(cache).count() == 3
    assert spark.read.parquet(cache).select("tokenizer").distinct().collect()[0][0] == version
    got(two, public_tokenizers.path("byte_bpe_50k.json"), cache=cache)
    assert spark.read.parquet(cache).count() == 6  # another tokenizer's counts are its own
