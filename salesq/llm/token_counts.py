"""Token counts through a digest cache.

The cache is a Parquet folder of ``(tokenizer, digest, n_tokens)``: the SHA-256
of the tokenizer's file and library version, and of the normalised content (NULL
read as empty; the model itself normalises nothing else away, so equal bytes are
what makes counts equal). A run joins its documents' digests to the cache, takes
one row of each digest that is missing, encodes those texts alone, appends them,
and joins the counts back. A run that dies before its append leaves the cache as
it was; a digest appended twice by two runs is read once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesq.llm.common import shared_path, written
from salesq.session import path_exists

MODEL, LIMIT = "piece_bpe_32k.model", 4096
_CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
_LOADED: dict = {}


def _tokenizer(path: str):
    """The library's tokenizer, once per Python worker (.model or .json)."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            tk = Tokenizer.from_file(path)
            tk.no_truncation()
            tk.no_padding()
            _LOADED[path] = lambda texts: [len(x.ids) for x in tk.encode_batch(texts, add_special_tokens=False)]
    return _LOADED[path]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and of the library that reads it."""
    import hashlib
    from importlib.metadata import version
    lib = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{lib} {version(lib)}".encode()).hexdigest()


def _encode(path: str, part: int = 4_000_000):
    """Counts of each text; at most about ``part`` characters are encoded together
    (a longer single text goes alone and whole), so memory follows the longest text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _tokenizer(path)
        for b in batches:
            counts, texts, chars = [], [], 0
            for t in b.column("text"):
                texts.append(t.as_py())
                chars += len(texts[-1])
                if chars >= part:
                    counts += count(texts)
                    texts, chars = [], 0
            if texts:
                counts += count(texts)
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    if path_exists(spark, cache):
        return spark.read.schema(_CACHE_SCHEMA).parquet(cache)
    return spark.createDataFrame([], _CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str | None = None, limit: int = LIMIT,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``cache`` names the folder that keeps counts between runs (by default a new
    one under the shared folder). NULL texts count as empty (0 bytes, 0 tokens
    where the library gives none); repeated rows and NULL ids each keep their
    row; an empty table appends and returns nothing. Other columns are not read."""
    spark = docs.sparkSession
    cache = cache or shared_path(spark, "token-cache")
    version = tokenizer_digest(tokenizer_path)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows = written(source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                 digest.alias("digest")), "digests")
    known = read_cache(spark, cache).filter(F.col("tokenizer") == version).select("digest").distinct()
    # NULL ids last: an id that is NULL cannot fetch its text by an ordinary join
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .join(known, "digest", "left_anti"))
    texts = source.withColumn("digest", digest)
    misses = (texts.alias("t").join(first.alias("m"), F.expr("t.digest = m.digest and t.doc_id <=> m.doc_id"))
              .select("t.digest", "t.text"))
    counted = misses.mapInArrow(_encode(tokenizer_path), "digest binary, n_tokens long")
    (counted.dropDuplicates(["digest"]).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache))
    # written: joined as a plain table, so a digest that a third of the rows share is split
    counts = written(read_cache(spark, cache).filter(F.col("tokenizer") == version)
                     .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
