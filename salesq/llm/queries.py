"""The registered queries of this package: ``opN_<name>`` -> ``(spark, sf_dir)``.

Each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesq.llm import (bpe_transducer, html_text, language_id, mixing, perplexity, pivot_index, sentencepieces, simhash,
                        token_alignment, token_counts, toxicity, url_filter, word_runs)
from salesq.llm.common import ship
from salesq.llm.oracle import ORACLE  # noqa: F401
from salesq.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = shipped
    return shipped


@query
def op1_perplexity_quality(spark, sf_dir):
    return perplexity.quality(read_table(spark, sf_dir, "documents"), labels=read_table(spark, sf_dir, "labels"))


@query
def op2_simhash_near_dup(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op3_pivot_near_dup(spark, sf_dir):
    return pivot_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op4_token_counts(spark, sf_dir):
    import public_tokenizers
    cache = spark.conf.get("salesq.tokenCache", None)  # a folder kept between runs, if the user names one
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path(token_counts.MODEL), cache)


@query
def op5_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies")


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op7_sentencepiece(spark, sf_dir):
    import public_tokenizers
    return sentencepieces.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.MODEL))


@query
def op8_html_text(spark, sf_dir):
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query
def op9_url_filter(spark, sf_dir):
    # a page's path ends in the number of the document it was made from, whose quality label marks the page
    pages = read_table(spark, sf_dir, "pages")
    number = F.regexp_extract(url_filter.url_parts(F.col("url"))[1], r"/([0-9]{1,18})[^0-9]*$", 1).try_cast("long")
    labels = read_table(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", (F.col("quality") == 0).alias("reject"))
    marks = pages.select("page_id", number.alias("doc_id")).join(labels, "doc_id").select("page_id", "reject")
    return url_filter.judge(pages, marks).withColumn("purity", F.round("purity", 6))


@query
def op10_language_id(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query
def op11_byte_bpe(spark, sf_dir):
    import public_tokenizers as P
    encoded = bpe_transducer.encode(read_table(spark, sf_dir, "documents"), P.path(bpe_transducer.RANKS), P.PATTERN, decoded=True)
    return bpe_transducer.digests(encoded)


@query
def op12_token_alignment(spark, sf_dir):
    import public_tokenizers as P
    a, b = P.path(token_alignment.A_FILE), P.path(token_alignment.B_FILE)
    return token_alignment.digests(token_alignment.align(read_table(spark, sf_dir, "documents"), a, b), a, b)


@query
def op13_word_runs(spark, sf_dir):
    return word_runs.digests(word_runs.detect(word_runs.with_periodic_tail(read_table(spark, sf_dir, "documents"))))
