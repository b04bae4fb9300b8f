import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def odd_docs(spark):
    """NULLs in every column, empty and blank texts, one very long text, repeated
    rows, and extra columns whose names clash with those used inside."""
    def make(extra=True):
        long_text = " ".join(f"word{i % 977} runs on" for i in range(30_000))
        rows = [(1, "the quick brown fox jumps over the lazy dog tonight again", "en", "a", 1),
                (1, "the quick brown fox jumps over the lazy dog tonight again", "en", "a", 1),
                (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "en", "b", 4),
                (None, "no id but words enough to count them one by one all right", "en", "b", 3),
                (5, long_text, "en", "a", 5), (6, "ein anderer Text über die Häuser und Gärten der kleinen Stadt", "de", "c", 9),
                (7, "12 34 !!", "de", None, 8), (8, "▁ literal sign ▁▁ and  double  spaces ", "en", "c", 8)]
        df = spark.createDataFrame(rows, DOCS)
        if not extra:
            return df
        from pyspark.sql import functions as F
        for name in ("f", "t", "d", "h", "key", "size", "copies", "dup", "node", "digest", "score", "_score", "_language", "half", "a.b"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
