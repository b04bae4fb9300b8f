"""Sources and sinks (S1–S11): CSV/parquet/JSON readers and writers."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesq.functions.expr import MISSING_TOKENS
from salesq.schema import TABLES
from salesq.session import path_exists
from salesq.sources.fixture import CSV_HEADERS, ORDINAL, RAW_COLUMNS

NUMERIC_RAW = ("price_per_unit", "quantity", "total_spent")


def parse_raw(text_df: DataFrame, tokens=MISSING_TOKENS, keep: list[str] | None = None) -> DataFrame:
    """S1 (parse half): CSV headers -> snake_case, missing tokens -> NULL,
    numeric columns ``try_cast`` to double (the text ``NaN`` becomes NULL, not NaN).
    Columns of ``keep`` stay as they are."""
    rename = dict(zip(CSV_HEADERS, RAW_COLUMNS))
    cols = [F.col(c) for c in keep or []]
    for h in text_df.columns:
        if h in (keep or []):
            continue
        name = rename.get(h, h.strip().lower().replace(" ", "_"))
        c = F.col(f"`{h}`").cast("string")
        c = F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)
        if name in NUMERIC_RAW:
            c = F.expr(f"try_cast(`{h}` AS double)")
            c = F.when(F.col(f"`{h}`").isin(*tokens) | F.isnan(c), F.lit(None).cast("double")).otherwise(c)
        cols.append(c.alias(name))
    return text_df.select(*cols)


def _read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text under its header's name (no
    inference pass); quotes inside quoted fields are doubled."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)


def read_raw_sales(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    """Scan the raw CSV as text, find the columns by header name in any order,
    and parse. A missing column is an error.

    ``ordinal`` adds ``row_order``, which sorts the rows as the files hold them: file
    name, start of the block that was read, place in it. It comes from the scan alone,
    block by block, so a splittable file is still read by many tasks; it is the same
    in every run over the same files, however they are split into tasks, up to the
    block starts, which sort alike."""
    text = _read_text_csv(spark, path)
    columns = [F.col(f"`{h}`") for h in CSV_HEADERS]
    if not ordinal:
        return parse_raw(text.select(*columns))
    # rows of a block are read in order by one task, so its running number orders them
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("place"))
    placed = text.select(*columns, order.alias(ORDINAL))
    return parse_raw(placed, keep=[ORDINAL])


def write_raw_csv(text_df: DataFrame, path: str) -> str:
    """The raw feed as the CSV it comes as (header, doubled quotes)."""
    text_df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def read_clean(spark: SparkSession, path: str) -> DataFrame | None:
    """Resume from a clean snapshot if a finished one is there (its folder or
    the one above has ``_SUCCESS``); any other trouble in reading it rises."""
    done = [os.path.join(p, "_SUCCESS") for p in (path, os.path.dirname(path.rstrip("/")))]
    if not any(path_exists(spark, p) for p in done) or not path_exists(spark, path):
        return None
    return spark.read.parquet(path)


def _snake(header: str) -> str:
    """``CategoryID`` and ``Category ID`` -> ``category_id``; ``category_id`` stays."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", header.strip()).replace(" ", "_").lower()


def conform_text(df: DataFrame, spec) -> DataFrame:
    """Text columns named by header -> the contract's types (L6's rules: whole
    numbers rounded half-even, what does not fit becomes NULL); other columns stay text."""
    types = {f.name: f.dataType for f in spec.schema.fields}
    cols = []
    for h in df.columns:
        name = _snake(h)
        kind = types.get(name, T.StringType())
        if isinstance(kind, T.IntegerType):
            c = F.expr(f"try_cast(rint(try_cast(`{h}` AS double)) AS int)")
        else:
            c = F.expr(f"try_cast(`{h}` AS {kind.simpleString()})")
        cols.append(c.alias(name))
    return df.select(*cols)


def read_star(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The six star tables. CSV columns are found by header name and
    conformed to the contract's types; no inference pass."""
    out = {}
    for name, spec in TABLES.items():
        p = os.path.join(directory, name)
        out[name] = conform_text(_read_text_csv(spark, p), spec) if fmt == "csv" else spark.read.parquet(p)
    return out


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Write a table (overwrite = clean slate, L9)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    getattr(w, fmt)(path) if fmt != "csv" else w.option("header", True).option("escape", '"').csv(path)
    return path


def write_star(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> dict[str, str]:
    """Six tables; the fact is partitioned by year-month of its date so later
    date filters prune files."""
    paths = {}
    for name, df in tables.items():
        p = os.path.join(directory, name)
        if name == "transactions" and fmt == "parquet" and "transaction_date" in df.columns:
            # REBALANCE by the partition column: few files per month, hot months split by AQE
            df = (df.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))
                  .hint("rebalance", "year_month"))
            write_table(df, p, partition_by=["year_month"])
        else:
            write_table(df, p, fmt=fmt)
        paths[name] = p
    return paths


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Documents as JSON lines, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def write_documents_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """The number of documents comes from the write itself, so nothing
    is read back to be counted."""
    seen = Observation()
    write_documents(df.observe(seen, F.count(F.lit(1)).alias("n")), path, mode)
    return seen.get["n"]


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_profile(results: dict[str, DataFrame], directory: str) -> dict[str, str]:
    """Each profile result as CSV. AQE sizes the files: a summary of a few rows
    is one, distinct values of a wide column are as many as they need."""
    out = {}
    for name, df in results.items():
        p = os.path.join(directory, name)
        df.hint("rebalance").write.mode("overwrite").option("header", True).csv(p)
        out[name] = p
    return out
