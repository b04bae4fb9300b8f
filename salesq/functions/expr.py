"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a pandas CSV reader treats as missing by
# default (pandas ``read_csv`` na_values documentation), in that order.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c, digits: int) -> Column:
    """numpy-style round-half-even at ``digits`` decimals: ``rint(x*10^d)/10^d``.

    Spark's ``round`` rounds half up and differs from numpy on values like
    0.125 or 10.345; ``rint`` on the scaled value reproduces numpy exactly.
    """
    scale = float(10 ** digits)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale)


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising under ANSI mode."""
    return F.try_divide(col_(num), col_(den))


def null_if_token(c, tokens=MISSING_TOKENS) -> Column:
    """Map missing-value tokens (after trimming nothing) to NULL."""
    c = col_(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def to_flag(c, default: bool = False, is_boolean: bool = False) -> Column:
    """Exact 'True'/'False' text (or a boolean column) to boolean; else ``default``."""
    c = col_(c)
    if is_boolean:
        return F.coalesce(c, F.lit(default))
    return (F.when(c == F.lit("True"), F.lit(True))
            .when(c == F.lit("False"), F.lit(False))
            .otherwise(F.lit(default)))


def count_if(cond: Column) -> Column:
    """Count of rows where ``cond`` is true; always a bigint (0 when none)."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint"), F.lit(0).cast("bigint"))


def money(c, precision: int = 18) -> Column:
    """Money as an exact decimal with two places."""
    return col_(c).cast(f"decimal({precision},2)")


def row_digest(cols: list) -> list:
    """Two 64-bit hashes of a row's values, NULLs included (a plain hash passes over
    them, so which values are NULL is hashed as well). Equal values have equal hashes."""
    nulls = [c.isNull() for c in cols]
    return [F.xxhash64(*cols, *nulls), F.xxhash64(F.lit(1), *cols, *nulls)]
