"""Cleaning and recovery of the raw sales feed.

The order of the steps is part of the contract. Every step is a column
expression on one flagged frame that keeps *all* raw rows; ``_drop`` holds the
reason a row leaves the clean table, and ``_f_*`` booleans record what each
step did, so the cleaning report is one aggregate over the same pass — no
per-step ``count()`` actions. The only shuffles are the item catalogue
aggregate (C8) and the nearest-match plan (C9).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from salesq.functions.expr import count_if, np_round, safe_div, to_flag
from salesq.operators.nearest import nearest_match
from salesq.session import cut_lineage
from salesq.sources.fixture import ORDINAL, RAW_COLUMNS

# Drop reasons (our codes).
MISSING_KEY = "missing_key"
UNRECOVERABLE = "unrecoverable"
UNMATCHED_ITEM = "unmatched_item"

CRITICAL_COLUMNS = ["transaction_id", "category", "item", "price_per_unit", "quantity", "total_spent"]


def _alive() -> Column:
    return F.col("_drop").isNull()


def _ensure_drop(df: DataFrame) -> DataFrame:
    return df if "_drop" in df.columns else df.withColumn("_drop", F.lit(None).cast("string"))


# ---------------------------------------------------------------- C1 – C3

def drop_missing_keys(df: DataFrame, keys=("transaction_id", "customer_id")) -> DataFrame:
    """Mark rows missing any critical identifier."""
    df = _ensure_drop(df)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.withColumn("_drop", F.when(_alive() & missing, F.lit(MISSING_KEY)).otherwise(F.col("_drop")))


def drop_unrecoverable(df: DataFrame, a: str = "quantity", b: str = "total_spent") -> DataFrame:
    """Mark rows where both quantity and total are missing (after C1)."""
    df = _ensure_drop(df)
    both = F.col(a).isNull() & F.col(b).isNull()
    return df.withColumn("_drop", F.when(_alive() & both, F.lit(UNRECOVERABLE)).otherwise(F.col("_drop")))


def quarantine(flagged: DataFrame, include_unmatched: bool = False) -> DataFrame:
    """The dropped rows with their original values and a reason; the
    has_* flags are set for the unrecoverable rows only. (Steps never change
    a dropped row's values; the two columns whose type changes keep their
    raw text in ``_raw_*``. Unmatched-item rows, optional, show the values
    after recovery.)"""
    reasons = [MISSING_KEY, UNRECOVERABLE] + ([UNMATCHED_ITEM] if include_unmatched else [])
    raw = [F.col(f"_raw_{c}").alias(c) if f"_raw_{c}" in flagged.columns else F.col(c) for c in RAW_COLUMNS]
    unrec = F.col("_drop") == F.lit(UNRECOVERABLE)

    def has(c):
        src = f"_raw_{c}" if f"_raw_{c}" in flagged.columns else c
        return F.when(unrec, F.col(src).isNotNull()).otherwise(F.lit(None).cast(BooleanType()))

    return (flagged.filter(F.col("_drop").isin(*reasons))
            .select(*raw, F.col("_drop").alias("drop_reason"),
                    has("price_per_unit").alias("has_price"),
                    has("item").alias("has_item"),
                    has("category").alias("has_category")))


# ---------------------------------------------------------------- C4 – C7

def standardize_flag(df: DataFrame, col: str = "discount_applied", default: bool = False) -> DataFrame:
    """C4: exact True/False kept; anything else and missing -> ``default``.
    The imputed count is the number of missing values only."""
    is_bool = isinstance(df.schema[col].dataType, BooleanType)
    return (df.withColumn("_f_imputed_" + col, _alive() & F.col(col).isNull())
              .withColumn(col, to_flag(col, default, is_boolean=is_bool)))


def recover_ratio(df: DataFrame, out: str, num: str, den: str, digits: int) -> DataFrame:
    """``out = round(num / den, digits)`` where out is missing, both inputs
    are present and ``den > 0``."""
    mask = _alive() & F.col(out).isNull() & F.col(num).isNotNull() & F.col(den).isNotNull() & (F.col(den) > 0)
    return (df.withColumn("_f_recovered_" + out, mask)
              .withColumn(out, F.when(mask, np_round(safe_div(num, den), digits)).otherwise(F.col(out))))


def recover_product(df: DataFrame, out: str, a: str, b: str, digits: int = 2) -> DataFrame:
    """``out = round(a * b, digits)`` where out is missing and both inputs present."""
    mask = _alive() & F.col(out).isNull() & F.col(a).isNotNull() & F.col(b).isNotNull()
    return (df.withColumn("_f_recovered_" + out, mask)
              .withColumn(out, F.when(mask, np_round(F.col(a) * F.col(b), digits)).otherwise(F.col(out))))


# ---------------------------------------------------------------- C8 – C10

def price_catalog(df: DataFrame, group: str = "category", label: str = "item",
                  value: str = "price_per_unit") -> DataFrame:
    """Mean price per (category, item) over live rows with all three present.
    Cents are summed as integers, so the mean does not depend on the order rows
    are added in, and ties and band edges are the same in every run."""
    live = _alive() if "_drop" in df.columns else F.lit(True)
    cents = F.sum(F.rint(F.col(value) * 100).cast("bigint"))
    return (df.filter(live & F.col(group).isNotNull() & F.col(label).isNotNull() & F.col(value).isNotNull())
              .groupBy(group, label).agg(((cents / F.lit(100.0)) / F.count(value)).alias("mean_price")))


def needs_item(df: DataFrame, group: str = "category", label: str = "item", value: str = "price_per_unit") -> DataFrame:
    """Marks (``_need``) the live rows whose missing item C9 may find."""
    need = _alive() & F.col(label).isNull() & F.col(group).isNotNull() & F.col(value).isNotNull()
    return _ensure_drop(df).withColumn("_need", need)


def infer_nearest(df: DataFrame, catalog: DataFrame, group: str = "category", label: str = "item",
                  value: str = "price_per_unit", tolerance: float = 0.15, buckets: int = 64) -> DataFrame:
    """Fill a missing item with the catalogue item of the same category whose
    mean price is nearest, within ``price * tolerance`` (inclusive).

    The rows that need an item are written, and so is the match table with one row
    per distinct (category, price) probe. Only those rows meet it (a plain join of a
    written side: AQE broadcasts it if its measured bytes are few, else splits a hot
    price); the rest bypass the join and stay a plan over ``df``.
    """
    if "_need" not in df.columns:
        df = needs_item(df, group, label, value)
    lacking = cut_lineage(df.filter(F.col("_need")))
    probes = lacking.select(group, value)
    matches = nearest_match(probes, catalog, key=group, value=value, label=label, mean="mean_price",
                            tolerance=tolerance, buckets=buckets, checkpoint=True)
    matches = cut_lineage(matches.withColumnRenamed(label, "_matched"))
    needy = (lacking.join(matches, [group, value], "left")
             .withColumn("_f_inferred_" + label, F.col("_matched").isNotNull())
             .withColumn(label, F.col("_matched")).drop("_matched"))
    rest = df.filter(~F.col("_need")).withColumn("_f_inferred_" + label, F.lit(False))
    return rest.unionByName(needy).drop("_need")


def drop_unmatched(df: DataFrame, label: str = "item") -> DataFrame:
    """Rows still without an item leave the clean table."""
    df = _ensure_drop(df)
    return df.withColumn("_drop", F.when(_alive() & F.col(label).isNull(), F.lit(UNMATCHED_ITEM))
                         .otherwise(F.col("_drop")))


# ---------------------------------------------------------------- C11 – C13

def standardize_date(df: DataFrame, col: str = "transaction_date") -> DataFrame:
    """C11: parse to DATE; unparseable text becomes NULL and the row stays."""
    if dict(df.dtypes)[col] == "date":
        return df
    return df.withColumn(col, F.to_date(F.try_to_timestamp(F.col(col).cast("string"))))


def enforce_product(df: DataFrame, out: str = "total_spent", a: str = "price_per_unit",
                    b: str = "quantity", tolerance: float = 0.01) -> DataFrame:
    """Rewrite ``out`` to round(a*b, 2) where it is missing or differs by more than
    ``tolerance`` (strict)."""
    calc = np_round(F.col(a) * F.col(b), 2)
    mask = _alive() & F.col(a).isNotNull() & F.col(b).isNotNull() & (
        F.col(out).isNull() | (F.abs(F.col(out) - calc) > F.lit(float(tolerance))))
    return (df.withColumn("_f_rewritten_" + out, mask)
              .withColumn(out, F.when(mask, calc).otherwise(F.col(out))))


def completeness(clean_df: DataFrame, cols=CRITICAL_COLUMNS) -> DataFrame:
    """Missing values per critical column, one row per column (one scan)."""
    agg = clean_df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, missing_count)")


# ---------------------------------------------------------------- C14 – C15

@dataclass
class CleanResult:
    flagged: DataFrame      # every raw row with _drop and _f_* flags
    clean: DataFrame        # the clean table (raw columns, date typed)
    include_unmatched: bool = False

    @property
    def quarantine(self) -> DataFrame:
        return quarantine(self.flagged, self.include_unmatched)

    @property
    def report(self) -> DataFrame:
        return cleaning_report(self.flagged)

    @property
    def completeness(self) -> DataFrame:
        return completeness(self.clean)


def cleaning_report(flagged: DataFrame) -> DataFrame:
    """C14: one-row report from one aggregate over the flagged frame."""
    after_nulls = sum((F.col(c).isNull().cast("int") for c in RAW_COLUMNS), F.lit(0))
    alive = _alive()
    r = flagged.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        count_if(F.col("_drop") == MISSING_KEY).alias("dropped_missing_key"),
        count_if(F.col("_drop") == UNRECOVERABLE).alias("dropped_unrecoverable"),
        count_if(F.col("_drop") == UNMATCHED_ITEM).alias("dropped_unmatched_item"),
        count_if(F.col("_drop").isNotNull()).alias("rows_dropped"),
        count_if(alive).alias("final_rows"),
        count_if(F.col("_f_recovered_price_per_unit")).alias("prices_recovered"),
        count_if(F.col("_f_recovered_quantity")).alias("quantities_recovered"),
        count_if(F.col("_f_recovered_total_spent")).alias("totals_recovered"),
        count_if(F.col("_f_inferred_item")).alias("items_recovered"),
        count_if(F.col("_f_imputed_discount_applied")).alias("discounts_imputed"),
        count_if(F.col("_f_rewritten_total_spent")).alias("totals_rewritten"),
        F.coalesce(F.sum("_nulls_before"), F.lit(0)).cast("bigint").alias("nulls_before"),
        F.coalesce(F.sum(F.when(alive, after_nulls).otherwise(0)), F.lit(0)).cast("bigint").alias("nulls_after"),
    )
    return r.withColumn("retention_pct",
                        np_round(safe_div(F.col("final_rows") * F.lit(100.0), F.col("initial_rows")), 1))


def kept_columns(df: DataFrame) -> list[str]:
    """The clean table's columns: the feed's, and its ordinal if it has one."""
    return [*RAW_COLUMNS, *([ORDINAL] if ORDINAL in df.columns else [])]


TYPE_CHANGING = ("discount_applied", "transaction_date")


def flag_raw(raw: DataFrame) -> DataFrame:
    """Raw columns plus what the report and quarantine need from before the
    steps: the null count of the raw row, and the raw text of the columns
    whose type a step changes. The order of the file's rows (``ORDINAL``), if the
    scan gave it, goes along."""
    nulls = sum((F.col(c).isNull().cast("int") for c in RAW_COLUMNS), F.lit(0))
    return raw.select(*[F.col(c) for c in kept_columns(raw)], nulls.alias("_nulls_before"),
                      *[F.col(c).alias(f"_raw_{c}") for c in TYPE_CHANGING])


def clean(raw: DataFrame, tolerance: float = 0.15, consistency_tolerance: float = 0.01,
          include_unmatched: bool = False, buckets: int = 64) -> CleanResult:
    """C1–C12 composed. Of the feed only the rows that need an item are written here,
    and the nearest-match table of C9 (four small writes): one scan finds those rows,
    one makes the catalogue, and whoever reads the lazy ``flagged`` scans the rest. The
    feed is to be a stored table; a copy of all its rows would cost more than the scans."""
    df = flag_raw(raw).withColumn("_drop", F.lit(None).cast("string"))
    df = drop_missing_keys(df)                                               # C1
    df = drop_unrecoverable(df)                                              # C2
    df = standardize_flag(df, "discount_applied")                            # C4
    df = recover_ratio(df, "price_per_unit", "total_spent", "quantity", 2)   # C5
    df = recover_ratio(df, "quantity", "total_spent", "price_per_unit", 1)   # C6
    df = recover_product(df, "total_spent", "price_per_unit", "quantity", 2) # C7
    catalog = price_catalog(df)                                              # C8
    df = infer_nearest(df, catalog, tolerance=tolerance, buckets=buckets)    # C9
    df = drop_unmatched(df)                                                  # C10
    df = standardize_date(df)                                                # C11
    df = enforce_product(df, tolerance=consistency_tolerance)                # C12
    clean_df = df.filter(_alive()).select(*kept_columns(df))
    return CleanResult(flagged=df, clean=clean_df, include_unmatched=include_unmatched)
