"""Profiling of a raw table (P1–P6): one aggregate pass per summary.

Exact quantiles are computed without a global sort in one task: values are
counted per distinct value (a partial aggregate), the distinct values are
range-partitioned and running counts come from per-partition offsets, and
the two order statistics around each requested rank are picked by a filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesq.functions.expr import count_if, row_digest
from salesq.operators.keys import numbered_ranges
from salesq.session import cut_lineage


def profile_shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _unpivot(agg: DataFrame, cols: list[str], value_name: str, extra: dict[str, str] | None = None) -> DataFrame:
    parts = []
    for c in cols:
        e = f"'{c}'"
        if extra:
            e += ", " + ", ".join(f"'{extra[c]}'" for _ in [0])
        parts.append(f"{e}, `{c}`")
    names = "column_name" + (", dtype" if extra else "") + f", {value_name}"
    return agg.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) as ({names})")


def profile_columns(df: DataFrame) -> DataFrame:
    """(column_name, dtype, non_null) from one aggregate."""
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return _unpivot(agg, df.columns, "non_null", extra=dict(df.dtypes))


def profile_missing(df: DataFrame) -> DataFrame:
    """(column_name, missing_count)."""
    agg = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _unpivot(agg, df.columns, "missing_count")


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Rows identical to an earlier row (NULLs compare equal, as grouping does).

    Exact, without moving whole rows: 128-bit digests of the rows are counted
    first, and only rows whose digest repeats are grouped by all their columns, so
    the shuffle of the table carries 16 bytes a row. The digests that repeat are
    written: a plain join side, which AQE broadcasts if its measured bytes are few.
    Zeros of both signs are made one before hashing, as grouping takes them for equal."""
    cols = [F.col(f"`{c}`") + F.lit(0.0).cast(t) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes]
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[
        h.alias(n) for h, n in zip(row_digest(cols), ("h1", "h2"))])
    repeated = cut_lineage(marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"))
    groups = (marked.join(repeated, ["h1", "h2"], "left_semi").select("row.*")
              .groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def profile_values(df: DataFrame, cols: list[str], missing: str = "nan") -> DataFrame:
    """P5: distinct values of selected columns, missing shown as ``missing``; one scan
    for all columns."""
    pairs = ", ".join(f"'{c}', coalesce(CAST(`{c}` AS string), '{missing}')" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, value)").distinct()


def profile_sketch(df: DataFrame, cols: list[str] | None = None, rsd: float = 0.02, accuracy: int = 10_000) -> DataFrame:
    """P2, P3, P5 and P6 in one scan, beside the exact summaries: a row a column with
    ``non_null, missing, distinct_approx`` and, for numbers, ``min_value, max_value,
    mean_value, q25, q50, q75``.

    All are mergeable partial aggregates of bounded size, so nothing but a row a task is
    shuffled. ``distinct_approx`` has the relative standard deviation ``rsd``; the rank
    of a quantile is off by at most the number of values over ``accuracy``."""
    types = dict(df.dtypes)
    rows = []
    for c in cols or df.columns:
        q = F.col(f"`{c}`")
        number = types[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or types[c].startswith("decimal")
        v = q.cast("double") if number else F.lit(None).cast("double")
        quantiles = F.percentile_approx(v, [0.25, 0.5, 0.75], F.lit(accuracy))
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.count(q).alias("non_null"), count_if(q.isNull()).alias("missing"),
            F.approx_count_distinct(q, rsd).alias("distinct_approx"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
            F.avg(v).alias("mean_value"), *[F.get(quantiles, F.lit(k)).alias(n) for k, n in enumerate(("q25", "q50", "q75"))]))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    num_partitions: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default) of several columns, exact.

    One pass for all columns: values are stacked as (column_name, v), counted
    per distinct value (partial aggregate), range-partitioned on
    (column_name, v) and written once; running counts come from in-partition
    windows plus per-partition offsets (one row per partition and column).
    Returns rows (column_name, p, value)."""
    spark = df.sparkSession
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    vals = df.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, v)").filter(F.col("v").isNotNull())
    vc = vals.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("cnt"))
    ranged = numbered_ranges(vc, ["column_name", "v"], num_partitions).drop("_mid")
    within = Window.partitionBy("_pid", "column_name").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("cnt").over(within), F.lit(0)))
    per_part = local.groupBy("column_name", "_pid").agg(F.sum("cnt").alias("_pc"))
    before = Window.partitionBy("column_name").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_part.withColumn("_off", F.coalesce(F.sum("_pc").over(before), F.lit(0))) \
        .select("column_name", "_pid", "_off")
    cum = (local.join(F.broadcast(offs), ["column_name", "_pid"])
           .withColumn("_lo", F.col("_off") + F.col("_local"))          # first 0-based rank of v
           .withColumn("_hi", F.col("_lo") + F.col("cnt") - 1))         # last rank of v
    n = per_part.groupBy("column_name").agg(F.sum("_pc").alias("_n"))
    ps = spark.createDataFrame([(float(p),) for p in probs], "p double")
    pos = n.withColumn("_k", F.lit(1)).join(F.broadcast(ps.withColumn("_k", F.lit(1))), "_k")
    pos = (pos.drop("_k").withColumn("_pos", F.col("p") * (F.col("_n") - 1).cast("double"))
           .withColumn("_r0", F.floor("_pos")).withColumn("_r1", F.ceil("_pos"))
           .withColumn("_frac", F.col("_pos") - F.col("_r0")))
    # the order statistics at ranks r0 and r1: equi-join on the column, range test on the rank
    lo = cum.join(F.broadcast(pos.select("column_name", "p", "_r0")), "column_name") \
        .filter((F.col("_r0") >= F.col("_lo")) & (F.col("_r0") <= F.col("_hi"))).select("column_name", "p", F.col("v").alias("_v0"))
    hi = cum.join(F.broadcast(pos.select("column_name", "p", "_r1")), "column_name") \
        .filter((F.col("_r1") >= F.col("_lo")) & (F.col("_r1") <= F.col("_hi"))).select("column_name", "p", F.col("v").alias("_v1"))
    return (pos.join(lo, ["column_name", "p"], "left").join(hi, ["column_name", "p"], "left")
            .select("column_name", "p", (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias("value")))


def profile_numeric(df: DataFrame, cols: list[str], approx: bool = False, digits: int = 6) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 %, max per numeric column, from
    one aggregate pass plus one quantile plan for all columns.
    ``approx=True`` uses ``percentile_approx`` instead of exact quantiles."""
    from salesq.functions.expr import np_round
    probs = [0.25, 0.5, 0.75]
    stats = ["count", "mean", "std", "min", "max"]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if approx:
            aggs += [F.percentile_approx(x, p, 10000).alias(f"{c}__p{int(p * 100)}") for p in probs]
    one = df.agg(*aggs)
    names = stats + ([f"p{int(p * 100)}" for p in probs] if approx else [])
    parts = ", ".join(f"'{c}', " + ", ".join(f"CAST(`{c}__{m}` AS DOUBLE)" for m in names) for c in cols)
    base = one.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, {', '.join(names)})")
    if not approx:
        q = (exact_quantiles(df, cols, probs).groupBy("column_name")
             .agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in probs]))
        base = base.join(q, "column_name", "left")
    return base.select("column_name", F.col("count").cast("bigint").alias("count"),
                       *[np_round(F.col(m), digits).alias(m) for m in ("mean", "std", "min", "p25", "p50", "p75", "max")])
