"""Surrogate keys in a global order without funnelling rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesq.session import cut_lineage


def numbered_ranges(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order_cols``, with the range
    (``_pid``) and the place in it (``_mid``) of every row, **written once**.

    Range bounds are sampled and may differ whenever the exchange is planned
    anew (another column set, another job), so everything that depends on the
    numbering must read this one written frame. Without an explicit number AQE
    coalesces neighbouring ranges: a tiny frame is one task, a large one stays
    spread."""
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols)).sortWithinPartitions(*order_cols)
    return cut_lineage(ranged.withColumn("_pid", F.spark_partition_id())
                             .withColumn("_mid", F.monotonically_increasing_id()))


FEW_ROWS = 100_000      # so many rows, counted first, are numbered by one task


def assign_ids(df: DataFrame, order_cols: list[str], id_col: str, start: int = 1,
               num_partitions: int | None = None, few: int = FEW_ROWS) -> DataFrame:
    """Dense ids ``start..start+n-1`` following the order of ``order_cols``.

    ``df`` is written once and counted. At most ``few`` rows are numbered by one
    window; more are range-partitioned and written with their place: the
    per-range row counts (one row per range, bounded by the partition count) and
    the ids are both computed from the written frame, so they always fit each
    other, and no single task sees all rows. ``id_col`` is placed first."""
    others = [c for c in df.columns if c != id_col]
    df = cut_lineage(df)
    if num_partitions is None and df.count() <= few:
        place = F.row_number().over(Window.orderBy(*order_cols)) + F.lit(start - 1)
        return df.select(place.cast("int").alias(id_col), *others)
    numbered = numbered_ranges(df, order_cols, num_partitions)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = (numbered.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
                   .withColumn(id_col, (F.col("_off") + (F.col("_mid") - F.col("_m0")) + F.lit(start)).cast("int")))
    return out.select(id_col, *others)
