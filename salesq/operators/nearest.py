"""Nearest catalogue entry within a group and a relative tolerance band.

1-D nearest neighbour is either the predecessor (largest mean <= value) or
the successor (smallest mean >= value). Both come from a sort, never from
pairing every probe with every catalogue entry:

* catalogue entries with equal means are first reduced to the smallest label
  (equal distance -> smallest label wins);
* probes and catalogue entries are unioned and windowed per
  ``(group, value bucket)`` ordered by value, so a hot group is split into
  many value ranges and no task holds a whole group;
* probes whose neighbour lies in another bucket take it from a per-bucket
  summary (one row per bucket) carried across buckets with windows in two
  levels (buckets within a group of ``fanout``, then groups);
* the closer of the two wins, ties to the smaller label; the band test
  ``abs(mean - value) <= value * tolerance`` is applied last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesq.session import cut_lineage


def nearest_match(probes: DataFrame, catalog: DataFrame, *, key: str, value: str,
                  label: str, mean: str, tolerance: float = 0.15,
                  buckets: int = 64, checkpoint: bool = False, fanout: int = 1024) -> DataFrame:
    """For each distinct ``(key, value)`` probe, the label of the nearest catalogue
    mean inside ``value * tolerance``. Returns ``(key, value, label)`` for matches.

    Bucket edges are ``buckets`` approximate quantiles of each key's probes and
    means, so a key whose values crowd in a narrow range is spread as well."""
    cat = (catalog.filter(F.col(key).isNotNull() & F.col(mean).isNotNull())
           .groupBy(key, mean).agg(F.min(label).alias(label)))
    pts = (probes.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
           .select(key, value).distinct())

    entry = F.struct(F.col("_v").alias("v"), F.col("_label").alias("label"))
    both = (cat.select(F.col(key), F.col(mean).alias("_v"), F.col(label).alias("_label"),
                       F.lit(1).alias("_is_cat"))
            .unionByName(pts.select(F.col(key), F.col(value).alias("_v"),
                                    F.lit(None).cast("string").alias("_label"),
                                    F.lit(0).alias("_is_cat")))
            .withColumn("_e", F.when(F.col("_is_cat") == 1, entry)))
    if checkpoint:
        # distinct catalogue means + distinct probe values: small next to the
        # input, read several times below -> one written table instead of scans
        both = cut_lineage(both)
    steps = [k / buckets for k in range(1, buckets)]
    edges = both.groupBy(key).agg((F.percentile_approx("_v", steps, 1000) if steps else F.array().cast("array<double>")).alias("_edges"))
    if checkpoint:
        edges = cut_lineage(edges)   # a plain side: AQE can split a hot key's points
    both = (both.join(edges, key)
            .withColumn("_b", F.size(F.filter("_edges", lambda x: x <= F.col("_v"))).cast("bigint")).drop("_edges"))

    # catalogue entry sorts before a probe of equal value -> "last at or before" is <=
    w = Window.partitionBy(key, "_b").orderBy(F.col("_v"), F.col("_is_cat").desc())
    whole = Window.partitionBy(key, "_b")
    windowed = (both
                .withColumn("_pred", F.last("_e", ignorenulls=True).over(
                    w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                .withColumn("_succ", F.first("_e", ignorenulls=True).over(
                    w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
                # bucket extremes from the same partitioning: no second pass over the inputs
                .withColumn("_hi", F.max("_e").over(whole))
                .withColumn("_lo", F.min("_e").over(whole)))
    in_bucket = windowed.filter(F.col("_is_cat") == 0)

    # one row per (key, bucket); neighbours carried across buckets in two
    # levels (within a group of ``fanout`` buckets, then across groups), so no
    # window partition holds all buckets of a category
    summary = (windowed.groupBy(key, "_b").agg(F.first("_hi").alias("_hi"), F.first("_lo").alias("_lo"))
               .withColumn("_sb", F.floor(F.col("_b") / F.lit(int(fanout)))))
    wl = Window.partitionBy(key, "_sb").orderBy("_b")
    local = (summary
             .withColumn("_lp", F.last("_hi", ignorenulls=True).over(wl.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("_ln", F.first("_lo", ignorenulls=True).over(wl.rowsBetween(1, Window.unboundedFollowing))))
    ws = Window.partitionBy(key).orderBy("_sb")
    groups = (summary.groupBy(key, "_sb").agg(F.max("_hi").alias("_ghi"), F.min("_lo").alias("_glo"))
              .withColumn("_sp", F.last("_ghi", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("_sn", F.first("_glo", ignorenulls=True).over(ws.rowsBetween(1, Window.unboundedFollowing)))
              .select(key, "_sb", "_sp", "_sn"))
    carried = (local.join(groups, [key, "_sb"])
               .select(key, "_b", F.coalesce("_lp", "_sp").alias("_prev_hi"),
                       F.coalesce("_ln", "_sn").alias("_next_lo")))

    cand = (in_bucket.join(carried, [key, "_b"], "left")
            .withColumn("_p", F.coalesce("_pred", "_prev_hi"))
            .withColumn("_s", F.coalesce("_succ", "_next_lo")))
    d_p = F.col("_v") - F.col("_p.v")
    d_s = F.col("_s.v") - F.col("_v")
    take_p = F.col("_s").isNull() | (F.col("_p").isNotNull() & (
        (d_p < d_s) | ((d_p == d_s) & (F.col("_p.label") <= F.col("_s.label")))))
    best = cand.withColumn("_best", F.when(take_p, F.col("_p")).otherwise(F.col("_s")))
    in_band = F.abs(F.col("_best.v") - F.col("_v")) <= F.col("_v") * F.lit(float(tolerance))
    return (best.filter(F.col("_best").isNotNull() & in_band)
            .select(F.col(key), F.col("_v").alias(value), F.col("_best.label").alias(label)))
