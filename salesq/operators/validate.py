"""Statistics, integrity/business checks and cross-store comparison.

Row counters over the fact are one aggregate of one scan; orphan checks count
their key first and join the few keys; V10 joins the fact's price columns to the
items. Results are small long-format tables (one row per check), unioned — never
collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesq.functions.expr import count_if, np_round, row_digest
from salesq.session import cut_lineage

DIGEST_BUCKETS = 4096       # of ids, when two stores are compared by digests (V31)
STAR_TABLES = ["categories", "locations", "payment_methods", "customers", "items", "transactions"]

# Check ids/names (ours) for the 17 counted checks, in order. The
# limits in ``run_checks`` and the status texts in ``validation_status`` are fixed too.
CHECKS = [
    (6, "orphan_customers", "foreign_key"),
    (7, "orphan_items", "foreign_key"),
    (8, "orphan_payment_methods", "foreign_key"),
    (9, "orphan_locations", "foreign_key"),
    (10, "price_calculation_errors", "business_rule"),
    (11, "non_positive_quantity", "business_rule"),
    (12, "non_positive_total", "business_rule"),
    (13, "future_dates", "business_rule"),
    (14, "extreme_quantity", "business_rule"),
    (15, "extreme_total", "business_rule"),
    (16, "null_customer_ids", "type_range"),
    (17, "null_transaction_ids", "type_range"),
    (18, "long_customer_ids", "type_range"),
    (19, "long_transaction_ids", "type_range"),
    (20, "precision_violations", "type_range"),
    (21, "duplicate_transactions", "duplicate"),
    (22, "duplicate_customers", "duplicate"),
]


def _lit_date(d) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def _stack(agg: DataFrame, ids: list[int]) -> DataFrame:
    """One-row aggregate with columns ``c<id>`` -> rows (check_id, check_name, check_group, issues)."""
    meta = {i: (n, g) for i, n, g in CHECKS}
    parts = ", ".join(f"{i}, '{meta[i][0]}', '{meta[i][1]}', c{i}" for i in ids)
    return agg.selectExpr(f"stack({len(ids)}, {parts}) as (check_id, check_name, check_group, issues)")


# ------------------------------------------------------------------ V1–V4

def row_counts(tables: dict[str, DataFrame], names=STAR_TABLES) -> DataFrame:
    """One row per table (a union of counts)."""
    out = None
    for n in names:
        part = tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def date_range(fact: DataFrame, col: str = "transaction_date") -> DataFrame:
    """V2."""
    return fact.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def distinct_stats(star: dict[str, DataFrame], approx: bool = False) -> DataFrame:
    """V3: distinct customers and items in the fact, categories among items."""
    cd = F.approx_count_distinct if approx else F.count_distinct
    # an aggregate a column: two distinct counts in one would multiply the rows
    parts = [star[table].agg(cd(key).alias(name)).withColumn("_k", F.lit(1)) for table, key, name in (
        ("transactions", "customer_id", "distinct_customers"), ("transactions", "item_id", "distinct_items"),
        ("items", "category_id", "distinct_categories"))]
    return parts[0].join(parts[1], "_k").join(parts[2], "_k").drop("_k")


def _avg_money(tp: Column) -> Column:
    """Average in whole cents (exact integer sum), rounded half-even to cents."""
    cents = F.sum(F.rint(tp.cast("double") * F.lit(100.0)).cast("bigint")).cast("double")
    return F.coalesce(np_round(F.try_divide(cents, F.count(tp).cast("double")), 0) / F.lit(100.0), F.lit(0.0))


def business_stats(fact: DataFrame, scale: int = 2) -> DataFrame:
    """V4: revenue, average order and quantity; NULL -> 0. Money is summed as decimal."""
    dec = f"decimal(18,{scale})"
    tp = F.col("total_price").cast(dec)
    return fact.agg(
        F.coalesce(F.sum(tp), F.lit(0).cast(dec)).cast(dec).alias("total_revenue"),
        _avg_money(F.col("total_price")).alias("avg_order_value"),
        np_round(F.coalesce(F.sum("quantity"), F.lit(0.0)).cast("double"), 1).alias("total_quantity"))


# ------------------------------------------------------------------ V5–V23

def orphan_item_categories(star: dict[str, DataFrame]) -> DataFrame:
    """V5 (not among the 17): items whose category does not exist."""
    cats = star["categories"].select("category_id").distinct()
    return (star["items"].join(cats, "category_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("issues"))
            .select(F.lit(5).alias("check_id"), F.lit("orphan_item_categories").alias("check_name"),
                    F.lit("foreign_key").alias("check_group"), "issues"))


def orphan_count(fact: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """V6–V9: fact rows whose key (NULL included) no parent row has. Rows are
    counted per key first, a map-side aggregate that leaves one row a key: a
    hot or a NULL key never meets the join with its rows."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.join(parent.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_issues")))


ORPHAN_KEYS = {6: ("customers", "customer_id"), 7: ("items", "item_id"),
               8: ("payment_methods", "payment_method_id"), 9: ("locations", "location_id")}


def run_checks(star: dict[str, DataFrame], as_of=None, max_quantity: float = 1000,
               max_total: float = 10000, max_key_bytes: int = 32,
               price_tolerance: float = 0.01, only: list[int] | None = None) -> DataFrame:
    """V6–V22 as a check table (check_id, check_name, check_group, issues).

    ``only`` names the checks to run; a check reads no more than its own columns:
    the row counters share one scan of the fact, each orphan check counts its key,
    duplicates count theirs, so no counter rides through another's shuffle."""
    wanted = set(only or [i for i, _, _ in CHECKS])
    t = star["transactions"]
    tp, q = F.col("total_price"), F.col("quantity")
    counters = {
        11: q <= 0,
        12: tp <= 0,
        13: F.col("transaction_date") > F.date_add(_lit_date(as_of), 1),
        14: q > F.lit(max_quantity),
        15: tp > F.lit(max_total),
        16: F.col("customer_id").isNull(),
        17: F.col("transaction_id").isNull(),
        19: F.octet_length("transaction_id") > max_key_bytes,
        20: (tp >= F.lit(1e8)) | (np_round(tp, 2) != tp),
    }
    parts = []
    ids = sorted(wanted & set(counters))
    if ids:
        parts.append(_stack(t.agg(*[count_if(counters[i]).alias(f"c{i}") for i in ids]), ids))
    for i in sorted(wanted & set(ORPHAN_KEYS)):
        table, key = ORPHAN_KEYS[i]
        parts.append(_stack(orphan_count(t, key, star[table]).withColumnRenamed("_issues", f"c{i}"), [i]))
    if 10 in wanted:
        items = star["items"].select("item_id", F.col("price_per_unit").alias("_price"))
        parts.append(_stack(t.select("item_id", "quantity", "total_price").join(items, "item_id").agg(
            count_if(F.abs(tp - F.col("_price") * q) > F.lit(price_tolerance)).alias("c10")), [10]))
    if 21 in wanted:
        parts.append(_stack(t.agg((F.count(F.lit(1)) - F.count_distinct("transaction_id")).alias("c21")), [21]))
    c = star["customers"]
    if 18 in wanted:
        parts.append(_stack(c.agg(count_if(F.octet_length("customer_id") > max_key_bytes).alias("c18")), [18]))
    if 22 in wanted:
        parts.append(_stack(c.agg((F.count(F.lit(1)) - F.count_distinct("customer_id")).alias("c22")), [22]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summarize_checks(checks: DataFrame) -> DataFrame:
    """Total issues over the 17 checks and pass/fail (V5 excluded)."""
    counted = checks.filter(F.col("check_id").between(6, 22))
    return counted.agg(F.count(F.lit(1)).alias("checks"),
                       F.coalesce(F.sum("issues"), F.lit(0)).cast("bigint").alias("total_issues"),
                       count_if(F.col("issues") > 0).alias("failed_checks")
                       ).withColumn("passed", F.col("total_issues") == 0)


def sample_keys(df: DataFrame, key: str = "transaction_id", n: int = 5) -> DataFrame:
    """A reproducible sample of n keys (hash order instead of random order)."""
    return (df.select(key).filter(F.col(key).isNotNull())
            .orderBy(F.md5(F.col(key)), F.col(key)).limit(n))


# ------------------------------------------------------------------ V25–V27

def document_statistics(docs: DataFrame, scale: int = 2) -> DataFrame:
    """Date range and business metrics over transaction documents."""
    dec = f"decimal(18,{scale})"
    tp = F.col("total_price").cast(dec)
    return docs.agg(
        F.to_date(F.min("transaction_date")).alias("min_date"),
        F.to_date(F.max("transaction_date")).alias("max_date"),
        F.coalesce(F.sum(tp), F.lit(0).cast(dec)).cast(dec).alias("total_revenue"),
        _avg_money(F.col("total_price")).alias("avg_order_value"),
        np_round(F.coalesce(F.sum("quantity"), F.lit(0.0)).cast("double"), 1).alias("total_quantity"))


def nested_distinct(embedded: DataFrame) -> DataFrame:
    """Distinct values on nested paths of embedded documents."""
    return embedded.agg(F.count_distinct("customer_id").alias("distinct_customers"),
                        F.count_distinct(F.col("item.item_id")).alias("distinct_items"),
                        F.count_distinct(F.col("category.category_id")).alias("distinct_categories"))


# ------------------------------------------------------------------ V28–V31

def compare_counts(relational: DataFrame, documents: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """(table_name, relational_count, document_count, match) by full outer join;
    of ``tables`` alone if given (the embedded mode compares the transactions)."""
    if tables is not None:
        relational, documents = (x.filter(F.col("table_name").isin(tables)) for x in (relational, documents))
    r = relational.select("table_name", F.col("row_count").alias("relational_count"))
    d = documents.select("table_name", F.col("row_count").alias("document_count"))
    return (r.join(d, "table_name", "full")
            .withColumn("match", F.coalesce(F.col("relational_count") == F.col("document_count"), F.lit(False))))


def compare_metrics(rel_stats: DataFrame, doc_stats: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Revenue within tolerance, quantity exact. Both inputs are one-row aggregates."""
    r = rel_stats.select(F.lit(1).alias("_k"), F.col("total_revenue").alias("relational_revenue"),
                         F.col("total_quantity").alias("relational_quantity"))
    d = doc_stats.select(F.lit(1).alias("_k"), F.col("total_revenue").alias("document_revenue"),
                         F.col("total_quantity").alias("document_quantity"))
    return (r.join(d, "_k").drop("_k")
            .withColumn("revenue_match", F.abs(F.col("relational_revenue") - F.col("document_revenue"))
                        < F.lit(tolerance))
            .withColumn("quantity_match", F.col("relational_quantity") == F.col("document_quantity")))


def compare_dates(rel_range: DataFrame, doc_range: DataFrame) -> DataFrame:
    """min/max date equal after truncation to the day."""
    r = rel_range.select(F.lit(1).alias("_k"), F.to_date("min_date").alias("relational_min"),
                         F.to_date("max_date").alias("relational_max"))
    d = doc_range.select(F.lit(1).alias("_k"), F.to_date("min_date").alias("document_min"),
                         F.to_date("max_date").alias("document_max"))
    return (r.join(d, "_k").drop("_k")
            .withColumn("min_match", F.coalesce(F.col("relational_min") == F.col("document_min"), F.lit(False)))
            .withColumn("max_match", F.coalesce(F.col("relational_max") == F.col("document_max"), F.lit(False))))


EMBEDDED_TABLES = ["customers", "transactions"]


def embedded_counts(documents: DataFrame, customers: DataFrame) -> DataFrame:
    """V25 in the embedded mode: its two collections under their tables' names."""
    return row_counts({"customers": customers, "transactions": documents}, EMBEDDED_TABLES)


def relational_rows(star: dict[str, DataFrame]) -> DataFrame:
    """Relational side of the row comparison: fact inner-joined with items,
    categories, payment methods and locations (as the reference spot check)."""
    t = star["transactions"]
    items = star["items"].select("item_id", F.col("category_id").alias("_cat"))
    cats = star["categories"].select(F.col("category_id").alias("_cat"))
    pms = star["payment_methods"].select("payment_method_id")
    locs = star["locations"].select("location_id")
    return (t.join(items, "item_id").join(cats, "_cat").join(pms, "payment_method_id")
            .join(locs, "location_id")
            .select("transaction_id", "quantity", "total_price", "transaction_date"))


def repeated_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Hashes (``_k``, with their bucket ``_b``) that more than one document's id has,
    written. Ids are counted by their 64-bit hash, 8 bytes a row."""
    hashes = docs.filter(F.col("_id").isNotNull()).groupBy(F.xxhash64(F.col("_id").cast("string")).alias("_k"))
    bucket = F.pmod("_k", F.lit(buckets or DIGEST_BUCKETS)).cast("int").alias("_b")
    return cut_lineage(hashes.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_k", bucket))


def one_document(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """*The* document of an id (a document key is unique) as ``transaction_id, _dq, _dt,
    _dd``: repeated ``_id`` values are reduced to the greatest (quantity, total, date).
    Only the documents whose hash is in ``repeated`` are grouped, and written; the
    others pass as they are."""
    values = docs.filter(F.col("_id").isNotNull()).select(
        F.col("_id").alias("transaction_id"), F.col("quantity").alias("_dq"), F.col("total_price").alias("_dt"),
        F.to_date("transaction_date").alias("_dd"))
    if repeated.isEmpty():
        return values
    marked = values.withColumn("_k", F.xxhash64(F.col("transaction_id").cast("string")))
    greatest = cut_lineage(marked.join(repeated.select("_k"), "_k", "left_semi").groupBy("transaction_id")
                           .agg(F.max(F.struct("_dq", "_dt", "_dd")).alias("_m")).select("transaction_id", "_m.*"))
    return marked.join(repeated.select("_k"), "_k", "left_anti").drop("_k").unionByName(greatest)


def row_differences(rel: DataFrame, docs: DataFrame, tolerance: float = 0.01, repeated: DataFrame | None = None) -> DataFrame:
    """V31 per row: relational row LEFT JOIN *the* document of its id
    (``one_document``, so a hot repeated key can never pair every copy with every
    copy; ``repeated``: its hashes, if known). Rows without an id meet no document and
    bypass the join: NULL would be one hot key of it."""
    d = one_document(docs, repeated_documents(docs) if repeated is None else repeated).withColumn("_found", F.lit(True))
    j = rel.filter(F.col("transaction_id").isNotNull()).join(d, "transaction_id", "left")
    found = F.col("_found").isNotNull()
    named = j.select(
        "transaction_id",
        F.lit(False).alias("null_id"),
        (~found).alias("missing"),
        (found & ~F.col("quantity").eqNullSafe(F.col("_dq"))).alias("quantity_diff"),
        (found & F.coalesce(F.abs(F.col("total_price") - F.col("_dt")) > F.lit(tolerance),
                            F.col("total_price").isNull() != F.col("_dt").isNull())).alias("total_diff"),
        (found & ~F.to_date("transaction_date").eqNullSafe(F.col("_dd"))).alias("date_diff"))
    no = F.lit(False)
    return named.unionByName(rel.filter(F.col("transaction_id").isNull()).select(
        "transaction_id", F.lit(True).alias("null_id"), no.alias("missing"), no.alias("quantity_diff"),
        no.alias("total_diff"), no.alias("date_diff")))


def _compared(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with a key as ``_b`` (bucket of the key) and two digests of what V31 compares."""
    cols = [F.col(key).cast("string"), F.col("quantity").cast("double"), F.col("total_price").cast("double"),
            F.to_date("transaction_date")]
    h1, h2 = row_digest(cols)
    return df.filter(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(cols[0]), F.lit(buckets)).cast("int").alias("_b"), h1.alias("_h1"), h2.alias("_h2"))


def differing_buckets(rel: DataFrame, docs: DataFrame, buckets: int = DIGEST_BUCKETS, repeated: DataFrame | None = None) -> DataFrame:
    """V31 by digests: the buckets of ids (at most ``buckets`` rows, ``_b``) whose rows are
    not the same on both sides, or hold a repeated document id (``repeated_documents``).
    Each side is one scan and a partial aggregate to a row a bucket: number of rows and
    sums of two 64-bit row digests, by halves, which whole numbers of 64 bits hold."""
    def sides(df, key):
        rows = _compared(df, key, buckets)
        return rows.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), *[
            F.sum(half).alias(f"s{h}{k}") for h in ("_h1", "_h2")
            for k, half in enumerate((F.shiftright(h, 32), F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))))])
    a, b = sides(rel, "transaction_id").alias("a"), sides(docs, "_id").alias("b")
    same = F.lit(True)
    for c in ("n", "s_h10", "s_h11", "s_h20", "s_h21"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    differ = a.join(b, F.col("a._b") == F.col("b._b"), "full").filter(~same).select(F.coalesce("a._b", "b._b").alias("_b"))
    repeated = repeated_documents(docs, buckets) if repeated is None else repeated
    return differ.unionByName(repeated.select("_b")).distinct()


def compare_rows(rel: DataFrame, docs: DataFrame, sample: int | None = None,
                 tolerance: float = 0.01, digests: bool = False) -> DataFrame:
    """V31 summary: all rows (``sample=None``) or the n hash-sampled ids.
    An empty sample gives zeros, not an error. Rows without an id cannot be
    compared; they are counted as ``null_ids``.

    ``digests`` compares digests of buckets of ids first and joins only the rows of
    the buckets that differ (``differing_buckets``, written when this is called): the
    same answer, and two stores that agree are never joined."""
    if sample is not None:
        # the sampled rows are written: they, not the whole tables, meet the documents
        ids = sample_keys(rel, "transaction_id", sample)
        rel = cut_lineage(rel.join(ids, "transaction_id", "left_semi"))
        docs = docs.join(rel.select(F.col("transaction_id").alias("_id")), "_id", "left_semi")
    if not digests:
        return _difference_counts(row_differences(rel, docs, tolerance))
    repeated = repeated_documents(docs)
    wanted = cut_lineage(differing_buckets(rel, docs, repeated=repeated))
    ids = rel.agg(F.count("transaction_id").alias("checked"), count_if(F.col("transaction_id").isNull()).alias("null_ids"))
    if wanted.isEmpty():
        return ids.select("checked", "null_ids", *[F.lit(0).cast("bigint").alias(c) for c in DIFFERENCES])

    def only(df, key):      # at most DIGEST_BUCKETS rows are broadcast
        b = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(DIGEST_BUCKETS)).cast("int")
        return df.filter(F.col(key).isNotNull()).withColumn("_b", b).join(F.broadcast(wanted), "_b", "left_semi").drop("_b")
    found = _difference_counts(row_differences(only(rel, "transaction_id"), only(docs, "_id"), tolerance, repeated))
    return (ids.withColumn("_one", F.lit(1)).join(F.broadcast(found.select(*DIFFERENCES).withColumn("_one", F.lit(1))), "_one")
            .drop("_one"))          # one row each


DIFFERENCES = ["missing_count", "mismatch_count", "quantity_mismatches", "total_mismatches", "date_mismatches", "non_date_mismatches"]


def _difference_counts(diffs: DataFrame) -> DataFrame:
    named = ~F.col("null_id")
    mism = F.col("quantity_diff") | F.col("total_diff") | F.col("date_diff")
    return diffs.agg(
        count_if(named).alias("checked"),
        count_if(F.col("null_id")).alias("null_ids"),
        count_if(F.col("missing")).alias("missing_count"),
        count_if(mism).alias("mismatch_count"),
        count_if(F.col("quantity_diff")).alias("quantity_mismatches"),
        count_if(F.col("total_diff")).alias("total_mismatches"),
        count_if(F.col("date_diff")).alias("date_mismatches"),
        count_if(mism & ~F.col("date_diff")).alias("non_date_mismatches"))


# ------------------------------------------------------------------ V32–V35

def validation_status(counts_cmp: DataFrame, metrics_cmp: DataFrame, dates_cmp: DataFrame,
                      spot: DataFrame, checks: DataFrame) -> DataFrame:
    """V32–V34 in one row.

    status_compat keeps the reference rule: any spot-check difference counts
    as a minor format difference and date-range differences never fail.
    status_strict fails on missing rows and non-date differences too.
    """
    c = counts_cmp.agg(F.min(F.col("match").cast("int")).alias("_cm"),
                       F.coalesce(F.sum("relational_count"), F.lit(0)).cast("bigint").alias("relational_total"),
                       F.coalesce(F.sum("document_count"), F.lit(0)).cast("bigint").alias("document_total"))
    m = metrics_cmp.select((F.col("revenue_match") & F.col("quantity_match")).alias("business_match"))
    d = dates_cmp.select((F.col("min_match") & F.col("max_match")).alias("dates_match"))
    s = spot.select("missing_count", "mismatch_count", "non_date_mismatches")
    k = checks.agg(
        F.coalesce(F.sum(F.when(F.col("check_id").between(6, 9), F.col("issues"))), F.lit(0))
        .cast("bigint").alias("fk_issues"),
        F.coalesce(F.sum(F.when(F.col("check_id").isin(11, 12), F.col("issues"))), F.lit(0))
        .cast("bigint").alias("rule_violations"))
    one = [x.withColumn("_k", F.lit(1)) for x in (c, m, d, s, k)]
    j = one[0]
    for x in one[1:]:
        j = j.join(x, "_k")
    counts_ok = F.coalesce(F.col("_cm") == 1, F.lit(False))
    critical = (F.when(counts_ok, 0).otherwise(1)
                + F.when(F.col("business_match"), 0).otherwise(1))
    success = (critical == 0) & (F.col("missing_count") == 0)
    compat = (F.when(success & (F.col("mismatch_count") == 0), F.lit("PASSED - EXCELLENT"))
              .when(success & (F.col("mismatch_count") > 0), F.lit("PASSED - minor differences"))
              .otherwise(F.lit("FAILED")))
    strict = (F.when(success & (F.col("non_date_mismatches") == 0) & (F.col("mismatch_count") == 0),
                     F.lit("PASSED - EXCELLENT"))
              .when(success & (F.col("non_date_mismatches") == 0), F.lit("PASSED - minor differences"))
              .otherwise(F.lit("FAILED")))
    return j.select(
        counts_ok.alias("record_count_match"), F.col("business_match"), F.col("dates_match"),
        critical.cast("int").alias("critical_issues"),
        F.col("missing_count"), F.col("mismatch_count"),
        compat.alias("status_compat"), strict.alias("status_strict"),
        "relational_total", "document_total",
        np_round(F.try_divide(F.col("document_total") * F.lit(100.0), F.col("relational_total")), 2)
        .alias("success_rate_pct"),
        "fk_issues", "rule_violations")


def validation_report(sections: dict[str, DataFrame]) -> DataFrame:
    """Every statistic, check and comparison as (section, metric, value) rows."""
    out = None
    for section, df in sections.items():
        cols = df.columns
        types = dict(df.dtypes)

        def text(c):
            # doubles through a fixed-scale decimal: no engine-specific float printing
            if types[c] in ("double", "float"):
                return f"CAST(CAST(`{c}` AS DECIMAL(38,6)) AS STRING)"
            return f"CAST(`{c}` AS STRING)"
        stack = ", ".join(f"'{c}', {text(c)}" for c in cols)
        part = df.selectExpr(f"stack({len(cols)}, {stack}) as (metric, value)").select(
            F.lit(section).alias("section"), "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out
