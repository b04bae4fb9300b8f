"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each built from the
driver tables through the library operators. SQL twins live in ``oracle_sql``."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesq.functions.expr import count_if, money
from salesq.operators import clean as C
from salesq.session import ensure_checkpoint_dir, in_parallel, materialize, remember
from salesq.sources.fixture import ORDINAL, RAW_COLUMNS, raw_sales

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _clean(spark, sf_dir) -> C.CleanResult:
    """The clean/recover plan, made once per session. Its matches and the rows that need
    them are written; the rest is columns over the stored raw feed, not a second copy of it."""
    return remember(spark, f"clean:{sf_dir}", lambda: C.clean(raw_sales(spark, sf_dir)), lambda r: r.flagged)


def _step_counts(before: DataFrame, after_pred) -> DataFrame:
    return before.agg(F.count(F.lit(1)).alias("rows_in"),
                      count_if(~after_pred).alias("rows_dropped"),
                      count_if(after_pred).alias("rows_out"))


# ------------------------------------------------------------------ cleaning

@query("clean_drop_critical")
def q_clean_drop_critical(spark, sf_dir):
    df = C.drop_missing_keys(raw_sales(spark, sf_dir))
    return _step_counts(df, F.col("_drop").isNull())


@query("clean_drop_unrecoverable")
def q_clean_drop_unrecoverable(spark, sf_dir):
    df = C.drop_unrecoverable(C.drop_missing_keys(raw_sales(spark, sf_dir)))
    return _step_counts(df.filter(F.col("_drop").isNull() | (F.col("_drop") == C.UNRECOVERABLE)),
                        F.col("_drop").isNull())


@query("clean_quarantine")
def q_clean_quarantine(spark, sf_dir):
    return _clean(spark, sf_dir).quarantine


def _live_after_c2(spark, sf_dir):
    df = C.flag_raw(raw_sales(spark, sf_dir))
    return C.drop_unrecoverable(C.drop_missing_keys(df))


@query("clean_discount")
def q_clean_discount(spark, sf_dir):
    df = C.standardize_flag(_live_after_c2(spark, sf_dir))
    return df.filter(F.col("_drop").isNull()).select(
        "transaction_id", "discount_applied",
        F.col("_f_imputed_discount_applied").alias("imputed"))


def _through_c7(spark, sf_dir):
    df = C.standardize_flag(_live_after_c2(spark, sf_dir))
    df = C.recover_ratio(df, "price_per_unit", "total_spent", "quantity", 2)
    df = C.recover_ratio(df, "quantity", "total_spent", "price_per_unit", 1)
    return C.recover_product(df, "total_spent", "price_per_unit", "quantity", 2)


@query("clean_recover_price")
def q_clean_recover_price(spark, sf_dir):
    df = _through_c7(spark, sf_dir)
    return df.filter(F.col("_f_recovered_price_per_unit")).select("transaction_id", "price_per_unit")


@query("clean_recover_quantity")
def q_clean_recover_quantity(spark, sf_dir):
    df = _through_c7(spark, sf_dir)
    return df.filter(F.col("_f_recovered_quantity")).select("transaction_id", "quantity")


@query("clean_recover_total")
def q_clean_recover_total(spark, sf_dir):
    df = _through_c7(spark, sf_dir)
    return df.filter(F.col("_f_recovered_total_spent")).select("transaction_id", "total_spent")


@query("item_catalog")
def q_item_catalog(spark, sf_dir):
    return C.price_catalog(_through_c7(spark, sf_dir)).select(
        "category", "item", F.round("mean_price", 6).alias("mean_price"))


@query("clean_infer_item")
def q_clean_infer_item(spark, sf_dir):
    flagged = _clean(spark, sf_dir).flagged
    return flagged.filter(F.col("_f_inferred_item")).select(
        "transaction_id", "category", "price_per_unit", "item")


@query("clean_drop_unmatched")
def q_clean_drop_unmatched(spark, sf_dir):
    flagged = _clean(spark, sf_dir).flagged
    return _step_counts(flagged.filter(F.col("_drop").isNull() | (F.col("_drop") == C.UNMATCHED_ITEM)),
                        F.col("_drop").isNull())


@query("clean_dates")
def q_clean_dates(spark, sf_dir):
    return _clean(spark, sf_dir).clean.select("transaction_id", "transaction_date")


@query("clean_consistency")
def q_clean_consistency(spark, sf_dir):
    flagged = _clean(spark, sf_dir).flagged
    return flagged.filter(F.col("_f_rewritten_total_spent")).select("transaction_id", "total_spent")


@query("clean_completeness")
def q_clean_completeness(spark, sf_dir):
    return _clean(spark, sf_dir).completeness


@query("cleaning_report")
def q_cleaning_report(spark, sf_dir):
    return _clean(spark, sf_dir).report


@query("sales_clean")
def q_sales_clean(spark, sf_dir):
    return _clean(spark, sf_dir).clean


@query("stats_clean_business")
def q_stats_clean_business(spark, sf_dir):
    c = _clean(spark, sf_dir).clean
    return c.agg(F.count(F.lit(1)).alias("rows"),
                 money(F.sum(money("total_spent"))).alias("total_revenue"),
                 F.sum("quantity").alias("total_quantity"),
                 F.count_distinct("customer_id").alias("distinct_customers"))


# ------------------------------------------------------------------ star

from salesq.operators import star as N  # noqa: E402
from salesq.operators import documents as D  # noqa: E402
from salesq.operators import validate as V  # noqa: E402
from salesq.plans import batch_run as PL  # noqa: E402
from salesq.sources.fixture import damaged_documents, damaged_star  # noqa: E402


def _star(spark, sf_dir):
    """The six star tables, each written once per session (S7). Dimensions are
    written first and the items and the fact are built from the written ones,
    so no surrogate-key plan is evaluated twice."""
    def clean():
        return _clean(spark, sf_dir).clean

    cats = materialize(spark, f"star.categories:{sf_dir}",
                       lambda: N.surrogate_dim(clean(), "category", "category_id", "category_name"))
    pms = materialize(spark, f"star.payment_methods:{sf_dir}",
                      lambda: N.surrogate_dim(clean(), "payment_method", "payment_method_id", "payment_method_name"))
    locs = materialize(spark, f"star.locations:{sf_dir}",
                       lambda: N.surrogate_dim(clean(), "location", "location_id", "location_name"))
    custs = materialize(spark, f"star.customers:{sf_dir}", lambda: N.customer_dim(clean()))
    items = materialize(spark, f"star.items:{sf_dir}", lambda: N.item_dim(clean(), cats))
    dims = {"categories": cats, "customers": custs, "payment_methods": pms, "locations": locs, "items": items}
    fact = materialize(spark, f"star.transactions:{sf_dir}", lambda: N.build_fact(clean(), dims))
    return {**dims, "transactions": fact}


@query("dim_categories")
def q_dim_categories(spark, sf_dir):
    return _star(spark, sf_dir)["categories"]


@query("dim_customers")
def q_dim_customers(spark, sf_dir):
    return _star(spark, sf_dir)["customers"]


@query("dim_payment_methods")
def q_dim_payment_methods(spark, sf_dir):
    return _star(spark, sf_dir)["payment_methods"]


@query("dim_locations")
def q_dim_locations(spark, sf_dir):
    return _star(spark, sf_dir)["locations"]


@query("dim_items")
def q_dim_items(spark, sf_dir):
    return _star(spark, sf_dir)["items"]


@query("dim_items_ordinal")
def q_dim_items_ordinal(spark, sf_dir):
    # the order lines' own order, which the transaction ids carry, stands for the row order
    parts = F.split("transaction_id", "_")
    clean = _clean(spark, sf_dir).clean.withColumn("ordinal", parts[1].cast("bigint") * 8 + parts[2].cast("bigint"))
    return N.item_dim(clean, _star(spark, sf_dir)["categories"], ordinal="ordinal")


@query("dim_id_ranges")
def q_dim_id_ranges(spark, sf_dir):
    """Ids of every dimension are dense: rows, distinct ids and the largest agree."""
    s = _star(spark, sf_dir)
    out = None
    for table, key in (("categories", "category_id"), ("payment_methods", "payment_method_id"),
                       ("locations", "location_id"), ("items", "item_id")):
        part = s[table].agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_ids"),
                            F.min(key).alias("least_id"), F.max(key).alias("largest_id")).select(
            F.lit(table).alias("table_name"), "row_count", "distinct_ids", "least_id", "largest_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("fact_transactions")
def q_fact_transactions(spark, sf_dir):
    return _star(spark, sf_dir)["transactions"]


@query("denorm_flat")
def q_denorm_flat(spark, sf_dir):
    return N.denormalize_flat(_star(spark, sf_dir))


# ------------------------------------------------------------------ documents

@query("docs_categories")
def q_docs_categories(spark, sf_dir):
    return D.lookup_documents(_star(spark, sf_dir)["categories"], "categories")


@query("docs_locations")
def q_docs_locations(spark, sf_dir):
    return D.lookup_documents(_star(spark, sf_dir)["locations"], "locations")


@query("docs_payment_methods")
def q_docs_payment_methods(spark, sf_dir):
    return D.lookup_documents(_star(spark, sf_dir)["payment_methods"], "payment_methods")


@query("docs_customers")
def q_docs_customers(spark, sf_dir):
    return D.customer_documents(_star(spark, sf_dir)["customers"])


@query("docs_items")
def q_docs_items(spark, sf_dir):
    s = _star(spark, sf_dir)
    return D.item_documents(s["items"], s["categories"])


@query("docs_transactions")
def q_docs_transactions(spark, sf_dir):
    return D.transaction_documents(_star(spark, sf_dir)["transactions"])


@query("docs_embedded")
def q_docs_embedded(spark, sf_dir):
    return D.flatten(D.embedded_documents(_star(spark, sf_dir)))


# ------------------------------------------------------------------ statistics (V1–V4)

@query("stats_row_counts")
def q_stats_row_counts(spark, sf_dir):
    return V.row_counts(_star(spark, sf_dir))


@query("stats_dates")
def q_stats_dates(spark, sf_dir):
    return V.date_range(_star(spark, sf_dir)["transactions"])


@query("stats_distinct")
def q_stats_distinct(spark, sf_dir):
    return V.distinct_stats(_star(spark, sf_dir))


@query("stats_business")
def q_stats_business(spark, sf_dir):
    return V.business_stats(_star(spark, sf_dir)["transactions"])


# ------------------------------------------------------------------ checks (V5–V24) on the damaged star

AS_OF = "2002-01-01"


def _checks(spark, sf_dir, only=None):
    return V.run_checks(damaged_star(spark, sf_dir), as_of=AS_OF, only=only)


@query("check_orphan_item_category")
def q_check_orphan_item_category(spark, sf_dir):
    return V.orphan_item_categories(damaged_star(spark, sf_dir))


@query("check_orphans")
def q_check_orphans(spark, sf_dir):
    return _checks(spark, sf_dir, list(range(6, 10)))


@query("check_price_calc")
def q_check_price_calc(spark, sf_dir):
    return _checks(spark, sf_dir, [10])


@query("check_business_rules")
def q_check_business_rules(spark, sf_dir):
    return _checks(spark, sf_dir, list(range(11, 16)))


@query("check_types_ranges")
def q_check_types_ranges(spark, sf_dir):
    return _checks(spark, sf_dir, list(range(16, 21)))


@query("check_duplicates")
def q_check_duplicates(spark, sf_dir):
    return _checks(spark, sf_dir, list(range(21, 23)))


@query("validation_summary")
def q_validation_summary(spark, sf_dir):
    return V.summarize_checks(_checks(spark, sf_dir))


@query("sample_ids")
def q_sample_ids(spark, sf_dir):
    return V.sample_keys(damaged_star(spark, sf_dir)["transactions"], "transaction_id", 5)


# ------------------------------------------------------------------ document side

def _doc_tables(star):
    return {
        "categories": D.lookup_documents(star["categories"], "categories"),
        "locations": D.lookup_documents(star["locations"], "locations"),
        "payment_methods": D.lookup_documents(star["payment_methods"], "payment_methods"),
        "customers": D.customer_documents(star["customers"]),
        "items": D.item_documents(star["items"], star["categories"]),
        "transactions": D.transaction_documents(star["transactions"]),
    }


@query("doc_counts")
def q_doc_counts(spark, sf_dir):
    return V.row_counts(_doc_tables(_star(spark, sf_dir)))


@query("doc_stats")
def q_doc_stats(spark, sf_dir):
    return V.document_statistics(D.transaction_documents(_star(spark, sf_dir)["transactions"]))


@query("doc_distinct_nested")
def q_doc_distinct_nested(spark, sf_dir):
    return V.nested_distinct(D.embedded_documents(_star(spark, sf_dir)))


# ------------------------------------------------------------------ cross-store comparison

def _damaged_docs(spark, sf_dir):
    s = damaged_star(spark, sf_dir)
    docs = _doc_tables(s)
    docs["transactions"] = damaged_documents(spark, sf_dir)
    return s, docs


def _compare_parts(spark, sf_dir):
    s, docs = _damaged_docs(spark, sf_dir)
    counts = V.compare_counts(V.row_counts(s), V.row_counts(docs))
    rel_stats = V.business_stats(s["transactions"], scale=3)
    doc_stats = V.document_statistics(docs["transactions"], scale=3)
    metrics = V.compare_metrics(rel_stats, doc_stats)
    dates = V.compare_dates(V.date_range(s["transactions"]), doc_stats)
    rel = V.relational_rows(s)
    return s, docs, counts, metrics, dates, rel


@query("compare_counts")
def q_compare_counts(spark, sf_dir):
    return _compare_parts(spark, sf_dir)[2]


@query("compare_metrics")
def q_compare_metrics(spark, sf_dir):
    return _compare_parts(spark, sf_dir)[3]


@query("compare_dates")
def q_compare_dates(spark, sf_dir):
    return _compare_parts(spark, sf_dir)[4]


@query("spot_check")
def q_spot_check(spark, sf_dir):
    _, docs, _, _, _, rel = _compare_parts(spark, sf_dir)
    return V.compare_rows(rel, docs["transactions"], sample=5)


@query("reconcile_rows_full")
def q_reconcile_rows_full(spark, sf_dir):
    _, docs, _, _, _, rel = _compare_parts(spark, sf_dir)
    return V.compare_rows(rel, docs["transactions"], sample=None)


@query("reconcile_rows_digests")
def q_reconcile_rows_digests(spark, sf_dir):
    """The same answer from digests of id buckets, rows joined only where they differ."""
    _, docs, _, _, _, rel = _compare_parts(spark, sf_dir)
    return V.compare_rows(rel, docs["transactions"], digests=True)


def _sections(spark, sf_dir, kind, star, documents, **how):
    """The validation sections of a pair, each computed once a session and written, several at a time."""
    built, one = None, threading.Lock()

    def get(name):
        def build():
            nonlocal built
            with one:
                built = built or PL.validation_tables(star(), documents(), as_of=AS_OF, **how)
            return built[name]
        return name, materialize(spark, f"validation.{kind}.{name}:{sf_dir}", build)
    return dict(in_parallel([lambda n=n: get(n) for n in (
        "relational_counts", "document_counts", "relational_dates", "relational_distinct", "relational_business",
        "document_statistics", "orphan_item_categories", "checks", "counts", "metrics", "dates", "rows")]))


def _damaged_sections(spark, sf_dir):
    return _sections(spark, sf_dir, "damaged", lambda: damaged_star(spark, sf_dir),
                     lambda: _damaged_docs(spark, sf_dir)[1], scale=3)


@query("validation_status")
def q_validation_status(spark, sf_dir):
    return PL.report_of(_damaged_sections(spark, sf_dir))[0]


@query("validation_report")
def q_validation_report(spark, sf_dir):
    return PL.report_of(_damaged_sections(spark, sf_dir))[1]


@query("validation_status_undamaged")
def q_validation_status_undamaged(spark, sf_dir):
    """The status of a star and its own documents: passed."""
    sections = _sections(spark, sf_dir, "undamaged", lambda: _star(spark, sf_dir), lambda: _doc_tables(_star(spark, sf_dir)))
    return PL.report_of(sections)[0]


# ------------------------------------------------------------------ the embedded document mode

def _embedded_docs(spark, sf_dir):
    s = _star(spark, sf_dir)
    return {"customers": D.customer_documents(s["customers"]), "transactions": D.embedded_documents(s)}


@query("doc_counts_embedded")
def q_doc_counts_embedded(spark, sf_dir):
    return V.row_counts(_embedded_docs(spark, sf_dir), V.EMBEDDED_TABLES)


@query("compare_counts_embedded")
def q_compare_counts_embedded(spark, sf_dir):
    return V.compare_counts(V.row_counts(_star(spark, sf_dir)),
                            V.row_counts(_embedded_docs(spark, sf_dir), V.EMBEDDED_TABLES), ["transactions"])


@query("reconcile_rows_embedded")
def q_reconcile_rows_embedded(spark, sf_dir):
    s = _star(spark, sf_dir)
    return V.compare_rows(V.relational_rows(s), _embedded_docs(spark, sf_dir)["transactions"])


# ------------------------------------------------------------------ profiling (P1–P6) and S1

from salesq.operators import profile as P  # noqa: E402
from salesq.sources import io as IO  # noqa: E402
from salesq.sources.fixture import raw_sales_text  # noqa: E402


@query("raw_scan")
def q_raw_scan(spark, sf_dir):
    """S1 end to end: the feed written as a real CSV and scanned by header name."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/salesq-raw-csv/{uuid.uuid4().hex[:12]}"
    return IO.read_raw_sales(spark, IO.write_raw_csv(raw_sales_text(spark, sf_dir), path))


@query("profile_shape")
def q_profile_shape(spark, sf_dir):
    return P.profile_shape(raw_sales(spark, sf_dir))


@query("profile_non_null")
def q_profile_non_null(spark, sf_dir):
    return P.profile_columns(raw_sales(spark, sf_dir))


@query("profile_missing")
def q_profile_missing(spark, sf_dir):
    return P.profile_missing(raw_sales(spark, sf_dir))


@query("profile_duplicates")
def q_profile_duplicates(spark, sf_dir):
    return P.profile_duplicates(raw_sales(spark, sf_dir))


@query("profile_values")
def q_profile_values(spark, sf_dir):
    return P.profile_values(raw_sales(spark, sf_dir), ["payment_method", "location", "discount_applied"])


@query("profile_numeric")
def q_profile_numeric(spark, sf_dir):
    return P.profile_numeric(raw_sales(spark, sf_dir), ["price_per_unit", "quantity", "total_spent"])


# ------------------------------------------------------------------ load

from salesq.operators import load as L  # noqa: E402
from salesq.operators.month_table import fact_table  # noqa: E402
from salesq.schema import LOAD_ORDER, TABLES  # noqa: E402

TS1, TS2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
BATCH1_END = "1997-01-01"


def _batch1(df):
    return df.filter(F.col("transaction_date") < F.lit(BATCH1_END).cast("date"))


@query("upsert_dimension")
def q_upsert_dimension(spark, sf_dir):
    clean = _clean(spark, sf_dir).clean
    names = lambda d: d.select(F.col("payment_method").alias("payment_method_name"))
    t1 = L.upsert_dimension(L.empty_table(spark, "payment_methods"), names(_batch1(clean)),
                            "payment_method_id", "payment_method_name", TS1)
    return L.upsert_dimension(t1, names(clean), "payment_method_id", "payment_method_name", TS2)


@query("upsert_customers")
def q_upsert_customers(spark, sf_dir):
    clean = _clean(spark, sf_dir).clean
    t1 = L.upsert_customers(L.empty_table(spark, "customers"), _batch1(clean), TS1)
    return L.upsert_customers(t1, clean, TS2)


@query("upsert_items")
def q_upsert_items(spark, sf_dir):
    clean = _clean(spark, sf_dir).clean
    star = _star(spark, sf_dir)
    items1 = N.item_dim(_batch1(clean), star["categories"])
    t1 = L.upsert_items(L.empty_table(spark, "items"), items1, TS1)
    return L.upsert_items(t1, star["items"], TS2)


def _empty_fact(spark):
    return spark.createDataFrame([], "transaction_id string, customer_id string, item_id int, "
                                     "payment_method_id int, location_id int, quantity double, total_price double, "
                                     "transaction_date date, discount_applied boolean, created_at timestamp_ntz, "
                                     "updated_at timestamp_ntz")


@query("upsert_transactions")
def q_upsert_transactions(spark, sf_dir):
    fact = _star(spark, sf_dir)["transactions"]
    t1 = L.upsert_transactions(_empty_fact(spark), _batch1(fact), TS1)
    return L.upsert_transactions(t1, fact, TS2)


@query("load_fill_defaults")
def q_load_fill_defaults(spark, sf_dir):
    raw = raw_sales(spark, sf_dir)
    pre = raw.select("transaction_id", "quantity", F.col("total_spent").alias("total_price"),
                     F.when(F.col("discount_applied").isNull(), F.lit(None).cast("boolean"))
                      .otherwise(F.col("discount_applied") == "True").alias("discount_applied"))
    return L.fill_defaults(pre)


def _damaged_split(spark, sf_dir):
    s = damaged_star(spark, sf_dir)
    return L.split_valid(s["transactions"], TABLES["transactions"], parents=s)


@query("load_rejects")
def q_load_rejects(spark, sf_dir):
    _, rejects = _damaged_split(spark, sf_dir)
    return rejects.withColumn("reasons", F.array_join("reasons", ","))


@query("conform_transactions")
def q_conform_transactions(spark, sf_dir):
    valid, _ = _damaged_split(spark, sf_dir)
    return valid


@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    star = _star(spark, sf_dir)
    loaded = {}
    for name in star:
        valid, _ = L.split_valid(star[name], TABLES[name], parents=star)
        loaded[name] = valid
    return L.reconcile_counts(V.row_counts(star), V.row_counts(loaded), mode="at_least")


@query("migration_summary")
def q_migration_summary(spark, sf_dir):
    s, docs = _damaged_docs(spark, sf_dir)
    return L.migration_summary(V.row_counts(s), V.row_counts(docs), L.key_errors(docs))


@query("contract_duplicates")
def q_contract_duplicates(spark, sf_dir):
    return L.contract_duplicates({n: damaged_star(spark, sf_dir)[n] for n in LOAD_ORDER})


@query("upsert_partitioned_fact")
def q_upsert_partitioned_fact(spark, sf_dir):
    """Two batches into a month-partitioned table; rows without a date included."""
    fact = _star(spark, sf_dir)["transactions"]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/salesq-partitioned/{uuid.uuid4().hex[:12]}"
    L.upsert_partitioned(spark, path, _batch1(fact), TS1)
    L.upsert_partitioned(spark, path, fact, TS2)
    return spark.read.option("basePath", path).parquet(path).withColumn("year_month", F.col("year_month").cast("string"))


@query("upsert_versioned_fact")
def q_upsert_versioned_fact(spark, sf_dir):
    """The same two batches, each published whole as a version."""
    return _versioned(spark, sf_dir).read()


@query("versioned_fact_before")
def q_versioned_fact_before(spark, sf_dir):
    """The first version, still readable after the second was published."""
    return _versioned(spark, sf_dir).read(1)


def _versioned(spark, sf_dir):
    fact = _star(spark, sf_dir)["transactions"]
    table = fact_table(spark, _folder(spark, "versioned"), fact)
    table.upsert(_batch1(fact), TS1)
    table.upsert(fact, TS2)
    return table


@query("load_superseded")
def q_load_superseded(spark, sf_dir):
    """Rows that a greater row of the same key replaces, of the damaged star's
    customers, items and transactions."""
    s, out = damaged_star(spark, sf_dir), None
    for name, key in (("customers", "customer_id"), ("items", "item_id"), ("transactions", "transaction_id")):
        _, gone = L.split_superseded(s[name], key)
        part = gone.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"),
                           F.array_join("reasons", ",").alias("reason"), "copies",
                           (F.col("total_price") if name == "transactions" else F.lit(None)).cast("double").alias("total_price"))
        out = part if out is None else out.unionByName(part)
    return out


@query("load_winners")
def q_load_winners(spark, sf_dir):
    """The transactions that stay, one a key (rows without a key stay for the checks)."""
    winners, _ = L.split_superseded(damaged_star(spark, sf_dir)["transactions"], "transaction_id")
    return winners


@query("source_counts")
def q_source_counts(spark, sf_dir):
    return L.source_counts(_star(spark, sf_dir))


@query("star_scan_counts")
def q_star_scan_counts(spark, sf_dir):
    """S3/S7 end to end: the star written as CSV and scanned by header name; rows,
    NULLs and sums of every column."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/salesq-star-csv/{uuid.uuid4().hex[:12]}"
    IO.write_star(_star(spark, sf_dir), out, fmt="csv")
    result = None
    for name, df in IO.read_star(spark, out, fmt="csv").items():
        exprs = []
        for c, kind in df.dtypes:
            total = F.sum(F.col(c).cast("decimal(18,2)")) if kind in ("int", "bigint") or kind.startswith("decimal") else F.lit(None)
            exprs.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("row_count"),
                                  F.sum(F.col(c).isNull().cast("bigint")).alias("nulls"),
                                  total.cast("decimal(18,2)").alias("total")))
        part = df.agg(F.array(*exprs).alias("c")).select(F.lit(name).alias("table_name"), F.explode("c").alias("c")).select("table_name", "c.*")
        result = part if result is None else result.unionByName(part)
    return result


# ------------------------------------------------------------------ written stages read back

def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/salesq-{name}/{uuid.uuid4().hex[:12]}"


@query("dim_items_file_order")
def q_dim_items_file_order(spark, sf_dir):
    """N5 from a CSV feed of several files: ids by first appearance in the files, from
    the ordinal of the scan. The feed is written in the order of its line keys."""
    keys = F.split("Transaction ID", "_")
    path = _folder(spark, "ordered-csv")
    text = raw_sales_text(spark, sf_dir)
    order = [keys[1].cast("bigint"), keys[2].cast("bigint"), F.col("Transaction ID")]
    ordered = text.repartitionByRange(*order).sortWithinPartitions(*order)
    clean = C.clean(IO.read_raw_sales(spark, IO.write_raw_csv(ordered, path), ordinal=True)).clean
    return N.item_dim(clean, _star(spark, sf_dir)["categories"], ordinal=ORDINAL).select("item_id", "item_name", "price_per_unit", "category_id")


@query("clean_snapshot_resume")
def q_clean_snapshot_resume(spark, sf_dir):
    """The clean stage written, then resumed from its snapshot."""
    out, raw = _folder(spark, "clean-run"), raw_sales(spark, sf_dir)
    PL.clean_stage(spark, raw, out)
    resumed = PL.clean_stage(spark, raw, out, skip_cleaning=True)
    return IO.read_clean(spark, resumed.paths["clean"]).select(*RAW_COLUMNS)


@query("quarantine_snapshot")
def q_quarantine_snapshot(spark, sf_dir):
    """The quarantine as the clean stage writes it."""
    return spark.read.parquet(PL.clean_stage(spark, raw_sales(spark, sf_dir), _folder(spark, "clean-run")).paths["quarantine"])


@query("star_scan_parquet")
def q_star_scan_parquet(spark, sf_dir):
    """The star written by month and read back; the fact."""
    out = _folder(spark, "star-parquet")
    IO.write_star(_star(spark, sf_dir), out)
    return IO.read_star(spark, out, fmt="parquet")["transactions"].drop("year_month")


@query("flat_snapshot")
def q_flat_snapshot(spark, sf_dir):
    """The flat view written and read back."""
    return spark.read.parquet(IO.write_table(N.denormalize_flat(_star(spark, sf_dir)), _folder(spark, "flat")))


@query("docs_round_trip")
def q_docs_round_trip(spark, sf_dir):
    """Transaction documents written as JSON lines and read with their schema."""
    docs = D.transaction_documents(_star(spark, sf_dir)["transactions"])
    return IO.read_documents(spark, IO.write_documents(docs, _folder(spark, "docs")), docs.schema)


@query("profile_snapshot")
def q_profile_snapshot(spark, sf_dir):
    """A profile written as CSV and read back."""
    out = IO.write_profile({"missing": P.profile_missing(raw_sales(spark, sf_dir))}, _folder(spark, "profile"))["missing"]
    return spark.read.schema("column_name string, missing_count long").option("header", True).csv(out)
