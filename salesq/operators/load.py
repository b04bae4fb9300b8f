"""Loading the star idempotently.

Parquet has no MERGE, so an upsert is a full outer join of the target
snapshot with the (deduplicated) source on the key, written as a new
snapshot directory. Per-row rejects are split off with an array of reasons
instead of failing the load. All steps are lazy DataFrame plans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesq.functions.expr import count_if
from salesq.operators.keys import assign_ids
from salesq.schema import LOAD_ORDER, TABLES, TableSpec
from salesq.session import cut_lineage


def _ts(load_ts) -> Column:
    if load_ts is None:
        return F.localtimestamp()
    if isinstance(load_ts, _dt.datetime):
        load_ts = load_ts.isoformat(sep=" ")
    # text -> TIMESTAMP_NTZ: independent of the session and process time zones
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def empty_table(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name].schema)


def _next_ids(new_rows: DataFrame, target: DataFrame, id_col: str, order_cols: list[str]) -> DataFrame:
    """ids max(target)+1.. for new rows in ``order_cols`` order (no collect: the
    max is a one-row aggregate joined on a constant)."""
    base = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_base")).withColumn("_k", F.lit(1))
    ided = assign_ids(new_rows, order_cols, "_seq")
    return (ided.withColumn("_k", F.lit(1)).join(F.broadcast(base), "_k")
            .withColumn(id_col, (F.col("_base") + F.col("_seq")).cast("int"))
            .drop("_k", "_base", "_seq"))


def upsert_dimension(target: DataFrame, names: DataFrame, id_col: str, name_col: str,
                     load_ts=None, collation: str | None = None) -> DataFrame:
    """L1: upsert a lookup dimension by its unique name. Existing names keep
    their id and CreatedAt and get UpdatedAt = load time; new names get the
    next ids in name order. ``collation`` (e.g. ``UNICODE_CI_AI_RTRIM``) makes
    the name match case/accent/trailing-space insensitive, like a
    case-insensitive unique key; by default names compare binary."""
    ts = _ts(load_ts)

    def k(c):
        return F.collate(F.col(c), collation) if collation else F.col(c)
    src = names.select(F.col(name_col)).filter(F.col(name_col).isNotNull())
    if collation:   # one source spelling per collated key (the smallest)
        src = src.groupBy(k(name_col).alias("_key")).agg(F.min(name_col).alias(name_col)).drop("_key")
    else:
        src = src.distinct()
    hits = src.select(k(name_col).alias("_key")).distinct().withColumn("_touch", F.lit(True))
    existing = (target.withColumn("_key", k(name_col)).join(hits, "_key", "left")
                .withColumn("updated_at", F.when(F.col("_touch"), ts).otherwise(F.col("updated_at")))
                .drop("_touch", "_key"))
    new = (src.withColumn("_key", k(name_col))
           .join(target.select(k(name_col).alias("_key")), "_key", "left_anti").drop("_key"))
    new = (_next_ids(new, target, id_col, [name_col])
           .withColumn("created_at", ts).withColumn("updated_at", ts))
    return existing.select(id_col, name_col, "created_at", "updated_at").unionByName(
        new.select(id_col, name_col, "created_at", "updated_at"))


def upsert_customers(target: DataFrame, source: DataFrame, load_ts=None) -> DataFrame:
    """L2: upsert customers by key (full outer join + coalesce)."""
    ts = _ts(load_ts)
    src = source.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct() \
        .withColumn("_in", F.lit(True))
    j = target.join(src, "customer_id", "full")
    return j.select(
        "customer_id",
        F.coalesce(F.col("created_at"), ts).alias("created_at"),
        F.when(F.col("_in"), ts).otherwise(F.col("updated_at")).alias("updated_at"))


def upsert_items(target: DataFrame, source: DataFrame, load_ts=None, order_col: str = "item_id") -> DataFrame:
    """L3: upsert items by (item_name, category_id); the latest source row
    (highest ``order_col``) gives the price; target ids are kept, new keys get
    the next ids. Ids are looked up by key, never reused from the source."""
    ts = _ts(load_ts)
    key = ["item_name", "category_id"]
    src = (source.filter(F.col("item_name").isNotNull())
           .groupBy(*key).agg(F.max_by("price_per_unit", order_col).alias("_price"))
           .withColumn("_price", F.col("_price").cast("decimal(10,2)")))
    # NULL categories are equal as keys: such an item is updated, not added again
    same = (F.col("t.item_name") == F.col("s.item_name")) & F.col("t.category_id").eqNullSafe(F.col("s.category_id"))
    old = target.alias("t").join(src.alias("s"), same, "left").select(
        "t.item_id", *(f"t.{k}" for k in key),
        F.coalesce("_price", "price_per_unit").cast("decimal(10,2)").alias("price_per_unit"),
        "t.created_at",
        F.when(F.col("_price").isNotNull(), ts).otherwise(F.col("t.updated_at")).alias("updated_at"))
    new = src.alias("s").join(target.alias("t"), same, "left_anti")
    new = (_next_ids(new, target, "item_id", key)
           .select("item_id", *key, F.col("_price").alias("price_per_unit"),
                   ts.alias("created_at"), ts.alias("updated_at")))
    return old.unionByName(new).select("item_id", "item_name", "price_per_unit", "category_id",
                                       "created_at", "updated_at")


FACT_VALUE_COLS = ["customer_id", "item_id", "payment_method_id", "location_id", "quantity",
                   "total_price", "transaction_date", "discount_applied"]


def dedupe_latest(source: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (pass the source's ordinal for
    "the last row wins"; default: all value columns). Rows without a key are
    left out; callers report them (``null_key_rejects``).

    The keys' 64-bit hashes are counted first, so only rows whose hash repeats are
    grouped with their values (and written); all others are neither sorted nor
    shuffled. The source is scanned again by whoever reads the result."""
    cols = [c for c in source.columns if c != key]
    order = F.struct(*(order_by or cols))
    named = source.filter(F.col(key).isNotNull()).select(key, *cols)
    hashed = F.xxhash64(key).alias("_hash")
    repeated = cut_lineage(named.groupBy(hashed).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"))
    if repeated.isEmpty():
        return named
    marked = named.select("*", hashed)
    best = cut_lineage(marked.join(repeated, "_hash", "left_semi").groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_r")))
    return (marked.join(repeated, "_hash", "left_anti").select(key, *cols)
            .unionByName(best.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])))


def split_superseded(source: DataFrame, key: str | list[str], order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(winners, superseded)`` of rows whose key must be unique.

    Of a repeated key the greatest row by ``order_by`` (then by all values) stays, as
    "the last row wins" if ``order_by`` is the source's ordinal; the others come
    back as distinct rows with their number of ``copies`` and the reason
    ``superseded:<key>``. Rows with a NULL in the key stay: they are no repeats, and
    the contract's checks judge them.

    Keys are counted first, and only those that repeat are written and joined back:
    all other rows are neither sorted nor grouped with their values. The rows of a
    repeated key are counted by value before they meet their winner, so copies of
    a hot row shrink before the shuffle, and both sides of that join are written, so
    AQE can split a hot key."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in source.columns if c not in keys]
    reason = F.array(F.lit("superseded:" + ",".join(keys))).alias("reasons")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    repeated = cut_lineage(source.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                           .filter("_n > 1").select(*keys))
    if repeated.isEmpty():
        return source, source.limit(0).select("*", F.lit(0).cast("bigint").alias("copies"), reason)
    rows = cut_lineage(source.join(repeated, keys, "left_semi").groupBy(*source.columns).agg(F.count(F.lit(1)).alias("copies")))
    values = F.struct(F.lit(0).alias("_"), *cols)          # a key may have no other column
    order = F.struct(*[F.col(c) for c in order_by or []], values)
    best = cut_lineage(rows.groupBy(*keys).agg(F.max_by(values, order).alias("_best")))
    winners = source.join(repeated, keys, "left_anti").unionByName(
        best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols]))
    stays = values.eqNullSafe(F.col("_best"))
    superseded = (rows.join(best, keys).withColumn("copies", F.col("copies") - F.when(stays, 1).otherwise(0))
                  .filter("copies > 0").select(*source.columns, "copies", reason))
    return winners, superseded


def null_key_rejects(source: DataFrame, key: str = "transaction_id") -> DataFrame:
    """L6 for an upsert: the rows that cannot be placed because their key is NULL."""
    return source.filter(F.col(key).isNull()).withColumn("reasons", F.array(F.lit(f"null:{key}")))


def upsert_transactions(target: DataFrame, source: DataFrame, load_ts=None,
                        order_by: list[str] | None = None, unique: bool = False) -> DataFrame:
    """L4: upsert facts by TransactionID; all value columns replaced by the
    source; CreatedAt kept; UpdatedAt moves only when a value changed. ``unique``
    says that no key repeats in the source (``split_superseded``): its rows are then
    not sorted to find the last of each key."""
    ts = _ts(load_ts)
    carried = [c for c in order_by or [] if c not in FACT_VALUE_COLS and c != "transaction_id"]
    src = source.select("transaction_id", *FACT_VALUE_COLS, *carried)
    src = src.filter("transaction_id is not null") if unique else dedupe_latest(src, "transaction_id", order_by)
    s = src.select("transaction_id", *[F.col(c).alias(f"_s_{c}") for c in FACT_VALUE_COLS],
                   F.lit(True).alias("_in"))
    j = target.join(s, "transaction_id", "full")
    changed = F.lit(False)
    for c in FACT_VALUE_COLS:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return j.select(
        "transaction_id",
        *[F.when(F.col("_in"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in FACT_VALUE_COLS],
        F.coalesce(F.col("created_at"), ts).alias("created_at"),
        F.when(F.col("_in") & (F.col("created_at").isNull() | changed), ts)
         .otherwise(F.col("updated_at")).alias("updated_at"))


def first_transactions(source: DataFrame, load_ts=None) -> DataFrame:
    """L4 where the target holds no row yet: the source (one row a key) with its stamps,
    joined with nothing."""
    ts = _ts(load_ts)
    return (source.filter("transaction_id is not null")
            .select("transaction_id", *FACT_VALUE_COLS, ts.alias("created_at"), ts.alias("updated_at")))


ROWS_A_FILE = 500_000       # about; a month of more rows is dealt to several tasks


def deal_by_month(df: DataFrame, part: str, rows: list[DataFrame], key: str = "transaction_id") -> DataFrame:
    """``df`` shuffled once, for the files of its months: a month is one task's, or by the
    key's hash (``_salt``) as many tasks' as the fullest month of ``rows`` has
    ``ROWS_A_FILE``."""
    months = rows[0].select(part)
    for r in rows[1:]:
        months = months.unionByName(r.select(part))
    most = months.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]
    return df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1 + most // ROWS_A_FILE))).repartition(part, "_salt")


def merge_months(target: DataFrame, source: DataFrame, moved: DataFrame, part: str, load_ts=None) -> DataFrame:
    """L4's rules (``upsert_transactions``) for rows with their month ``part``, dealt by the
    month they come to: one shuffle for the search and for the months' files. No key
    repeats in the source; ``moved`` (key and new month, written) holds the keys whose
    row in the target has another month than the source gives it."""
    ts, key = _ts(load_ts), "transaction_id"
    to = moved.select(key, F.col(part).alias("_to"), F.lit(True).alias("_moved"))
    old = target.join(to, key, "left").select(
        key, *FACT_VALUE_COLS, "created_at", "updated_at", F.when(F.col("_moved"), F.col("_to")).otherwise(F.col(part)).alias(part),
        F.lit(0).alias("_new"))
    none = F.lit(None).cast("timestamp_ntz")
    new = source.filter(F.col(key).isNotNull()).select(
        key, *FACT_VALUE_COLS, none.alias("created_at"), none.alias("updated_at"), part, F.lit(1).alias("_new"))
    group = Window.partitionBy(part, "_salt", key)
    order = group.orderBy("_new")
    was = {c: F.lag(c).over(order) for c in (*FACT_VALUE_COLS, "created_at", "updated_at")}
    changed = F.lit(False)
    for c in FACT_VALUE_COLS:
        changed = changed | ~F.col(c).eqNullSafe(was[c])
    is_new = F.col("_new") == 1
    both = deal_by_month(old.unionByName(new), part, [target, source], key)
    return (both.select(
        key, *FACT_VALUE_COLS,
        F.coalesce(F.when(is_new, was["created_at"]).otherwise(F.col("created_at")), ts).alias("created_at"),
        F.when(is_new & (was["created_at"].isNull() | changed), ts).when(is_new, was["updated_at"])
         .otherwise(F.col("updated_at")).alias("updated_at"), part, "_new", F.max("_new").over(group).alias("_any"))
        .filter("_new = _any").drop("_new", "_any"))


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Pre-load defaults (discount -> false, quantity/total -> 0)."""
    defaults = defaults or {"discount_applied": False, "quantity": 0.0, "total_price": 0.0}
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def _with_reasons(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None, written: bool = False):
    """Add ``reasons`` (array of violated rules) and return (frame, conformed exprs).
    ``written`` says that the parents are written tables with unique keys."""
    parents = parents or {}
    reasons = []
    conv = {}
    types = dict(df.dtypes)
    for f in spec.schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType) and types[f.name] in ("double", "float"):
            conv[f.name] = F.expr(f"try_cast(rint(`{f.name}`) AS int)")
        else:
            conv[f.name] = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        reasons.append(F.when(c.isNotNull() & conv[f.name].isNull(), F.lit(f"bad_type:{f.name}")))
    for n in spec.not_null:
        if n in df.columns:
            reasons.append(F.when(F.col(n).isNull(), F.lit(f"null:{n}")))
    for n, limit in spec.max_bytes.items():
        if n in df.columns:
            reasons.append(F.when(F.octet_length(n) > limit, F.lit(f"too_long:{n}")))
    j = df
    for col, (ptable, pcol) in spec.fks.items():
        if ptable in parents and col in df.columns:
            keys = parents[ptable].select(F.col(pcol).alias(col)).filter(F.col(col).isNotNull())
            if written:
                # a plain join side: AQE can broadcast it by its measured size or
                # split the partition of a hot child key
                j = j.join(keys.withColumn(f"_fk_{col}", F.lit(True)), col, "left")
                missing = F.col(f"_fk_{col}").isNull()
            else:
                # the distinct keys meet the parent, and the few without one are written:
                # AQE broadcasts them, so a large parent does not shuffle whole rows
                lost = cut_lineage(df.select(col).filter(F.col(col).isNotNull()).distinct().join(keys, col, "left_anti"))
                j = j.join(lost.withColumn(f"_lost_{col}", F.lit(True)), col, "left")
                missing = F.col(f"_lost_{col}").isNotNull()
            reasons.append(F.when(F.col(col).isNotNull() & missing, F.lit(f"missing_parent:{col}")))
    j = j.withColumn("reasons", F.array_compact(F.array(*reasons)))
    return j, conv


def split_valid(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None):
    """Conform rows to the table contract; return (valid, rejects).

    Reasons: NOT NULL, text longer than the byte limit, value not castable or
    out of range for the declared type, missing parent key (left join to the
    parent's distinct keys). Quantities are rounded half-even before the INT
    cast (non-integral ones are counted by ``non_integral_count``)."""
    j, conv = _with_reasons(df, spec, parents)
    names = [f.name for f in spec.schema.fields if f.name in df.columns]
    valid = (j.filter(F.size("reasons") == 0)
             .select(*[conv[n].alias(n) if n in conv else F.col(n) for n in names]))
    rejects = j.filter(F.size("reasons") > 0).select(*df.columns, "reasons")
    return valid, rejects


def check_rows(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None,
               carry: list[str] | None = None, written: bool = False) -> DataFrame:
    """L6 in one pass (columns of ``carry``, e.g. an ordinal, go along unchecked): each
    row once, with the conformed values (valid rows), the original values (rejected
    rows), the reasons and ``_ok``. Written partitioned by ``_ok``, it is split by
    partition pruning instead of evaluating the checks twice. ``written``: the
    parents are written tables with unique keys, joined as they are."""
    j, conv = _with_reasons(df, spec, parents, written)
    ok = F.size("reasons") == 0
    names = [f.name for f in spec.schema.fields if f.name in df.columns]
    return j.select(
        *[F.when(ok, conv[n] if n in conv else F.col(n)).alias(n) for n in names],
        *[F.col(c) for c in carry or [] if c not in names],
        *[F.when(~ok, F.col(c)).alias(f"_orig_{c}") for c in df.columns],
        F.when(~ok, F.col("reasons")).alias("reasons"),
        ok.alias("_ok"))


def _ok() -> Column:
    # a partition column read back from paths is text ('true'/'false')
    return F.lower(F.col("_ok").cast("string")) == F.lit("true")


def valid_part(checked: DataFrame, spec: TableSpec, carry: list[str] | None = None) -> DataFrame:
    names = [f.name for f in spec.schema.fields if f.name in checked.columns]
    return checked.filter(_ok()).select(*names, *[c for c in carry or [] if c not in names])


def reject_part(checked: DataFrame) -> DataFrame:
    orig = [c for c in checked.columns if c.startswith("_orig_")]
    return checked.filter(~_ok()).select(*[F.col(c).alias(c[len("_orig_"):]) for c in orig], "reasons")


def non_integral_count(df: DataFrame, col: str = "quantity") -> DataFrame:
    return df.agg(count_if(F.col(col).isNotNull() & (F.col(col) != F.rint(col))).alias("non_integral"))


def reconcile_counts(expected: DataFrame, actual: DataFrame, mode: str = "at_least") -> DataFrame:
    """(table_name, expected, actual, passed); ``at_least`` passes when
    actual >= expected (the reference rule), ``exact`` needs equality."""
    e = expected.select("table_name", F.col("row_count").alias("expected"))
    a = actual.select("table_name", F.col("row_count").alias("actual"))
    j = e.join(a, "table_name", "full").fillna(0, ["expected", "actual"])
    ok = (F.col("actual") >= F.col("expected")) if mode == "at_least" else (F.col("actual") == F.col("expected"))
    return j.withColumn("passed", ok)


def source_counts(tables: dict[str, DataFrame], names=LOAD_ORDER) -> DataFrame:
    """Row count per table plus a grand total row."""
    from salesq.operators.validate import row_counts
    rc = row_counts(tables, names)
    total = rc.agg(F.lit("__total__").alias("table_name"),
                   F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("row_count"))
    return rc.unionByName(total)


def key_errors(tables: dict[str, DataFrame], key: str = "_id") -> DataFrame:
    """Rows of each table a keyed store would refuse: without a key, or with one
    that an earlier row has. (table_name, errors)"""
    out = None
    for name, df in tables.items():
        part = df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("errors")).select(
            F.lit(name).alias("table_name"), "errors")
        out = part if out is None else out.unionByName(part)
    return out


def contract_duplicates(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLES) -> DataFrame:
    """For every declared primary and unique key (table_name, key_columns),
    the rows beyond the first of their key and the rows with a NULL in it."""
    out = None
    for name, df in tables.items():
        for cols in (specs[name].pk, *specs[name].unique):
            whole = F.lit(True)
            for c in cols:
                whole = whole & F.col(c).isNotNull()
            counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            part = counted.agg(
                F.coalesce(F.sum(F.when(whole, F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("duplicates"),
                F.coalesce(F.sum(F.when(~whole, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
            ).select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"), "duplicates", "null_keys")
            out = part if out is None else out.unionByName(part)
    return out


def migration_summary(read: DataFrame, written: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per target rows read, rows written, rows lost (e.g. to an inner
    join), rows refused (``errors(table_name, errors)``; none given: 0), and totals."""
    r = read.select("table_name", F.col("row_count").alias("rows_read"))
    w = written.select("table_name", F.col("row_count").alias("rows_written"))
    j = (r.join(w, "table_name", "full").fillna(0, ["rows_read", "rows_written"])
         .withColumn("rows_lost", F.col("rows_read") - F.col("rows_written"))
         )
    if errors is None:
        j = j.withColumn("errors", F.lit(0).cast("bigint"))
    else:
        j = j.join(errors, "table_name", "left").withColumn("errors", F.coalesce("errors", F.lit(0)).cast("bigint"))
    tot = j.agg(F.lit("__total__").alias("table_name"),
                *[F.sum(c).cast("bigint").alias(c) for c in ("rows_read", "rows_written", "rows_lost", "errors")])
    return j.unionByName(tot)


def audit_event(spark, event: str, message: str, extra: str | None = None, ts=None) -> DataFrame:
    """One structured audit row (append it with ``write_table(mode='append')``)."""
    return audit_events(spark, [(event, message, extra)], ts)


def audit_events(spark, events: list[tuple], ts=None) -> DataFrame:
    """Several audit rows (event, message[, extra]) in one small frame."""
    now = ts or _dt.datetime.now()
    rows = [(now, e[0], e[1], e[2] if len(e) > 2 else None) for e in events]
    return spark.createDataFrame(rows, "ts timestamp_ntz, event string, message string, extra string")


def remap_keys(df: DataFrame, star: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """Translate surrogate keys of the normalised star into the loaded tables'
    keys through the natural keys (names; item name + category). Ids can
    drift between the two (one item id per price in the star, one per
    (name, category) once loaded), so they are never copied. Unknown keys
    stay NULL and are rejected by the contract. Every lookup side is a
    dimension (AQE broadcasts it after measuring it)."""
    out = df
    cols = df.columns
    if "category_id" in cols and "categories" in loaded:
        m = (star["categories"].select("category_id", "category_name")
             .join(loaded["categories"].select(F.col("category_id").alias("_new"), "category_name"), "category_name")
             .select("category_id", "_new"))
        out = out.join(m, "category_id", "left").withColumn("category_id", F.col("_new")).drop("_new")
    if "item_id" in cols and "items" in loaded:
        s_items = star["items"].select("item_id", "item_name", F.col("category_id").alias("_scat"))
        s_cats = star["categories"].select(F.col("category_id").alias("_scat"), "category_name")
        l_cats = loaded["categories"].select(F.col("category_id").alias("_lcat"), "category_name")
        l_items = loaded["items"].select(F.col("item_id").alias("_new"), "item_name",
                                         F.col("category_id").alias("_lcat"))
        m = (s_items.join(s_cats, "_scat", "left").join(l_cats, "category_name", "left")
             .join(l_items, ["item_name", "_lcat"], "left").select("item_id", "_new"))
        out = out.join(m, "item_id", "left").withColumn("item_id", F.col("_new")).drop("_new")
    for table, id_col, name_col in (("payment_methods", "payment_method_id", "payment_method_name"),
                                    ("locations", "location_id", "location_name")):
        if id_col in cols and table in loaded:
            m = (star[table].select(id_col, name_col)
                 .join(loaded[table].select(F.col(id_col).alias("_new"), name_col), name_col)
                 .select(id_col, "_new"))
            out = out.join(m, id_col, "left").withColumn(id_col, F.col("_new")).drop("_new")
    return out.select(*cols)


def upsert_partitioned(spark, target_path: str, source: DataFrame, load_ts=None, key: str = "transaction_id",
                       date_col: str = "transaction_date", part: str = "year_month",
                       order_by: list[str] | None = None) -> list[str | None]:
    """L4 for a month-partitioned fact: only the partitions a batch touches are
    read and rewritten (dynamic partition overwrite), not the whole table.

    Touched months = months of the (deduplicated) source rows plus the current
    months of target rows whose key reappears in the source (a row can move
    to another month). Rows without a date live in the NULL partition. The
    target is read through a filter on those months (partition pruning), merged
    (``merge_months``), staged under the checkpoint folder (a path cannot be read
    and overwritten in one job) and written back. A touched month
    left without rows is removed, the staged copy as well. A batch without rows
    is a no-op. Returns the touched months, NULL as None last (a list bounded by
    the number of months).

    ``source`` is read several times: pass a stored or persisted frame.

    This form keeps a plain folder a month, and for it reads the key column of the
    whole target and replaces months in place: a job that dies while it writes
    back can leave a month deleted, whose other rows are then in the staged copy
    alone. ``month_table.MonthTable`` has neither weakness."""
    import uuid

    from salesq.session import delete_path, ensure_checkpoint_dir, path_exists

    month = F.date_format(F.col(date_col), "yyyy-MM")
    carried = [c for c in order_by or [] if c not in FACT_VALUE_COLS and c != key]
    src = (dedupe_latest(source.select(key, *FACT_VALUE_COLS, *carried), key, order_by)
           .drop(*carried).withColumn(part, month))

    def months_of(df):
        found = [r[0] for r in df.select(part).distinct().collect()]      # one row per month
        return sorted(found, key=lambda m: (m is None, m))

    def store(df, path):        # of rows that lie by month: few files each
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)

    months = months_of(src)
    if not months:
        return []
    if not path_exists(spark, target_path):
        store(deal_by_month(first_transactions(src, load_ts).withColumn(part, month), part, [src]).drop("_salt"), target_path)
        return months
    target = spark.read.option("basePath", target_path).parquet(target_path).withColumn(part, F.col(part).cast("string"))
    moved = cut_lineage(target.select(key, F.col(part).alias("_from")).join(src.select(key, part), key)
                        .filter(~F.col("_from").eqNullSafe(F.col(part))))
    months = sorted({*months, *months_of(moved.select(F.col("_from").alias(part)))}, key=lambda m: (m is None, m))
    dated = [m for m in months if m is not None]
    touched = (F.col(part).isin(dated) if dated else F.lit(False)) | (F.col(part).isNull() & F.lit(None in months))
    merged = merge_months(target.filter(touched), src, moved, part, load_ts)
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/salesq-upsert/{uuid.uuid4().hex}"
    merged.write.partitionBy(part).parquet(stage)
    staged = spark.read.schema(merged.schema).parquet(stage)
    store(staged, target_path)
    kept = months_of(staged)
    for m in months:
        if m not in kept:
            delete_path(spark, f"{target_path.rstrip('/')}/{part}={m or '__HIVE_DEFAULT_PARTITION__'}")
    delete_path(spark, stage)
    return months
