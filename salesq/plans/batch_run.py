"""End-to-end batch run (the reference's four scripts as one Spark application): clean -> star -> load snapshots -> documents -> validation.

Every stage boundary is a written table (parquet/JSON) under ``out_dir``;
later stages read those tables back, so lineage stays short and a lost
executor only recomputes the current stage. Nothing is collected except the
one-row reports returned to the caller.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesq.operators import clean as C
from salesq.operators import documents as D
from salesq.operators import load as L
from salesq.operators import star as N
from salesq.operators import validate as V
from salesq.schema import LOAD_ORDER, TABLES
from salesq.session import (begin_stage, delete_path, end_stage, fingerprint, in_parallel, list_dirs, path_exists, publish_text,
                            scratch, stage_done)
from salesq.sources import io as IO
from salesq.sources.fixture import ORDINAL


@dataclass
class RunResult:
    paths: dict[str, str] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _write_audit(spark, out_dir, events: list[tuple[str, str]]):
    """Append the stage's audit events in one write."""
    if not events:
        return
    IO.write_table(L.audit_events(spark, events).coalesce(1), os.path.join(out_dir, "audit"), mode="append")


def clean_stage(spark: SparkSession, raw: DataFrame, out_dir: str, skip_cleaning: bool = False,
                include_unmatched: bool = False) -> RunResult:
    """C1–C15 + S2/S5/S6: the feed is written once, partitioned by whether a row
    stays; the clean table is the partition of the rows that do. ``skip_cleaning``
    resumes from a finished clean table if the feed's files and the parameters are
    still those it was made from."""
    res = RunResult()
    flagged_p = os.path.join(out_dir, "clean_flagged")
    clean_p = os.path.join(flagged_p, "_live=true")
    mark = fingerprint(raw, include_unmatched=include_unmatched)
    if skip_cleaning and stage_done(spark, out_dir, "clean", mark) and IO.read_clean(spark, clean_p) is not None:
        res.paths["clean"] = clean_p
        return res
    begin_stage(spark, out_dir, "clean")
    with scratch(spark):
        r = C.clean(raw, include_unmatched=include_unmatched)
        IO.write_table(r.flagged.withColumn("_live", F.col("_drop").isNull()), flagged_p, partition_by=["_live"])
        if not path_exists(spark, clean_p):       # no row stays: an empty clean table
            IO.write_table(r.flagged.limit(0), clean_p)
    flagged = spark.read.parquet(flagged_p)
    live = F.lower(F.col("_live").cast("string")) == "true"
    cr = C.CleanResult(flagged=flagged, clean=flagged.filter(live).select(*C.kept_columns(flagged)), include_unmatched=include_unmatched)
    res.paths["clean"] = clean_p
    gone = C.CleanResult(flagged=flagged.filter(~live), clean=cr.clean, include_unmatched=include_unmatched)
    res.paths["quarantine"] = IO.write_table(gone.quarantine, os.path.join(out_dir, "quarantine"))
    res.reports["cleaning_report"] = cr.report
    res.reports["completeness"] = cr.completeness
    end_stage(spark, out_dir, "clean", mark)
    return res


def star_stage(spark: SparkSession, clean_path: str, out_dir: str, resume: bool = False) -> dict[str, DataFrame]:
    """N1–N6 + S7/S8: star written (fact partitioned by month) and read back. ``resume``
    reuses a finished star of the same clean table."""
    clean = spark.read.parquet(clean_path)
    clean = clean.select(*C.kept_columns(clean))
    ordinal = ORDINAL if ORDINAL in clean.columns else None       # of a CSV feed: ids by first appearance
    star_dir = os.path.join(out_dir, "star")
    mark = fingerprint(clean)
    if resume and stage_done(spark, out_dir, "star", mark):
        return _star_read(spark, star_dir)
    begin_stage(spark, out_dir, "star")
    dims = {}

    def keep(name, build):     # dimensions first; items and fact join the *written* ones
        IO.write_table(build(), os.path.join(star_dir, name))
        dims[name] = spark.read.parquet(os.path.join(star_dir, name))
    with scratch(spark):
        in_parallel([
            lambda: keep("categories", lambda: N.surrogate_dim(clean, "category", "category_id", "category_name")),
            lambda: keep("customers", lambda: N.customer_dim(clean)),
            lambda: keep("payment_methods", lambda: N.surrogate_dim(clean, "payment_method", "payment_method_id", "payment_method_name")),
            lambda: keep("locations", lambda: N.surrogate_dim(clean, "location", "location_id", "location_name"))])
        keep("items", lambda: N.item_dim(clean, dims["categories"], ordinal=ordinal))
        IO.write_star({"transactions": N.build_fact(clean, dims, carry=[ordinal] if ordinal else None)}, star_dir)
    written = _star_read(spark, star_dir)
    IO.write_table(N.denormalize_flat(written), os.path.join(out_dir, "flat"))
    end_stage(spark, out_dir, "star", mark)
    return written


def _star_read(spark: SparkSession, star_dir: str) -> dict[str, DataFrame]:
    written = IO.read_star(spark, star_dir, fmt="parquet")
    return written | {"transactions": written["transactions"].drop("year_month")}


def load_stage(spark: SparkSession, star: dict[str, DataFrame], out_dir: str, load_ts=None,
               snapshot: str = "v1", order_by: list[str] | None = None) -> dict[str, DataFrame]:
    """L1–L8 + S11/S12: conform, split rejects and superseded rows, upsert into the
    previous snapshot, write a new snapshot directory, reconcile counts. ``order_by``
    names the fact columns (an ordinal) whose greatest row of a repeated key wins; the
    others are written to ``superseded/<snapshot>/<table>`` and counted in the audit.

    The snapshot is marked complete last, and only complete snapshots are read as the
    base of a later one: a load that dies can be run again."""
    rel_dir = os.path.join(out_dir, "relational")
    if order_by is None and ORDINAL in star["transactions"].columns:
        order_by = [ORDINAL]
    prev = _latest_snapshot(spark, rel_dir, before=snapshot)
    delete_path(spark, os.path.join(rel_dir, f"snapshot={snapshot}", COMPLETE))
    events = [("MIGRATION_START", f"snapshot {snapshot}")]
    loaded: dict[str, DataFrame] = {}

    def load(name):
        src = L.remap_keys(star[name], star, loaded)     # ids by natural key, never copied
        if name == "transactions":
            src = L.fill_defaults(src)
        checked_p = os.path.join(out_dir, "checked", snapshot, name)
        carry = order_by if name == "transactions" else None
        checks = L.check_rows(src, TABLES[name], parents=loaded, carry=carry, written=True)
        IO.write_table(checks, checked_p, partition_by=["_ok"])
        checked = spark.read.parquet(checked_p)
        valid = L.valid_part(checked, TABLES[name], carry)
        target = prev.get(name) if prev else None
        if target is None:
            target = L.empty_table(spark, name) if name != "transactions" else None
        found = []
        if name in WINNER_ORDER:
            valid, gone = L.split_superseded(valid, list(TABLES[name].unique[0] if TABLES[name].unique else TABLES[name].pk),
                                             order_by if name == "transactions" else WINNER_ORDER[name])
            path = os.path.join(out_dir, "superseded", snapshot, name)
            seen = Observation()
            IO.write_table(gone.observe(seen, F.coalesce(F.sum("copies"), F.lit(0)).alias("n")), path)
            if seen.get["n"]:
                found.append(("SUPERSEDED", f"{name}: {seen.get['n']} rows replaced by a later row of their key"))
        if name in ("categories", "locations", "payment_methods"):
            id_col = TABLES[name].pk[0]
            name_col = TABLES[name].unique[0][0]
            new = L.upsert_dimension(target, valid.select(name_col), id_col, name_col, load_ts)
        elif name == "customers":
            new = L.upsert_customers(target, valid, load_ts)
        elif name == "items":
            new = L.upsert_items(target, valid, load_ts)
        else:
            if target is None:
                target = spark.createDataFrame([], L.valid_part(checked, TABLES[name]).schema
                                               .add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz"))
            new = L.upsert_transactions(target, valid, load_ts, order_by, unique=True)
            odd = L.non_integral_count(star[name]).first()[0]
            if odd:
                found.append(("WARNING", f"{odd} non-integral quantities were rounded"))
        p = os.path.join(rel_dir, f"snapshot={snapshot}", name)
        IO.write_table(new, p)
        loaded[name] = spark.read.parquet(p)
        return [*found, ("TABLE_LOADED", name)]

    with scratch(spark):
        # parents before children; tables of one step do not refer to each other
        for step in (["categories", "locations", "payment_methods", "customers"], ["items"], ["transactions"]):
            events += [e for found in in_parallel([lambda n=name: load(n) for name in step]) for e in found]
    recon_p = os.path.join(out_dir, "reconcile", snapshot)
    IO.write_table(L.reconcile_counts(V.row_counts(star, LOAD_ORDER), V.row_counts(loaded, LOAD_ORDER)).coalesce(1), recon_p)
    failed = 0
    for r in spark.read.parquet(recon_p).orderBy("table_name").collect():       # one row a table
        failed += not r.passed
        events.append(("RECONCILIATION_SUCCESS" if r.passed else "RECONCILIATION_FAILURE",
                       f"{r.table_name}: expected {r.expected}, actual {r.actual}"))
    events.append(("MIGRATION_COMPLETE", f"snapshot {snapshot}") if not failed else
                  ("MIGRATION_INCOMPLETE", f"snapshot {snapshot}: {failed} tables hold fewer rows than their source"))
    _write_audit(spark, out_dir, events)
    mark_complete(spark, os.path.join(rel_dir, f"snapshot={snapshot}"))
    return {n: loaded[n] for n in LOAD_ORDER}


# tables whose key can repeat in a star, and the columns whose greatest row then wins
WINNER_ORDER = {"customers": None, "items": ["item_id"], "transactions": None}
COMPLETE = "complete.json"


def mark_complete(spark: SparkSession, snapshot_dir: str) -> None:
    """Publish the list of a snapshot's finished tables: from then on it can be a base."""
    done = [n for n in LOAD_ORDER if path_exists(spark, os.path.join(snapshot_dir, n, "_SUCCESS"))]
    missing = sorted(set(LOAD_ORDER) - set(done))
    if missing:
        raise RuntimeError(f"{snapshot_dir} has no finished {', '.join(missing)}")
    publish_text(spark, os.path.join(snapshot_dir, COMPLETE), json.dumps(done))


def _latest_snapshot(spark, rel_dir, before: str | None = None) -> dict[str, DataFrame] | None:
    """The tables of the newest complete snapshot; one that died half written is
    passed over, and a complete one that lost a table is an error, never an empty table."""
    def order(name):        # v9 before v10: runs of digits compare as numbers
        return [(1, int(x), "") if x.isdigit() else (0, 0, x) for x in re.split(r"([0-9]+)", name) if x]
    snaps = sorted((d for d in list_dirs(spark, rel_dir) if d.startswith("snapshot=")), key=order, reverse=True)
    for name in snaps:
        base = os.path.join(rel_dir, name)
        if (before is not None and order(name) >= order(f"snapshot={before}")) or not path_exists(spark, os.path.join(base, COMPLETE)):
            continue
        lost = [n for n in LOAD_ORDER if not path_exists(spark, os.path.join(base, n, "_SUCCESS"))]
        if lost:
            raise RuntimeError(f"{base} was complete but has lost {', '.join(lost)}")
        return {n: spark.read.parquet(os.path.join(base, n)) for n in LOAD_ORDER}
    return None


def document_stage(spark: SparkSession, loaded: dict[str, DataFrame], out_dir: str, embedded: bool = False,
                   dry_run: bool = False) -> DataFrame:
    """D2–D6 + S9/L9/L10/L11: write each collection (overwrite = clean slate);
    ``dry_run`` only counts. Returns the migration summary: rows written are counted
    by the writes, keys that a store would refuse are found in the columnar source."""
    docs = {name: df for name, df in _document_frames(loaded, embedded).values()}
    if dry_run:
        counts = [(name, df.count()) for name, df in docs.items()]
    else:
        counts = in_parallel([lambda n=name, d=df: (n, IO.write_documents_counted(d, os.path.join(out_dir, "documents", n)))
                              for name, df in docs.items()])
    read_counts = V.row_counts(loaded, list(loaded)) if not embedded else V.row_counts(
        {"customers": loaded["customers"], "transactions_with_details": loaded["transactions"]},
        ["customers", "transactions_with_details"])
    return L.migration_summary(read_counts, spark.createDataFrame(counts, "table_name string, row_count bigint"), L.key_errors(docs))


def _document_frames(loaded: dict[str, DataFrame], embedded: bool) -> dict[str, tuple[str, DataFrame]]:
    """Table -> (collection, its documents)."""
    if embedded:
        return {"customers": ("customers", D.customer_documents(loaded["customers"])),
                "transactions": ("transactions_with_details", D.embedded_documents(loaded))}
    return {"categories": ("categories", D.lookup_documents(loaded["categories"], "categories")),
            "locations": ("locations", D.lookup_documents(loaded["locations"], "locations")),
            "payment_methods": ("payment_methods", D.lookup_documents(loaded["payment_methods"], "payment_methods")),
            "customers": ("customers", D.customer_documents(loaded["customers"])),
            "items": ("items", D.item_documents(loaded["items"], loaded["categories"])),
            "transactions": ("transactions", D.transaction_documents(loaded["transactions"]))}


def documents_read(spark: SparkSession, loaded: dict[str, DataFrame], out_dir: str, embedded: bool = False) -> dict[str, DataFrame]:
    """The written collections read back with their known schemas (no JSON
    schema-inference pass over the data), under their tables' names."""
    frames = _document_frames(loaded, embedded)
    return {n: IO.read_documents(spark, os.path.join(out_dir, "documents", path), df.schema) for n, (path, df) in frames.items()}


def transaction_documents_read(spark: SparkSession, loaded: dict[str, DataFrame], out_dir: str) -> DataFrame:
    return documents_read(spark, loaded, out_dir)["transactions"]


def validation_tables(star: dict[str, DataFrame], documents: dict[str, DataFrame], as_of=None, embedded: bool = False,
                      scale: int = 2) -> dict[str, DataFrame]:
    """V1–V31 as small frames by section, for a relational star and its documents
    (six collections, or customers and embedded transactions)."""
    tables = V.EMBEDDED_TABLES if embedded else V.STAR_TABLES
    doc_stats = V.document_statistics(documents["transactions"], scale=scale)
    rel_stats, dates = V.business_stats(star["transactions"], scale=scale), V.date_range(star["transactions"])
    rel_counts, doc_counts = V.row_counts(star), V.row_counts(documents, tables)
    return {
        "relational_counts": rel_counts, "document_counts": doc_counts,
        "relational_dates": dates, "relational_distinct": V.distinct_stats(star),
        "relational_business": rel_stats, "document_statistics": doc_stats,
        "orphan_item_categories": V.orphan_item_categories(star).select("issues"),
        "checks": V.run_checks(star, as_of=as_of),
        # the embedded mode compares the transactions, the other all six tables
        "counts": V.compare_counts(rel_counts, doc_counts, ["transactions"] if embedded else None),
        "metrics": V.compare_metrics(rel_stats, doc_stats),
        "dates": V.compare_dates(dates, doc_stats),
        "rows": V.compare_rows(V.relational_rows(star), documents["transactions"], digests=True),
    }


LONG_SECTIONS = {"relational_counts": ("table_name", ["row_count"]), "document_counts": ("table_name", ["row_count"]),
                 "checks": ("check_name", ["issues"]), "counts": ("table_name", ["relational_count", "document_count"])}


def report_of(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """V32–V35 from written section tables: (status, report)."""
    status = V.validation_status(tables["counts"], tables["metrics"], tables["dates"], tables["rows"], tables["checks"])
    report = None
    for section, (name, values) in LONG_SECTIONS.items():
        part = tables[section].select(F.lit(section).alias("section"), F.col(name).alias("metric"),
                                      F.concat_ws("/", *[F.col(v).cast("string") for v in values]).alias("value"))
        report = part if report is None else report.unionByName(part)
    rest = {n: df for n, df in tables.items() if n not in LONG_SECTIONS}
    rest |= {"summary": V.summarize_checks(tables["checks"]), "status": status}
    return status, report.unionByName(V.validation_report(rest))


def validate_stage(spark: SparkSession, loaded: dict[str, DataFrame], out_dir: str, as_of=None,
                   embedded: bool = False) -> dict[str, DataFrame]:
    """V1–V35 over the loaded tables and the written documents. Every section is
    computed once and written; status and report are built from the written ones."""
    documents = documents_read(spark, loaded, out_dir, embedded)
    base = os.path.join(out_dir, "validation_embedded" if embedded else "validation")
    def store(name, df):
        p = IO.write_table(df.coalesce(1), os.path.join(base, name))       # a few rows each
        return name, spark.read.schema(df.schema).parquet(p)
    tables = dict(in_parallel([lambda n=n, d=d: store(n, d) for n, d in
                               validation_tables(loaded, documents, as_of, embedded).items()]))
    status, report = report_of(tables)
    return tables | dict([store("status", status), store("report", report)])


def run(spark: SparkSession, raw: DataFrame, out_dir: str, load_ts=None, as_of=None,
        skip_cleaning: bool = False, snapshot: str = "v1", embedded: bool = False) -> RunResult:
    """The whole batch pipeline (documents in six collections, or ``embedded``);
    returns written paths and small report frames."""
    res = clean_stage(spark, raw, out_dir, skip_cleaning=skip_cleaning)
    star = star_stage(spark, res.paths["clean"], out_dir, resume=skip_cleaning)
    loaded = load_stage(spark, star, out_dir, load_ts=load_ts, snapshot=snapshot)
    nulls = {c: N.null_names(spark.read.parquet(res.paths["clean"]), c).first()[0] or 0
             for c in ("category", "payment_method", "location")}
    _write_audit(spark, out_dir, [("WARNING", f"{n} rows without a {c}") for c, n in nulls.items() if n])
    res.reports["migration_summary"] = document_stage(spark, loaded, out_dir, embedded=embedded)
    checked = validate_stage(spark, loaded, out_dir, as_of=as_of, embedded=embedded)
    res.reports |= checked
    res.reports["summary"] = V.summarize_checks(checked["checks"])
    res.reports["reconcile"] = spark.read.parquet(os.path.join(out_dir, "reconcile", snapshot))
    res.paths["out"] = out_dir
    return res


def run_csv(spark: SparkSession, path: str, out_dir: str, **how) -> RunResult:
    """``run`` on a CSV feed in the order of its files: item ids by first appearance, and
    the last row of a repeated key wins."""
    return run(spark, IO.read_raw_sales(spark, path, ordinal=True), out_dir, **how)
