"""Incremental load (L7, streaming form): each micro-batch of fact rows is checked
against the contract (L5, L6), upserted (L4) and published under its batch id, so a
replayed batch changes nothing and the checkpoint makes the stream restartable."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesq.operators.load import (check_rows, fill_defaults, null_key_rejects, reject_part, split_superseded,
                                    upsert_partitioned, upsert_transactions, valid_part)
from salesq.operators.month_table import BUCKETS, fact_table
from salesq.schema import TABLES
from salesq.session import cut_lineage, list_dirs, path_exists, scratch


def _current(spark: SparkSession, target_dir: str, before_batch: int | None = None) -> DataFrame | None:
    ids = sorted(int(d.split("=")[1]) for d in list_dirs(spark, target_dir)
                 if d.startswith("batch=") and path_exists(spark, os.path.join(target_dir, d, "_SUCCESS")))
    if before_batch is not None:
        ids = [i for i in ids if i < before_batch]
    return spark.read.parquet(os.path.join(target_dir, f"batch={ids[-1]}")) if ids else None


def upsert_batch(batch_df: DataFrame, batch_id: int, target_dir: str, empty_target: DataFrame, load_ts=None,
                 order_by: list[str] | None = None):
    spark = batch_df.sparkSession
    target = _current(spark, target_dir, before_batch=batch_id)
    if target is None:
        target = empty_target
    out = upsert_transactions(target, batch_df, load_ts, order_by)
    out.write.mode("overwrite").parquet(os.path.join(target_dir, f"batch={batch_id}"))


def _write_rejects(rejects: DataFrame, batch_id: int, rejects_dir: str) -> None:
    """Rows that are not loaded, with the reasons; a replayed batch rewrites its own
    folder, also with no rows."""
    rejects.write.mode("overwrite").parquet(os.path.join(rejects_dir, f"batch={batch_id}"))


def conform_batch(batch_df: DataFrame, parents: dict[str, DataFrame], order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """L5 and L6 for one micro-batch against static parents: ``(valid rows, rejects)``
    as the batch load makes them: defaults, types, NULLs, lengths, missing parents, and
    rows that a later row of the same key in the batch replaces. Rejects are
    ``transaction_id, row`` (the original values as JSON), ``reasons`` and ``copies``."""
    spec = TABLES["transactions"]
    carry = [c for c in order_by or [] if c not in spec.schema.names]
    checked = cut_lineage(check_rows(fill_defaults(batch_df), spec, parents=parents, carry=carry))
    valid, gone = split_superseded(valid_part(checked, spec, carry), "transaction_id", order_by)

    def told(df, copies):
        values = [c for c in df.columns if c not in ("reasons", "copies")]
        return df.select(F.col("transaction_id").cast("string").alias("transaction_id"),
                         F.to_json(F.struct(*values)).alias("row"), "reasons", copies.cast("bigint").alias("copies"))
    return valid, told(reject_part(checked), F.lit(1)).unionByName(told(gone, F.col("copies")))


def load_stream(stream_df: DataFrame, target_dir: str, checkpoint: str, empty_target: DataFrame | None = None,
                load_ts=None, trigger_once: bool = True, mode: str = "partitioned",
                rejects_dir: str | None = None, order_by: list[str] | None = None,
                parents: dict[str, DataFrame] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Start the streaming upsert.

    ``mode='versioned'``: each batch is published whole as the next version of a
    ``MonthTable`` at ``target_dir`` (read it with ``fact_table(...).read()``); a batch
    that was published is not applied again when the stream replays it.
    ``mode='partitioned'``: each batch rewrites only the months it touches in
    one plain month-partitioned table at ``target_dir`` (``upsert_partitioned``);
    a replayed batch changes nothing, since unchanged rows keep UpdatedAt.
    ``mode='snapshot'``: each batch writes the whole table as ``batch=<id>``
    (read with ``latest``), for tables small enough to be rewritten.
    With ``parents`` (the loaded dimensions) every batch runs the batch load's
    defaults and checks (``conform_batch``); without, only rows without a key are
    refused. Refused rows go to ``rejects_dir`` (default ``<target_dir>_rejects``), a
    folder a batch. ``order_by`` names the columns whose greatest row of a key wins in
    a batch."""
    rejects_dir = rejects_dir or target_dir.rstrip("/") + "_rejects"

    def fn(df, bid):
        df = df.persist()
        try:
            with scratch(df.sparkSession):
                if parents is not None:
                    rows, rejects = conform_batch(df, parents, order_by)
                else:
                    rows, rejects = df, null_key_rejects(df)
                _write_rejects(rejects, bid, rejects_dir)
                if mode == "versioned":
                    fact_table(df.sparkSession, target_dir, rows, buckets).upsert(
                        rows, load_ts, order_by, source_name=checkpoint, batch=bid)
                elif mode == "partitioned":
                    upsert_partitioned(df.sparkSession, target_dir, rows, load_ts, order_by=order_by)
                else:
                    upsert_batch(rows, bid, target_dir, empty_target, load_ts, order_by)
        finally:
            df.unpersist()
    w = stream_df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def latest(spark: SparkSession, target_dir: str) -> DataFrame | None:
    return _current(spark, target_dir)
