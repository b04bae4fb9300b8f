"""Session helpers: a tuned local session for tests/bench, checkpoint folder lookup."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may turn a shuffle join into a broadcast join only after it has
    # measured the actual size of that side at runtime (a checked bound).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "salesq") -> SparkSession:
    """Session for tests and the bench (``local[cores]``)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # small inputs on few cores: aim for many small partitions (cluster keeps its default)
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
        .config("spark.sql.files.maxPartitionBytes", "8MB")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (if any)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a single-machine
    session (``local[...]``, as in tests) gets one of its own; a cluster, whose
    executors could not see it, gets an error."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="salesq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside are removed on leaving: for a stage that
    has stored its own results by then, and returns nothing that reads them."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete_path(spark, path)


def note_scratch(path: str) -> str:
    """Record an intermediate table for the innermost ``scratch`` (if any)."""
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def cut_lineage(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back
    (``partition_by``: one folder a value, so that filters on them prune files).

    Same guarantees as a reliable ``checkpoint()`` (survives executor loss, cuts
    the plan), but one job instead of two (an eager RDD checkpoint evaluates an
    unpersisted plan twice) and a columnar, pushdown-friendly result."""
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = note_scratch(f"{base}/salesq-cut/{uuid.uuid4().hex}")
    df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_MATERIALIZED: dict[tuple, str] = {}


def _source_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a source folder's entries."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def materialize(spark: SparkSession, key: str, build) -> DataFrame:
    """Write ``build()`` once per session as parquet under the shared checkpoint
    folder and read it back: cuts lineage (a plain scan replaces a deep plan)
    and survives executor loss, unlike a local checkpoint. ``key`` is
    ``<name>:<source folder>``; if a file of the source folder changes, the table
    is built anew."""
    import re
    import uuid
    k = (spark.sparkContext.applicationId, key, _source_version(spark, key.partition(":")[2]))
    if k not in _MATERIALIZED or not path_exists(spark, _MATERIALIZED[k]):
        base = ensure_checkpoint_dir(spark).rstrip("/")
        safe = re.sub(r"[^A-Za-z0-9_.-]+", "_", key)[-120:]
        path = f"{base}/salesq-tables/{safe}-{uuid.uuid4().hex[:12]}"
        # written as the plan's last stage deals its rows: another exchange only to
        # even out the files would shuffle every stored row once more
        build().write.mode("overwrite").parquet(path)
        _MATERIALIZED[k] = path
    return spark.read.parquet(_MATERIALIZED[k])


_REMEMBERED: dict[tuple, tuple] = {}


def remember(spark: SparkSession, key: str, build, reads):
    """``build()`` once per session, for a result of lazy frames over tables written on
    the way: kept as it is instead of being written once more. ``reads(result)`` is a
    frame that scans all those tables; if one of their folders is gone, or a file of the
    source folder (``key`` as in ``materialize``) changes, the result is built anew."""
    k = (spark.sparkContext.applicationId, key, _source_version(spark, key.partition(":")[2]))
    if k not in _REMEMBERED or not all(path_exists(spark, p) for p in _REMEMBERED[k][1]):
        result = build()
        _REMEMBERED[k] = (result, {os.path.dirname(f) for f in reads(result).inputFiles()})
    return _REMEMBERED[k][0]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for HDFS/S3/local)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the Hadoop FileSystem (nothing if missing)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Child directory names through the Hadoop FileSystem ([] if missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, hidden ones left out ([] if missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return [n for n in names if not n.startswith((".", "_"))]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a hidden name and rename it to ``path``: readers see
    it whole or not at all. False if ``path`` is there already."""
    import uuid

    from py4j.protocol import Py4JJavaError
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    hidden = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE                            # refuses a name in use, unlike FileSystem.rename on some stores
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, p, how)
        return True
    except Py4JJavaError as e:
        fs.delete(hidden, False)
        if fs.exists(p):
            return False
        raise e


def in_parallel(tasks: list, threads: int = 4) -> list:
    """Results of independent jobs (functions without arguments) submitted side by
    side, so that small ones share the executors instead of waiting for each other.
    The first failure rises after all have ended."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    inherits = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(threads) as pool:
        futures = [pool.submit(inherits(t)) for t in tasks]
    return [f.result() for f in futures]


def fingerprint(df: DataFrame, **parameters) -> str:
    """Digest of what a stage's result follows from: names, sizes and times of the files
    that ``df`` reads, its plan (with the rows themselves where it reads no file), and
    the parameters."""
    import hashlib
    import json
    spark = df.sparkSession
    files = []
    for name in sorted(df.inputFiles()):        # one entry a file, not a row
        fs, p = _fs(spark, name)
        status = fs.getFileStatus(p)
        files.append([name, status.getLen(), status.getModificationTime()])
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    what = [files, plan, None if files else df.semanticHash(), sorted(parameters.items())]
    return hashlib.sha256(json.dumps(what, default=str).encode()).hexdigest()


def stage_done(spark: SparkSession, out_dir: str, stage: str, mark: str) -> bool:
    """Did this stage finish with the same input and parameters (``fingerprint``)?"""
    path = f"{out_dir.rstrip('/')}/_stages/{stage}.txt"
    return path_exists(spark, path) and read_text(spark, path) == mark


def begin_stage(spark: SparkSession, out_dir: str, stage: str) -> None:
    """From now on the stage's output is not to be reused, until ``end_stage``."""
    delete_path(spark, f"{out_dir.rstrip('/')}/_stages/{stage}.txt")


def end_stage(spark: SparkSession, out_dir: str, stage: str, mark: str) -> None:
    publish_text(spark, f"{out_dir.rstrip('/')}/_stages/{stage}.txt", mark)
