"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesq.session import ensure_checkpoint_dir, note_scratch

# The contracts' word: a run of code points other than space and \x09-\x0D.
# ``bytes.split()`` cuts UTF-8 at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
HELD_OUT_REMAINDER, FOLDS = 2, 4


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once an application), for
    sessions whose Python workers cannot import it from their own path."""
    import tempfile
    import zipfile
    from pathlib import Path

    import salesq

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(salesq.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="salesq-ship-")) / "salesq_package.zip"  # Spark copies it from here
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return note_scratch(f"{base}/salesq-llm/{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, is evaluated once, and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text) -> F.Column:
    """Number of words of a text column (NULL: 0), inside codegen."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 4; NULL ids get NULL."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id) -> F.Column:
    return F.coalesce(fold(doc_id) == HELD_OUT_REMAINDER, F.lit(False))


class Memory(dict):
    """Answers of ``make`` by string, in two generations of at most ``size`` entries:
    when the young one is full it becomes the old one, and what is asked for again
    moves back to the young one, so entries in use stay and the size is bounded.
    Keys longer than ``longest`` characters are not kept."""

    def __init__(self, make, size: int, longest: int):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
