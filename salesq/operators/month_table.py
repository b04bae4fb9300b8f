"""A month-partitioned fact whose upserts are published whole or not at all.

A version is one small file, ``_versions/<n>.json``, that names the folder of every
month's rows and of every index bucket; its size grows with the months and buckets,
never with the rows. An upsert writes the months it touches and the index buckets of
its keys into folders of a fresh name and publishes the next version last, by
renaming a finished file to a name that must be free. A reader takes the newest
version, so it sees all rows of the old or of the new state; a job that dies before
the rename leaves folders that nothing names, and running the batch again repairs
everything. Of two writers at once the second fails and reads the newer state when
it is run again.

The index holds ``(key, month)`` in buckets of the key's hash. A batch reads only
its own keys' buckets to find the months its rows must leave, never the keys of the
whole fact.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesq.operators.load import FACT_VALUE_COLS, deal_by_month, dedupe_latest, first_transactions, merge_months
from salesq.session import cut_lineage, delete_path, list_dirs, list_files, publish_text, read_text, scratch

BUCKETS = 64
NO_DATE = "__HIVE_DEFAULT_PARTITION__"      # folder name of rows without a date


class ConcurrentUpdate(RuntimeError):
    """Another writer published the version this upsert was to become."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    months: dict = field(default_factory=dict)       # month (None: no date) -> folder of rows
    index: dict = field(default_factory=dict)        # bucket -> folder of (key, month)
    applied: dict = field(default_factory=dict)      # name of a source -> its last batch

    def text(self) -> str:
        return json.dumps({"number": self.number, "index": {str(b): f for b, f in self.index.items()},
                           "months": [[m, f] for m, f in self.months.items()], "applied": self.applied})

    @staticmethod
    def parse(text: str) -> Version:
        v = json.loads(text)
        return Version(v["number"], {m: f for m, f in v["months"]}, {int(b): f for b, f in v["index"].items()}, v["applied"])


class MonthTable:
    """The fact at ``path``; ``schema`` is that of its rows without the month."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "transaction_id",
                 date_col: str = "transaction_date", month: str = "year_month", buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.date_col, self.month, self.buckets = key, date_col, month, buckets

    # ---------------------------------------------------------------- versions
    def _version_path(self, number: int) -> str:
        return f"{self.path}/_versions/{number:010d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_files(self.spark, f"{self.path}/_versions") if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The newest version (empty: version 0), or an older one that is still kept."""
        if number is None:
            known = self.versions()
            if not known:
                return Version()
            number = known[-1]
        return Version.parse(read_text(self.spark, self._version_path(number)))

    # ---------------------------------------------------------------- reading
    def _rows(self, version: Version, months: list | None = None) -> DataFrame:
        wanted = [m for m in version.months if months is None or m in months]
        full = T.StructType([*self.schema.fields, T.StructField(self.month, T.StringType())])
        if not wanted:
            return self.spark.createDataFrame([], full)
        out = None
        for folder in sorted({version.months[m] for m in wanted}):      # one frame a publishing upsert, not one a month
            paths = [f"{self.path}/{folder}/{self.month}={m or NO_DATE}" for m in wanted if version.months[m] == folder]
            part = self.spark.read.schema(full).option("basePath", f"{self.path}/{folder}").parquet(*paths)
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, number: int | None = None, months: list | None = None) -> DataFrame:
        """The rows of a version (default: the newest) with their month; ``months``
        names the only ones to look at (None: rows without a date)."""
        return self._rows(self.version(number), months)

    def _index(self, version: Version, buckets: list[int]) -> DataFrame:
        schema = T.StructType([T.StructField(self.key, self.schema[self.key].dataType), T.StructField(self.month, T.StringType()),
                               T.StructField("_bucket", T.IntegerType())])
        by_folder: dict[str, list[str]] = {}
        for b in buckets:
            if b in version.index:
                by_folder.setdefault(version.index[b], []).append(f"{self.path}/{version.index[b]}/_bucket={b}")
        out = self.spark.createDataFrame([], schema)
        for folder, paths in sorted(by_folder.items()):
            out = out.unionByName(self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}").parquet(*paths))
        return out

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int").alias("_bucket")

    # ---------------------------------------------------------------- writing
    def _store(self, df: DataFrame, folder: str, by: str) -> None:
        # the rows lie by month or bucket: few files each
        df.write.partitionBy(by).parquet(f"{self.path}/{folder}")

    def _indexed(self, src: DataFrame, version: Version, buckets: list[int]) -> DataFrame:
        """The rows of ``buckets`` as ``src`` leaves them: its keys, and those of now that it
        has not. They are dealt by bucket once: for the search and for the files.
        ``_moved`` marks the keys that come from another month."""
        both = src.select(self.key, self.month, self._bucket(), F.lit(1).alias("_new"))
        if any(b in version.index for b in buckets):
            both = both.unionByName(self._index(version, buckets).withColumn("_new", F.lit(0)))
        # by the bucket alone, and the window asks for no other exchange
        dealt = both.repartition("_bucket")
        newest = Window.partitionBy("_bucket", self.key).orderBy(F.col("_new").desc())
        moved = F.lead("_new").over(newest).isNotNull() & ~F.lead(self.month).over(newest).eqNullSafe(F.col(self.month))
        return (dealt.withColumn("_place", F.row_number().over(newest)).withColumn("_moved", moved)
                .filter("_place = 1").drop("_place", "_new"))

    def _moved(self, index: str) -> DataFrame:
        """Keys that the batch of this index folder moves, with their new month (written)."""
        schema = T.StructType([T.StructField(self.key, self.schema[self.key].dataType), T.StructField(self.month, T.StringType()),
                               T.StructField("_moved", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])
        return cut_lineage(self.spark.read.schema(schema).parquet(f"{self.path}/{index}").filter("_moved").select(self.key, self.month))

    def _named(self, folder: str, by: str) -> dict:
        """Months or buckets that a finished write holds."""
        names = [d.partition("=")[2] for d in list_dirs(self.spark, f"{self.path}/{folder}") if d.startswith(f"{by}=")]
        return {(None if n == NO_DATE else n): folder for n in names}

    def _publish(self, version: Version) -> None:
        if not publish_text(self.spark, self._version_path(version.number), version.text()):
            raise ConcurrentUpdate(f"version {version.number} of {self.path} is there already: run the batch again")

    def plan(self, source: DataFrame, version: Version | None = None) -> tuple[list, list[int]]:
        """``(months, buckets)`` that an upsert of ``source`` (one row a key, with its
        month) touches: months of its rows and of the same keys' rows now."""
        version = version or self.version()
        buckets = sorted(r[0] for r in source.select(self._bucket()).distinct().collect())      # at most ``buckets``
        months = [r[0] for r in source.select(self.month).distinct().collect()]                 # one a month
        if set(version.months) <= set(months):      # no key can be in a month besides
            return sorted(months, key=lambda m: (m is None, m)), buckets
        now = self._index(version, buckets).join(source.select(self.key), self.key, "left_semi").select(self.month)
        months = [r[0] for r in source.select(self.month).unionByName(now).distinct().collect()]   # one a month
        return sorted(months, key=lambda m: (m is None, m)), buckets

    def upsert(self, source: DataFrame, load_ts=None, order_by: list[str] | None = None,
               source_name: str | None = None, batch: int | None = None) -> list:
        """Upsert by key (L4's rules) and publish the next version; returns the touched
        months, those without a date as None last.

        ``source_name`` and ``batch`` name a numbered batch of a stream: one that is not
        above the last published of its source is not applied again. Rows without a key
        are left out (report them with ``null_key_rejects``). A batch without rows
        publishes nothing. ``source`` is read several times: pass a stored or persisted frame."""
        version = self.version()
        if source_name is not None and batch is not None and batch <= version.applied.get(source_name, -1):
            return []
        carried = [c for c in order_by or [] if c not in FACT_VALUE_COLS and c != self.key]
        month = F.date_format(F.col(self.date_col), "yyyy-MM")
        with scratch(self.spark):
            src = (dedupe_latest(source.select(self.key, *FACT_VALUE_COLS, *carried), self.key, order_by)
                   .drop(*carried).withColumn(self.month, month))
            months, buckets = self.plan(src, version)
            if not months:
                return []
            tag = f"{version.number + 1:010d}-{uuid.uuid4().hex[:12]}"
            rows, index = f"rows-{tag}", f"index-{tag}"
            self._store(self._indexed(src, version, buckets), index, "_bucket")
            alike = all(src.schema[f.name].dataType == f.dataType for f in self.schema.fields if f.name in src.columns)
            if alike and not set(months) & set(version.months):
                merged = deal_by_month(first_transactions(src, load_ts).withColumn(self.month, month), self.month, [src], self.key).drop("_salt")
            else:
                merged = merge_months(self._rows(version, months), src, self._moved(index), self.month, load_ts)
            self._store(merged, rows, self.month)
        stays = {m: f for m, f in version.months.items() if m not in months}    # a month left without rows goes
        other = {b: f for b, f in version.index.items() if b not in buckets}
        applied = version.applied | ({source_name: batch} if source_name is not None and batch is not None else {})
        self._publish(Version(version.number + 1, stays | self._named(rows, self.month),
                              other | {int(b): f for b, f in self._named(index, "_bucket").items()}, applied))
        return months

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all versions but the newest ``keep`` and every folder that none of
        them names, also those of upserts that died. Not to be run beside a writer.
        Returns the folders."""
        known = self.versions()
        kept = [self.version(n) for n in known[-keep:]]
        named = {f for v in kept for f in (*v.months.values(), *v.index.values())}
        gone = [d for d in list_dirs(self.spark, self.path) if d.startswith(("rows-", "index-")) and d not in named]
        for n in known[:-keep]:
            delete_path(self.spark, self._version_path(n))
        for d in gone:
            delete_path(self.spark, f"{self.path}/{d}")
        # months and buckets that later versions replaced inside a folder still in use
        for folder in sorted(named):
            for by, used in ((self.month, {m or NO_DATE for v in kept for m, f in v.months.items() if f == folder}),
                             ("_bucket", {str(b) for v in kept for b, f in v.index.items() if f == folder})):
                for d in list_dirs(self.spark, f"{self.path}/{folder}"):
                    if d.startswith(f"{by}=") and d.partition("=")[2] not in used:
                        delete_path(self.spark, f"{self.path}/{folder}/{d}")
        return gone


def fact_table(spark: SparkSession, path: str, source: DataFrame, buckets: int = BUCKETS) -> MonthTable:
    """A ``MonthTable`` for facts of ``source``'s types."""
    types = {f.name: f.dataType for f in source.schema.fields}
    fields = [T.StructField(c, types[c]) for c in ("transaction_id", *FACT_VALUE_COLS)]
    stamps = [T.StructField(c, T.TimestampNTZType()) for c in ("created_at", "updated_at")]
    return MonthTable(spark, path, T.StructType(fields + stamps), buckets=buckets)
