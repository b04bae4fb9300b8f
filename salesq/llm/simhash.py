"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint holds, per bit, the majority over the XXH64 (seed 42) of
every 3-word shingle of the whole text. Two fingerprints at most ``distance``
bits apart agree up to ``distance // 2`` bits in one of their 32-bit halves, so
each half is a table key, the small Hamming ball around a half is enumerated
(for distance 3: the half itself and its one-bit neighbours) and looked up in
the table, and the whole 64 bits of each match are compared. All work after the
fingerprints runs on distinct fingerprints: a group of copies is one row.

A neighbour's flips are enumerated upward only (0 to 1): of two halves one bit
apart exactly one reaches the other that way, so each pair is met once a half.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import written
from salesq.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text; NULL or no word: 0."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:] or ends[-1:], strict=False)]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):  # bounded bit matrix, whole text
        part = np.array(hashes[k:k + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                     name: str = "_fingerprint") -> DataFrame:
    """Adds the fingerprint (long) of every whole text."""
    @pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return docs.withColumn(name, udf(F.col(text).cast("binary")))


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints(f)`` distinct longs -> linked pairs ``(a, b)``, each once or twice.

    ``distance`` up to 3 (one flip in a half) is what two halves allow."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one flip cover distances 0 to 3")
    halves = F.array(F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("f", 32).alias("key")),
                     F.struct(F.lit(1).alias("half"), F.col("f").bitwiseAND(0xFFFFFFFF).alias("key")))
    table = prints.select("f", F.explode(halves).alias("s")).select("f", "s.half", "s.key")
    ball = F.array(F.col("key"))
    if distance >= 2:
        ball = F.expr("concat(array(key), transform(filter(sequence(0, 31), i -> (shiftright(key, i) & 1) = 0), "
                      "i -> key | shiftleft(1L, i)))")
    probes = table.select(F.col("f").alias("a"), "half", F.col("key").alias("own"), F.explode(ball).alias("key"))
    found = probes.join(table.withColumnRenamed("f", "b"), ["half", "key"])
    return (found.filter((F.col("own") != F.col("key")) | (F.col("a") < F.col("b")))
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
           distance: int = DISTANCE) -> DataFrame:
    """One row per input row: ``doc_id``, ``t`` (hash of the text), ``f`` (the
    fingerprint) and ``component_id``, the least ``doc_id`` reachable through links."""
    rows = written(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                    "text", shingle, "f").select("doc_id", F.xxhash64("text").alias("t"), "f"), "prints")
    classes = written(rows.groupBy("f").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = components(links(classes.select("f"), distance))
    rooted = (classes.join(roots.withColumnRenamed("node", "f"), "f", "left")
              .select("f", "least_id", F.coalesce("root", "f").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    member = written(rooted.join(named, "root").select("f", "root", "component_id"), "members")
    return rows.join(member, "f").select("doc_id", "t", "f", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``.

    NULL, empty and blank texts have fingerprint zero and link with one another
    like any other. Repeated rows stay, each with its class. A NULL ``doc_id``
    never names a class unless all ids of its class are NULL. An empty table
    gives an empty result; other columns, whatever their names, are not read."""
    return groups(docs, doc_id, text, shingle, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """The documents with one row of each group left: that of the least
    ``doc_id`` (NULL last; of rows that repeat an id, the least text hash; of
    equal rows any one). Columns are as given, whatever their names."""
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("t").alias("t"))
    winners = (groups(docs, doc_id, text, shingle, distance).groupBy("root").agg(F.min(who).alias("w"))
               .select("root", F.col("w.id").alias("id"), F.col("w.t").alias("t")))
    winners = winners.withColumn("key", F.xxhash64("id", "t"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(doc_id).alias("doc_id"),
                       F.xxhash64(text).alias("text_hash")).withColumn("key", F.xxhash64("doc_id", "text_hash"))
    kept = rows.alias("r").join(winners.alias("w"), F.expr("r.key = w.key and r.doc_id <=> w.id and r.text_hash = w.t"))
    one = Window.partitionBy("r.key", "root").orderBy("text_hash")  # equal rows of one id; the join's own key
    return kept.select("d", F.row_number().over(one).alias("n")).filter("n = 1").select("d.*")
