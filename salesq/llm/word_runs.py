"""Periodic runs of words, by Lyndon arrays from the first phase of a suffix sorter.

A run is a longest stretch of words with smallest period p and at least
``min_exponent`` periods. Each holds a Lyndon word of length p, under the order of
the words or its reverse, that is the longest Lyndon word at its place, so the runs
come from two Lyndon arrays:

1. ``lyndon_array`` is phase one of Baier's suffix sorting: suffixes are grouped by
   their first word; from the highest group down, each suffix of a group refines the
   group of the nearest position before it in a lower one, in turn of how many of
   the group's suffixes lead there. A group's context, when its turn comes, is the
   longest Lyndon prefix of its suffixes; only its length is kept. The end of the
   text is below all words in both orders.
2. Each root [i, i+p) is extended by the longest common extensions of i and i+p to
   the right and to the left; a root inside a run of its period found before is not
   extended again, so a run is walked over once.

Only stretches that can hold a run are sorted: in a run of L >= max(length, e*p)
words, k = length*(1-2/e)+1 words in a row occur twice or more (one period on), so
a run lies inside one stretch whose windows of k words each occur twice in the
text. Windows are compared by hashes; a clash only adds a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_EXPONENT = 24, 3
MIX, OUT_BYTES = 0x9E3779B97F4A7C15, 32_000_000


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position of ``ranks`` (integers)."""
    n = len(ranks)
    highest_first = sorted(set(ranks), reverse=True)
    group_of_rank = {r: g for g, r in enumerate(highest_first)}
    group = [group_of_rank[r] for r in ranks]                # group of each suffix
    members: list[list[int]] = [[] for _ in highest_first]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(members)                             # length of each group's context
    lower = [*range(1, len(members)), -1]                    # next group in descending order
    higher = [*range(-1, len(members) - 1)]
    done, before, length = bytearray(n), [0] * n, [0] * n
    g = 0 if n else -1
    while g >= 0:
        size, led_to = context[g], {}
        for i in members[g]:
            if group[i] != g:                                # moved up since it was listed
                continue
            j = i - 1
            while j >= 0 and done[j]:                        # nearest position in a lower group
                j = before[j]
            before[i], done[i], length[i] = j, 1, size
            if j >= 0:
                led_to[j] = led_to.get(j, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for j, times in led_to.items():
            split.setdefault((-times, group[j]), []).append(j)
        for (times, old), moved in sorted(split.items()):    # most suffixes first: it ends up highest
            new = len(members)
            members.append(moved)
            context.append(context[old] - times * size)
            up = higher[old]                                 # the new group comes right above the old one
            higher.append(up)
            lower.append(old)
            higher[old] = new
            lower[up] = new
            for j in moved:
                group[j] = new
        g = lower[g]
    return length


def _common(a: np.ndarray, i: int, j: int, most: int) -> int:
    """Length, up to ``most``, of the longest common extension of a[i:] and a[j:]:
    slices of doubling length are compared, then the first difference is found."""
    done, width = 0, 16
    while done < most:
        width = min(width, most - done)
        differ = a[i + done:i + done + width] != a[j + done:j + done + width]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done += width
        width *= 2
    return most


def runs_of_stretch(words: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of each run of a sequence of integers, sorted."""
    n = len(words)
    backward = words[::-1]
    plain = words.tolist()
    found = set()
    for ranks in (plain, [-r for r in plain]):
        reach: dict[int, int] = {}          # period -> end of the last run found
        for i, p in enumerate(lyndon_array(ranks)):
            # of a run, the first root under the right order has two periods or more in it
            if i + p >= n or plain[i] != plain[i + p] or i + p <= reach.get(p, 0):
                continue
            right = _common(words, i, i + p, n - i - p)
            left = _common(backward, n - i, n - i - p, i) if i and plain[i - 1] == plain[i + p - 1] else 0
            length = left + p + right
            if length >= 2 * p:
                reach[p] = i + p + right
                if length >= max(min_length, min_exponent * p):
                    found.add((i - left, length, p))
    return sorted(found)


def _stretches(words: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Longest stretches whose windows of ``k`` words all occur twice or more."""
    n = len(words) - k + 1
    if n < 2:
        return []
    hashes = np.zeros(n, np.uint64)
    for j in range(k):
        hashes = (hashes ^ words[j:j + n].astype(np.uint64)) * np.uint64(MIX)
        hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(n + 2, bool)
    again[order[1:][same] + 1] = True
    again[order[:-1][same] + 1] = True
    edges = np.flatnonzero(again[1:] != again[:-1])
    return [(int(a), int(b) + k - 1) for a, b in zip(edges[::2], edges[1::2])]


def runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of words, by start, then
    period; ``min_exponent`` is 2 or more."""
    if len(words) < min_length:
        return []
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    k = max(1, min_length * (min_exponent - 2) // min_exponent + 1)
    found = []
    for start, end in _stretches(ids, k):
        if end - start >= min_length:
            found += [(start + s, length, p) for s, length, p in runs_of_stretch(ids[start:end], min_length, min_exponent)]
    return sorted(found)


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words without those that some run holds after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, p in found:
        keep[start + p:start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
           min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs (an array of
    ``start, length, period``, by start, then period) and its words, joined by single
    spaces, without each run's repeats.

    NULL, empty and blank texts have no words, no runs and an empty collapsed text;
    repeated rows and NULL ids keep their rows; an empty table gives an empty result;
    other columns, whatever their names, are not read. Whole texts of any length."""
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            start, counts, found, short, size = 0, [], [], [], 0
            for k in range(len(texts)):
                words = (texts[k].as_py() or "").encode().split()   # cuts at exactly the contract's six bytes
                r = runs(words, min_length, min_exponent)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in r])
                short.append(b" ".join(collapse(words, r)).decode())
                size += len(short[-1])
                if size >= OUT_BYTES or k == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").slice(start, k + 1 - start), pa.array(counts, pa.int64()),
                         pa.array(found, pa.list_(kind)), pa.array(short, pa.string())],
                        ["doc_id", "n_words", "runs", "collapsed"])
                    start, counts, found, short, size = k + 1, [], [], [], 0

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    of = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {of}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                                "collapsed string")


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` as the contract's query reads them: where crc32 of the id as
    text ends in 0, the words from one on repeat with a period; other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.coalesce(F.size("w"), F.lit(0))
    shaped = chosen.withColumn("n", n).withColumn("a", (F.col("g") % F.nullif(F.col("n"), F.lit(0))).cast("int")).withColumn(
        "p", (F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int"))
    rest = F.col("n") - F.col("a")
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), 1, rest)
    periodic = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return shaped.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``detect``'s rows."""
    # greatest exact length/period first: a/b against c/d as a*d against c*b; ties: smallest start, then period
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (b, r) ->
        CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                    F.col("best.period").alias("period"),
                    F.floor(F.expr("best.length * 1000 div best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
