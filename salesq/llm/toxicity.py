"""Toxicity by compression distance.

Two zstandard dictionaries of the same size are made from labelled texts: one of
what marks toxic documents (the pieces with the largest likelihood ratio of their
document counts, strongest last, where references are cheapest) and one of ordinary
words. A piece is a word or a beginning of words, so a stem whose inflections are
each too rare to tell still counts with all of them; of pieces that begin alike only
the strongest is taken. Copies of a text, whole or in part, are one witness: texts in
which a piece comes first between the same two neighbours count once for it.
Each window of a text is compressed with either; the bytes the toxic dictionary saves
over the ordinary one are its distance. A window is one word behind a short lead that
both dictionaries hold before each entry (one match takes the lead and the word's
beginning, so even a short mark's saving shows); partial matches count, so variants of
a marked word save bytes too. The ordinary words that begin most like the marks come
first, so a shared beginning alone saves nothing. Zstandard's own dictionary trainer was measured and
finds common syllables instead of rare marks (README).

A document's numbers of windows beyond each threshold, in bytes saved and in the
share of the window saved, go through a logistic calibration, fitted on labelled documents that made no dictionary. Both samples are
bounded (``SAMPLE`` rows a class and half, by a hash of the id), and the calibration
weighs the classes as all labelled rows do; the counting of words and windows runs
in Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import HELD_OUT_REMAINDER, fold, held_out

SAMPLE, MARKS, DICTIONARY, THRESHOLDS, CUT, MEMORY, SEED = 2000, 400, 4096, 8, 0.3, 300_000, 42
LEAST_RATIO, LEAST_DOCS, RIDGE = 15.0, 3, 1.0
STEM, PIECES = (4, 12), 20       # bytes of a beginning; ranked pieces looked at for each mark
_LEAD = bytes(range(1, 9)) + b"\x0b\x0c"
# A-Z to a-z; other ASCII that is neither letter nor digit to a space
_FOLD = bytes(c + 32 if 65 <= c < 91 else c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else 32 for c in range(256))


def windows(text: bytes | None) -> list[bytes]:
    """The windows of a whole text: its words, folded (letters beyond A-Z to small ones as well)."""
    if not text:
        return []
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_FOLD).split()


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None  # of features, the last is the offset
    prior: float = 0.0


class Compressor:
    """Bytes saved by the toxic dictionary, remembered for each distinct window."""

    def __init__(self, model: Model):
        how = zstandard.ZstdCompressionParameters(
            window_log=14, hash_log=12, chain_log=13, search_log=5, min_match=3, target_length=16,
            strategy=zstandard.STRATEGY_BTOPT, write_checksum=False, write_content_size=False, write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self.toxic, self.ordinary = (
            zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(
                d + _LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress for d in (model.toxic, model.ordinary))
        self.memory: dict[bytes, int] = {}

    def saved(self, window: bytes) -> int:
        got = self.memory.get(window)
        if got is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            data = _LEAD + b" " + window + b" "
            bytes_saved = min(max(len(self.ordinary(data)) - len(self.toxic(data)), 0), THRESHOLDS)
            share = min(THRESHOLDS * bytes_saved // (len(window) + 1), THRESHOLDS)
            got = self.memory[window] = bytes_saved * (THRESHOLDS + 1) + share
        return got

    def counts(self, text: bytes | None) -> np.ndarray:
        """Windows in all, those that save at least 1, 2, ... bytes, and those that
        save at least 1, 2, ... parts of ``THRESHOLDS`` of themselves."""
        words = windows(text)
        both = np.bincount(np.fromiter(map(self.saved, words), np.int64, len(words)), minlength=(THRESHOLDS + 1) ** 2)
        both = both.reshape(THRESHOLDS + 1, THRESHOLDS + 1)
        by_bytes, by_share = (both.sum(axis)[::-1].cumsum()[::-1] for axis in (1, 0))
        return np.concatenate([by_bytes, by_share[1:]])


def features(counts: np.ndarray) -> np.ndarray:
    """Of stacked window counts: their logarithms and their shares of the text."""
    share = counts[:, 1:] / np.maximum(counts[:, :1], 1)
    return np.hstack([np.log1p(counts), np.log1p(100 * share), np.ones((len(counts), 1))])


def calibrate(x: np.ndarray, y: np.ndarray, share: float, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method, rows weighted so that toxic ones
    weigh ``share`` of all, whatever their share of the sample."""
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _dictionary(words: list[bytes], most: int = DICTIONARY) -> bytes:
    """Up to ``most`` bytes of words, each behind the lead as in a window, the first of the list last."""
    out, size = [], 0
    for w in words:
        entry = _LEAD + b" " + w + b" "
        if size + len(entry) > most:
            break
        out.append(entry)
        size += len(entry)
    return b"".join(reversed(out))


def likest(marks: list[bytes], plain: list[bytes]) -> list[bytes]:
    """Ordinary words, for each mark first the one that begins most like it, then the others in their order."""
    begun: dict[bytes, bytes] = {}
    for w in plain:
        for k in range(len(w) + 1):
            begun.setdefault(w[:k], w)
    like = (next(begun[m[:k]] for k in range(len(m), -1, -1) if m[:k] in begun) for m in marks if plain)
    return list(dict.fromkeys([*like, *plain]))


def beginnings(word: bytes) -> list[bytes]:
    """The proper beginnings of ``STEM`` bytes, cut between characters."""
    least, most = STEM
    return [word[:k] for k in range(least, min(len(word), most + 1)) if word[k] & 0xC0 != 0x80]


def pieces(words: set[bytes]) -> list[bytes]:
    """The words and their beginnings."""
    return sorted(words | {p for w in words for p in beginnings(w)})


def passages(words: list[bytes]) -> dict[bytes, int]:
    """Where each piece of a text comes first: a hash of that word and its neighbours."""
    first: dict[bytes, int] = {}
    for k, w in enumerate(words):
        first.setdefault(w, k)
    out: dict[bytes, int] = {}
    for w, k in first.items():
        here = zlib.crc32(b" ".join(words[max(k - 1, 0):k + 2]))
        for p in (w, *beginnings(w)):
            out.setdefault(p, here)
    return out


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, toxic in zip(b.column("text"), b.column("toxic"), strict=True):
            words = windows(text.as_py())
            whole, place = set(words), passages(words)
            found = pieces(whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array([p in whole for p in found], pa.bool_()),
                 pa.array([toxic.as_py()] * len(found), pa.int64()), pa.array([place[p] for p in found], pa.int64())],
                ["word", "whole", "toxic", "passage"])


def strongest(ranked: list[bytes], most: int) -> list[bytes]:
    """Pieces in their order, without those that begin like one taken before or that one begins with."""
    taken: dict[bytes, None] = {}
    begun: set[bytes] = set()           # beginnings of what was taken
    for p in ranked:
        if p in begun or any(p[:k] in taken for k in range(1, len(p))):
            continue
        taken[p] = None
        begun.update(p[:k] for k in range(1, len(p) + 1))
        if len(taken) == most:
            break
    return list(taken)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic") -> Model:
    """Learns from labelled rows whose id lies outside the held-out fold; without
    both classes among them every score is the share of toxic labels (0 if none)."""
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT_REMAINDER))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    half = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2)).alias("half")
    known = known.select("doc_id", "toxic", half)
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    model = Model(b"", b"", None, totals.get(1, 0) / max(1, sum(totals.values())))
    if len(totals) < 2:
        return model
    picked = None
    for c in (0, 1):
        for h in (0, 1):
            part = known.filter((F.col("toxic") == c) & (F.col("half") == h)).orderBy(F.xxhash64("doc_id")).limit(sample)
            picked = part if picked is None else picked.unionByName(part)
    # at most four times ``sample`` rows of three numbers: a proven bound
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(picked), "doc_id")
    made = rows.filter("half = 0")
    n = {r.toxic: r["count"] for r in made.groupBy("toxic").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not (n0 and n1):
        return model
    # copies are one witness: a piece counts once for all texts in which it comes first in the same passage
    words = (made.select("text", F.col("toxic").cast("long").alias("toxic"))
             .mapInArrow(_pieces_of, "word binary, whole boolean, toxic long, passage long")
             .groupBy("word", "toxic", "passage").agg(F.max("whole").alias("whole")).groupBy("word").agg(F.sum("toxic").alias("a"), (F.count("toxic") - F.sum("toxic")).alias("b"), F.max("whole").alias("whole")))

    def term(k, m, p):
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(k < m, (m - k) * F.log(1 - p)).otherwise(0.0)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    both = (a + b) / (n0 + n1)
    ratio = 2 * (term(a, n1, a / n1) + term(b, n0, b / n0) - term(a, n1, both) - term(b, n0, both))
    marked = words.filter((F.col("a") >= LEAST_DOCS) & (a / n1 > 4 * b / n0)).withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
    # of equal ratios the longest: a whole stem rather than its beginning
    ranked = marked.orderBy(F.desc("ratio"), F.desc(F.octet_length("word")), "word").limit(PIECES * MARKS).select("word").collect()
    marks = strongest([bytes(r.word) for r in ranked], MARKS)
    plain = [bytes(r.word) for r in words.filter(F.col("whole") & (a / n1 <= 2 * b / n0)).orderBy(F.desc("b"), "word").limit(4 * MARKS).select("word").collect()]
    model.toxic = _dictionary(marks)
    model.ordinary = _dictionary(likest(marks, plain), len(model.toxic))
    counted = window_counts(rows.filter("half = 1"), model).select("toxic", "counts").collect()
    y = np.array([r.toxic for r in counted], float)
    if 0 < y.sum() < len(y):
        order = np.lexsort(np.array([r.counts for r in counted]).T)  # sums in one order, whatever the tasks did
        model.weights = calibrate(features(np.array([r.counts for r in counted], float)[order]), y[order], model.prior)
    return model


def window_counts(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``counts`` to rows with a binary ``text``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY bytes

    @pandas_udf("array<long>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = Compressor(sent.value)
        for texts in batches:
            yield pd.Series([c.counts(t) for t in texts], dtype=object)
    return rows.withColumn("counts", count("text"))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "_score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; NULL texts as empty ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        c = Compressor(m)
        for texts in batches:
            if m.weights is None or not len(texts):
                yield pd.Series(np.full(len(texts), m.prior))
                continue
            x = features(np.stack([c.counts(t) for t in texts]).astype(float))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30))))
    return docs.withColumn(name, score(F.col(text).cast("binary")))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    NULL and empty texts have the score of a text without windows; repeated rows
    and NULL ids (never learned from, not held out) keep their rows; labels of
    unknown documents, NULL labels and labels other than 0 and 1 are passed over;
    an empty table gives an empty result. Other columns are not read."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = train(docs, labels, sample, doc_id, text)
    return with_score(rows, model, "text", "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents scored below ``cut``; columns as given, whatever their names."""
    model = train(docs, labels, sample, doc_id, text)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(text).alias("text"))
    return with_score(rows, model, "text", "score").filter(F.col("score") < cut).select("d.*")
