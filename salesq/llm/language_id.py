"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. One linear classifier a bit, on the
relative frequencies of hashed byte n-grams of the whole text, predicts that bit;
a text's language is the codeword with the least loss summed over all bits, each
bit weighted by how well it is predicted in training. Where the two least losses
lie close, the text is flagged as ambiguous.

The classifiers (regularised least squares, solved in closed form) are fitted on
at most about ``SAMPLE`` labelled documents in all, as many of each language as
there are or as its equal share allows, picked by a hash of the id; their n-gram
vectors are made by Spark. The model is ``DIMS`` numbers a bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import HELD_OUT_REMAINDER, fold, held_out

SAMPLE, DIMS, ORDERS, RIDGE, SHARP, AMBIGUOUS, SEED = 2000, 4096, (2, 3), 1e-3, 4.0, 0.5, 42
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def ngram_vector(text: bytes, dims: int = DIMS) -> np.ndarray:
    """Relative frequencies of the whole text's hashed byte n-grams, square-rooted
    and of length one, so that long and short texts weigh alike."""
    x = _LOWER[np.frombuffer(b" " + text + b" ", np.uint8)]
    counts = np.zeros(dims, np.int64)
    for at in range(0, len(x), 1 << 20):  # bounded temporaries, whole text
        part = x[at:at + (1 << 20) + max(ORDERS) - 1]
        for n in ORDERS:
            if len(part) < n:
                continue
            last = len(part) - n + 1 if at + (1 << 20) >= len(x) else 1 << 20
            h = np.full(last, n, np.uint32)
            for k in range(n):
                h = h * np.uint32(0x9E3779B1) + part[k:k + last]
            h ^= h >> np.uint32(15)
            counts += np.bincount((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - int(np.log2(dims))), minlength=dims)
    v = np.sqrt(counts)
    return (v / max(np.linalg.norm(v), 1e-9)).astype(np.float32)


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """+1/-1 codes of n classes: all splits up to 6 classes, else the random code
    (15 bits for each doubling) of the largest least distance in 200 draws."""
    if n <= 6:
        bits = np.arange(1, max(2, 2 ** max(n - 1, 0)))
        return np.array([[1] * len(bits)] + [[1 - 2 * (b >> k & 1) for b in bits] for k in range(n - 1)], dtype=float)[:n]
    rng, best = np.random.default_rng(seed), None
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], size=(n, int(np.ceil(15 * np.log2(n)))))
        gap = (m.shape[1] - (m @ m.T)[np.triu_indices(n, 1)]).min()
        if best is None or gap > best[0]:
            best = gap, m
    return best[1]


@dataclass
class Model:
    """Languages, their codewords, the bits' weights (dims x bits) and trust."""
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    trust: np.ndarray

    def decode(self, vectors: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores (0 to 1) of stacked n-gram vectors."""
        margins = vectors @ self.weights + self.offset
        # logistic loss of each codeword's bits against the margins, trusted bits first
        loss = (np.logaddexp(0, -SHARP * margins[:, None, :] * self.codes[None]) * self.trust).sum(2)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        return [self.languages[k] for k in loss.argmin(1)], (p.max(1) / p.sum(1))


def fit(vectors: np.ndarray, labels: list[str], ridge: float = RIDGE) -> Model:
    languages = sorted(set(labels))
    codes = codewords(len(languages))
    y = codes[[languages.index(x) for x in labels]]
    # each language weighs the same, whatever its number of rows
    w = np.sqrt(np.array([1 / labels.count(x) for x in labels]) * len(labels) / len(languages))[:, None]
    x = np.hstack([vectors, np.ones((len(vectors), 1), np.float32)]).astype(np.float64) * w
    alpha = np.linalg.solve(x @ x.T + ridge * len(x) / len(languages) * np.eye(len(x)), y * w)
    full = x.T @ alpha
    right = (np.sign(np.hstack([vectors, np.ones((len(vectors), 1))]) @ full) == y).mean(0)
    trust = np.maximum(2 * right - 1, 1e-3)
    return Model(languages, codes, full[:-1].astype(np.float32), full[-1].astype(np.float32), trust / trust.sum() * len(trust))


def train(docs: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fits a model on rows with text, language and an id outside the held-out
    fold; None if there is none."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id")) != HELD_OUT_REMAINDER))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return None
    share = max(1, sample // len(counts))
    chance = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, share / n)))))
    u = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1e6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [ngram_vector(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(v, pa.binary())], ["lang", "v"])

    picked = rows.filter(u < chance[F.col("lang")]).select("lang", F.col("text").cast("binary").alias("text"))
    got = sorted((r.lang, bytes(r.v)) for r in picked.mapInArrow(run, "lang string, v binary").collect())
    if not got:
        return None
    return fit(np.stack([np.frombuffer(v, np.float32) for _, v in got]), [k for k, _ in got])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds struct ``_language`` of ``lang_pred``, ``score`` and ``ambiguous``.

    ``und`` with score 0 and flagged: NULL text, no letter, or no model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS numbers a bit

    @pandas_udf("lang_pred string, score double, ambiguous boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        m, out = shared.value, []
        for at in range(0, len(texts), 256):
            part = list(texts.iloc[at:at + 256])
            known = [k for k, t in enumerate(part) if t is not None]
            got: list = [(UNKNOWN, 0.0, True)] * len(part)
            if m is not None and known:
                names, p = m.decode(np.stack([ngram_vector(part[k]) for k in known]))
                for k, name, q in zip(known, names, p, strict=True):
                    got[k] = (name, float(q), bool(q < AMBIGUOUS))
            out += got
        return pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    letters = F.when(F.col(text).rlike(r"\p{L}"), F.col(text).cast("binary"))
    return docs.withColumn("_language", udf(letters))


def identify(docs: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` of every row.

    Learns from rows outside the held-out fold only. NULL or letterless texts are
    ``und`` with score 0; repeated rows and NULL ids (never learned from, not held
    out) keep their rows; with no labelled row all are ``und``; an empty table
    gives an empty result. Whole texts of any length."""
    model = train(docs, sample, doc_id, text, lang)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return predict(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_language.*")


def accepted(docs: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is known and not ambiguous; columns as given."""
    model = train(docs, sample, doc_id, text, lang)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(text).alias("text"))
    return predict(rows, model).filter("not _language.ambiguous").select("d.*")
