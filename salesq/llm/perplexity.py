"""Quality rules: base rules and n-gram perplexity bands per language.

The language model is a modified Kneser-Ney model of byte 5-grams over a text's
words joined by single spaces, one model per language and fold: distinct texts are
dealt into two folds by a hash and each is scored by the model of the other fold, so
a text never vouches for itself, nor do its copies: equal texts of a language are one
text, counted and scored once, whose result goes to every row. (Word n-grams were
measured first: more than half of all word pairs are distinct, which would move
several times the corpus.)

1. ``pack``: tasks gather documents into blocks of about ``BLOCK`` bytes and write,
   per block, its rows and its compressed distinct texts with their digests.
2. ``owners``: of the blocks that hold a digest, one counts and scores its text. The
   fold is hashed from the smallest id of the copies and that row's text.
3. ``count``: per block, the sorted array of the distinct n-gram codes of its own
   texts with their counts in either fold. A code holds the five bytes and a hash of
   the language: a collision-free hash within a language.
4. ``model``: Spark sums the counts and derives the lower orders' continuation
   counts, discounts, interpolation weights and probabilities by joins on codes.
5. ``score``: each block's distinct codes fetch their log-probabilities by a join
   and return to their block as sorted hash arrays with values (in steps of
   1/``STEPS``), where every position of every text finds its own by binary search.
   Blocks are stored in buckets by block, so that the texts are not shuffled.
6. ``spread``: every block fetches the results of its digests for its rows.

No part of the model is collected or broadcast; it grows with the corpus.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesq.llm.common import held_out, shared_path, written

ORDER, BLOCK, PART, LEVEL, STEPS, HELD = 5, 24_000_000, 2_000_000, 6, 2000, 2_000_000
ROW = 64  # bytes that a row counts for besides its text
SPREAD, SHORT = (8.0, 6.0), 440  # quartile distances below and above without labels; bytes at which a band is wider by sqrt(2)
CUTS, CUT = 64, 0.25  # spreads tried by the calibration, in quartile distances
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
NO_LANGUAGE = ""
_CODE_BITS = 8 * ORDER
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_RANDOM = np.random.default_rng(5).integers(1, 2 ** 63, 256, dtype=np.uint64)
_STEP, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Growing tables of powers modulo 2**64, shared by a task's texts."""

    def __init__(self):
        self.up, self.down = _powers(_STEP, 1 << 16), _powers(_BACK, 1 << 16)

    def upto(self, n: int):
        if n > len(self.up):
            self.up, self.down = _powers(_STEP, 2 * n), _powers(_BACK, 2 * n)
        return self.up[:n], self.down[:n]


def repeated_words(line: bytes, powers: Powers) -> int:
    """Words of single-spaced ``line`` that lie in a ``WINDOW``-word window found
    at least twice. Windows are compared by a random-table hash of their bytes."""
    b = np.frombuffer(line, np.uint8)
    spaces = np.flatnonzero(b == 32)
    n = len(spaces) + 1
    if n <= WINDOW:
        return 0
    up, down = powers.upto(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_RANDOM[b] * up[:-1], out=sums[1:])
    starts = np.concatenate([[0], spaces + 1])[:n - WINDOW + 1]
    ends = np.concatenate([spaces, [len(b)]])[WINDOW - 1:]
    h = (sums[ends] - sums[starts]) * down[starts]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    hit = np.zeros(len(h), bool)
    hit[order[1:]] |= same
    hit[order[:-1]] |= same
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.flatnonzero(hit), 1)
    np.add.at(cover, np.flatnonzero(hit) + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def base_counts(text: bytes, line: bytes, n_words: int, powers: Powers) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    b = np.frombuffer(text, np.uint8)
    w = np.frombuffer(line, np.uint8)
    chars = int(((w & 0xC0) != 0x80).sum()) - max(0, n_words - 1)
    seen, dup = set(), 0
    for row in text.split(b"\n"):
        if row in seen:
            dup += 1
        elif row and not row.isspace():
            seen.add(row)
    return chars, int(_SYMBOL[b].sum()), dup, repeated_words(line, powers)


def codes(line: bytes) -> np.ndarray:
    """One code for each byte of ``line`` and its end: that byte and the four before."""
    b = np.frombuffer(b" " * (ORDER - 1) + line + b" ", np.uint8).astype(np.int64)
    out = b[:len(b) - ORDER + 1].copy()
    for k in range(1, ORDER):
        out <<= 8
        out |= b[k:len(b) - ORDER + 1 + k]
    return out


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros((len(keys), 2), np.int64)
    for side in (0, 1):
        counts[:, side] = np.bincount(where, np.concatenate([c[:, side] for _, c in parts]), minlength=len(keys))
    return keys, counts


class Grams:
    """N-gram counts of texts, by fold."""

    def __init__(self):
        self.waiting, self.waiting_size, self.parts = [], 0, []

    def add(self, tag: int, side: int, line: bytes):
        self.waiting.append(((codes(line) | tag) << 1 | side))  # 63 bits and the fold
        self.waiting_size += len(line)
        if self.waiting_size >= PART:
            self.fold()

    def fold(self):
        if self.waiting:
            keys, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            counts = np.zeros((len(keys), 2), np.int64)
            counts[np.arange(len(keys)), keys & 1] = n
            self.parts.append((keys >> 1, counts))
            self.waiting, self.waiting_size = [], 0
            if len(self.parts) >= 4:
                self.parts = [_merge(self.parts)]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.fold()
        return _merge(self.parts)


class Block:
    """Documents gathered for one block: base counts of its rows, distinct texts."""

    def __init__(self):
        self.rows, self.lines, self.heads, self.size = [], [], {}, 0

    def add(self, doc_id, lang: str, tag: int, text_hash: int, counts: tuple, line: bytes):
        name = lang.encode()
        digest = hashlib.blake2b(b"%d " % len(name) + name, digest_size=16)
        digest.update(line)
        digest, first = digest.digest(), (doc_id is not None, doc_id or 0, text_hash)  # NULL first, as Spark's min
        head = self.heads.get(digest)
        if head is None:
            head = self.heads[digest] = [len(self.lines), first, lang, tag, counts[0], counts[4]]
            self.lines.append(line)
            self.size += len(line)
        head[1] = min(head[1], first)
        self.rows.append((doc_id, lang, head[0], *counts))
        self.size += ROW

    def batch(self) -> pa.RecordBatch:
        ends = np.cumsum([len(x) for x in self.lines], dtype=np.int64)
        texts = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.lines))
        heads = [(d, f[1] if f[0] else None, f[2], *rest) for d, (_, f, *rest) in self.heads.items()]
        packed = [zstandard.ZstdCompressor(level=LEVEL).compress(x)
                  for x in (_stream(self.rows, ROWS), _stream(heads, HEADS), ends.tobytes())]
        return pa.RecordBatch.from_pydict(
            {"block": [uuid.uuid4().int >> 65], "docs": [packed[0]], "heads": [packed[1]], "ends": [packed[2]], "texts": [texts]}, PACKED)


FIELDS = ["doc_id", "lang", "at", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ROWS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *((f, pa.int64()) for f in FIELDS[2:])])
HEADS = pa.schema([("digest", pa.binary()), ("first_id", pa.int64()), ("text_hash", pa.int64()), ("lang", pa.string()),
                   *((f, pa.int64()) for f in ("tag", "n_words", "n_repeat_words"))])
PACKED = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("docs", "heads", "ends", "texts"))])


def _stream(rows: list[tuple], schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema))
    return sink.getvalue().to_pybytes()


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


def _plain(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, block = Powers(), Block()
    for b in batches:
        ids, texts, langs = b.column("doc_id"), b.column("text"), b.column("lang")
        tags, hashes = b.column("tag").to_pylist(), b.column("text_hash").to_pylist()
        for k in range(b.num_rows):
            text = texts[k].as_py() or b""
            words = text.split()
            line = b" ".join(words)
            counts = (len(words), *base_counts(text, line, len(words), powers))
            block.add(ids[k].as_py(), langs[k].as_py(), tags[k], hashes[k], counts, line)
            if block.size >= BLOCK:
                yield block.batch()
                block = Block()
    if block.rows:
        yield block.batch()


def pack(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang)`` -> the written blocks, in buckets by block."""
    spark = docs.sparkSession
    lang = F.coalesce("lang", F.lit(NO_LANGUAGE))
    tag = F.shiftleft(F.xxhash64(lang).bitwiseAND((1 << (62 - _CODE_BITS)) - 1), _CODE_BITS)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), lang.alias("lang"), tag.alias("tag"), F.xxhash64("text").alias("text_hash"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(100_000, max(8, 4 * math.ceil(size / BLOCK)))  # mostly one block a bucket
    name = f"perplexity_blocks_{uuid.uuid4().hex[:12]}"
    (rows.mapInArrow(_pack, "block long, docs binary, heads binary, ends binary, texts binary")
     .write.bucketBy(buckets, "block").option("path", shared_path(spark, name)).format("parquet").saveAsTable(name))
    return spark.table(name)


def entries(blocks: DataFrame) -> DataFrame:
    """A row for each distinct text of each block, without the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, heads in zip(b.column("block").to_pylist(), b.column("heads").to_pylist(), strict=True):
                table = _table(heads)
                n = table.num_rows
                yield from (table.add_column(0, "at", pa.array(np.arange(n))).add_column(0, "block", pa.array(np.full(n, block)))
                            .combine_chunks().to_batches(max_chunksize=100_000))
    return blocks.select("block", "heads").mapInArrow(
        run, "block long, at long, digest binary, first_id long, text_hash long, lang string, tag long, n_words long, n_repeat_words long")


def owners(texts: DataFrame) -> DataFrame:
    """``block, at, side``: one place and the fold of each distinct text."""
    first = texts.groupBy("digest").agg(F.min(F.struct("first_id", "text_hash")).alias("first"), F.min(F.struct("block", "at")).alias("place"))
    return first.select("place.*", F.pmod(F.xxhash64("first.first_id", "first.text_hash"), F.lit(2)).alias("side"))


def _count(blocks: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
    found, press = [], zstandard.ZstdCompressor(level=1).compress
    if len(owned):
        for block, heads, ends, texts in zip(*(blocks[c] for c in ("block", "heads", "ends", "texts")), strict=True):
            tags, grams = _table(heads).column("tag").to_numpy(), Grams()
            ends, texts = _plain(ends, np.int64), zstandard.ZstdDecompressor().decompress(texts)
            for at, side in zip(owned["at"], owned["side"], strict=True):
                grams.add(int(tags[at]), int(side), texts[ends[at - 1] if at else 0:ends[at]])
            keys, counts = grams.all()
            found.append((block, press(np.diff(keys, prepend=0).astype(np.int64).tobytes()), press(counts.astype(np.int32).tobytes())))
    return pd.DataFrame(found, columns=["block", "keys", "counts"])


def gram_counts(blocks: DataFrame) -> DataFrame:
    """``block, g, c0, c1``: every block's distinct codes and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, keys, counts in zip(*(b.column(c).to_pylist() for c in ("block", "keys", "counts")), strict=True):
                g, c = np.cumsum(_plain(keys, np.int64)), _plain(counts, np.int32).reshape(-1, 2)
                for at in range(0, len(g), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(g[part]), block)), pa.array(g[part]), pa.array(c[part, 0].astype(np.int64)),
                         pa.array(c[part, 1].astype(np.int64))], ["block", "g", "c0", "c1"])
    return blocks.select("block", "keys", "counts").mapInArrow(run, "block long, g long, c0 long, c1 long")


def _tag_of(g):
    return F.shiftrightunsigned(g, _CODE_BITS)


def model(grams: DataFrame) -> DataFrame:
    """``g, c0, c1`` summed counts of the highest order -> ``g, l0, l1``: natural
    log-probabilities of each code's last byte under either fold's model.

    Modified Kneser-Ney: the highest order has counts, the lower ones the number of
    distinct longer codes that end so; three discounts per language and order from
    the numbers of codes seen one to four times (0.5, 1, 1.5 where these don't give
    discounts in range); the rest goes to the next lower order, at last to 1/256."""
    full = (1 << _CODE_BITS) - 1
    orders = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):  # drop the first byte, keep the language
        code = F.col("g").bitwiseAND((1 << (8 * n)) - 1).bitwiseOR(F.col("g").bitwiseAND(~full))
        orders[n] = written(orders[n + 1].groupBy(code.alias("g")).agg(
            *(F.sum((F.col(f"c{s}") > 0).cast("long")).alias(f"c{s}") for s in (0, 1))), f"grams{n}")
    below = None
    for n in range(1, ORDER + 1):
        seen = orders[n].withColumn("tag", _tag_of(F.col("g")))
        tally = seen.groupBy("tag").agg(*(F.sum((F.col(f"c{s}") == k).cast("long")).alias(f"n{k}_{s}") for s in (0, 1) for k in (1, 2, 3, 4)))
        discount = []
        for s in (0, 1):
            n1, n2, n3, n4 = (F.col(f"n{k}_{s}").cast("double") for k in (1, 2, 3, 4))
            y = F.try_divide(n1, n1 + 2 * n2)
            above = [F.try_divide(x, z) for x, z in ((n2, n1), (n3, n2), (n4, n3))]
            for k, plain in ((1, 0.5), (2, 1.0), (3, 1.5)):
                d = k - (k + 1) * y * above[k - 1]  # NULL where a count is missing
                discount.append(F.when(d.between(0.0, float(k)), d).otherwise(F.lit(plain)).alias(f"d{k}_{s}"))
        tally = written(tally.select("tag", *discount), f"discounts{n}")
        rows = seen.join(tally, "tag")
        context = F.col("g").bitwiseAND((1 << (8 * n)) - 1)
        rows = rows.withColumn("h", F.shiftright(context, 8).bitwiseOR(F.col("g").bitwiseAND(~full)))
        cut = [F.when(F.col(f"c{s}") >= 3, F.col(f"d3_{s}")).when(F.col(f"c{s}") == 2, F.col(f"d2_{s}"))
               .when(F.col(f"c{s}") == 1, F.col(f"d1_{s}")).otherwise(F.lit(0.0)).alias(f"cut{s}") for s in (0, 1)]
        rows = rows.select("g", "h", "c0", "c1", *cut)
        totals = rows.groupBy("h").agg(*(F.sum(f"{x}{s}").alias(f"{x}_all{s}") for x in ("c", "cut") for s in (0, 1)))
        rows = rows.join(totals, "h")
        if below is None:
            rows = rows.withColumns({f"q{s}": F.lit(1 / 256) for s in (0, 1)})
        else:
            tail = F.col("g").bitwiseAND((1 << (8 * (n - 1))) - 1).bitwiseOR(F.col("g").bitwiseAND(~full))
            rows = rows.withColumn("tail", tail).join(below.withColumnRenamed("g", "tail"), "tail")
        p = [F.when(F.col(f"c_all{s}") > 0, (F.col(f"c{s}") - F.col(f"cut{s}") + F.col(f"cut_all{s}") * F.col(f"q{s}")) / F.col(f"c_all{s}"))
             .otherwise(F.col(f"q{s}")) for s in (0, 1)]
        below = written(rows.select("g", p[0].alias("q0"), p[1].alias("q1")), f"model{n}")
    return below.select("g", *(F.log(f"q{s}").cast("float").alias(f"l{s}") for s in (0, 1)))


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``block, g, l0, l1`` -> per block a sorted array of codes (as steps) and
    its rounded values, compressed; at most about ``HELD`` rows are gathered."""
    press = zstandard.ZstdCompressor(level=3).compress

    def flush(parts):
        block, g, *l = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((g, block))
        block, g = block[order], g[order]
        values = np.stack([np.clip(np.rint(-STEPS * x[order].astype(np.float64)), 0, 65535).astype(np.uint16) for x in l])
        ends = np.flatnonzero(np.diff(block, append=-1))
        starts = np.concatenate([[0], ends[:-1] + 1])
        return pa.RecordBatch.from_pydict(
            {"block": block[starts], "keys": [press(np.diff(g[s:e + 1], prepend=0).tobytes()) for s, e in zip(starts, ends, strict=True)],
             "values": [press(np.ascontiguousarray(values[:, s:e + 1]).tobytes()) for s, e in zip(starts, ends, strict=True)]})

    parts, held = [], 0
    for b in batches:
        if b.num_rows:
            parts.append([b.column(c).to_numpy() for c in ("block", "g", "l0", "l1")])
            held += b.num_rows
        if held >= HELD:
            yield flush(parts)
            parts, held = [], 0
    if parts:
        yield flush(parts)


def _score(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """``answers`` hold a block's code arrays and, with no keys, its own texts."""
    found, own = [], answers["keys"].isna()
    keys = np.concatenate([np.cumsum(_plain(k, np.int64)) for k in answers["keys"][~own]] or [np.zeros(0, np.int64)])
    values = np.concatenate([_plain(v, np.uint16).reshape(2, -1) for v in answers["values"][~own]] or [np.zeros((2, 0))], axis=1)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[:, order] / -float(STEPS)
    places, sides = answers["at"][own].to_numpy(np.int64), answers["side"][own].to_numpy(np.int64)
    for heads, ends, texts in zip(blocks["heads"], blocks["ends"], blocks["texts"], strict=True):
        rows = _table(heads).to_pandas().iloc[places]
        ends, texts = _plain(ends, np.int64), zstandard.ZstdDecompressor().decompress(texts)
        log, length = np.zeros(len(rows)), np.zeros(len(rows))
        for k, (place, tag, side) in enumerate(zip(places, rows["tag"], sides, strict=True)):
            start, end, total = int(ends[place - 1]) if place else 0, int(ends[place]), 0.0
            for at in range(start, end + 1, PART):  # bounded temporaries, whole text
                lead = max(start, at - ORDER + 1)
                g = codes(texts[lead:min(end, at + PART)])
                g = g[at - lead:][:PART] if at + PART <= end else g[at - lead:]
                total += float(values[1 - side][np.searchsorted(keys, g | tag)].sum(dtype=np.float64))
            log[k], length[k] = total, end - start + 1
        found.append(rows[["digest", "lang", "n_words", "n_repeat_words"]].assign(positions=length.astype(np.int64), log_perplexity=-log / length))
    return pd.concat(found)


def _spread(blocks: pd.DataFrame, results: pd.DataFrame) -> pd.DataFrame:
    results = results.set_index("at")[["positions", "log_perplexity"]]
    return pd.concat([_table(d).to_pandas().join(results, on="at").drop(columns="at") for d in blocks["docs"]])


def scored(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text, lang)`` -> of every row, base counts and ``log_perplexity``
    (natural, per byte); of every distinct text of a language, the latter."""
    blocks = pack(docs)
    places = entries(blocks)
    owned = written(owners(places), "owned")
    grouped = blocks.select("block", "heads", "ends", "texts").groupBy("block")
    grams = gram_counts(written(grouped.cogroup(owned.groupBy("block")).applyInPandas(_count, "block long, keys binary, counts binary"), "counted"))
    summed = written(grams.groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "grams")
    answers = (grams.select("block", "g").join(model(summed), "g").select("block", "g", "l0", "l1")
               .mapInArrow(_arrays, "block long, keys binary, values binary"))
    answers = answers.unionByName(owned, allowMissingColumns=True)
    texts = written(grouped.cogroup(answers.groupBy("block")).applyInPandas(
        _score, "digest binary, lang string, n_words long, n_repeat_words long, positions long, log_perplexity double"), "scored_texts")
    results = places.select("block", "at", "digest").join(texts.select("digest", "positions", "log_perplexity"), "digest").drop("digest")
    rows = blocks.select("block", "docs").groupBy("block").cogroup(results.groupBy("block")).applyInPandas(
        _spread, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                 "n_repeat_words long, positions long, log_perplexity double")
    return written(rows, "scored"), texts


def spreads(rows: DataFrame, bands: DataFrame, labels: DataFrame, short: int) -> DataFrame:
    """``lang, below, above``: per language and side the spread, in steps of ``CUT``,
    that rejects the largest surplus of labelled junk over labelled good texts; NULL
    where none rejects more junk. Held-out ids are not used."""
    marks = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", (F.col("quality") == 0).alias("junk"))
    known = rows.join(marks, "doc_id").select("lang", "positions", "log_perplexity", "junk").distinct()  # copies once
    unit = (F.col("q")[1] - F.col("q")[0]) * F.sqrt(1 + short / F.col("positions"))
    sides = [F.struct(F.lit(n).alias("side"), F.try_divide(d, unit).alias("far"))
             for n, d in (("below", F.col("q")[0] - F.col("log_perplexity")), ("above", F.col("log_perplexity") - F.col("q")[1]))]
    tally = (known.join(bands, "lang").select("lang", "junk", F.explode(F.array(*sides)).alias("s")).filter("s.far > 0")
             .groupBy("lang", "s.side", F.least(F.floor(F.col("s.far") / CUT), F.lit(CUTS)).alias("step"))
             .agg(F.sum(F.when(F.col("junk"), 1).otherwise(-1)).alias("surplus")))
    beyond = Window.partitionBy("lang", "side").orderBy(F.desc("step"))  # at most CUTS + 1 rows
    best = (tally.withColumn("gain", F.sum("surplus").over(beyond)).filter("gain > 0")
            .groupBy("lang", "side").agg((F.max(F.struct("gain", "step"))["step"] * CUT).alias("spread")))
    return best.groupBy("lang").agg(*(F.max(F.when(F.col("side") == n, F.col("spread"))).alias(n) for n in ("below", "above")))


def quality(docs: DataFrame, spread: tuple = SPREAD, short: int = SHORT, doc_id: str = "doc_id", text: str = "text",
            lang: str = "lang", labels: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, lang, perplexity, lower, upper`` of every row.

    A document is kept if it passes the base rules and its log-perplexity lies
    within its language's band: the quartiles of the language's distinct texts that
    pass the base rules, widened below and above by ``spread`` times their distance; for
    a text of n bytes by ``sqrt(1 + short / n)`` times that, as the mean over few
    bytes scatters more. ``labels(doc_id, quality)``, if given, set the spreads of each
    language and side where they show junk (``spreads``). NULL, empty and blank texts have no words and fail; NULL
    languages form one language of their own; repeated rows and NULL ids keep their
    rows; an empty table gives an empty result; other columns are not read."""
    rows, texts = scored(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    bands = texts.filter(~failed).groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q"))
    bands = bands.withColumns({"below": F.lit(float(spread[0])), "above": F.lit(float(spread[1]))})
    if labels is not None:
        bands = written(bands, "bands")
        found = spreads(rows.filter(~failed), bands.select("lang", "q"), labels, short)
        bands = written(bands.alias("b").join(found.alias("f"), "lang", "left").select(
            "lang", "q", *(F.coalesce(f"f.{n}", f"b.{n}").alias(n) for n in ("below", "above"))), "calibrated")
    width = (F.col("q")[1] - F.col("q")[0]) * F.sqrt(1 + short / F.col("positions"))
    judged = rows.join(bands, "lang", "left").withColumns({
        "perplexity": F.exp("log_perplexity"), "lower": F.exp(F.col("q")[0] - F.col("below") * width),
        "upper": F.exp(F.col("q")[1] + F.col("above") * width)})
    inside = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & inside).alias("kept"), F.nullif("lang", F.lit(NO_LANGUAGE)).alias("lang"),
                         "perplexity", "lower", "upper")
