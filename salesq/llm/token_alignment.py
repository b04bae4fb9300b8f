"""Alignment of the tokens that two tokenizers give to the same texts.

Tokenizer A is a byte-level BPE (.json), B a SentencePiece model; both cover the
bytes of space+text. Offsets where a token of each ends cut the tokens into
groups, and the two tokens that end there are linked.

A ``Fragment`` is what a byte range of a text yields: an open prefix (tokens up to
its first cut, which may belong to a group begun before), closed groups, and an
open suffix. ``compose`` joins the fragments of neighbouring ranges; it is
associative, with the empty fragment as neutral element. So a long text is
divided at multiples of ``CHUNK`` bytes, its ranges are encoded by different tasks
and the fragments are composed in a tree of ``FAN`` at a time. A range's task reads
a little more on both sides, from and to a place that no token crosses (a space
after a sign that is none), and takes the tokens that end inside its range. A
division without such a place within ``CHUNK`` bytes on both sides is left out:
that stretch stays whole.

Linked tokens end at the same byte, so the bytes of one are a suffix of the
other's: the number of distinct linked pairs is bounded by the two vocabularies
(``pair_bound``), whatever the corpus. Their counts are broadcast if that bound
allows, else joined by a shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesq.llm.common import written

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK, FAN, LONG, OUT_TOKENS, BROADCAST_PAIRS = 32_768, 8, 50_000, 500_000, 8_000_000
SPACE = "▁"
# a space after a character that is no white space, before anything at all
_PLACE = re.compile(rb"(?<=[!-~\x80-\xff])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])"
                    rb"(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80) (?=.)", re.S)
_ALIGNERS: dict = {}


@dataclass
class Fragment:
    """Tokens that end inside one byte range. ``closed``: the range holds a cut;
    without one all its tokens are in ``head``. ``groups``: text of the closed
    groups, ``links``: one for each; the group that ends at the first cut is not among
    them but in ``head``, save where the range starts the text, which is a cut too."""
    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    closed: bool = False
    head_a: list = field(default_factory=list)
    head_b: list = field(default_factory=list)
    groups: str = ""
    links: list | np.ndarray = field(default_factory=list)
    tail_a: list = field(default_factory=list)
    tail_b: list = field(default_factory=list)


def _open(lo: int, a, b) -> tuple:
    """Fields of a fragment without a cut in it: prefix, or suffix from the text's start."""
    head, tail = ([], []), (a.tolist(), b.tolist())
    return (*tail, "", [], *head) if lo else (*head, "", [], *tail)


def group_text(a, b) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def compose(x: Fragment, y: Fragment, n_b: int) -> Fragment:
    """The fragment of two neighbouring ranges; ``n_b`` is the number of B's ids."""
    ok, a, b = x.ok and y.ok, x.n_a + y.n_a, x.n_b + y.n_b
    if not x.closed:
        return Fragment(ok, a, b, y.closed, [*x.head_a, *y.head_a], [*x.head_b, *y.head_b], y.groups, y.links, y.tail_a, y.tail_b)
    middle_a, middle_b = [*x.tail_a, *y.head_a], [*x.tail_b, *y.head_b]
    if not y.closed:
        return Fragment(ok, a, b, True, x.head_a, x.head_b, x.groups, x.links, middle_a, middle_b)
    groups = ";".join(filter(None, (x.groups, group_text(middle_a, middle_b), y.groups)))
    links = np.concatenate((x.links, [int(middle_a[-1]) * n_b + int(middle_b[-1])], y.links)).astype(np.int64)
    return Fragment(ok, a, b, True, x.head_a, x.head_b, groups, links, y.tail_a, y.tail_b)


def finish(x: Fragment) -> Fragment:
    """The fragment of a whole text. A text that a tokenizer gives back with other bytes
    has no tokens; nor has one that ends without a cut."""
    return x if x.ok and x.closed and not len(x.tail_a) and not len(x.tail_b) else Fragment(x.ok)


def _byte_of_sign() -> dict[str, int]:
    """The signs that byte-level vocabularies write bytes as: printable Latin-1 is
    itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in plain):
        signs[chr(0x100 + k)] = b
    return signs


class Aligner:
    """Both tokenizers, once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a_path = a_path
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        signs = _byte_of_sign()
        vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        n_a = max(vocabulary.values()) + 1
        self.a_bytes = [b""] * n_a
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(signs[c] for c in piece) if all(c in signs for c in piece) else piece.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.fast = self._fast(spec)
        # may a text be divided before a space that follows another sign?
        level = spec.get("pre_tokenizer") or {}
        self.divisible = (level.get("type") == "ByteLevel" and level.get("use_regex", True) and not spec.get("normalizer")
                          and not any(SPACE in p.lstrip(SPACE) for p in pieces))
        # text of a token by 2 * id + (its group ends), B's after A's
        words = [w for n, end in ((n_a, "|"), (self.n_b, ";")) for i in range(n) for w in (f"{i},", f"{i}{end}")]
        width = max(map(len, words))
        self.words = np.array([w.ljust(width).encode() for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)

    def _fast(self, spec: dict):
        """The same byte-level BPE through the faster library, where the file's merges
        are in the order of their tokens' ids and its cut is the usual pattern."""
        import public_tokenizers
        import tiktoken
        level, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (level.get("type") != "ByteLevel" or level.get("add_prefix_space") or not level.get("use_regex", True)
                or spec.get("normalizer") or model.get("type") != "BPE"):
            return None
        special = {t["id"] for t in spec.get("added_tokens", [])}
        ranks = {t: i for i, t in enumerate(self.a_bytes) if i not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        if ids != sorted(ids) or len(ids) + 256 != len(ranks):
            return None
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def a(self):
        """The file's own library, which bears a text of any length."""
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.a_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B for a text that starts with a space."""
        if self.fast and len(text) <= LONG:
            a = np.array(self.fast.encode_ordinary(text), np.int32)
        else:
            a = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int32)
        return a, np.array(self.b.encode(text[1:]), np.int32)

    def divide(self, data: bytes) -> list[tuple[int, int, int, bytes]]:
        """``(lo, hi, at, piece)`` for the byte ranges (lo, hi] of ``data``; the piece
        starts at ``at`` and holds every token that ends in the range."""
        def place(c):       # the last place up to c and the first from it on
            before = None
            for m in _PLACE.finditer(data, max(0, c - CHUNK), c + 2):
                before = m.start()
            after = _PLACE.search(data, c, c + CHUNK)
            return None if before is None or after is None else (c, before, after.start())
        cuts = [p for p in map(place, range(CHUNK, len(data), CHUNK)) if p] if self.divisible else []
        edges = [(0, 0, 0), *cuts, (len(data), len(data), len(data))]
        return [(lo, hi, at, data[at:to]) for (lo, at, _), (hi, _, to) in zip(edges, edges[1:])]

    def fragment(self, piece: bytes, at: int = 0, lo: int = 0, hi: int | None = None) -> Fragment:
        """The fragment of the byte range (lo, hi] of a text, from the piece at ``at``."""
        a, b = self.encode(piece.decode())
        a_end, b_end = np.cumsum(self.a_size[a]) + at, np.cumsum(self.b_size[b]) + at
        # a byte-level BPE only joins the text's own bytes: where A is one, its sizes tell
        if (a_end[-1:] != at + len(piece) or (not self.fast and b"".join(map(self.a_bytes.__getitem__, a.tolist())) != piece)
                or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != piece):
            return Fragment(False)
        if hi is not None:
            inside = (a_end > lo) & (a_end <= hi)
            a, a_end = a[inside], a_end[inside]
            inside = (b_end > lo) & (b_end <= hi)
            b, b_end = b[inside], b_end[inside]
        if not len(a) or not len(b):
            return Fragment(True, len(a), len(b), lo == 0, *_open(lo, a, b))
        near = np.minimum(np.searchsorted(a_end, b_end), len(a) - 1)
        common = a_end[near] == b_end
        cut_a, cut_b = near[common], np.flatnonzero(common)     # the last token of each group
        if not len(cut_a):
            return Fragment(True, len(a), len(b), lo == 0, *_open(lo, a, b))
        first = int(lo > 0)     # the start of the text is a cut: no prefix is open there
        a0, b0 = (cut_a[0] + 1, cut_b[0] + 1) if first else (0, 0)
        a1, b1 = cut_a[-1] + 1, cut_b[-1] + 1
        cut_a, cut_b = cut_a[first:], cut_b[first:]
        return Fragment(True, len(a), len(b), True, a[:a0].tolist(), b[:b0].tolist(),
                        self._text(a[a0:a1], b[b0:b1], cut_a - a0, cut_b - b0), a[cut_a].astype(np.int64) * self.n_b + b[cut_b],
                        a[a1:].tolist(), b[b1:].tolist())

    def _text(self, a, b, cut_a, cut_b) -> str:
        """Closed groups as text: ``a1,a2|b1;a3|b2,b3``."""
        if not len(cut_a):
            return ""
        last_a, last_b = np.zeros(len(a), np.int32), np.zeros(len(b), np.int32)
        last_a[cut_a], last_b[cut_b] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        flat = np.empty(len(a) + len(b), np.int32)              # group after group, A's tokens first
        flat[np.arange(len(a)) + np.concatenate(([0], cut_b + 1))[group_a]] = 2 * a + last_a
        flat[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * (b + len(self.a_bytes)) + last_b
        signs = self.words[flat].ravel()                        # fixed width, padded with spaces
        return signs[signs != 32][:-1].tobytes().decode()

    def pair_bound(self) -> int:
        """Most distinct pairs that can ever be linked: the bytes of one token are a
        suffix of the other's."""
        from collections import Counter
        count_a, count_b = Counter(self.a_bytes), Counter(self.b_bytes)
        shorter_b = sum(n * count_b[t[k:]] for t, n in count_a.items() for k in range(len(t)) if t[k:] in count_b)
        shorter_a = sum(n * count_a[t[k:]] for t, n in count_b.items() for k in range(1, len(t)) if t[k:] in count_a)
        return shorter_a + shorter_b


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


_PART = ("ok boolean, n_a long, n_b long, closed boolean, head_a array<int>, head_b array<int>, groups string, "
         "links array<bigint>, tail_a array<int>, tail_b array<int>")
_FIELDS = ["ok", "n_a", "n_b", "closed", "head_a", "head_b", "groups", "links", "tail_a", "tail_b"]
_TYPES = [pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string(),
          pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]


def _columns(parts: list[Fragment]) -> list[pa.Array]:
    return [pa.array([getattr(p, n) for p in parts], t) for n, t in zip(_FIELDS, _TYPES)]


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, doc_id, n_a, n_b, groups, links`` of every row: token counts, the groups
    as text (``a1,a2|b1;a3|b2,b3``, ids in order), and one link a group, the number
    ``a * B's size + b``.

    NULL and empty texts, and texts that a tokenizer does not give back byte for byte,
    have no tokens (zeros, empty text and array). Repeated rows and NULL ids keep
    their rows (``row`` tells them apart); an empty table gives an empty result; other
    columns, whatever their names, are not read. Whole texts of any length."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    n_b = aligner(a_path, b_path).n_b
    size = F.coalesce(F.octet_length("text"), F.lit(0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        for b in batches:
            texts, start, parts, total = b.column("text"), 0, [], 0
            for k in range(len(texts)):
                t = texts[k].as_py()
                parts.append(finish(al.fragment(f" {t}".encode())) if t else Fragment())
                total += parts[-1].n_a + parts[-1].n_b
                if total >= OUT_TOKENS or k == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [b.column("row").slice(start, len(parts)), b.column("doc_id").slice(start, len(parts)), *_columns(parts)],
                        ["row", "doc_id", *_FIELDS])
                    start, parts, total = k + 1, [], 0

    def divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        for b in batches:
            for k in range(b.num_rows):
                ranges = al.divide(f" {b.column('text')[k].as_py()}".encode())
                for s in range(0, len(ranges), 64):     # a few MB at a time
                    part = ranges[s:s + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(b.column("row")[k], len(part)), pa.repeat(b.column("doc_id")[k], len(part)),
                         pa.array(range(s, s + len(part)), pa.int64()),
                         *(pa.array([r[c] for r in part], pa.int64()) for c in range(3)),
                         pa.array([r[3] for r in part], pa.binary())],
                        ["row", "doc_id", "no", "lo", "hi", "at", "piece"])

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        for b in batches:
            for k in range(b.num_rows):
                lo, hi, at, piece = (b.column(c)[k].as_py() for c in ("lo", "hi", "at", "piece"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(k, 1) for c in ("row", "doc_id", "no")] + _columns([al.fragment(piece, at, lo, hi)]),
                    ["row", "doc_id", "no", *_FIELDS])

    def composed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        parts = [Fragment(**{n: getattr(r, n) for n in _FIELDS}) for r in group.itertuples(index=False)]
        out = reduce(lambda x, y: compose(x, y, n_b), parts)
        return pd.DataFrame([[group["row"].iloc[0], group["doc_id"].iloc[0], group["no"].iloc[0] // FAN,
                              *(getattr(out, n) for n in _FIELDS)]], columns=["row", "doc_id", "no", *_FIELDS])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                part = Fragment(**{n: b.column(n)[k].as_py() for n in _FIELDS})
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(k, 1), b.column("doc_id").slice(k, 1), *_columns([finish(part)])],
                    ["row", "doc_id", *_FIELDS])

    done = rows.filter(size < CHUNK).select("row", "doc_id", "text").mapInArrow(whole, f"row long, doc_id {kind}, {_PART}")
    longest = rows.agg(F.max(size)).first()[0] or 0
    if longest >= CHUNK:
        named = f"row long, doc_id {kind}, no long, {_PART}"
        level = (rows.filter(size >= CHUNK).select("row", "doc_id", "text")
                 .mapInArrow(divided, f"row long, doc_id {kind}, no long, lo long, hi long, at long, piece binary")
                 .repartition("row", "no").mapInArrow(fragments, named))
        ranges = longest // CHUNK + 2
        while ranges > 1:
            level = level.groupBy("row", F.expr(f"no div {FAN}")).applyInPandas(composed, named)
            ranges = -(-ranges // FAN)
        done = done.unionByName(level.drop("no").mapInArrow(finished, f"row long, doc_id {kind}, {_PART}"))
    return done.select("row", "doc_id", "n_a", "n_b", "groups", "links")


def with_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Adds ``n_links, n_best, count_sum`` to ``align``'s rows (stored, as both the counts and their sums read them). A pair's count is
    the number of links of the whole corpus that hold it; ``n_best`` counts the links
    whose count is the highest of their B id."""
    al = aligner(a_path, b_path)
    stored = written(aligned, "alignment")
    links = stored.select("row", F.explode("links").alias("link"))
    counts = links.groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "links")
    b = F.col("link") % al.n_b
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    pairs = counts.withColumn("b", b).join(highest, "b").select("link", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    if al.pair_bound() <= BROADCAST_PAIRS:      # proven by the vocabularies alone
        pairs = F.broadcast(pairs)
    sums = links.join(pairs, "link").groupBy("row").agg(F.sum("n").alias("count_sum"), F.sum("best").alias("n_best"))
    return stored.withColumn("n_links", F.size("links").cast("long")).join(sums, "row", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("count_sum", "n_best")})


def digests(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The contract's columns. The groups are hashed before ``with_counts`` stores
    the rows, so their text is not written."""
    hashed = aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(""))
    return with_counts(hashed.drop("groups"), a_path, b_path).select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")
