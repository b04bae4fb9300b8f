"""Byte-level BPE encoding by a lazily determinised transducer, and decoding.

A token sequence is the BPE encoding of its bytes exactly if each two neighbours
(u, v) are the encoding of u+v: up to the first merge across a boundary, the merges
of two neighbouring tokens' bytes go as they do alone. So each prefix of a match has one encoding,
and the encodings of all prefixes are the paths of a nondeterministic transducer
that starts a token at every position, follows a trie of all tokens, and ends a
token where its predecessor allows it.

``Transducer`` determinises it on demand: a state holds the open hypotheses (last
token and trie node) with the tokens not yet emitted of each; a transition reads one
byte and emits what all hypotheses that are still open agree on. A hypothesis closes
after the longest token at most, so tokens come out after a bounded lookahead and a
match of any length needs constant memory. States and hypotheses keep their
transitions; at ``STATES`` states their table starts anew, with the same answers.

Texts are cut into matches of the tokenizer's pattern; a match seen before comes
from a bounded memory (``common.Memory``), any other runs through the transducer.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import Memory

RANKS = "byte_bpe_50k.tiktoken"
STATES, OPEN, PAIRS, MEMORY = 300_000, 400_000, 250_000, 150_000
LONG_MATCH, LONG_TEXT, OUT_IDS, DECODED, FEW = 64, 1_000_000, 4_000_000, 65_536, 16
ROOT, NONE = 0, -1
_CODECS: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, map(bytes.strip, f)))}


class Open:
    """A hypothesis: the token before it, the trie node of its bytes so far, and where
    each next byte leads: (hypothesis or None, token that ends there or NONE)."""
    __slots__ = ("last", "node", "go")

    def __init__(self, last: int, node: int):
        self.last, self.node, self.go = last, node, {}


class Transducer:
    """Encoder of one match: ``encode(bytes) -> ids``."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} single bytes are no tokens: not a byte-level vocabulary")
        self.ranks = ranks
        self.ordered = sorted(ranks)             # the tokens below a trie node are a range of it
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}          # trie node << 8 | byte -> node
        self.token, self.first, self.below = [NONE], [0], [0]   # of a node: its token; first place and number of those below
        for place, text in enumerate(self.ordered):
            node = ROOT
            for b in text:
                self.below[node] += 1
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.token.append(NONE)
                    self.first.append(place)
                    self.below.append(0)
                node = nxt
            self.token[node] = ranks[text]
            self.first[node] = place + 1
        self.never = max(ranks.values()) + 1     # above every rank
        self.edges: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self.open: dict[int, Open] = {}
        self._start_anew()

    def _start_anew(self) -> None:
        """Drop the states; hypotheses stay with their moves, which makes states cheap to
        find again, unless there are too many of them as well."""
        if len(self.open) >= OPEN:
            self.open.clear()
        self.states: dict[tuple, dict] = {}
        self.start = self._state(((self._open(NONE, ROOT), ()),))

    def _open(self, last: int, node: int) -> Open:
        key = (last + 1) << 32 | node
        known = self.open.get(key)
        if known is None:
            known = self.open[key] = Open(last, node)
        return known

    def _edges(self, token: int) -> tuple[list, list, bool]:
        """How the token's last and its first part grow while its bytes merge (lowest
        rank first, leftmost of equals): ``(part, highest rank merged until it grows)``
        for each, and whether the bytes merge into the token at all."""
        known = self.edges.get(token)
        if known is not None:
            return known
        text, ranks = self.bytes_of[token], self.ranks
        parts = [text[k:k + 1] for k in range(len(text))]
        left, right, low, high = [], [], NONE, NONE
        while len(parts) > 1:
            found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            rank, k = min(found)
            low, high = max(low, rank), max(high, rank)
            if k == 0:
                left.append((parts[0], low))
                low = NONE
            if k == len(parts) - 2:
                right.append((parts[-1], high))
                high = NONE
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        known = self.edges[token] = (left + [(parts[0], self.never)], right + [(parts[-1], self.never)], len(parts) == 1)
        return known

    def _follows(self, last: int, token: int) -> bool:
        """May ``token`` come after ``last`` (NONE: at the start of a match)? No, if in
        the course of the merges the parts at the boundary could merge before either grows."""
        key = (last + 1) << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            left, _, known = self._edges(token)
            if known and last != NONE:
                _, right, _ = self._edges(last)
                i = j = 0
                while True:
                    (a, until_a), (b, until_b) = right[i], left[j]
                    rank = self.ranks.get(a + b)
                    if rank is not None and rank < until_a and rank <= until_b:
                        known = False
                        break
                    if i == len(right) - 1 and j == len(left) - 1:
                        break
                    if until_a <= until_b:
                        i += 1
                    else:
                        j += 1
            self.pairs[key] = known
        return known

    def _move(self, h: Open, byte: int) -> tuple[Open | None, int]:
        """A hypothesis reads a byte. It stays open while a token below its node may
        come after its last one (taken for granted where there are many)."""
        node = self.child.get(h.node << 8 | byte)
        if node is None:
            move = (None, NONE)
        else:
            token, below, at = self.token[node], self.below[node], self.first[node]
            ends = token != NONE and self._follows(h.last, token)
            more = below > FEW or any(self._follows(h.last, self.ranks[t]) for t in self.ordered[at:at + below])
            move = (self._open(h.last, node) if more else None, token if ends else NONE)
        h.go[byte] = move
        return move

    def _state(self, open_now: tuple) -> dict:
        """A state: byte -> (state, tokens emitted); its hypotheses under NONE."""
        state = self.states.get(open_now)
        if state is None:
            state = self.states[open_now] = {NONE: open_now}
        return state

    def _step(self, state: dict, byte: int) -> tuple[dict, tuple]:
        if len(self.states) >= STATES:
            self._start_anew()
        still_open, ended = [], None
        for h, waiting in state[NONE]:                  # earliest start, hence longest token, first
            move = h.go.get(byte)
            stays, token = move if move is not None else self._move(h, byte)
            if token != NONE and ended is None:         # each prefix has one encoding
                ended = (self._open(token, ROOT), (*waiting, token))
            if stays is not None:
                still_open.append((stays, waiting))
        still_open.append(ended)
        first = still_open[0][1]
        agreed = len(first)
        for _, waiting in still_open:
            while first[:agreed] != waiting[:agreed]:
                agreed -= 1
        after = self._state(tuple([(h, w[agreed:]) for h, w in still_open]) if agreed else tuple(still_open))
        move = state[byte] = (after, first[:agreed])
        return move

    def feed(self, state: dict, text: bytes, out: list[int]) -> dict:
        """Read ``text``, append what is certain to ``out``; returns the new state."""
        for byte in text:
            move = state.get(byte)
            state, emitted = move if move is not None else self._step(state, byte)
            if emitted:
                out += emitted
        return state

    def encode(self, text: bytes) -> list[int]:
        out: list[int] = []
        state = self.feed(self.start, text, out)
        out += state[NONE][-1][1]                       # the hypothesis that ends with the match
        return out


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.transducer = Transducer(ranks)
        cut = regex.compile(pattern)
        self.findall, self.finditer = cut.findall, cut.finditer
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_of[i] = t
        self.memory = Memory(self._match, MEMORY, LONG_MATCH)

    def _match(self, match: str) -> bytes:
        text = match.encode()
        whole = self.transducer.ranks.get(text)          # a match that is a token is that token
        ids = [whole] if whole is not None else self.transducer.encode(text)
        return array("i", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids as packed 32-bit integers."""
        if not text:
            return b""
        matches = self.findall(text) if len(text) <= LONG_TEXT else (m.group() for m in self.finditer(text))
        return b"".join(map(self.memory.__getitem__, matches))

    def decode_stream(self, ids: np.ndarray) -> Iterator[str]:
        """Text of the ids, in pieces: an incremental UTF-8 decoder holds back a
        character whose bytes are not complete (an invalid one becomes U+FFFD)."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for k in range(0, len(ids), DECODED):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[k:k + DECODED].tolist())))
        yield machine.decode(b"", True)

    def decode(self, ids) -> str:
        return "".join(self.decode_stream(np.asarray(ids, np.int32)))


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker, rank file and pattern."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row, and with ``decoded`` the text of the ids as well.

    NULL and empty texts have no ids (and decode to an empty text); repeated rows
    and NULL ids keep their rows; an empty table gives an empty result; other
    columns, whatever their names, are not read. Whole texts of any length."""
    names = ["doc_id", "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in batches:
            texts = b.column("text")
            start, packed, back, total = 0, [], [], 0
            for k in range(len(texts)):
                packed.append(c.encode(texts[k].as_py()))
                if decoded:
                    back.append(c.decode(np.frombuffer(packed[-1], np.int32)))
                total += len(packed[-1]) // 4
                if total >= OUT_IDS or k == len(texts) - 1:
                    offsets = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                    columns = [b.column("doc_id").slice(start, k + 1 - start), ids, *([pa.array(back, pa.string())] if decoded else [])]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    start, packed, back, total = k + 1, [], [], 0

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded string" if decoded else ""))


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of each row's ids (NULL ids: NULL; bytes that are
    no UTF-8 become U+FFFD)."""
    @pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        c = codec(ranks_path, pattern)
        return pd.Series([None if r is None else c.decode(r) for r in rows], dtype=object)
    return tokens.withColumn("decoded", text(F.col(ids)))


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of rows with ids and decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
