"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton holds all pieces of a public .model file. One pass over a text
yields, at each position, every piece that ends there (the automaton follows its
output links), and each relaxes the best score of that position: a Viterbi search
for the segmentation of the highest total piece score. A character that no piece
covers becomes its UTF-8 bytes' pieces at a score below all others.

No piece of such a model crosses from a word into the space that opens the next,
nor holds a line break, and hardly any goes from letters and digits to other signs or back (all
checked when the model is read; a text that holds one of those few is cut at spaces
only). So the best path passes every such place, and a text's path is that of its
chunks: a distinct chunk runs through the automaton once while the task's memory
keeps it (``common.Memory``, two bounded generations), with its ids and the bytes
that they decode to; the round trip of a text joins the latter.

A literal U+2581 (the sign that stands for a space) is written as bytes, so that
decoding returns every text exactly; NULL texts give no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import Memory

SPACE, MEMORY, LONGEST, OUT_IDS = "▁", 200_000, 64, 4_000_000
_CODECS: dict = {}


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = sp.unk_id()
        self.bytes_of: list[bytes] = []
        self.byte_id: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        normal = []
        for i in range(sp.get_piece_size()):
            piece, score = sp.id_to_piece(i), sp.get_score(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                self.automaton.add_word(piece, (len(piece), score, i))
                normal.append((piece, score))
        self.automaton.make_automaton()
        self.worst = min(s for _, s in normal) - 10.0
        crossing = any(SPACE in p.lstrip(SPACE) for p, _ in normal)
        broken = any("\n" in p for p, _ in normal)
        self.chunks = re.compile(r".+" if crossing or broken else rf"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+", re.S).findall
        self.fine = self.chunks if crossing or broken else re.compile(
            rf"{SPACE}*(?:[^\W_]+|(?:[^{SPACE}\n\w]|_)+)|\n|{SPACE}+", re.S).findall
        # pieces that go from one kind of sign to another
        self.mixed = [p for p, _ in normal if len(self.fine(p)) > 1]
        self.memory = Memory(self._known, MEMORY, LONGEST)

    def _fallback(self, char: str) -> list[int]:
        raw = char.encode()
        return [self.byte_id[b] for b in raw] if self.byte_id else [self.unknown]

    def path(self, chunk: str) -> list[int]:
        """Viterbi over one chunk: ids of the best segmentation."""
        n, worst = len(chunk), self.worst
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        seen = 0
        for end, piece in self.automaton.iter(chunk):
            end += 1
            while seen < end:  # a character by itself, at the worst score
                seen += 1
                if best[seen - 1] + worst > best[seen]:
                    best[seen] = best[seen - 1] + worst
            score = best[end - piece[0]] + piece[1]
            if score > best[end]:
                best[end], back[end] = score, piece
        ids, at = [], n
        while at:
            if back[at] is None:
                ids += reversed(self._fallback(chunk[at - 1]))
                at -= 1
            else:
                ids.append(back[at][2])
                at -= back[at][0]
        return ids[::-1]

    def _known(self, chunk: str) -> tuple[bytes, bytes]:
        """A chunk's ids, packed as 32-bit integers, and the bytes they decode to."""
        ids = self.path(chunk)
        return np.array(ids, np.int32).tobytes(), b"".join(map(self.bytes_of.__getitem__, ids))

    def parts(self, text: str) -> list[tuple[bytes, bytes]]:
        """Ids and decoded bytes of the text's chunks."""
        out, chunks = [], self.chunks if any(p in text for p in self.mixed) else self.fine
        # a literal space sign is cut out and written as its bytes
        for k, span in enumerate((" " + text).split(SPACE)):
            if k:
                ids = self._fallback(SPACE)
                out.append((np.array(ids, np.int32).tobytes(), b"".join(map(self.bytes_of.__getitem__, ids))))
            out += map(self.memory.__getitem__, chunks(span.replace(" ", SPACE)))
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids as packed 32-bit integers."""
        return b"".join([ids for ids, _ in self.parts(text)]) if text else b""

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def codec(path: str) -> Codec:
    """One codec per Python worker and model."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip`` of every row; ``round_trip`` says that
    decoding the ids gave the text back. NULL and empty texts have no ids (and
    come back); repeated rows and NULL ids keep their rows; an empty table gives
    an empty result; other columns are not read. Whole texts of any length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            texts = b.column("text")
            start, packed, same, total = 0, [], [], 0
            for k in range(len(texts)):
                t = texts[k].as_py()
                parts = c.parts(t) if t else []
                ids = b"".join([i for i, _ in parts])
                packed.append(ids)
                same.append(not t or b"".join([d for _, d in parts]) == b" " + t.encode())
                total += len(ids) // 4
                if total >= OUT_IDS or k == len(texts) - 1:
                    offsets = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
                    values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").slice(start, k + 1 - start), pa.ListArray.from_arrays(pa.array(offsets), values),
                         pa.array(np.diff(offsets), pa.int64()), pa.array(same)],
                        ["doc_id", "ids", "n_tokens", "round_trip"])
                    start, packed, same, total = k + 1, [], [], 0

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")


def decode(tokens: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of each row's ids (NULL ids: NULL)."""
    @pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        c = codec(model_path)
        return pd.Series([None if r is None else c.decode(list(r)) for r in rows], dtype=object)
    return tokens.withColumn("decoded", text(F.col(ids)))
