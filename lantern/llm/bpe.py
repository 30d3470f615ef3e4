"""Byte-level BPE encoding and decoding with pyahocorasick.

Bytes become Latin-1 characters, so an Aho-Corasick automaton over the vocabulary finds every token in a piece of
text at once. Encoding takes the longest token at each place and backtracks to shorter ones wherever a token may not
stand beside the one before it; that test replays the merges of the two tokens and is memoised, as are whole pieces.
The result is that of the merges in rank order. Only the vocabulary (bounded) is broadcast.

Defined results: null text counts as empty and has no tokens; ids may be null or repeated (one row for each input
row); other columns are ignored; an empty table gives an empty result; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.llm.common import release

#: Pieces whose ids a worker keeps at most; beyond that the memory starts anew, which changes no result.
KEEP_PIECES = 300_000
_codecs: dict[str, "Codec"] = {}


class Codec:
    """ranks: the lines of a .tiktoken file; ids are ranks, lower ones merge first."""

    def __init__(self, ranks: bytes, pattern: str):
        import ahocorasick
        import regex

        self.token = {int(rank): base64.b64decode(word) for word, rank in map(bytes.split, ranks.splitlines()) if word}
        self.id_of = {word: i for i, word in self.token.items()}
        self.find = regex.compile(pattern).findall
        self.compatible: dict[int, bool] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves = {i: (i, i) for i, word in self.token.items() if len(word) == 1}
        self.shorter: dict[int, int] = {}
        self.searcher = ahocorasick.Automaton()
        for i in sorted(self.token):
            word = self.token[i]
            self.searcher.add_word(word.decode("latin-1"), (i, len(word)))
            if len(word) > 1:
                self._learn(i, word)
        self.searcher.make_automaton()
        for i, word in self.token.items():
            cut = next((n for n in range(len(word) - 1, 0, -1) if word[:n] in self.id_of), 0)
            if cut:
                self.shorter[i] = self.id_of[word[:cut]]
        self.compatible.clear()  # was asked before all merges were known
        self.pieces = _Pieces(self)

    def _learn(self, i: int, word: bytes) -> None:
        """The two tokens whose merge makes this one: those that stay apart under all lower ranks."""
        for cut in range(1, len(word)):
            left, right = self.id_of.get(word[:cut], i), self.id_of.get(word[cut:], i)
            if left < i and right < i and self._apart(left, right):
                self.halves[i] = (left, right)
                self.merged[left, right] = i
                return
        raise ValueError(f"token {i} isn't made by a merge")

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges inside both tokens are done.

        Going back through the merges, the one of higher rank of the two was made last and is undone first; a merge
        of what then stands at the border counts if it ranks below every merge undone so far.
        """
        last = 1 << 62
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < last:
                return False
            a, b = self.halves[left], self.halves[right]
            undo_left, undo_right = a[0] != a[1] or len(self.token[left]) > 1, b[0] != b[1] or len(self.token[right]) > 1
            if not undo_left and not undo_right:
                return True
            if undo_left and (left > right or not undo_right):
                last, left = left, a[1]  # at the same rank the left one of two equal merges is made first
            else:
                last, right = right + 1, b[0]

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) > 2 * KEEP_PIECES:
                self.compatible.clear()
            known = self.compatible[key] = self._apart(left, right)
        return known

    def encode_piece(self, raw: bytes) -> list[int]:
        whole = self.id_of.get(raw)
        if whole is not None:
            return [whole]
        end = len(raw)
        longest: list[int | None] = [None] * (end + 1)
        size = [0] * end
        for stop, (i, n) in self.searcher.iter(raw.decode("latin-1")):
            at = stop - n + 1
            if n > size[at]:
                size[at], longest[at] = n, i
        dead = bytearray(end + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while token is not None:
            before = out[-1] if out else None
            while token is not None:
                to = at + len(self.token[token])
                if not dead[to] and (before is None or self.may_follow(before, token)):
                    break
                token = self.shorter.get(token)
            if token is not None:
                out.append(token)
                at = to
                token = longest[at]
            else:  # nothing fits here: the token before must be shorter
                dead[at] = 1
                token = out.pop()
                at -= len(self.token[token])
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.find(text))))

    def forget(self) -> None:
        """Drops what is memoised, at the end of a task."""
        self.pieces.clear()
        self.compatible.clear()
        release()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Pieces(dict):
    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) > KEEP_PIECES:
            self.clear()
        ids = tuple(self.codec.encode_piece(piece.encode("utf-8", "surrogatepass")))
        if len(piece) < 64:
            self[piece] = ids
        return ids


def codec(ranks: bytes, pattern: str) -> Codec:
    """One for each vocabulary and Python worker."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def _ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each text. vocabulary: the driver's path of a .tiktoken file."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        own.forget()

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and data (binary), the bytes that the ids stand for; null ids count as none."""
    ranks = encoded.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            data = [own.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    d = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids and keeps digests, in one pass."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        decimal = {i: str(i) for i in own.token}.__getitem__
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
