"""Byte-level BPE encoding and decoding by longest match and backtracking.

Bytes become Latin-1 characters, so one Aho-Corasick automaton finds the longest token that starts at
every place of a piece.  The encoder goes from left to right with the longest token; a token may follow
another only if the two are *compatible*: plain merging of their joined bytes gives back just these two.
Where no token fits, it steps back and tries the next shorter one.  No place is visited again once found
dead, so the work is linear in the piece, and the result is what merging by rank gives.  Compatibility of
token pairs and the split of a token are memoised.

Texts are cut by a pattern first and every match is encoded apart; a match that is itself a token is that
token.  Defined cases: a null or empty text has no ids and decodes to nothing; repeated rows are encoded
each; an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import importable_in_workers, text_slices

#: Pieces whose ids a Python worker remembers; the memory is emptied when full.
CACHE_PIECES = 400_000


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            self.automaton.add_word(token, (len(token), rank))
        self.automaton.make_automaton()
        self.compatible = lru_cache(1 << 18)(self._compatible)
        self.split = lru_cache(1 << 17)(self._split)
        self.shorter = lru_cache(1 << 17)(self._shorter)

    @classmethod
    def from_file(cls, path: str) -> "BytePairEncoder":
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))})

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte or an unreachable token."""
        parts = list(self.tokens[token])
        while len(parts) > 2:
            merges = [(r, i) for i in range(len(parts) - 1)
                      if (r := self.ids.get(parts[i] + parts[i + 1])) is not None and r < token]
            if not merges:
                return None
            _, i = min(merges)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (self.ids[parts[0]], self.ids[parts[1]]) if len(parts) == 2 else None

    def _shorter(self, token: int) -> int | None:
        """The longest token that begins ``token`` and is shorter."""
        text = self.tokens[token]
        return next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), None)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves ``left`` and ``right`` standing side by side.

        Undoes the merges of both from the latest on; the pair at the border must never have been
        a merge that comes before the one just undone.
        """
        limit = 1 << 62
        while True:
            joined = self.ids.get(self.tokens[left] + self.tokens[right])
            if joined is not None and joined < limit and self.split(joined) == (left, right):
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            # undo the later merge; of equal ranks the left one was done first, so the right is undone first
            if b is None or (a is not None and left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def encode(self, piece: str) -> list[int]:
        """Ids of one piece given as Latin-1 text of its bytes."""
        if (whole := self.ids.get(piece)) is not None:
            return [whole]
        n = len(piece)
        longest: list[int] = [0] * n
        length = [0] * n
        for end, (size, token) in self.automaton.iter(piece):
            start = end + 1 - size
            if size > length[start]:
                length[start], longest[start] = size, token
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else None
        tokens, compatible = self.tokens, self.compatible
        while token is not None:
            end = at + len(tokens[token])
            if alive[end] and (not out or compatible(out[-1], token)) and (len(tokens[token]) == 1 or self.split(token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else None
                continue
            token = self.shorter(token)
            while token is None:  # nothing fits here: step back over the last token
                alive[at] = 0
                token = out.pop()
                at -= len(tokens[token])
                token = self.shorter(token)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return "".join(map(self.tokens.__getitem__, ids)).encode("latin-1")


class TextEncoder:
    """Cuts texts by a pattern and remembers the ids of pieces seen."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.bpe = BytePairEncoder.from_file(path)
        self.findall = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def pieces(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(piece index per match, offsets per text, distinct pieces)."""
        found = [self.findall(t) if t else [] for t in texts]
        offsets = np.cumsum([0, *map(len, found)])
        flat = pa.array([p for f in found for p in f], pa.string()).dictionary_encode()
        return flat.indices.to_numpy(), offsets, flat.dictionary.to_pylist()

    def ids_of(self, pieces: list[str]) -> list[tuple[int, ...]]:
        known, encode = self.known, self.bpe.encode
        if len(known) > CACHE_PIECES:
            known.clear()
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = known[p] = tuple(encode(p.encode().decode("latin-1")))
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return [i for ids in self.ids_of(self.findall(text)) for i in ids]


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(path: str, pattern: str) -> TextEncoder:
    """The worker's encoder for a vocabulary file; read once in each Python process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TextEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def _ids(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                index, offsets, pieces = encoder.pieces(texts.to_pylist())
                ids, index = encoder.ids_of(pieces), index.tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)),
                    pa.array([[i for k in index[a:b] for i in ids[k]] for a, b in zip(offsets[:-1], offsets[1:])],
                             pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return encode


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    importable_in_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_ids(path, pattern), "doc_id long, ids array<int>")


def _decoded(path: str, pattern: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = text_encoder(path, pattern).bpe
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([bpe.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.binary())],
                names=["doc_id", "bytes"])
    return decode


def decode_documents(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids)."""
    importable_in_workers(ids.sparkSession)
    return ids.select("doc_id", "ids").mapInArrow(_decoded(path, pattern), "doc_id long, bytes binary")


def _digests(path: str, pattern: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                index, offsets, pieces = encoder.pieces(texts.to_pylist())
                ids = encoder.ids_of(pieces)
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                written = [" ".join(map(str, i)) for i in ids]
                decoded = [encoder.bpe.decode(i) for i in ids]
                rows = []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    own = index[a:b].tolist()
                    rows.append((int(counts[index[a:b]].sum()),
                                 hashlib.sha256(" ".join(map(written.__getitem__, own)).encode()).hexdigest(),
                                 hashlib.sha256(b"".join(map(decoded.__getitem__, own))).hexdigest()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)),
                    *[pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return digest


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Ids and decoded bytes are digested inside the task, so the token ids never leave it.
    """
    importable_in_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_digests(path, pattern),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
