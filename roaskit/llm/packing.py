"""Best-fit packing: documents into sequences of bounded length.

Best-fit decreasing over the *lengths*: pieces of one length are interchangeable, so the plan needs
only how many pieces there are of each length (at most ``capacity`` numbers).  Lengths are handled
from long to short; a segment tree over remaining capacities finds the tightest open bin in
logarithmic time, and a run of equal bins takes a run of equal pieces in one step.  The runs say
where the j-th piece of each length goes, so Spark places all pieces with one rank and one join.

Defined cases: a null or empty text is one piece holding only the end id; repeated rows are packed
each; an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.llm.common import Scratch, split_words, spread, text_slices

CAPACITY = 2048
END_ID = 0
#: Pieces ranked together in one task.
RANK_ROWS = 100_000
#: Bytes of words and ids that a Python worker remembers, and words that go through the tokenizer together.
CACHE_BYTES, WORDS_TOGETHER = 32 << 20, 100

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class RemainingCapacities:
    """Segment tree over capacities 0..n: which have an open bin, and the least one of at least s."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.size
        self.any[i] = is_open
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, s: int) -> int | None:
        i = s + self.size
        if self.any[i]:
            return s
        while i > 1 and not (i % 2 == 0 and self.any[i + 1]):
            i //= 2
        if i <= 1:
            return None
        i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces of each length.

    Returns runs (length, first rank, end rank, pieces per bin, first bin, offset in the bin): the
    pieces of that length with ranks in the range fill consecutive bins, that many in each.
    """
    tree = RemainingCapacities(capacity)
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs, made = [], 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            bins[room].append((first, n))
            tree.set(room, True)

    for s in sorted(counts, reverse=True):
        rank, end = 0, counts[s]
        while rank < end:
            room = tree.tightest(s)
            if room is None:
                room, first, n = capacity, made, -(-(end - rank) // (capacity // s))
                made += n
            else:
                first, n = bins[room].pop()
                if not bins[room]:
                    tree.set(room, False)
            each = room // s
            put = min(end - rank, n * each)
            full, rest = divmod(put, each)
            runs.append((s, rank, rank + put, each, first, capacity - room))
            leave(room - each * s, first, full)
            leave(room - rest * s, first + full, 1 if rest else 0)
            used = full + (1 if rest else 0)
            leave(room, first + used, n - used)
            rank += put
    return runs


class WordIds:
    """Token ids of texts, each distinct word between ASCII white space encoded once.

    The tokenizer drops white space and handles the words between it apart from each other, so the
    ids of a text are the ids of its words in order.  New words go through it many at a time: words of
    plain letters are one run of the vocabulary's pieces each, whose last ends a word; between other
    words stands a control character.  What is remembered are two Arrow and numpy buffers of at most
    ``CACHE_BYTES`` (beyond that they start anew), so a worker's memory is bounded whatever the words.

    Strings of special tokens become their ids, as the tokenizer does by itself; with ``literal`` they
    are ordinary text.
    """

    MARK, WORD_END = "\x01", "</w>"
    PLAIN = "^[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+$"

    def __init__(self, path: str, literal: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.WORD_END)]] = True
        mark = self._ids(self.MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids = pa.array([], pa.string()), np.empty(0, np.uint32)
        self.lengths = np.empty(0, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _together(self, words: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids of each) of a few words that go through the tokenizer together."""
        if marked:
            ids = self._ids(f" {self.MARK} ".join(words) + f" {self.MARK}")
            is_mark = ids == self.mark
            lengths, ids = np.diff(np.flatnonzero(is_mark), prepend=-1) - 1, ids[~is_mark]
        else:
            ids = self._ids(" ".join(words))
            lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(lengths) == len(words):
            return ids, lengths
        parts = [self._ids(w) for w in words]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _learn(self, words: pa.Array) -> None:
        plain = pc.match_substring_regex(words, self.PLAIN)
        odd = pc.match_substring(words, self.MARK) if self.mark is not None else pa.array([True] * len(words))
        groups = [(pc.and_not(plain, odd), False, WORDS_TOGETHER), (pc.and_not(pc.invert(plain), odd), True, WORDS_TOGETHER), (odd, False, 1)]
        for mask, marked, step in groups:
            own = words.filter(mask)
            listed = own.to_pylist()
            parts = [self._together(listed[k:k + step], marked) if step > 1 else self._alone(listed[k]) for k in range(0, len(listed), step)]
            self.words = pa.concat_arrays([self.words, own.cast(pa.string())])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in parts)])
            self.lengths = np.concatenate([self.lengths, *(lengths for _, lengths in parts)])

    def _alone(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(word)
        return ids, np.array([len(ids)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets per text)."""
        index, offsets, words = split_words(texts)
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.words.nbytes + self.ids.nbytes + self.lengths.nbytes > CACHE_BYTES:
            self._forget()
        place = pc.index_in(words, value_set=self.words.cast(words.type))
        if place.null_count:
            self._learn(words.filter(place.is_null()))
            place = pc.index_in(words, value_set=self.words.cast(words.type))
        place = place.to_numpy().astype(np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        place = place[index]
        per_word = self.lengths[place]
        ends = np.concatenate(([0], np.cumsum(per_word)))
        return self.ids[spread(starts[place], per_word)], ends[offsets]


_ENCODERS: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str, literal: bool = False) -> WordIds:
    """The worker's encoder for a vocabulary file; read once in each Python process."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, literal) not in _ENCODERS:
        _ENCODERS[path, literal] = WordIds(path, literal)
    return _ENCODERS[path, literal]


def _pieces(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, texts in text_slices(batch.column(1)):
                ids, offsets = encoder.encode(texts)
                out = []
                for k in range(len(texts)):
                    own = np.append(ids[offsets[k]:offsets[k + 1]], END_ID).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start:start + capacity]
                        out.append((doc_ids[row + k], piece, start, len(part), zlib.crc32(part.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return cut


def document_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: only documents longer than ``capacity`` ids (end id included) are cut."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer_path, capacity), PIECES)


def pack_pieces(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that are already written (they are read twice)."""
    spark = pieces.sparkSession
    # at most ``capacity`` rows: one per length
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit_runs(counts, capacity)
    buckets = -(-sum(counts.values()) // RANK_ROWS) or 1
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    cut = pieces.withColumn("bucket", bucket)
    before = (cut.groupBy("length", "bucket").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket"))
                          - F.col("count")).drop("count"))
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cut.withColumn("nth", F.row_number().over(own))
              .join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1))
    plan = spark.createDataFrame(
        runs, "run_length long, first_rank long, end_rank long, each long, first_bin long, base long")
    # the plan's size follows the capacity, not the number of documents
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("run_length"))
                         & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_bin") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + (nth % F.col("each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document of ``docs`` into as few sequences of at most ``capacity`` ids as best fit finds."""
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.keep(document_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    return pack_pieces(pieces, scratch, capacity)
