"""Ranked lexical search with hashed max-sketches.

**Index.**  A document's terms fold into a sketch of a power of two of coordinates, ``SPARSITY`` for each of its
distinct terms: coordinate ``hash(term) mod width`` holds the largest term frequency that falls there.  As a
document's impact ``(10^9 tf) div (1000 tf + 20 m)`` grows with tf, the impact of that maximum is the maximum of the
impacts, whatever the corpus statistics are when a query comes; the index stays right when documents are added.
Beside the sketch stand the document's exact terms (64-bit hashes) and frequencies.

**Search.**  A batch of queries looks up its terms in every sketch; the sum of weight times impact of the coordinates
is an upper bound of the score.  In descending order of bound documents are scored exactly until the next bound lies
under the threshold.  Two passes do so: in the first, every task finds a few best documents for each query, and the
k-th best of these over all tasks is a lower bound of the k-th best score of all; the second starts from this
threshold, so a task scores only what may still be among the best of the whole corpus, however many tasks there are.

All numbers of the score are integers, the weight ``floor(1000 ln((2N + 2) / (2df + 1)))`` comes from doubles.  N, the
sum of lengths and document frequencies count all documents.  Queries are worked off in blocks of about ``BLOCK_TERMS``
terms, which bounds what goes to a worker; documents are never held whole by the driver.

Defined cases: a null text has no terms; an item without terms gets no rows, as does one that no document matches;
rows that repeat an item id or a document id are items and documents of their own; of equal scores the smaller
document id ranks first, null ids last; a text of any length is read whole; empty tables give an empty result; other
columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.llm.common import Scratch, split_words, spread, text_slices
from roaskit.llm.jaccard import word_hashes

#: Coordinates of a sketch for each distinct term of its document, and coordinates at least.
SPARSITY, LEAST_WIDTH = 8, 64
#: Term frequencies from here on share one code, whose impact counts as the limit of all impacts.
SATURATED = 255
#: The limit of ``(10^9 tf) div (1000 tf + 20 m)``.
LARGEST_IMPACT = 1_000_000
#: Terms of the queries that go to workers at once.
BLOCK_TERMS = 100_000
#: Bytes of sketches, and impacts (documents x terms of the queries), that a task handles at once.
SLICE_BYTES, SLICE_IMPACTS = 1 << 20, 1 << 20
#: Best documents of each task and query that set the threshold, over all tasks and at least for each.
SEEDS, LEAST_SEEDS = 200, 8

#: Byte to byte: A-Z to a-z; what belongs to no term (all ASCII but letters and digits) to a space.
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                 for c in range(256)], np.uint8)


def split_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of each text: (term index per term, offsets per text, distinct terms)."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    folded = FOLD[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data is not None else np.empty(0, np.uint8)
    moved = pa.py_buffer(np.ascontiguousarray(ends - ends[0]))
    return split_words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, moved, pa.py_buffer(folded)]))


def sketch(hashes: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """The largest (saturated) frequency at each coordinate."""
    width = max(LEAST_WIDTH, 1 << (SPARSITY * max(1, len(hashes)) - 1).bit_length())
    out = np.zeros(width, np.uint8)
    np.maximum.at(out, (hashes & np.uint64(width - 1)).astype(np.int64), np.minimum(tfs, SATURATED).astype(np.uint8))
    return out


INDEX = "doc_id long, n long, peaks binary, terms binary, tfs binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to rows of the index."""
    for batch in batches:
        for row, texts in text_slices(batch.column(1)):
            index, offsets, distinct = split_terms(texts)
            hashed = word_hashes(distinct)
            peaks, terms, tfs = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own, counts = np.unique(index[a:b], return_counts=True)
                order = np.argsort(hashed[own])
                own, counts = hashed[own][order], counts[order].astype(np.uint32)
                peaks.append(sketch(own, counts).tobytes())
                terms.append(own.tobytes())
                tfs.append(counts.tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, len(texts)), pa.array(np.diff(offsets), pa.int64()),
                *[pa.array(c, pa.binary()) for c in (peaks, terms, tfs)]], names=[f.split()[0] for f in INDEX.split(", ")])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_no, text) to (item_no, distinct term hashes)."""
    for batch in batches:
        for row, texts in text_slices(batch.column(1)):
            index, offsets, distinct = split_terms(texts)
            hashed = word_hashes(distinct)
            sets = [np.unique(hashed[index[a:b]]).view(np.int64) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["item_no", "terms"])


@dataclass
class Block:
    """A block of queries: sorted vocabulary, and each query's number and places in the vocabulary."""
    vocabulary: np.ndarray
    items: list[int]
    places: list[np.ndarray]
    weights: np.ndarray | None = None
    documents: int = 0
    total: int = 0


def make_block(rows: list) -> Block:
    """A block from (item_no, terms) rows that have terms."""
    lists = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    vocabulary = np.unique(np.concatenate(lists))
    return Block(vocabulary, [r["item_no"] for r in rows], [np.searchsorted(vocabulary, x) for x in lists])


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def spread_of(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents of n terms: 100 - 50 + (50 n N) div L; 0 terms never match."""
    if documents * int(n.max(initial=0)) < 1 << 56:
        return 50 + 50 * n * documents // max(total, 1)
    return np.array([50 + 50 * int(x) * documents // max(total, 1) for x in n], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // np.maximum(1000 * tf + 20 * m, 1)


def _found(terms: pa.Array, tfs: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the vocabulary, frequency) of the documents' terms that stand in the vocabulary, sorted."""
    lists = terms.to_pylist()
    rows = np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists])
    hashed, counts = np.frombuffer(b"".join(lists), np.uint64), np.frombuffer(b"".join(tfs.to_pylist()), np.uint32)
    place = np.minimum(np.searchsorted(vocabulary, hashed), len(vocabulary) - 1)
    hit = vocabulary[place] == hashed if len(vocabulary) else np.zeros(0, bool)
    return rows[hit], place[hit], counts[hit].astype(np.int64)


def _document_counts(block: Block) -> Callable:
    """(terms, tfs) to (place in the vocabulary, documents): one row for each term that the task met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(block.vocabulary), np.int64)
        for batch in batches:
            counts += np.bincount(_found(batch.column(0), batch.column(1), block.vocabulary)[1], minlength=len(counts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(counts[met], pa.int64())], names=["place", "df"])
    return run


class _Best:
    """The best k (score, document) of one query so far."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, max(threshold, 1)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.threshold
        scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
        best = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.k:  # equal scores may still come with a smaller id
            self.threshold = max(self.threshold, int(self.scores[-1]))


def bounds(peaks: np.ndarray, m: np.ndarray, block: Block) -> np.ndarray:
    """Upper bounds (documents x queries) from sketches of one width."""
    columns = (block.vocabulary & np.uint64(peaks.shape[1] - 1)).astype(np.int64)
    tf = np.ascontiguousarray(peaks.T)[columns].astype(np.int64)
    top = np.where(tf >= SATURATED, LARGEST_IMPACT, impacts(tf, m[None, :])).astype(np.float64)
    top *= block.weights[:, None]
    return np.stack([top[p].sum(0) for p in block.places], 1)  # whole numbers far below 2^53


class _Scorer:
    """Exact scores of (document, query) pairs of one slice."""

    def __init__(self, rows: np.ndarray, place: np.ndarray, tf: np.ndarray, m: np.ndarray, block: Block):
        self.block, self.size = block, len(block.vocabulary)
        self.keys = rows * self.size + place
        self.worth = impacts(tf, m[rows]) * block.weights[place]

    def __call__(self, documents: np.ndarray, queries: np.ndarray) -> np.ndarray:
        lengths = np.array([len(p) for p in self.block.places])
        starts = np.cumsum(lengths) - lengths
        places = np.concatenate(self.block.places)[spread(starts[queries], lengths[queries])]
        pair = np.repeat(np.arange(len(documents)), lengths[queries])
        keys = documents[pair] * self.size + places
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.zeros(len(documents), np.int64)
        np.add.at(out, pair[hit], self.worth[at[hit]])
        return out


#: A null document id sorts after all others inside a task.
NO_ID = np.iinfo(np.int64).max


def _slices(batch: pa.RecordBatch, terms: int) -> Iterator[np.ndarray]:
    """Rows with equally wide sketches, as many as are handled at once with ``terms`` terms of queries."""
    widths = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        step = max(1, min(SLICE_BYTES // int(width), SLICE_IMPACTS // terms))
        for k in range(0, len(rows), step):
            yield rows[k:k + step]


def _search(block: Block, k: int, thresholds: list[int]) -> Callable:
    """Rows of the index to each query's best k documents of the task that reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k, t) for t in thresholds]
        for batch in batches:
            for rows in _slices(batch, len(block.vocabulary)):
                part = batch.take(pa.array(rows))
                ids = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                m = spread_of(part.column(1).to_numpy(zero_copy_only=False), block.documents, block.total)
                peaks = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(part), -1)
                top = bounds(peaks, m, block)
                exact = None
                for first in (True, False):  # the k highest bounds raise the threshold for the rest
                    asked: list[tuple[np.ndarray, int]] = []
                    for q, b in enumerate(best):
                        may = np.flatnonzero(top[:, q] >= b.threshold)
                        if first and len(may) > k:
                            may = may[np.argpartition(-top[may, q], k - 1)[:k]]
                        if len(may):
                            asked.append((may, q))
                    if not asked:
                        break
                    exact = exact or _Scorer(*_found(part.column(3), part.column(4), block.vocabulary), m, block)
                    queries = np.repeat([q for _, q in asked], [len(may) for may, _ in asked])
                    documents = np.concatenate([may for may, _ in asked])
                    scores, at = exact(documents, queries), 0
                    for may, q in asked:
                        best[q].add(scores[at:at + len(may)], ids[may])
                        at += len(may)
                        top[may, q] = -1
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(block.items, [len(b.ids) for b in best]), pa.int64()),
            pa.array([None if i == NO_ID else int(i) for b in best for i in b.ids], pa.int64()),
            pa.array(np.concatenate([b.scores for b in best]), pa.int64())], names=["item_no", "doc_id", "score"])
    return run


FOUND = "item_no long, doc_id long, score long"


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items with terms, about ``BLOCK_TERMS`` terms at a time."""
    full = items.where(F.size("terms") > 0)
    terms = full.agg(F.sum(F.size("terms").cast("long"))).first()[0] or 0
    count = -(-terms // BLOCK_TERMS)
    for b in range(count):
        rows = full.where(F.pmod(F.xxhash64("item_no"), F.lit(count)) == b).orderBy("item_no").collect()
        if rows:
            yield rows


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): every item's k best documents with a score above 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index = scratch.keep(texts.mapInArrow(_index, INDEX), "index")
    stats = (index.withColumn("task", F.spark_partition_id())
             .agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("total"),
                  F.count_distinct("task").alias("tasks")).first())

    numbered = scratch.keep(items.select(F.monotonically_increasing_id().alias("item_no"), F.col(item_col).alias("item_id"),
                                         F.col(item_text_col).alias("text")), "items")
    terms = scratch.keep(numbered.select("item_no", "text").mapInArrow(_item_terms, "item_no long, terms array<long>"), "terms")
    seeds = min(k, max(LEAST_SEEDS, -(-SEEDS // max(stats["tasks"], 1))))
    found, best = None, Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for number, rows in enumerate(_blocks(terms)):
        block = make_block(rows)
        block.documents, block.total = stats["documents"], stats["total"] or 0
        counted = index.select("terms", "tfs").mapInArrow(_document_counts(block), "place long, df long")
        df = {r["place"]: r["df"] for r in counted.groupBy("place").agg(F.sum("df").alias("df")).collect()}  # the block's vocabulary
        block.weights = np.array([weight(block.documents, df.get(p, 0)) for p in range(len(block.vocabulary))], np.int64)
        tops = index.mapInArrow(_search(block, seeds, [0] * len(block.items)), FOUND)
        tops = tops.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        reached = {r["item_no"]: r["score"] for r in tops.select("item_no", "score").collect()}  # one number a query
        told = index.mapInArrow(_search(block, k, [reached.get(i, 0) for i in block.items]), FOUND)
        told = scratch.keep(told.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), f"found{number}")
        found = told if found is None else found.unionByName(told)
    scratch.drop("index")
    if found is None:
        found = spark.createDataFrame([], f"{FOUND}, rank int")
    return found.join(numbered.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
