"""Exact dedup with counting quotient filters.

Every partition builds counting quotient filters of its texts' 64-bit fingerprints: a fingerprint is
split into quotient and remainder, the remainders of a quotient stand sorted in one run, each with its
count.  The filters are cut into blocks of neighbouring quotients; the blocks of all partitions meet
and merge losslessly, because their remainders are sorted and counts add up.  Fingerprints with a count
above one route their documents to byte verification: documents are the same only if their whole texts are.

Of equal texts the row with the largest id stays (nulls lose).  Defined cases: a null text counts as
empty; rows that repeat id and text all count in ``group_size`` and one of them stays; an empty table
gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.llm.common import Scratch, fresh, key_split

#: Quotient bits within a block of the filter, and fingerprints a block holds on average.
QUOTIENT_BITS = 12
BLOCK_ROWS = 1 << 18
#: Distinct fingerprints a partition gathers before it emits its filters.
BUFFER_ROWS = 1 << 20


class CountingQuotientFilter:
    """Sorted runs of remainders with counts; ``shift`` low bits of a fingerprint are its remainder.

    ``run_lengths`` has one entry for each quotient of the block: how many remainders its run holds.
    """

    def __init__(self, run_lengths: np.ndarray, remainders: np.ndarray, counts: np.ndarray, shift: int):
        self.run_lengths, self.remainders, self.counts, self.shift = run_lengths, remainders, counts, shift

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray, shift: int) -> "CountingQuotientFilter":
        """``fingerprints``: bits within the block, sorted and distinct."""
        quotients = (fingerprints >> np.uint64(shift)).astype(np.int64)
        lengths = np.bincount(quotients, minlength=1 << QUOTIENT_BITS).astype(np.uint32)
        return cls(lengths, fingerprints & np.uint64((1 << shift) - 1), counts, shift)

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(len(self.run_lengths), dtype=np.uint64), self.run_lengths)
        return (quotients << np.uint64(self.shift)) | self.remainders

    @classmethod
    def merge(cls, filters: list["CountingQuotientFilter"]) -> "CountingQuotientFilter":
        """All filters' runs, merged in order of quotient and remainder; equal remainders add their counts."""
        keys = np.concatenate([f.fingerprints() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(keys, kind="stable")  # a merge of sorted runs
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return cls.build(keys[first], np.add.reduceat(counts, first), filters[0].shift)

    def to_bytes(self) -> tuple[bytes, bytes, bytes]:
        return self.run_lengths.tobytes(), self.remainders.tobytes(), self.counts.tobytes()

    @classmethod
    def from_bytes(cls, runs: bytes, remainders: bytes, counts: bytes, shift: int) -> "CountingQuotientFilter":
        return cls(np.frombuffer(runs, np.uint32), np.frombuffer(remainders, np.uint64),
                   np.frombuffer(counts, np.int64), shift)


def _build_filters(block_bits: int):
    shift = 64 - block_bits - QUOTIENT_BITS
    low = np.uint64((1 << (64 - block_bits)) - 1)

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        blocks = (keys >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(keys), np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True])))
        rows = [(int(blocks[a]), *CountingQuotientFilter.build(keys[a:b] & low, counts[a:b].astype(np.int64), shift).to_bytes())
                for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))],
                                          names=["block", "runs", "remainders", "counts"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy().view(np.uint64))
                n += batch.num_rows
            if n >= BUFFER_ROWS:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)
    return build


def _merge_filters(block_bits: int):
    shift = 64 - block_bits - QUOTIENT_BITS

    def merge(block: pa.Table) -> pa.Table:
        parts = [CountingQuotientFilter.from_bytes(a, b, c, shift) for a, b, c in zip(
            block["runs"].to_pylist(), block["remainders"].to_pylist(), block["counts"].to_pylist())]
        whole = CountingQuotientFilter.merge(parts)
        many = whole.counts > 1
        high = np.uint64(block["block"][0].as_py()) << np.uint64(64 - block_bits) if block_bits else np.uint64(0)
        prints = (whole.fingerprints()[many] | high).view(np.int64)
        return pa.table({"fingerprint": pa.array(prints, pa.int64()), "times": pa.array(whole.counts[many], pa.int64())})
    return merge


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """(fingerprint, times) of the long column ``fingerprint``'s values that occur more than once."""
    block_bits = max(0, (rows // BLOCK_ROWS).bit_length())
    filters = prints.select("fingerprint").mapInArrow(
        _build_filters(block_bits), "block long, runs binary, remainders binary, counts binary")
    return filters.groupBy("block").applyInArrow(_merge_filters(block_bits), "fingerprint long, times long")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256)."""
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    whole = whole.withColumn("fingerprint", F.xxhash64("text"))
    narrow = scratch.keep(whole.select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_sha256")), "prints")
    repeated = scratch.keep(repeated_fingerprints(narrow, narrow.count()), "repeated")
    # byte verification: the whole text is part of the group's key; map-side partial sums shrink hot groups
    groups = (whole.join(repeated.select("fingerprint"), "fingerprint", "left_semi")
              .groupBy("fingerprint", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    # rows that repeat both id and text: one of them stays; numbered before the join, by a key that copies don't share
    nth = F.row_number().over(Window.partitionBy("doc_id", "fingerprint", "text_sha256").orderBy(F.lit(1)))
    told = narrow.withColumn("nth", nth).join(groups, ["fingerprint", "text_sha256"], "left")
    single = F.col("group_size").isNull()
    return told.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))).alias("kept"),
        "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    told = Scratch(docs.sparkSession).keep(exact_copies(docs, id_col, text_col).where(~F.col("kept")), "gone")
    twin = F.col("doc_id").eqNullSafe(F.col("keep_id"))  # repeats id and text of a row that stays
    gone_id, sha, is_twin = fresh(docs.columns, "gone_id", "gone_sha", "gone_twin")
    gone = told.select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(sha), twin.alias(is_twin)).distinct()
    same = (F.col(id_col).cast("long").eqNullSafe(F.col(gone_id))
            & (F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256) == F.col(sha)))
    # only rows whose id may be among the gone ones are shuffled
    key, = fresh(docs.columns, "gone_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long")))
    may, sure = key_split(keyed, key, gone.where(~F.col(is_twin)).select(F.xxhash64(gone_id).alias(key)))
    stays = sure.drop(key).unionByName(may.drop(key).join(gone.where(~F.col(is_twin)), same, "left_anti"))
    twins = gone.where(is_twin)
    if twins.isEmpty():
        return stays
    return (stays.join(twins, same, "left_anti")
            .unionByName(stays.join(twins, same, "left_semi").dropDuplicates([id_col, text_col])))
