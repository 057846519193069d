"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.session import delete_at_exit, ensure_checkpoint_dir, importable_in_workers

#: Bytes of text handled at once inside a task; bounds a worker's memory whatever the batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fresh scan of one table (nothing is kept between calls)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_in_slices(spark: SparkSession) -> None:
    """Let no Arrow batch of this session pass ``SLICE_BYTES`` (but for one longer row): 10,000 texts in one, Spark's own
    bound in rows, take hundreds of MB of an executor in both processes.  A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(name))
    if now is None or not 0 < int(now[1]) <= SLICE_BYTES:
        spark.conf.set(name, SLICE_BYTES)


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    A written table cuts the lineage, is read by every executor, and survives the loss of the
    executor that wrote it.  The folder comes from ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession):
        importable_in_workers(spark)
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        delete_at_exit(spark, self.base)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """Write ``df`` and read it again."""
        df.write.option("compression", compression).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table written by this object that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of a key filter.
FILTER_BITS = 1 << 24


def _filter_words(wanted: DataFrame) -> np.ndarray:
    """The bits of the wanted keys, at most ``FILTER_BITS / 64`` rows of the driver."""
    name = wanted.columns[0]
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{name}`, 64) as int))")
    slots = wanted.select(F.expr(f"cast(pmod(`{name}`, {FILTER_BITS}) div 64 as int)").alias("word"), bit.alias("bit"))
    held = slots.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    words[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return words


def _passing(sent, at: int, wanted: bool):
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = sent.value
        for batch in batches:
            slot = batch.column(at).to_numpy(zero_copy_only=False) % FILTER_BITS
            keep = (filled[slot // 64] >> (slot % 64).astype(np.uint64) & np.uint64(1)).astype(bool) == wanted
            if keep.any():
                yield batch if keep.all() else batch.filter(pa.array(keep))
    return passing


def key_filter(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` (a long that spreads evenly, as a hash does) may be among the wanted ones.

    A cheap step before a join by that key, for rows that are costly to shuffle: wanted keys set bits of a filter
    of fixed size, which is broadcast.  Some other rows pass too, more of them the more keys are wanted.
    """
    return key_split(rows, key, wanted)[0]


def key_split(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may be among the wanted ones, and those whose key surely is not."""
    sent, at = rows.sparkSession.sparkContext.broadcast(_filter_words(wanted)), rows.columns.index(key)
    may, sure = (rows.mapInArrow(_passing(sent, at, w), rows.schema) for w in (True, False))
    return may, sure


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names like these that no column has (Spark does not tell case apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def give_back_memory() -> None:
    """Hand memory that Arrow's pool and the allocator keep back to the system: workers live through many stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) pieces of at most ``SLICE_BYTES`` of text, or of lists of 32-bit ids; one longer row stands alone."""
    listed = pa.types.is_list(texts.type) or pa.types.is_large_list(texts.type)
    sizes = pc.fill_null(pc.multiply(pc.list_value_length(texts), 4) if listed else pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > SLICE_BYTES:
            yield start, texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield start, texts.slice(start)
    give_back_memory()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space of each text: (word index per word, offsets per text, distinct words).

    White space is exactly ``[\\x20\\x09-\\x0D]``; a null text has no words.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = words.flatten()
    offsets = words.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # leading and trailing white space gives empty strings
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The runs of rows that are equal in their first ``keys`` columns (integers without nulls), of sorted batches.

    Holds one run and one batch at a time.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        edges = [0, *cuts.tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... for each (start, length), one after another."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)
