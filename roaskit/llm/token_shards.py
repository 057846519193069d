"""Training-order materialisation of token sequences in fixed-stride shards.

Token ids of all documents, each ended by an end id, run on as one stream per input partition, which is cut
into sequences of one length; sequences are numbered 0 .. M - 1 in input order.  A keyed Feistel network over the
smallest even number of bits that holds M, walked along its cycle until it lands below M, permutes the numbers:
every sequence has a global slot, each slot one sequence, and no shuffled list is kept anywhere.  Slots are dealt
to shards by range, and a shard is a raw file of equal strides in slot order, so training reads sequentially and
resumes at any slot by arithmetic alone.

Ids come from a tokenizer's vocabulary file (``tokenizer_path``), from a column of ids (``ids_col``), or, by default,
from the byte vocabulary: the bytes of UTF-8, and 255, which UTF-8 never uses, as end id.  An id takes 8, 16 or 32 bits
(little-endian), as the vocabulary needs.  Every text is encoded once: each partition's stream is written, cut into
sequences that carry their partition and number in it, and both the numbering and the dealing read that table.
Only a partition's last sequence is filled up (with end ids), and its used length is recorded: filling is told apart by
place.  A manifest beside the files, written last, holds what a reader needs (key, stride, sequences per shard, total,
ids, used lengths), so another process opens the folder and reads any range of slots from the shards that hold it.

Shard files are written under a name of their own and then moved, so a task that runs again, or twice, leaves the
same files.  Defined cases: a null or empty text or list is its end id alone; null, negative or too large ids raise an
error; repeated rows are written each; an empty table makes no shards; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.llm.common import Scratch, importable_in_workers, text_slices
from roaskit.llm.packing import word_ids

#: The byte vocabulary's end id and number of ids.
END_ID, BYTE_IDS = 255, 256
#: Ids per sequence and sequences per shard.
STRIDE, SHARD_SEQUENCES = 2048, 4096
ROUNDS = 6

#: Sequences that leave a task together.
TOGETHER = 1024

MANIFEST = "manifest.json"
CUT = "part int, nth long, used int, ids binary"
DEALT = "shard long, slot long, ids binary"
WRITTEN = "shard long, sequences long"
READ = "slot long, shard long, offset long, source_index long, n_tokens long, n_ends long, ids_crc32 long"


class Permutation:
    """Keyed permutation of 0 .. size - 1."""

    def __init__(self, size: int, key: int):
        self.size, self.half = size, max(1, -(-max(size - 1, 1).bit_length() // 2))
        self.keys = np.random.default_rng(key).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def _mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def _network(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return left << half | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        x = self._network(np.asarray(x, np.uint64), keys, back)
        while (outside := x >= self.size).any():
            x[outside] = self._network(x[outside], keys, back)
        return x.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


def id_type(vocabulary: int) -> np.dtype:
    """The narrowest of 8, 16 and 32 bits that tells ``vocabulary`` ids apart."""
    return np.dtype("u1" if vocabulary <= 1 << 8 else "<u2" if vocabulary <= 1 << 16 else "<u4")


def _byte_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in pc.fill_null(texts, "").to_pylist()]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def _given_ids(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    if flat.null_count:
        raise ValueError("a list of ids holds a null")
    return flat.to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _with_ends(held: np.ndarray, flat: np.ndarray, offsets: np.ndarray, end_id: int) -> np.ndarray:
    """``held``, then the ids of each document and an end id, in one copy."""
    out = np.empty(len(held) + len(flat) + len(offsets) - 1, held.dtype)
    out[:len(held)] = held
    rest = out[len(held):]
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    own = np.ones(len(rest), bool)
    own[ends] = False
    rest[own], rest[ends] = flat, end_id
    return out


def _sequences(encoder: Callable[[], Callable], end_id: int, vocabulary: int, stride: int):
    """Rows of texts or lists of ids -> sequences of the partition's stream, numbered in their order."""
    kind = id_type(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, held, nth = TaskContext.get().partitionId(), encoder(), np.empty(0, kind), 0

        def rows(ids: np.ndarray, used: int) -> pa.RecordBatch:
            n, size = len(ids) // stride, stride * kind.itemsize
            offsets = np.arange(n + 1, dtype=np.int32) * np.int32(size)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part, np.int32)), pa.array(np.arange(nth, nth + n)), pa.array(np.full(n, used, np.int32)),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])],
                names=["part", "nth", "used", "ids"])

        for batch in batches:
            for _, some in text_slices(batch.column(0)):
                flat, offsets = encode(some)
                if len(flat) and (flat.min() < 0 or flat.max() >= vocabulary):
                    raise ValueError(f"ids from {flat.min()} to {flat.max()} do not fit a vocabulary of {vocabulary}")
                held = _with_ends(held, flat, offsets, end_id)
                whole = len(held) // stride * stride
                for at in range(0, whole, TOGETHER * stride):
                    ids = held[at:min(whole, at + TOGETHER * stride)]
                    yield rows(ids, stride)
                    nth += len(ids) // stride
                held = held[whole:]
        if len(held):
            yield rows(np.concatenate((held, np.full(stride - len(held), end_id, kind))), len(held))
    return cut


def _deal(first_of: dict[int, int], order: Permutation, per_shard: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                first = np.array([first_of[p] for p in batch.column(0).to_pylist()], np.int64)
                slots = order.slot(first + batch.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(slots // per_shard), pa.array(slots), batch.column(2)],
                                                 names=["shard", "slot", "ids"])
    return deal


def _write(base: str):
    """Rows sorted by slot: one file per shard, written apart and then moved."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(base)
        files.create_dir(root)
        shard, held = None, []

        def done() -> pa.RecordBatch:
            draft, name = f"{root}/_draft-{uuid.uuid4().hex}", f"{root}/shard-{shard:010d}.bin"
            with files.open_output_stream(draft) as out:
                for part in held:
                    out.write(part)
            if files.get_file_info(name).type == fs.FileType.NotFound:
                files.move(draft, name)
            else:  # another attempt has written the same bytes
                files.delete_file(draft)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(held)], pa.int64())], names=["shard", "sequences"])

        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != shard and held:
                    yield done()
                    held = []
                shard = k
                held.append(ids)
        if held:
            yield done()
    return write


def _read(order: Permutation, stride: int, per_shard: int, short: dict[int, int], end_id: int, kind: np.dtype,
          from_slot: int, to_slot: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_buffer()
                shard = int(path.rsplit("-", 1)[1].split(".")[0])
                size = stride * kind.itemsize
                n = data.size // size
                own = np.arange(max(0, from_slot - shard * per_shard), min(n, to_slot - shard * per_shard))
                n, slots = len(own), shard * per_shard + own
                strides = np.frombuffer(data, kind).reshape(-1, stride)[own]
                index = order.index(slots)
                used = np.array([short.get(i, stride) for i in index.tolist()], np.int64)
                ends = (strides == end_id) & (np.arange(stride) < used[:, None])
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots), pa.array(np.full(n, shard, np.int64)), pa.array(own * size),
                    pa.array(index), pa.array(used), pa.array(ends.sum(axis=1).astype(np.int64)),
                    pa.array([zlib.crc32(s.tobytes()) for s in strides], pa.int64())], names=[f.split()[0] for f in READ.split(", ")])
    return read


class Shards:
    """Written shards: where they are, how many sequences they hold, in which order, and which are not full.

    ``short`` has the used length of each partition's last sequence by its number; all others are full."""

    def __init__(self, spark: SparkSession, base: str, sequences: int, key: int, stride: int, per_shard: int,
                 short: dict[int, int], end_id: int, kind: np.dtype):
        self.spark, self.base, self.sequences, self.stride, self.per_shard = spark, base, sequences, stride, per_shard
        self.key, self.short, self.end_id, self.kind = key, short, end_id, kind
        self.order = Permutation(max(sequences, 1), key)

    def save(self) -> None:
        """Write the manifest; a folder that has one is whole."""
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.base)
        files.create_dir(root)
        held = {"key": self.key, "stride": self.stride, "sequences_per_shard": self.per_shard, "sequences": self.sequences,
                "end_id": self.end_id, "id_type": self.kind.str, "used": sorted(self.short.items())}
        with files.open_output_stream(draft := f"{root}/_draft-{uuid.uuid4().hex}") as out:
            out.write(json.dumps(held).encode())
        files.move(draft, f"{root}/{MANIFEST}")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Shards":
        """Shards written earlier, by this or another process."""
        from pyarrow import fs

        importable_in_workers(spark)
        files, root = fs.FileSystem.from_uri(path)
        with files.open_input_stream(f"{root}/{MANIFEST}") as data:
            held = json.loads(data.read())
        return cls(spark, path, held["sequences"], held["key"], held["stride"], held["sequences_per_shard"],
                   dict(map(tuple, held["used"])), held["end_id"], np.dtype(held["id_type"]))

    def read(self, from_slot: int = 0, to_slot: int | None = None) -> DataFrame:
        """A row per sequence with from_slot <= slot < to_slot, from the shards that hold these slots."""
        start, end = max(0, from_slot), self.sequences if to_slot is None else min(to_slot, self.sequences)
        if start >= end:
            return self.spark.createDataFrame([], READ)
        files = self.spark.read.format("binaryFile")
        if start < self.per_shard and end > (self.sequences - 1) // self.per_shard * self.per_shard:
            files = files.option("pathGlobFilter", "shard-*.bin").load(self.base)
        else:
            files = files.load([f"{self.base}/shard-{k:010d}.bin" for k in range(start // self.per_shard, -(-end // self.per_shard))])
        return files.select("path", "content").mapInArrow(
            _read(self.order, self.stride, self.per_shard, self.short, self.end_id, self.kind, start, end), READ)


def _empty(path: str) -> bool:
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(path)
    return not files.get_file_info(fs.FileSelector(root, allow_not_found=True))


def write_shards(docs: DataFrame, key: int = 20, stride: int = STRIDE, per_shard: int = SHARD_SEQUENCES,
                 text_col: str = "text", tokenizer_path: str | None = None, ids_col: str | None = None,
                 end_id: int = END_ID, vocabulary: int = BYTE_IDS, path: str | None = None) -> Shards:
    """Write every document's ids, in training order, to shards in ``path`` (a URI of an empty folder that all executors
    see; a new one in the shared folder if not given).

    ``end_id`` and ``vocabulary`` (the number of ids, end id included) go with ``tokenizer_path`` or ``ids_col``."""
    if not 0 <= end_id < vocabulary <= 1 << 32:
        raise ValueError(f"end id {end_id} is not in a vocabulary of {vocabulary}")
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    base = path or scratch.path("shards")
    if path and not _empty(path):
        raise FileExistsError(f"{path} holds files")
    if ids_col is not None:
        rows, encoder = docs.select(F.col(ids_col).cast("array<long>").alias("ids")), lambda: _given_ids
    else:
        rows = docs.select(F.col(text_col).cast("string").alias("text"))
        encoder = (lambda: word_ids(tokenizer_path, literal=True).encode) if tokenizer_path else lambda: _byte_ids
    cut = scratch.keep(rows.mapInArrow(_sequences(encoder, end_id, vocabulary, stride), CUT), "sequences", "zstd")
    sizes = cut.groupBy("part").agg(F.count("*").alias("n"), F.min("used").alias("used")).collect()  # a row per partition
    first_of, short, total = {}, {}, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        first_of[r["part"]] = total
        total += r["n"]
        if r["used"] < stride:
            short[total - 1] = r["used"]
    shards = Shards(spark, base, total, key, stride, per_shard, short, end_id, id_type(vocabulary))
    if total:
        dealt = cut.select("part", "nth", "ids").mapInArrow(_deal(first_of, shards.order, per_shard), DEALT)
        met = dealt.repartition("shard").sortWithinPartitions("slot")
        written = scratch.keep(met.mapInArrow(_write(base), WRITTEN), "written")
        done = written.agg(F.sum("sequences").alias("n"), F.count_distinct("shard").alias("shards")).first()
        if (done["n"], done["shards"]) != (total, -(-total // per_shard)):
            raise RuntimeError(f"{done['n']} of {total} sequences are in {done['shards']} shards")
        scratch.drop("sequences")
    shards.save()
    return shards
