"""Language-model scoring with a log-frequency Bloom filter.

Training counts every token and every bigram of the training documents.  Token counts stay exact; bigram
counts are quantised on a logarithmic scale, and a bigram of level q is stored in a Bloom filter as the q
elements (bigram, 1) ... (bigram, q).  A reader probes (bigram, 1), (bigram, 2), ... until one is missing; false
positives can only raise a count, and each further step is as unlikely again.  Executors build the filter by
hash range and write each range, as the sorted token counts of each range, to a file in the shared folder.
From there it reaches all workers: where the folder is mounted they map the files, so the pages are shared and
no worker holds them; elsewhere they read the ranges that they need and keep at most ``HELD_BYTES``.  Nothing
of a size that grows with the corpus passes the driver, and the documents are scored in one pass.

The score of a text is the sum over its tokens of log10 p, with p an interpolation, by a fixed weight, of the
share c(previous, token) / c(previous), at most 1, with the add-one probability (c(token) + 1) / (N + V + 1); the
latter alone stands for a text's first token and after a token that training has not seen.  A level stands for
the least of its counts, so the shares of the tokens that training saw after a token sum to at most 1.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end of text, counted as a token; they
are told apart by 64 bits of hash.  Learned from: documents whose ``crc32(id as text) mod 7`` is not 2.  Defined
cases: a null text counts as empty and has the end only; a null id is never held out; repeated rows are
learned from and scored each; with no training rows all counts are zero; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import Scratch, split_words, text_slices

#: The end of a text; no word holds a space.
END = b" "
#: Bytes of the filter and of token counts that a worker keeps where it cannot map them.
HELD_BYTES = 64 << 20
#: Bits per stored element, probes per element, and levels: counts are kept as 1 + floor(log2(count)).
ELEMENT_BITS, PROBES, MOST_LEVELS = 8, 4, 48
#: Weight of the bigram share.
WEIGHT = 0.6
#: Text bytes whose bigrams share a hash range (one segment of the filter), and segments per range of tokens.
SEGMENT_BYTES, SEGMENTS_PER_RANGE = 8 << 20, 8
#: Distinct keys a task gathers before it passes them on.
BUFFER_KEYS = 1 << 21

TOKEN, GRAM = 0, 1
PARTS = "kind int, part long, keys binary, counts binary"
MERGED = "kind int, part long, size long, total long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every token of the texts, offsets per text); each text ends with the end token."""
    import xxhash

    index, offsets, words = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    names = [*words.cast(pa.binary()).to_pylist(), END]
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
    n = len(offsets) - 1
    out = np.empty(len(index) + n, np.uint64)
    ends = offsets[1:] + np.arange(n)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = hashed[index], hashed[-1]
    return out, offsets + np.arange(n + 1)


def bigrams(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places that have a token before them in the same text, hash of the bigram that ends there)."""
    has = np.ones(len(tokens), bool)
    has[offsets[:-1]] = False
    at = np.flatnonzero(has)
    return at, _mix(tokens[at - 1] * np.uint64(0x9E3779B97F4A7C15) + tokens[at])


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each key: its top 32 bits scaled to the number of ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Tally:
    """Counts of 64-bit keys, handed on sorted and cut by hash range."""

    def __init__(self, kind: int, parts: int):
        self.kind, self.parts, self.held, self.size = kind, parts, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.unique(keys, return_counts=True)
        self.held.append(new)
        self.size += len(new[0])
        if self.size >= BUFFER_KEYS:
            keys, counts = summed(*(np.concatenate(x) for x in zip(*self.held)))
            self.held, self.size = [(keys, counts)], len(keys)
            if self.size >= BUFFER_KEYS // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = summed(*(np.concatenate(x) for x in zip(*self.held)))
        self.held, self.size = [], 0
        if self.kind == GRAM:  # a filter needs no more than its range and 32 bits
            key_type = np.uint32
        else:
            key_type = np.uint64
        parts = part_of(keys, self.parts)
        cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1], [True])))
        rows = [(self.kind, int(parts[a]), keys[a:b].astype(key_type).tobytes(), counts[a:b].astype(np.uint32).tobytes())
                for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                         names=["kind", "part", "keys", "counts"])


def _count(segments: int, ranges: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = Tally(TOKEN, ranges), Tally(GRAM, segments)
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                tokens, offsets = token_hashes(texts)
                yield from words.add(tokens)
                yield from grams.add(bigrams(tokens, offsets)[1])
        yield from words.flush()
        yield from grams.flush()
    return count


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count))."""
    return np.searchsorted(2 ** np.arange(MOST_LEVELS, dtype=np.int64), counts, side="right")


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The least of the counts that a level stands for."""
    return np.where(levels == 0, 0.0, 2.0 ** (levels - 1))


def _place(grams: np.ndarray, level: int, probe: int, bits) -> np.ndarray:
    """The bit of one probe for the elements (gram, level); grams by their low 32 bits."""
    one = _mix(grams.astype(np.uint64) + np.uint64(level << 32))
    step = _mix(one ^ np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
    return (one + np.uint64(probe) * step) % bits


def build_segment(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of one hash range's elements."""
    levels = levels_of(counts)
    bits = max(64, int(levels.sum()) * ELEMENT_BITS)
    flags = np.zeros(-(-bits // 8) * 8, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        grams, levels = grams[levels >= level], levels[levels >= level]
        for probe in range(PROBES):
            flags[_place(grams, level, probe, np.uint64(len(flags)))] = True
    return np.packbits(flags, bitorder="little")


def levels_in(segment: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The level of each gram of one hash range, by membership probes in its segment until one fails."""
    low, bits = grams & np.uint64(0xFFFFFFFF), np.uint64(8 * len(segment))
    out, rows = np.zeros(len(grams), np.int64), np.arange(len(grams) if len(segment) else 0)
    for level in range(1, MOST_LEVELS + 1):
        for probe in range(PROBES):
            place = _place(low[rows], level, probe, bits)
            byte = segment[(place >> np.uint64(3)).astype(np.int64)]
            rows = rows[(byte >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
        out[rows] = level
        if not len(rows):
            break
    return out


def counts_in(table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The counts of tokens by one hash range's table: sorted keys, then as many counts."""
    keys, counts = np.split(table.view(np.uint64), 2)
    if not len(keys):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
    return np.where(keys[at] == tokens, counts[at], 0).astype(np.int64)


class SharedRanges:
    """Files of hash ranges in the shared folder, written by tasks and read by workers."""

    def __init__(self, base: str):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(base)
        self.mapped, self.held, self.size = isinstance(self.files, fs.LocalFileSystem), {}, 0

    def put(self, kind: int, part: int, data: bytes) -> None:
        """Written apart and then moved; another attempt has written the same bytes."""
        from pyarrow import fs

        self.files.create_dir(self.root)
        draft, name = f"{self.root}/_draft-{uuid.uuid4().hex}", f"{self.root}/{kind}-{part:010d}"
        with self.files.open_output_stream(draft) as out:
            out.write(data)
        if self.files.get_file_info(name).type == fs.FileType.NotFound:
            self.files.move(draft, name)
        else:
            self.files.delete_file(draft)

    def of(self, kind: int, part: int) -> np.ndarray:
        """The bytes of a range; none if training has met no key in it."""
        if (kind, part) not in self.held:
            name = f"{self.root}/{kind}-{part:010d}"
            try:
                if self.mapped:
                    with pa.memory_map(name) as file:
                        data = np.frombuffer(file.read_buffer(), np.uint8)
                else:
                    with self.files.open_input_file(name) as file:
                        data = np.frombuffer(file.read_buffer(), np.uint8)
            except FileNotFoundError:
                data = np.empty(0, np.uint8)
            if not self.mapped:
                self.size += len(data)
                while self.held and self.size > HELD_BYTES:  # the one kept longest goes
                    self.size -= len(self.held.pop(next(iter(self.held))))
            self.held[kind, part] = data
        return self.held[kind, part]

    def looked_up(self, kind: int, parts: int, keys: np.ndarray, look: Callable) -> np.ndarray:
        """``look(range's bytes, its keys)`` for sorted keys, range by range."""
        out, part = np.zeros(len(keys), np.int64), part_of(keys, parts)
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(keys) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            out[a:b] = look(self.of(kind, int(part[a])), keys[a:b])
        return out


def _merge(base: str):
    def merge(group: pa.Table) -> pa.Table:
        kind, part = group["kind"][0].as_py(), group["part"][0].as_py()
        key_type = np.uint32 if kind == GRAM else np.uint64
        keys, counts = summed(np.concatenate([np.frombuffer(k, key_type) for k in group["keys"].to_pylist()]),
                              np.concatenate([np.frombuffer(c, np.uint32) for c in group["counts"].to_pylist()]).astype(np.int64))
        data = build_segment(keys, counts).tobytes() if kind == GRAM else keys.tobytes() + counts.tobytes()
        SharedRanges(base).put(kind, part, data)
        return pa.table({"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int64()),
                         "size": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())})
    return merge


def held_out(id_column) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _score(base: str, segments: int, ranges: int, n_train: int, v_train: int):
    """Rows (doc_id, held_out, text) to their scores."""
    whole = n_train + v_train + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = SharedRanges(base)
        for batch in batches:
            for row, texts in text_slices(batch.column(2)):
                tokens, offsets = token_hashes(texts)
                different, place = np.unique(tokens, return_inverse=True)
                c = shared.looked_up(TOKEN, ranges, different, counts_in)[place]
                one = (c + 1) / whole
                at, grams = bigrams(tokens, offsets)
                different, place = np.unique(grams, return_inverse=True)
                levels = shared.looked_up(GRAM, segments, different, levels_in)[place]
                before, p = c[at - 1], one.copy()
                share = np.minimum(counts_of(levels) / np.maximum(before, 1), 1.0)
                p[at] = np.where(before > 0, WEIGHT * share + (1 - WEIGHT) * one[at], one[at])
                sums = [np.add.reduceat(x, offsets[:-1]) for x in ((c > 0).astype(np.int64), np.log10(one), np.log10(p))]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i).slice(row, len(texts)) for i in range(2)), pa.array(np.diff(offsets)), pa.array(sums[0]),
                    pa.array(np.full(len(texts), n_train, np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                    names=[f.split()[0] for f in SCORES.split(", ")])
    return score


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    scratch = Scratch(docs.sparkSession)
    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = rows.where(~F.col("held_out")).select("text")
    n_bytes = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = n_bytes // SEGMENT_BYTES + 1
    ranges = segments // SEGMENTS_PER_RANGE + 1
    base = scratch.path("ranges")
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    counted = train.mapInArrow(_count(segments, ranges), PARTS).groupBy("kind", "part").applyInArrow(_merge(base), MERGED)
    tokens = counted.groupBy("kind").agg(F.sum("size").alias("size"), F.sum("total").alias("total")).where(F.col("kind") == TOKEN).first()
    n_train, v_train = (tokens["total"], tokens["size"]) if tokens else (0, 0)
    return rows.mapInArrow(_score(base, segments, ranges, n_train, v_train), SCORES)
