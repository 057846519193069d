"""MinHash near-duplicate detection over documents' word n-gram sets.

1. **Signatures.**  Every set of shingles gets ``MINIMA`` minima of universal hashes ``a * x + b`` (multiply-shift,
   of which 16 bits are kept).  Equal sets are folded first: the copy that was written first stands for them.
2. **Banding.**  The first ``BANDS * BAND_ROWS`` minima make one bucket key a band; sets that share a bucket are
   candidates.  At a similarity of 0.85 a pair shares none of 32 bands of 5 minima with probability 7e-9.
3. **Signature verification.**  Of candidates only pairs whose minima agree often enough (five standard deviations
   below the threshold: one linked pair in 3 million is lost) are compared on their **full sets**.
4. **Components** by alternating large-star and small-star over tables of links.

No bucket is expanded into all its pairs.  Each set first meets the smallest set (the *pivot*) of each of its
buckets, and of these pairs the one whose minima agree best is compared.  What is still of several components in one
bucket then meets inside tasks: a bucket is cut into blocks of ``BLOCK`` rows, each pair of blocks is one run, only
rows of different components are held against each other, and a pair leaves the task only from the first bucket that
it shares and only if its minima agree.  So a group of copies costs its rows, and a family of texts that nearly link
costs comparisons of minima, spread by blocks; neither makes rows in proportion to all its pairs.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Defined cases: a null or empty text has no shingles and
links with nothing; fewer words than n make one shingle; texts of any length are read whole; rows that repeat an id
each count by their own text; a null id is no smallest id (a class of null ids alone keeps null, and is kept); an
empty table gives an empty result; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import Scratch, key_filter, sorted_runs, text_slices
from roaskit.llm.jaccard import shingle_sets

#: Universal hashes; their minima are kept in 16 bits each.
MINIMA, MINIMUM_BYTES = 480, 2
#: Buckets of each set, and minima that make one bucket's key.
BANDS, BAND_ROWS = 32, 5
#: Shingles hashed at once; a worker's buffers stay in cache.
HASHED_AT_ONCE = 1 << 15
#: Rows of a bucket that one task holds against each other, or against as many others.
BLOCK = 1024
#: Standard deviations that a linked pair's agreement may fall below its mean.
DEVIATIONS = 5.0
#: Large-star and small-star need a number of rounds that grows with the logarithm; beyond this it is an error.
MOST_ROUNDS = 60


def universal_hashes(count: int, seed: int = 20240229) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and summands of ``count`` multiply-shift hashes of 32-bit keys."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A row of 16-bit minima per (non-empty) set of 64-bit shingle hashes."""
    out, first = np.empty((len(sets), len(a)), np.uint16), 0
    while first < len(sets):
        last, held = first, 0
        while last < len(sets) and (last == first or held + len(sets[last]) <= HASHED_AT_ONCE):
            held += len(sets[last])
            last += 1
        out[first:last] = _minima(sets[first:last], a, b)
        first = last
    return out


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    keys = np.concatenate(sets) >> np.uint64(32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    hashed = np.empty_like(keys)
    least = np.empty((len(a), len(sets)), np.uint64)
    for k in range(len(a)):
        np.multiply(keys, a[k], out=hashed)
        np.add(hashed, b[k], out=hashed)
        np.minimum.reduceat(hashed, starts, out=least[k])
    return (least >> np.uint64(48)).astype(np.uint16).T


def least_agreement(percent: int, minima: int = MINIMA) -> int:
    """Minima that two linked sets agree in at least, but for the stated chance."""
    p = percent / 100
    return max(0, math.floor(minima * p - DEVIATIONS * math.sqrt(minima * p * (1 - p))))


SIGNED = "doc_id long, n long, digest binary, minima binary, text_a long, text_b long"


def _sign(words: int) -> Callable:
    """(id, text, both hashes of the text) to (id, size of its set, digest of its set, minima, hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        a, b = universal_hashes(MINIMA)
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                sets = list(shingle_sets(texts, words))
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full, a, b)) if full else iter(())
                beside = [batch.column(k).slice(row, len(texts)) for k in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([
                    beside[0].cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    beside[1], beside[2]], names=[f.split()[0] for f in SIGNED.split(", ")])
    return run


def _shingles(words: int) -> Callable:
    """(both hashes of a text, text) to (hashes, its set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch.column(2)):
                sets = [s.view(np.int64) for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)),
                    pa.array(sets, pa.list_(pa.int64()))], names=["text_a", "text_b", "items"])
    return run


def bucket_keys(minima: Column) -> Column:
    """One key a band: a hash of the band's number and its minima."""
    width = BAND_ROWS * MINIMUM_BYTES
    return F.array(*[F.xxhash64(F.lit(band), F.substring(minima, band * width + 1, width)) for band in range(BANDS)])


def _matrix(column: pa.Array) -> np.ndarray:
    """Fixed-width binary values as rows of 16-bit minima."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(one, two, minima of one, minima of two) to (one, two, minima that agree)."""
    for batch in batches:
        same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(1) if len(batch) else []
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.int64())],
                                         names=["one", "two", "same"])


def _meet(percent: int) -> Callable:
    """Runs of (key, blocks, own block, set, class, size, minima): pairs of different classes whose minima agree.

    A pair is told by the first band in which its minima agree, which is the first bucket that it shares.
    """
    enough, width = least_agreement(percent), BAND_ROWS

    def told(run: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        block, name, kind, size = (run.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 6))
        band, within = run.column(8)[0].as_py(), run.column(1)[0].as_py() == run.column(2)[0].as_py()
        if kind.min() == kind.max():
            return
        minima = _matrix(run.column(7))
        for at in range(len(run) - 1):
            other = kind[at + 1:] != kind[at]
            if not within:
                other &= block[at + 1:] != block[at]
            other &= 100 * np.minimum(size[at + 1:], size[at]) >= percent * np.maximum(size[at + 1:], size[at])
            rest = np.flatnonzero(other) + at + 1
            rest = rest[(minima[rest] == minima[at]).sum(1) >= enough] if len(rest) else rest
            for k in rest:
                shared = (minima[k, :BANDS * width] == minima[at, :BANDS * width]).reshape(BANDS, width).all(1)
                if int(np.argmax(shared)) == band:
                    yield int(name[at]), int(name[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[int, int]] = []
        for rows in sorted_runs(batches, 3):
            pairs += told(rows)
            if len(pairs) >= 10_000:
                yield _pairs(pairs)
                pairs = []
        yield _pairs(pairs)
    return run


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["one", "two"])


def _linked(percent: int) -> Callable:
    """(one, two, both sets) to the pairs with 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = []
            for k in range(len(batch)):
                x, y = a[k].values.to_numpy(), b[k].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["one", "two"])
    return run


def star_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): of every node of ``links`` (one, two) but the roots the smallest node it is connected with.

    Large-star links every larger neighbour of a node to the smallest of its neighbourhood, small-star the smaller
    neighbours and the node itself; both keep what is connected.  They alternate until no link changes.  A hot
    node's neighbours stay rows of one table: minima combine before the shuffle and the join splits a skewed key.
    """
    def pairs(one: Column, two: Column) -> list[Column]:
        return [one.alias("node"), two.alias("root")]

    low, high = F.least("one", "two"), F.greatest("one", "two")
    state = scratch.keep(links.where("one <> two").select(*pairs(high, low)).distinct(), f"{name}0")
    print_of = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))]
    before = state.agg(*print_of).first()
    for turn in range(1, MOST_ROUNDS):
        both = state.unionByName(state.select(*pairs(F.col("root"), F.col("node"))))
        near = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.join(near, "node").where("root > node").select(*pairs(F.col("root"), F.col("least"))).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = (large.join(least, "node")
                 .select(*pairs(F.when(F.col("root") == F.col("least"), F.col("node")).otherwise(F.col("root")), F.col("least")))
                 .distinct())
        state = scratch.keep(small, f"{name}{turn}")
        after = state.agg(*print_of).first()
        scratch.drop(f"{name}{turn - 1}")
        if after == before:
            return state
        before = after
    raise RuntimeError("the components did not settle")


class _Candidates:
    """The sets of one run that share a bucket with another set, and what is told about their pairs."""

    def __init__(self, scratch: Scratch, percent: int, minima: DataFrame, items: DataFrame):
        self.scratch, self.percent, self.minima, self.items = scratch, percent, minima, items

    def agreeing(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (one, two) whose sizes may link and whose minima agree often enough, and how often."""
        for side, at in (("one", "a"), ("two", "b")):
            own = self.minima.select(F.col("set_no").alias(side), F.col("n").alias(f"n_{at}"), F.col("minima").alias(f"minima_{at}"))
            pairs = pairs.join(own, side)
        fits = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        told = pairs.where(fits).select("one", "two", "minima_a", "minima_b").mapInArrow(_agreeing, "one long, two long, same long")
        return told.where(F.col("same") >= least_agreement(self.percent))

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that link by their full sets."""
        for side, at in (("one", "a"), ("two", "b")):
            pairs = pairs.join(self.items.select(F.col("set_no").alias(side), F.col("items").alias(f"items_{at}")), side)
        rows = pairs.select("one", "two", "items_a", "items_b").mapInArrow(_linked(self.percent), "one long, two long")
        return self.scratch.keep(rows, name)

    def by_pivot(self, lists: DataFrame) -> DataFrame:
        """Every set with that pivot of its buckets whose minima agree best with its own."""
        pairs = lists.where("set_no <> pivot").select(F.col("set_no").alias("one"), F.col("pivot").alias("two")).distinct()
        best = self.agreeing(pairs).groupBy("one").agg(F.max(F.struct("same", "two")).alias("best"))
        return best.select("one", F.col("best.two").alias("two"))

    def across(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs that share a bucket and are of different components so far."""
        known = roots.select(F.col("node").alias("set_no"), F.col("root").alias("class"))
        told = (lists.join(known, "set_no", "left")
                .select("key", "band", "set_no", F.coalesce("class", "set_no").alias("class")))
        mixed = (told.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("rows"))
                 .where("low < high").select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")))
        own = F.pmod(F.xxhash64("set_no"), F.col("blocks")).cast("int")
        rows = (told.join(mixed, "key").withColumn("own", own)
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("key", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own",
                        "set_no", "class", "band"))
        rows = rows.join(self.minima.select("set_no", "n", "minima"), "set_no")
        order = ["key", "first", "second"]
        runs = (rows.repartition(*order).sortWithinPartitions(*order, "set_no")
                .select(*order, "own", "set_no", "class", "n", "minima", "band"))
        return runs.mapInArrow(_meet(self.percent), "one long, two long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a document's class by links of at least ``percent`` similarity.

    ``component_id`` is the smallest id of the class, and ``kept`` marks the rows that bear it.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_a"), F.xxhash64(F.lit(1), F.col(text_col)).alias("text_b"))
    signed = scratch.keep(texts.mapInArrow(_sign(words), SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")
    sets = scratch.keep(signed.where("n > 0").groupBy("digest").agg(F.min("row").alias("set_no"), F.min("doc_id").alias("least_id")), "sets")

    # one row per set and band; of those only what shares a bucket goes on
    own = signed.join(sets.select(F.col("set_no").alias("row")), "row", "left_semi")
    keys = scratch.keep(own.select(F.col("row").alias("set_no"), F.posexplode(bucket_keys(F.col("minima"))).alias("band", "key")), "keys")
    shared = keys.groupBy("key").agg(F.min("set_no").alias("pivot"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    lists = scratch.keep(keys.join(shared.select("key", "pivot"), "key"), "lists")
    scratch.drop("keys")
    near = lists.select(F.col("set_no").alias("row")).distinct()
    minima = scratch.keep(signed.join(near, "row", "left_semi").select(F.col("row").alias("set_no"), "n", "minima", "text_a", "text_b"), "minima")
    wanted = minima.select("text_a", "text_b", "set_no")
    near_texts = key_filter(texts.select("text_a", "text_b", "text"), "text_a", wanted.select("text_a"))
    once = (near_texts.join(wanted.drop("set_no"), ["text_a", "text_b"], "left_semi")
            .groupBy("text_a", "text_b").agg(F.first("text").alias("text")))
    items = once.mapInArrow(_shingles(words), "text_a long, text_b long, items array<long>")
    items = scratch.keep(items.join(wanted, ["text_a", "text_b"]).select("set_no", "items"), "items")

    candidates = _Candidates(scratch, percent, minima, items)
    links = candidates.linked(candidates.by_pivot(lists), "pivot_links")
    roots = star_components(links, scratch, "pivot_roots")
    more = candidates.linked(candidates.across(lists, roots), "cross_links")
    known = roots.select(F.col("node").alias("one"), F.col("root").alias("two"))
    roots = star_components(known.unionByName(more), scratch, "roots")
    for name in ("lists", "minima", "items"):
        scratch.drop(name)

    classed = sets.join(roots.withColumnRenamed("node", "set_no"), "set_no", "left").withColumn("class", F.coalesce("root", "set_no"))
    least = classed.groupBy("class").agg(F.min("least_id").alias("component"))
    named = classed.join(least, "class").select("digest", "component")
    rows = signed.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))
