"""Size-aware heavy-light Jaccard join of documents' word n-gram sets.

Two documents link when ``100 * |A and B| >= percent * |A or B|``; the result is each document's class of
documents reachable by links.  Equal sets are first folded into one.  Then, by size:

* **Light** sets enumerate fixed-size subsets.  A linked pair of sizes n and m shares at least
  ``need(n, m)`` shingles, so both enumerate a subset of that size which they have in common; a shared
  subset of that size proves the link, with no further check.  In the list of a subset the smallest
  member is the pivot: any member that links with another through this subset links with the pivot.
* **Heavy** sets scan inverted lists.  Shingles stand in one global order (rare before common, by a sketch
  of fixed size, then by hash); a linked pair meets in the lists of the first ``n - least(n) + 1`` shingles
  of each.  First every set meets a few pivots of its lists, and these pairs are verified exactly, which
  gathers large groups in a number of pairs that grows with the rows.  Sets that still share a list with
  another class then meet a few leads drawn from the list, of those that parity rows allow.  Then only members
  of *different* classes meet, and of two the smaller in a shorter prefix still, as its partner is not smaller.

Before a pair is verified, rows of parity bits per set bound from below how many shingles the two differ by;
only pairs that may still link are compared whole.

A set's id is one half of its 128-bit digest (checked: no two sets share it, else another seed is taken), so
copies of a set name it alike and no join is needed to fold them.  Set contents are not stored: a scan of the
texts makes them again for the sets that are verified.

The boundary between light and heavy is the size with the least estimated cost, from the histogram of sizes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Defined cases: a null or empty text has no
shingles and links with nothing; fewer words than n make one shingle; rows that repeat an id form one
document for linking only if their sets link; a null id stays null and is a class of its own when nothing
else is in it; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import Scratch, fresh, key_filter, split_words, text_slices

#: Counters of the frequency sketch (fixed size, so its broadcast is bounded), and the blocks they travel in.
SKETCH, SKETCH_BLOCKS = 1 << 18, 32
#: A set enumerates at most this many subsets (over all sizes of subset) to count as light.
MOST_SUBSETS = 400
#: What one row of an inverted list costs beside one enumerated subset: it is kept, met and verified.
LIST_COST = 4.0
#: Bits of a set's parity row at most.
PARITY_BITS = 1 << 16
#: Longs of the short parity row that a set brings into a join of its lists.
SIGN_LONGS = 16
#: The columns of a row of an inverted list, beside its key, once classes are known; its parity row joins it in time.
ROW = ["set_id", "n", "short", "class"]
#: Sets drawn from each list that its other sets meet before classes meet in full.
LEADS = 3
#: Tasks among which the members of one pivot are spread.
SALTS = 8
#: Distances at least halve in a round, so this many rounds reach any length of chain; then it is an error.
MOST_ROUNDS = 60


def need(n: int, m: int, percent: int) -> int:
    """The least overlap of linked sets of sizes n and m: 100 o >= p (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def least(n: int, percent: int) -> int:
    """The least overlap of a set of size n with any set it links with (also the least partner)."""
    return -(-percent * n // 100)


def largest_partner(n: int, percent: int) -> int:
    return 100 * n // percent


def subset_sizes(n: int, percent: int) -> list[int]:
    """The sizes of subset that a set of size n shares with partners of any size it may link with."""
    return sorted({need(n, m, percent) for m in range(max(1, least(n, percent)), largest_partner(n, percent) + 1)
                   if need(n, m, percent) <= min(n, m)})


def subsets(n: int, percent: int) -> int:
    return sum(math.comb(n, c) for c in subset_sizes(n, percent))


def prefix_length(n: int, percent: int) -> int:
    return n - least(n, percent) + 1


def short_prefix_length(n: int, percent: int) -> int:
    """As many shingles of a set suffice to meet every partner that is not smaller, in that partner's prefix."""
    return n - need(n, n, percent) + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size, by the least sum of enumerated subsets and rows of inverted lists."""
    best, at, n = math.inf, 0, 0
    while True:
        light = sum(k * subsets(s, percent) for s, k in sizes.items() if s <= n)
        listed = sum(k * prefix_length(s, percent) for s, k in sizes.items() if s > n or s >= least(n + 1, percent))
        if light + LIST_COST * listed < best:
            best, at = light + LIST_COST * listed, n
        n += 1
        if subsets(n, percent) > MOST_SUBSETS:
            return at


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    index, offsets, distinct = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashed = word_hashes(distinct)[index] if len(index) else np.empty(0, np.uint64)
    for a, b in zip(offsets[:-1], offsets[1:]):
        own = hashed[a:b]
        if not len(own):
            yield own
            continue
        k = min(words, len(own))
        out = np.full(len(own) - k + 1, k, np.uint64)
        for j in range(k):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + own[j:len(own) - k + 1 + j])
        yield np.unique(out)


def _batch(names: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as a batch; ``names`` is a schema as Spark writes it."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in names.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _set_id(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Both halves of a set's digest, as longs."""
    import xxhash

    high, low = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes(), seed=seed), np.int64)
    return int(high), int(low)


def _each_set(words: int, seed: int, make: Callable, digests: bool = False) -> Callable:
    """A task that calls ``make`` with (doc ids, shingle sets, set ids) of every slice of documents (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                sets = list(shingle_sets(texts, words))
                ids = batch.column(0).slice(row, len(texts)).to_pylist()
                if digests:
                    ids = [(i, hashlib.sha256((t or "").encode()).digest()) for i, t in zip(ids, texts.to_pylist())]
                yield from make(ids, sets, [_set_id(s, seed) for s in sets])
    return run


NARROW = "doc_id long, n long, set_id long, check long, parity binary, sign array<long>, block long, counts binary"
DIGESTED = NARROW + ", digest binary"


def parity(shingles: np.ndarray) -> bytes:
    """Bits that each shingle toggles, about as many as there are shingles.

    The exclusive or of two sets' bits belongs to their symmetric difference, which has at least as many
    members as bits stand in it: a bound that no linked pair breaks, in an eighth of a byte per shingle.
    """
    bits = min(max(64, 1 << max(0, len(shingles) - 1).bit_length()), PARITY_BITS)
    odd = np.bincount((shingles >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sign(shingles: np.ndarray) -> list[int]:
    """A parity row of a fixed width, as longs, for a bound inside a join's condition."""
    odd = np.bincount((shingles >> np.uint64(40) & np.uint64(64 * SIGN_LONGS - 1)).astype(np.int64), minlength=64 * SIGN_LONGS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def least_difference(one: bytes, two: bytes) -> int:
    """How many shingles two sets differ by at least."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    while len(a) != len(b):  # the longer row folds onto itself
        if len(a) < len(b):
            a, b = b, a
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _possible(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            most = n + m - 2 * -(-percent * (n + m) // (100 + percent))
            keep = [least_difference(x, y) <= d for x, y, d in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), most.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], names=["a", "b"])
    return check


def _narrow(words: int, seed: int, digests: bool = False):
    """A row per document (with its text's SHA-256 if asked for), and at the end the partition's part of the frequency sketch, by blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)

        def rows(ids: list, sets: list, names: list) -> Iterator[pa.RecordBatch]:
            nonlocal counts
            at = (np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64)
            counts += np.bincount(at, minlength=SKETCH)
            if digests:
                yield _batch(DIGESTED, [(i, len(s), *name, parity(s), sign(s), None, None, d) for (i, d), s, name in zip(ids, sets, names)])
            else:
                yield _batch(NARROW, [(i, len(s), *name, parity(s), sign(s), None, None) for i, s, name in zip(ids, sets, names)])

        yield from _each_set(words, seed, rows, digests)(batches)
        if counts.any():
            size = SKETCH // SKETCH_BLOCKS
            yield _batch(DIGESTED if digests else NARROW, [
                (None, None, None, None, None, None, k, counts[k * size:(k + 1) * size].tobytes(), *[None] * digests)
                for k in range(SKETCH_BLOCKS)])
    return run


def _add_blocks(parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in parts["counts"].to_pylist())
    return pa.table({"block": parts["block"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def frequency_ranks(parts: DataFrame) -> np.ndarray:
    """For each counter, how far its load lies above what is usual, in powers of two (0: not above)."""
    rows = (parts.select("block", "counts").groupBy("block")
            .applyInArrow(_add_blocks, "block long, counts binary").collect())  # SKETCH counters in all
    load = np.zeros(SKETCH)
    size = SKETCH // SKETCH_BLOCKS
    for r in rows:
        load[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    usual = np.median(load) + 2 * math.sqrt(np.median(load)) + 2
    return np.clip(np.ceil(np.log2(np.maximum(load / usual, 1))), 0, 60).astype(np.uint8)


def _prefix(shingles: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the global order, as many as a linked set must meet one of."""
    rank = ranks[(shingles & np.uint64(len(ranks) - 1)).astype(np.int64)]
    return shingles[np.argsort(rank, kind="stable")[:prefix_length(len(shingles), percent)]]


KEYS = "key long, set_id long, n long, c long, short long"


def _keys(words: int, seed: int, percent: int, light: int, ranks):
    """Rows of the subsets of light sets (c: their size) and of the inverted lists (c = 0; short: whether the
    shingle stands in the short prefix)."""
    listed = least(light + 1, percent)

    def rows(ids: list, sets: list, names: list) -> Iterator[pa.RecordBatch]:
        keys, owners, sizes, kinds, shorts = [], [], [], [], []
        for s, (name, _) in zip(sets, names):
            n = len(s)
            found = []
            if 0 < n <= light:
                found += [(k, c) for c, k in _subset_keys(s, percent)]
            if n >= max(listed, 1):
                found.append((_prefix(s, ranks.value, percent), 0))
            for k, c in found:
                keys.append(k.view(np.int64))
                for column, value in ((owners, name), (sizes, n), (kinds, c)):
                    column.append(np.full(len(k), value, np.int64))
                shorts.append((np.arange(len(k)) < short_prefix_length(n, percent)).astype(np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, owners, sizes, kinds, shorts)],
                                             names=["key", "set_id", "n", "c", "short"])
    return _each_set(words, seed, rows)


def _subset_keys(s: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(size, keys of all subsets of that size): a key sums the members' mixed hashes, by what is left out."""
    whole = _mix(s)
    for c in subset_sizes(len(s), percent):
        left = np.array(list(itertools.combinations(range(len(s)), len(s) - c)), np.int64)
        out = whole[left].sum(axis=1, dtype=np.uint64) if len(s) > c else np.zeros(1, np.uint64)
        yield c, _mix(whole.sum(dtype=np.uint64) - out + np.uint64(c))


LISTS = "key long, set_id long, n long, c long, short long, pivot long, pivot_n long"


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (c, key, order): the lists of several sets, each set once, with the list's first set as pivot."""
    held = [np.empty(0, np.int64)] * 5  # of the list that goes on: its first set and its last
    for batch in batches:
        old = len(held[0])
        rows = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
        key, set_id, _, c, _ = rows
        if len(key) == old:
            continue
        change = (key[1:] != key[:-1]) | (c[1:] != c[:-1])
        distinct = np.concatenate(([True], change | (set_id[1:] != set_id[:-1])))
        distinct[:old] = True
        rows = [x[distinct] for x in rows]
        key, set_id, n, c, _ = rows
        starts = np.concatenate(([True], (key[1:] != key[:-1]) | (c[1:] != c[:-1])))
        at = np.arange(len(key))
        first = np.maximum.accumulate(np.where(starts, at, 0))
        told = np.flatnonzero((at >= old) & (at > first))
        led = np.unique(first[told])  # a list's first set is told with its second
        led = led[(led > 0) | (old < 2)]
        told, pivots = np.concatenate((led, told)), np.concatenate((led, first[told]))
        if len(told):
            columns = (*(x[told] for x in rows), set_id[pivots], n[pivots])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[f.split()[0] for f in LISTS.split(", ")])
        keep = np.unique([first[-1], len(key) - 1])
        held = [x[keep] for x in rows]


def linkable(n, m, percent: int):
    """Whether sets of these sizes can link at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _contents(words: int, seed: int):
    def rows(ids: list, sets: list, names: list) -> Iterator[pa.RecordBatch]:
        yield _batch("set_id long, shingles binary", [(name, s.tobytes()) for s, (name, _) in zip(sets, names)])
    return _each_set(words, seed, rows)


def _verify(percent: int):
    """Rows sorted by (pivot, salt, kind): a pivot's set, then the sets that may link with it."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, whole = None, None
        for batch in batches:
            links = []
            for owner, kind, set_id, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                s = np.frombuffer(data, np.uint64)
                if kind == 0:
                    pivot, whole = owner, s
                elif owner == pivot:
                    small, large = (s, whole) if len(s) <= len(whole) else (whole, s)
                    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                    if 100 * both >= percent * (len(s) + len(whole) - both):
                        links.append((set_id, pivot))
            yield _batch("a long, b long", links)
    return check


class _Join:
    """One run: the documents, the shingle parameters, and where intermediate tables go."""

    def __init__(self, docs: DataFrame, words: int, percent: int, digests: bool = False):
        self.docs, self.words, self.percent = docs, words, percent
        self.scratch = Scratch(docs.sparkSession)
        for seed in range(8):
            name = f"narrow-{seed}"
            told = self.scratch.keep(docs.mapInArrow(_narrow(words, seed, digests), DIGESTED if digests else NARROW), name)
            self.narrow = told.where("block is null").select("doc_id", "n", "set_id", "check", "parity", "sign", *["digest"] * digests)
            full = self.narrow.where("n > 0")
            self.seed = seed
            if full.groupBy("set_id").agg(F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y").isEmpty():
                self.sketch = told.where("block is not null")
                self.sets = self.scratch.keep(full.groupBy("set_id").agg(
                    F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("sign").alias("sign")), "sets")
                return
        raise RuntimeError("set digests collide under every seed")

    def lists(self, light: int) -> DataFrame:
        ranks = self.docs.sparkSession.sparkContext.broadcast(frequency_ranks(self.sketch))  # SKETCH bytes
        keys = self.docs.mapInArrow(_keys(self.words, self.seed, self.percent, light, ranks), KEYS)
        # in the list of a subset the smallest set leads; in an inverted list the order is as good as random
        order = F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))
        met = keys.repartition("key", "c").sortWithinPartitions("c", "key", order, "set_id").mapInArrow(_lists, LISTS)
        return self.scratch.keep(met, "lists")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of the pairs (a, b), a written table, those whose whole sets link; b's set is sent once to each task that needs it."""
        asked = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        some = self.sets.join(asked, "set_id", "left_semi")  # parity rows of no other set are shuffled
        one, two = (some.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}")) for x in "ab")
        pairs = (pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "parity_a", "parity_b")
                 .mapInArrow(_possible(self.percent), "a long, b long"))
        pairs = self.scratch.keep(pairs, f"{name}-pairs")
        asked = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        wanted = self.sets.join(asked, "set_id", "left_semi").select(F.col("least_id").alias("__least")).distinct()
        keyed = self.docs.withColumn("key", F.xxhash64("doc_id"))
        texts = key_filter(keyed, "key", wanted.select(F.xxhash64("__least").alias("key"))).drop("key")
        texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("__least")), "left_semi")
        made = texts.mapInArrow(_contents(self.words, self.seed), "set_id long, shingles binary")
        contents = self.scratch.keep(made.join(asked, "set_id", "left_semi"), f"{name}-contents")
        salt = F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int")
        members = pairs.join(contents, F.col("a") == F.col("set_id")).select(
            F.col("b").alias("pivot"), salt.alias("salt"), F.lit(1).alias("kind"), "set_id", "shingles")
        pivots = pairs.select(F.col("b").alias("pivot"), salt.alias("salt")).distinct()
        pivots = pivots.join(contents, F.col("pivot") == F.col("set_id")).select(
            "pivot", "salt", F.lit(0).alias("kind"), "set_id", "shingles")
        met = members.unionByName(pivots).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "kind")
        links = met.select("pivot", "kind", "set_id", "shingles").mapInArrow(_verify(self.percent), "a long, b long")
        links = self.scratch.keep(links.distinct(), f"{name}-links")
        self.scratch.drop(f"{name}-contents")
        self.scratch.drop(f"{name}-pairs")
        return links

    def mixed(self, lists: DataFrame, classed: DataFrame, name: str) -> DataFrame:
        """The rows of the inverted lists that hold more than one class, each with its class."""
        told = lists.select("key", "set_id", "n", "short").join(classed.select("set_id", "class"), "set_id")
        several = told.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
        return self.scratch.keep(told.join(several.select("key"), "key", "left_semi").select("key", *ROW), name)

    def _signs(self) -> DataFrame:
        """The short parity row of each set."""
        return self.sets.select("set_id", *[F.col("sign")[k].alias(f"s{k}") for k in range(SIGN_LONGS)])

    def _apart(self, light: int) -> Column:
        """Whether rows a and b are of different classes and may link by their sizes."""
        n, m = F.col("n_a"), F.col("n_b")
        return (F.col("class_a") != F.col("class_b")) & (F.greatest(n, m) > light) & linkable(n, m, self.percent)

    def _near(self) -> Column:
        """Whether rows a and b may link by their parity rows (the first longs alone tell most pairs apart)."""
        n, m, p = F.col("n_a"), F.col("n_b"), self.percent
        most = n + m - 2 * F.ceil((n + m) * p / F.lit(100 + p))

        def differ(longs: int) -> Column:
            return sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(longs)), F.lit(0))
        return (differ(SIGN_LONGS // 4) <= most) & (differ(SIGN_LONGS) <= most)

    @staticmethod
    def _side(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(c if c == "key" else f"{c}_{side}") for c in rows.columns])

    def lead_pairs(self, told: DataFrame, light: int) -> DataFrame:
        """For each set a few leads of other classes that it may link with: a list has LEADS leads, so that the
        pairs met grow with the rows.  A lead drawn from a list is most often of its largest class."""
        drawn = told.groupBy("key").agg(*[F.min_by("set_id", F.xxhash64("set_id", F.lit(k))).alias(f"d{k}") for k in range(LEADS)])
        drawn = drawn.select("key", F.explode(F.array_distinct(F.array(*[f"d{k}" for k in range(LEADS)]))).alias("set_id"))
        leads = self._side(told.join(drawn, ["key", "set_id"], "left_semi"), "b")
        met = self._side(told, "a").join(leads, "key").where(self._apart(light))
        # sets that meet do so in several lists: parity rows join each pair once
        pairs = met.groupBy("set_id_a", "set_id_b", "n_a", "n_b").count()
        for side in "ab":
            pairs = pairs.join(self._side(self._signs(), side), f"set_id_{side}")
        a, b = F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")
        met = pairs.where(self._near()).select(a, b, "count").groupBy("a").agg(
            F.max_by("b", F.struct("count", "b")).alias("frequent"), F.min_by("b", F.xxhash64("a", "b")).alias("any"))
        return met.select("a", F.explode(F.array_distinct(F.array("frequent", "any"))).alias("b"))

    def class_pairs(self, told: DataFrame, light: int) -> DataFrame:
        """All pairs of sets of different classes that meet in inverted lists and that their prefixes do not rule out."""
        n, m = F.col("n_a"), F.col("n_b")
        # the smaller set is in its short prefix, of equal sets both are
        roles = ((n > m) | (F.col("short_a") == 1)) & ((m > n) | (F.col("short_b") == 1))
        signed = told.join(self._signs(), "set_id")
        met = self._side(signed, "a").join(self._side(signed, "b"), "key").where(
            (F.col("set_id_a") < F.col("set_id_b")) & roles & self._apart(light) & self._near())
        return met.select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): the least node reachable from each node that has a link.

    Each round every node takes the least root among its neighbours' and its own, and a root that hears of
    a smaller one passes it on to all that follow it; written tables cut the lineage between rounds.
    """
    edges = scratch.keep(links.select(F.col("a").alias("x"), F.col("b").alias("y"))
                         .union(links.select("b", "a")).distinct(), f"{name}-edges")
    first = edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low"))
    roots = scratch.keep(first.select("node", F.least("node", "low").alias("root")), f"{name}-0")
    for k in range(1, MOST_ROUNDS):
        near = edges.join(roots, F.col("y") == F.col("node")).groupBy("x").agg(F.min("root").alias("offer"))
        told = roots.join(near, F.col("node") == F.col("x")).select("node", F.least("root", "offer").alias("next"), F.col("root").alias("old"))
        best = told.groupBy(F.col("old").alias("boss")).agg(F.min("next").alias("bosses"))
        step = told.join(best, F.col("old") == F.col("boss")).select("node", F.least("next", "bosses").alias("root"), "old")
        after = scratch.keep(step, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        roots = after.select("node", "root")
        if after.where("root <> old").isEmpty():
            scratch.drop(f"{name}-edges")
            return roots
    raise RuntimeError(f"classes still change after {MOST_ROUNDS} rounds")


def merged(classed: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``classed`` after links between members of different classes; they join the classes, not their members."""
    one, two = (classed.select(F.col("set_id").alias(x), F.col("class").alias(f"class_{x}")) for x in "ab")
    bridges = links.join(one, "a").join(two, "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
    whole = components(bridges, scratch, name)
    told = classed.join(whole, F.col("class") == F.col("node"), "left")
    return scratch.keep(told.select("set_id", "least_id", F.coalesce("root", "class").alias("class")), f"{name}-classes")


def _classes(docs: DataFrame, words: int, percent: int, digests: bool = False) -> tuple[_Join, DataFrame]:
    """The join over ``docs`` (doc_id, text), and (set_id, least_id, class) of its sets."""
    job = _Join(docs, words, percent, digests)
    sets = job.sets
    sizes = {r["n"]: r["count"] for r in sets.groupBy("n").count().collect()}  # one row per size of set
    light = boundary(sizes, percent)
    lists = job.lists(light)
    a, b = F.col("set_id").alias("a"), F.col("pivot").alias("b")
    members = lists.where("set_id <> pivot")
    n, m = F.col("n"), F.col("pivot_n")
    # a shared subset of the size that the two sizes need proves the link
    proven = members.where((F.col("c") > 0) & (F.col("c") * (100 + percent) >= (n + m) * percent)).select(a, b).distinct()
    # to gather classes it is enough that each set meets a few pivots of its lists
    met = members.where((F.col("c") == 0) & (F.greatest(n, m) > light) & linkable(n, m, percent)).groupBy(a, b).count()
    met = met.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("last"), F.max_by("b", F.struct("count", "b")).alias("frequent"))
    pairs = job.scratch.keep(met.select("a", F.explode(F.array_distinct(F.array("least", "last", "frequent"))).alias("b")), "pivots-met")
    links = proven.unionByName(job.verified(pairs, "pivots"))
    job.scratch.drop("pivots-met")
    classes = components(links, job.scratch, "first")
    classed = sets.select("set_id", "least_id").join(classes, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "least_id", F.coalesce("root", "set_id").alias("class"))
    # most classes that belong together are joined through leads, before any two classes meet in full
    classed = job.scratch.keep(classed, "first-classes")
    rows = job.mixed(lists.where("c = 0"), classed, "mixed-first")
    job.scratch.drop("lists")  # a table goes as soon as the one made of it is written
    pairs = job.scratch.keep(job.lead_pairs(rows, light), "leads-met")
    classed = merged(classed, job.verified(pairs, "leads"), job.scratch, "second")
    job.scratch.drop("leads-met")
    rows = job.mixed(rows, classed, "mixed-last")
    job.scratch.drop("mixed-first")
    pairs = job.scratch.keep(job.class_pairs(rows, light), "class-pairs")
    job.scratch.drop("mixed-last")
    told = merged(classed, job.verified(pairs, "classes"), job.scratch, "last")
    job.scratch.drop("class-pairs")
    return job, told


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    job, told = _classes(docs, words, percent)
    told = told.withColumnRenamed("class", "root")
    least_of = told.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classed = told.join(least_of, "root").select("set_id", "component_id")
    return (job.narrow.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id"))
            .join(classed, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class one, that with the smallest id (null ids last, equal ids by digest
    of the text), and all rows without a word."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    job, told = _classes(rows, words, percent, digests=True)
    named = job.narrow.where("n > 0").join(told, "set_id").groupBy("class", "doc_id", "digest").agg(F.count("*").alias("times"))
    named = job.scratch.keep(named, "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "times")).alias("first")
    own_id, own_digest = fresh([*docs.columns, *named.columns], "gone_id", "gone_digest")
    stay = named.groupBy("class").agg(first).select(
        F.col("first.doc_id").alias(own_id), F.col("first.digest").alias(own_digest), F.col("first.times").alias("own_times"))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col("digest") == F.col(own_digest))
    gone = job.scratch.keep(named.join(stay, same, "left_anti").select(
        F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest)), "gone")
    row = (F.col(id_col).cast("long").eqNullSafe(F.col(own_id))
           & (F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)) == F.col(own_digest)))
    stays = docs.join(gone, row, "left_anti")
    twins = job.scratch.keep(stay.where("own_times > 1").drop("own_times"), "twins")  # rows that repeat id and text: one of them stays
    if twins.isEmpty():
        return stays
    return (stays.join(twins, row, "left_anti")
            .unionByName(stays.join(twins, row, "left_semi").dropDuplicates([id_col, text_col])))
