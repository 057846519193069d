"""Exact top-k inner products by vector-approximation files.

Vectors are cut into chunks of bounded size.  Each chunk is an approximation file: every component is
quantised to a cell, and the cells alone bound a query's score with every vector of the chunk.  Exact
vectors are then read in order of that bound, until the k-th best exact score beats every bound left,
which makes the chunk's k results certain.  The best k over a query's chunks are the result.  Queries
meet the chunks by an equi-join on the chunk number, in blocks, and stream through a task that holds
one chunk at a time.

Score: inner product of floor(256 * x), as integers (beyond the range of a long: its nearest end).  Ties
go to the smaller id.  Defined cases: vectors that are null or hold null or non-finite components, and rows
with a null id, take no part; only vectors of the same length meet; rows that repeat an id are candidates
each, and of a query's own row only that one row is left out; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roaskit.llm.common import Scratch

#: Vectors of a chunk (on average), queries scored together, bits of a cell, exact vectors read at a time.
CHUNK_ROWS, BLOCK_QUERIES, CELL_BITS, READ_ROWS = 16_384, 64, 4, 32
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


class ApproximationFile:
    """A chunk's exact vectors and the cells their components fall into."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.keys, self.ids, self.vectors = keys, ids, vectors
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        self.width = np.maximum((high - low) / (1 << CELL_BITS), 1e-9)
        cells = np.minimum(np.floor((vectors - low) / self.width), (1 << CELL_BITS) - 1)
        self.cells = cells.astype(np.uint8)
        self.low = low
        self.largest = float(np.abs(vectors).max(initial=0.0))

    def top(self, keys: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query's row, vector's id, score) of the k best of each query in this chunk."""
        middle = self.low + (self.cells + 0.5) * self.width
        slack = np.abs(queries) @ (self.width / 2)
        upper = queries @ middle.T
        upper += (slack + 1 + np.abs(upper).max(initial=0.0) * 1e-9)[:, None]  # rounding of the bound itself
        exact = self.largest * float(np.abs(queries).max(initial=0.0)) * queries.shape[1] < EXACT
        out = []
        for row, (key, query) in enumerate(zip(keys, queries)):
            bound = upper[row]
            best: list[tuple[int, int]] = []  # (-score, id), ascending
            left, order, done = np.arange(len(bound)), np.empty(0, np.int64), 0
            while done < len(order) or len(left):
                if done == len(order):  # the next highest bounds of the vectors not read yet
                    at = self._first(bound[left], max(READ_ROWS, 2 * k, 3 * len(order)))
                    order, done = left[at], 0
                    left = np.delete(left, at)
                part = order[done:done + READ_ROWS]
                if len(best) == k and bound[part[0]] < -best[-1][0]:
                    break
                if exact:
                    scores = (self.vectors[part] @ query).astype(np.int64).tolist()
                else:
                    scores = [max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(v, query)))) for v in self.vectors[part]]
                best += [(-s, int(self.ids[i])) for s, i in zip(scores, part) if self.keys[i] != key]
                best = sorted(best)[:k]
                done += len(part)
            out += [(int(key), i, -s) for s, i in best]
        return out

    @staticmethod
    def _first(bound: np.ndarray, n: int) -> np.ndarray:
        """Rows of the n highest bounds, highest first."""
        if n >= len(bound):
            return np.argsort(-bound, kind="stable")
        part = np.argpartition(-bound, n)[:n]
        return part[np.argsort(-bound[part], kind="stable")]


def _scan(k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by chunk and kind: a chunk's vectors (kind 0), then the queries (kind 1)."""
        chunk, vectors, queries, file = None, [], [], None

        def matrix(parts: list) -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))

        def score() -> pa.RecordBatch:
            keys, ids, q = matrix(queries)
            owner = dict(zip(keys.tolist(), ids.tolist()))
            rows = [r for at in range(0, len(keys), BLOCK_QUERIES) for r in file.top(keys[at:at + BLOCK_QUERIES], q[at:at + BLOCK_QUERIES], k)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (
                [r[0] for r in rows], [owner[r[0]] for r in rows], [r[1] for r in rows], [r[2] for r in rows])],
                names=["row_key", "query_id", "vec_id", "score"])

        for batch in batches:
            chunks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keys, ids = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            lists = batch.column(4)
            cuts = np.flatnonzero(np.concatenate(([True], (chunks[1:] != chunks[:-1]) | (kinds[1:] != kinds[:-1]), [True])))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = lists.slice(a, b - a)
                size = len(part[0]) if b > a else 0
                values = part.flatten().to_numpy().astype(np.float64).reshape(b - a, size)
                if chunks[a] != chunk:
                    if queries:
                        yield score()
                    chunk, vectors, queries, file = chunks[a], [], [], None
                if kinds[a] == 0:
                    vectors.append((keys[a:b], ids[a:b], values))
                    continue
                if not vectors:
                    continue
                if file is None:
                    file = ApproximationFile(*matrix(vectors))
                queries.append((keys[a:b], ids[a:b], values))
                if sum(len(q[0]) for q in queries) >= BLOCK_QUERIES:
                    yield score()
                    queries = []
        if queries:
            yield score()
    return scan


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): rows whose id is divisible by ``every`` against all other rows."""
    scratch = Scratch(vectors.sparkSession)
    as_double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), as_double.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite))
    # whole numbers as doubles: exact below 2^53, and no overflow above
    cells = F.transform("x", lambda x: F.when(F.abs(x) < 1e15, F.floor(x * 256).cast("double")).otherwise(x * 256))
    rows = scratch.keep(rows.select("vec_id", cells.alias("x"), F.size("x").alias("size"),
                                    F.monotonically_increasing_id().alias("row_key")), "vectors")
    sizes = {r["size"]: r["count"] for r in rows.groupBy("size").count().collect()}  # one row per vector length
    parts = []
    for size, n in sizes.items():
        chunks = -(-n // CHUNK_ROWS)
        same = rows.where(F.col("size") == size)
        held = same.select(F.pmod(F.xxhash64("row_key"), F.lit(chunks)).alias("chunk"), F.lit(0).alias("kind"), "row_key", "vec_id", "x")
        asked = same.where(F.col("vec_id") % every == 0).select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), F.lit(1).alias("kind"), "row_key", "vec_id", "x")
        met = held.unionByName(asked).repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind", "row_key")
        parts.append(met.select("chunk", "kind", "row_key", "vec_id", "x").mapInArrow(
            _scan(k), "row_key long, query_id long, vec_id long, score long"))
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("row_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
