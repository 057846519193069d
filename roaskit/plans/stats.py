"""Statistics over whole tables: chronological split (M2), time-series folds
(M3), exact AUC and ROC (M6), accuracy (M7) and the Poisson bootstrap (B1).

Global order comes from ``running_totals`` (range partitioning + offsets), so
no step runs in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.operators.ordering import global_rank, running_totals


def chronological_split(df: DataFrame, order_cols, fractions=(0.70, 0.15),
                        names=("train", "tune", "test"), rank_col: str = "row_rank", partitions: int | None = None) -> DataFrame:
    """M2: first floor(f1 * n) rows in time order, next floor(f2 * n), rest (exact)."""
    ranked, n = global_rank(df, order_cols, rank_col, partitions)
    a = int(n * fractions[0])
    b = a + int(n * fractions[1])
    split = (F.when(F.col(rank_col) <= a, names[0]).when(F.col(rank_col) <= b, names[1]).otherwise(names[2]))
    return ranked.withColumn("split", split)


def approx_chronological_split(df: DataFrame, ts: str, fractions=(0.70, 0.15),
                               names=("train", "tune", "test"), accuracy: int = 100_000) -> DataFrame:
    """M2, cheap form: time cut points from ``percentile_approx`` (bounded
    memory, one aggregate pass, no checkpoint).  Split sizes are within the
    sketch's rank error and rows sharing a time stamp stay together; use
    ``chronological_split`` for exact sizes."""
    from roaskit.functions.scalars import micros
    t = micros(ts)
    cuts = df.agg(F.percentile_approx(t, [fractions[0], fractions[0] + fractions[1]], accuracy).alias("q")).scalar()
    out = df.withColumn("_q", cuts)
    split = F.when(t < F.col("_q")[0], names[0]).when(t < F.col("_q")[1], names[1]).otherwise(names[2])
    return out.withColumn("split", split).drop("_q")


def time_series_folds(df: DataFrame, order_cols, n_splits: int = 5, rank_col: str = "row_rank",
                      partitions: int | None = None) -> DataFrame:
    """M3: expanding-window folds; test size floor(n / (k + 1)); training rows
    always precede the fold's test rows.  One output row per (row, fold) the
    row takes part in, with ``role`` train or test."""
    ranked, n = global_rank(df, order_cols, rank_col, partitions)
    test_size = n // (n_splits + 1)
    idx = F.col(rank_col) - 1
    folds = []
    for i in range(n_splits):  # a frame per fold: a reader of one fold does not make the rows of the others
        start = n - (n_splits - i) * test_size
        role = F.when(idx < start, "train").otherwise("test")
        folds.append(ranked.where(idx < start + test_size).withColumns({"fold": F.lit(i), "role": role}))
    return reduce(DataFrame.union, folds)


def exact_quantiles(df: DataFrame, col: str, probs, tie_cols: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy / pandas default):
    for p, h = (n - 1) p, value = x[floor h] + (h - floor h)(x[floor h + 1] - x[floor h]).

    Unlike Spark's exact ``percentile`` -- which gathers a whole group in one
    task -- the order comes from the distributed ``global_rank``; only the
    2 x len(probs) rows at the needed ranks are kept.  One row per p.
    """
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"), *(tie_cols or []))
    ranked, n = global_rank(x, ["_x", *(tie_cols or [])], "_r")
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([(float(p), None) for p in probs], "p double, value double")
    wanted = {}
    for p in probs:
        h = (n - 1) * float(p)
        lo = int(math.floor(h))
        wanted[float(p)] = (lo + 1, min(lo + 2, n), h - lo)  # 1-based ranks
    ranks = sorted({r for lo, hi, _ in wanted.values() for r in (lo, hi)})
    picked = ranked.where(F.col("_r").isin(ranks)).select("_r", "_x")
    rows = [(p, lo, hi, frac) for p, (lo, hi, frac) in wanted.items()]
    spec = spark.createDataFrame(rows, "p double, lo long, hi long, frac double")
    lo_v = picked.select(F.col("_r").alias("lo"), F.col("_x").alias("_xl"))
    hi_v = picked.select(F.col("_r").alias("hi"), F.col("_x").alias("_xh"))
    j = spec.join(lo_v, "lo").join(hi_v, "hi")
    return j.select("p", (F.col("_xl") + F.col("frac") * (F.col("_xh") - F.col("_xl"))).alias("value"))


def _score_counts(df: DataFrame, score: str, label: str, by: list[str] | None = None, rows: str | None = None) -> DataFrame:
    s = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    n = F.col(rows).cast("double") if rows else F.lit(1.0)
    return s.groupBy(*(by or []), score).agg(F.sum(F.col(label).cast("double") * n).alias("pos"),
                                               F.sum((1.0 - F.col(label).cast("double")) * n).alias("neg"))


def auc_exact(df: DataFrame, score: str, label: str, partitions: int | None = None) -> DataFrame:
    """M6: exact ROC AUC with ties counted one half (Mann-Whitney), one row.

    Counts are aggregated per distinct score first (map-side), then one
    running sum of negatives in score order gives, per score, the negatives
    ranked below it.  ``partitions`` are those of the running sum.
    """
    g = _score_counts(df, score, label)
    cum, tot = running_totals(g, [score], ["neg", "pos"], prefix="cum_", partitions=partitions)
    p, n = tot["pos"], tot["neg"]
    below = F.col("cum_neg") - F.col("neg")
    num = cum.agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("num"))
    return num.select((F.col("num") / F.lit(p * n) if p * n > 0 else F.lit(None).cast("double")).alias("auc"),
                      F.lit(int(p)).cast("long").alias("positives"), F.lit(int(n)).cast("long").alias("negatives"))


def auc_by(df: DataFrame, score: str, label: str, by: str, partitions: int | None = None, rows: str | None = None) -> DataFrame:
    """M6: ``auc_exact`` of every value of ``by`` in one scan, one row each (null where a label is missing).  ``rows`` is a
    column with the rows that a row stands for."""
    g = _score_counts(df, score, label, [by], rows)
    cum, _ = running_totals(g, [score], ["neg"], prefix="cum_", partitions=partitions, group_cols=[by])
    below, pairs = F.col("cum_neg") - F.col("neg"), F.col("positives") * F.col("negatives")
    told = cum.groupBy(by).agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("num"),
                               F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    return told.select(by, F.when(pairs > 0, F.col("num") / pairs).alias("auc"), F.col("positives").cast("long").alias("positives"),
                       F.col("negatives").cast("long").alias("negatives"))


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """M6: (threshold, fpr, tpr) at every distinct score, from the highest down."""
    g = _score_counts(df, score, label)
    cum, tot = running_totals(g, [F.col(score).desc()], ["pos", "neg"], prefix="cum_")
    p, n = tot["pos"], tot["neg"]
    return cum.select(F.col(score).alias("threshold"),
                      (F.col("cum_neg") / F.lit(n) if n else F.lit(None).cast("double")).alias("fpr"),
                      (F.col("cum_pos") / F.lit(p) if p else F.lit(None).cast("double")).alias("tpr"))


def accuracy(df: DataFrame, pred: str, label: str, by: list[str] | None = None) -> DataFrame:
    """M7: share of rows whose prediction equals the label (per group)."""
    ok = (F.col(pred).cast("int") == F.col(label).cast("int")).cast("double")
    g = df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.avg(ok).alias("accuracy"))
    return g


# --- fixed values: Poisson(1) cumulative distribution, by formula -----------------
POISSON1_CDF = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(12)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that neighbouring inputs give unrelated bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Weights held at once in a bootstrap task.
BOOTSTRAP_CELLS = 1 << 20


def _resample_sums(n_resamples: int):
    """Of rows (hash of the row's id, value): per resample the sum of weight x value and of weights, once a task."""
    marks = _mixed(np.arange(1, n_resamples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    edges = (np.array(POISSON1_CDF) * 2.0 ** 32).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(n_resamples), np.zeros(n_resamples)
        step = max(1, BOOTSTRAP_CELLS // n_resamples)
        for batch in batches:
            ids = batch.column(0).to_numpy().view(np.uint64)
            values = batch.column(1).to_numpy()
            for k in range(0, len(ids), step):
                u = (_mixed(ids[k:k + step, None] ^ marks) >> np.uint64(32)).astype(np.uint32)
                weights = np.searchsorted(edges, u, side="right").astype(np.float64)
                sums += values[k:k + step] @ weights
                counts += weights.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_resamples, dtype=np.int32)), pa.array(sums), pa.array(counts)],
                                         names=["_b", "_s", "_n"])
    return run


def bootstrap_ci(df: DataFrame, value: str, id_col: str, n_resamples: int = 1000, level: float = 0.95,
                 seed: int = 42) -> DataFrame:
    """B1: Poisson bootstrap of the mean: every row gets weight Poisson(1) in
    every resample (inverse CDF of a seeded hash of row id and resample, so
    the same in any partitioning).  A task adds its rows into one sum and one
    count per resample, and a small aggregate merges the tasks; exact
    percentiles give the interval.  One row: point estimate, interval bounds,
    resample count."""
    x = df.where(F.col(value).isNotNull()).select(F.xxhash64(id_col, F.lit(seed)).alias("_id"), F.col(value).cast("double").alias("_x"))
    parts = x.mapInArrow(_resample_sums(n_resamples), "_b int, _s double, _n double")
    means = (parts.groupBy("_b").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
             .where(F.col("_n") > 0).select((F.col("_s") / F.col("_n")).alias("_m")))
    a = (1 - level) / 2
    q = means.agg(F.percentile("_m", F.array(F.lit(a), F.lit(1 - a))).alias("q"), F.count(F.lit(1)).alias("k"))
    point = x.agg(F.avg("_x")).scalar()
    return q.select(point.alias("point_estimate"), F.col("q")[0].alias("ci_low"), F.col("q")[1].alias("ci_high"),
                    F.col("k").alias("resamples"))
