import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from roaskit.plans import stats as st
from roaskit.plans.impute import impute_iterative, impute_mean


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 20) / 20.0, rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, y int")
    assert abs(st.auc_exact(df, "score", "y").first().auc - brute_auc(pairs)) < 1e-12
    roc = sorted((r.fpr, r.tpr) for r in st.roc_points(df, "score", "y").collect())
    assert roc[-1] == (1.0, 1.0)


def test_split_and_folds(spark):
    df = spark.range(1000).withColumn("t", (F.col("id") * 7919) % 1000)
    s = st.chronological_split(df, ["t", "id"])
    sizes = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes == {"train": 700, "tune": 150, "test": 150}
    assert s.where("split = 'train'").agg(F.max("t")).first()[0] < s.where("split = 'test'").agg(F.min("t")).first()[0]
    f = st.time_series_folds(df, ["t", "id"], 5).toPandas()
    for k, g in f.groupby("fold"):
        assert g[g.role == "train"].row_rank.max() < g[g.role == "test"].row_rank.min()
        assert (g.role == "test").sum() == 1000 // 6


def test_bootstrap_interval_contains_mean(spark):
    rng = random.Random(42)
    vals = [(i, rng.gauss(178.0, 100.0)) for i in range(500)]
    r = st.bootstrap_ci(spark.createDataFrame(vals, "id long, v double"), "v", "id", 1000).first()
    assert r.resamples == 1000 and r.ci_low < r.point_estimate < r.ci_high
    se = pd.Series([v for _, v in vals]).std() / 500 ** 0.5
    assert abs((r.ci_high - r.ci_low) - 2 * 1.96 * se) < 0.35 * 2 * 1.96 * se


def test_imputation_flags_before_fill(spark):
    rows = [(40.0 * k, 90.0 * k + 3, 2.0 * k, "x") for k in range(1, 9)]
    rows[1] = (None, *rows[1][1:])
    rows[4] = (rows[4][0], None, *rows[4][2:])
    rows[6] = (*rows[6][:2], None, "x")
    df = spark.createDataFrame(rows, "total_spend double, revenue double, new_customers double, channel string").coalesce(1)
    cols = ["total_spend", "revenue", "new_customers"]
    it = impute_iterative(df, cols).toPandas()
    assert it.imputed_bool.tolist() == [False, True, False, False, True, False, True, False]
    assert it[cols].notna().all().all()
    # the columns are near-linear in each other: regression fills beat the mean
    assert abs(it.loc[1, "total_spend"] - 80.0) < 15 and abs(it.loc[4, "revenue"] - 453.0) < 60
    m = impute_mean(df, ["new_customers"]).toPandas()
    assert abs(m.loc[6, "new_customers"] - 58.0 / 7) < 1e-9


def test_imputation_leaves_a_column_without_values_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, None, None), (3.0, 6.0, None)], "a double, b double, c double")
    got = sorted((r.a, r.b, r.c) for r in impute_iterative(df, ["a", "b", "c"], ridge=1e-6).collect())
    assert [r[2] for r in got] == [None] * 3 and abs(got[1][1] - 4.0) < 0.01


def test_imputation_equals_the_loop_over_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 1))
    x = np.hstack([base * k + rng.normal(size=(300, 1)) * 0.3 + k for k in (1, 2, -3, 4)])
    x[rng.random(x.shape) < 0.15] = np.nan
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)],
                               "id long, a double, b double, c double, d double").repartition(5)
    gap = np.isnan(x)
    full = np.where(gap, np.nanmean(x, axis=0), x)
    for _ in range(6):
        for t in range(4):
            z = np.hstack([np.ones((300, 1)), np.delete(full, t, axis=1)])
            o = ~gap[:, t]
            beta = np.linalg.solve(z[o].T @ z[o] + 1e-6 * np.eye(4), z[o].T @ full[o, t])
            full[gap[:, t], t] = z[gap[:, t]] @ beta
    out = impute_iterative(df, names, max_iter=6, tol=0.0, ridge=1e-6)
    got = out.orderBy("id").toPandas()
    assert np.allclose(got[names].to_numpy(), full, atol=1e-8)
    assert got.imputed_bool.tolist() == gap.any(axis=1).tolist()


def _fit_rows(z, y):
    """Bayesian ridge on rows: evidence maximisation by singular values, as published."""
    mean, level = z.mean(0), y.mean()
    x, t = z - mean, y - level
    u, s, v = np.linalg.svd(x, full_matrices=False)
    noise, weight, before = 1 / (t.var() + np.finfo(float).eps), 1.0, None
    for _ in range(300):
        beta = v.T @ (s * (u.T @ t) / (s ** 2 + weight / noise))
        known = np.sum(noise * s ** 2 / (weight + noise * s ** 2))
        weight = (known + 2e-6) / (np.sum(beta ** 2) + 2e-6)
        noise = (len(y) - known + 2e-6) / (np.sum((t - x @ beta) ** 2) + 2e-6)
        if before is not None and np.sum(np.abs(before - beta)) < 1e-3:
            break
        before = beta
    beta = v.T @ (s * (u.T @ t) / (s ** 2 + weight / noise))
    return lambda new: level + (new - mean) @ beta


def test_bayesian_imputation_equals_the_loop_over_rows(spark):
    """Several gapped columns; NaN and infinities are gaps like NULL."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(250, 1))
    x = np.hstack([base * k + rng.normal(size=(250, 1)) * 0.4 + 3 * k for k in (1, 2, -3, 40)])
    for t, share in enumerate((0.2, 0.05, 0.1, 0.0)):
        x[rng.random(250) < share, t] = np.nan
    names, odd = ["a", "b", "c", "d"], [None, float("nan"), float("inf")]
    rows = [(i, *[odd[i % 3] if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(5)
    gap = np.isnan(x)
    full = np.where(gap, np.nanmean(x, axis=0), x)
    for _ in range(5):
        for t in sorted((t for t in range(4) if gap[:, t].any()), key=lambda t: gap[:, t].sum()):
            z, o = np.delete(full, t, axis=1), ~gap[:, t]
            full[~o, t] = _fit_rows(z[o], full[o, t])(z[~o])
    got = impute_iterative(df, names, max_iter=5, tol=0.0).orderBy("id").toPandas()
    assert np.allclose(got[names].to_numpy(), full, atol=1e-6)
    assert got.imputed_bool.tolist() == gap.any(axis=1).tolist()


def test_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select("id", (F.col("id") % 37).cast("double").alias("v"))
    a, b = (st.bootstrap_ci(df.repartition(k), "v", "id", 200).first() for k in (1, 7))
    assert abs(a.ci_low - b.ci_low) < 1e-9 and abs(a.ci_high - b.ci_high) < 1e-9
