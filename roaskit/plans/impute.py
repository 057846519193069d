"""Imputation.

``impute_mean`` fills gaps with the column mean (a scalar subquery).
``impute_iterative`` is chained-equation imputation: start from the means,
then, round robin, regress each column that has gaps on
the others using the rows where it is observed, and refill its gaps from the
fit.  The regressions are Bayesian ridge, the column with the fewest gaps
first: both precisions (of the noise and of the weights) are found by
maximising the evidence.  One aggregate
pass gathers a moment matrix per pattern of gaps; all rounds run on these
small matrices, because a gap's value stays an affine function of the row's
observed values.  One projection then fills the gaps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.functions.scalars import any_null


#: Bytes of the fills of all gap patterns up to which they are broadcast.
MOST_BROADCAST = 8 << 20


def impute_mean(df: DataFrame, cols: list[str], flag: str | None = "imputed_bool") -> DataFrame:
    """NULL -> column mean; ``flag`` marks rows that had any gap (set before filling)."""
    out = df.withColumn(flag, any_null(cols)) if flag else df
    for c in cols:
        mean = df.agg(F.avg(c)).scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), mean))
    return out


#: Weak priors of both precisions, rounds of evidence maximisation and the change of weights that ends them.
PRIOR, EVIDENCE_ROUNDS, EVIDENCE_TOL = 1e-6, 300, 1e-3


def impute_iterative(df: DataFrame, cols: list[str], max_iter: int = 10, ridge: float | None = None,
                     tol: float = 1e-3, flag: str | None = "imputed_bool") -> DataFrame:
    """Chained regressions over ``cols`` (numeric).  Flags gaps before filling.

    The regressions are Bayesian ridge, or ridge with the fixed penalty
    ``ridge`` when given (0: least squares).  NULL, NaN and infinite values
    are gaps.  A column without any value stays NULL and takes no part in the
    regressions.
    """
    floats = [c for c, t in df.dtypes if c in cols and t in ("double", "float")]
    df = df.withColumns({c: F.when(F.abs(F.col(c)) < float("inf"), F.col(c)) for c in floats})  # NaN is larger
    flagged = df.withColumn(flag, any_null(cols)) if flag else df
    gaps, tables = _gap_moments(df, cols)
    n = sum(m[0, 0] for m in tables.values())
    seen = {c: sum(m[0, 0] for g, m in tables.items() if g[i] == "0") for i, c in enumerate(cols)}
    used = [i for i, c in enumerate(cols) if seen[c]]
    targets = [i for i in used if seen[cols[i]] < n]
    if ridge is None:
        targets.sort(key=lambda i: -seen[cols[i]])
    if not targets:
        return flagged
    d = len(cols) + 1
    mean = {i: sum(m[0, i + 1] for m in tables.values()) / seen[cols[i]] for i in used}
    # fill[g] turns (1, observed values, 0 in gaps) of pattern g's rows into (1, all values)
    fill = {}
    for g in tables:
        t = np.eye(d)
        for i in used:
            if g[i] == "1":
                t[i + 1] = 0.0
                t[i + 1, 0] = mean[i]
        fill[g] = t
    prev = None
    for _ in range(max_iter if len(used) > 1 else 0):
        betas = []
        for t in targets:
            xs = [0, *(i + 1 for i in used if i != t)]
            full = sum(fill[g] @ m @ fill[g].T for g, m in tables.items() if g[t] == "0")
            beta = _bayesian_ridge(full, xs, t + 1) if ridge is None else _solved(
                full[np.ix_(xs, xs)] + ridge * np.eye(len(xs)), full[xs, t + 1])
            betas.append(beta)
            for g in tables:
                if g[t] == "1":
                    fill[g][t + 1] = beta @ fill[g][xs]
        flat = np.concatenate(betas)
        if prev is not None and np.max(np.abs(flat - prev)) <= tol * max(1.0, np.max(np.abs(prev))):
            break
        prev = flat
    # a row per pattern of gaps that occurs: broadcast while that is small, else joined by shuffle
    rows = [(g, [fill[g][i + 1].tolist() for i in range(len(cols))]) for g in tables if "1" in g]
    maps = df.sparkSession.createDataFrame(rows, "_gaps string, _fill array<array<double>>")
    if len(rows) * len(cols) * d * 8 <= MOST_BROADCAST:
        maps = F.broadcast(maps)
    out = flagged.withColumn("_gaps", gaps).join(maps, "_gaps", "left")
    known = F.array(F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    out = out.withColumn("_known", known)

    def filled(i: int):
        terms = F.zip_with(F.col("_fill")[i], F.col("_known"), lambda a, b: a * b)
        return F.coalesce(F.col(cols[i]), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))
    return out.withColumns({cols[i]: filled(i) for i in targets}).select(*flagged.columns)


def _bayesian_ridge(m: np.ndarray, xs: list[int], y: int) -> np.ndarray:
    """Intercept and weights of column y on ``xs`` (0, the constant, first) from sums of products ``m``.

    Evidence maximisation: with the eigenvalues e of the centred products, ``g = sum(a e / (l + a e))`` weights are
    well determined; the precision of the weights becomes g over their squares, that of the noise the rest of the
    rows over the squared residuals, until the weights settle.
    """
    n, at = m[0, 0], xs[1:]
    mean_x, mean_y = m[0, at] / n, m[0, y] / n
    products = m[np.ix_(at, at)] - n * np.outer(mean_x, mean_x)
    with_y, squares = m[at, y] - n * mean_x * mean_y, max(m[y, y] - n * mean_y * mean_y, 0.0)
    eigen, basis = np.linalg.eigh(products)
    eigen, turned = np.maximum(eigen, 0.0), basis.T @ with_y
    noise, weight = 1.0 / (squares / n + np.finfo(float).eps), 1.0
    before = None
    for _ in range(EVIDENCE_ROUNDS):
        beta = basis @ (turned / (eigen + weight / noise))
        residual = max(squares - 2 * beta @ with_y + beta @ products @ beta, 0.0)
        determined = np.sum(noise * eigen / (weight + noise * eigen))
        weight = (determined + 2 * PRIOR) / (beta @ beta + 2 * PRIOR)
        noise = (n - determined + 2 * PRIOR) / (residual + 2 * PRIOR)
        if before is not None and np.sum(np.abs(before - beta)) < EVIDENCE_TOL:
            break
        before = beta
    beta = basis @ (turned / (eigen + weight / noise))
    return np.concatenate(([mean_y - mean_x @ beta], beta))


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The solution of a symmetric system whose columns have very different units: scaled to a unit diagonal first."""
    scale = 1 / np.sqrt(np.maximum(np.diag(a), np.finfo(float).tiny))
    return scale * np.linalg.solve(a * np.outer(scale, scale), b * scale)


def _gap_moments(df: DataFrame, cols: list[str]):
    """The gap pattern of a row ("0" observed, "1" missing, per column), and per pattern the sums of products of
    (1, observed values), from one aggregate pass; patterns are as many as occur, 2 ** len(cols) at most."""
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    values = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]]
    at = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    rows = df.groupBy(gaps.alias("_gaps")).agg(*[F.sum(values[i] * values[j]).alias(f"m_{i}_{j}") for i, j in at]).collect()
    tables = {}
    for r in rows:
        m = np.zeros((len(values), len(values)))
        for i, j in at:
            m[i, j] = m[j, i] = r[f"m_{i}_{j}"]
        tables[r["_gaps"]] = m
    return gaps, tables
