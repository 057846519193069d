"""Conversion model (M1, M4, M5, M8-M11) on Spark ML.

Gradient-boosted trees (``GBTClassifier``) stand in for the single-machine
booster; a task grows all trees of a fit (``roaskit.plans.boost``).  AUC is computed exactly by ``roaskit.plans.stats.auc_exact`` on the
scored frame, so model quality is compared, not tree values.
"""

from __future__ import annotations

import math
import random
import uuid
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from roaskit.functions.scalars import weekday_mon0
from roaskit.operators.reshape import align_features, one_hot
from roaskit.plans import boost
from roaskit.plans.stats import auc_by, auc_exact
from roaskit.session import delete_at_exit, ensure_checkpoint_dir

CATEGORICALS = ["utm_source", "utm_medium", "creative_format", "creative_theme", "effectiveness_tier"]


def build_features(sessions: DataFrame, levels: dict[str, list], keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """M1: hour, weekday (Mon = 0), month, spend (NULL -> 0) and one-hot
    columns with a NULL indicator for each categorical.  Returns the frame and
    the ordered feature list (ids, dates, names and the target are excluded)."""
    base = sessions.withColumns({
        "hour_of_day": F.hour("session_start"),
        "day_of_week": weekday_mon0("session_start"),
        "month": F.month("session_start"),
        "spend": F.coalesce(F.col("spend").cast("double"), F.lit(0.0)),
    })
    enc = one_hot(base, levels, null_indicator=True, drop=True)
    features = ["spend", "hour_of_day", "day_of_week", "month"] + \
        [f"{c}_{v}" for c, vals in levels.items() for v in vals] + [f"{c}_nan" for c in levels]
    return align_features(enc, features, keep=keep), features


#: Rows of one task of a fit.  A fit runs a job per level of every tree, so its tasks are cut by rows: with as many as a
#: shuffle has partitions, a small table spends its time on starting tasks.
TASK_ROWS = 100_000
#: Rows of one task of the frames that a fit is made from, which are read a few times only.
FRAME_ROWS = 50_000
#: The row number that ``stats.chronological_split`` and ``stats.time_series_folds`` give.
RANK = "row_rank"


def fit_tasks(df: DataFrame) -> int:
    """The partitions that a frame is fitted and scored in."""
    return max(1, -(-df.count() // TASK_ROWS))


def frame_tasks(spark: SparkSession, rows: int) -> int:
    """The partitions that so many rows are put in order in: as many as a shuffle has, or fewer for few rows."""
    return max(1, min(-(-rows // FRAME_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def dealt(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """All rows of ``df`` in ``fit_tasks`` partitions of equal size, whatever part of the time order they are of.

    Rows are dealt and ordered by ``RANK`` (all columns, if there is none), so the draws of a seeded fit depend on the
    rows alone, not on the cluster's settings."""
    key = [RANK] if RANK in df.columns else [f"`{c}`" for c in df.columns]
    return df.repartition(tasks or fit_tasks(df), *key).sortWithinPartitions(*key)


def _vectors(df: DataFrame, assembler: VectorAssembler, label: str, tasks: int | None = None) -> DataFrame:
    """The label and the feature vector of every row, dealt and checkpointed: a fit's tasks carry all that lies between
    its rows and their last written or shuffled form, hundreds of times, and its jobs go through the stages before."""
    ensure_checkpoint_dir(df.sparkSession)
    row = [label, assembler.getOutputCol()]
    if RANK not in df.columns:
        return assembler.transform(dealt(df, tasks)).select(*row).checkpoint()
    # the rows are dealt as vectors, which are narrower than the columns they are made of
    return dealt(assembler.transform(df).select(*row, RANK), tasks or fit_tasks(df)).select(*row).checkpoint()


#: Rows that a larger frame's split points are found in (Spark ML looks at 10,000 of them).
SPLIT_ROWS = 50_000


def _units(df: DataFrame, assembler: VectorAssembler, learner: GBTClassifier, test: DataFrame | None = None):
    """(units, split points, whether in order) of the rows to fit (role 0) and of those to score (role 1), written; None if
    there are more to fit than one task takes."""
    ensure_checkpoint_dir(df.sparkSession)
    label, inputs, n = learner.getLabelCol(), assembler.getInputCols(), df.count()
    key = [RANK] if RANK in df.columns else [f"`{c}`" for c in df.columns]
    in_order, some = n <= TASK_ROWS, df
    if not in_order and n > SPLIT_ROWS:  # the same rows however they lie
        some = df.where(F.pmod(F.xxhash64(*key, F.lit(learner.getSeed())), F.lit(n)) < SPLIT_ROWS)
    splits = boost.find_splits(_vectors(some, assembler, label, 1), learner)
    row = [f"`{c}`" for c in (label, *inputs)]
    if in_order:
        rows = dealt(df.select(*row, RANK) if RANK in df.columns else df, 1).select(*row)
    else:
        rows = df.select(*row)
    told = boost.units(rows, splits, in_order).withColumn("role", F.lit(0)).checkpoint()
    if not in_order and told.count() > boost.MOST_UNITS:
        return None
    if test is not None:
        told = told.unionByName(boost.units(test.select(*row), splits, False, train=False).withColumn("role", F.lit(1)).checkpoint())
    return told, splits, in_order


def fit_dealt(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """A fit (of ``gbt_pipeline`` or ``logistic_pipeline``) on the rows of ``df``: of a frame of many tasks from its units, if one
    task can take them, otherwise by Spark ML on the rows, dealt and kept for the time of the fit."""
    assembler, learner = pipeline.getStages()
    params = boost.params_of(learner)
    found = _units(df, assembler, learner) if params and fit_tasks(df) > 1 else None
    if found:
        told, splits, in_order = found
        made = told.coalesce(1).mapInArrow(boost.nodes(splits, params, in_order), boost.NODE).collect()  # nodes of a model
        return PipelineModel([assembler, boost.spark_model(df.sparkSession, made, splits, learner)])
    rows = _vectors(df, assembler, learner.getLabelCol()).persist()
    try:
        return PipelineModel([assembler, learner.fit(rows)])
    finally:
        rows.unpersist()


def gbt_pipeline(features: list[str], label: str = "converted", seed: int = 42, **params) -> Pipeline:
    """M4: assemble features -> GBT (``maxIter``, ``stepSize``, ``maxDepth``,
    ``subsamplingRate``, ``featureSubsetStrategy``, ``minInfoGain``)."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **params)
    return Pipeline(stages=[asm, gbt])


def logistic_pipeline(features: list[str], label: str = "churned") -> Pipeline:
    """M8: logistic-regression baseline."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, LogisticRegression(featuresCol="features", labelCol=label)])


def positive_probability(scored: DataFrame, name: str = "p_convert") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


def model_auc(model: PipelineModel, df: DataFrame, label: str = "converted") -> float | None:
    scored = positive_probability(model.transform(df)).select("p_convert", label)
    return auc_exact(scored, "p_convert", label, fit_tasks(df)).first()["auc"]


# --- fixed values: ranges of the published searches ---
SPACE = {
    "maxIter": (100, 1000),
    "stepSize": (0.01, 0.3),
    "maxDepth": (3, 10),
    "subsamplingRate": (0.6, 1.0),
    "featureShare": (0.6, 1.0),
}
TRIALS, CV_TRIALS = 25, 50
#: Fits that run side by side on one persisted frame, and the tasks per core that fits of few tasks run side by side: a fit
#: waits for the driver between its many short jobs.
PARALLELISM, TASKS_PER_CORE = 4, 4


def sample_params(rng: random.Random, space: dict | None = None) -> dict:
    """One seeded random draw from the search space (learning rate on a log scale)."""
    sp = {**SPACE, **(space or {})}
    lo, hi = sp["stepSize"]
    return {
        "maxIter": rng.randint(*sp["maxIter"]),
        "stepSize": float(10 ** rng.uniform(math.log10(lo), math.log10(hi))),
        "maxDepth": rng.randint(*sp["maxDepth"]),
        "subsamplingRate": rng.uniform(*sp["subsamplingRate"]),
        "featureSubsetStrategy": f"{rng.uniform(*sp['featureShare']):.4f}",
    }


def _side_by_side(spark: SparkSession, task, items: list, parallelism: int) -> list:
    """``task`` of every item, several at once; each is a series of Spark jobs."""
    pool = ThreadPool(parallelism)
    try:
        return pool.map(inheritable_thread_target(spark)(task), items, chunksize=1)
    finally:
        pool.terminate()


def fits_at_once(spark: SparkSession, tasks: int) -> int:
    """How many fits of so many tasks run side by side: on a large table a few fits fill the cores, on a small one many must."""
    return max(PARALLELISM, -(-TASKS_PER_CORE * spark.sparkContext.defaultParallelism // tasks))


class Part(NamedTuple):
    """A train and a test frame made ready for many fits: units of both, or, for Spark ML, the rows of each."""

    units: DataFrame | None
    splits: list
    in_order: bool
    train: DataFrame | None
    test: DataFrame | None
    tasks: int
    size: int


def _ready(train: DataFrame, test: DataFrame, features: list[str], label: str, seed: int) -> Part:
    assembler, learner = gbt_pipeline(features, label, seed=seed).getStages()
    found = _units(train, assembler, learner, test)
    if found:
        return Part(*found, None, None, 1, found[0].count())
    rows = [_vectors(df, assembler, label).persist() for df in (train, test)]
    tasks = rows[0].rdd.getNumPartitions()
    return Part(None, [], False, *rows, tasks, tasks * TASK_ROWS)


def _done(parts: list[Part]) -> None:
    for rows in (df for part in parts for df in (part.train, part.test) if df is not None):
        rows.unpersist()


def _by_length(fits: list, params_of, part_of) -> list:
    """The fits, the longest first, so that none of them runs on alone at the end."""
    return sorted(fits, key=lambda f: params_of(f)["maxIter"] * params_of(f)["maxDepth"] * part_of(f).size, reverse=True)


def _search_aucs(parts: list[tuple[DataFrame, DataFrame]], features: list[str], drawn: list[dict], label: str, seed: int,
                 parallelism: int | None) -> list[list[float | None]]:
    """For each draw, the AUC on every part: fitted on the first frame of the part, scored on the second.

    Each fit's scores are written, and one pass over all of them gives every AUC: an AUC of its own would cost each
    fit a dozen jobs."""
    spark = parts[0][0].sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    kept = [_ready(train, test, features, label, seed) for train, test in parts]

    def score(item) -> None:
        at, params, part = item
        if part.units is not None:
            run = boost.scores(part.splits, {**params, "seed": seed}, part.in_order, at)
            scored = part.units.coalesce(1).mapInArrow(run, boost.SCORED)
            by_label = F.array(*[F.struct(F.lit(y).alias("label"), F.col(n).alias("rows")) for y, n in ((1, "pos"), (0, "neg"))])
            scored = scored.select("fit", "score", F.inline(by_label)).where("rows > 0")
        else:
            model = gbt_pipeline(features, label, seed=seed, **params).getStages()[1].fit(part.train)
            scored = positive_probability(model.transform(part.test), "score").select(
                F.lit(at).alias("fit"), "score", F.col(label).cast("int").alias("label"), F.lit(1).cast("long").alias("rows"))
        scored.write.parquet(f"{path}/{at}")

    fits = [(at, *fit) for at, fit in enumerate((p, part) for p in drawn for part in kept)]
    try:
        _side_by_side(spark, score, _by_length(fits, lambda f: f[1], lambda f: f[2]),
                      parallelism or fits_at_once(spark, max(part.tasks for part in kept)))
    finally:
        _done(kept)
    scores = spark.read.parquet(*[f"{path}/{at}" for at in range(len(fits))])
    found = {r["fit"]: r["auc"] for r in auc_by(scores, "score", "label", "fit", frame_tasks(spark, scores.count()), "rows").collect()}  # a row per fit
    return [[found.get(t * len(parts) + k) for k in range(len(parts))] for t in range(len(drawn))]


def fitted_auc(train: DataFrame, test: DataFrame, features: list[str], params: dict, label: str = "converted", seed: int = 42) -> float | None:
    """The AUC on ``test`` of a fit on ``train``."""
    return _search_aucs([(train, test)], features, [params], label, seed, None)[0][0]


TRIAL = "trial int, max_iter int, step_size double, max_depth int, subsampling_rate double, feature_share double"


def _trial_row(t: int, p: dict) -> tuple:
    return t, p["maxIter"], p["stepSize"], p["maxDepth"], p["subsamplingRate"], float(p["featureSubsetStrategy"])


def search_params(train: DataFrame, tune: DataFrame, features: list[str], trials: int = TRIALS,
                  label: str = "converted", seed: int = 42, space: dict | None = None,
                  parallelism: int | None = None) -> DataFrame:
    """M5: seeded random search maximising hold-out AUC; one row per trial.  Both frames are dealt and persisted once,
    and several trials run side by side (``fits_at_once``, if ``parallelism`` is not given)."""
    rng = random.Random(seed)
    drawn = [sample_params(rng, space) for _ in range(trials)]
    aucs = _search_aucs([(train, tune)], features, drawn, label, seed, parallelism)
    rows = [(*_trial_row(t, p), auc) for t, (p, (auc,)) in enumerate(zip(drawn, aucs))]
    return train.sparkSession.createDataFrame(rows, f"{TRIAL}, auc double")


def search_params_cv(folds: DataFrame, features: list[str], trials: int = CV_TRIALS, label: str = "converted",
                     seed: int = 42, space: dict | None = None, parallelism: int | None = None) -> DataFrame:
    """M5 with M3: seeded random search scored by mean AUC over expanding
    time-series folds (``folds`` as produced by ``stats.time_series_folds``:
    one row per (row, fold) with ``role`` train / test).  Each fold's frames are
    dealt and persisted once; a trial fits one model per fold, several fits side by side."""
    rng = random.Random(seed)
    drawn = [sample_params(rng, space) for _ in range(trials)]
    parts = fold_parts(folds)
    scores = _search_aucs(parts, features, drawn, label, seed, parallelism) if parts else [[] for _ in drawn]
    rows = []
    for t, p in enumerate(drawn):
        valid = [a for a in scores[t] if a is not None]
        rows.append((*_trial_row(t, p), len(parts), sum(valid) / len(valid) if valid else None))
    return folds.sparkSession.createDataFrame(rows, f"{TRIAL}, folds int, mean_auc double")


def _block_of_trees(spark: SparkSession, gbt: GBTClassificationModel, start: int, stop: int) -> GBTClassificationModel:
    """The model of the trees from ``start`` up to ``stop`` alone."""
    gateway = spark.sparkContext._gateway
    ml, n = gateway.jvm.org.apache.spark.ml, stop - start
    whole = gbt._java_obj
    trees, weights = whole.trees(), whole.treeWeights()
    some, scales = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        some[i], scales[i] = trees[start + i], weights[start + i]
    return GBTClassificationModel(ml.classification.GBTClassificationModel(whole.uid(), some, scales))


def staged_aucs(model: PipelineModel, df: DataFrame, counts: list[int], label: str = "converted") -> dict[int, float | None]:
    """AUC on ``df`` of the first k trees of a fitted model, for each k of ``counts``.

    Boosting adds trees one after another, so the first k trees of a fit are the fit of k trees (same seed): one
    fit at the largest count stands for all smaller ones.  Each tree scores a row once: the margin of k trees is
    the sum of the margins of the blocks of trees between counts, and one pass over all margins gives every AUC.
    Counts beyond the model's are left out."""
    gbt, made = model.stages[-1], PipelineModel(model.stages[:-1])
    counts = sorted({k for k in counts if 0 < k <= gbt.getNumTrees})
    scored, margin, start = made.transform(df).select(label, gbt.getFeaturesCol()), F.lit(0.0), 0
    for k in counts:
        block = _block_of_trees(df.sparkSession, gbt, start, k).setFeaturesCol(gbt.getFeaturesCol())
        block = block.setRawPredictionCol(f"block_{k}").setProbabilityCol("").setPredictionCol("")
        scored, margin, start = block.transform(scored), margin + vector_to_array(f"block_{k}")[1], k
        scored = scored.withColumn(f"margin_{k}", margin)
    told = F.array(*[F.struct(F.lit(k).alias("trees"), F.col(f"margin_{k}").alias("margin")) for k in counts])
    margins = scored.select(label, F.inline(told))
    found = {r["trees"]: r["auc"] for r in auc_by(margins, "margin", label, "trees", fit_tasks(df)).collect()}  # a row per count
    return {k: found.get(k) for k in counts}


#: Successive halving keeps one trial of so many in each round, and scores a fit at so many tree counts.
ETA, STAGES = 3, 4


def halving_budgets(trials: int, most: int, eta: int = ETA) -> list[int]:
    """The tree counts of the rounds: the last fits ``most`` trees, each earlier one a part of eta of the next."""
    rounds = 0
    while eta ** (rounds + 1) <= trials:
        rounds += 1
    return [max(1, -(-most // eta ** r)) for r in range(rounds, -1, -1)]


def _best_stage(scores: dict[int, float]) -> tuple[float, int]:
    """(AUC, tree count) of the best stage, of equals that of the fewest trees."""
    return max(((auc, k) for k, auc in scores.items()), key=lambda s: (s[0], -s[1]), default=(-math.inf, 0))


def search_params_halving(parts: list[tuple[DataFrame, DataFrame]], features: list[str], trials: int = TRIALS,
                          label: str = "converted", seed: int = 42, space: dict | None = None, eta: int = ETA,
                          parallelism: int | None = None) -> DataFrame:
    """M5 in stages: the draws of ``search_params``, but only promising ones are fitted whole.

    ``parts`` are (train, test) pairs: one for a hold-out search, one per fold for a cross-validated one.  In the first
    round every trial gets a small part of the largest tree count; each later round fits the best of ``eta`` with
    ``eta`` times as many trees, up to what the trial drew.  A fit is scored at several tree counts (``staged_aucs``)
    by the mean AUC of the parts, and a trial counts by its best.

    One row per trial: ``max_iter`` is the best tree count found (so ``best_params`` takes it), ``drawn_iter`` the
    count drawn, ``fitted_iter`` the trees of the longest fit, ``rounds`` the rounds it took part in, and ``auc`` (null
    if no part has both labels)."""
    rng = random.Random(seed)
    drawn = [sample_params(rng, space) for _ in range(trials)]
    spark = parts[0][0].sparkSession
    parts = [_ready(train, test, features, label, seed) for train, test in parts]
    scores: list[dict[int, float]] = [{} for _ in drawn]
    fitted, rounds, alive = [0] * trials, [0] * trials, list(range(trials))

    def fit(item) -> tuple[int, dict[int, float | None]]:
        at, params, part = item
        counts = sorted({-(-params["maxIter"] * j // STAGES) for j in range(1, STAGES + 1)})
        if part.units is None:
            assembler, learner = gbt_pipeline(features, label, seed=seed, **params).getStages()
            return at, staged_aucs(PipelineModel([learner.fit(part.train)]), part.test, counts, label)
        run = boost.stages(part.splits, {**params, "seed": seed}, part.in_order, counts)
        return at, {r["trees"]: r["auc"] for r in part.units.coalesce(1).mapInArrow(run, boost.STAGED).collect()}  # a row per count

    try:
        for budget in halving_budgets(trials, max(p["maxIter"] for p in drawn), eta):
            todo = [(t, min(budget, drawn[t]["maxIter"])) for t in alive]
            todo = [(t, trees) for t, trees in todo if trees > fitted[t]]
            fits = [(at, *f) for at, f in enumerate(({**drawn[t], "maxIter": trees}, part) for t, trees in todo for part in parts)]
            fits = _by_length(fits, lambda f: f[1], lambda f: f[2])
            told = [found for _, found in sorted(_side_by_side(spark, fit, fits, parallelism or fits_at_once(spark, max(p.tasks for p in parts))),
                                                 key=lambda x: x[0])]
            for at, (t, trees) in enumerate(todo):
                found = told[at * len(parts):(at + 1) * len(parts)]
                for k in found[0]:
                    valid = [f[k] for f in found if f[k] is not None]
                    if valid:
                        scores[t][k] = sum(valid) / len(valid)
                fitted[t] = trees
            for t in alive:
                rounds[t] += 1
            alive = sorted(alive, key=lambda t: (-_best_stage(scores[t])[0], t))[:-(-len(alive) // eta)]
    finally:
        _done(parts)
    rows = []
    for t, p in enumerate(drawn):
        auc, trees = _best_stage(scores[t])
        rows.append((*_trial_row(t, {**p, "maxIter": trees or p["maxIter"]}), p["maxIter"], fitted[t], rounds[t],
                     auc if scores[t] else None))
    return spark.createDataFrame(rows, f"{TRIAL}, drawn_iter int, fitted_iter int, rounds int, auc double")


def fold_parts(folds: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """The (train, test) pairs of ``stats.time_series_folds``."""
    ids = sorted(r[0] for r in folds.select("fold").distinct().collect())  # k values
    by_role = lambda f, role: folds.where((F.col("fold") == f) & (F.col("role") == role))
    return [(by_role(f, "train"), by_role(f, "test")) for f in ids]


def best_trial(searched: DataFrame, score: str = "auc") -> Row:
    """The row of the best trial of a search (the earliest of equals)."""
    best = searched.where(F.col(score).isNotNull()).orderBy(F.col(score).desc(), "trial").first()
    if best is None:
        raise ValueError("no trial could be scored")
    return best


def best_params(searched: DataFrame, score: str = "auc") -> dict:
    """The parameters of the best trial of a search, for ``gbt_pipeline``."""
    best = best_trial(searched, score)
    return {"maxIter": best["max_iter"], "stepSize": best["step_size"], "maxDepth": best["max_depth"],
            "subsamplingRate": best["subsampling_rate"], "featureSubsetStrategy": f"{best['feature_share']:.4f}"}


def feature_importance(model: PipelineModel, features: list[str], k: int = 15) -> DataFrame:
    """M9: top ``k`` feature importances (bounded by the feature count)."""
    gbt = model.stages[-1]
    imp = gbt.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(features, imp)), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    """The pipeline carries its feature list (assembler input columns)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> tuple[PipelineModel, list[str]]:
    m = PipelineModel.load(path)
    return m, list(m.stages[0].getInputCols())


LIFT_STEPS = [10, 25, 50, 75, 100]


def lift_forecast(model: PipelineModel, features_df: DataFrame, orders: DataFrame,
                  steps=LIFT_STEPS) -> DataFrame:
    """Scored as is and with spend x (1 + pct / 100) for every pct at once
    (one exploded frame, one transform).  Incremental conversions
    sum(p1 - p0) = sum(p1) - sum(p0), so no row pairing or join is needed;
    revenue = that x mean order value over all orders (a scalar subquery).
    Trees may give a negative lift; it is not clipped."""
    assembler, learner = model.stages
    inputs, rest = assembler.getInputCols(), []
    for k, cols in enumerate((inputs[:inputs.index("spend")], inputs[inputs.index("spend") + 1:])):
        if cols:  # what does not change with the spend is assembled once per row, not once per pct
            part = VectorAssembler(inputCols=cols, outputCol=f"_rest_{k}", handleInvalid=assembler.getHandleInvalid())
            features_df, rest = part.transform(features_df), [*rest, (k, f"_rest_{k}")]
    whole = assembler.copy().setInputCols([c for k, c in rest if k == 0] + ["spend"] + [c for k, c in rest if k == 1])
    pct = F.explode(F.array(*[F.lit(int(p)) for p in [0] + list(steps)])).alias("pct")
    ex = features_df.select("spend", *[c for _, c in rest], pct).withColumn("spend", F.col("spend") * (1 + F.col("pct") / 100.0))
    sums = (positive_probability(learner.transform(whole.transform(ex)))
            .groupBy("pct").agg(F.sum("p_convert").alias("_s"), F.count(F.lit(1)).alias("sessions")))
    # one row per pct: gathered in one, the base of all is found without a second scoring
    told = sums.agg(F.collect_list(F.struct("pct", "_s", "sessions")).alias("_all"))
    s0 = F.filter("_all", lambda r: r["pct"] == 0)[0]["_s"]
    told = told.select(s0.alias("_s0"), F.inline("_all")).where(F.col("pct") > 0)
    aov = orders.agg(F.avg("gross_revenue")).scalar()
    out = told.withColumn("lift_conversions", F.col("_s") - F.col("_s0"))
    return out.select("pct", "sessions", "lift_conversions", (F.col("lift_conversions") * aov).alias("lift_revenue"))
