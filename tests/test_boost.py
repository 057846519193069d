"""The trees that a task grows: Spark ML's own on a frame of one task, and the same law on a larger one."""

import datetime as dt
import inspect
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roaskit.plans import boost, catalog
from roaskit.plans import model as ml

T0 = dt.datetime(2024, 1, 1)
LEVELS = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}


def frame(spark, n=700, seed=5, spends=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tier, spend = rng.choice(["Low", "High"]), rng.choice(spends) if spends else rng.uniform(100, 1000)
        rows.append((i, T0 + dt.timedelta(minutes=97 * i), rng.choice(["click", "view", None]), tier, float(spend),
                     int(rng.random() < (0.7 if tier == "High" and spend > 500 else 0.1))))
    df = spark.createDataFrame(rows, "session_id long, session_start timestamp_ntz, utm_source string, effectiveness_tier string, "
                                     "spend double, converted int")
    return ml.build_features(df, LEVELS, keep=["session_id", "converted"])


def by_spark(pipeline, df):
    assembler, learner = pipeline.getStages()
    return PipelineModel([assembler, learner.fit(ml._vectors(df, assembler, "converted"))])


def chances(model, df):
    return {r[0]: r[1] for r in model.transform(df).select("session_id", vector_to_array("probability")[1]).collect()}


def jobs_of(spark, run):
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def grown(pipeline, df):
    assembler, learner = pipeline.getStages()
    told, splits, in_order = ml._units(df, assembler, learner)
    made = told.coalesce(1).mapInArrow(boost.nodes(splits, boost.params_of(learner), in_order), boost.NODE).collect()
    return PipelineModel([assembler, boost.spark_model(df.sparkSession, made, splits, learner)])


def test_trees_of_a_frame_of_one_task_are_sparks_in_a_few_jobs(spark):
    df, feats = frame(spark)
    df = df.persist()
    for params in ({"subsamplingRate": 0.7886, "featureSubsetStrategy": "0.6"}, {}):
        pipeline = ml.gbt_pipeline(feats, maxIter=12, maxDepth=5, stepSize=0.2, **params)
        model, jobs = jobs_of(spark, lambda: grown(pipeline, df))
        assert jobs < 30  # Spark ML takes a job for every level of every tree, 60 and more
        old = by_spark(pipeline, df)
        one, two = chances(model, df), chances(old, df)
        assert len(one) == 700 and all(abs(p - two[k]) < 1e-9 for k, p in one.items())
        shape = lambda m: [line for line in m.stages[1].toDebugString.splitlines()[1:] if "Predict" not in line]
        assert shape(model) == shape(old)
        assert np.allclose(model.stages[1].featureImportances.toArray(), old.stages[1].featureImportances.toArray(), atol=1e-12)
        assert (model.stages[1].getMaxIter(), model.stages[1].getNumTrees, model.stages[1].getLabelCol()) == (12, 12, "converted")


def test_a_large_frame_is_fitted_from_its_units(spark, monkeypatch):
    df, feats = frame(spark, 900, spends=[150, 400, 620, 900])
    df = df.persist()
    pipeline = ml.gbt_pipeline(feats, maxIter=8, maxDepth=3, stepSize=0.2)
    old = chances(by_spark(pipeline, df), df)
    monkeypatch.setattr(ml, "TASK_ROWS", 300)
    assembler, learner = pipeline.getStages()
    told, splits, in_order = ml._units(df, assembler, learner)
    assert not in_order and told.count() < 900 and told.agg(F.sum("pos"), F.sum("neg")).first() == df.agg(
        F.sum("converted"), F.sum(1 - F.col("converted"))).first()
    new = chances(ml.fit_dealt(pipeline, df), df)  # without draws the trees are those of the rows
    assert sum(abs(p - old[k]) < 1e-9 for k, p in new.items()) > 890
    drawn = ml.gbt_pipeline(feats, maxIter=20, maxDepth=3, stepSize=0.1, subsamplingRate=0.7, featureSubsetStrategy="0.8")
    assert abs(ml.model_auc(ml.fit_dealt(drawn, df), df) - ml.model_auc(by_spark(drawn, df), df)) < 0.02
    model, jobs = jobs_of(spark, lambda: ml.fit_dealt(drawn, df))
    assert jobs < 40  # Spark ML takes a job for every level of every tree, 60 and more
    again = [chances(m, df) for m in (model, ml.fit_dealt(drawn, df.repartition(7)))]
    assert again[0] == again[1]  # the rows alone make the model


def test_more_units_than_a_task_takes_are_left_to_spark(spark, monkeypatch):
    df, feats = frame(spark, 400)
    df = df.persist()
    monkeypatch.setattr(ml, "TASK_ROWS", 150)
    monkeypatch.setattr(boost, "MOST_UNITS", 20)
    pipeline = ml.gbt_pipeline(feats, maxIter=3, maxDepth=2)
    assert chances(ml.fit_dealt(pipeline, df), df) == chances(by_spark(pipeline, df), df)
    small = {"maxIter": (4, 6), "maxDepth": (2, 3)}
    assert all(r.auc > 0.6 for r in ml.search_params(df, df, feats, trials=2, space=small).collect())
    assert all(r.auc > 0.6 for r in ml.search_params_halving([(df, df)], feats, trials=2, space=small).collect())


def test_what_spark_alone_knows_is_left_to_spark(spark):
    learner = lambda **params: ml.gbt_pipeline(["spend"], **params).getStages()[1]
    assert boost.params_of(learner(maxIter=3))["maxIter"] == 3
    assert boost.params_of(learner(minInfoGain=0.1)) is None and boost.params_of(learner(featureSubsetStrategy="sqrt")) is None
    assert boost.params_of(ml.logistic_pipeline(["spend"]).getStages()[1]) is None


def test_a_row_to_fit_without_a_feature_is_refused(spark, monkeypatch):
    df, feats = frame(spark, 300)
    df = df.withColumn("month", F.when(F.col("session_id") != 17, F.col("month")))
    for rows in (100_000, 100):
        monkeypatch.setattr(ml, "TASK_ROWS", rows)
        with pytest.raises(Exception):
            ml.fit_dealt(ml.gbt_pipeline(feats, maxIter=2), df)


def test_draws_of_a_unit_follow_the_binomial_law():
    counts, rng = np.array([0, 1, 7, 300, 2048, 2049, 10 ** 6]), np.random.default_rng(1)
    drawn = boost.Binomials(np.repeat(counts, 4000), 0.7).draw(rng).reshape(-1, 4000)
    assert (drawn >= 0).all() and (drawn <= counts[:, None]).all()
    mean, spread = counts * 0.7, np.sqrt(counts * 0.7 * 0.3)
    assert (np.abs(drawn.mean(axis=1) - mean) <= 5 * spread / np.sqrt(4000)).all()
    assert (np.abs(drawn.std(axis=1) - spread) <= 0.1 * spread).all()


def test_the_auc_of_counts_is_that_of_the_rows():
    pos, neg = np.array([1, 0, 3]), np.array([2, 2, 1])
    rows = [(k, y) for k in range(3) for y in [1] * int(pos[k]) + [0] * int(neg[k])]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z]
    assert abs(boost.auc_of(pos, neg) - sum(pairs) / len(pairs)) < 1e-12 and boost.auc_of(pos, pos * 0) is None


@pytest.mark.parametrize("name, search, trials", [
    ("param_search", "search_params", 25),
    ("param_search_cv", "search_params_cv", 50),
    ("param_search_halving", "search_params_halving", 25),
])
def test_a_registered_search_runs_all_trials_over_the_published_ranges(spark, monkeypatch, name, search, trials):
    rows = [(i, T0 + dt.timedelta(minutes=i), 1.0 * i, i % 2) for i in range(60)]
    e = spark.createDataFrame(rows, "session_id long, session_start timestamp_ntz, spend double, converted int")
    e = e.withColumns({c: F.lit(None).cast("string") for c in ml.CATEGORICALS})
    monkeypatch.setattr(catalog, "_enriched_once", lambda spark, sf: (e, 2))
    monkeypatch.setattr(ml, "fitted_auc", lambda *a, **k: 0.5)
    called, real = [], inspect.signature(getattr(ml, search))

    def searched(*a, **k):
        called.append(real.bind(*a, **k))
        called[0].apply_defaults()
        return spark.createDataFrame([(*ml._trial_row(0, ml.sample_params(random.Random(1))), 0.5)], f"{ml.TRIAL}, auc double")

    monkeypatch.setattr(ml, search, searched)
    assert catalog.QUERIES[name](spark, "unread").count() == 1
    assert called[0].arguments["trials"] == trials and called[0].arguments["space"] is None
    assert ml.SPACE["maxIter"] == (100, 1000) and ml.SPACE["maxDepth"] == (3, 10)
