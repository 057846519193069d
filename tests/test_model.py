import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from roaskit.plans import catalog
from roaskit.plans import model as ml
from roaskit.operators.reshape import discover_levels
from roaskit.plans.stats import auc_by, auc_exact, chronological_split, time_series_folds

T0 = dt.datetime(2024, 1, 1)


def sessions(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        src = rng.choice(["click", "view", None])
        tier = rng.choice(["Low", "High"])
        spend = rng.uniform(100, 1000)
        p = 0.8 if (tier == "High" and spend > 500) else 0.05
        rows.append((i, T0 + dt.timedelta(minutes=7 * i), src, tier, spend, int(rng.random() < p)))
    return spark.createDataFrame(rows, "session_id long, session_start timestamp_ntz, utm_source string, "
                                       "effectiveness_tier string, spend double, converted int")


def test_features_train_importance_roundtrip_and_lift(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    feats_df, feats = ml.build_features(sessions(spark), levels, keep=["session_id", "converted"])
    assert feats[:4] == ["spend", "hour_of_day", "day_of_week", "month"]
    assert "utm_source_nan" in feats and feats_df.where("utm_source_nan = 1").count() > 0
    model = ml.gbt_pipeline(feats, maxIter=8, maxDepth=3).fit(feats_df)
    auc = auc_exact(ml.positive_probability(model.transform(feats_df)), "p_convert", "converted").first().auc
    assert auc > 0.8
    top = [r.feature for r in ml.feature_importance(model, feats, 3).collect()]
    assert "spend" in top or "effectiveness_tier_High" in top
    path = os.path.join(tempfile.mkdtemp(prefix="roaskit-model-"), "m")
    ml.save_model(model, path)
    loaded, loaded_feats = ml.load_model(path)
    assert loaded_feats == feats
    a = loaded.transform(feats_df).select("session_id", "prediction").orderBy("session_id").collect()
    b = model.transform(feats_df).select("session_id", "prediction").orderBy("session_id").collect()
    assert a == b
    orders = spark.createDataFrame([(1, 10.0), (2, 30.0)], "order_id long, gross_revenue double")
    lift = {r.pct: r for r in ml.lift_forecast(model, feats_df, orders).collect()}
    assert sorted(lift) == [10, 25, 50, 75, 100]
    assert all(abs(r.lift_revenue - 20.0 * r.lift_conversions) < 1e-9 for r in lift.values())
    assert all(r.sessions == 600 for r in lift.values())


def test_search_runs_its_trials_and_feeds_the_best(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 1500), levels, keep=["session_id", "session_start", "converted"])
    assert ml.SPACE["maxIter"] == (100, 1000) and (ml.TRIALS, ml.CV_TRIALS) == (25, 50)
    split = chronological_split(df, ["session_start", "session_id"]).persist()
    small = {"maxIter": (4, 8), "maxDepth": (3, 4), "stepSize": (0.2, 0.3)}
    found = ml.search_params(split.where("split = 'train'"), split.where("split = 'tune'"), feats, trials=3, space=small)
    assert [r.trial for r in found.orderBy("trial").collect()] == [0, 1, 2]
    best = ml.best_params(found)
    model = ml.gbt_pipeline(feats, **best).fit(split.where("split <> 'test'"))
    assert ml.model_auc(model, split.where("split = 'test'")) > 0.85
    folds = time_series_folds(df, ["session_start", "session_id"], 2)
    cv = ml.search_params_cv(folds, feats, trials=2, space=small).collect()
    assert len(cv) == 2 and all(r.folds == 2 and r.mean_auc > 0.7 for r in cv)


def test_the_first_trees_of_a_fit_are_the_fit_of_fewer_trees(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark), levels, keep=["session_id", "converted"])
    df = df.repartition(3).persist()
    params = {"maxDepth": 3, "stepSize": 0.2, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.7"}
    staged = ml.staged_aucs(ml.gbt_pipeline(feats, seed=5, maxIter=7, **params).fit(df), df, [1, 4, 7, 9])
    assert sorted(staged) == [1, 4, 7]
    for k, auc in staged.items():
        whole = ml.model_auc(ml.gbt_pipeline(feats, seed=5, maxIter=k, **params).fit(df), df)
        assert abs(auc - whole) < 1e-9


def test_budgets_of_successive_halving():
    assert ml.halving_budgets(25, 900) == [100, 300, 900]
    assert ml.halving_budgets(1, 50) == [50] and ml.halving_budgets(50, 10, 3) == [1, 2, 4, 10]


def test_halving_keeps_the_best_and_reports_every_trial(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 900), levels, keep=["session_id", "session_start", "converted"])
    folds = time_series_folds(df, ["session_start", "session_id"], 2).persist()
    small = {"maxIter": (6, 9), "maxDepth": (2, 4)}
    rows = sorted(ml.search_params_halving(ml.fold_parts(folds), feats, trials=4, space=small).collect())
    rng = random.Random(42)
    drawn = [ml.sample_params(rng, small) for _ in range(4)]
    assert [(r.trial, r.drawn_iter, r.max_depth) for r in rows] == [(t, p["maxIter"], p["maxDepth"]) for t, p in enumerate(drawn)]
    assert sorted(r.rounds for r in rows) == [1, 1, 2, 2]
    assert all(r.fitted_iter == (r.drawn_iter if r.rounds == 2 else 3) and 0 < r.max_iter <= r.fitted_iter for r in rows)
    best = max(rows, key=lambda r: r.auc)
    assert best.rounds == 2 and best.auc > 0.8


def test_a_search_without_both_labels_has_no_score(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 200), levels, keep=["session_id", "converted"])
    rows = ml.search_params_halving([(df, df.where("converted = 0"))], feats, trials=2, space={"maxIter": (2, 3), "maxDepth": (2, 2)})
    assert [r.auc for r in rows.collect()] == [None, None]


def test_levels_are_found_in_one_pass_without_nulls(spark):
    assert discover_levels(sessions(spark), ["utm_source", "effectiveness_tier"]) == {
        "utm_source": ["click", "view"], "effectiveness_tier": ["High", "Low"]}


def _tasks_of_jobs(spark, run):
    """The task counts of all stages that ``run`` starts, of most trees' levels the most frequent one."""
    sc, group = spark.sparkContext, f"tasks-{random.random()}"
    sc.setJobGroup(group, group)
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [i.numTasks for i in map(tracker.getStageInfo, stages) if i is not None]


def test_a_fit_has_as_many_tasks_as_its_rows_need(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 900), levels, keep=["session_id", "session_start", "converted"])
    models, small = [], {"maxIter": (2, 3), "maxDepth": (2, 2)}
    for shuffles in ("32", "3"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            split = chronological_split(df, ["session_start", "session_id"])
            train, tune = split.where("split = 'train'"), split.where("split = 'tune'")
            told = _tasks_of_jobs(spark, lambda: models.append(ml.search_params(train, tune, feats, trials=2, space=small).collect()))
            assert sum(n >= 32 for n in told) <= len(told) // 4
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert models[0] == models[1]  # the rows alone make the model


def test_dealt_rows_are_all_there_and_balanced(spark, monkeypatch):
    monkeypatch.setattr(ml, "TASK_ROWS", 100)
    df = sessions(spark, 950)
    ranked = chronological_split(df, ["session_start", "session_id"])
    part = ml.dealt(ranked.where("row_rank <= 400"))
    assert ml.fit_tasks(df) == 10 and ml.fit_tasks(df.where("false")) == 1
    sizes = [len(rows) for rows in part.rdd.glom().collect()]
    assert len(sizes) == 4 and sum(sizes) == 400 and max(sizes) < 150
    assert sorted(r.session_id for r in ml.dealt(df.union(df)).collect()) == sorted(2 * list(range(950)))


def test_auc_by_group_is_the_auc_of_each_group(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([0.1, 0.2, 0.4, 0.7, None]), rng.choice([0, 1, None]) if g < 3 else 1) for g in range(4) for _ in range(60)]
    df = spark.createDataFrame(rows, "g int, score double, label int").persist()
    found = {r.g: (r.auc, r.positives, r.negatives) for r in auc_by(df, "score", "label", "g").collect()}
    assert sorted(found) == [0, 1, 2, 3] and found[3][0] is None
    for g, told in found.items():
        assert told == tuple(auc_exact(df.where(f"g = {g}"), "score", "label").first())


def test_a_search_makes_one_pass_for_the_aucs_of_all_fits(spark, monkeypatch):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 900), levels, keep=["session_id", "session_start", "converted"])
    folds = time_series_folds(df, ["session_start", "session_id"], 2).persist()
    one_label = folds.withColumn("converted", F.when((F.col("fold") == 1) & (F.col("role") == "test"), 0).otherwise(F.col("converted")))
    small, rng = {"maxIter": (2, 4), "maxDepth": (2, 3)}, random.Random(42)
    drawn = [ml.sample_params(rng, small) for _ in range(3)]
    (train, test), _ = ml.fold_parts(folds)
    alone = [ml.model_auc(ml.gbt_pipeline(feats, seed=42, **p).fit(ml.dealt(train)), test) for p in drawn]
    passes = []
    for name in ("auc_by", "auc_exact"):
        monkeypatch.setattr(ml, name, lambda *a, _made=getattr(ml, name), **k: passes.append(a) or _made(*a, **k))
    found = ml.search_params(train, test, feats, trials=3, space=small).orderBy("trial").collect()
    assert len(passes) == 1 and all(abs(r.auc - a) < 1e-12 for r, a in zip(found, alone))
    cv = ml.search_params_cv(one_label, feats, trials=3, space=small).orderBy("trial").collect()
    assert len(passes) == 2 and all(r.folds == 2 and abs(r.mean_auc - a) < 1e-12 for r, a in zip(cv, alone))
    none = ml.search_params(train, test.where("false"), feats, trials=2, space=small).collect()
    assert [r.auc for r in none] == [None, None]


def test_model_frames_are_cut_by_rows_and_whole(spark):
    folder = tempfile.mkdtemp(prefix="roaskit-tables-")
    kinds = ["click", "view", "signup", "purchase"]
    events = [(i, T0 + dt.timedelta(minutes=i), i % 37, kinds[i % 4], 1.5 * i, f'{{"k": {i % 11}}}') for i in range(400)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{folder}/events.parquet")
    parts = [(k, f"p{k}", f"b{k % 3}", f"t{k % 2}", 5 * k, 900.0 + k) for k in range(9)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{folder}/part.parquet")
    whole = {r.session_id: r for r in catalog._enriched(spark, folder).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        split, feats = catalog._model_frames(spark, folder)
        assert split.rdd.getNumPartitions() == 1
        rows = split.orderBy("row_rank").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.session_id for r in rows] == sorted(whole) and [r.row_rank for r in rows] == list(range(1, 301))
    assert [r.split for r in rows] == ["train"] * 210 + ["tune"] * 45 + ["test"] * 45
    assert all((r.converted, r.spend) == (whole[r.session_id].converted, whole[r.session_id].spend or 0.0) for r in rows)
    assert {"creative_theme_b2", "creative_format_t1", "utm_source_nan"} < set(feats)
    assert ml.frame_tasks(spark, 0) == 1 and ml.frame_tasks(spark, 10 ** 9) == int(old)


def test_lift_assembles_a_session_once_and_scores_in_one_pass(spark):
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark), levels, keep=["session_id", "converted"])
    whole, df = df.persist(), df.withColumn("spend", F.when(F.col("session_id") % 50 > 0, F.col("spend")))  # some without spend
    orders = spark.createDataFrame([(1, 10.0), (2, 30.0)], "order_id long, gross_revenue double")
    for inputs in (feats, feats[1:3] + feats[:1] + feats[3:], feats[1:] + feats[:1], feats[:1]):
        model = ml.gbt_pipeline(inputs, maxIter=5, maxDepth=3).fit(whole)
        told = ml.lift_forecast(model, df, orders, steps=[40, 100, -20])
        found = {r.pct: (r.sessions, r.lift_conversions, r.lift_revenue) for r in told.collect()}
        p = {k: ml.positive_probability(model.transform(df.withColumn("spend", F.col("spend") * (1 + F.lit(k) / 100.0)))).agg(
            F.sum("p_convert")).first()[0] for k in (0, 40, 100)}
        assert sorted(found) == [40, 100]
        for k, (n, lift, revenue) in found.items():
            assert n == 600 and abs(lift - (p[k] - p[0])) < 1e-9 and abs(revenue - 20 * lift) < 1e-9
        # the vector of what the spend does not change lies below the rows of every pct
        plan = told._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 1 and (len(inputs) == 1 or "_rest_" in plan.split("Generate explode")[1])
    assert ml.lift_forecast(model, df.where("false"), orders).collect() == []


def test_rows_are_put_in_order_before_features_widen_them(spark, monkeypatch):
    ranked = []
    real = catalog.st.chronological_split
    monkeypatch.setattr(catalog.st, "chronological_split", lambda df, *a, **k: ranked.append(df.columns) or real(df, *a, **k))
    e = sessions(spark, 200).withColumns({c: F.lit(None).cast("string") for c in ("utm_medium", "creative_format", "creative_theme")})
    monkeypatch.setattr(catalog, "_enriched_once", lambda spark, sf: (e, 2))
    split, feats = catalog._model_frames(spark, "unread")
    assert ranked == [e.columns] and {"row_rank", "split", *feats} < set(split.columns) and split.count() == 200
    model_rows = ml._vectors(split, ml.gbt_pipeline(feats).getStages()[0], "converted")
    assert model_rows.columns == ["converted", "features"] and model_rows.count() == 200
    # the same rows in the same order as when the columns are dealt
    wide = ml.gbt_pipeline(feats).getStages()[0].transform(ml.dealt(split)).select("converted", "features")
    assert model_rows.collect() == wide.collect()


def test_fits_of_few_tasks_fill_the_cores_and_the_longest_start_first(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert ml.fits_at_once(spark, 1) == ml.TASKS_PER_CORE * cores and ml.fits_at_once(spark, 1000) == ml.PARALLELISM
    levels = {"utm_source": ["click", "view"], "effectiveness_tier": ["Low", "High"]}
    df, feats = ml.build_features(sessions(spark, 300), levels, keep=["session_id", "converted"])
    started, real = [], ml._side_by_side
    monkeypatch.setattr(ml, "_side_by_side", lambda spark, task, items, n: started.append((items, n)) or real(spark, task, items, n))
    small = {"maxIter": (2, 6), "maxDepth": (2, 3)}
    found = sorted(ml.search_params(df, df, feats, trials=4, space=small).collect())
    assert found == sorted(ml.search_params(df, df, feats, trials=4, space=small, parallelism=1).collect())
    (items, n), (_, one) = started
    assert n == ml.TASKS_PER_CORE * cores and one == 1 and [r.trial for r in found] == [0, 1, 2, 3]
    lengths = [p["maxIter"] * p["maxDepth"] for _, p, _ in items]
    assert lengths == sorted(lengths, reverse=True) and sorted(at for at, _, _ in items) == [0, 1, 2, 3]
