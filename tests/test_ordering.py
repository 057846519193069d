import datetime as dt
import math
import random

import pandas as pd
from pyspark.sql import functions as F

from roaskit.operators.ordering import global_rank, running_totals, seeded_sample


def test_global_rank_exact(spark):
    rng = random.Random(1)
    data = [(i, rng.randint(0, 50)) for i in range(5000)]
    df = spark.createDataFrame(data, "id long, t long")
    ranked, n = global_rank(df, ["t", "id"], partitions=7)
    got = {r.id: r["rank"] for r in ranked.collect()}
    order = sorted(data, key=lambda x: (x[1], x[0]))
    assert n == 5000
    assert got == {rid: i + 1 for i, (rid, _) in enumerate(order)}


def test_grouped_running_totals_hot_group(spark):
    rng = random.Random(2)
    data = [(("hot" if rng.random() < 0.5 else f"g{rng.randint(0, 9)}"), i, rng.randint(-3, 9) * 1.0)
            for i in range(4000)]
    df = spark.createDataFrame(data, "g string, id long, v double")
    out, _ = running_totals(df, ["id"], ["v"], prefix="c_", partitions=9, group_cols=["g"])
    got = {r.id: r.c_v for r in out.collect()}
    pdf = pd.DataFrame(data, columns=["g", "id", "v"]).sort_values(["g", "id"])
    pdf["c"] = pdf.groupby("g")["v"].cumsum()
    assert all(abs(got[i] - c) < 1e-9 for i, c in zip(pdf["id"], pdf["c"]))


def test_ungrouped_running_totals_negative_values(spark):
    data = [(i, (-1.0) ** i * i) for i in range(300)]
    out, tot = running_totals(spark.createDataFrame(data, "id long, v double"), ["id"], ["v"], partitions=5)
    got = sorted((r.id, r.cum_v) for r in out.collect())
    acc = 0.0
    for (i, v), (_, c) in zip(data, got):
        acc += v
        assert abs(acc - c) < 1e-9
    assert abs(tot["v"] - acc) < 1e-9


def test_seeded_sample_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in seeded_sample(df, 50, 1, ["k"]).collect())
    b = sorted(r.k for r in seeded_sample(df.repartition(7), 50, 1, ["k"]).collect())
    assert a == b and len(a) == 50
    assert seeded_sample(df, 5000, 1, ["k"]).count() == 1000


def test_other_columns_pass_through_order_unchanged(spark):
    big = 2**53
    data = [(i, None if i % 3 == 0 else big + 1 + 2 * i, dt.datetime(9999, 12, 31, 23, 59, 59), None if i == 4 else float(i))
            for i in range(12)]
    df = spark.createDataFrame(data, "id long, payload long, far timestamp_ntz, v double")
    ranked, n = global_rank(df, ["id"], partitions=3)
    assert n == 12 and sorted((r.id, r.payload, r.far, r.v) for r in ranked.collect()) == data
    out, _ = running_totals(df, ["id"], ["v"], partitions=3, group_cols=["far"])
    got = sorted((r.id, r.payload, r.far, r.v, r.cum_v) for r in out.collect())
    assert [r[:4] for r in got] == data and got[-1][4] == sum(range(12)) - 4
    for frame in (ranked, out):
        plan = frame._jdf.queryExecution().toString()
        assert "InPandas" not in plan and "PythonUDF" not in plan


def test_order_of_an_empty_table_and_null_groups(spark):
    none, n = global_rank(spark.createDataFrame([], "id long"), ["id"], partitions=3)
    assert n == 0 and none.count() == 0
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 3, 5.0), ("a", 4, None)], "g string, id long, v double")
    out, _ = running_totals(df, ["id"], ["v"], partitions=4, group_cols=["g"])
    assert sorted((r.id, r.cum_v) for r in out.collect()) == [(1, 1.0), (2, 3.0), (3, 5.0), (4, 5.0)]


def test_running_totals_keep_odd_numbers_and_names(spark):
    """NaN and infinities add up as doubles do; any column name passes; a group split over ranges is stitched."""
    data = [("g" if i < 90 else "h", i, float("nan") if i == 95 else float("inf") if i == 97 else float(i)) for i in range(100)]
    df = spark.createDataFrame(data, "`a group` string, `id,x` long, `Value (1)` double")
    out, _ = running_totals(df, [F.col("`id,x`")], ["Value (1)"], prefix="c_", partitions=6, group_cols=["a group"])
    assert out.columns == ["a group", "id,x", "Value (1)", "c_Value (1)"]
    got = {r[1]: r[3] for r in out.collect()}
    assert all(got[i] == i * (i + 1) / 2 for i in range(90)) and got[94] == 90 + 91 + 92 + 93 + 94
    assert all(math.isnan(got[i]) for i in range(95, 100))
    total = running_totals(df, [F.col("`id,x`")], ["Value (1)"], partitions=6)[1]["Value (1)"]
    assert math.isnan(total)


def test_running_totals_shuffle_once(spark):
    out, _ = running_totals(spark.range(1000).withColumn("g", F.col("id") % 3), ["id"], ["id"], partitions=4, group_cols=["g"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1  # over one row per range
    assert out.agg(F.max("cum_id")).first()[0] == sum(range(0, 1000, 3))
