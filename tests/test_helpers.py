import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from roaskit.operators import filters as flt
from roaskit.operators import quality as qa
from roaskit.operators.reshape import pivot_wide, tag_union
from roaskit.plans.stats import exact_quantiles
from roaskit.sources.files import read_table


def test_read_table_declared_schema_keeps_text_ids(spark):
    d = tempfile.mkdtemp(prefix="roaskit-h-")
    p = os.path.join(d, "orders.csv")
    with open(p, "w") as f:
        f.write("order_id,gross_revenue\n007,12.5\n008,x\n")
    df = read_table(spark, p, "order_id string, gross_revenue string")
    assert [r.order_id for r in df.collect()] == ["007", "008"]


def test_assert_valid_raises_with_counts(spark):
    c = qa.Contract("t", {"v": "double"}, rules={"v:positive": F.col("v") > 0})
    ok = qa.with_errors(spark.createDataFrame([("1",)], "v string"), c)
    qa.assert_valid(ok)
    bad = qa.with_errors(spark.createDataFrame([("1",), ("-2",), ("-3",)], "v string"), c)
    with pytest.raises(ValueError, match="v:positive=2"):
        qa.assert_valid(bad)


def test_matches_null_is_false(spark):
    df = spark.createDataFrame([("Paid Search Agency",), (None,), ("Email",)], "c string")
    got = [r[0] for r in df.select(flt.matches("c", "agency")).collect()]
    assert got == [True, False, False]
    assert [r[0] for r in df.select(flt.matches("c", "agency", negate=True)).collect()] == [False, True, True]


def test_tag_union_and_pivot_roundtrip(spark):
    a = spark.createDataFrame([("2024-01-01", 3.0)], "date string, value double")
    b = spark.createDataFrame([("2024-01-01", 5.0), ("2024-02-01", 1.0)], "date string, value double")
    u = tag_union({"New": a, "Existing": b}, "customer_type")
    w = {r.date: (r.New, r.Existing) for r in pivot_wide(u, ["date"], "customer_type", ["New", "Existing"], "value").collect()}
    assert w == {"2024-01-01": (3.0, 5.0), "2024-02-01": (0.0, 1.0)}
    long = w and u.groupBy("customer_type").agg(F.sum("value")).collect()
    assert sorted((r[0], r[1]) for r in long) == [("Existing", 6.0), ("New", 3.0)]


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(5)
    vals = [rng.choice([1.0, 2.0, 2.0, 7.5]) * rng.random() for _ in range(999)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    probs = [0.0, 0.025, 0.5, 0.9, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, "v", probs, tie_cols=["id"]).collect()}
    for p in probs:
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-12


def test_min_max_scale_and_period_end(spark):
    import datetime as dt
    from roaskit.operators.reshape import min_max_scale
    from roaskit.plans.channels import cap_period, complete_period_end
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "v double")
    assert [r.v_scaled for r in min_max_scale(df, "v").orderBy("v").collect()] == [0.0, 0.5, 1.0]
    a = spark.createDataFrame([(dt.date(2025, 4, 1), 3.0), (dt.date(2025, 5, 1), 2.0), (dt.date(2025, 6, 1), 0.0)],
                              "date date, value double")
    b = spark.createDataFrame([(dt.date(2025, 4, 1), 1.0), (dt.date(2025, 5, 1), 0.0)], "date date, value double")
    end = complete_period_end((a, "date", "value"), (b, "date", "value"))
    assert spark.range(1).select(end).first()[0] == dt.date(2025, 5, 1)
    assert [r.date for r in cap_period(a, "date", end).collect()] == [dt.date(2025, 4, 1)]


def test_approx_split_close_to_exact(spark):
    from roaskit.plans.stats import approx_chronological_split
    df = spark.range(10000).withColumn("ts", F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz"))
    sizes = {r.split: r["count"] for r in approx_chronological_split(df, "ts").groupBy("split").count().collect()}
    assert abs(sizes["train"] - 7000) <= 20 and abs(sizes["tune"] - 1500) <= 20
