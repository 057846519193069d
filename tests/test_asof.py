import bisect
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from roaskit.operators.joins import asof_join
from roaskit.operators.scan import SLOT, in_order
from roaskit.plans.creative import attribute_last_touch

T0 = dt.datetime(2024, 1, 1)


def brute(orders, sessions):
    j = orders.join(sessions.select("user_id", "session_id", "session_start"), "user_id")
    j = j.where(F.col("session_start") <= F.col("order_datetime"))
    w = Window.partitionBy("order_id").orderBy(F.col("session_start").desc(), F.col("session_id"))
    return j.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def rows(df):
    return sorted(tuple(r) for r in df.select("order_id", "session_id").collect())


def test_fixture_cases(spark):
    s = spark.createDataFrame([
        (1, "u1", T0 + dt.timedelta(hours=1)), (2, "u1", T0 + dt.timedelta(hours=3)),
        (3, "u1", T0 + dt.timedelta(hours=3)),            # tie with session 2
        (4, "u2", T0 + dt.timedelta(hours=5)),
        (5, "u3", T0 + dt.timedelta(days=2)),
    ], "session_id long, user_id string, session_start timestamp_ntz")
    o = spark.createDataFrame([
        (10, "u1", T0, 5.0),                                   # before any session -> dropped
        (11, "u1", T0 + dt.timedelta(hours=2), 7.0),           # -> 1
        (12, "u1", T0 + dt.timedelta(hours=3), 9.0),           # same instant, tie -> 2 (smallest id)
        (13, "u2", T0 + dt.timedelta(hours=5), 1.0),           # same instant -> 4
        (14, "u2", T0 + dt.timedelta(days=3), 2.0),            # two orders on one session -> 4
        (15, "u9", T0 + dt.timedelta(hours=5), 3.0),           # user without session -> dropped
        (16, "u3", T0 + dt.timedelta(days=9), 4.0),            # carried across many buckets -> 5
    ], "order_id long, user_id string, order_datetime timestamp_ntz, gross_revenue double")
    got = rows(attribute_last_touch(o, s, partitions=3))
    assert got == [(11, 1), (12, 2), (13, 4), (14, 4), (16, 5)]
    assert got == rows(brute(o, s))


def test_random_against_brute_force_with_hot_user(spark):
    rng = random.Random(7)
    sess, orders = [], []
    for i in range(3000):
        u = "hot" if rng.random() < 0.4 else f"u{rng.randint(0, 40)}"
        sess.append((i, u, T0 + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 20))))
    for i in range(1500):
        u = "hot" if rng.random() < 0.4 else f"u{rng.randint(0, 45)}"
        orders.append((100000 + i, u, T0 + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 20)), 1.0))
    s = spark.createDataFrame(sess, "session_id long, user_id string, session_start timestamp_ntz")
    o = spark.createDataFrame(orders, "order_id long, user_id string, order_datetime timestamp_ntz, gross_revenue double")
    expect = rows(brute(o, s))
    for partitions in (1, 2, 5, 40):
        assert rows(attribute_last_touch(o, s, partitions=partitions)) == expect


def test_a_burst_of_one_user_spreads_over_tasks(spark):
    rng = random.Random(11)
    late = T0 + dt.timedelta(days=364)
    sess = [(0, "bot", T0)] + [(i, "bot", late + dt.timedelta(microseconds=rng.randrange(5_000_000))) for i in range(1, 3000)]
    orders = [(10_000 + i, "bot", late + dt.timedelta(microseconds=rng.randrange(5_000_000)), 1.0) for i in range(2000)]
    s = spark.createDataFrame(sess, "session_id long, user_id string, session_start timestamp_ntz")
    o = spark.createDataFrame(orders, "order_id long, user_id string, order_datetime timestamp_ntz, gross_revenue double")
    out = attribute_last_touch(o, s)
    # the brute force in Python: last session at or before the order, smallest id on a tie
    at = sorted((t, -i) for i, _, t in sess)
    expect = sorted((i, -at[bisect.bisect_right(at, (t, 1)) - 1][1]) for i, _, t, _ in orders)
    assert rows(out) == expect
    ranges = in_order(o.select("user_id", F.col("order_datetime").alias("at")), [F.col("user_id"), F.col("at")], 10)
    assert ranges.groupBy(SLOT).count().agg(F.max("count")).first()[0] < 600  # 2,000 rows in ten ranges


def test_rows_of_one_instant_spread_by_rows(spark):
    """One key and one time stamp: the ranges are still cut by rows, and every left row finds the last right row."""
    s = spark.createDataFrame([(i, "bot", T0) for i in range(500)], "session_id long, user_id string, session_start timestamp_ntz")
    o = spark.createDataFrame([(i, "bot", T0) for i in range(3000)], "order_id long, user_id string, order_datetime timestamp_ntz")
    assert rows(attribute_last_touch(o, s, partitions=8)) == [(i, 0) for i in range(3000)]


def test_asof_plan_reads_and_shuffles_each_side_once(spark, tmp_path):
    for name, ids in (("o", "order_id long, user_id string, order_datetime timestamp_ntz"), ("s", "session_id long, user_id string, session_start timestamp_ntz")):
        spark.createDataFrame([(i, f"u{i % 7}", T0 + dt.timedelta(hours=i)) for i in range(50)], ids).write.parquet(str(tmp_path / name))
    out = attribute_last_touch(spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "s")))
    assert len(rows(out)) == len(rows(brute(spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "s"))))) > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    scanned = [f for f in out.inputFiles() if f.endswith(".parquet") and "roaskit_scan_" not in f]
    assert not scanned  # what is read again are the written ranges
    assert plan.count("Exchange hashpartitioning") <= 1 and "rangepartitioning" not in plan  # the one is over a row per range


def test_left_keeps_unmatched(spark):
    s = spark.createDataFrame([(1, "a", T0)], "session_id long, user_id string, session_start timestamp_ntz")
    o = spark.createDataFrame([(1, "a", T0 - dt.timedelta(seconds=1)), (2, "b", T0)],
                              "order_id long, user_id string, order_datetime timestamp_ntz")
    out = asof_join(o, s, "user_id", "order_datetime", "session_start", ["session_id"], "session_id", how="left")
    assert sorted((r.order_id, r.session_id) for r in out.collect()) == [(1, None), (2, None)]
