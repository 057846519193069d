import datetime as dt

from pyspark.sql import functions as F

from roaskit.operators import quality as qa
from roaskit.operators.reshape import duplicate_row_count, rejected_month_cells, unpivot_months
from roaskit.plans.catalog import order_line_contract

ORDERS = [("p-1", "anna", "2024-11-30 08:15", "mug", "3", "7.25", "0"),
          ("p-2", "bert", "2024-11-30 08:20", "mug", "-1", "7.25", "0"),
          ("p-3", None, "2024-11-30 08:25", "jar", "2.0", "4", "0.05"),
          ("p-4", "dora", "2024-11-30 08:30", "jar", "6", "-0.01", "0"),
          ("p-5", "emil", "2024-11-30 08:35", "lid", "2.0", "1.1", "1"),
          ("p-6", "fay", "2024-11-30 08:40", "lid", None, "NaN", "0")]
ORDER_COLS = "order_id string, customer_id string, order_datetime string, sku string, qty string, unit_price string, discount string"


web_session_contract = qa.web_session_contract


def test_order_sample_row_level_quarantine(spark):
    good, bad = qa.validate(spark.createDataFrame(ORDERS, ORDER_COLS), order_line_contract())
    assert sorted(r.order_id for r in good.collect()) == ["p-1", "p-5"]
    reasons = {r.order_id: list(r.errors) for r in bad.collect()}
    assert reasons == {"p-2": ["qty:min"], "p-3": ["customer_id:not_null"], "p-4": ["unit_price:non_negative"],
                       "p-6": ["qty:not_null", "unit_price:type_double", "qty:min", "unit_price:non_negative"]}
    assert good.count() + bad.count() == len(ORDERS)


def test_session_sample_two_reasons_and_hashing(spark):
    rows = [("ida@shop.test", "v1", "2024-02-29 23:59", "newsletter", "email", "leap"),
            (None, "v2", "tomorrow", "search", "paid", "leap"),
            ("jo@shop.test", "v3", "2024-03-01 00:01", "search", "organic", "none")]
    df = spark.createDataFrame(rows, "user_id string, session_id string, session_start string, source string, "
                                     "medium string, campaign string")
    good, bad = qa.validate(df, web_session_contract())
    assert good.count() == 2
    b = bad.first()
    assert b.session_id == "v2"
    assert sorted(b.errors) == ["session_start:type_timestamp_ntz", "user_id:not_null"]
    hashed = {r.session_id: r.user_id for r in good.collect()}
    assert len(hashed["v1"]) == 64 and "@" not in hashed["v1"]
    assert good.where("session_id = 'v1'").first().session_start == dt.datetime(2024, 2, 29, 23, 59)


def test_contract_matching_with_alias(spark):
    c = order_line_contract()
    header = ["order_id", "customer_id", "datetime", "sku", "qty", "unit_price", "discount"]
    assert qa.match_contract(header, [web_session_contract(), c]) == "order_lines"
    assert qa.match_contract(["customer_id", "persona"], [web_session_contract(), c]) is None
    df = spark.createDataFrame([tuple(ORDERS[0])], ", ".join(f"{h} string" for h in header))
    good, _ = qa.validate(df, c)
    assert good.first().order_datetime == dt.datetime(2024, 11, 30, 8, 15)


def test_percent_in_count_column_rejected(spark):
    c = qa.Contract("counts", {"value": "double"}, rules={"value:no_percent": ~F.col("value").isNull()})
    df = spark.createDataFrame([("-99.61%",), ("12",)], "value string")
    _, bad = qa.validate(df, c)
    assert [r.errors[0] for r in bad.collect()] == ["value:type_double"]


def test_check_columns_strict_ordered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, a int, x int")
    assert qa.check_columns(df, ["a", "b"]) == []
    assert "unexpected column x" in qa.check_columns(df, ["a", "b"], strict=True)
    assert "column order differs" in qa.check_columns(df, ["a", "b"], ordered=True)


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, -2.0, "a"), (1, 3.0, None), (2, None, "a")], "k long, v double, s string")
    p = {r.column: r for r in qa.profile(df).collect()}
    assert p["v"].nulls == 1 and p["v"].negatives == 1 and p["v"].min_value == -2.0
    assert p["s"].distinct == 1 and p["k"].distinct == 2
    t = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2030, 1, 1),)], "d date")
    q = qa.profile(t, future_after="2025-06-01 00:00:00", quartiles=True).first()
    assert q.future == 1 and q.min_time == dt.datetime(2024, 1, 1)
    d = duplicate_row_count(df, ["k"]).first()
    assert (d.total_rows, d.distinct_rows, d.duplicate_rows) == (3, 2, 1)


def test_profile_parts_merge_to_the_profile_of_all(spark):
    df = spark.range(20_000).select(F.pmod("id", F.lit(3)).alias("file"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5 - 900).alias("v"),
                                    (F.col("id") % 5000).cast("string").alias("the key"), F.lit(None).cast("double").alias("none"))
    cols = ["v", "the key", "none"]
    parts = qa.profile_parts(df, cols, by=["file"]).persist()
    assert parts.count() == 9
    merged = {r.column: r for r in qa.merge_profiles(parts, quartiles=True).collect()}
    whole = {r.column: r for r in qa.profile(df, cols, exact_distinct=["the key"], quartiles=True).collect()}
    told = df.agg(F.stddev("v").alias("s"), F.avg("v").alias("m"), F.count_distinct("v").alias("d")).first()
    for got in (merged, whole):
        assert abs(got["v"].stddev - told.s) < 1e-6 and abs(got["v"].mean - told.m) < 1e-6
        assert abs(got["v"].distinct - told.d) < 0.05 * told.d and abs(got["v"].quartiles[1] - told.m) < 0.02 * 30_000
        assert got["none"].non_null == 0 and got["none"].distinct == 0 and got["none"].mean is None and got["none"].quartiles is None
    assert whole["the key"].distinct == 5000 and abs(merged["the key"].distinct - 5000) < 250
    assert merged["v"].non_null + merged["v"].nulls == 20_000
    one_file = {(r.file, r.column): r.non_null for r in qa.merge_profiles(parts, by=["file"]).collect()}
    assert sum(one_file[f, "v"] for f in range(3)) == merged["v"].non_null
    plan = qa.profile(df, cols)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_one_hot_keeps_a_level_that_is_called_nan(spark):
    from roaskit.operators.reshape import one_hot
    df = spark.createDataFrame([("nan",), (None,), ("x",)], "c string")
    got = one_hot(df, {"c": ["nan", "x"]})
    assert got.columns == ["c_nan", "c_x", "c_nan_"]
    assert sorted(map(tuple, got.collect())) == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_unpivot_months_drops_total_and_bad_year(spark):
    df = spark.createDataFrame([("Email", "2024", "1,252", None, "9", "1,261"), ("Email", "TOTAL", "1", "2", "3", "6")],
                               "channel string, year string, january string, february string, march string, total string")
    got = sorted((r.channel, r.date, r.value) for r in unpivot_months(df, ["channel", "year"]).collect())
    assert got == [("Email", dt.date(2024, 1, 1), 1252.0), ("Email", dt.date(2024, 3, 1), 9.0)]


def test_unpivot_months_parses_money_and_returns_what_it_rejects(spark):
    df = spark.createDataFrame([("Email", "2024", "($12.00)", "-99.61%", "$1,252"), ("Email", "soon", "7", " ", None)],
                               "channel string, year string, january string, february string, march string")
    got = sorted((r.date, r.value) for r in unpivot_months(df, ["channel", "year"]).collect())
    assert got == [(dt.date(2024, 1, 1), -12.0), (dt.date(2024, 3, 1), 1252.0)]
    bad = sorted((r.year, r.month, r.cell) for r in rejected_month_cells(df, ["channel", "year"]).collect())
    assert bad == [("2024", "february", "-99.61%"), ("soon", "january", "7")]


def test_nulls_and_non_finite_numbers_fail_and_whole_decimals_pass(spark):
    from roaskit.operators.quality import order_line_contract, validate
    base = {"order_id": "o", "customer_id": "c", "order_datetime": "2024-05-06 07:08:09", "sku": "s", "qty": "2.0",
            "unit_price": "3.5", "discount": "0"}
    rows = [base, *[{**base, **change} for change in ({"qty": None}, {"qty": "2.5"}, {"unit_price": None}, {"unit_price": "NaN"},
                                                     {"unit_price": "Infinity"}, {"order_datetime": None}, {"discount": None})]]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in base))
    good, bad = validate(df, order_line_contract())
    assert [r.qty for r in good.collect()] == [2]
    assert bad.count() == 7 and all(r.errors for r in bad.collect())
