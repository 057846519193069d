import datetime as dt

from pyspark.sql import functions as F

from roaskit.functions import scalars as fx


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_clean_currency(spark):
    assert one(spark, fx.clean_currency, "$1,047,386.58 ") == 1047386.58
    assert one(spark, fx.clean_currency, "($107,428.31)") == -107428.31
    assert one(spark, fx.clean_currency, "abc") is None
    assert one(spark, fx.clean_currency, None) is None


def test_clean_percentage_and_numeric(spark):
    assert abs(one(spark, fx.clean_percentage, '"3%"') - 0.03) < 1e-12
    assert one(spark, fx.clean_numeric, "1,252") == 1252.0
    assert one(spark, fx.clean_numeric, "n/a") is None


def test_clean_mixed(spark):
    assert one(spark, fx.clean_mixed, "#REF!") is None
    assert one(spark, fx.clean_mixed, "nan") is None
    assert one(spark, fx.clean_mixed, " ") is None
    assert one(spark, fx.clean_mixed, " 1,234") == 1234.0
    assert abs(one(spark, fx.clean_mixed, "12.5%") - 0.125) < 1e-12
    assert one(spark, fx.clean_mixed, "($12.00)") == -12.0


def test_canonical_channel(spark):
    for raw, key in [("Affiliate Media", "affiliates"), ("Affiliate Agency", "affiliates"), ("affiliates", "affiliates"),
                     (" Paid Search Media ", "paid search"), ("Paid Social Agency", "paid social"), ("Email", "email")]:
        assert one(spark, fx.canonical_channel, raw) == key
    assert one(spark, fx.spend_kind, "Paid Search Agency") == "agency"
    assert one(spark, fx.spend_kind, None) == "media"


def test_metric_channel(spark):
    assert one(spark, fx.metric_channel, "NET SALES - Paid Search") == "paid search"
    assert one(spark, fx.metric_channel, "GROSS SALES") is None
    assert one(spark, fx.metric_channel, "NET SALES - " + "x" * 12_000) == "x" * 12_000


def test_lenient_date_month_names(spark):
    assert one(spark, fx.lenient_date, "2024-May-01") == dt.date(2024, 5, 1)
    assert one(spark, fx.lenient_date, "2024-June-01") == dt.date(2024, 6, 1)
    assert one(spark, fx.lenient_date, "1/5/2025") == dt.date(2025, 1, 5)
    assert one(spark, fx.lenient_date, "2025-02-30") is None
    assert one(spark, fx.lenient_date, "garbage") is None


def test_year_token(spark):
    assert one(spark, fx.year_token, "2025 (Jan - May)") == 2025
    assert one(spark, fx.year_token, "2s025 (Jan - May)") is None
    assert one(spark, fx.year_token, "2024") == 2024


def test_weekday_and_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 3, 4))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(fx.weekday_mon0("a").alias("w"), fx.whole_days_between("b", "a").alias("d"),
                  fx.whole_days_between("a", "b").alias("neg")).first()
    assert (r.w, r.d, r.neg) == (0, 1, -2)


def test_safe_ratio_and_hash(spark):
    df = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df.select(fx.safe_ratio("n", "d")).collect()] == [2.5, 0.0, 0.0]
    h = one(spark, fx.sha256_id, "abc")
    assert h == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert one(spark, fx.sha256_id, None) is None


from hypothesis import given, settings
from hypothesis import strategies as st


def accounting(cents: int) -> str:
    amount = f"{abs(cents) // 100:,}.{abs(cents) % 100:02d}"
    return f"(${amount})" if cents < 0 else f"${amount} "


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-10 ** 11, max_value=10 ** 11), min_size=1, max_size=50))
def test_currency_roundtrip(spark, cents):
    df = spark.createDataFrame([(c, accounting(c)) for c in cents], "cents long, txt string")
    got = df.select("cents", fx.clean_currency("txt").alias("v")).collect()
    assert all(abs(r.v * 100 - r.cents) < 1e-3 for r in got)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Paid Search", "paid social", "Affiliate", "affiliates", "Email", "SMS"]),
                          st.sampled_from(["", " Media", " Agency", " media ", " AGENCY"]),
                          st.sampled_from(["", "  "])), min_size=1, max_size=30))
def test_canonical_channel_idempotent(spark, parts):
    names = [pad + base + suffix + pad for base, suffix, pad in parts]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    once = df.select(fx.canonical_channel("c").alias("k"))
    twice = once.select("k", fx.canonical_channel("k").alias("k2")).collect()
    assert all(r.k == r.k2 for r in twice)
    assert not any(r.k.endswith((" media", " agency")) or r.k == "affiliate" for r in twice)


def test_exact_sum_keeps_tiny_and_huge_values(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(fx.exact_sum("v")).first()[0]
    assert abs(total([1e-7] * 10) - 1e-6) < 1e-18
    assert total([0.1] * 10 + [None]) == 1.0
    assert total([1e40, 1.0]) == 1e40
    assert total([None, None]) is None
