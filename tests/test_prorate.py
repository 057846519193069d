"""Spend of a part of a campaign's days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roaskit.plans import creative

D = dt.date


@pytest.mark.parametrize("start, end, lo, hi, share", [
    (D(2024, 1, 1), D(2024, 1, 10), "2024-01-01", "2024-01-10", 1.0),
    (D(2024, 1, 1), D(2024, 1, 10), "2024-01-06", "2024-02-10", 0.5),
    (D(2024, 1, 1), D(2024, 1, 10), "2024-01-03", "2024-01-03", 0.1),
    (D(2024, 1, 1), D(2024, 1, 10), "2023-12-01", "2023-12-31", 0.0),
    (D(2024, 1, 1), D(2024, 1, 10), "2024-01-11", None, 0.0),
    (D(2024, 1, 1), D(2024, 1, 10), None, "2024-01-04", 0.4),
    (D(2024, 1, 1), D(2024, 1, 10), None, None, 1.0),
    (D(2024, 1, 5), D(2024, 1, 5), "2024-01-05", "2024-01-05", 1.0),
    (D(2024, 2, 28), D(2024, 3, 1), "2024-02-29", "2024-02-29", 1 / 3),
    (None, D(2024, 1, 10), "2024-01-01", "2024-01-02", 1.0), (D(2024, 1, 1), None, "2024-01-01", "2024-01-02", 1.0),
    (D(2024, 1, 9), D(2024, 1, 1), "2024-01-01", "2024-01-02", 1.0)])
def test_share_of_days(spark, start, end, lo, hi, share):
    row = spark.createDataFrame([(start, end)], "a date, b date").select(creative.spend_share("a", "b", lo, hi).alias("x")).first()
    assert row.x == pytest.approx(share)


def test_parts_of_a_range_add_up_to_the_whole(spark):
    rows = [(f"s{i}", f"u{i % 5}", dt.datetime(2024, 1, 1 + i % 20, 8), f"c{i % 3}" if i % 7 else None) for i in range(200)]
    sessions = spark.createDataFrame(rows, "session_id string, user_id string, session_start timestamp_ntz, campaign_id string")
    campaigns = spark.createDataFrame(
        [(f"c{k}", D(2024, 1, 1 + k), 100.0 * (k + 1), "video", "t") for k in range(4)],
        "campaign_id string, start_date date, spend double, creative_format string, creative_theme string")
    orders = spark.createDataFrame([("o1", "u1", dt.datetime(2024, 1, 15), 10.0)],
                                   "order_id string, user_id string, order_datetime timestamp_ntz, gross_revenue double")
    runs = creative.campaign_runs(campaigns, sessions)
    ends = {r.campaign_id: r.end_date for r in runs.collect()}
    for c, _, day in ((r[3], r[0], r[2].date()) for r in rows):
        assert c is None or ends[c] >= day
    assert ends["c3"] == D(2024, 1, 4)  # no session: its start
    e = creative.enrich_sessions(sessions, runs, orders).persist()
    spent = {}
    for lo, hi in (("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-20")):
        part = e.where((F.to_date("session_start") >= lo) & (F.to_date("session_start") <= hi))
        for r in creative.campaign_summary(part, prorate=(lo, hi)).collect():
            spent[r.campaign_id] = spent.get(r.campaign_id, 0.0) + r.spend
    e.unpersist()
    assert spent == pytest.approx({"c0": 100.0, "c1": 200.0, "c2": 300.0})
