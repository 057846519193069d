"""Properties on the driver tables (sf 0.001)."""

from pyspark.sql import functions as F

from roaskit.operators import quality as qa
from roaskit.plans import creative
from roaskit.plans.catalog import order_line_contract
from roaskit.sources import adapters as ad

SF = "/root/testdata/sf0.001"


def test_attribution_properties(spark):
    o, s = ad.orders(spark, SF), ad.sessions(spark, SF)
    a = creative.attribute_last_touch(o, s)
    # never a later session, at most one row per order
    assert a.where(F.col("session_start") > F.col("order_datetime")).count() == 0
    assert a.groupBy("order_id").count().where("count > 1").count() == 0
    # attributed revenue = revenue of the orders that have an earlier session
    has_prior = (o.alias("o").join(s.alias("s"), (F.col("o.user_id") == F.col("s.user_id"))
                                   & (F.col("s.session_start") <= F.col("o.order_datetime")), "left_semi"))
    assert abs(a.agg(F.sum("gross_revenue")).first()[0] - has_prior.agg(F.sum("gross_revenue")).first()[0]) < 1e-6
    # every attributed order points at a session of the same user
    j = a.join(s.select("session_id", F.col("user_id").alias("su")), "session_id")
    assert j.where(F.col("su") != F.col("user_id")).count() == 0 and j.count() == a.count()


def test_rollup_totals_equal_flat_sums(spark):
    e = creative.enrich_sessions(ad.sessions(spark, SF), ad.campaigns(spark, SF), ad.orders(spark, SF))
    flat = creative.creative_summary(e).agg(F.sum("total_revenue"), F.sum("total_spend")).first()
    r = creative.creative_rollup(e)
    total = r.where("level = 2").first()
    assert abs(total.total_revenue - flat[0]) < 1e-6 and abs(total.total_spend - flat[1]) < 1e-6
    themes = r.where("level = 1").agg(F.sum("total_revenue"), F.sum("share_of_parent")).first()
    assert abs(themes[0] - flat[0]) < 1e-6 and abs(themes[1] - 1.0) < 1e-9


def test_good_plus_rejected_is_input(spark):
    lines = ad.order_lines(spark, SF)
    good, bad = qa.validate(lines, order_line_contract(5, 0.08))
    assert good.count() + bad.count() == lines.count()
    assert bad.where(F.size("errors") == 0).count() == 0
