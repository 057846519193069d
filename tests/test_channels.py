import datetime as dt

from roaskit.plans import channels as ch
from roaskit.plans import modules as mod

# Published per-channel totals and the corrected ROAS computed from them.
TOTALS = [("organic search", 59978.0, 2794810.73), ("email", 96624.0, 3743370.64), ("sms", 25270.0, 641236.85),
          ("paid search", 780570.23, 4616495.91), ("shopping", 289068.26, 882064.96),
          ("affiliates", 243691.41, 630776.05), ("paid social", 2455543.29, 1974848.56), ("direct", 0.0, 3264081.45)]
AGENCY = [("Paid Search Agency", 110400.0), ("Affiliate Agency", 110938.0), ("Paid Social Agency", 257589.0)]
GOLDEN = {"organic search": 46.5973, "email": 38.7416, "sms": 25.3754, "paid search": 5.1814, "shopping": 3.0514,
          "affiliates": 1.7787, "paid social": 0.7279, "direct": 0.0}
D = dt.date(2024, 1, 1)


def test_corrected_roas_goldens(spark):
    bd = spark.createDataFrame(TOTALS, "marketing_channel string, ad_spend double, `gross_discount_(shopify)` double")
    ms = spark.createDataFrame([(n, v, D) for n, v in AGENCY], "channel_name string, value double, date date")
    got = {r.marketing_channel: round(r.corrected_roas, 4) for r in ch.channel_roas(bd, ms).collect()}
    assert got == GOLDEN


def test_monthly_spend_conditional_aggregation(spark):
    ms = spark.createDataFrame([("Paid Search Media", 100.0, D), ("Paid Search Agency", 10.0, D),
                                ("Affiliate Media", 50.0, D), ("Affiliate Agency", 5.0, D),
                                ("Email Agency", 7.0, D)], "channel_name string, value double, date date")
    got = {r.mapping_key: (r.value_media, r.value_agency, r.total_spend) for r in ch.monthly_spend(ms).collect()}
    assert got == {"paid search": (100.0, 10.0, 110.0), "affiliates": (50.0, 5.0, 55.0)}


def test_spend_overrides_only_where_zero(spark):
    spend = spark.createDataFrame([(D, "paid search", 0.0), (D, "paid social", 5.0), (D, "affiliates", 0.0)],
                                  "date date, mapping_key string, total_spend double")
    ov = spark.createDataFrame([(D, "Paid Search Agency", 40), (D, "Paid Social Agency", 99)],
                               "month date, channel string, spend_override long")
    got = {r.mapping_key: r.total_spend for r in ch.apply_spend_overrides(spend, ov).collect()}
    assert got == {"paid search": 40.0, "paid social": 5.0, "affiliates": 0.0}


def test_overall_cac_caps_every_input(spark):
    m = spark.createDataFrame([("Paid Search Media", 100.0, dt.date(2025, 4, 1)), ("Paid Search Media", 900.0, dt.date(2025, 5, 1))],
                              "channel_name string, value double, date date")
    c = spark.createDataFrame([("Paid Search", 10.0, dt.date(2025, 4, 1))], "channel_name string, value double, date date")
    assert ch.overall_cac(m, c, "2025-05-01").first().cac == 10.0
    assert ch.overall_cac(m, c, "2025-06-01").first().cac == 100.0


def test_wholesale_edges(spark):
    w = spark.createDataFrame([("R", "S1", 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0), ("R", "S2", 100, 40, 90, 10, 1000.0, 100.0, 50.0, 50.0)],
                              "retailer string, sku string, units_ordered int, units_sold int, units_shipped int, on_hand int, "
                              "wholesale_dollars double, discounts double, returns_dollars double, markdowns_dollars double")
    r = {x.sku: x for x in mod.wholesale_kpis(w).collect()}
    assert (r["S1"].sell_through_pct, r["S1"].weeks_of_supply, r["S1"].fill_rate_pct, r["S1"].net_margin_pct) == (0, 0, 0, 0)
    assert (r["S2"].sell_through_pct, r["S2"].weeks_of_supply, r["S2"].fill_rate_pct, r["S2"].net_margin_pct) == (0.8, 1.0, 0.9, 0.8)


def test_email_exclude_totals_and_flow_roas(spark):
    e = spark.createDataFrame([(D, "Triggered", 10), (D, "Total", 10)], "date date, email_type string, sends long")
    assert [r.email_type for r in mod.exclude_subtotals(e).collect()] == ["Triggered"]
    f = spark.createDataFrame([("welcome", D, 1000, 10.0)], "flow_name string, send_date date, sends long, revenue double")
    assert mod.email_flow_roas(f).first().roas == 2.0


# Spend before May 2025, spend in May 2025 and new customers to April 2025, per
# channel (sums of the committed cleaned monthly files).
CAC_SPEND = [("Paid Search Media", 2147091.0, 79749.0), ("Paid Search Agency", 102899.0, 7501.0),
             ("Paid Social Media", 3500682.0, 238355.0), ("Paid Social Agency", 235171.0, 22418.0),
             ("Affiliate Media", 1484502.0, 18461.0), ("Affiliate Agency", 101960.0, 8978.0)]
CAC_CUSTOMERS = [("Paid Search", 59935.0), ("Paid Social", 28809.0), ("Affiliate", 14194.0)]


def test_overall_cac_goldens_both_caps(spark):
    apr, may = dt.date(2025, 4, 1), dt.date(2025, 5, 1)
    m = spark.createDataFrame([(n, pre, apr) for n, pre, _ in CAC_SPEND] + [(n, mv, may) for n, _, mv in CAC_SPEND],
                              "channel_name string, value double, date date")
    c = spark.createDataFrame([(n, v, apr) for n, v in CAC_CUSTOMERS], "channel_name string, value double, date date")
    capped = {r.channel: round(r.cac, 2) for r in ch.overall_cac(m, c, "2025-05-01").collect()}
    assert capped == {"paid search": 37.54, "paid social": 129.68, "affiliates": 111.77}
    published = {r.channel: round(r.cac, 2) for r in ch.overall_cac(m, c, "2025-06-01").collect()}
    assert published == {"paid search": 39.00, "paid social": 138.73, "affiliates": 113.70}


def test_trends_imputed_flags_kept_apart(spark):
    d = [dt.date(2024, m, 1) for m in range(1, 7)]
    spend = spark.createDataFrame([("Paid Search Media", 100.0 * (i + 1), x) for i, x in enumerate(d)],
                                  "channel_name string, value double, date date")
    top = spark.createDataFrame([(x, "s", "NET SALES - Paid Search", 300.0 * (i + 1)) for i, x in enumerate(d) if i != 2],
                                "date date, source string, metric string, value double")
    cust = spark.createDataFrame([("Paid Search", 10.0, x) for i, x in enumerate(d) if i != 4],
                                 "channel_name string, value double, date date")
    t = {r.date: r for r in ch.monthly_trends_imputed(ch.monthly_spend(spend), top, cust).collect()}
    assert [t[x].imputed_revenue for x in d] == [False, False, True, False, False, False]
    assert [t[x].imputed_customers for x in d] == [False, False, False, False, True, False]
    assert abs(t[d[2]].net_revenue - 900.0) < 1.0 and abs(t[d[2]].monthly_roas - 3.0) < 0.01
    assert t[d[4]].new_customers == 10.0 and t[d[4]].monthly_cac == 50.0
