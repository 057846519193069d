"""Registered queries of sources, sinks, contracts and small helpers, each with its DuckDB oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roaskit.functions.scalars import seconds_between, to_number
from roaskit.operators import filters as flt
from roaskit.operators import joins as jn
from roaskit.operators import quality as qa
from roaskit.operators import reshape as rs
from roaskit.operators.ordering import seeded_sample
from roaskit.plans import channels as ch
from roaskit.plans import creative
from roaskit.plans.catalog import SAMPLE_N, SAMPLE_SEED, _mspend, _trends, r4, register
from roaskit.session import ensure_checkpoint_dir
from roaskit.sources import adapters as ad
from roaskit.sources import files
from roaskit.sources.tables import load


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"


# --- sources and sinks ------------------------------------------------------------------

@register("sheet_round_trip", """
SELECT c_custkey AS customer_id, 'Café, ' || c_mktsegment || chr(10) || '"x"' AS segment,
  round(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 4) AS balance FROM customer""")
def q_sheet_round_trip(spark, sf):
    """Customers as a spreadsheet export (Latin-1, semicolons, quotes and line breaks in cells, a blank
    last column, untidy names), read back, renamed, typed, stored and scanned under a declared schema."""
    root = _folder(spark)
    cells = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Cust Key"),
        F.concat(F.lit("Café, "), "c_mktsegment", F.lit('\n"x"')).alias("MKT-Segment"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))).alias("Acct Bal"),
        F.lit(None).cast("string").alias(" "))
    cells.write.options(header=True, sep=";", encoding="ISO-8859-1", quote='"', escape='"').csv(f"{root}/sheet")
    sheet = files.normalize_columns(files.read_messy_csv(spark, f"{root}/sheet", sep=";", encoding="ISO-8859-1"))
    sheet = files.rename_columns(sheet, {"mkt_segment": "segment", "acct_bal": "balance"}, first_as="customer_id")
    typed = sheet.select(F.col("customer_id").cast("long"), "segment", to_number("balance").alias("balance"))
    files.write_table(typed, f"{root}/customers.parquet")
    back = files.read_table(spark, f"{root}/customers.parquet", "customer_id long, segment string, balance double")
    return back.select("customer_id", "segment", r4("balance").alias("balance"))


@register("drop_folder_to_master", """
SELECT 'master' AS source, o_orderkey AS order_id, o_orderstatus AS status, TRUE AS from_csv FROM orders
UNION ALL SELECT 'again', o_orderkey, o_orderstatus, TRUE FROM orders""")
def q_drop_folder_to_master(spark, sf):
    """Every order dropped as CSV, scanned with its file name and appended to a master table by key, twice;
    the second delivery is kept apart."""
    root = _folder(spark)
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    files.write_table(rows.withColumn("part", F.pmod("order_id", F.lit(4))), f"{root}/inbox", "csv", partition_by=["part"])
    scan = files.scan_drop_folder(spark, f"{root}/inbox/part=*", "*.csv", "order_id long, status string", header=False)
    told = scan.select("order_id", "status", F.col("source_file").endswith(".csv").alias("from_csv"))
    for _ in range(2):
        files.append_to_master(spark, told, f"{root}/master", key=["order_id"], duplicates=f"{root}/again")
    return rs.tag_union({"master": files.read_master(spark, f"{root}/master"),
                         "again": files.read_master(spark, f"{root}/again", of=f"{root}/master")})


# --- filters, joins and reshapes --------------------------------------------------------

@register("agency_rows", """
SELECT channel_name, date, round(value, 4) AS value FROM d_media_spend WHERE lower(channel_name) LIKE '%agency'""")
def q_agency_rows(spark, sf):
    """Regex predicate."""
    return ad.media_spend(spark, sf).where(flt.matches("channel_name", "AGENCY$")).select(
        "channel_name", "date", r4("value").alias("value"))


@register("sessions_with_campaign", """
SELECT session_id, user_id, campaign_id FROM d_sessions WHERE user_id IS NOT NULL AND campaign_id IS NOT NULL""")
def q_sessions_with_campaign(spark, sf):
    """Rows without a key are dropped."""
    return flt.drop_null_keys(ad.sessions(spark, sf), ["user_id", "campaign_id"]).select("session_id", "user_id", "campaign_id")


@register("customers_side_by_side", """
SELECT e.channel_name, e.date, e.value AS value_existing, n.value AS value_new
FROM d_cust_ext e LEFT JOIN d_cust_new n ON e.channel_name = n.channel_name AND e.date = n.date""")
def q_customers_side_by_side(spark, sf):
    """Composite-key join; the clashing value columns get suffixes."""
    return jn.join_with_suffixes(ad.customers_ext(spark, sf), ad.customers_new(spark, sf), ["channel_name", "date"],
                                 suffixes=("_existing", "_new"))


@register("spend_and_customers_aligned", """
SELECT coalesce(s.channel_name, c.channel_name) AS channel_name, coalesce(s.date, c.date) AS date,
  round(coalesce(s.value, 0.0), 4) AS spend, coalesce(c.value, 0.0) AS customers
FROM d_media_spend s FULL JOIN d_cust_new c ON s.channel_name = c.channel_name AND s.date = c.date""")
def q_spend_and_customers_aligned(spark, sf):
    """Full alignment on channel and month; what one side lacks is 0."""
    spend = ad.media_spend(spark, sf).select("channel_name", "date", r4("value").alias("spend"))
    customers = ad.customers_new(spark, sf).select("channel_name", "date", F.col("value").alias("customers"))
    return jn.full_align(spend, customers, ["channel_name", "date"])


PIVOT = ["Paid Search", "Paid Social", "Affiliate", "Email"]


@register("new_customers_wide", "SELECT date, " + ", ".join(
    f"coalesce(sum(value) FILTER (WHERE channel_name = '{c}'), 0.0) AS \"{c}\"" for c in PIVOT) + " FROM d_cust_new GROUP BY date")
def q_new_customers_wide(spark, sf):
    """Long to wide over a fixed list of channels."""
    return rs.pivot_wide(ad.customers_new(spark, sf), ["date"], "channel_name", PIVOT, "value")


@register("attribution_delay", """
SELECT order_id, session_id, round((epoch_us(order_datetime) - epoch_us(session_start)) / 1000000.0, 4) AS delay_seconds
FROM d_attr""")
def q_attribution_delay(spark, sf):
    """seconds from the attributed session to the order."""
    a = creative.attribute_last_touch(ad.orders(spark, sf), ad.sessions(spark, sf))
    return a.select("order_id", "session_id", r4(seconds_between("order_datetime", "session_start")).alias("delay_seconds"))


@register("seeded_sample", f"""
SELECT session_id, user_id FROM d_sessions ORDER BY md5('{SAMPLE_SEED}|' || CAST(session_id AS VARCHAR)), session_id
LIMIT {SAMPLE_N}""")
def q_seeded_sample(spark, sf):
    """O3: the sampled rows themselves."""
    return seeded_sample(ad.sessions(spark, sf), SAMPLE_N, SAMPLE_SEED, ["session_id"]).select("session_id", "user_id")


# --- contracts and imputation -----------------------------------------------------------

@register("output_contracts", """
SELECT 'monthly_trends' AS source, mapping_key AS channel, count(*) AS rows, count(*) FILTER (WHERE ok) AS accepted,
  count(*) FILTER (WHERE NOT ok) AS rejected
FROM (SELECT *, total_spend >= 0 AND net_revenue >= 0 AND monthly_cac IS NOT NULL AS ok FROM d_trends) t GROUP BY 2
UNION ALL SELECT 'channel_roas', marketing_channel, count(*), count(*) FILTER (WHERE true_total_ad_spend >= 0),
  count(*) FILTER (WHERE NOT true_total_ad_spend >= 0) FROM d_croas GROUP BY 2""")
def q_output_contracts(spark, sf):
    """Q5 + Q8: monthly trends and channel ROAS against their output contracts."""
    trends = qa.with_errors(_trends(spark, sf), qa.monthly_trends_contract())
    roas = qa.with_errors(ch.channel_roas(ad.channel_breakdown(spark, sf), ad.media_spend(spark, sf)), qa.channel_roas_contract())
    return rs.tag_union({
        "monthly_trends": qa.validation_counts(trends.withColumnRenamed("mapping_key", "channel"), ["channel"]),
        "channel_roas": qa.validation_counts(roas.withColumnRenamed("marketing_channel", "channel"), ["channel"])})


@register("impute_regression", """
WITH m AS (SELECT s.date, s.mapping_key, s.total_spend, CASE WHEN extract(month FROM s.date) % 5 = 0 THEN NULL
    ELSE r.net_revenue END AS net_revenue
  FROM d_mspend s LEFT JOIN d_netrev r ON s.date = r.date AND s.mapping_key = r.mapping_key),
f AS (SELECT regr_slope(net_revenue, total_spend) AS b, regr_intercept(net_revenue, total_spend) AS a FROM m)
SELECT date, mapping_key, floor(total_spend * 100.0 + 0.5) / 100.0 AS total_spend,
  floor(coalesce(net_revenue, (SELECT a FROM f) + (SELECT b FROM f) * total_spend) * 100.0 + 0.5) / 100.0 AS net_revenue,
  net_revenue IS NULL AS imputed_bool FROM m""")
def q_impute_regression(spark, sf):
    """One column with gaps (here also the revenue of May and October) regressed on one without."""
    from roaskit.plans.impute import impute_iterative
    m = ch.monthly_roas(_mspend(spark, sf), ad.topsheet(spark, sf), fill_missing=False).select(
        "date", "mapping_key", "total_spend",
        F.when(F.pmod(F.month("date"), F.lit(5)) != 0, F.col("net_revenue")).alias("net_revenue"))
    out = impute_iterative(m, ["total_spend", "net_revenue"], ridge=0.0)
    cents = [(F.floor(F.col(c) * 100.0 + 0.5).cast("double") / 100.0).alias(c) for c in ("total_spend", "net_revenue")]
    return out.select("date", "mapping_key", *cents, "imputed_bool")
