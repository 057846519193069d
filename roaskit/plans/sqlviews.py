"""DuckDB oracle views: the adapter mapping of ``roaskit.sources.adapters``
restated in plain SQL over the driver tables, so each Spark query has an
independent check.  Only the oracle side uses these strings."""

from __future__ import annotations

import re

CHANNEL_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Paid Search' WHEN '2-HIGH' THEN 'Paid Social'
  WHEN '3-MEDIUM' THEN 'Affiliate' WHEN '4-NOT SPECIFIED' THEN 'Email' WHEN '5-LOW' THEN 'Organic Search' END"""

VIEWS = {
    "d_sessions": """SELECT event_id AS session_id, user_id, ts AS session_start, event_type AS utm_source,
  CASE event_type WHEN 'click' THEN 'cpc' WHEN 'view' THEN 'social_paid' WHEN 'signup' THEN 'organic'
    WHEN 'error' THEN 'referral' END AS utm_medium,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS campaign_id
  FROM events WHERE event_type <> 'purchase'""",
    "d_orders": """SELECT event_id AS order_id, user_id, ts AS order_datetime, value AS gross_revenue
  FROM events WHERE event_type = 'purchase'""",
    "d_campaigns": """SELECT p_partkey AS campaign_id, p_name AS campaign_name,
  CAST(DATE '2024-01-01' + CAST(p_size % 10 AS INTEGER) AS DATE) AS start_date, p_retailprice AS spend,
  p_type AS creative_format, p_brand AS creative_theme,
  CASE WHEN p_size <= 15 THEN 'Low' WHEN p_size <= 35 THEN 'Medium' ELSE 'High' END AS effectiveness_tier
  FROM part""",
    "d_attr": """SELECT order_id, user_id, order_datetime, gross_revenue, session_id, session_start FROM (
  SELECT o.order_id, o.user_id, o.order_datetime, o.gross_revenue, s.session_id, s.session_start,
    row_number() OVER (PARTITION BY o.order_id ORDER BY s.session_start DESC, s.session_id) AS rn
  FROM d_orders o JOIN d_sessions s ON o.user_id = s.user_id AND s.session_start <= o.order_datetime) t
  WHERE rn = 1""",
    "d_srev": """SELECT session_id, CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS gross_revenue, count(*) AS orders FROM d_attr GROUP BY session_id""",
    "d_enriched": """SELECT s.session_id, s.user_id, s.session_start, s.utm_source, s.utm_medium, s.campaign_id,
  c.campaign_name, c.start_date, c.spend, c.creative_format, c.creative_theme, c.effectiveness_tier,
  coalesce(r.gross_revenue, 0.0) AS gross_revenue, CASE WHEN r.orders > 0 THEN 1 ELSE 0 END AS converted
  FROM d_sessions s LEFT JOIN d_campaigns c ON s.campaign_id = c.campaign_id
  LEFT JOIN d_srev r ON s.session_id = r.session_id""",
    # channel facts
    "d_ord": f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, {CHANNEL_CASE} AS channel,
  o_orderstatus, o_totalprice, o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders""",
    "d_media_spend": """SELECT channel || ' ' || kind AS channel_name, value, date FROM (
  SELECT date, channel, 'Media' AS kind,
    CAST(sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END AS DECIMAL(38,6))) AS DOUBLE) / 100.0 AS value
  FROM d_ord GROUP BY date, channel
  UNION ALL
  SELECT date, channel, 'Agency' AS kind,
    count(*) FILTER (WHERE o_orderstatus = 'O') * 25.0 AS value
  FROM d_ord GROUP BY date, channel) t""",
    "d_first": """SELECT o_custkey, arg_min(date, (o_orderdate, o_orderkey)) AS date,
  arg_min(channel, (o_orderdate, o_orderkey)) AS channel FROM d_ord GROUP BY o_custkey""",
    "d_cust_new": """SELECT channel AS channel_name, CAST(count(*) AS DOUBLE) AS value, date
  FROM d_first GROUP BY date, channel""",
    "d_cust_ext": """SELECT t.channel AS channel_name, t.n - coalesce(n.value, 0.0) AS value, t.date
  FROM (SELECT date, channel, count(*) AS n FROM d_ord GROUP BY date, channel) t
  LEFT JOIN d_cust_new n ON t.date = n.date AND t.channel = n.channel_name""",
    "d_net_sales": """SELECT o.date, o.channel, CAST(sum(l.net) AS DOUBLE) AS value FROM
  (SELECT l_orderkey, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,6))) AS net FROM lineitem
   GROUP BY l_orderkey) l
  JOIN d_ord o ON l.l_orderkey = o.o_orderkey GROUP BY o.date, o.channel""",
    "d_topsheet": """SELECT date, 'shopify' AS source, 'NET SALES - ' || channel AS metric, value FROM d_net_sales
  UNION ALL
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, 'shopify' AS source, 'GROSS SALES' AS metric,
    CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS value FROM orders GROUP BY 1""",
    "d_breakdown": """SELECT CAST(year(date) AS VARCHAR) AS year_period, lower(channel) AS marketing_channel,
  CAST(sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END AS DECIMAL(38,6))) AS DOUBLE) / 100.0 AS ad_spend,
  CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) / 10.0 AS gross_discount, count(*) AS orders, year(date) AS year
  FROM d_ord GROUP BY year(date), lower(channel)""",
    "d_overrides": """SELECT date AS month, channel || ' Agency' AS channel,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) * 10 AS BIGINT) AS spend_override
  FROM d_ord GROUP BY date, channel""",
}


def canon(expr: str) -> str:
    """SQL form of ``canonical_channel``."""
    s = f"trim(regexp_replace(trim(lower({expr})), '( media| agency)$', ''))"
    return f"CASE WHEN {s} = 'affiliate' THEN 'affiliates' ELSE {s} END"


VIEW_DEPS = {
    "d_attr": ["d_orders", "d_sessions"], "d_srev": ["d_attr"],
    "d_enriched": ["d_sessions", "d_campaigns", "d_srev"],
    "d_media_spend": ["d_ord"], "d_first": ["d_ord"], "d_cust_new": ["d_first"], "d_cust_ext": ["d_cust_new", "d_ord"],
    "d_net_sales": ["d_ord"], "d_topsheet": ["d_net_sales"], "d_breakdown": ["d_ord"], "d_overrides": ["d_ord"],
}


VIEWS.update({
    "d_mspend": f"""SELECT date, mapping_key, value_media, coalesce(value_agency, 0.0) AS value_agency,
  value_media + coalesce(value_agency, 0.0) AS total_spend FROM (
  SELECT date, {canon('channel_name')} AS mapping_key,
    CAST(sum(CAST(CASE WHEN channel_name NOT ILIKE '%agency%' THEN value END AS DECIMAL(38,6))) AS DOUBLE) AS value_media,
    CAST(sum(CAST(CASE WHEN channel_name ILIKE '%agency%' THEN value END AS DECIMAL(38,6))) AS DOUBLE) AS value_agency,
    count(CASE WHEN channel_name NOT ILIKE '%agency%' THEN 1 END) AS n_media
  FROM d_media_spend GROUP BY 1, 2) t WHERE n_media > 0""",
    "d_netrev": f"""SELECT date, {canon("substr(metric, 13)")} AS mapping_key, value AS net_revenue
  FROM d_topsheet WHERE metric LIKE 'NET SALES - %'""",
    "d_mroas": """SELECT s.date, s.mapping_key, s.total_spend, coalesce(r.net_revenue, 0.0) AS net_revenue,
  r.net_revenue IS NULL AS imputed_revenue,
  CASE WHEN s.total_spend > 0 THEN coalesce(r.net_revenue, 0.0) / s.total_spend ELSE 0.0 END AS monthly_roas
  FROM d_mspend s LEFT JOIN d_netrev r ON s.date = r.date AND s.mapping_key = r.mapping_key""",
    "d_mcac": f"""SELECT s.date, s.mapping_key, s.total_spend, coalesce(c.value, 0.0) AS new_customers,
  c.value IS NULL AS imputed_customers,
  CASE WHEN coalesce(c.value, 0.0) > 0 THEN s.total_spend / c.value ELSE 0.0 END AS monthly_cac
  FROM d_mspend s LEFT JOIN (SELECT date, {canon('channel_name')} AS mapping_key, value FROM d_cust_new) c
  ON s.date = c.date AND s.mapping_key = c.mapping_key""",
    "d_trends": """SELECT r.date, r.mapping_key, r.total_spend, r.net_revenue, r.imputed_revenue, r.monthly_roas,
  c.new_customers, c.imputed_customers, c.monthly_cac
  FROM d_mroas r LEFT JOIN d_mcac c ON r.date = c.date AND r.mapping_key = c.mapping_key
  WHERE r.mapping_key IN ('paid search', 'paid social', 'affiliates')""",
    "d_croas": f"""SELECT s.marketing_channel, s.total_ad_spend, s.total_revenue, f.mapping_key,
  coalesce(f.agency_fees, 0.0) AS agency_fees, s.total_ad_spend + coalesce(f.agency_fees, 0.0) AS true_total_ad_spend,
  CASE WHEN s.total_ad_spend + coalesce(f.agency_fees, 0.0) > 0
    THEN s.total_revenue / (s.total_ad_spend + coalesce(f.agency_fees, 0.0)) ELSE 0.0 END AS corrected_roas
  FROM (SELECT marketing_channel, CAST(sum(CAST(ad_spend AS DECIMAL(38,6))) AS DOUBLE) AS total_ad_spend, CAST(sum(CAST(gross_discount AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue
        FROM d_breakdown GROUP BY marketing_channel) s
  LEFT JOIN (SELECT {canon('channel_name')} AS mapping_key, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS agency_fees FROM d_media_spend
             WHERE channel_name ILIKE '%agency%' GROUP BY 1) f
  ON {canon('s.marketing_channel')} = f.mapping_key""",
    "d_email_monthly": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CASE o_orderstatus WHEN 'F' THEN 'Batch Marketing' WHEN 'O' THEN 'Triggered' WHEN 'P' THEN 'Transactional' END
    AS email_type, count(*) AS sends, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS clicks
  FROM orders GROUP BY 1, 2""",
    "d_flows": """SELECT event_type AS flow_name, CAST(ts AS DATE) AS send_date, count(*) AS sends,
  count(*) FILTER (WHERE value >= 10) AS opens, count(*) FILTER (WHERE value >= 50) AS clicks,
  CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2""",
    "d_wholesale": """SELECT coalesce(s.s_name, CAST(g.l_suppkey AS VARCHAR)) AS retailer, g.l_partkey AS sku, g.* EXCLUDE (l_suppkey, l_partkey)
  FROM (SELECT l_suppkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units_ordered,
    CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS units_sold,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS units_shipped,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS on_hand,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS DOUBLE) AS wholesale_dollars, CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(38,6))) AS DOUBLE) AS discounts,
    CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS DECIMAL(38,6))) AS DOUBLE) AS returns_dollars,
    CAST(sum(CAST(l_extendedprice * l_tax AS DECIMAL(38,6))) AS DOUBLE) AS markdowns_dollars
  FROM lineitem GROUP BY l_suppkey, l_partkey) g LEFT JOIN supplier s ON g.l_suppkey = s.s_suppkey""",
})
VIEW_DEPS.update({
    "d_mspend": ["d_media_spend"], "d_netrev": ["d_topsheet"], "d_mroas": ["d_mspend", "d_netrev"],
    "d_mcac": ["d_mspend", "d_cust_new"], "d_trends": ["d_mroas", "d_mcac"],
    "d_croas": ["d_breakdown", "d_media_spend"],
})




def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs it references (in dependency order)."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for d in VIEW_DEPS.get(name, []):
            visit(d)
        if name not in needed:
            needed.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", body):
            visit(name)
    ordered = [n for n in VIEWS if n in needed]
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
