"""Registered queries: one Spark plan per operator family, each with the
DuckDB oracle SQL that checks it.  Ratios and float sums are rounded to four
places on both sides; every ordering has a total tie-break."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.operators import filters as flt
from roaskit.operators.ordering import distinct_values, seeded_sample, top_k
from roaskit.plans import creative
from roaskit.plans.sqlviews import with_views
from roaskit.sources import adapters as ad

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql_round4(with_views(sql))
        return fn
    return deco


def r4(c) -> F.Column:
    """Round to four places with plain IEEE arithmetic, ``floor(x * 1e4 + 0.5) / 1e4``.

    Spark's ``round`` (decimal HALF_UP) and DuckDB's ``round`` break exact
    halves differently; this formula gives bit-identical doubles in both."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(10000.0) + F.lit(0.5)).cast("double") / F.lit(10000.0)


def sql_round4(sql: str) -> str:
    """Rewrite every ``round(<expr>, 4)`` of the oracle SQL into the ``r4`` formula."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 0, j + 5, -1
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        arg = sql[last_comma + 1:k].strip() if last_comma > 0 else ""
        if arg == "4":
            inner = sql_round4(sql[j + 6:last_comma])
            out.append(sql[i:j] + f"(floor(({inner}) * 10000.0 + 0.5) / 10000.0)")
        else:
            out.append(sql[i:j] + "round(" + sql_round4(sql[j + 6:k]) + ")")
        i = k + 1


def _enriched(spark, sf):
    return creative.enrich_sessions(ad.sessions(spark, sf), ad.campaigns(spark, sf), ad.orders(spark, sf))


# --- creative performance ---------------------------------------------------

@register("attribution_last_touch", """
SELECT order_id, user_id, order_datetime, round(gross_revenue, 4) AS gross_revenue, session_id, session_start
FROM d_attr""")
def q_attribution(spark, sf):
    a = creative.attribute_last_touch(ad.orders(spark, sf), ad.sessions(spark, sf))
    return a.select("order_id", "user_id", "order_datetime", r4("gross_revenue").alias("gross_revenue"),
                    "session_id", "session_start")


@register("session_revenue", """
SELECT session_id, campaign_id, round(gross_revenue, 4) AS gross_revenue, converted FROM d_enriched""")
def q_session_revenue(spark, sf):
    e = _enriched(spark, sf)
    return e.select("session_id", "campaign_id", r4("gross_revenue").alias("gross_revenue"), "converted")


@register("campaign_summary", """
SELECT c.campaign_id, c.spend, c.creative_format, c.creative_theme,
  round(p.total_revenue, 4) AS total_revenue, p.total_conversions
FROM (SELECT DISTINCT campaign_id, spend, creative_format, creative_theme FROM d_enriched
      WHERE campaign_id IS NOT NULL) c
JOIN (SELECT campaign_id, CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue, CAST(sum(converted) AS BIGINT) AS total_conversions
      FROM d_enriched WHERE campaign_id IS NOT NULL GROUP BY campaign_id) p ON c.campaign_id = p.campaign_id""")
def q_campaign_summary(spark, sf):
    c = creative.campaign_summary(_enriched(spark, sf))
    return c.select("campaign_id", "spend", "creative_format", "creative_theme",
                    r4("total_revenue").alias("total_revenue"), "total_conversions")


_CREATIVE_SQL = """
WITH cs AS (
  SELECT c.campaign_id, c.spend, c.creative_format, c.creative_theme, p.total_revenue, p.total_conversions
  FROM (SELECT DISTINCT campaign_id, spend, creative_format, creative_theme FROM f
        WHERE campaign_id IS NOT NULL) c
  JOIN (SELECT campaign_id, CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue, sum(converted) AS total_conversions
        FROM f WHERE campaign_id IS NOT NULL GROUP BY campaign_id) p ON c.campaign_id = p.campaign_id),
g AS (SELECT creative_format, creative_theme, CAST(sum(CAST(spend AS DECIMAL(38,6))) AS DOUBLE) AS total_spend, CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
        CAST(sum(total_conversions) AS BIGINT) AS total_conversions
      FROM cs WHERE creative_format IS NOT NULL AND creative_theme IS NOT NULL
      GROUP BY creative_format, creative_theme)
SELECT creative_format, creative_theme, round(total_spend, 4) AS total_spend, round(total_revenue, 4) AS total_revenue,
  total_conversions,
  round(CASE WHEN total_spend > 0 THEN total_revenue / total_spend ELSE 0.0 END, 4) AS roas,
  round(CASE WHEN total_conversions > 0 THEN total_spend / total_conversions ELSE 0.0 END, 4) AS cac,
  round(greatest(CASE WHEN total_spend > 0 THEN total_revenue / total_spend ELSE 0.0 END, 0.01), 4) AS roas_display
FROM g"""


def _creative_out(df):
    return df.select("creative_format", "creative_theme", r4("total_spend").alias("total_spend"),
                     r4("total_revenue").alias("total_revenue"), "total_conversions",
                     r4("roas").alias("roas"), r4("cac").alias("cac"), r4("roas_display").alias("roas_display"))


@register("creative_summary", "WITH f AS (SELECT * FROM d_enriched) " + _CREATIVE_SQL.replace("WITH cs", ", cs", 1))
def q_creative_summary(spark, sf):
    return _creative_out(creative.creative_summary(_enriched(spark, sf)))


# Filter widgets: inclusive date range on the date part, format multi-select, theme "All".
FILTER_LO, FILTER_HI = "2024-01-05", "2024-01-20"
FILTER_FORMATS = ["SMALL", "PROMO", "LARGE"]


@register("creative_summary_filtered", f"""WITH f AS (SELECT * FROM d_enriched
  WHERE session_start >= TIMESTAMP '{FILTER_LO}' AND session_start < TIMESTAMP '{FILTER_HI}' + INTERVAL 1 DAY
    AND creative_format IN ({", ".join(f"'{x}'" for x in FILTER_FORMATS)})) """
          + _CREATIVE_SQL.replace("WITH cs", ", cs", 1))
def q_creative_summary_filtered(spark, sf):
    e = _enriched(spark, sf)
    e = flt.filter_dates(e, "session_start", FILTER_LO, FILTER_HI)
    e = flt.filter_in(e, "creative_format", FILTER_FORMATS)
    e = flt.filter_in(e, "creative_theme", ["All"])
    return _creative_out(creative.creative_summary(e))


_RUNS_SQL = f"""
WITH runs AS (
  SELECT campaign_id, CAST(max(session_start) AS DATE) AS last_day FROM d_sessions WHERE campaign_id IS NOT NULL GROUP BY campaign_id),
f AS (
  SELECT e.* REPLACE (e.spend * CASE WHEN e.start_date IS NULL THEN 1.0 ELSE
      greatest(date_diff('day', greatest(e.start_date, DATE '{FILTER_LO}'),
                         least(greatest(e.start_date, r.last_day), DATE '{FILTER_HI}')) + 1, 0)::DOUBLE
      / (date_diff('day', e.start_date, greatest(e.start_date, r.last_day)) + 1)::DOUBLE END AS spend)
  FROM d_enriched e LEFT JOIN runs r ON e.campaign_id = r.campaign_id
  WHERE e.session_start >= TIMESTAMP '{FILTER_LO}' AND e.session_start < TIMESTAMP '{FILTER_HI}' + INTERVAL 1 DAY) """


def _enriched_in_range(spark, sf):
    """Sessions of the filtered days, with the days that their campaigns run."""
    sessions = ad.sessions(spark, sf)
    e = creative.enrich_sessions(sessions, creative.campaign_runs(ad.campaigns(spark, sf), sessions), ad.orders(spark, sf))
    return flt.filter_dates(e, "session_start", FILTER_LO, FILTER_HI)


@register("campaign_summary_prorated", _RUNS_SQL + """
SELECT campaign_id, round(any_value(spend), 4) AS spend, creative_format, creative_theme,
  round(CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE), 4) AS total_revenue, CAST(sum(converted) AS BIGINT) AS total_conversions
FROM f WHERE campaign_id IS NOT NULL GROUP BY campaign_id, creative_format, creative_theme""")
def q_campaign_summary_prorated(spark, sf):
    """D3 over a part of the range: a campaign's spend goes evenly to its days, and those in the range count."""
    c = creative.campaign_summary(_enriched_in_range(spark, sf), prorate=(FILTER_LO, FILTER_HI))
    return c.select("campaign_id", r4("spend").alias("spend"), "creative_format", "creative_theme",
                    r4("total_revenue").alias("total_revenue"), "total_conversions")


@register("creative_summary_prorated", _RUNS_SQL + _CREATIVE_SQL.replace("WITH cs", ", cs", 1))
def q_creative_summary_prorated(spark, sf):
    """D4 with the spend of the filtered days only."""
    return _creative_out(creative.creative_summary(_enriched_in_range(spark, sf), prorate=(FILTER_LO, FILTER_HI)))


@register("creative_rollup", """
WITH f AS (SELECT * FROM d_enriched), cs AS (
  SELECT c.campaign_id, c.spend, c.creative_format, c.creative_theme, p.total_revenue, p.total_conversions
  FROM (SELECT DISTINCT campaign_id, spend, creative_format, creative_theme FROM f WHERE campaign_id IS NOT NULL) c
  JOIN (SELECT campaign_id, CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue, sum(converted) AS total_conversions
        FROM f WHERE campaign_id IS NOT NULL GROUP BY campaign_id) p ON c.campaign_id = p.campaign_id),
leaf AS (SELECT creative_format, creative_theme, CAST(sum(CAST(spend AS DECIMAL(38,6))) AS DOUBLE) AS total_spend, CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
        sum(total_conversions) AS total_conversions FROM cs
      WHERE creative_format IS NOT NULL AND creative_theme IS NOT NULL GROUP BY creative_format, creative_theme),
leaf2 AS (SELECT *, greatest(CASE WHEN total_spend > 0 THEN total_revenue / total_spend ELSE 0.0 END, 0.01)
        * total_revenue AS wr FROM leaf),
r AS (SELECT creative_theme, creative_format, CAST(sum(CAST(total_spend AS DECIMAL(38,6))) AS DOUBLE) AS total_spend, CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
        CAST(sum(total_conversions) AS BIGINT) AS total_conversions, sum(wr) AS wr,
        CASE grouping(creative_theme, creative_format) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS level
      FROM leaf2 GROUP BY ROLLUP (creative_theme, creative_format)),
r2 AS (SELECT *, sum(CASE WHEN level = 1 THEN total_revenue END) OVER (PARTITION BY creative_theme) AS parent_rev,
        (SELECT sum(total_revenue) FROM leaf) AS all_rev FROM r)
SELECT creative_theme, creative_format, level, round(total_spend, 4) AS total_spend,
  round(total_revenue, 4) AS total_revenue, total_conversions,
  round(CASE WHEN total_revenue > 0 THEN wr / total_revenue END, 4) AS weighted_roas,
  round(CASE WHEN level = 0 THEN (CASE WHEN parent_rev > 0 THEN total_revenue / parent_rev ELSE 0.0 END)
        WHEN level = 1 THEN (CASE WHEN all_rev > 0 THEN total_revenue / all_rev ELSE 0.0 END) ELSE 1.0 END, 4)
    AS share_of_parent,
  round(CASE WHEN level = 0 THEN (CASE WHEN total_spend > 0 THEN total_revenue / total_spend ELSE 0.0 END) END, 4)
    AS roas,
  round(CASE WHEN level = 0 THEN (CASE WHEN total_conversions > 0 THEN total_spend / total_conversions ELSE 0.0 END)
    END, 4) AS cac
FROM r2""")
def q_creative_rollup(spark, sf):
    r = creative.creative_rollup(_enriched(spark, sf))
    return r.select("creative_theme", "creative_format", "level", r4("total_spend").alias("total_spend"),
                    r4("total_revenue").alias("total_revenue"), "total_conversions",
                    r4("weighted_roas").alias("weighted_roas"), r4("share_of_parent").alias("share_of_parent"),
                    r4("roas").alias("roas"), r4("cac").alias("cac"))


_PAYBACK_SQL = """
WITH s AS (SELECT e.campaign_id, e.session_id, e.session_start, e.gross_revenue, c.start_date, c.spend AS campaign_spend
  FROM d_enriched e JOIN d_campaigns c ON e.campaign_id = c.campaign_id
  WHERE e.session_start >= CAST(c.start_date AS TIMESTAMP)),
p AS (SELECT campaign_id FROM s GROUP BY campaign_id HAVING sum(gross_revenue) > 0),
curve AS (SELECT s.campaign_id, s.session_id, s.session_start,
    CAST(floor((epoch_us(s.session_start) - epoch_us(CAST(s.start_date AS TIMESTAMP))) / 86400000000) AS BIGINT)
      AS days_since_launch,
    s.gross_revenue,
    sum(s.gross_revenue) OVER (PARTITION BY s.campaign_id ORDER BY s.session_start, s.session_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_revenue,
    s.campaign_spend
  FROM s JOIN p ON s.campaign_id = p.campaign_id)
"""


@register("payback_curve", _PAYBACK_SQL + """
SELECT campaign_id, session_id, session_start, days_since_launch, round(gross_revenue, 4) AS gross_revenue,
  round(cumulative_revenue, 4) AS cumulative_revenue, campaign_spend FROM curve""")
def q_payback_curve(spark, sf):
    c = creative.payback_curve(_enriched(spark, sf), ad.campaigns(spark, sf))
    return c.select("campaign_id", "session_id", "session_start", "days_since_launch",
                    r4("gross_revenue").alias("gross_revenue"), r4("cumulative_revenue").alias("cumulative_revenue"),
                    "campaign_spend")


@register("payback_period", _PAYBACK_SQL + """
SELECT campaign_id, first(campaign_spend) AS campaign_spend, round(max(cumulative_revenue), 4) AS final_revenue,
  min(CASE WHEN cumulative_revenue >= campaign_spend THEN days_since_launch END) AS payback_day
FROM curve GROUP BY campaign_id""")
def q_payback_period(spark, sf):
    p = creative.payback_period(creative.payback_curve(_enriched(spark, sf), ad.campaigns(spark, sf)))
    return p.select("campaign_id", "campaign_spend", r4("final_revenue").alias("final_revenue"), "payback_day")


# Scoring predicates on the adapter's tags: theme = brand, format = part type.
PROMO_THEME, VIDEO_FORMAT = "Brand#1", "PROMO"


@register("conversion_score", f"""
WITH e AS (SELECT * FROM d_enriched),
b AS (SELECT min(spend) AS lo, max(spend) AS hi FROM e),
s0 AS (SELECT e.session_id, e.effectiveness_tier = 'High' AS high, e.creative_theme = '{PROMO_THEME}' AS promo,
         e.creative_format = '{VIDEO_FORMAT}' AS video, e.effectiveness_tier = 'Low' AS low,
         0.02 + (e.spend - b.lo) / (b.hi - b.lo) * 0.05 AS p FROM e, b),
s1 AS (SELECT session_id, high, promo, video, low,
         CASE WHEN coalesce(high AND promo AND video, false) THEN least(greatest(p + 0.85, 0.0), 1.0) ELSE p END AS p
       FROM s0),
s2 AS (SELECT session_id, low,
         CASE WHEN coalesce(high AND (promo OR video), false) THEN least(greatest(p + 0.5, 0.0), 1.0) ELSE p END AS p
       FROM s1)
SELECT session_id, round(CASE WHEN coalesce(low, false) THEN least(greatest(p * 0.1, 0.005), 1.0) ELSE p END, 4)
  AS conversion_score FROM s2""")
def q_conversion_score(spark, sf):
    s = creative.conversion_score(_enriched(spark, sf), promo_theme=PROMO_THEME, video_format=VIDEO_FORMAT)
    return s.select("session_id", r4("conversion_score").alias("conversion_score"))


@register("filter_values", """
SELECT DISTINCT creative_format AS value, 'creative_format' AS filter FROM d_campaigns WHERE creative_format IS NOT NULL
UNION ALL
SELECT DISTINCT creative_theme AS value, 'creative_theme' AS filter FROM d_campaigns WHERE creative_theme IS NOT NULL""")
def q_filter_values(spark, sf):
    c = ad.campaigns(spark, sf)
    f = distinct_values(c, "creative_format").select(F.col("creative_format").alias("value"),
                                                     F.lit("creative_format").alias("filter"))
    t = distinct_values(c, "creative_theme").select(F.col("creative_theme").alias("value"),
                                                    F.lit("creative_theme").alias("filter"))
    return f.unionByName(t)


@register("top_campaigns", """
SELECT campaign_id, round(total_revenue, 4) AS total_revenue FROM (
  SELECT campaign_id, CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue FROM d_enriched WHERE campaign_id IS NOT NULL
  GROUP BY campaign_id) t ORDER BY total_revenue DESC, campaign_id LIMIT 15""")
def q_top_campaigns(spark, sf):
    c = creative.campaign_summary(_enriched(spark, sf))
    return top_k(c, 15, [F.col("total_revenue").desc(), F.col("campaign_id")]).select(
        "campaign_id", r4("total_revenue").alias("total_revenue"))


SAMPLE_N, SAMPLE_SEED = 1000, 1


@register("seeded_sample_size", f"""
SELECT least(count(*), {SAMPLE_N}) AS sample_rows, least(count(DISTINCT session_id), {SAMPLE_N}) AS distinct_ids
FROM d_sessions""")
def q_seeded_sample_size(spark, sf):
    s = seeded_sample(ad.sessions(spark, sf), SAMPLE_N, SAMPLE_SEED, ["session_id"])
    return s.agg(F.count(F.lit(1)).alias("sample_rows"), F.countDistinct("session_id").alias("distinct_ids"))


# --- channel profitability ------------------------------------------------------

from roaskit.plans import channels as ch  # noqa: E402
from roaskit.plans import modules as mod  # noqa: E402
from roaskit.plans.sqlviews import canon  # noqa: E402

# Analysis cut-off: the first month left out (all inputs capped at the same month).
CAP_END = "2001-07-01"


def _mspend(spark, sf):
    return ch.monthly_spend(ad.media_spend(spark, sf))


@register("channel_roas", """
SELECT marketing_channel, round(total_ad_spend, 4) AS total_ad_spend, round(total_revenue, 4) AS total_revenue,
  mapping_key, round(agency_fees, 4) AS agency_fees, round(true_total_ad_spend, 4) AS true_total_ad_spend,
  round(corrected_roas, 4) AS corrected_roas FROM d_croas""")
def q_channel_roas(spark, sf):
    r = ch.channel_roas(ad.channel_breakdown(spark, sf), ad.media_spend(spark, sf))
    return r.select("marketing_channel", r4("total_ad_spend").alias("total_ad_spend"),
                    r4("total_revenue").alias("total_revenue"), "mapping_key", r4("agency_fees").alias("agency_fees"),
                    r4("true_total_ad_spend").alias("true_total_ad_spend"),
                    r4("corrected_roas").alias("corrected_roas"))


@register("monthly_spend", """
SELECT date, mapping_key, round(value_media, 4) AS value_media, round(value_agency, 4) AS value_agency,
  round(total_spend, 4) AS total_spend FROM d_mspend""")
def q_monthly_spend(spark, sf):
    m = _mspend(spark, sf)
    return m.select("date", "mapping_key", r4("value_media").alias("value_media"),
                    r4("value_agency").alias("value_agency"), r4("total_spend").alias("total_spend"))


@register("spend_overrides_applied", f"""
SELECT s.date, s.mapping_key, round(coalesce(CASE WHEN s.total_spend = 0 THEN CAST(o.spend_override AS DOUBLE)
    ELSE s.total_spend END, 0.0), 4) AS total_spend
FROM d_mspend s LEFT JOIN (SELECT month, {canon('channel')} AS k, spend_override FROM d_overrides) o
  ON CAST(date_trunc('month', s.date) AS DATE) = o.month AND s.mapping_key = o.k""")
def q_spend_overrides_applied(spark, sf):
    m = ch.apply_spend_overrides(_mspend(spark, sf), ad.spend_overrides(spark, sf))
    return m.select("date", "mapping_key", r4("total_spend").alias("total_spend"))


@register("monthly_roas", """
SELECT date, mapping_key, round(total_spend, 4) AS total_spend, round(net_revenue, 4) AS net_revenue,
  imputed_revenue, round(monthly_roas, 4) AS monthly_roas FROM d_mroas""")
def q_monthly_roas(spark, sf):
    r = ch.monthly_roas(_mspend(spark, sf), ad.topsheet(spark, sf))
    return r.select("date", "mapping_key", r4("total_spend").alias("total_spend"),
                    r4("net_revenue").alias("net_revenue"), "imputed_revenue", r4("monthly_roas").alias("monthly_roas"))


@register("monthly_cac", """
SELECT date, mapping_key, round(total_spend, 4) AS total_spend, round(new_customers, 4) AS new_customers,
  imputed_customers, round(monthly_cac, 4) AS monthly_cac FROM d_mcac""")
def q_monthly_cac(spark, sf):
    c = ch.monthly_cac(_mspend(spark, sf), ad.customers_new(spark, sf))
    return c.select("date", "mapping_key", r4("total_spend").alias("total_spend"),
                    r4("new_customers").alias("new_customers"), "imputed_customers",
                    r4("monthly_cac").alias("monthly_cac"))


def _trends(spark, sf):
    return ch.monthly_trends(_mspend(spark, sf), ad.topsheet(spark, sf), ad.customers_new(spark, sf))


@register("monthly_trends", """
SELECT date, mapping_key, round(total_spend, 4) AS total_spend, round(net_revenue, 4) AS net_revenue,
  imputed_revenue, round(monthly_roas, 4) AS monthly_roas, round(new_customers, 4) AS new_customers,
  imputed_customers, round(monthly_cac, 4) AS monthly_cac FROM d_trends""")
def q_monthly_trends(spark, sf):
    t = _trends(spark, sf)
    return t.select("date", "mapping_key", r4("total_spend").alias("total_spend"),
                    r4("net_revenue").alias("net_revenue"), "imputed_revenue", r4("monthly_roas").alias("monthly_roas"),
                    r4("new_customers").alias("new_customers"), "imputed_customers",
                    r4("monthly_cac").alias("monthly_cac"))


@register("monthly_trends_imputed")
def q_monthly_trends_imputed(spark, sf):
    """D13 + I1 + I2: trends with revenue gaps imputed by regression and
    customer gaps by the mean, flags kept apart (rows-only: iterative fit)."""
    t = ch.monthly_trends_imputed(_mspend(spark, sf), ad.topsheet(spark, sf), ad.customers_new(spark, sf))
    return t.select("date", "mapping_key", r4("total_spend").alias("total_spend"),
                    r4("net_revenue").alias("net_revenue"), "imputed_revenue", r4("monthly_roas").alias("monthly_roas"),
                    r4("new_customers").alias("new_customers"), "imputed_customers",
                    r4("monthly_cac").alias("monthly_cac"))


@register("low_roas_label", """
SELECT date, mapping_key, round(monthly_roas, 4) AS monthly_roas, CAST(monthly_roas < 1.5 AS INTEGER) AS churned
FROM d_trends""")
def q_low_roas_label(spark, sf):
    t = ch.low_roas_label(_trends(spark, sf))
    return t.select("date", "mapping_key", r4("monthly_roas").alias("monthly_roas"), "churned")


@register("spend_gaps", """
SELECT date, mapping_key, round(total_spend, 4) AS total_spend FROM d_trends
WHERE NOT (total_spend > 0) OR total_spend IS NULL""")
def q_spend_gaps(spark, sf):
    return ch.spend_gaps(_trends(spark, sf)).select("date", "mapping_key", r4("total_spend").alias("total_spend"))


_OVERALL_CAC_SQL = f"""
oc_s AS (SELECT {canon('channel_name')} AS k, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total_spend FROM d_media_spend
         WHERE date < DATE '{CAP_END}' GROUP BY 1),
oc_c AS (SELECT {canon('channel_name')} AS k, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total_new_customers FROM d_cust_new
         WHERE date < DATE '{CAP_END}' GROUP BY 1),
oc AS (SELECT * FROM (SELECT coalesce(oc_s.k, oc_c.k) AS channel, oc_s.total_spend, oc_c.total_new_customers,
         CASE WHEN oc_c.total_new_customers > 0 THEN oc_s.total_spend / oc_c.total_new_customers ELSE 0.0 END AS cac
       FROM oc_s FULL JOIN oc_c ON oc_s.k = oc_c.k) t WHERE cac > 0)"""


@register("overall_cac", "WITH " + _OVERALL_CAC_SQL + """
SELECT channel, round(total_spend, 4) AS total_spend, round(total_new_customers, 4) AS total_new_customers,
  round(cac, 4) AS cac FROM oc""")
def q_overall_cac(spark, sf):
    c = ch.overall_cac(ad.media_spend(spark, sf), ad.customers_new(spark, sf), CAP_END)
    return c.select("channel", r4("total_spend").alias("total_spend"),
                    r4("total_new_customers").alias("total_new_customers"), r4("cac").alias("cac"))


@register("kpi_summary", "WITH " + _OVERALL_CAC_SQL + """
SELECT round(CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE), 4) AS total_revenue,
  round(CASE WHEN CAST(sum(CAST(CASE WHEN true_total_ad_spend > 0 THEN true_total_ad_spend END AS DECIMAL(38,6))) AS DOUBLE) > 0
    THEN CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) / CAST(sum(CAST(CASE WHEN true_total_ad_spend > 0 THEN true_total_ad_spend END AS DECIMAL(38,6))) AS DOUBLE) ELSE 0.0 END, 4)
    AS blended_roas,
  (SELECT round(CASE WHEN CAST(sum(CAST(total_new_customers AS DECIMAL(38,6))) AS DOUBLE) > 0 THEN CAST(sum(CAST(total_spend AS DECIMAL(38,6))) AS DOUBLE) / CAST(sum(CAST(total_new_customers AS DECIMAL(38,6))) AS DOUBLE)
    ELSE 0.0 END, 4) FROM oc) AS blended_cac,
  (SELECT round(coalesce(CAST(sum(CAST(total_new_customers AS DECIMAL(38,6))) AS DOUBLE), 0.0), 4) FROM oc) AS total_new_customers,
  arg_max(marketing_channel, (corrected_roas, marketing_channel)) AS best_roas_channel,
  (SELECT arg_min(channel, (cac, channel)) FROM oc) AS lowest_cac_channel
FROM d_croas""")
def q_kpi_summary(spark, sf):
    r = ch.channel_roas(ad.channel_breakdown(spark, sf), ad.media_spend(spark, sf))
    c = ch.overall_cac(ad.media_spend(spark, sf), ad.customers_new(spark, sf), CAP_END)
    k = ch.kpi_summary(r, c)
    return k.select(r4("total_revenue").alias("total_revenue"), r4("blended_roas").alias("blended_roas"),
                    r4("blended_cac").alias("blended_cac"), r4("total_new_customers").alias("total_new_customers"),
                    "best_roas_channel", "lowest_cac_channel")


@register("best_channels", "WITH " + _OVERALL_CAC_SQL + """
SELECT * FROM (SELECT 'roas' AS metric, marketing_channel AS channel, round(corrected_roas, 4) AS value FROM d_croas
               ORDER BY corrected_roas DESC, marketing_channel LIMIT 3)
UNION ALL
SELECT * FROM (SELECT 'cac' AS metric, channel, round(cac, 4) AS value FROM oc ORDER BY cac, channel LIMIT 3)""")
def q_best_channels(spark, sf):
    r = ch.channel_roas(ad.channel_breakdown(spark, sf), ad.media_spend(spark, sf))
    c = ch.overall_cac(ad.media_spend(spark, sf), ad.customers_new(spark, sf), CAP_END)
    best = top_k(r, 3, [F.col("corrected_roas").desc(), F.col("marketing_channel")]).select(
        F.lit("roas").alias("metric"), F.col("marketing_channel").alias("channel"),
        r4("corrected_roas").alias("value"))
    low = top_k(c, 3, [F.col("cac"), F.col("channel")]).select(
        F.lit("cac").alias("metric"), "channel", r4("cac").alias("value"))
    return best.unionByName(low)


@register("customer_mix", f"""
WITH t AS (SELECT date, 'New' AS customer_type, value FROM d_cust_new
           UNION ALL SELECT date, 'Existing' AS customer_type, value FROM d_cust_ext)
SELECT date, round(coalesce(sum(CASE WHEN customer_type = 'New' THEN value END), 0.0), 4) AS "New",
  round(coalesce(sum(CASE WHEN customer_type = 'Existing' THEN value END), 0.0), 4) AS "Existing"
FROM t WHERE date < DATE '{CAP_END}' GROUP BY date""")
def q_customer_mix(spark, sf):
    m = ch.customer_mix(ad.customers_new(spark, sf), ad.customers_ext(spark, sf), end=CAP_END)
    return m.select("date", r4("New").alias("New"), r4("Existing").alias("Existing"))


@register("new_customer_ranking", f"""
SELECT channel_name, round(sum(value), 4) AS new_customers FROM d_cust_new WHERE date < DATE '{CAP_END}'
GROUP BY channel_name""")
def q_new_customer_ranking(spark, sf):
    r = ch.new_customer_ranking(ad.customers_new(spark, sf), end=CAP_END)
    return r.select("channel_name", r4("new_customers").alias("new_customers"))


# --- modules ----------------------------------------------------------------------

@register("persona_distribution", """
SELECT c_mktsegment AS persona, count(*) AS count FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1""")
def q_persona_distribution(spark, sf):
    return mod.persona_distribution(ad.personas(spark, sf))


PERSONA_PICK = ["BUILDING", "MACHINERY"]


@register("persona_distribution_filtered", f"""
SELECT c_mktsegment AS persona, count(*) AS count FROM customer
WHERE c_mktsegment IN ({", ".join(f"'{p}'" for p in PERSONA_PICK)}) GROUP BY 1""")
def q_persona_distribution_filtered(spark, sf):
    return mod.persona_distribution(ad.personas(spark, sf), PERSONA_PICK)


@register("email_flow_roas", """
SELECT flow_name, round(CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE), 4) AS total_revenue, round(CAST(sum(CAST(sends * CAST(0.005 AS DOUBLE) AS DECIMAL(38,6))) AS DOUBLE), 4) AS total_cost,
  round(CASE WHEN CAST(sum(CAST(sends * CAST(0.005 AS DOUBLE) AS DECIMAL(38,6))) AS DOUBLE) > 0 THEN CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE) / CAST(sum(CAST(sends * CAST(0.005 AS DOUBLE) AS DECIMAL(38,6))) AS DOUBLE)
    ELSE 0.0 END, 4) AS roas
FROM d_flows GROUP BY flow_name""")
def q_email_flow_roas(spark, sf):
    r = mod.email_flow_roas(ad.email_flows(spark, sf))
    return r.select("flow_name", r4("total_revenue").alias("total_revenue"), r4("total_cost").alias("total_cost"),
                    r4("roas").alias("roas"))


@register("email_funnel", """
SELECT flow_name, CAST(sum(sends) AS BIGINT) AS sends, CAST(sum(opens) AS BIGINT) AS opens,
  CAST(sum(clicks) AS BIGINT) AS clicks, round(CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE), 4) AS revenue,
  round(CASE WHEN sum(sends) > 0 THEN sum(opens) / sum(sends) ELSE 0.0 END, 4) AS open_rate,
  round(CASE WHEN sum(opens) > 0 THEN sum(clicks) / sum(opens) ELSE 0.0 END, 4) AS click_rate,
  round(CASE WHEN sum(clicks) > 0 THEN CAST(sum(CAST(revenue AS DECIMAL(38,6))) AS DOUBLE) / sum(clicks) ELSE 0.0 END, 4) AS revenue_per_click
FROM d_flows GROUP BY flow_name""")
def q_email_funnel(spark, sf):
    f = mod.email_funnel(ad.email_flows(spark, sf))
    return f.select("flow_name", "sends", "opens", "clicks", r4("revenue").alias("revenue"),
                    r4("open_rate").alias("open_rate"), r4("click_rate").alias("click_rate"),
                    r4("revenue_per_click").alias("revenue_per_click"))


@register("email_without_totals", """SELECT date, email_type, sends, clicks FROM d_email_monthly""")
def q_email_without_totals(spark, sf):
    return mod.exclude_subtotals(ad.email_monthly(spark, sf))


@register("wholesale_kpis", """
SELECT retailer, sku,
  round(CASE WHEN units_sold + on_hand > 0 THEN units_sold / (units_sold + on_hand) ELSE 0.0 END, 4) AS sell_through_pct,
  round(CASE WHEN units_sold / 4.0 > 0 THEN on_hand / (units_sold / 4.0) ELSE 0.0 END, 4) AS weeks_of_supply,
  round(CASE WHEN units_ordered > 0 THEN units_shipped / units_ordered ELSE 0.0 END, 4) AS fill_rate_pct,
  round(CASE WHEN wholesale_dollars > 0 THEN (wholesale_dollars - discounts - returns_dollars - markdowns_dollars)
    / wholesale_dollars ELSE 0.0 END, 4) AS net_margin_pct
FROM d_wholesale""")
def q_wholesale_kpis(spark, sf):
    w = mod.wholesale_kpis(ad.wholesale(spark, sf))
    return w.select("retailer", "sku", r4("sell_through_pct").alias("sell_through_pct"),
                    r4("weeks_of_supply").alias("weeks_of_supply"), r4("fill_rate_pct").alias("fill_rate_pct"),
                    r4("net_margin_pct").alias("net_margin_pct"))


# --- scalar cleaning, reshape ------------------------------------------------------

from roaskit.functions import scalars as fx  # noqa: E402
from roaskit.operators import quality as qa  # noqa: E402
from roaskit.operators import reshape as rs  # noqa: E402
from roaskit.sources.tables import load  # noqa: E402


@register("clean_currency", "SELECT c_custkey, round(c_acctbal, 4) AS amount FROM customer")
def q_clean_currency(spark, sf):
    t = ad.currency_text(spark, sf)
    return t.select("c_custkey", r4(fx.clean_currency("balance_text")).alias("amount"))


@register("clean_percentage", """
SELECT l_orderkey, l_linenumber, round(round(l_discount * 100) / 100.0, 4) AS pct FROM lineitem""")
def q_clean_percentage(spark, sf):
    li = load(spark, sf, "lineitem")
    txt = F.concat(F.lit('"'), F.format_number(F.col("l_discount") * 100, 0), F.lit('%"'))
    return li.select("l_orderkey", "l_linenumber", r4(fx.clean_percentage(txt)).alias("pct"))


@register("clean_numeric", "SELECT o_orderkey, round(o_totalprice, 4) AS amount FROM orders")
def q_clean_numeric(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", r4(fx.clean_numeric(F.format_number("o_totalprice", 2))).alias("amount"))


def mixed_cells(spark, sf):
    """Spreadsheet-like cells from orders: currency, percentages, error tokens, no-break spaces."""
    o = load(spark, sf, "orders")
    pri = F.col("o_orderpriority")
    txt = (F.when(F.col("o_orderstatus") == "F",
                  F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" ")))
            .when(F.col("o_orderstatus") == "O",
                  F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit("%")))
            .when(pri == "5-LOW", F.lit("#REF!"))
            .when(pri == "4-NOT SPECIFIED", F.lit("nan"))
            .when(pri == "3-MEDIUM", F.lit(" "))
            .otherwise(F.concat(F.lit(fx.NBSP), F.col("o_custkey").cast("string"))))
    return o.select("o_orderkey", txt.alias("cell"))


@register("clean_mixed", """
SELECT o_orderkey, round(CASE WHEN o_orderstatus = 'F' THEN o_totalprice
  WHEN o_orderstatus = 'O' THEN (o_orderkey % 100) / 100.0
  WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM') THEN NULL
  ELSE CAST(o_custkey AS DOUBLE) END, 4) AS value FROM orders""")
def q_clean_mixed(spark, sf):
    return mixed_cells(spark, sf).select("o_orderkey", r4(fx.clean_mixed("cell")).alias("value"))


@register("lenient_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN CAST(o_orderdate AS DATE)
  ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS parsed FROM orders""")
def q_lenient_dates(spark, sf):
    o = load(spark, sf, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    txt = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 1, F.date_format(d, "M/d/yyyy"))
            .when(k == 2, F.concat(F.date_format(d, "yyyy-MMM"), F.lit("-01")))
            .otherwise(F.concat(F.date_format(d, "yyyy-MMMM"), F.lit("-01"))))
    return o.select("o_orderkey", fx.lenient_date(txt).alias("parsed"))


@register("year_token", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year
FROM orders""")
def q_year_token(spark, sf):
    o = load(spark, sf, "orders")
    y = F.year("o_orderdate").cast("string")
    y = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.substring(y, 1, 1), F.lit("s"), F.substring(y, 2, 3))) \
         .otherwise(y)
    txt = F.concat(y, F.lit(" (Jan - "), F.date_format("o_orderdate", "MMM"), F.lit(")"))
    return o.select("o_orderkey", fx.year_token(txt).alias("year"))


@register("canonical_channel", f"""
SELECT DISTINCT channel_name, {canon('channel_name')} AS mapping_key,
  CASE WHEN channel_name ILIKE '%agency%' THEN 'agency' ELSE 'media' END AS kind FROM d_media_spend""")
def q_canonical_channel(spark, sf):
    m = ad.media_spend(spark, sf).select("channel_name").distinct()
    return m.select("channel_name", fx.canonical_channel("channel_name").alias("mapping_key"),
                    fx.spend_kind("channel_name").alias("kind"))


@register("hashed_users", "SELECT c_custkey, sha256(c_name) AS user_hash FROM customer")
def q_hashed_users(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", fx.sha256_id("c_name").alias("user_hash"))


@register("unpivot_months", "SELECT channel_name, date, round(value, 4) AS value FROM d_cust_new")
def q_unpivot_months(spark, sf):
    wide = ad.monthly_sheet(spark, sf)
    long = rs.unpivot_months(wide, ["channel", "year"])
    return long.select(F.col("channel").alias("channel_name"), "date", r4("value").alias("value"))


@register("unpivot_months_text", """
SELECT channel_name, CAST(year(date) AS VARCHAR) AS year, CAST(month(date) AS INTEGER) AS month,
  CASE month(date) WHEN 6 THEN -value WHEN 7 THEN NULL ELSE value END AS value,
  CASE WHEN month(date) = 7 THEN format('{:,}', CAST(value AS BIGINT)) || '%' END AS rejected FROM d_cust_new""")
def q_unpivot_months_text(spark, sf):
    """A sheet whose June cells are negative amounts and whose July cells are percents, which are returned as rejected."""
    wide = ad.monthly_sheet(spark, sf).withColumns({
        "june": F.concat(F.lit("($"), "june", F.lit(")")), "july": F.concat("july", F.lit("%"))})
    kept = rs.unpivot_months(wide, ["channel", "year"]).select(
        F.col("channel").alias("channel_name"), F.year("date").cast("string").alias("year"), F.month("date").alias("month"),
        r4("value").alias("value"), F.lit(None).cast("string").alias("rejected"))
    return kept.unionByName(rs.rejected_month_cells(wide, ["channel", "year"]).select(
        F.col("channel").alias("channel_name"), "year", fx.month_number("month").cast("int").alias("month"),
        F.lit(None).cast("double").alias("value"), F.col("cell").alias("rejected")))


# --- data quality ---------------------------------------------------------------------

MIN_QTY, MAX_DISCOUNT = 5, 0.08


order_line_contract = qa.order_line_contract


_ORDER_LINES_SQL = f"""
WITH ol AS (SELECT l.l_orderkey || '-' || l.l_linenumber AS order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
    o.o_orderdate AS order_datetime, CAST(l.l_partkey AS VARCHAR) AS sku, CAST(l.l_quantity AS BIGINT) AS qty,
    l.l_extendedprice / l.l_quantity AS unit_price, l.l_discount AS discount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
chk AS (SELECT *, concat_ws(';', CASE WHEN qty < {MIN_QTY} THEN 'qty:min' END,
    CASE WHEN unit_price < 0 THEN 'unit_price:non_negative' END,
    CASE WHEN discount > {MAX_DISCOUNT} THEN 'discount:max' END) AS errors FROM ol)
"""


def _checked_lines(spark, sf):
    return qa.with_errors(ad.order_lines(spark, sf), order_line_contract(MIN_QTY, MAX_DISCOUNT))


@register("order_lines_valid", _ORDER_LINES_SQL + """
SELECT order_id, customer_id, order_datetime, sku, qty, round(unit_price, 4) AS unit_price,
  round(discount, 4) AS discount FROM chk WHERE errors = ''""")
def q_order_lines_valid(spark, sf):
    good, _ = qa.validate(ad.order_lines(spark, sf), order_line_contract(MIN_QTY, MAX_DISCOUNT))
    return good.select("order_id", "customer_id", "order_datetime", "sku", "qty",
                       r4("unit_price").alias("unit_price"), r4("discount").alias("discount"))


@register("order_lines_rejected", _ORDER_LINES_SQL + "SELECT order_id, errors FROM chk WHERE errors <> ''")
def q_order_lines_rejected(spark, sf):
    _, bad = qa.validate(ad.order_lines(spark, sf), order_line_contract(MIN_QTY, MAX_DISCOUNT))
    return bad.select("order_id", F.concat_ws(";", "errors").alias("errors"))


@register("order_lines_nulls", f"""
WITH ol AS (SELECT l.l_orderkey || '-' || l.l_linenumber AS order_id,
    CASE WHEN l.l_linenumber <> 5 THEN o.o_custkey END AS customer_id,
    CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_quantity AS BIGINT) END AS qty, l.l_linenumber = 2 AS nan,
    l.l_discount AS discount FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT order_id, qty, concat_ws(';', CASE WHEN customer_id IS NULL THEN 'customer_id:not_null' END,
  CASE WHEN qty IS NULL THEN 'qty:not_null' END, CASE WHEN nan THEN 'unit_price:type_double' END,
  CASE WHEN qty IS NULL OR qty < {MIN_QTY} THEN 'qty:min' END, CASE WHEN nan THEN 'unit_price:non_negative' END,
  CASE WHEN discount > {MAX_DISCOUNT} THEN 'discount:max' END) AS errors FROM ol""")
def q_order_lines_nulls(spark, sf):
    """Q2 + Q3: returned lines without a quantity, second lines with NaN prices, fifth lines without a customer,
    and quantities written as ``17.0``."""
    lines = ad.order_lines(spark, sf, extra=["l_returnflag", "l_linenumber"])
    cells = lines.withColumns({
        "customer_id": F.when(F.col("l_linenumber") != 5, F.col("customer_id")),
        "qty": F.when(F.col("l_returnflag") != "R", F.concat("qty", F.lit(".0"))),
        "unit_price": F.when(F.col("l_linenumber") == 2, F.lit("NaN")).otherwise(F.col("unit_price"))})
    checked = qa.with_errors(cells.drop("l_returnflag", "l_linenumber"), order_line_contract(MIN_QTY, MAX_DISCOUNT))
    return checked.select("order_id", "qty", F.concat_ws(";", "errors").alias("errors"))


@register("validation_counts", _ORDER_LINES_SQL + """
SELECT CAST(year(order_datetime) AS INTEGER) AS year, count(*) AS rows, count(*) FILTER (WHERE errors = '') AS accepted,
  count(*) FILTER (WHERE errors <> '') AS rejected FROM chk GROUP BY 1""")
def q_validation_counts(spark, sf):
    c = _checked_lines(spark, sf).withColumn("year", F.year("order_datetime"))
    return qa.validation_counts(c, ["year"])


PROFILE_FUTURE = "2001-01-01 00:00:00"  # the as-of date: later order dates count as future
PROFILE_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "double"),
                ("o_orderstatus", "string"), ("o_orderdate", "timestamp_ntz")]


def _profile_sql():
    parts = []
    for c, t in PROFILE_COLS:
        num = t in ("bigint", "double")
        tim = t == "timestamp_ntz"
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
  count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(DISTINCT {c}) AS "distinct",
  {f'CAST(min({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS min_value,
  {f'CAST(max({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS max_value,
  {f'round(avg({c}), 4)' if num else 'CAST(NULL AS DOUBLE)'} AS mean,
  {f'round(stddev_samp({c}), 4)' if num else 'CAST(NULL AS DOUBLE)'} AS stddev,
  {f'count(*) FILTER (WHERE {c} < 0)' if num else 'CAST(NULL AS BIGINT)'} AS negatives,
  {f'min({c})' if tim else 'CAST(NULL AS TIMESTAMP)'} AS min_time,
  {f'max({c})' if tim else 'CAST(NULL AS TIMESTAMP)'} AS max_time,
  {f"count(*) FILTER (WHERE {c} > TIMESTAMP '{PROFILE_FUTURE}')" if tim else 'CAST(NULL AS BIGINT)'} AS future
  FROM orders""")
    return "\nUNION ALL\n".join(parts)


@register("table_profile", _profile_sql())
def q_table_profile(spark, sf):
    p = qa.profile(load(spark, sf, "orders"), [c for c, _ in PROFILE_COLS], exact_distinct=True, future_after=PROFILE_FUTURE)
    return p.withColumns({"mean": r4("mean"), "stddev": r4("stddev")})


@register("table_profile_merged", f"""
WITH p AS ({_profile_sql()})
SELECT "column", non_null, nulls, min_value, max_value, mean, stddev, TRUE AS distinct_within, TRUE AS median_within FROM p""")
def q_table_profile_merged(spark, sf):
    """Q10: a profile kept per order status and merged from the stored parts; the sketched distinct counts lie within
    three standard errors (5 %) of the exact ones, the sketched medians within 1 % of the ranks."""
    from roaskit.sources.files import write_table
    orders, cols = load(spark, sf, "orders"), [c for c, _ in PROFILE_COLS]
    at = f"{_inbox(spark)}/parts"
    write_table(qa.profile_parts(orders, cols, by=["o_orderstatus"], future_after=PROFILE_FUTURE), at)
    p = qa.merge_profiles(spark.read.parquet(at), quartiles=True)
    exact, ranks = F.lit(0), F.lit(None).cast("array<double>")
    for c, t in PROFILE_COLS:
        exact = F.when(F.col("column") == c, orders.agg(F.count_distinct(c)).scalar()).otherwise(exact)
        if t in ("bigint", "double"):
            ranks = F.when(F.col("column") == c, orders.agg(F.percentile_approx(F.col(c).cast("double"), [0.49, 0.51], 100_000)).scalar()).otherwise(ranks)
    median = F.col("quartiles")[1]
    return p.select("column", "non_null", "nulls", "min_value", "max_value", r4("mean").alias("mean"), r4("stddev").alias("stddev"),
                    (F.abs(F.col("distinct") - exact) <= 0.05 * exact).alias("distinct_within"),
                    F.coalesce(median.between(ranks[0], ranks[1]), median.isNull()).alias("median_within"))


@register("web_sessions_hashed", """
SELECT CAST(session_id AS VARCHAR) AS session_id, sha256(CAST(user_id AS VARCHAR)) AS user_id,
  CAST(date_trunc('second', session_start) AS TIMESTAMP) AS session_start
FROM d_sessions""")
def q_web_sessions_hashed(spark, sf):
    """Q4 + Q9: session contract; valid rows are stored with the user id as SHA-256."""
    good, _ = qa.validate(ad.web_session_cells(spark, sf), qa.web_session_contract())
    return good.select("session_id", "user_id", "session_start")


@register("duplicate_rows", """
SELECT (SELECT count(*) FROM lineitem) AS total_rows, count(*) AS distinct_rows,
  (SELECT count(*) FROM lineitem) - count(*) AS duplicate_rows
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) t""")
def q_duplicate_rows(spark, sf):
    return rs.duplicate_row_count(load(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@register("unique_key_violations", """
SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_unique_key_violations(spark, sf):
    from roaskit.operators.joins import duplicate_keys
    return duplicate_keys(load(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


_RAW_MONTHLY_SQL = f"""
WITH raw AS (SELECT s.date, s.mapping_key, s.total_spend, r.net_revenue, c.value AS new_customers
  FROM d_mspend s
  LEFT JOIN d_netrev r ON s.date = r.date AND s.mapping_key = r.mapping_key
  LEFT JOIN (SELECT date, {canon('channel_name')} AS mapping_key, value FROM d_cust_new) c
    ON s.date = c.date AND s.mapping_key = c.mapping_key)
"""


def _raw_monthly(spark, sf):
    ms = _mspend(spark, sf)
    r = ch.monthly_roas(ms, ad.topsheet(spark, sf), fill_missing=False).select(
        "date", "mapping_key", "total_spend", "net_revenue")
    c = ch.monthly_cac(ms, ad.customers_new(spark, sf), fill_missing=False).select(
        "date", "mapping_key", "new_customers")
    return r.join(c, ["date", "mapping_key"], "left")


@register("imputed_flags", _RAW_MONTHLY_SQL + """
SELECT date, mapping_key, (net_revenue IS NULL OR new_customers IS NULL) AS imputed_bool,
  CAST((net_revenue IS NULL)::INTEGER + (new_customers IS NULL)::INTEGER AS INTEGER) AS null_cells FROM raw""")
def q_imputed_flags(spark, sf):
    m = _raw_monthly(spark, sf)
    cols = ["net_revenue", "new_customers"]
    return m.select("date", "mapping_key", fx.any_null(cols).alias("imputed_bool"),
                    fx.null_count(cols).alias("null_cells"))


@register("impute_mean", _RAW_MONTHLY_SQL + """
SELECT date, mapping_key, round(coalesce(new_customers, (SELECT avg(new_customers) FROM raw)), 4) AS new_customers,
  new_customers IS NULL AS imputed_customers FROM raw""")
def q_impute_mean(spark, sf):
    from roaskit.plans.impute import impute_mean
    m = impute_mean(_raw_monthly(spark, sf), ["new_customers"], flag="imputed_customers")
    return m.select("date", "mapping_key", r4("new_customers").alias("new_customers"), "imputed_customers")


# --- statistics -------------------------------------------------------------------------

from roaskit.plans import stats as st  # noqa: E402
from roaskit.plans.sqlviews import VIEW_DEPS, VIEWS  # noqa: E402

VIEWS["d_scores"] = f"""SELECT session_id, session_start, converted,
  CASE WHEN coalesce(low, false) THEN least(greatest(p * 0.1, 0.005), 1.0) ELSE p END AS score FROM (
  SELECT session_id, session_start, converted, low,
    CASE WHEN coalesce(high AND (promo OR video), false) THEN least(greatest(p + 0.5, 0.0), 1.0) ELSE p END AS p FROM (
    SELECT session_id, session_start, converted, high, promo, video, low,
      CASE WHEN coalesce(high AND promo AND video, false) THEN least(greatest(p + 0.85, 0.0), 1.0) ELSE p END AS p
    FROM (SELECT e.session_id, e.session_start, e.converted, e.effectiveness_tier = 'High' AS high,
            e.creative_theme = '{PROMO_THEME}' AS promo, e.creative_format = '{VIDEO_FORMAT}' AS video,
            e.effectiveness_tier = 'Low' AS low,
            0.02 + (e.spend - (SELECT min(spend) FROM d_enriched)) /
              ((SELECT max(spend) FROM d_enriched) - (SELECT min(spend) FROM d_enriched)) * 0.05 AS p
          FROM d_enriched e) a) b) c"""
VIEW_DEPS["d_scores"] = ["d_enriched"]
VIEWS["d_ranked"] = """SELECT session_id, session_start,
  row_number() OVER (ORDER BY session_start, session_id) AS row_rank, count(*) OVER () AS n FROM d_sessions"""
VIEW_DEPS["d_ranked"] = ["d_sessions"]


def _scores(spark, sf):
    s = creative.conversion_score(_enriched(spark, sf), promo_theme=PROMO_THEME, video_format=VIDEO_FORMAT)
    return s.select("session_id", "session_start", "converted", F.col("conversion_score").alias("score"))


@register("chronological_split", """
SELECT s.*, row_rank, CASE WHEN row_rank <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
  WHEN row_rank <= floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'tune' ELSE 'test' END AS split
FROM d_ranked r JOIN d_sessions s USING (session_id)""")
def q_chronological_split(spark, sf):
    return st.chronological_split(ad.sessions(spark, sf), ["session_start", "session_id"])


@register("chronological_split_approx")
def q_chronological_split_approx(spark, sf):
    """M2, cheap form: sketch cut points, no checkpoint; split sizes (rows-only:
    the sketch is approximate by design)."""
    s = st.approx_chronological_split(ad.sessions(spark, sf), "session_start")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


N_FOLDS = 5


@register("time_series_folds", f"""
WITH f AS (SELECT range AS fold FROM range({N_FOLDS})),
r AS (SELECT session_id, row_rank - 1 AS idx, n, n // {N_FOLDS + 1} AS ts FROM d_ranked)
SELECT r.session_id, r.idx + 1 AS row_rank, CAST(f.fold AS INTEGER) AS fold,
  CASE WHEN r.idx < r.n - ({N_FOLDS} - f.fold) * r.ts THEN 'train' ELSE 'test' END AS role
FROM r, f WHERE r.idx < r.n - ({N_FOLDS} - f.fold) * r.ts + r.ts""")
def q_time_series_folds(spark, sf):
    f = st.time_series_folds(ad.sessions(spark, sf), ["session_start", "session_id"], N_FOLDS)
    return f.select("session_id", "row_rank", "fold", "role")


_AUC_COUNTS = """g AS (SELECT score, sum(converted) AS pos, sum(1 - converted) AS neg FROM d_scores
  WHERE score IS NOT NULL GROUP BY score)"""


@register("auc_exact", f"""
WITH {_AUC_COUNTS},
c AS (SELECT score, pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg
  AS below FROM g)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 4) AS auc,
  CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM c""")
def q_auc_exact(spark, sf):
    a = st.auc_exact(_scores(spark, sf), "score", "converted")
    return a.select(r4("auc").alias("auc"), "positives", "negatives")


@register("roc_points", f"""
WITH {_AUC_COUNTS},
c AS (SELECT score, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM g
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(score, 4) AS threshold, round(cn / (SELECT sum(neg) FROM g), 4) AS fpr,
  round(cp / (SELECT sum(pos) FROM g), 4) AS tpr FROM c""")
def q_roc_points(spark, sf):
    r = st.roc_points(_scores(spark, sf), "score", "converted")
    return r.select(r4("threshold").alias("threshold"), r4("fpr").alias("fpr"), r4("tpr").alias("tpr"))


SCORE_CUTOFF = 0.05


@register("accuracy", f"""
WITH f AS (SELECT range AS fold FROM range({N_FOLDS})),
r AS (SELECT k.session_id, k.row_rank - 1 AS idx, k.n, k.n // {N_FOLDS + 1} AS ts, s.score, s.converted
      FROM d_ranked k JOIN d_scores s ON k.session_id = s.session_id)
SELECT CAST(f.fold AS INTEGER) AS fold, count(*) AS n,
  round(avg(CASE WHEN CAST(r.score >= {SCORE_CUTOFF} AS INTEGER) = r.converted THEN 1.0 ELSE 0.0 END), 4) AS accuracy
FROM r, f WHERE r.idx >= r.n - ({N_FOLDS} - f.fold) * r.ts AND r.idx < r.n - ({N_FOLDS} - f.fold) * r.ts + r.ts
GROUP BY f.fold""")
def q_accuracy(spark, sf):
    folds = st.time_series_folds(ad.sessions(spark, sf), ["session_start", "session_id"], N_FOLDS)
    test = folds.where(F.col("role") == "test").select("session_id", "fold")
    s = _scores(spark, sf).withColumn("pred", (F.col("score") >= SCORE_CUTOFF).cast("int"))
    a = st.accuracy(test.join(s, "session_id"), "pred", "converted", by=["fold"])
    return a.select("fold", "n", r4("accuracy").alias("accuracy"))


@register("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    """Poisson bootstrap of mean customer value: rows-only (resampling is hash-random)."""
    b = st.bootstrap_ci(ad.ltv(spark, sf), "predicted_ltv", "customer_id", n_resamples=1000, level=0.95, seed=42)
    return b.select(r4("point_estimate").alias("point_estimate"), r4("ci_low").alias("ci_low"),
                    r4("ci_high").alias("ci_high"), "resamples")


LTV_PROBS = [0.025, 0.25, 0.5, 0.75, 0.975]


@register("ltv_quantiles", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(v, CAST({p} AS DOUBLE)), 4) AS value "
    f"FROM (SELECT CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS v FROM events WHERE event_type = 'purchase' "
    f"GROUP BY user_id) t" for p in LTV_PROBS))
def q_ltv_quantiles(spark, sf):
    q = st.exact_quantiles(ad.ltv(spark, sf), "predicted_ltv", LTV_PROBS, tie_cols=["customer_id"])
    return q.select("p", r4("value").alias("value"))


@register("impute_iterative")
def q_impute_iterative(spark, sf):
    """Chained-regression imputation of monthly revenue and customers: rows-only."""
    from roaskit.plans.impute import impute_iterative
    m = _raw_monthly(spark, sf)
    out = impute_iterative(m, ["total_spend", "net_revenue", "new_customers"], max_iter=10)
    return out.select("date", "mapping_key", r4("total_spend").alias("total_spend"),
                      r4("net_revenue").alias("net_revenue"), r4("new_customers").alias("new_customers"),
                      "imputed_bool")


# --- features and models -----------------------------------------------------------------

from roaskit.plans import model as ml  # noqa: E402

FEATURE_LEVELS = {"utm_source": ["click", "view", "signup", "error"], "effectiveness_tier": ["Low", "Medium", "High"]}


@register("session_features", """
SELECT session_id, CAST(hour(session_start) AS INTEGER) AS hour_of_day,
  CAST(isodow(session_start) - 1 AS INTEGER) AS day_of_week, CAST(month(session_start) AS INTEGER) AS month,
  round(coalesce(spend, 0.0), 4) AS spend,
  CASE WHEN utm_source = 'click' THEN 1 ELSE 0 END AS utm_source_click,
  CASE WHEN utm_source = 'view' THEN 1 ELSE 0 END AS utm_source_view,
  CASE WHEN utm_source = 'signup' THEN 1 ELSE 0 END AS utm_source_signup,
  CASE WHEN utm_source = 'error' THEN 1 ELSE 0 END AS utm_source_error,
  CASE WHEN effectiveness_tier = 'Low' THEN 1 ELSE 0 END AS effectiveness_tier_Low,
  CASE WHEN effectiveness_tier = 'Medium' THEN 1 ELSE 0 END AS effectiveness_tier_Medium,
  CASE WHEN effectiveness_tier = 'High' THEN 1 ELSE 0 END AS effectiveness_tier_High,
  CASE WHEN utm_source IS NULL THEN 1 ELSE 0 END AS utm_source_nan,
  CASE WHEN effectiveness_tier IS NULL THEN 1 ELSE 0 END AS effectiveness_tier_nan
FROM d_enriched""")
def q_session_features(spark, sf):
    f, feats = ml.build_features(_enriched(spark, sf), FEATURE_LEVELS, keep=["session_id"])
    return f.withColumn("spend", r4("spend"))


def _long_features_sql() -> str:
    """Rows (session_id, feature, value): numbers, each categorical's levels in the data, and its NULL indicator."""
    numbers = {"hour_of_day": "hour(session_start)", "day_of_week": "isodow(session_start) - 1", "month": "month(session_start)",
               "spend": "round(coalesce(spend, 0.0), 4)"}
    parts = [f"SELECT session_id, '{n}' AS feature, CAST({x} AS DOUBLE) AS value FROM d_enriched" for n, x in numbers.items()]
    for c in ml.CATEGORICALS:
        parts += [f"SELECT session_id, '{c}_' || l, CASE WHEN {c} = l THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM d_enriched "
                  f"CROSS JOIN (SELECT DISTINCT {c} AS l FROM d_enriched WHERE {c} IS NOT NULL)",
                  f"SELECT session_id, '{c}_nan', CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM d_enriched"]
    return "\nUNION ALL ".join(parts)


@register("session_features_long", _long_features_sql())
def q_session_features_long(spark, sf):
    """M1 over all of the models' categoricals, with the levels that occur, as one row per session and feature."""
    from roaskit.operators.reshape import discover_levels
    e = _enriched(spark, sf)
    f, feats = ml.build_features(e, discover_levels(e, ml.CATEGORICALS), keep=["session_id"])
    f = f.withColumn("spend", r4("spend"))
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("value")) for n in feats])
    return f.select("session_id", F.inline(pairs))


@register("one_hot_features", """
SELECT session_id, CASE WHEN utm_medium = 'cpc' THEN 1 ELSE 0 END AS utm_medium_cpc,
  CASE WHEN utm_medium = 'social_paid' THEN 1 ELSE 0 END AS utm_medium_social_paid,
  0 AS utm_medium_email,
  CASE WHEN utm_medium IS NULL THEN 1 ELSE 0 END AS utm_medium_nan FROM d_sessions""")
def q_one_hot_features(spark, sf):
    """R6 + R7: one-hot with a NULL indicator, aligned to a fixed feature list
    (a level absent from the list is dropped, a listed column absent from the
    data is 0)."""
    from roaskit.operators.reshape import align_features, one_hot
    s = one_hot(ad.sessions(spark, sf), {"utm_medium": ["cpc", "social_paid", "organic", "referral"]})
    feats = ["utm_medium_cpc", "utm_medium_social_paid", "utm_medium_email", "utm_medium_nan"]
    return align_features(s, feats, keep=["session_id"])


# --- fixed values: chosen parameters of the published study (the column share becomes a
# featureSubsetStrategy fraction; the split penalty gamma has no GBT twin).
GBT_PARAMS = {"maxIter": 184, "maxDepth": 6, "stepSize": 0.1842, "subsamplingRate": 0.7886,
              "featureSubsetStrategy": "0.8096"}


def _trained(spark, sf):
    """The conversion model on train + tune."""
    split, feats = _model_frames(spark, sf)
    model = ml.fit_dealt(ml.gbt_pipeline(feats, **GBT_PARAMS), split.where(F.col("split") != "test"))
    return split, feats, model


ORDER = ["session_start", "session_id"]


def _enriched_once(spark, sf):
    """What features are made of, for every session, and in how many tasks to number the rows.  Levels, order and features
    are all made of these rows: they are written once, in tasks cut by rows, and put in order before the features widen them."""
    from roaskit.session import ensure_checkpoint_dir
    sessions, orders = ad.sessions(spark, sf), ad.orders(spark, sf)
    tasks = ml.frame_tasks(spark, sessions.count() + orders.count())
    e = creative.enrich_sessions(sessions, ad.campaigns(spark, sf), orders, tasks)
    ensure_checkpoint_dir(spark)
    return e.select("session_id", "session_start", "spend", "converted", *ml.CATEGORICALS).checkpoint(), tasks


def _features(e, placed, places):
    """The features of the rows of ``placed``, made of ``e``, beside the columns ``places``; and their names."""
    from roaskit.operators.reshape import discover_levels
    return ml.build_features(placed, discover_levels(e, ml.CATEGORICALS), keep=["session_id", "session_start", "converted", *places])


def _model_frames(spark, sf):
    e, tasks = _enriched_once(spark, sf)
    return _features(e, st.chronological_split(e, ORDER, partitions=tasks), [ml.RANK, "split"])


@register("conversion_model_auc")
def q_conversion_model_auc(spark, sf):
    """M4 + M6: GBT fitted on train + tune, exact AUC on the time-ordered test split (rows-only)."""
    split, feats, model = _trained(spark, sf)
    test = split.where(F.col("split") == "test")
    scored = ml.positive_probability(model.transform(test)).select("p_convert", "converted")
    return st.auc_exact(scored, "p_convert", "converted", ml.fit_tasks(test))


@register("param_search")
def q_param_search(spark, sf):
    """M5: seeded random search, hold-out AUC per trial (rows-only)."""
    split, feats = _model_frames(spark, sf)
    return ml.search_params(split.where(F.col("split") == "train"), split.where(F.col("split") == "tune"),
                            feats)


@register("param_search_cv")
def q_param_search_cv(spark, sf):
    """M5 + M3: random search scored by mean AUC over expanding time folds (rows-only)."""
    e, tasks = _enriched_once(spark, sf)
    folds, feats = _features(e, st.time_series_folds(e, ORDER, 5, partitions=tasks), [ml.RANK, "fold", "role"])
    return ml.search_params_cv(folds, feats)


@register("param_search_halving")
def q_param_search_halving(spark, sf):
    """M5 + M4 + M6: successive halving over all trials, each fit scored at several tree counts; the best trial's
    parameters are fitted on train + tune, and its row holds the exact AUC on test (rows-only)."""
    split, feats = _model_frames(spark, sf)
    parts = [(split.where(F.col("split") == "train"), split.where(F.col("split") == "tune"))]
    found = ml.search_params_halving(parts, feats)
    best = ml.best_trial(found)
    auc = ml.fitted_auc(split.where(F.col("split") != "test"), split.where(F.col("split") == "test"), feats, ml.best_params(found))
    return found.withColumn("test_auc", F.when(F.col("trial") == best["trial"], F.lit(auc).cast("double")))


@register("feature_importance")
def q_feature_importance(spark, sf):
    """M9: top 15 importances (rows-only)."""
    split, feats, model = _trained(spark, sf)
    return ml.feature_importance(model, feats, 15)


@register("lift_forecast")
def q_lift_forecast(spark, sf):
    """M10 + M11: save / load the pipeline, then score every session at five
    budget increases (rows-only)."""
    import uuid
    from roaskit.session import ensure_checkpoint_dir
    split, feats, model = _trained(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    ml.save_model(model, path)
    loaded, loaded_feats = ml.load_model(path)
    assert loaded_feats == feats
    return ml.lift_forecast(loaded, split, ad.orders(spark, sf))


@register("logistic_baseline")
def q_logistic_baseline(spark, sf):
    """M8 + M3 + M7 + M12: low-ROAS label, logistic regression per expanding
    time fold, accuracy per fold (rows-only)."""
    t = ch.low_roas_label(_trends(spark, sf))
    feats = ["total_spend", "net_revenue", "monthly_roas", "monthly_cac"]
    folds = st.time_series_folds(t, ["date", "mapping_key"], N_FOLDS).persist()
    rows = []
    for i in range(N_FOLDS):
        tr = folds.where((F.col("fold") == i) & (F.col("role") == "train"))
        te = folds.where((F.col("fold") == i) & (F.col("role") == "test"))
        m = ml.logistic_pipeline(feats, "churned").fit(tr)
        rows.append(st.accuracy(m.transform(te), "prediction", "churned").withColumn("fold", F.lit(i)))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("fold", "n", r4("accuracy").alias("accuracy"))


# --- streaming ingestion -------------------------------------------------------------------

@register("ingest_stream_result", _ORDER_LINES_SQL + """
SELECT order_id, customer_id, order_datetime, sku, qty, round(unit_price, 4) AS unit_price,
  round(discount, 4) AS discount FROM chk WHERE errors = ''""")
def q_ingest_stream_result(spark, sf):
    """S5 + S6 + S8 + T1 + T2: the order lines are dropped as CSV files in an
    inbox under the shared checkpoint folder, ingested by the stream, and the
    master table read back; it must equal the batch validation.  No key
    dedup here: (order, line number) repeats in the driver data, so a key
    anti join would drop distinct rows; replays are made safe by the
    commit log instead."""
    import uuid
    from roaskit.session import ensure_checkpoint_dir
    from roaskit.sources.master import read_committed
    from roaskit.streaming.ingest import run_available
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest/{uuid.uuid4().hex}"
    ad.order_lines(spark, sf).write.option("header", True).csv(f"{root}/inbox")
    run_available(spark, f"{root}/inbox", order_line_contract(MIN_QTY, MAX_DISCOUNT), f"{root}/master",
                  f"{root}/quarantine", f"{root}/_checkpoint", archive=f"{root}/archive")
    m = read_committed(spark, f"{root}/master")
    return m.select("order_id", "customer_id", "order_datetime", "sku", "qty",
                    r4("unit_price").alias("unit_price"), r4("discount").alias("discount"))


def _inbox(spark) -> str:
    import uuid
    from roaskit.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest/{uuid.uuid4().hex}"


@register("ingest_mixed_inbox", _ORDER_LINES_SQL + """
SELECT 'order_lines' AS kind, order_id AS id, qty, round(unit_price, 4) AS unit_price, errors FROM chk
UNION ALL SELECT 'web_sessions', CAST(session_id AS VARCHAR), NULL, NULL, '' FROM d_sessions
UNION ALL SELECT 'unrouted', c_custkey || ',' || c_mktsegment, NULL, NULL, 'unknown_header' FROM customer""")
def q_ingest_mixed_inbox(spark, sf):
    """S8 + T1 + Q1: order lines under two header orders (one with an alias), web sessions, and files of a third kind,
    all in one inbox; every row comes back from the table it was sent to."""
    from roaskit.sources.master import log_of, read_committed
    from roaskit.streaming.ingest import run_available
    root = _inbox(spark)
    lines = ad.order_lines(spark, sf, extra=["l_returnflag"])
    names = [c for c in lines.columns if c != "l_returnflag"]
    turned = [F.col("order_datetime").alias("datetime"), *[F.col(c) for c in reversed(names) if c != "order_datetime"]]
    parts = {"lines": lines.where("l_returnflag <> 'R'").select(*names), "turned": lines.where("l_returnflag = 'R'").select(*turned),
             "sessions": ad.web_session_cells(spark, sf), "personas": ad.personas(spark, sf)}
    for name, part in parts.items():
        part.write.option("header", True).csv(f"{root}/inbox/{name}")
    run_available(spark, f"{root}/inbox/*", [order_line_contract(MIN_QTY, MAX_DISCOUNT), qa.web_session_contract()],
                  f"{root}/master", f"{root}/quarantine", f"{root}/_checkpoint")
    none, number = F.array().cast("array<string>"), F.lit(None).cast("bigint")
    def rows(table, kind, key, errors, lines=False):
        return read_committed(spark, f"{root}/{table}", log_of(f"{root}/master")).select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), (F.col("qty") if lines else number).alias("qty"),
            (r4("unit_price") if lines else F.lit(None).cast("double")).alias("unit_price"), F.concat_ws(";", errors).alias("errors"))
    out = rows("master/order_lines", "order_lines", "order_id", none, True)
    for other in (rows("quarantine/order_lines", "order_lines", "order_id", "errors", True),
                  rows("master/web_sessions", "web_sessions", "session_id", none),
                  rows("quarantine/web_sessions", "web_sessions", "session_id", "errors"),
                  rows("quarantine/unrouted", "unrouted", "raw", "errors")):
        out = out.unionByName(other)
    return out


@register("ingest_dedup", _ORDER_LINES_SQL + """
SELECT split_part(order_id, '-', 1) AS order_id, sku, qty, CASE WHEN row_number() OVER (
  PARTITION BY split_part(order_id, '-', 1) ORDER BY customer_id, order_datetime, sku, qty, unit_price, discount) > 1
  THEN 'duplicate_key' ELSE '' END AS errors FROM chk WHERE errors = ''""")
def q_ingest_dedup(spark, sf):
    """S6 + Q7: order lines under one key per order; the first line stays and the others are in quarantine."""
    from roaskit.sources.master import log_of, read_committed
    from roaskit.streaming.ingest import run_available
    root = _inbox(spark)
    lines = ad.order_lines(spark, sf).withColumn("order_id", F.substring_index("order_id", "-", 1))
    lines.write.option("header", True).csv(f"{root}/inbox")
    run_available(spark, f"{root}/inbox", order_line_contract(MIN_QTY, MAX_DISCOUNT), f"{root}/master", f"{root}/quarantine",
                  f"{root}/_checkpoint", dedup_key=["order_id"])
    kept = read_committed(spark, f"{root}/master").select("order_id", "sku", "qty", F.lit("").alias("errors"))
    twice = read_committed(spark, f"{root}/quarantine", log_of(f"{root}/master")).where(F.array_contains("errors", "duplicate_key"))
    return kept.unionByName(twice.select("order_id", "sku", "qty", F.concat_ws(";", "errors").alias("errors")))


# --- scaling and analysis period ---------------------------------------------------------

@register("spend_scaled", """
SELECT campaign_id, round((spend - (SELECT min(spend) FROM d_campaigns))
  / ((SELECT max(spend) FROM d_campaigns) - (SELECT min(spend) FROM d_campaigns)), 4) AS spend_scaled
FROM d_campaigns""")
def q_spend_scaled(spark, sf):
    """min-max scaled campaign spend."""
    from roaskit.operators.reshape import min_max_scale
    s = min_max_scale(ad.campaigns(spark, sf), "spend", "spend_scaled")
    return s.select("campaign_id", r4("spend_scaled").alias("spend_scaled"))


@register("analysis_end", """
SELECT CAST(date_trunc('month', min(last_month)) + INTERVAL 1 MONTH AS DATE) AS analysis_end FROM (
  SELECT max(date) AS last_month FROM d_media_spend WHERE value <> 0
  UNION ALL SELECT max(date) FROM d_cust_new WHERE value <> 0) t""")
def q_analysis_end(spark, sf):
    """Q13 option: the first month after the last complete month of every input."""
    end = ch.complete_period_end((ad.media_spend(spark, sf), "date", "value"),
                                 (ad.customers_new(spark, sf), "date", "value"))
    # one row: an aggregate over the whole table carries the scalar
    return ad.customers_new(spark, sf).agg(F.count(F.lit(1)).alias("_n")).select(end.alias("analysis_end"))


from roaskit.plans import catalog_more  # noqa: E402, F401  (registers further queries)
