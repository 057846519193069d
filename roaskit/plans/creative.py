"""Creative performance (D1-D7, D22): attribution, ROAS / CAC by creative tag,
roll-ups and payback, all as one lazy plan per output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaskit.functions.scalars import clip, exact_sum, safe_ratio, whole_days_between
from roaskit.operators.joins import asof_join
from roaskit.operators.ordering import running_totals


def attribute_last_touch(orders: DataFrame, sessions: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each order goes to the same user's latest session starting at or
    before the order; orders with no such session are dropped (one row per order)."""
    return asof_join(orders, sessions.select("user_id", "session_id", "session_start"),
                     by="user_id", left_ts="order_datetime", right_ts="session_start",
                     right_cols=["session_id", "session_start"], tie_col="session_id",
                     how="inner", partitions=partitions)


def session_revenue(attributed: DataFrame) -> DataFrame:
    """Revenue and order count per attributed session."""
    return attributed.groupBy("session_id").agg(
        exact_sum("gross_revenue").alias("gross_revenue"), F.count(F.lit(1)).alias("orders"))


def enrich_sessions(sessions: DataFrame, campaigns: DataFrame, orders: DataFrame, partitions: int | None = None) -> DataFrame:
    """D2 + J1: sessions with campaign attributes, attributed revenue (0 when
    none) and ``converted`` (1 when some order is attributed to the session).

    Campaigns are a dimension; Spark broadcasts them when their size is under
    the broadcast threshold and AQE re-plans at run time otherwise, so the join
    survives a campaign table of any size.  ``partitions`` are those of the attribution.
    """
    rev = session_revenue(attribute_last_touch(orders, sessions, partitions))
    s = sessions.join(campaigns, "campaign_id", "left")
    s = s.join(rev, "session_id", "left")
    return s.withColumns({
        "gross_revenue": F.coalesce(F.col("gross_revenue"), F.lit(0.0)),
        "converted": F.when(F.col("orders") > 0, 1).otherwise(0),
    }).drop("orders")


def campaign_runs(campaigns: DataFrame, sessions: DataFrame) -> DataFrame:
    """``campaigns`` with ``end_date``, the day of a campaign's last session, but not before its start (its start, if
    it has no session).  ``sessions`` are all of them, not those of a filtered range."""
    last = (sessions.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id")
            .agg(F.max("session_start").cast("date").alias("_last")))
    return (campaigns.join(last, "campaign_id", "left")
            .withColumn("end_date", F.greatest("start_date", "_last")).drop("_last"))


def spend_share(start, end, lo=None, hi=None) -> F.Column:
    """The share of a campaign's days (start to end, both included) that lie in ``lo`` to ``hi`` (both included; None:
    unbounded).  A day counts as much as any other; with no start, no end or an end before the start it is 1."""
    start, end = F.col(start), F.col(end)
    first = start if lo is None else F.greatest(start, F.lit(str(lo)[:10]).cast("date"))
    last = end if hi is None else F.least(end, F.lit(str(hi)[:10]).cast("date"))
    known = start.isNotNull() & end.isNotNull() & (start <= end)
    inside = F.greatest(F.date_diff(last, first) + 1, F.lit(0))
    return F.when(known, inside / (F.date_diff(end, start) + 1)).otherwise(F.lit(1.0))


def campaign_summary(enriched: DataFrame, prorate: tuple | None = None) -> DataFrame:
    """D3: revenue and conversions per campaign; spend counted once per campaign
    that has a session in ``enriched`` (already filtered by the caller).

    Spend, format and theme come from the campaign dimension (one row per
    campaign id), so grouping by them together with the id equals "distinct
    campaigns joined to per-campaign sums" -- in one shuffle instead of three.

    With ``prorate=(lo, hi)``, the range of days that the caller filtered by, a
    campaign's spend is allocated evenly to its days and only those in the range
    count; ``enriched`` then holds ``start_date`` and ``end_date`` (``campaign_runs``).
    """
    keys = ["campaign_id", "spend", "creative_format", "creative_theme"]
    days = [] if prorate is None else ["start_date", "end_date"]
    out = (enriched.where(F.col("campaign_id").isNotNull()).groupBy(*keys, *days)
           .agg(exact_sum("gross_revenue").alias("total_revenue"), F.sum("converted").alias("total_conversions")))
    if prorate is None:
        return out
    return out.withColumn("spend", F.col("spend") * spend_share(*days, *prorate)).drop(*days)


def creative_summary(enriched: DataFrame, prorate: tuple | None = None) -> DataFrame:
    """Spend, revenue, conversions per (format, theme); roas, cac, roas_display.  ``prorate`` as in ``campaign_summary``."""
    c = campaign_summary(enriched, prorate)
    g = (c.where(F.col("creative_format").isNotNull() & F.col("creative_theme").isNotNull())
         .groupBy("creative_format", "creative_theme")
         .agg(exact_sum("spend").alias("total_spend"), exact_sum("total_revenue").alias("total_revenue"),
              F.sum("total_conversions").alias("total_conversions")))
    roas = safe_ratio("total_revenue", "total_spend")
    return g.withColumns({
        "roas": roas,
        "cac": safe_ratio("total_spend", "total_conversions"),
        "roas_display": clip(roas, lower=0.01),
    })


def creative_rollup(enriched: DataFrame) -> DataFrame:
    """Theme -> format hierarchy with subtotals.

    ``level`` is 0 for (theme, format) leaves, 1 for theme subtotals and 2 for
    the grand total; ``share_of_parent`` is revenue over the parent's revenue;
    ``weighted_roas`` is the revenue-weighted mean of leaf ``roas_display``;
    ROAS and CAC are shown only on leaves.
    """
    leaves = creative_summary(enriched).withColumn("_wr", F.col("roas_display") * F.col("total_revenue"))
    r = leaves.rollup("creative_theme", "creative_format").agg(
        exact_sum("total_spend").alias("total_spend"), exact_sum("total_revenue").alias("total_revenue"),
        F.sum("total_conversions").alias("total_conversions"), F.sum("_wr").alias("_wr"),
        F.grouping_id().alias("level"))
    r = r.withColumn("level", F.when(F.col("level") == 0, 0).when(F.col("level") == 1, 1).otherwise(2))
    # parent of a leaf = its theme subtotal (a window per theme over the roll-up output);
    # parent of a theme subtotal = the roll-up's own grand total (a window over the subtotals alone; leaves stay apart)
    parent_rev = F.sum(F.when(F.col("level") == 1, F.col("total_revenue"))).over(Window.partitionBy("creative_theme"))
    apart = F.when(F.col("level") == 0, F.xxhash64("creative_theme", "creative_format"))
    total_rev = F.sum(F.when(F.col("level") == 2, F.col("total_revenue"))).over(Window.partitionBy(apart))
    r = r.withColumns({
        "weighted_roas": F.when(F.col("total_revenue") > 0, F.col("_wr") / F.col("total_revenue")),
        "share_of_parent": F.when(F.col("level") == 0, safe_ratio(F.col("total_revenue"), parent_rev))
                           .when(F.col("level") == 1, safe_ratio(F.col("total_revenue"), total_rev))
                           .otherwise(F.lit(1.0)),
        "roas": F.when(F.col("level") == 0, safe_ratio("total_revenue", "total_spend")),
        "cac": F.when(F.col("level") == 0, safe_ratio("total_spend", "total_conversions")),
    })
    return r.drop("_wr")


def payback_curve(enriched: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per campaign, sessions at or after launch in time order with days
    since launch and cumulative revenue; campaigns whose revenue is 0 are left out.

    All campaigns at once.  The running sum is a grouped ``running_totals``
    (range partitioning on campaign, time, session), so a campaign holding a
    third of all sessions is still spread over many tasks.
    """
    c = campaigns.select("campaign_id", F.col("start_date").alias("_launch"), F.col("spend").alias("campaign_spend"))
    s = (enriched.select("campaign_id", "session_id", "session_start", "gross_revenue")
         .join(c, "campaign_id")
         .where(F.col("session_start") >= F.col("_launch").cast("timestamp_ntz")))
    s = s.withColumn("days_since_launch", whole_days_between("session_start", "_launch"))
    cum, _ = running_totals(s, ["session_start", "session_id"], ["gross_revenue"], prefix="_cum_",
                            group_cols=["campaign_id"])
    # from the checkpointed frame, so the attribution runs once; a campaign's totals are a small table
    paying = cum.groupBy("campaign_id").agg(F.sum("gross_revenue").alias("_total")).where(F.col("_total") > 0)
    cum = cum.join(paying.select("campaign_id"), "campaign_id", "left_semi")
    return cum.select("campaign_id", "session_id", "session_start", "days_since_launch", "gross_revenue",
                      F.col("_cum_gross_revenue").alias("cumulative_revenue"), "campaign_spend")


def payback_period(curve: DataFrame) -> DataFrame:
    """First day on which cumulative revenue reaches spend (NULL = never)."""
    return curve.groupBy("campaign_id").agg(
        F.first("campaign_spend").alias("campaign_spend"),
        F.max("cumulative_revenue").alias("final_revenue"),
        F.min(F.when(F.col("cumulative_revenue") >= F.col("campaign_spend"), F.col("days_since_launch")))
         .alias("payback_day"))


# --- fixed values of the conversion scoring rule ----------------------------
SCORE_BASE = 0.02
SCORE_SPEND_WEIGHT = 0.05
SCORE_GOLDEN_BOOST = 0.85
SCORE_SECONDARY_BOOST = 0.50
SCORE_LOW_TIER_FACTOR = 0.1
SCORE_LOW_TIER_FLOOR = 0.005
# ---------------------------------------------------------------------------


def conversion_score(sessions: DataFrame, promo_theme: str = "Promo / Sale", video_format: str = "video",
                     high_tier: str = "High", low_tier: str = "Low") -> DataFrame:
    """Deterministic rule score in [0, 1], applied in this order:

    base + weight x min-max scaled spend; golden path (high tier, promo theme
    and video format) + boost, clipped; secondary path (high tier and promo or
    video -- golden rows match too) + boost, clipped; low tier x factor,
    clipped to [floor, 1].  A session without spend has no score.  The spend
    bounds are scalar subqueries (``DataFrame.scalar``), not a cross join.
    """
    bounds = sessions.agg(F.struct(F.min("spend").alias("lo"), F.max("spend").alias("hi"))).scalar()
    # attach the scalar subquery once as a column; every later step reads the column
    out = sessions.withColumn("_b", bounds)
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    tier, theme, fmt = F.col("effectiveness_tier"), F.col("creative_theme"), F.col("creative_format")
    high = F.coalesce(tier == high_tier, F.lit(False))
    promo = F.coalesce(theme == promo_theme, F.lit(False))
    video = F.coalesce(fmt == video_format, F.lit(False))
    out = out.withColumn("_p", F.lit(SCORE_BASE) + F.try_divide(F.col("spend") - lo, hi - lo) * F.lit(SCORE_SPEND_WEIGHT))
    p = F.col("_p")
    out = out.withColumn("_p", F.when(high & promo & video, clip(p + SCORE_GOLDEN_BOOST, 0.0, 1.0)).otherwise(p))
    out = out.withColumn("_p", F.when(high & (promo | video), clip(p + SCORE_SECONDARY_BOOST, 0.0, 1.0)).otherwise(p))
    out = out.withColumn("_p", F.when(F.coalesce(tier == low_tier, F.lit(False)),
                                      clip(p * SCORE_LOW_TIER_FACTOR, SCORE_LOW_TIER_FLOOR, 1.0)).otherwise(p))
    return out.withColumn("conversion_score", F.col("_p")).drop("_b", "_p")
