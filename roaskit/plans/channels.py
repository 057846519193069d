"""Channel profitability (D8-D17): agency-fee-corrected ROAS, monthly spend,
ROAS and CAC trends, overall CAC, KPIs and the customer mix.

One ``canonical_channel`` key is used on every side, so ``Affiliate Media``,
``Affiliate Agency``, ``affiliate`` and ``affiliates`` meet in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.functions.scalars import canonical_channel, exact_sum, metric_channel, month_start, safe_ratio, spend_kind

TREND_CHANNELS = ["paid search", "paid social", "affiliates"]


def _spend_rows(media_spend: DataFrame) -> DataFrame:
    return media_spend.select("date", canonical_channel("channel_name").alias("mapping_key"),
                              spend_kind("channel_name").alias("kind"), "value")


def channel_roas(breakdown: DataFrame, media_spend: DataFrame) -> DataFrame:
    """Ad spend + agency fees -> true spend; corrected ROAS = revenue / true spend (0 when no spend)."""
    fees = (_spend_rows(media_spend).where(F.col("kind") == "agency")
            .groupBy("mapping_key").agg(exact_sum("value").alias("agency_fees")))
    summary = breakdown.groupBy("marketing_channel").agg(
        exact_sum("ad_spend").alias("total_ad_spend"), exact_sum("`gross_discount_(shopify)`").alias("total_revenue"))
    j = summary.join(fees, canonical_channel("marketing_channel") == fees.mapping_key, "left")
    j = j.withColumn("agency_fees", F.coalesce(F.col("agency_fees"), F.lit(0.0)))
    j = j.withColumn("true_total_ad_spend", F.col("total_ad_spend") + F.col("agency_fees"))
    j = j.withColumn("corrected_roas", safe_ratio("total_revenue", "true_total_ad_spend"))
    return j.select("marketing_channel", "total_ad_spend", "total_revenue", "mapping_key", "agency_fees",
                    "true_total_ad_spend", "corrected_roas")


def monthly_spend(media_spend: DataFrame) -> DataFrame:
    """Media spend + same-month agency fee per channel.

    A conditional aggregation in one shuffle instead of the media x agency
    self join; rows exist where the channel has a media line that month.
    """
    g = _spend_rows(media_spend).groupBy("date", "mapping_key").agg(
        exact_sum(F.when(F.col("kind") == "media", F.col("value"))).alias("value_media"),
        exact_sum(F.when(F.col("kind") == "agency", F.col("value"))).alias("value_agency"),
        F.count_if(F.col("kind") == "media").alias("_n_media"))
    g = g.where(F.col("_n_media") > 0).withColumn("value_agency", F.coalesce(F.col("value_agency"), F.lit(0.0)))
    return g.select("date", "mapping_key", "value_media", "value_agency",
                    (F.col("value_media") + F.col("value_agency")).alias("total_spend"))


def apply_spend_overrides(spend: DataFrame, overrides: DataFrame) -> DataFrame:
    """Where total spend is 0, use the same month and channel's override (else 0)."""
    o = overrides.select(month_start("month").alias("_month"), canonical_channel("channel").alias("_key"),
                         "spend_override")
    j = spend.join(o, (month_start("date") == o._month) & (spend.mapping_key == o._key), "left")
    total = F.when(F.col("total_spend") == 0, F.col("spend_override")).otherwise(F.col("total_spend"))
    return j.withColumn("total_spend", F.coalesce(total.cast("double"), F.lit(0.0))).drop("_month", "_key",
                                                                                          "spend_override")


def net_revenue(topsheet: DataFrame) -> DataFrame:
    """per channel-month net sales from the ``NET SALES - <channel>`` metrics."""
    return (topsheet.where(F.coalesce(F.col("metric").startswith("NET SALES -"), F.lit(False)))
            .select("date", metric_channel("metric").alias("mapping_key"), F.col("value").alias("net_revenue")))


def monthly_roas(spend: DataFrame, topsheet: DataFrame, fill_missing: bool = True) -> DataFrame:
    """Net sales / spend per channel-month.  ``imputed_revenue`` flags
    months without a revenue line; they count as 0 unless ``fill_missing`` is
    False (then impute first, see ``roaskit.plans.impute``)."""
    j = spend.join(net_revenue(topsheet), ["date", "mapping_key"], "left")
    j = j.withColumn("imputed_revenue", F.col("net_revenue").isNull())
    if fill_missing:
        j = j.withColumn("net_revenue", F.coalesce(F.col("net_revenue"), F.lit(0.0)))
    return j.withColumn("monthly_roas", safe_ratio("net_revenue", "total_spend"))


def monthly_cac(spend: DataFrame, customers_new: DataFrame, fill_missing: bool = True) -> DataFrame:
    """Spend / new customers per channel-month."""
    c = customers_new.select("date", canonical_channel("channel_name").alias("mapping_key"),
                             F.col("value").alias("new_customers"))
    j = spend.join(c, ["date", "mapping_key"], "left")
    j = j.withColumn("imputed_customers", F.col("new_customers").isNull())
    if fill_missing:
        j = j.withColumn("new_customers", F.coalesce(F.col("new_customers"), F.lit(0.0)))
    return j.withColumn("monthly_cac", safe_ratio("total_spend", "new_customers"))


def monthly_trends(spend: DataFrame, topsheet: DataFrame, customers_new: DataFrame,
                   channels=TREND_CHANNELS, end=None, positive_spend: bool = False) -> DataFrame:
    """ROAS and CAC per channel-month for the trend channels, with both
    imputation flags kept (the CAC flag is not lost in the final join).

    One chain -- spend, then net revenue, then new customers, both left joins
    on (date, channel) -- so the spend side is built and shuffled once.
    """
    c = customers_new.select("date", canonical_channel("channel_name").alias("mapping_key"),
                             F.col("value").alias("new_customers"))
    t = spend.select("date", "mapping_key", "total_spend")
    if channels:
        t = t.where(F.col("mapping_key").isin(list(channels)))
    if end is not None:
        t = t.where(F.col("date") < F.lit(end).cast("date"))
    t = t.join(net_revenue(topsheet), ["date", "mapping_key"], "left").join(c, ["date", "mapping_key"], "left")
    t = t.withColumns({"imputed_revenue": F.col("net_revenue").isNull(),
                       "imputed_customers": F.col("new_customers").isNull()})
    t = t.withColumns({"net_revenue": F.coalesce(F.col("net_revenue"), F.lit(0.0)),
                       "new_customers": F.coalesce(F.col("new_customers"), F.lit(0.0))})
    t = t.withColumns({"monthly_roas": safe_ratio("net_revenue", "total_spend"),
                       "monthly_cac": safe_ratio("total_spend", "new_customers")})
    if positive_spend:
        t = t.where(F.col("total_spend") > 0)
    return t.select("date", "mapping_key", "total_spend", "net_revenue", "imputed_revenue", "monthly_roas",
                    "new_customers", "imputed_customers", "monthly_cac")


def monthly_trends_imputed(spend: DataFrame, topsheet: DataFrame, customers_new: DataFrame,
                           channels=TREND_CHANNELS, max_iter: int = 10) -> DataFrame:
    """D11-D13 with I1 / I2 (the data-preparation flow): months without a
    revenue line get revenue by chained regression on spend, months without a
    customer count get the mean count; each gap keeps its own flag
    (``imputed_revenue``, ``imputed_customers``), set before filling; ratios
    are computed after imputation, and every row is returned for validation."""
    from roaskit.plans.impute import impute_iterative, impute_mean
    roas = monthly_roas(spend, topsheet, fill_missing=False).select(
        "date", "mapping_key", "total_spend", "net_revenue")
    roas = impute_iterative(roas, ["net_revenue", "total_spend"], max_iter=max_iter, flag="imputed_revenue")
    roas = roas.withColumn("monthly_roas", safe_ratio("net_revenue", "total_spend"))
    cac = monthly_cac(spend, customers_new, fill_missing=False).select("date", "mapping_key", "total_spend",
                                                                       "new_customers")
    cac = impute_mean(cac, ["new_customers"], flag="imputed_customers")
    cac = cac.withColumn("monthly_cac", safe_ratio("total_spend", "new_customers")).drop("total_spend")
    t = roas.join(cac, ["date", "mapping_key"], "left")
    return t.where(F.col("mapping_key").isin(list(channels))) if channels else t


def cap_period(df: DataFrame, date_col: str, end) -> DataFrame:
    """Q13: keep rows strictly before ``end`` (the first incomplete month);
    ``end`` is a date string or a column such as ``complete_period_end(...)``."""
    bound = end if isinstance(end, F.Column) else F.lit(end).cast("date")
    return df.where(F.col(date_col) < bound)


def complete_period_end(*series) -> F.Column:
    """Q13 option: the analysis end = the month after the earliest of each
    table's last month with a non-zero value.  ``series`` are
    ``(df, date_col, value_col)`` triples; the result is one scalar-subquery
    column usable in ``cap_period``-style filters."""
    lasts = [df.where(F.col(v) != 0).agg(F.max(F.col(d)).alias("_last")) for df, d, v in series]
    u = lasts[0]
    for x in lasts[1:]:
        u = u.unionByName(x)
    return u.agg(F.add_months(F.trunc(F.min("_last"), "month"), 1)).scalar()


def overall_cac(media_spend: DataFrame, customers_new: DataFrame, end) -> DataFrame:
    """(media + agency) / new customers per channel over one capped period;
    only channels with ``cac > 0``."""
    s = _spend_rows(cap_period(media_spend, "date", end))
    spend = s.groupBy("mapping_key").agg(exact_sum("value").alias("total_spend"))
    cust = (cap_period(customers_new, "date", end)
            .groupBy(canonical_channel("channel_name").alias("mapping_key"))
            .agg(exact_sum("value").alias("total_new_customers")))
    j = spend.join(cust, "mapping_key", "full")
    j = j.withColumn("cac", safe_ratio("total_spend", "total_new_customers"))
    return (j.where(F.col("cac") > 0)
             .select(F.col("mapping_key").alias("channel"), "total_spend", "total_new_customers", "cac"))


def kpi_summary(roas: DataFrame, cac: DataFrame) -> DataFrame:
    """One row: total revenue, blended ROAS (channels with spend), blended
    CAC, new customers, best-ROAS and lowest-CAC channel.  The CAC figures are
    scalar subqueries, so no cross join is planned."""
    c = cac.agg(F.struct(exact_sum("total_new_customers").alias("new"), exact_sum("total_spend").alias("spend"),
                         F.min_by("channel", F.struct("cac", "channel")).alias("lowest"))).scalar()
    k = roas.agg(
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum(F.when(F.col("true_total_ad_spend") > 0, F.col("true_total_ad_spend"))).alias("_spend"),
        F.max_by("marketing_channel", F.struct("corrected_roas", "marketing_channel")).alias("best_roas_channel"))
    k = k.withColumn("_c", c)  # the CAC-side subquery, referenced once
    return k.select(
        "total_revenue",
        safe_ratio("total_revenue", "_spend").alias("blended_roas"),
        safe_ratio(F.col("_c.spend"), F.col("_c.new")).alias("blended_cac"),
        F.coalesce(F.col("_c.new"), F.lit(0.0)).alias("total_new_customers"),
        "best_roas_channel",
        F.col("_c.lowest").alias("lowest_cac_channel"))


def customer_mix(customers_new: DataFrame, customers_ext: DataFrame, end=None) -> DataFrame:
    """Monthly New vs Existing customers (tag, union, pivot with fixed values)."""
    tagged = (customers_new.withColumn("customer_type", F.lit("New"))
              .unionByName(customers_ext.withColumn("customer_type", F.lit("Existing"))))
    if end is not None:
        tagged = cap_period(tagged, "date", end)
    p = tagged.groupBy("date").pivot("customer_type", ["New", "Existing"]).agg(F.sum("value"))
    return p.fillna(0.0, subset=["New", "Existing"])


def new_customer_ranking(customers_new: DataFrame, end=None) -> DataFrame:
    """New customers per channel, most first."""
    c = customers_new if end is None else cap_period(customers_new, "date", end)
    return (c.groupBy("channel_name").agg(F.sum("value").alias("new_customers"))
             .orderBy(F.col("new_customers").desc(), "channel_name"))


def spend_gaps(trends: DataFrame) -> DataFrame:
    """Q11: channel-months with no positive spend."""
    return trends.where(~(F.col("total_spend") > 0) | F.col("total_spend").isNull())


def low_roas_label(trends: DataFrame, threshold: float = 1.5) -> DataFrame:
    """``churned`` = 1 when the month's ROAS is under ``threshold``."""
    return trends.withColumn("churned", (F.col("monthly_roas") < threshold).cast("int"))
